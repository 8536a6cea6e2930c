"""Rules of the queries' inputs and results that the small tables do not reach."""

import duckdb
from pyspark.sql import functions as F

from claimweft.functions import text as T
from claimweft.operators import governance, propositions
from claimweft.plans import flow, run
from claimweft.sources import exports
from conftest import SMALL


def test_upper_case_of_quotes_is_that_of_the_sql(spark):
    chars = spark.createDataFrame([(i, f"a{chr(i)}b{chr(i)}") for i in (*range(1, 0x700), *range(0x1E00, 0x2000), *range(0xA7C0, 0xA7E0), *range(0xFB00, 0xFB20), *range(0x10D50, 0x10D90))], "i int, evidence_text string")
    got = {r.i: (r.t, r.u) for r in chars.select("i", F.col("evidence_text").alias("t"), F.expr(T.simple_upper("evidence_text")).alias("u")).collect()}
    want = dict(duckdb.connect().execute("SELECT x, upper(x) FROM (SELECT unnest(?) AS x)", [[t for t, _ in got.values()]]).fetchall())
    assert not [(hex(i), t, u, want[t]) for i, (t, u) in got.items() if u != want[t]]
    faulty = exports.with_claim_faults(spark.createDataFrame([("claim_0", "Die Straße ist nicht naß.")], "claim_id string, evidence_text string"))
    assert faulty.first().evidence_text == "DIE STRAẞE IST NICHT NAẞ."


def test_groups_name_all_their_sources(spark):
    own = "'n' || id AS normalized_claim_id, 'c' || id AS claim_id, 's' || (id % 1500) AS source_id, 'e' || id AS evidence_id, 'a' AS subject, 'p' AS predicate, 'o' AS object, 'm' AS modality, 't' AS truth_status, 0.5D AS confidence"
    (group,) = propositions.duplicate_groups(spark.range(3000).selectExpr(*own.split(", "))).collect()
    assert group.source_ids == sorted(f"s{i}" for i in range(1500)) and (group.member_count, group.source_count) == (3000, 1500)


def test_personal_data_of_the_queries_is_that_of_their_sql(spark, monkeypatch):
    texts = ["415-555-0142 415-555-0143", "call 415-555-0142\n415-555-0143,415-555-0144.", "für.jo@example.orgß x", "ßjo@example.org", "é123-45-6789é", "(415)\x0b555-0142", "+1 415 555 0142-1415.555.0142", "nothing"]
    rows = [(f"ev_{i}", "s", t) for i, t in enumerate(texts)]
    empty = spark.createDataFrame([], "message_id string, source_id string, text string")
    monkeypatch.setattr(run, "contacts", lambda s, d: spark.createDataFrame(rows, "evidence_id string, source_id string, text string"))
    monkeypatch.setattr(run.flow, "messages", lambda s, d: empty)
    duck = duckdb.connect()
    duck.execute("CREATE TABLE contacts AS SELECT 'ev_' || (i - 1) AS evidence_id, x AS text FROM (SELECT unnest(?) AS x, generate_subscripts(?, 1) AS i)", [texts, texts])
    kinds = (("email", run._marks(run.EMAIL, False)), ("phone", run._marks(run.PHONE_SQL, True)), ("ssn", run._marks(run.SSN_SQL, False)))
    found = " UNION ALL ".join(run._found(k, m, "evidence", "contacts", "evidence_id") for k, m in kinds)
    want = duck.execute(f"SELECT record_id, pii_type, min(char_start), min(char_start) + length(match)::INT FROM ({found}) GROUP BY record_id, pii_type, match").fetchall()
    got = run._pii(spark, "").select("record_id", "pii_type", "char_start", "char_end").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert len([x for x in want if x[0] == "ev_0"]) == 1
    sql = run.oracle_sql()["pii_redactions_all"]
    sql = sql[sql.rindex("FROM (SELECT evidence_id, ") :]
    want = duck.execute(f"SELECT record_id, n::INT, digest {sql.replace('SELECT evidence_id,', 'SELECT evidence_id AS record_id,', 1)}").fetchall()
    assert sorted(map(tuple, run._redacted(spark, "").select("record_id", "replacement_count", "digest").collect())) == sorted(want)
    rules = governance.pii_findings(run.contacts(spark, ""), "evidence")
    assert rules.where("record_id = 'ev_0'").count() == 2  # the operator's own rules find both


def test_ocr_texts_compile(spark):
    """A stage over 64 KB a method is compiled in vain, on the driver too, and costs memory there."""
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = flow.ocr_texts.rows(spark, SMALL)._jdf.queryExecution().executedPlan()
        stages = getattr(getattr(spark.sparkContext._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
        sizes = [(len(stages.apply(i)._2()), stages.apply(i)._3().maxMethodCodeSize()) for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)
    assert sizes and all(source < 500_000 and 0 < method < 65_536 for source, method in sizes)
