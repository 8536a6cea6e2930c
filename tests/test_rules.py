"""Rules on hand-made rows: ids, sentences, scores, validation, repeated appends, streams."""

import hashlib
import json

from pyspark.sql import functions as F

from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id
from claimweft.operators import chat, records, validate
from claimweft.sources.jsonl import append_new, new_rows, read_jsonl
from claimweft.streaming.append import append_stream


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column).first()[0]


def test_ids_are_hashes_of_canonical_json(spark):
    for s in ("plain", 'quo"te\\', "é \x7f", "😀\n\t", ""):
        assert one(spark, json_string(F.col("v")), v=s) == json.dumps(s)
    want = "ev_" + hashlib.sha256(b'{"a":"x","b":3}').hexdigest()[:24]
    assert one(spark, stable_id("ev", b=F.lit("3"), a=json_string(F.col("v"))), v="x") == want


def test_sentences_drop_unterminated_lines_but_the_last(spark):
    assert one(spark, T.sentences(F.col("v")), v="foo bar\nbaz. 3.5 m? end") == ["baz.", "3.", "5 m?", "end"]
    assert one(spark, T.sentences(F.col("v")), v="") == []


def test_scores(spark):
    got = {s: one(spark, T.span_score(F.col("v")), v=s) for s in ("Thanks", "Was Berta at sea?", "It was not 3 maybe.", "blue", "")}
    assert got["Thanks"] is None and got["blue"] is None and got[""] is None
    assert abs(got["Was Berta at sea?"] - 0.85) < 1e-9 and got["It was not 3 maybe."] == 0.95


def test_chat_example(spark):
    export = spark.createDataFrame([(1, 0, "user", "Was Berta at sea?"), (1, 1, "external", "I met Berta yesterday. It had three ropes."), (1, 2, "user", "Thanks")], "conv_id long, turn long, role string, text string")
    spans = chat.spans(chat.context_windows(chat.evidence(chat.messages(export))))
    rows = spans.orderBy("message_index", "sentence_no").collect()
    assert [r["sentence"] for r in rows] == ["Was Berta at sea?", "I met Berta yesterday.", "It had three ropes."]
    assert rows[0]["risk_flags"] == "question_speech_act" and rows[2]["risk_flags"] == "context_dependent_coreference"
    v = validate.validate(chat.claims(spans))
    assert v.where("status = 'accepted_extracted'").count() == 3
    wrong = validate.validate(chat.claims(spans).withColumn("evidence_text", F.regexp_replace("evidence_text", "three", "four")))
    assert [r["errors"] for r in wrong.where("errors <> ''").collect()] == ["evidence_not_exact_substring,quantity_mismatch"]


def test_overlapping_utterances(spark):
    rows = [("s", "a", 0.0, 3.0, 0.9, 0.9), ("s", "b", 2.5, 4.0, 0.9, 0.9), ("s", "c", 5.0, 6.0, 0.5, 0.4), ("t", "d", 0.0, 9.0, 0.9, 0.9)]
    u = spark.createDataFrame(rows, "source_id string, utterance_id string, start double, end double, asr_confidence double, diarization_confidence double")
    assert dict(records.utterance_risk(u).select("utterance_id", "risk_flags").collect()) == {"a": "overlapping_speech", "b": "overlapping_speech", "c": "low_asr_confidence,speaker_uncertain", "d": ""}


def test_redaction_and_findings(spark):
    t = "Write to jo@example.org or dial 415-555-0187."
    assert one(spark, records.redact(F.col("v")), v=t) == "Write to [EMAIL] or dial [PHONE]."
    found = records.pii_findings(spark.createDataFrame([("r", t)], "id string, text string"), "id").collect()
    assert sorted(r["preview"] for r in found) == ["***-***-0187", "j***@example.org"]


def test_appends_are_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, v string")
    path = str(tmp_path / "t")
    append_new(rows, path, "id")
    append_new(rows, path, "id")
    assert read_jsonl(spark, path, rows.schema).count() == 2
    assert new_rows(rows, rows.limit(0), "id").count() == 2
    source = str(tmp_path / "in")
    rows.union(spark.createDataFrame([(3, "c")], rows.schema)).write.json(source)
    append_stream(spark.readStream.schema(rows.schema).json(source), path, "id", str(tmp_path / "cp")).awaitTermination()
    assert read_jsonl(spark, path, rows.schema).count() == 3


def test_redaction_of_odd_texts_is_that_of_the_sql(spark, tmp_path):
    """Numbers parted by one character, words beyond ASCII at an edge, every kind of blank: pii_redact gives its SQL's rows."""
    import duckdb

    from claimweft.plans import registry
    from conftest import SMALL

    phones = ["415-555-0187 415-555-0188", "+1 (415) 555-0187,4155550188;415.555.0189", "14155550187", "1234155550187", "415\x0b555\x0b0187", "(415)\t555\n0187\n", "٤415-555-0187", "415-555-0187\n"]
    words = ["éjo@example.org", "jo@example.orgé", ".jo@example.org", "a@b.co,c@d.org", "jo@example.org_", "é123-45-6789", "123-45-6789é", "x123-45-6789", "123-45-6789 123-45-6780", "", None]
    d, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(i, t) for i, t in enumerate(phones + words)], "doc_id long, text string").coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{SMALL}/conversations.parquet").coalesce(1).write.parquet(f"{d}/conversations.parquet")
    registry.queries()["pii_redact"](spark, d).write.parquet(out)
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.execute(f"create view {t} as select * from '{d}/{t}.parquet/*.parquet'")
    c.execute(f"create table want as {registry.oracle_sql()['pii_redact']}")
    assert not c.execute(f"select * from want except all select record_id, digest from '{out}/*.parquet'").fetchall()
    assert one(spark, records.redact(F.col("v")), v=phones[0]) == "[PHONE] [PHONE]"
