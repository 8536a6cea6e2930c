"""Sections against a stack of open headings, repairs, imports, gates, report tables and their export."""

import random
import sqlite3

from pyspark.sql import functions as F

from claimweft.operators import clusters, provenance, records, repair, reports, sections, validate
from claimweft.sources.jsonl import record_table

BLOCKS = "source_id string, page int, block_no int, text string"


def test_sections_of_a_survey(spark):
    texts = ["1. Quay wall", "The wall was dry.", "1.1 Crane Tracks", "They were laid in 2019.", "2. Next Steps", "THE TRACKS WERE LAID IN 2019."]
    b = spark.createDataFrame([("s", 1 + i // 4, i % 4, t) for i, t in enumerate(texts)], BLOCKS)
    got = [r.section for r in sections.section_paths(b, records.furniture(b)).orderBy("page", "block_no").collect()]
    assert got == ["1. Quay wall"] * 2 + ["1. Quay wall > 1.1 Crane Tracks"] * 2 + ["2. Next Steps"] * 2


def test_heading_levels(spark):
    want = {"1) Quay": 1, "1.2.3 Rail bolts": 3, "Appendix C: Drawings": 1, "CRANE CABIN": 1, "Crane Cabin Findings": 2, "The cabin was clean": None, "Cabin Is Clean": None, "Crane Cabin.": None, "ok": None, "": None, "X" * 121: None, "  Site \t Plan ": 2}
    b = spark.createDataFrame([("s", 1, i, t) for i, t in enumerate(want)], BLOCKS)
    got = {r.block_no: r.level for r in sections.headings(b).collect()}
    assert [got.get(i) for i in range(len(want))] == list(want.values())


def test_paths_equal_a_stack(spark):
    r = random.Random(5)
    rows, want = [], {}
    for s in ("a", "b", "c"):
        stack = []
        for i in range(120):
            level = r.choice([None, 1, 2, 3, 4, 5])
            number = ".".join(str(r.randint(1, 9)) for _ in range(level or 0)) + ("." if level == 1 else "")
            text = f"{number} Part {i}" if level else f"plain words {i}."
            furniture = r.random() < 0.1
            if furniture:
                want[s, 1, i] = ""
            else:
                if level:
                    stack = stack[: min(level, len(stack) + 1) - 1] + [text]
                want[s, 1, i] = " > ".join(stack)
            rows.append((s, 1, i, text, "header" if furniture else None))
    b = spark.createDataFrame(rows, BLOCKS + ", kind string")
    got = sections.section_paths(b.drop("kind"), b.where("kind IS NOT NULL").drop("text")).collect()
    assert {(g.source_id, g.page, g.block_no): g.section for g in got} == want and len(got) == len(rows)


def test_repairs(spark):
    rows = [
        ("blanks", "The barge   Lund looks slow.", "The barge Lund looks slow.", "Well. The barge Lund looks slow. Yes."), ("quotes", 'She called it "sound" then.', "She called it “sound” then.", "She called it “sound” then."),
        ("exact", "Lund is slow.", "Lund is slow.", "Lund is slow."), ("wrong", "Lund is fast.", "Lund is slow.", "Lund is slow."), ("slice", "ﬁne  day", None, "What a fine day it is."), ("none", "x", None, None), ("null", None, "a", "a"), ("bare", "  ", "a b", "a b"),
    ]
    got = {r.claim_id: (r.suggestion, r.scope) for r in repair.suggest_repairs(spark.createDataFrame(rows, "claim_id string, evidence_text string, span_text string, evidence string")).collect()}
    assert got == {"blanks": ("The barge Lund looks slow.", "span"), "quotes": ("She called it “sound” then.", "span"), "slice": ("fine day", "evidence")}


def test_import_of_loose_claims(spark):
    rows = [(1, '{"claim":"Lund is slow.","evidence":"Lund is slow.","attribution":"kim","confidence":"82%","source_id":"s","evidence_id":"e","source_modality":"chat"}'), (2, '{"claim":"x","confidence":0.5}'), (3, "no json"), (4, None), (5, "[]")]
    got = {r.line: r for r in repair.import_claims(spark.createDataFrame(rows, "line int, payload string")).collect()}
    assert got[1].status == "repaired" and got[1].confidence == 0.82 and (got[1].attribution_type, got[1].agent) == ("speaker", "kim") and got[1].claim_id.startswith("claim_import_")
    assert all(got[i].status == "schema_invalid" for i in (2, 3, 4, 5))


def test_gates(spark):
    c = [("a", "unnamed_visual_feature_cluster", None, None, None, 5, 0.91, 3), ("b", "unnamed_visual_feature_cluster", None, None, None, 2, None, 1), ("c", "named_visual_classification", "accept", None, 0.1, None, None, None), ("d", "named_visual_classification", None, None, 0.6, None, None, None), ("e", "named_visual_classification", "reject", True, 1.0, None, None, None), ("f", None, None, None, None, None, None, None)]
    got = dict(provenance.image_gate(spark.createDataFrame(c, "claim_id string, claim_type string, review_decision string, human_confirmed boolean, confidence double, cluster_size int, cohesion_score double, source_count int")).collect())
    assert got == {"a": "", "b": "image_cluster_too_small,image_cluster_low_cohesion,image_cluster_insufficient_cross_source", "c": "", "d": "image_label_low_confidence", "e": "human_review_rejected_label", "f": ""}


def test_colors(spark):
    v = [(1, [0.8, 0.1, 0.1]), (2, [0.5, 0.5, 0.5]), (3, [0.9, 0.8, 0.1]), (4, [0.1, 0.8, 0.9]), (5, [0.9, 0.1, 0.8]), (6, [0.0, 0.0, 0.1]), (7, [0.9, 0.9, 0.9])]
    got = {r.vec_id: r.color for r in clusters.dominant_color(spark.createDataFrame(v, "vec_id long, embedding array<float>")).collect()}
    assert list(map(got.get, range(1, 8))) == ["red", "gray", "yellow", "cyan", "magenta", "black", "white"]


def test_report_and_export(spark, tmp_path):
    df = spark.createDataFrame([("k", "a|b", 1), ("k", None, 2)], "counter string, value string, n int")
    assert reports.markdown({"Counts": df}).splitlines()[2:6] == ["| counter | value | n |", "|---|---|---|", "| k |  | 2 |", "| k | a\\|b | 1 |"]
    path = str(tmp_path / "x.db")
    table = record_table(spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int").coalesce(1), "id")
    for _ in range(2):
        assert reports.export_sqlite({"t": table.union(table)}, path) == {"t": 4}
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT record_key, payload_json FROM t ORDER BY 1").fetchall() == [("a", '{"id":"a","v":1}'), ("b", '{"id":"b","v":2}')]
        assert db.execute("SELECT * FROM artifact_counts").fetchall() == [("t", 4)]


def test_audio_windows(spark):
    u = spark.createDataFrame([("s", "u1", "S0", 0.0, 2.0, "Did it?"), ("s", "u2", "S1", 2.1, 6.0, "Yes.")], "source_id string, utterance_id string, speaker string, start double, end double, text string")
    rows = records.audio_windows(u).orderBy("utterance_id").collect()
    assert (rows[1].chunk_text, rows[1].chunk_start, rows[1].chunk_end, rows[1].speakers) == ("S0: Did it?\nS1: Yes.", 0.0, 6.0, "S0,S1") and rows[0].chunk_text == "S0: Did it?"
    assert records.audio_windows(u.where(F.lit(False))).count() == 0


def test_repairs_are_applied_once(spark):
    claims = spark.createDataFrame([("a", "x  y", "x y", "x y."), ("b", "changed", "u v", "u v"), ("c", "p  q", "r", "s")], "claim_id string, evidence_text string, span_text string, evidence string")
    suggested = spark.createDataFrame([("a", "x  y", "x y", "span"), ("b", "u  v", "u v", "span"), ("c", "p  q", "p q", "span"), ("d", "m  n", "m n", "span")], "claim_id string, original string, suggestion string, scope string")
    first = repair.apply_repairs(suggested, claims, claims).collect()
    assert {r.claim_id: (r.outcome, r.reason) for r in first} == {"a": ("created", ""), "b": ("failed", "claim_evidence_text_changed"), "c": ("failed", "suggested_text_not_exact_support"), "d": ("failed", "missing_claim")}
    made = [(r.new_claim_id,) for r in first if r.outcome == "created"]
    again = repair.apply_repairs(suggested, claims, spark.createDataFrame(made, "claim_id string")).collect()
    assert [r.outcome for r in again if r.claim_id == "a"] == ["skipped"]


def test_rates_of_no_jobs_are_null(spark):
    jobs = spark.createDataFrame([], "source_id string, cost_usd double, latency_seconds double")
    assert tuple(reports.job_rates(jobs, spark.createDataFrame([], "status string")).first()) == (None, None)


def test_s_expressions_keep_letters(spark):
    n = spark.createDataFrame([("n", "c", "s", "e", "speaker:x", "asserts", 'é "q"\\', "asserted", "unverified", 1.0)], "normalized_claim_id string, claim_id string, source_id string, evidence_id string, subject string, predicate string, object string, modality string, truth_status string, confidence double")
    lines = [r.line for r in validate.metta(n).collect()]
    assert lines[0] == '(claim "n" "c" "s" "e" "speaker:x" "asserts" "é \\"q\\"\\\\" "{\\"modality\\":\\"asserted\\",\\"truth_status\\":\\"unverified\\"}" )' and lines[3] == '(claim-confidence "n" 1 )'
