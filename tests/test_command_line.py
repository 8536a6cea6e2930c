"""The command line over stored tables: stages add nothing twice, and exit codes tell what failed."""

import json
import sqlite3

import pytest

from claimweft import demo, pipeline
from claimweft.__main__ import COMMANDS, main
from claimweft.config import Settings, load, parse_yaml
from conftest import SMALL


def test_lists_and_refuses(capsys):
    assert main(["queries"]) == 0 and "claim_status_counts" in capsys.readouterr().out.split()
    assert main(["commands"]) == 0 and len(capsys.readouterr().out.split()) == len(COMMANDS) == 58
    for bad in (["run"], ["run", "no_such", "--data", "x", "--out", "y"], ["append", "chat_messages", "--data", "x", "--out", "y"], ["nonsense"]):
        with pytest.raises(SystemExit):
            main(bad)


def test_runs_and_appends(spark, tmp_path):
    out = str(tmp_path / "m")
    assert main(["run", "chat_messages", "--data", SMALL, "--out", out], spark) == 0
    n = spark.read.parquet(out).count()
    for _ in range(2):
        assert main(["append", "chat_messages", "--data", SMALL, "--out", out + "l", "--key", "message_id"], spark) == 0
    assert n and spark.read.json(out + "l").count() == n


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("demo")
    st = pipeline.Store(spark, Settings(root=str(root / "tables")))
    files = demo.write_files(str(root / "files"))
    first = {m: pipeline.run_modality(st, m, f) for m, f in files.items()}
    return st, files, first, root


def test_a_whole_run(store):
    st, files, first, _ = store
    assert {k: v[0] for k, v in first["chat"].items()} == {"ingest_chat": 4, "build_evidence": 4, "chunk": 4, "detect_spans": 5, "extract_claims": 5, "validate_claims": 5, "normalize_claims": 5, "export_graph": 5}
    spans = {r.text: r for r in st.need("spans").collect()}
    assert spans["She has two cables."].risk_flags == ["context_dependent_coreference"] and spans["Was the crane repaired?"].risk_flags == ["question_speech_act"] and "Thanks" not in spans
    assert spans["It was not replaced."].risk_flags == ["assistant_generated_text", "context_dependent_coreference"] and spans["It was not replaced."].char_start == 23
    held = {r.evidence_text: sorted(r.reason_codes) for r in st.need("quarantine").collect()}
    assert held["Two valves were replaced."] == ["low_asr_confidence", "overlapping_speech"] and held["The gauge has failed."] == ["overlapping_speech"]
    accepted = {r.evidence_text for r in st.need("claims_validated").collect()}
    assert {"The pump has three valves.", "The deck was painted.", "The quay wall has four cracks.", "It may leak.", "The fenders were not found."} <= accepted
    blocks = {(r.page, r.block_no): r for r in st.need("pdf_blocks").collect()}
    assert blocks[1, 0].block_type == blocks[2, 0].block_type == "header" and blocks[2, 2].section_path == ["1. Quay", "1.1 Fenders"] and blocks[1, 2].cleanup_actions == ["join_wrapped_lines"]
    assert {(r.format, r.width, r.height) for r in st.need("images").collect()} == {("PNG", 240, 300), ("PNG", 241, 300)}


def test_stages_add_nothing_twice(store):
    st, files, first, _ = store
    counts = {name: df.count() for name, df in st.all().items() if name != "jobs"}
    for m, f in files.items():
        again = pipeline.run_modality(st, m, f)
        assert all(v[0] == 0 for k, v in again.items() if k != "export_graph"), again
    assert {name: df.count() for name, df in st.all().items() if name != "jobs"} == counts


def test_reviews_reports_and_exit_codes(store, spark, capsys):
    st, files, _, root = store
    root_ = ["--root", st.settings.root]
    claim = next(r.claim_id for r in st.need("quarantine").collect() if r.evidence_text == "The gauge has failed.")
    for _ in range(2):
        assert main(["review-claim", claim, "--decision", "Needs-Review", "--reviewer-id", "kim", "--reason-code", "b", *root_], spark) == 0
    assert capsys.readouterr().out.split("\n")[:2] == ["created 1, skipped 0", "created 0, skipped 0"]
    assert sorted(r.status for r in st.need("audit_events").collect()) == ["created", "skipped"]
    with pytest.raises(Exception, match="not found"):
        main(["review-claim", "claim_none", "--decision", "accept", "--reviewer-id", "kim", *root_], spark)
    page = str(root / "queue.html")
    assert main(["review-queue", "--format", "html", "--out", page, *root_], spark) == 0
    queue = {r.claim_id: r for r in st.need("review_queue").collect()}
    assert queue[claim].review_state == "needs_review" and "<audio" in open(page).read() and "--decision accept" in queue[claim].review_commands["accept"]
    for command in ("route-models", "dedupe-claims", "repair-claims", "apply-repairs", "detect-pii", "check-privacy", "retention-plan"):
        assert main([command, *root_], spark) == 0, command
    gold = root / "gold.json"
    ids = {r.evidence_text: r.evidence_id for r in st.need("claims_raw").collect()}
    gold.write_text(json.dumps({"claims": [c | {"evidence_id": ids[c["evidence_text"]]} for c in demo.GOLD["claims"]]}))
    assert main(["finalize-run", str(root / "reports"), "--gold", str(gold), *root_], spark) == 0
    found = dict(st.need("gold_eval").select("metric", "value").collect())
    assert found["accepted_recall"] == 1.0 and found["quarantine_recall"] == 1.0 and 0 < found["accepted_precision"] < 1
    text = (root / "reports" / "extraction_summary.md").read_text()
    assert "## Quality metrics" in text and "| Accepted text claim exact-evidence rate | 100.0% |" in text and "## Acceptance Checks" in text
    assert main(["report", "--format", "html", "--out", str(root / "r.html"), *root_], spark) == 0 and "<table>" in (root / "r.html").read_text()
    with sqlite3.connect(root / "reports" / "claims.sqlite") as db:
        assert all(db.execute(f"SELECT count(*) FROM {name}").fetchone()[0] == n for name, n in db.execute("SELECT * FROM artifact_counts").fetchall())
    capsys.readouterr()
    assert main(["trace-claim", claim, *root_], spark) == 0
    traced = json.loads(capsys.readouterr().out)
    assert traced["found"] and traced["raw_claim"]["claim_id"] == claim and traced["span"]["text"] == "The gauge has failed." and traced["source"]["source_modality"] == "audio" and len(traced["review_decisions"]) == 1 and traced["jobs"]
    assert main(["trace-claim", "claim_none", *root_], spark) == 0 and not json.loads(capsys.readouterr().out)["found"]
    assert main(["validate-artifacts", *root_], spark) == 0
    st.need("spans").limit(1).withColumn("span_id", __import__("pyspark").sql.functions.lit("bad")).withColumn("evidence_id", __import__("pyspark").sql.functions.lit("none")).write.mode("append").parquet(st.path("spans"))
    assert main(["acceptance-check", "--summary", str(root / "reports" / "extraction_summary.md"), *root_], spark) == 1
    assert st.need("acceptance_check").where("status = 'failed'").select("check_id").collect()[0][0] == "spans_link_evidence"


def test_loose_claims_are_imported(store, spark):
    st, _, _, root = store
    good = {"claim": "The deck was painted.", "evidence": "The deck was painted.", "attribution": "S2", "confidence": "82%", "source_id": "s", "evidence_id": "e", "source_modality": "audio"}
    for name, text, want in (("a.json", json.dumps({"claims": [good, {"claim": "x", "confidence": 0.5}]}), (1, 0)), ("b.jsonl", json.dumps(good) + "\n\n" + json.dumps(good | {"evidence_id": "e2"}), (1, 1)), ("c.json", "", (0, 0))):
        (root / name).write_text(text)
        assert pipeline.import_raw_claims(st, str(root / name)) == want, name


def test_settings(tmp_path):
    assert load(str(tmp_path / "none.yaml")) == Settings()
    (tmp_path / "s.yaml").write_text("# run\nroot: /data/t\nretention_days: 30\nprivacy:\n  enabled: false\n  local_providers:\n    - own\n")
    s = load(str(tmp_path / "s.yaml"))
    assert (s.root, s.retention_days, s.privacy.enabled, s.privacy.local_providers) == ("/data/t", 30, False, ("own",)) and s.path("spans") == "/data/t/spans.jsonl"
    (tmp_path / "bad.json").write_text('{"rooot": 1}')
    with pytest.raises(ValueError, match="unknown settings"):
        load(str(tmp_path / "bad.json"))
    assert parse_yaml("a:\nb: [1, x]\nc: 'q'") == {"a": None, "b": [1, "x"], "c": "q"}
