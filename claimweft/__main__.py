"""Command line: python -m claimweft COMMAND [ARGUMENTS] --root DIR; ``commands`` lists them all."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from claimweft import config, demo, pipeline
from claimweft.operators import measures, propositions
from claimweft.plans import catalog
from claimweft.sources import jsonl

MODAL = ("chat", "pdf", "audio")
#: Command -> (arguments, what it does with the store and them; the result is printed, a whole number is the exit code).
COMMANDS = {
    "init": ((), lambda st, a: Path(st.settings.root).mkdir(parents=True, exist_ok=True)),
    "seed-demo-artifacts": (("folder",), lambda st, a: {m: pipeline.run_modality(st, m, f) for m, f in demo.write_files(a.folder).items()}),
    "register-source": (("file", "modality"), lambda st, a: st.add("sources", pipeline.ingest.register_files(st.spark, a.file, a.modality).select("source_id", "source_modality", "source_file", "sha256"))),
    "ingest-chat": (("file",), lambda st, a: pipeline.ingest_chat(st, a.file)), "ingest-pdf": (("file",), lambda st, a: pipeline.ingest_pdf(st, a.file)), "ingest-audio-transcript": (("file",), lambda st, a: pipeline.ingest_audio_transcript(st, a.file)),
    "ingest-images": (("file",), lambda st, a: pipeline.ingest_images(st, a.file)), "ingest-image-ocr": (("file",), lambda st, a: pipeline.ingest_image_ocr(st, a.file)), "normalize-audio": (("file", "folder"), lambda st, a: [r.asDict() for r in pipeline.ingest.normalization_plans(pipeline.ingest.register_files(st.spark, a.file, "audio"), a.folder).collect()]),
    "propose-image-regions": ((), lambda st, a: pipeline.propose_image_regions(st)), "build-image-evidence": ((), lambda st, a: pipeline.build_evidence(st, "image")), "build-image-cluster-evidence": ((), lambda st, a: pipeline.build_cluster_evidence(st)),
    "embed-image-regions": ((), lambda st, a: pipeline.embed(st, st.spark.read.parquet(a.table)) if a.table else pipeline.embed_image_regions(st)), "classify-image-regions": ((), lambda st, a: pipeline.classify_image_regions(st)), "cluster-image-regions": ((), lambda st, a: pipeline.cluster_image_regions(st, a.threshold, source_id=a.source_id)),
    "chunk-image-ocr": ((), lambda st, a: pipeline.chunk(st, "image")), "detect-image-ocr-spans": ((), lambda st, a: pipeline.detect_spans(st, "image")),
    "build-evidence": ((), lambda st, a: pipeline.build_evidence(st, a.modality or "all")), "chunk": ((), lambda st, a: pipeline.chunk(st, a.modality or "all")), "detect-spans": ((), lambda st, a: pipeline.detect_spans(st, a.modality or "all")),
    "extract-claims": ((), lambda st, a: pipeline.extract_claims(st, a.modality or "all", a.source_id)), "validate-claims": ((), lambda st, a: pipeline.validate_claims(st, a.source_id, tuple(a.claim_id or ()))), "import-raw-claims": (("file",), lambda st, a: pipeline.import_raw_claims(st, a.file)), "normalize-claims": ((), lambda st, a: pipeline.normalize_claims(st)),
    "run-chat": (("file",), lambda st, a: pipeline.run_modality(st, "chat", a.file)), "run-pdf": (("file",), lambda st, a: pipeline.run_modality(st, "pdf", a.file)), "run-audio-transcript": (("file",), lambda st, a: pipeline.run_modality(st, "audio", a.file)), "run-images": (("file",), lambda st, a: pipeline.run_modality(st, "image", a.file)),
    "route-models": ((), lambda st, a: pipeline.route_models(st)), "dedupe-claims": ((), lambda st, a: pipeline.dedupe_claims(st, a.include_singletons)), "repair-claims": ((), lambda st, a: pipeline.repair_claims(st)), "apply-repairs": ((), lambda st, a: pipeline.apply_repairs(st)),
    "review-claim": (("id",), lambda st, a: pipeline.review_claim(st, a.id, a.decision, a.reviewer_id, a.reason_code or [], a.notes)), "review-queue": ((), lambda st, a: pipeline.review_queue(st, a.include_reviewed, a.out if a.format == "html" else None)),
    "detect-pii": ((), lambda st, a: pipeline.detect_pii(st, a.table or "all")), "redact-pii": (("table_name", "out_path"), lambda st, a: pipeline.redact_pii(st, a.table_name, a.out_path)), "check-privacy": ((), lambda st, a: _privacy(st, a)), "retention-plan": ((), lambda st, a: pipeline.retention_plan(st)),
    "eval-gold": (("file",), lambda st, a: pipeline.eval_gold(st, a.file)), "report": ((), lambda st, a: pipeline.report(st, a.out, a.format)), "acceptance-check": ((), lambda st, a: int(bool(pipeline.acceptance_check(st, a.summary)))), "finalize-run": (("folder",), lambda st, a: pipeline.finalize(st, a.folder, a.gold)),
    "export-graph": ((), lambda st, a: pipeline.export_graph(st, a.out)), "export-metta": ((), lambda st, a: propositions.write_s_expressions(st.need("claims_normalized"), a.out)), "export-sqlite": ((), lambda st, a: pipeline.measures_export(st, a.out)),
    "trace-claim": (("id",), lambda st, a: _trace(st, a)), "validate-jsonl": (("file", "table_name"), lambda st, a: _broken(pipeline.tables.violations({a.table_name: st.spark.read.json(a.file)}))), "validate-artifacts": ((), lambda st, a: _broken(pipeline.validate_tables(st))),
    "example-evidence": ((), lambda st, a: {"evidence_id": "ev_msg_example", "source_id": "src_example", "source_modality": "chat", "evidence_type": "message_span", "text": "The crane has two cables.", "provenance": {"conversation_id": "c", "message_id": "m", "sender_id": "ann"}, "risk_flags": []}),
}
for _m in MODAL:
    COMMANDS[f"build-{_m}-evidence"] = ((), lambda st, a, m=_m: pipeline.build_evidence(st, m))
    COMMANDS[f"chunk-{_m}"] = ((), lambda st, a, m=_m: pipeline.chunk(st, m))
    COMMANDS[f"detect-{_m}-spans"] = ((), lambda st, a, m=_m: pipeline.detect_spans(st, m))


def _broken(rows) -> int:
    """Print the broken rules; 1 if there are some."""
    found = 0
    for r in rows.toLocalIterator():
        found = 1
        print(f"{r['table']}: {r.record_id}: {r.code}")
    return found


def _privacy(st, a):
    n, _ = pipeline.check_privacy(st)
    print(f"{n} violations")
    return int(bool(n) and not a.report_only)


def _trace(st, a):
    document = pipeline.trace_claim(st, a.id)
    if a.format == "html":
        Path(a.out).write_text(measures.trace_html(document), encoding="utf-8")
        return None
    return document


def session() -> SparkSession:
    return SparkSession.builder.appName("claimweft").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="claimweft", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("commands", "queries"):
        sub.add_parser(name)
    for name, needs in (("run", ("data", "out")), ("append", ("data", "out", "key"))):
        c = sub.add_parser(name)
        c.add_argument("name")
        for n in needs:
            c.add_argument(f"--{n}", required=True)
        c.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    for name, (arguments, _) in COMMANDS.items():
        c = sub.add_parser(name)
        for n in arguments:
            c.add_argument(n)
        c.add_argument("--root", default=None, help="folder of the tables")
        c.add_argument("--config", default=None, help="settings as JSON or YAML")
        for flag in ("--modality", "--source-id", "--out", "--summary", "--gold", "--table", "--notes") if name != "register-source" else ("--out",):
            c.add_argument(flag)
        c.add_argument("--claim-id", action="append")
        c.add_argument("--reason-code", action="append")
        c.add_argument("--decision", default="needs_review")
        c.add_argument("--reviewer-id", default="")
        c.add_argument("--threshold", type=float, default=0.08)
        c.add_argument("--format", default="markdown")
        for flag in ("--include-reviewed", "--include-singletons", "--report-only"):
            c.add_argument(flag, action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code 1 when an acceptance check, a table rule or a privacy rule fails; clusters and memory are set by
    spark-submit or the environment.
    """
    p = parser()
    a = p.parse_args(argv)
    if a.command == "commands":
        print("\n".join(sorted(COMMANDS)))
        return 0
    queries = catalog.queries()
    if a.command == "queries":
        print("\n".join(sorted(queries)))
        return 0
    if a.command in ("run", "append"):
        if a.name not in queries:
            p.error(f"no query {a.name}")
        rows = queries[a.name](spark or session(), a.data)
        jsonl.append_new(rows, a.out, a.key) if a.command == "append" else rows.write.mode("overwrite").format(a.format).save(a.out)
        return 0
    settings = config.load(a.config)
    settings = dataclasses.replace(settings, root=a.root) if a.root else settings
    got = COMMANDS[a.command][1](pipeline.Store(spark or session(), settings), a)
    if isinstance(got, int) and not isinstance(got, bool):
        return got
    if isinstance(got, tuple):
        print(f"created {got[0]}, skipped {got[1]}")
    elif got is not None:
        print(json.dumps(got, indent=2, sort_keys=True, default=str, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
