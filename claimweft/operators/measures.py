"""Measures of a run: gold sets, acceptance checks, counters, rates, jobs, and where a claim comes from.

A run is a dict of tables by their usual names; a table that is missing has no rows.
"""

from __future__ import annotations

import html
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweft.functions.ids import json_string, stable_id
from claimweft.operators.ingest import items

Tables = dict[str, DataFrame]

# Tables and the column that names a row.
KEYS = {
    "sources": "source_id",
    "chat_messages": "message_id",
    "pdf_blocks": "block_id",
    "audio_utterances": "utterance_id",
    "images": "image_id",
    "image_regions": "region_id",
    "image_region_embeddings": "embedding_id",
    "image_feature_clusters": "feature_cluster_id",
    "evidence": "evidence_id",
    "chunks": "chunk_id",
    "spans": "span_id",
    "claims_raw": "claim_id",
    "validations": "validation_id",
    "claims_validated": "claim_id",
    "claims_normalized": "normalized_claim_id",
    "jobs": "job_id",
    "review_decisions": "review_id",
    "audit_events": "audit_event_id",
    "errors": "error_id",
    "quarantine": "quarantine_id",
}
IMAGE_MODALITIES = ("model_observation", "uncertain_observation", "hypothetical")
IMAGE_TRUTHS = ("model_observation_unverified", "human_confirmed")
IMAGE_AGENTS = ("model", "human_reviewer")
MOST_DETAILS = 20


# ---- gold sets ----------------------------------------------------------------------------------------------------


def gold_claims(exports: DataFrame) -> DataFrame:
    """evidence_id, evidence_text and expected_status of gold files (payload): a list or an object with claims."""
    i = F.col("item")
    text = lambda k: F.try_variant_get(i, f"$.{k}", "string")
    need = lambda k: F.coalesce(F.nullif(text(k), F.lit("")), F.raise_error(F.lit(f"every gold claim needs {k}")).cast("string"))
    return items(exports.select("payload"), ("claims",)).select(need("evidence_id").alias("evidence_id"), need("evidence_text").alias("evidence_text"), F.coalesce(text("expected_status"), F.lit("accepted")).alias("expected_status"))


def gold_sets(gold: DataFrame, validated_claims: DataFrame, quarantine: DataFrame) -> DataFrame:
    """side (accepted or quarantined), evidence_id, evidence_text, expected, produced: each key of either set once."""
    key = ["evidence_id", "evidence_text"]

    def side(name: str, produced: DataFrame) -> DataFrame:
        want = gold.where(F.col("expected_status") == name).select(*key, F.lit(1).alias("w"), F.lit(0).alias("p"))
        have = produced.where((F.coalesce("evidence_id", F.lit("")) != "") & (F.coalesce("evidence_text", F.lit("")) != "")).select(*key, F.lit(0).alias("w"), F.lit(1).alias("p"))
        both = want.unionByName(have).groupBy(*key).agg(F.max("w").alias("w"), F.max("p").alias("p"))
        return both.select(F.lit(name).alias("side"), *key, (F.col("w") == 1).alias("expected"), (F.col("p") == 1).alias("produced"))

    return side("accepted", validated_claims.where("support_status = 'accepted_extracted'")).unionByName(side("quarantined", quarantine))


def _rate(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), F.nullif(b, F.lit(0)).cast("double"))


def gold_metrics(gold: DataFrame, validated_claims: DataFrame, quarantine: DataFrame, validations: DataFrame) -> DataFrame:
    """metric, value: sizes of the sets, precision and recall, and shares of validations. Null where nothing is counted."""
    names = {"accepted": "accepted", "quarantined": "quarantine"}
    sets = gold_sets(gold, validated_claims, quarantine)
    of = lambda s, *tests: F.count_if(reduce(lambda a, b: a & b, [F.col("side") == s, *tests]))
    e, p = F.col("expected"), F.col("produced")
    counted = []
    for s, short in names.items():
        hit, want, have = of(s, e, p), of(s, e), of(s, p)
        counted += [want.alias(f"expected_{s}"), have.alias(f"produced_{s}"), hit.alias(f"{short}_matches"), of(s, ~e, p).alias(f"{short}_false_positives"), of(s, e, ~p).alias(f"{short}_missing"), _rate(hit, have).alias(f"{short}_precision"), _rate(hit, want).alias(f"{short}_recall")]
    flag = lambda c: _rate(F.count_if(F.col(f"summary.{c}")), F.count(F.col(f"summary.{c}")))
    v = validations.agg(
        flag("evidence_exact_match").alias("evidence_exact_match_rate"), flag("attribution_preserved").alias("attribution_preservation_rate"), flag("uncertainty_preserved").alias("uncertainty_preservation_rate"), flag("negation_preserved").alias("negation_preservation_rate"),
        flag("quantities_preserved").alias("quantity_preservation_rate"), _rate(F.count_if(F.size("summary.introduced_entities") > 0), F.count("summary.introduced_entities")).alias("unsupported_entity_rate"), _rate(F.count_if(F.col("status") == "quarantined"), F.count(F.lit(1))).alias("quarantine_rate"))
    out = [_long(sets.agg(*counted)), _long(v), gold.agg(F.count(F.lit(1)).alias("gold_claims")).select(F.lit("gold_claims").alias("metric"), F.col("gold_claims").cast("double").alias("value"))]
    return reduce(DataFrame.unionByName, out)


def _long(row: DataFrame) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns))
    return row.select(F.explode(pairs).alias("p")).select("p.*")


# ---- acceptance ---------------------------------------------------------------------------------------------------


def _empty(tables: Tables, name: str, spark: SparkSession, schema: str) -> DataFrame:
    return tables[name] if name in tables else spark.createDataFrame([], schema)


def _check(name: str, rows: DataFrame, reasons: Column, record: str, missing: str | None = None) -> DataFrame:
    """check_id, total, failed and details: rows with reasons fail. With ``missing``, a table without rows fails once."""
    bad = rows.withColumn("__r", reasons)
    fails = F.size("__r") > 0
    # details come from the first ids only; an aggregate keeps them, not a collected group
    agg = bad.agg(F.count(F.lit(1)).alias("n"), F.count_if(fails).alias("f"))
    listed = bad.where(fails).select(F.to_json(F.struct(F.col(record).cast("string").alias("record_id"), F.col("__r").alias("reasons"))).alias("d")).orderBy("d").limit(MOST_DETAILS).agg(F.array_sort(F.collect_list("d")).alias("details"))
    out = agg.crossJoin(listed)  # one row each
    if missing:
        none = F.array(F.to_json(F.struct(F.lit(missing).alias("artifact"), F.lit("missing_required_records").alias("reason"))))
        out = out.select(F.greatest("n", F.lit(1)).alias("n"), F.when(F.col("n") == 0, 1).otherwise(F.col("f")).alias("f"), F.when(F.col("n") == 0, none).otherwise(F.col("details")).alias("details"))
    return out.select(F.lit(name).alias("check_id"), F.when(F.col("f") > 0, "failed").otherwise("passed").alias("status"), F.col("n").alias("total"), F.col("f").cast("long").alias("failed"), "details", F.greatest(F.col("f") - MOST_DETAILS, F.lit(0)).cast("long").alias("omitted"))


def _why(*pairs: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(test, F.lit(False)), code) for code, test in pairs)))


def acceptance(tables: Tables, report: str | None = "") -> DataFrame:
    """Nineteen checks of a run, a row each: check_id, status, total, failed, details (20 at most), omitted.

    ``tables`` has at least sources, evidence, chunks, spans, image_regions, claims_raw, validations, claims_validated,
    claims_normalized and quarantine; more are checked for unique ids. ``report`` is the summary's text.
    """
    t = tables
    spark = t["evidence"].sparkSession
    no = F.array().cast("array<string>")
    key = lambda name, column, alias: t[name].select(F.col(column).alias(alias)).where(F.col(alias).isNotNull()).distinct()
    found = lambda df, name, column, on: df.join(key(name, column, f"__{name}"), F.col(on) == F.col(f"__{name}"), "left")
    lacks = lambda name: F.col(f"__{name}").isNull()
    present = lambda name: _check({"sources": "source_records_registered", "claims_raw": "raw_claims_extracted", "validations": "validation_run_completed"}[name], t[name].select(F.lit("x").alias("id")), no, "id", name)
    one = lambda c: c.select("check_id", "status", F.lit(1).cast("long").alias("total"), "failed", "details", "omitted")
    out = [one(present("sources"))]
    out.append(_check("evidence_records_created", found(t["evidence"], "sources", "source_id", "source_id"), _why(("missing_source", lacks("sources"))), "evidence_id", "evidence"))
    named = t["chunks"].select("chunk_id", F.explode_outer("evidence_ids").alias("e"))
    linked = found(named, "evidence", "evidence_id", "e").groupBy("chunk_id").agg(F.count("e").alias("n"), F.count_if(F.col("e").isNotNull() & lacks("evidence")).alias("unknown"))
    out.append(_check("chunks_link_evidence", linked, _why(("missing_evidence_ids", F.col("n") == 0), ("unknown_evidence_id", F.col("unknown") > 0)), "chunk_id"))
    units = t["spans"].select(F.lit("x").alias("id")).limit(1).unionByName(t["image_regions"].select(F.lit("x").alias("id")).limit(1)).limit(1)
    out.append(_check("spans_or_regions_detected", units, no, "id", "spans"))
    spans = found(found(t["spans"], "evidence", "evidence_id", "evidence_id"), "chunks", "chunk_id", "chunk_id")
    out.append(_check("spans_link_evidence", spans, _why(("unknown_evidence_id", lacks("evidence")), ("unknown_chunk_id", F.col("chunk_id").isNotNull() & lacks("chunks"))), "span_id"))
    out += [one(present("claims_raw")), one(present("validations"))]
    held = t["quarantine"].groupBy(F.col("claim_id").alias("q")).agg(F.max(F.size("reason_codes") > 0).alias("q_reasons"))
    invalid = t["validations"].where("status = 'quarantined'").join(held, F.col("claim_id") == F.col("q"), "left")
    out.append(_check("invalid_claims_quarantined_with_reasons", invalid, _why(("validation_missing_errors", F.size("errors") <= 0), ("missing_quarantine_record", F.col("q").isNull()), ("quarantine_missing_reason_codes", F.col("q").isNotNull() & ~F.col("q_reasons"))), "claim_id"))
    ev = t["evidence"].select(F.col("evidence_id").alias("e_id"), F.col("source_id").alias("e_source"), F.col("source_modality").alias("e_modality"), F.col("evidence_type").alias("e_type"), F.col("text").alias("e_text"), F.col("provenance").alias("p"))
    accepted = t["claims_validated"].where("support_status = 'accepted_extracted'").join(ev, F.col("evidence_id") == F.col("e_id"), "left")
    there = F.col("e_id").isNotNull()
    empty = there & (F.col("p").isNull() | (F.to_json("p") == "{}"))
    out.append(_check("accepted_claims_complete_provenance", found(accepted, "sources", "source_id", "source_id"), _why(("missing_evidence", ~there), ("missing_source", lacks("sources")), ("evidence_source_mismatch", F.col("e_source") != F.col("source_id")), ("evidence_modality_mismatch", F.col("e_modality") != F.col("source_modality")), ("empty_evidence_provenance", empty)), "claim_id"))
    texts = accepted.where((F.col("source_modality") != "image") | (F.col("e_type") == "ocr_text_span") | ((F.coalesce("evidence_text", F.lit("")) != "") & (F.coalesce("e_text", F.lit("")) != "")))
    out.append(_check("accepted_text_claims_exact_evidence", texts, _why(("evidence_exact_match_not_true", ~F.coalesce("validation.evidence_exact_match", F.lit(False)))), "claim_id"))
    raw = t["claims_raw"].select(F.col("claim_id").alias("r_id"), F.col("attribution").alias("r_att"))
    spoken = accepted.where(F.col("source_modality").isin("chat", "audio")).join(raw, F.col("claim_id") == F.col("r_id"), "left")
    speaker = F.col("r_att.type") == "speaker"
    out.append(_check("accepted_chat_audio_claims_attributed", spoken, _why(("missing_raw_claim", F.col("r_id").isNull()), ("missing_attribution", F.col("r_att").isNull()), ("attribution_not_speaker", ~speaker), ("missing_attribution_agent", speaker & (F.coalesce("r_att.agent", F.lit("")) == "")), ("attribution_not_preserved", ~F.col("validation.attribution_preserved"))), "claim_id"))
    out.append(_check("accepted_pdf_claims_page_provenance", accepted.where("source_modality = 'pdf'"), _why(("missing_page_provenance", F.col("p.page").isNull())), "claim_id"))
    kept = ("attribution_preserved", "negation_preserved", "uncertainty_preserved", "quantities_preserved")
    out.append(_check("accepted_claims_preserve_semantics", accepted, _why(*((k, ~F.col(f"validation.{k}")) for k in kept)), "claim_id"))
    images = t["claims_raw"].where("source_modality = 'image'")
    out.append(_check("image_claim_truth_status_policy", images, _why(("unsafe_image_modality", ~F.coalesce(F.col("modality").isin(*IMAGE_MODALITIES), F.lit(False))), ("unsafe_image_truth_status", ~F.coalesce(F.col("truth_status").isin(*IMAGE_TRUTHS), F.lit(False))), ("unsafe_image_attribution", ~F.coalesce(F.col("attribution.type").isin(*IMAGE_AGENTS), F.lit(False)))), "claim_id"))
    sure = accepted.groupBy(F.col("claim_id").alias("a_id")).agg(F.max("confidence").alias("a_confidence"))
    n = t["claims_normalized"].join(sure, F.col("claim_id") == F.col("a_id"), "left")
    out.append(_check("normalized_claims_from_accepted_claims", n, _why(("normalized_from_non_accepted_claim", F.col("a_id").isNull())), "normalized_claim_id"))
    out.append(_check("normalized_claims_preserve_confidence", n.where("a_confidence IS NOT NULL"), _why(("missing_normalized_confidence", F.col("confidence").isNull()), ("normalized_confidence_mismatch", F.col("confidence") != F.col("a_confidence")), ("missing_confidence_basis", F.coalesce("confidence_basis", F.lit("")) == "")), "normalized_claim_id"))
    blank = F.coalesce(F.exists("reason_codes", lambda x: F.coalesce(x, F.lit("")) == ""), F.lit(False))
    out.append(_check("quarantine_reason_codes_present", t["quarantine"], _why(("missing_machine_readable_reason_code", (F.coalesce(F.size("reason_codes"), F.lit(0)) <= 0) | blank)), "quarantine_id"))
    written = spark.createDataFrame([("summary", bool(report))], "id string, there boolean")
    out.append(_check("summary_report_exists", written, _why(("missing_non_empty_summary_report", ~F.col("there"))), "id"))
    ids = reduce(DataFrame.unionByName, (t[name].select(F.lit(name).alias("table"), F.col(k).cast("string").alias("id")) for name, k in KEYS.items() if name in t))
    once = ids.groupBy("table", "id").agg(F.count(F.lit(1)).alias("n"))
    unnamed = F.coalesce("id", F.lit("")) == ""
    wrong = once.withColumn("bad", F.when(unnamed, F.col("n")).otherwise(F.col("n") - 1))
    totals = wrong.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("f"))
    listed = wrong.where("bad > 0").select(F.to_json(F.struct("table", "id", F.when(unnamed, "missing_record_id").otherwise("duplicate_record_id").alias("reason"))).alias("d")).orderBy("d").limit(MOST_DETAILS).agg(F.array_sort(F.collect_list("d")).alias("details"))
    out.append(totals.crossJoin(listed).select(F.lit("artifact_ids_unique").alias("check_id"), F.when(F.col("f") > 0, "failed").otherwise("passed").alias("status"), F.col("n").alias("total"), F.col("f").alias("failed"), "details", F.greatest(F.col("f") - MOST_DETAILS, F.lit(0)).alias("omitted")))
    return reduce(DataFrame.unionByName, out)


# ---- counters and rates -------------------------------------------------------------------------------------------

#: Counter tables of a summary: title, table, column or list that is counted.
COUNTERS = (
    ("Sources By Modality", "sources", "source_modality"), ("Evidence By Modality", "evidence", "source_modality"), ("Spans By Modality", "spans", "source_modality"), ("Raw Claims By Modality", "claims_raw", "source_modality"),
    ("Validated Claims By Modality", "claims_validated", "source_modality"), ("Normalized Claims By Predicate", "claims_normalized", "predicate"), ("Entity Resolution Bases", "claims_normalized", "entity_resolution.basis"), ("Duplicate Groups By Level", "claim_duplicates", "duplicate_level"),
    ("Validation Statuses", "validations", "status"), ("Validation Errors", "validations", "errors"), ("Validation Warnings", "validations", "warnings"), ("Jobs By Stage", "jobs", "stage"), ("Model Routing By Tier", "model_routing", "selected_tier"), ("Model Routing By Role", "model_routing", "model_role"),
    ("Review Decisions", "review_decisions", "decision"), ("Review Queue By State", "review_queue", "review_state"), ("Acceptance Checks", "acceptance_check", "status"), ("Review Queue Reasons", "review_queue", "reason_codes"), ("Review Queue Warnings", "review_queue", "warnings"),
    ("Review Queue Risk Flags", "review_queue", "risk_flags"), ("Audit Events", "audit_events", "action"), ("Quarantine Reasons", "quarantine", "reason_codes"), ("PII Findings By Type", "pii_findings", "pii_type"), ("PII Redactions By Artifact", "pii_redactions", "artifact"),
    ("Privacy Policy Violations", "privacy_policy_violations", "reason_code"), ("Retention Plan Reasons", "retention_plan", "reason_code"),
)


def counters(tables: Tables) -> DataFrame:
    """counter, value, n for the 26 counter tables; nulls aren't counted, of lists every item is."""
    out = []
    for title, name, column in COUNTERS:
        if name not in tables:
            continue
        kind = tables[name].select(column).schema[0].dataType.typeName()
        each = tables[name].select((F.explode(column) if kind == "array" else F.col(column)).alias("value"))
        values = each.select(F.col("value").cast("string").alias("value")).where("value IS NOT NULL")
        out.append(values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(F.lit(title).alias("counter"), "value", "n"))
    return reduce(DataFrame.unionByName, out)


def artifact_counts(tables: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("artifact"), "records") for name, df in sorted(tables.items())))


def percent(value: Column) -> Column:
    """A share as a percentage with one figure after the point; n/a for null."""
    return F.coalesce(F.concat(F.format_string("%.1f", value * 100), F.lit("%")), F.lit("n/a"))


def quality(tables: Tables) -> DataFrame:
    """metric, value: seventeen measures of a run as numbers, shares of 1; null where nothing is to be counted.

    Tables that a run doesn't have count as empty: review_decisions, jobs (source_id, stage, metrics: map of texts),
    claim_repairs, claim_duplicate_members.
    """
    t = tables
    share = lambda df, test, name, of=None: df.agg(_rate(F.count_if(test), F.count(F.lit(1)) if of is None else of).alias(name))
    v, validated, raw = t["validations"], t["claims_validated"], t["claims_raw"]
    says = F.array_contains("errors", "unsupported_entities_introduced") | F.array_contains("warnings", "unsupported_entities_introduced")
    flag = lambda c, name: v.agg(_rate(F.count_if(F.col(f"summary.{c}")), F.count(F.col(f"summary.{c}"))).alias(name))
    n_raw = raw.agg(F.count(F.lit(1)).alias("raw"))
    over_raw = lambda df, name: df.agg(F.count(F.lit(1)).alias("x")).crossJoin(n_raw).select(_rate(F.col("x"), F.col("raw")).alias(name))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    sure = validated.where("support_status = 'accepted_extracted' AND confidence IS NOT NULL").select(F.col("claim_id").alias("a"), F.col("confidence").alias("c"))
    passed = t["claims_normalized"].join(sure, F.col("claim_id") == F.col("a"))
    out = [
        share(validated.where("source_modality <> 'image'"), F.col("validation.evidence_exact_match"), "Accepted text claim exact-evidence rate"), over_raw(t["quarantine"], "Raw claim quarantine rate"), share(v, says, "Unsupported entity validation rate"),
        flag("negation_preserved", "Negation preservation rate"), flag("uncertainty_preserved", "Uncertainty preservation rate"), flag("attribution_preserved", "Attribution preservation rate"), flag("quantities_preserved", "Quantity preservation rate"),
        share(passed, (F.col("confidence") == F.col("c")) & (F.coalesce("confidence_basis", F.lit("")) != ""), "Normalized confidence propagation rate"),
    ]
    if "claim_duplicate_members" in t:
        twice = t["claim_duplicate_members"].groupBy("dedupe_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        again = t["claim_duplicate_members"].join(twice, "dedupe_id", "left_semi").agg(F.count_distinct("claim_id").alias("x"))
        out.append(again.crossJoin(t["claims_normalized"].agg(F.count(F.lit(1)).alias("all"))).select(_rate(F.col("x"), F.col("all")).alias("Duplicate normalized claim rate")))
    if "review_decisions" in t:
        last = t["review_decisions"].groupBy("claim_id", "reviewer_id").agg(F.max_by("decision", F.struct("reviewed_at", "review_id")).alias("d"))
        several = last.groupBy("claim_id").agg(F.count(F.lit(1)).alias("k"), F.count_distinct("d").alias("different")).where("k >= 2")
        out.append(share(several, F.col("different") > 1, "Review disagreement rate"))
    if "claim_repairs" in t:
        out += [over_raw(t["claim_repairs"], "Evidence repair suggestion rate"), count(t["claim_repairs"], "Evidence repair suggestions")]
    if "jobs" in t:
        out += job_measures(t["jobs"], validated)
    out += [count(validated, "Accepted claims"), count(t["quarantine"], "Quarantined claims")]
    return reduce(DataFrame.unionByName, map(_long, out))


COSTS, SECONDS = ("cost_usd", "model_cost_usd", "total_cost_usd"), ("latency_seconds", "duration_seconds", "elapsed_seconds", "runtime_seconds")


def job_measures(jobs: DataFrame, accepted: DataFrame) -> list[DataFrame]:
    """Cost of an accepted claim, seconds of a source, share of repairs that were applied: one row each."""
    number = lambda k: F.col("metrics")[k].try_cast("double")
    total = lambda names: F.sum(F.aggregate(F.filter(F.array(*map(number, names)), lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + x))
    known = lambda names: F.max(reduce(lambda a, b: a | b, (number(k).isNotNull() for k in names)))
    n = accepted.agg(F.count(F.lit(1)).alias("accepted"))
    cost = jobs.agg(F.when(known(COSTS), total(COSTS)).alias("x")).crossJoin(n).select(_rate(F.col("x"), F.col("accepted")).alias("Cost per accepted claim"))
    seconds = jobs.agg(_rate(F.when(known(SECONDS), total(SECONDS)), F.count_distinct(F.nullif("source_id", F.lit("")))).alias("Latency per source"))
    whole = lambda k: F.sum(F.greatest(F.coalesce(number(k), F.lit(0.0)).cast("long"), F.lit(0)))
    repairs = jobs.where("stage = 'apply_repairs'").agg(_rate(whole("repairs_applied"), whole("repairs_applied") + whole("repairs_failed")).alias("Repair application success rate"))
    return [cost, seconds, repairs]


def summary_markdown(tables: Tables, gold: DataFrame | None = None) -> str:
    """The summary of a run: counts, counters and measures under headings. Small tables only come to the driver."""
    lines = ["# Extraction summary", "", "## Artifact counts", "", "| Artifact | Records |", "|---|---|"]
    lines += [f"| {r.artifact} | {r.records} |" for r in artifact_counts(tables).orderBy("artifact").toLocalIterator()]
    found: dict[str, list] = {}
    for r in counters(tables).orderBy("counter", "value").toLocalIterator():
        found.setdefault(r.counter, []).append(r)
    for title, *_ in COUNTERS:
        if title in found:
            lines += ["", f"## {title}", "", "| Value | Count |", "|---|---|", *("| " + r.value.replace("|", "\\|") + f" | {r.n} |" for r in found[title])]
    lines += ["", "## Quality metrics", "", "| Metric | Value |", "|---|---|"]
    rows = quality(tables) if gold is None else quality(tables).unionByName(gold.select(F.concat(F.lit("Gold "), "metric").alias("metric"), "value"))
    text = F.when(F.col("metric").endswith("rate") | F.col("metric").endswith("precision") | F.col("metric").endswith("recall"), percent(F.col("value"))).when(F.col("metric") == "Cost per accepted claim", F.coalesce(F.format_string("$%.4f", "value"), F.lit("n/a"))).when(F.col("metric") == "Latency per source", F.coalesce(F.format_string("%.2fs", "value"), F.lit("n/a"))).otherwise(F.col("value").cast("long").cast("string"))
    return "\n".join([*lines, *(f"| {r.metric} | {r.text} |" for r in rows.select("metric", text.alias("text")).toLocalIterator()), ""])


def as_html(markdown: str) -> str:
    """Headings and tables of Markdown as a page."""
    out, rows = ["<!doctype html><html><head><meta charset='utf-8'></head><body>"], []

    def flush():
        if rows:
            cells = [[html.escape(c.strip().replace("\\|", "|")) for c in r.strip("|").replace("\\|", "\0").split("|")] for r in rows]
            cells = [[c.replace("\0", "|") for c in r] for r in cells]
            out.append("<table><tr>" + "".join(f"<th>{c}</th>" for c in cells[0]) + "</tr>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in cells[2:]) + "</table>")
            rows.clear()

    for line in markdown.split("\n"):
        if line.startswith("|"):
            rows.append(line)
            continue
        flush()
        level = len(line) - len(line.lstrip("#"))
        if level:
            out.append(f"<h{level}>{html.escape(line[level:].strip())}</h{level}>")
        elif line.strip():
            out.append(f"<p>{html.escape(line)}</p>")
    flush()
    return "\n".join([*out, "</body></html>"])


# ---- jobs ---------------------------------------------------------------------------------------------------------


def config_hash(config: dict) -> str:
    """The hash of a configuration, the same for the same values in any order."""
    import hashlib

    return "cfg_" + hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:16]


def job_rows(requests: DataFrame, config: dict, existing: DataFrame | None, now: str) -> DataFrame:
    """Job rows for requests (stage, source_id, input_record_ids, model_id, prompt_id, metrics: map), none twice.

    A job's id comes from its stage, source, sorted inputs, configuration, model and prompt; a job that is in ``existing``
    or is asked for again is left out. A blank stage fails.
    """
    hashed = lambda prefix, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", stable_id(prefix, 16, value=json_string(F.col(c))))
    inputs = F.array_sort(F.array_distinct(F.coalesce("input_record_ids", F.array().cast("array<string>"))))
    stage = F.when(F.trim("stage") != "", F.col("stage")).otherwise(F.raise_error(F.lit("a job needs a stage")).cast("string"))
    r = requests.withColumn("stage", stage).withColumn("input_record_ids", inputs).withColumn("model_hash", hashed("model", "model_id")).withColumn("prompt_hash", hashed("prompt", "prompt_id")).withColumn("config_hash", F.lit(config_hash(config)))
    listed = F.concat(F.lit("["), F.array_join(F.transform("input_record_ids", json_string), ","), F.lit("]"))
    own = stable_id("job", stage=json_string(F.col("stage")), source_id=json_string(F.col("source_id")), input_record_ids=listed, config_hash=json_string(F.col("config_hash")), model_hash=json_string(F.col("model_hash")), prompt_hash=json_string(F.col("prompt_hash")))
    rows = r.withColumn("job_id", own).dropDuplicates(["job_id"])
    if existing is not None:
        rows = rows.join(existing.select("job_id").distinct(), "job_id", "left_anti")
    return rows.select("job_id", "stage", "source_id", "input_record_ids", "config_hash", "model_id", "model_hash", "prompt_id", "prompt_hash", F.lit("succeeded").alias("status"), F.lit(1).alias("attempts"), F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"), "metrics")


def sources_of(*tables: DataFrame) -> DataFrame:
    """The distinct sources that tables name, by source_id or by a list source_ids."""
    parts = [t.select(F.col("source_id").alias("source_id")) for t in tables if "source_id" in t.columns] + [t.select(F.explode("source_ids").alias("source_id")) for t in tables if "source_ids" in t.columns]
    return reduce(DataFrame.unionByName, parts).where("source_id IS NOT NULL").distinct()


# ---- where a claim comes from -------------------------------------------------------------------------------------

#: Tables of a trace whose rows carry the claim's id, and the name that they have in the trace.
BY_CLAIM = {
    "validations": "validations", "review_decisions": "review_decisions", "quarantine": "quarantine", "claims_normalized": "normalized_claims", "claim_graph": "graph_edges", "claim_repairs": "repair_suggestions", "review_queue": "review_queue", "privacy_policy_violations": "privacy_policy_violations",
}


def trace(tables: Tables, claim_ids: list[str]) -> DataFrame:
    """claim_id, part, row (JSON): all that a run knows of some claims, from their source to their propositions.

    Each table is filtered by the claims' own ids, and by those of their span, evidence and source. A claim that is in
    none of the claim tables has the part ``missing``. Rows are in no order.
    """
    t = tables
    asked = t["claims_raw"].sparkSession.createDataFrame([(c,) for c in dict.fromkeys(claim_ids)], "asked string")
    as_row = lambda df, part, claim: df.select(claim.alias("claim_id"), F.lit(part).alias("part"), F.to_json(F.struct(*(c for c in df.columns if c not in ("asked", "__claim")))).alias("row"))
    held = lambda df, test: df.join(F.broadcast(asked), test)  # noqa: E731  the ids that are asked for
    out = []
    anchors = []
    for name, part, rank in (("claims_raw", "raw_claim", 0), ("claims_validated", "validated_claim", 1), ("claims_normalized", None, 2)):
        if name in t:
            own = held(t[name], F.col("claim_id") == F.col("asked"))
            if part:
                out.append(as_row(own, part, F.col("asked")))
            column = lambda c, df=t[name]: (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c)
            anchors.append(own.select("asked", F.lit(rank).alias("rank"), *map(column, ("span_id", "evidence_id", "source_id", "source_modality"))))
    best = reduce(DataFrame.unionByName, anchors).groupBy("asked").agg(F.min_by(F.struct("span_id", "evidence_id", "source_id", "source_modality"), F.col("rank")).alias("an"))
    anchor = best.select(F.col("asked").alias("__claim"), F.col("an.span_id").alias("__span"), F.col("an.evidence_id").alias("__evidence"), F.col("an.source_id").alias("__source"), F.col("an.source_modality").alias("__modality"))
    near = lambda df, test: df.join(F.broadcast(anchor), test)
    plain = lambda df, part: df.select(F.col("__claim").alias("claim_id"), F.lit(part).alias("part"), F.to_json(F.struct(*(c for c in df.columns if not c.startswith("__")))).alias("row"))
    out.append(asked.join(best.select("asked"), "asked", "left_anti").select(F.col("asked").alias("claim_id"), F.lit("missing").alias("part"), F.lit("{}").alias("row")))
    for name, part in BY_CLAIM.items():
        if name in t:
            out.append(as_row(held(t[name], F.col("claim_id") == F.col("asked")), part, F.col("asked")))
    for name, part, on, key in (("sources", "source", "source_id", "__source"), ("evidence", "evidence", "evidence_id", "__evidence"), ("spans", "span", "span_id", "__span"), ("retention_plan", "retention_plan", "source_id", "__source")):
        if name in t:
            out.append(plain(near(t[name], F.col(on) == F.col(key)), part))
    if "spans" in t and "chunks" in t:
        of_span = near(t["spans"].select("span_id", F.col("chunk_id").alias("c")), F.col("span_id") == F.col("__span")).select("__claim", "c")
        out.append(plain(t["chunks"].join(F.broadcast(of_span), F.col("chunk_id") == F.col("c")).drop("c"), "chunk"))
    if "claim_duplicate_members" in t:
        out.append(as_row(held(t["claim_duplicate_members"], F.col("claim_id") == F.col("asked")), "duplicate_groups", F.col("asked")))
    if "model_routing" in t:
        out.append(plain(near(t["model_routing"].dropDuplicates(["routing_id"]), (F.col("record_id") == F.col("__claim")) | (F.col("record_id") == F.col("__span"))), "model_routing"))
    for name in ("pii_findings", "pii_redactions"):
        if name in t:
            f = t[name]
            about = F.coalesce(F.col("claim_id") == F.col("__claim"), F.lit(False)) | F.coalesce(F.col("evidence_id") == F.col("__evidence"), F.lit(False)) | F.coalesce(F.col("record_id").isin(F.col("__claim"), F.col("__span"), F.col("__evidence")), F.lit(False)) | F.coalesce((F.col("source_id") == F.col("__source")) & (F.col("artifact") == "sources"), F.lit(False))
            out.append(plain(near(f, about), name))
    if "audit_events" in t:
        out.append(plain(near(t["audit_events"].dropDuplicates(["audit_event_id"]), F.coalesce(F.col("claim_id") == F.col("__claim"), F.lit(False)) | F.coalesce(F.col("claim_id").isNull() & (F.col("source_id") == F.col("__source")), F.lit(False))), "audit_events"))
    if "jobs" in t:
        has = lambda x: F.array_contains("input_record_ids", x)
        about = has(F.col("__claim")) | F.coalesce(F.col("source_id") == F.col("__source"), F.lit(False)) | ((F.col("stage") == "extract_claims") & (has(F.concat(F.lit("modality:"), F.coalesce("__modality", F.lit("")))) | has("modality:all"))) | ((F.col("stage") == "validate_claims") & has("claims_raw")) | ((F.col("stage") == "normalize_claims") & has("claims_validated")) | ((F.col("stage") == "check_privacy") & has("claims_raw") & has("sources")) | ((F.col("stage") == "retention_plan") & F.col("__source").isNotNull() & has("sources"))
        out.append(plain(near(t["jobs"], F.coalesce(about, F.lit(False))), "jobs"))
    return reduce(DataFrame.unionByName, out)


def trace_json(rows: DataFrame, claim_id: str) -> dict:
    """The trace of one claim as a document: one row or a list of rows a part."""
    single = {"source", "evidence", "chunk", "span", "raw_claim", "validated_claim"}
    out: dict = {"claim_id": claim_id, "found": True}
    for r in rows.where(F.col("claim_id") == claim_id).orderBy("part", "row").toLocalIterator():
        if r.part == "missing":
            out["found"] = False
        elif r.part in single:
            out[r.part] = json.loads(r.row)
        else:
            out.setdefault(r.part, []).append(json.loads(r.row))
    return out


def trace_html(document: dict) -> str:
    parts = "".join(f"<h2>{html.escape(k)}</h2><pre>{html.escape(json.dumps(v, indent=2, ensure_ascii=False, sort_keys=True))}</pre>" for k, v in document.items() if k not in ("claim_id", "found"))
    return f"<!doctype html><html><head><meta charset='utf-8'></head><body><h1>{html.escape(document['claim_id'])}</h1>{parts}</body></html>"
