"""Deterministic validation of claims against their evidence, quarantine, normalisation, duplicates, graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id


def validate(c: DataFrame) -> DataFrame:
    """Add errors (codes joined by commas, in the order of the rules) and status. One projection, no shuffle.

    For chat claims that carry their evidence; ``validator`` joins all modalities. Null claim texts and agents don't pass.
    """
    c = c.withColumn("claim_q", T.quantities(F.coalesce("claim_text", F.lit("")))).withColumn("evidence_q", T.quantities(F.col("evidence_text")))
    support = F.array_union(T.entities(F.col("evidence")), F.array_union(T.entities(F.col("evidence_text")), T.entities(F.coalesce("context_used", F.lit("")))))
    new = F.array_except(T.entities(F.regexp_replace("claim_text", "^The speaker (asked|asserted): ", "")), F.array_union(support, F.array(F.coalesce("agent", F.lit("")))))
    supported = F.contains("evidence", F.col("evidence_text")) | F.contains(F.coalesce("context_used", F.lit("")), F.col("evidence_text"))
    rules = [  # fixed values: the codes, in the order of the rules
        ("missing_evidence", F.col("evidence").isNull()), ("missing_evidence_text", F.coalesce("evidence_text", F.lit("")) == ""), ("evidence_not_exact_substring", ~supported),
        ("missing_claim_text", F.col("claim_text").isNull()), ("attribution_agent_mismatch", ~F.coalesce(F.col("agent") == F.col("sender_id"), F.lit(False))),
        ("negation_dropped", T.has_word(F.col("evidence_text"), T.NEGATION) & ~T.has_word(F.coalesce("claim_text", F.lit("")), T.NEGATION)),
        ("uncertainty_dropped", T.has_word(F.col("evidence_text"), T.UNCERTAINTY) & ~T.has_word(F.coalesce("claim_text", F.lit("")), T.UNCERTAINTY)),
        ("quantity_mismatch", (F.size("evidence_q") > 0) & ((F.size("claim_q") == 0) | (F.size(F.array_except("claim_q", "evidence_q")) > 0))),
        ("unsupported_entities_introduced", F.size(new) > 0),
    ]
    errors = F.array_join(F.array_compact(F.array(*(F.when(test, code) for code, test in rules))), ",")
    return c.withColumn("errors", errors).withColumn("status", F.when(F.col("errors") == "", "accepted_extracted").otherwise("quarantined")).drop("claim_q", "evidence_q")


def quarantine_reasons(v: DataFrame) -> DataFrame:
    return v.where("status = 'quarantined'").select(F.explode(F.split("errors", ",")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("claims"))


def predicate(modality):
    # fixed values: the predicate of each modality
    by = {"asserted": "asserts", "direct_observation": "reports_observation", "uncertain_observation": "asserts_uncertain", "reported": "reports", "reported_direct_observation": "reports_observation", "reported_uncertain": "asserts_uncertain", "negated": "negates", "hypothetical": "asks_whether", "question_asked": "asks_whether", "model_observation": "model_observation"}
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in by.items() for x in kv)), modality), F.lit("asserts"))


def normalize(v: DataFrame) -> DataFrame:
    """Accepted claims as propositions."""
    a = v.where("status = 'accepted_extracted'")
    return a.select(
        stable_id("nclaim", claim_id=json_string(F.col("claim_id")), normalizer=F.lit('"v1"')).alias("normalized_claim_id"), "claim_id", "source_id", "evidence_id",
        T.canonical_id(F.lit("speaker"), F.col("agent")).alias("subject"), predicate(F.col("modality")).alias("predicate"), F.col("evidence_text").alias("object"), "modality", "truth_status", "confidence",
    )


def duplicate_groups(n: DataFrame, singletons: bool = False) -> DataFrame:
    """Claims with one subject, predicate, object, modality and truth status. Aggregated on the map side."""
    g = n.groupBy("subject", "predicate", "object", "modality", "truth_status").agg(
        F.count(F.lit(1)).alias("members"), F.count_distinct("source_id").alias("source_count"), F.count_distinct("evidence_id").alias("evidence_count"), F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"))
    level = F.when(F.col("members") == 1, "singleton").when(F.col("source_count") > 1, "cross_source_corroboration_candidate").when(F.col("evidence_count") > 1, "same_source_distinct_evidence").otherwise("same_evidence_duplicate")
    g = g.withColumn("duplicate_level", level)
    return g if singletons else g.where("members > 1")


def edges(n: DataFrame) -> DataFrame:
    return n.select(stable_id("edge", normalized_claim_id=json_string(F.col("normalized_claim_id")), subject=json_string(F.col("subject")), predicate=json_string(F.col("predicate"))).alias("edge_id"), "normalized_claim_id", "subject", "predicate", "object", "modality", "confidence")


def atom(column):
    """A JSON string literal that leaves everything beyond ASCII as it is."""
    quoted = F.to_json(F.struct(F.coalesce(column, F.lit("")).alias("c")))
    return F.substring(quoted, 6, F.length(quoted) - 6)


def metta(n: DataFrame) -> DataFrame:
    """S-expressions of the normalized claims: the claim with its qualifiers, then modality, truth status and confidence."""
    q = lambda c: atom(F.col(c))
    expression = lambda name, *atoms: F.concat_ws(" ", F.lit("(" + name), *atoms, F.lit(")"))
    id_ = q("normalized_claim_id")
    qualifiers = atom(F.concat(F.lit('{"modality":'), q("modality"), F.lit(',"truth_status":'), q("truth_status"), F.lit("}")))
    number = F.regexp_replace(F.round("confidence", 6).cast("string"), "\\.0$", "")
    lines = F.array_compact(F.array(
        expression("claim", id_, *map(q, ("claim_id", "source_id", "evidence_id", "subject", "predicate", "object")), qualifiers), expression("claim-modality", id_, q("modality")),
        expression("claim-truth-status", id_, q("truth_status")), F.when(F.col("confidence").isNotNull(), expression("claim-confidence", id_, number))))
    return n.select(F.explode(lines).alias("line"))


def route(spans: DataFrame, below: float = 0.6, flags: tuple[str, ...] = ("context_dependent_coreference",)) -> DataFrame:
    low = F.when(F.col("score") < below, f"span_score_lt:{below}")
    hit = F.transform(F.filter(F.split("risk_flags", ","), lambda f: f.isin(*flags)), lambda f: F.concat(F.lit("risk_flag:"), f))
    reasons = F.array_join(F.concat(F.array_compact(F.array(low)), hit), ",")
    return spans.select("span_id", "score", reasons.alias("reasons")).withColumn("tier", F.when(F.col("reasons") == "", "default").otherwise("strong"))
