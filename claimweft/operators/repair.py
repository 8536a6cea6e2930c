"""Repairs: support text for evidence that differs only in form, and loose claims brought into the claims' columns."""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id

# Typographic marks and what they count as.
FOLDED = str.maketrans({"\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"', "\u2013": "-", "\u2014": "-"})


def _fold(s: str) -> str:
    return unicodedata.normalize("NFKC", s).translate(FOLDED)


def repaired_text(original: str, support: str) -> str | None:
    """The passage of ``support`` that equals ``original`` but for compatibility forms, quotes, dashes and white space.

    Whole support first, then one of its sentences, then any slice; None if there is none or nothing to repair.
    """
    words = _fold(original).split()
    if not words or original in support:
        return None
    if _fold(support).split() == words:
        return support
    for sentence in re.findall(r"[^.!?\n]+(?:[.!?]+|$)", support):
        if _fold(sentence).split() == words:
            return sentence.strip()
    chars = [(f, i) for i, c in enumerate(support) for f in _fold(c)]
    found = re.search(r"\s+".join(map(re.escape, words)), "".join(f for f, _ in chars))
    return support[chars[found.start()][1] : chars[found.end() - 1][1] + 1] if found else None


def suggest_repairs(claims: DataFrame) -> DataFrame:
    """claim_id, original, suggestion, scope for claims with evidence_text, span_text and evidence.

    Native filters leave only claims whose text is not exact; those alone go through Python, in Arrow batches.
    """
    inexact = claims.where((F.col("evidence_text") != "") & ~(F.coalesce(F.contains("span_text", "evidence_text"), F.lit(False)) & F.coalesce(F.contains("evidence", "evidence_text"), F.lit(False))))

    def run(batches):
        for pdf in batches:
            out = []
            for claim, original, span, evidence in pdf.itertuples(index=False):
                for scope, support in (("span", span), ("evidence", evidence)):
                    if support and (fixed := repaired_text(original, support)) is not None:
                        out.append((claim, original, fixed, scope))
                        break
            yield pd.DataFrame(out, columns=["claim_id", "original", "suggestion", "scope"])

    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package
    return inexact.select("claim_id", "evidence_text", "span_text", "evidence").mapInPandas(run, "claim_id string, original string, suggestion string, scope string")


def apply_repairs(suggestions: DataFrame, claims: DataFrame, existing: DataFrame) -> DataFrame:
    """Outcome of each suggestion and, where it is created, the id and text of the new claim.

    failed: the claim is missing, its text has changed, or the suggestion is in no support text; skipped: the repaired
    claim is among ``existing`` (claim_id) already. The repaired claim has an id of its own and goes to validation anew.
    """
    s = suggestions.select("claim_id", "original", "suggestion", "scope").dropDuplicates()
    repair_id = stable_id("repair", claim_id=json_string(F.col("claim_id")), original_evidence_text=json_string(F.col("original")), suggested_evidence_text=json_string(F.col("suggestion")))
    s = s.withColumn("repair_id", repair_id)
    s = s.withColumn("new_claim_id", stable_id("claim_repair", claim_id=json_string(F.col("claim_id")), repair_id=json_string(F.col("repair_id")), suggested_evidence_text=json_string(F.col("suggestion"))))
    c = claims.select("claim_id", F.col("evidence_text").alias("now"), "span_text", "evidence", F.lit(True).alias("found"))
    j = s.join(c, "claim_id", "left").join(existing.select(F.col("claim_id").alias("new_claim_id"), F.lit(True).alias("there")).distinct(), "new_claim_id", "left")
    exact = F.coalesce(F.contains("span_text", "suggestion"), F.lit(False)) | F.coalesce(F.contains("evidence", "suggestion"), F.lit(False))
    reason = F.when(F.col("found").isNull(), "missing_claim").when(~F.col("now").eqNullSafe(F.col("original")), "claim_evidence_text_changed").when(~exact, "suggested_text_not_exact_support").when(F.col("there"), "repaired_claim_exists")
    outcome = F.when(reason.isNull(), "created").when(reason == "repaired_claim_exists", "skipped").otherwise("failed")
    return j.select("claim_id", "repair_id", "new_claim_id", outcome.alias("outcome"), F.coalesce(reason, F.lit("")).alias("reason"), F.when(outcome == "created", F.col("suggestion")).alias("evidence_text"))


def import_claims(payloads: DataFrame) -> DataFrame:
    """Loose claims (one JSON object a row, column payload) with aliases renamed, types coerced, ids made, and a status.

    Status is schema_valid, repaired or schema_invalid (no object, or a required field missing or out of range).
    """
    v = F.try_parse_json("payload")
    text = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    kind = lambda k: F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")), F.lit("VOID"))
    claim = F.coalesce(*(text(k) for k in ("source_faithful_claim", "claim", "claim_text", "text")))
    support = F.coalesce(*(text(k) for k in ("evidence_text", "evidence", "supporting_text")))
    agent = F.when(kind("attribution") == "STRING", text("attribution")).otherwise(text("attribution.agent"))
    speaks = F.when(text("source_modality").isin("chat", "audio"), "speaker").when(text("source_modality") == "pdf", "document").when(text("source_modality") == "image", "model").otherwise("unknown")
    raw = F.regexp_replace(T.strip(text("confidence")), "%+$", "").try_cast("double")
    confidence = F.when((raw > 1) & (raw <= 100), raw / 100).otherwise(raw)
    renamed = lambda name, aliases: F.when(text(name).isNull(), F.coalesce(*(F.when(text(a).isNotNull(), F.lit(f"rename_{a}_to_{name}")) for a in aliases)))
    made = text("claim_id").isNull() & text("source_id").isNotNull() & text("evidence_id").isNotNull() & claim.isNotNull()
    own = stable_id("claim_import", source_id=json_string(text("source_id")), evidence_id=json_string(text("evidence_id")), source_faithful_claim=json_string(claim))
    actions = F.array_join(F.array_compact(F.array(
        renamed("source_faithful_claim", ("claim", "claim_text", "text")), renamed("evidence_text", ("evidence", "supporting_text")), F.when(kind("attribution") == "STRING", "coerce_attribution_string"),
        F.when((kind("confidence") == "STRING") & raw.isNotNull(), "coerce_confidence_number"), F.when((raw > 1) & (raw <= 100), "scale_confidence_percent"),
        F.when(kind("risk_flags") == "STRING", "coerce_risk_flags_string"), F.when(made, "generate_claim_id"))), ",")
    lacking = text("source_id").isNull() | text("evidence_id").isNull() | claim.isNull() | agent.isNull() | ~F.coalesce(confidence.between(0, 1), F.lit(True)) | ((text("source_modality") != "image") & (F.coalesce(support, F.lit("")) == ""))
    return payloads.select(
        "line", F.when(made, own).otherwise(text("claim_id")).alias("claim_id"), claim.alias("claim_text"), support.alias("evidence_text"), F.when(kind("attribution") == "STRING", speaks).otherwise(text("attribution.type")).alias("attribution_type"),
        agent.alias("agent"), confidence.alias("confidence"), actions.alias("actions"), F.when(F.coalesce(lacking, F.lit(True)), "schema_invalid").when(actions != "", "repaired").otherwise("schema_valid").alias("status"))
