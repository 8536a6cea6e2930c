"""Deterministic validation of raw claims against their evidence, spans and reviews: errors, warnings and a summary.

Claims are joined with evidence and spans (left, many to one) and with their latest review; every rule is an expression
over the joined row. Only texts that match their support in another form than exactly go through Python.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.frames import computed
from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id
from claimweft.operators.extraction import with_chunk_texts
from claimweft.operators.provenance import LEAST_CLUSTER_SIZE, LEAST_CLUSTER_SOURCES, LEAST_COHESION, LEAST_LABEL_CONFIDENCE, _bad_box, _blank, _is
from claimweft.operators.repair import FOLDED

VERSION = "deterministic.v9"
# Modalities that keep doubt, provenance that names things, flags that hold back audio claims.
DOUBTFUL = ("uncertain_observation", "reported_uncertain", "hypothetical")
NAMING = ("sender_id", "sender_display_name", "speaker", "image_id", "region_id", "feature_cluster_id", "embedding_model", "clustering_method", "ocr_model")
AUDIO_RISKS = ("low_asr_confidence", "speaker_uncertain", "overlapping_speech")


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """claim_id, review_decision: the decision of the latest review, of several at one time the one with the last id."""
    return reviews.groupBy(F.col("claim_id").alias("reviewed")).agg(F.max_by("decision", F.struct("reviewed_at", "review_id")).alias("review_decision"))


def joined(claims: DataFrame, evidence: DataFrame, spans: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Claims with ev (evidence), sp (span) and review_decision, each null where there is none. Ids are unique in each table."""
    ev = evidence.select(F.col("evidence_id").alias("ev_id"), F.struct(*evidence.columns).alias("ev"))
    sp = spans.select(F.col("span_id").alias("sp_id"), F.struct("span_id", "evidence_id", "text", "risk_flags").alias("sp"))
    j = claims.join(ev, F.col("evidence_id") == F.col("ev_id"), "left").join(sp, F.col("span_id") == F.col("sp_id"), "left").drop("ev_id", "sp_id")
    if reviews is None:
        return j.withColumn("review_decision", F.lit(None).cast("string"))
    last = latest_reviews(reviews)
    return j.join(last, F.col("claim_id") == F.col("reviewed"), "left").drop("reviewed")


def python_text(json: Column) -> Column:
    """The words of a JSON text as they stand in the other notation of a record: None, True and False for null, true, false."""
    t = F.coalesce(json, F.lit(""))
    for a, b in (("null", "None"), ("true", "True"), ("false", "False")):
        t = F.regexp_replace(t, f"(?<=[:\\[,]){a}(?=[,\\]}}])", b)
    return t


def _folded_match():
    """A function: whether a text is in one of its supports once all are in compatibility form with plain quotes and single
    blanks. It carries all it needs, so that workers need no copy of the package."""
    folded = dict(FOLDED)

    @F.pandas_udf("boolean")
    def match(text: pd.Series, supports: pd.Series) -> pd.Series:
        import unicodedata

        def fold(s):
            return " ".join(unicodedata.normalize("NFKC", s).translate(folded).split())

        return pd.Series([t is not None and s is not None and any(fold(t) in fold(x) for x in s) for t, s in zip(text, supports)], dtype=bool)

    return match


def _codes(rules: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*(F.when(_is(test), code) for code, test in rules)))


def checked(j: DataFrame) -> DataFrame:
    """Add flags, errors, warnings and the parts of the summary to ``joined`` rows.

    A rule whose facts are missing does not pass in silence: null claim texts, agents and modalities count as empty.
    """
    p = lambda k: F.col(f"ev.provenance.{k}")
    m, kind = F.coalesce("source_modality", F.lit("")), F.coalesce("ev.evidence_type", F.lit(""))
    there = F.col("ev").isNotNull()
    none = F.array().cast("array<string>")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    j = j.withColumn("flags", F.array_sort(F.array_union(F.array_union(F.coalesce("risk_flags", none), F.coalesce("ev.risk_flags", none)), F.coalesce("sp.risk_flags", none))))
    j = j.withColumn("supports", F.filter(F.array("sp.text", "ev.text", "context_used"), lambda s: s.isNotNull() & (s != "")))
    quote = F.coalesce(F.nullif("evidence_text", F.lit("")), F.element_at(F.when(F.size("supports") > 0, F.col("supports")), 1), F.lit(""))
    said = F.concat_ws(" ", "source_faithful_claim", "modality", F.nullif("subject", F.lit("")), F.nullif("predicate", F.lit("")), python_text(F.col("object")), python_text(F.when(F.col("attributes") != "{}", F.col("attributes"))))
    j = j.withColumn("quote", quote).withColumn("said", said)
    exact_needed = (m != "image") | (kind == "ocr_text_span")
    exact = F.exists("supports", lambda s: F.contains(s, text("evidence_text")))
    j = j.withColumn("exact_match", F.when(exact_needed, (text("evidence_text") != "") & exact))
    doubtful = exact_needed & (text("evidence_text") != "") & ~F.col("exact_match")
    j = j.withColumn("folded", F.coalesce(_folded_match()(F.when(doubtful, F.col("evidence_text")), F.when(doubtful, F.col("supports"))), F.lit(False)))
    j = j.withColumn("quote_q", T.quantities(F.col("quote"))).withColumn("said_q", T.quantities(F.col("said")))
    allowed = F.filter(F.array(F.col("attribution.agent"), *map(p, NAMING)), lambda s: s.isNotNull())
    known = F.flatten(F.transform(F.concat("supports", allowed), T.entities))
    j = j.withColumn("introduced", F.array_sort(F.array_except(T.entities(F.col("said")), known)))
    agents = F.filter(F.array(p("sender_id"), p("sender_display_name"), p("speaker")), lambda s: s.isNotNull())
    speech = m.isin("chat", "audio")
    not_speaker = speech & (F.coalesce("attribution.type", F.lit("")) != "speaker")
    wrong_agent = speech & ~not_speaker & there & (F.size(agents) > 0) & ~F.coalesce(F.array_contains(agents, F.coalesce("attribution.agent", F.lit(""))), F.lit(False))
    not_document = (m == "pdf") & ~F.coalesce("attribution.type", F.lit("")).isin("document", "speaker")
    not_model = (m == "image") & ~F.coalesce("attribution.type", F.lit("")).isin("model", "human_reviewer")
    pdf, chat, audio, image = ((m == x) & there for x in ("pdf", "chat", "audio", "image"))
    region, cluster, ocr = (image & (kind == x) for x in ("visual_region", "visual_cluster", "ocr_text_span"))
    blank = lambda k: _blank(f"ev.provenance.{k}")
    outside = lambda k: ~p(k).between(0, 1)
    start, end, duration = p("start"), p("end"), p("source_duration")
    has = lambda flag: F.array_contains("flags", flag)
    leans = speech & has("context_dependent_coreference")
    label, group = (m == "image") & (F.col("claim_type") == "named_visual_classification"), (m == "image") & (F.col("claim_type") == "unnamed_visual_feature_cluster")
    attributes = F.try_parse_json(text("attributes"))
    confirmed = (F.col("truth_status") == "human_confirmed") | (F.col("attribution.type") == "human_reviewer") | _is(F.try_variant_get(attributes, "$.human_confirmed", "boolean")) | _is(F.try_variant_get(attributes, "$.human_reviewed", "boolean"))
    j = j.withColumn("human_confirmed", _is(F.col("review_decision") == "accept") | _is(confirmed))
    open_label = label & ~_is(F.col("review_decision").isin("reject", "needs_review")) & ~F.col("human_confirmed")
    label_confidence = F.coalesce(F.try_variant_get(attributes, "$.classifier.confidence", "double"), "confidence")
    size = F.coalesce(p("cluster_size"), F.size("object_members"))
    size = F.when(size >= 0, size)
    cohesion = F.coalesce(p("cohesion_score"), F.try_variant_get(attributes, "$.cohesion_score", "double"))
    sources = F.when(p("source_ids").isNotNull(), F.size(F.array_distinct(p("source_ids"))))
    lost_negation = T.has_word(F.col("quote"), T.NEGATION) & ~T.has_word(F.col("said"), T.NEGATION) & ~_is(F.col("modality") == "negated")
    lost_doubt = T.has_word(F.col("quote"), T.UNCERTAINTY) & ~T.has_word(F.col("said"), T.UNCERTAINTY) & ~_is(F.col("modality").isin(*DOUBTFUL))
    other_quantity = (F.size("quote_q") > 0) & ((F.size("said_q") == 0) | (F.size(F.array_except("said_q", "quote_q")) > 0))
    # fixed values: the codes, in the order of the rules
    errors = [
        ("missing_evidence", ~there), ("source_id_mismatch", there & ~F.col("source_id").eqNullSafe(F.col("ev.source_id"))),
        ("missing_span", (text("span_id") != "") & F.col("sp").isNull()), ("span_evidence_mismatch", F.col("sp").isNotNull() & ~F.col("sp.evidence_id").eqNullSafe(F.col("evidence_id"))),
        ("missing_evidence_text", exact_needed & (text("evidence_text") == "")), ("evidence_not_exact_substring", doubtful),
        ("attribution_not_speaker", not_speaker), ("attribution_agent_mismatch", wrong_agent), ("attribution_not_document", not_document), ("attribution_not_model_or_reviewer", not_model),
        ("missing_page_provenance", pdf & ~_is(p("page") >= 1)), ("missing_block_provenance", pdf & (F.coalesce(p("block_id"), F.lit("")) == "")), ("missing_bbox_provenance", pdf & _is(F.lower(p("extractor")) == "pymupdf") & ~_is(F.size(p("bbox")) == 4)),
        ("missing_conversation_provenance", chat & blank("conversation_id")), ("missing_message_provenance", chat & blank("message_id")), ("missing_sender_provenance", chat & blank("sender_id")),
        ("missing_utterance_provenance", audio & blank("utterance_id")), ("missing_speaker_provenance", audio & blank("speaker")),
        ("missing_audio_timestamp_provenance", audio & (start.isNull() | end.isNull())), ("invalid_audio_timestamp_bounds", audio & ((start < 0) | (end < start))),
        ("invalid_audio_source_duration_provenance", audio & (duration < 0)), ("audio_timestamp_out_of_source_bounds", audio & start.isNotNull() & (duration >= 0) & (end > duration)),
        ("invalid_asr_confidence_provenance", audio & outside("asr_confidence")), ("invalid_diarization_confidence_provenance", audio & outside("diarization_confidence")),
        ("missing_image_provenance", (region | ocr) & blank("image_id")), ("missing_region_provenance", region & blank("region_id")), ("missing_image_bbox_provenance", (region | ocr) & _bad_box("ev.provenance.bbox")),
        ("missing_region_proposal_provenance", region & blank("proposal_method")), ("missing_feature_cluster_provenance", cluster & blank("feature_cluster_id")), ("missing_embedding_model_provenance", cluster & blank("embedding_model")),
        ("missing_clustering_method_provenance", cluster & blank("clustering_method")), ("missing_cluster_member_provenance", cluster & ~_is(F.size(p("member_region_ids")) > 0)),
        ("missing_ocr_model_provenance", ocr & blank("ocr_model")), ("invalid_ocr_confidence_provenance", ocr & outside("ocr_confidence")),
        ("context_dependency_not_flagged", leans & ~F.coalesce("context_dependent", F.lit(False))), ("missing_context_used", leans & (text("context_used") == "")),
        *((flag, (m == "audio") & has(flag)) for flag in AUDIO_RISKS),
        ("image_cluster_too_small", group & ~_is(size >= LEAST_CLUSTER_SIZE)), ("image_cluster_low_cohesion", group & ~_is(cohesion >= LEAST_COHESION)), ("image_cluster_insufficient_cross_source", group & ~_is(sources >= LEAST_CLUSTER_SOURCES)),
        ("human_review_rejected_label", label & (F.col("review_decision") == "reject")), ("human_review_needs_review", label & (F.col("review_decision") == "needs_review")),
        ("image_label_missing_confidence", open_label & label_confidence.isNull()), ("image_label_low_confidence", open_label & (label_confidence < LEAST_LABEL_CONFIDENCE)),
        ("low_ocr_confidence", (kind == "ocr_text_span") & has("low_ocr_confidence")),
        ("negation_dropped", lost_negation), ("uncertainty_dropped", lost_doubt), ("quantity_mismatch", other_quantity), ("unsupported_entities_introduced", exact_needed & (F.size("introduced") > 0)),
    ]
    warnings = [
        ("evidence_matches_after_normalization", doubtful & F.col("folded")),
        ("missing_audio_source_duration_provenance", audio & duration.isNull()), ("missing_asr_confidence_provenance", audio & p("asr_confidence").isNull()), ("missing_diarization_confidence_provenance", audio & p("diarization_confidence").isNull()),
        ("missing_region_crop_provenance", region & blank("crop_path")), ("missing_cluster_representative_provenance", cluster & ~_is(F.size(p("representative_region_ids")) > 0)), ("missing_ocr_confidence_provenance", ocr & p("ocr_confidence").isNull()),
        ("unsupported_entities_introduced", F.size("introduced") > 0),
    ]
    j = computed(j, errors=_codes(errors), warnings=_codes(warnings))  # else a filter by status computes every rule again
    wrong = lambda *codes: F.arrays_overlap("errors", F.array(*map(F.lit, codes)))
    summary = F.struct(
        (F.size("errors") == 0).alias("deterministic_valid"), F.col("exact_match").alias("evidence_exact_match"), (~wrong("negation_dropped")).alias("negation_preserved"), (~wrong("uncertainty_dropped")).alias("uncertainty_preserved"),
        (~wrong("attribution_not_speaker", "attribution_agent_mismatch", "attribution_not_document", "attribution_not_model_or_reviewer")).alias("attribution_preserved"), (~wrong("quantity_mismatch")).alias("quantities_preserved"),
        F.col("introduced").alias("introduced_entities"), F.col("confidence").alias("claim_confidence"), F.lit("raw_claim_confidence").alias("confidence_basis"), F.lit(VERSION).alias("validator_version"))
    return j.withColumn("summary", summary).drop("supports", "quote", "said", "folded", "quote_q", "said_q", "introduced", "exact_match")


def validate(claims: DataFrame, evidence: DataFrame, spans: DataFrame, reviews: DataFrame | None = None, validations: DataFrame | None = None, chunks: DataFrame | None = None) -> DataFrame:
    """A row a claim that has no validation of this version yet: the claim, validation_id, status, errors, warnings, summary,
    flags and human_confirmed. Errors and warnings are arrays in the order of the rules; repeated claims are judged alike.

    With ``chunks``, context_used of a claim is a chunk's id; the text takes its place after all other joins, which so
    shuffle no text of a chunk, and the id is kept as context_chunk.
    """
    own = stable_id("val", claim_id=json_string(F.col("claim_id")), validator=json_string(F.lit(VERSION)))
    todo = claims.withColumn("validation_id", own)
    if validations is not None:
        todo = todo.join(validations.select("validation_id").distinct(), "validation_id", "left_anti")
    j = joined(todo, evidence, spans, reviews)
    out = checked(j if chunks is None else with_chunk_texts(j, chunks)).drop("ev", "sp")
    return out.withColumn("status", F.when(F.size("errors") == 0, "accepted_extracted").otherwise("quarantined"))


def validations(v: DataFrame) -> DataFrame:
    """The log of a run, a row a claim."""
    return v.select("validation_id", "claim_id", F.col("claim_id").alias("record_id"), F.lit("validate_claims").alias("stage"), "status", "errors", "warnings", F.lit(VERSION).alias("validator_version"), "source_modality", "summary")


def validated_claims(v: DataFrame) -> DataFrame:
    """Accepted claims. A label that a person confirmed is human_confirmed."""
    a = v.where("status = 'accepted_extracted'")
    truth = F.when((F.col("source_modality") == "image") & (F.col("claim_type") == "named_visual_classification") & F.col("human_confirmed"), "human_confirmed").otherwise(F.col("truth_status"))
    return a.select("claim_id", "source_id", "source_modality", "span_id", "evidence_id", "source_faithful_claim", "evidence_text", F.struct("subject", "predicate", "object", "quantity", "attributes").alias("normalized_claim"), "modality", truth.alias("truth_status"), "confidence", F.lit("accepted_extracted").alias("support_status"), F.col("summary").alias("validation"), F.col("flags").alias("risk_flags"))


def quarantine(v: DataFrame) -> DataFrame:
    """Claims that are held back, with reasons and the claim as JSON."""
    q = v.where("status = 'quarantined'")
    own = stable_id("q", claim_id=json_string(F.col("claim_id")), validator=json_string(F.lit(VERSION)))
    payload = F.to_json(F.struct(*sorted(c for c in v.columns if c not in ("validation_id", "status", "errors", "warnings", "summary", "flags", "human_confirmed", "review_decision"))))
    return q.select(own.alias("quarantine_id"), F.lit("claim").alias("record_type"), F.col("claim_id").alias("record_id"), "source_id", "evidence_id", "claim_id", F.lit("validate_claims").alias("stage"), F.col("errors").alias("reason_codes"), "warnings", payload.alias("payload"), "evidence_text")
