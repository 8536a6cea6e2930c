"""What the evidence of each kind must say about its origin, and the gates of risky evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the gates.
LEAST_CLUSTER_SIZE, LEAST_COHESION, LEAST_CLUSTER_SOURCES, LEAST_LABEL_CONFIDENCE = 5, 0.75, 3, 0.85


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).rlike("^\\s*$"), F.lit(True))


def _is(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def _join(rules: list[tuple[str, Column]]) -> Column:
    return F.array_join(F.array_compact(F.array(*(F.when(test, code) for code, test in rules))), ",")


def _bad_box(name: str) -> Column:
    b = F.col(name)
    good = (F.size(b) == 4) & (F.get(b, F.lit(0)) >= 0) & (F.get(b, F.lit(1)) >= 0) & (F.get(b, F.lit(2)) > 0) & (F.get(b, F.lit(3)) > 0)
    return ~_is(good)


def provenance_findings(e: DataFrame) -> DataFrame:
    """evidence_id, errors and warnings (codes joined by commas, in the order of the rules) for evidence of any kind.

    ``e`` has one nullable column for each fact of origin; those of other kinds are null. One projection, no shuffle.
    """
    kind, modality = F.col("evidence_type"), F.col("modality")
    chat, pdf, audio = modality == "chat", modality == "pdf", modality == "audio"
    region, cluster, ocr = kind == "visual_region", kind == "visual_cluster", kind == "ocr_text_span"
    start, end, duration = F.col("start"), F.col("end"), F.col("source_duration")
    outside = lambda c: _is(~F.col(c).between(0, 1))
    empty = lambda c: ~_is(F.size(c) > 0)
    errors = [
        ("missing_page_provenance", pdf & ~_is(F.col("page") >= 1)), ("missing_block_provenance", pdf & (F.coalesce("block_id", F.lit("")) == "")),
        ("missing_bbox_provenance", pdf & _is(F.lower("extractor") == "pymupdf") & ~_is(F.size("bbox") == 4)),
        ("missing_conversation_provenance", chat & _blank("conversation_id")), ("missing_message_provenance", chat & _blank("message_id")), ("missing_sender_provenance", chat & _blank("sender_id")),
        ("missing_utterance_provenance", audio & _blank("utterance_id")), ("missing_speaker_provenance", audio & _blank("speaker")),
        ("missing_audio_timestamp_provenance", audio & (start.isNull() | end.isNull())), ("invalid_audio_timestamp_bounds", audio & _is((start < 0) | (end < start)) & start.isNotNull() & end.isNotNull()),
        ("invalid_audio_source_duration_provenance", audio & _is(duration < 0)), ("audio_timestamp_out_of_source_bounds", audio & start.isNotNull() & _is((duration >= 0) & (end > duration))),
        ("invalid_asr_confidence_provenance", audio & outside("asr_confidence")), ("invalid_diarization_confidence_provenance", audio & outside("diarization_confidence")),
        ("missing_image_provenance", (region | ocr) & _blank("image_id")), ("missing_region_provenance", region & _blank("region_id")), ("missing_image_bbox_provenance", (region | ocr) & _bad_box("bbox")),
        ("missing_region_proposal_provenance", region & _blank("proposal_method")), ("missing_feature_cluster_provenance", cluster & _blank("feature_cluster_id")),
        ("missing_embedding_model_provenance", cluster & _blank("embedding_model")), ("missing_clustering_method_provenance", cluster & _blank("clustering_method")), ("missing_cluster_member_provenance", cluster & empty("member_region_ids")),
        ("missing_ocr_model_provenance", ocr & _blank("ocr_model")), ("invalid_ocr_confidence_provenance", ocr & outside("ocr_confidence")),
    ]
    warnings = [
        ("missing_audio_source_duration_provenance", audio & duration.isNull()), ("missing_asr_confidence_provenance", audio & F.col("asr_confidence").isNull()),
        ("missing_diarization_confidence_provenance", audio & F.col("diarization_confidence").isNull()), ("missing_region_crop_provenance", region & _blank("crop_path")),
        ("missing_cluster_representative_provenance", cluster & empty("representative_region_ids")), ("missing_ocr_confidence_provenance", ocr & F.col("ocr_confidence").isNull()),
    ]
    return e.select("evidence_id", _join(errors).alias("errors"), _join(warnings).alias("warnings"))


def image_gate(c: DataFrame) -> DataFrame:
    """claim_id and errors of image claims: labels need confidence or a person's consent, clusters size, cohesion, sources."""
    label, cluster = F.col("claim_type") == "named_visual_classification", F.col("claim_type") == "unnamed_visual_feature_cluster"
    decision, human = F.coalesce("review_decision", F.lit("")), _is(F.col("human_confirmed"))
    unsure = label & ~decision.isin("accept", "reject", "needs_review") & ~human
    return c.select("claim_id", _join([
        ("human_review_rejected_label", label & (decision == "reject")), ("human_review_needs_review", label & (decision == "needs_review")),
        ("image_label_missing_confidence", unsure & F.col("confidence").isNull()), ("image_label_low_confidence", unsure & _is(F.col("confidence") < LEAST_LABEL_CONFIDENCE)),
        ("image_cluster_too_small", cluster & ~_is(F.col("cluster_size") >= LEAST_CLUSTER_SIZE)), ("image_cluster_low_cohesion", cluster & ~_is(F.col("cohesion_score") >= LEAST_COHESION)),
        ("image_cluster_insufficient_cross_source", cluster & ~_is(F.col("source_count") >= LEAST_CLUSTER_SOURCES)),
    ]).alias("errors"))
