"""Evidence of every kind in one table: source, kind, text, where it comes from, risk flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.functions.ids import json_string, stable_id

#: Facts of origin; those of other kinds of evidence are null.
PROVENANCE = {
    "conversation_id": "string", "thread_id": "string", "message_id": "string", "sender_id": "string", "sender_display_name": "string", "sender_role": "string", "timestamp": "string", "char_start": "int", "char_end": "int",
    "page": "int", "block_id": "string", "block_no": "int", "bbox": "array<double>", "section_path": "array<string>", "extractor": "string",
    "utterance_id": "string", "speaker": "string", "start": "double", "end": "double", "source_duration": "double", "asr_confidence": "double", "diarization_confidence": "double",
    "image_id": "string", "region_id": "string", "crop_path": "string", "mask_path": "string", "proposal_method": "string", "proposal_score": "double",
    "feature_cluster_id": "string", "embedding_model": "string", "clustering_method": "string", "member_region_ids": "array<string>", "representative_region_ids": "array<string>", "representative_crop_paths": "array<string>",
    "representative_bboxes": "array<array<double>>", "cluster_size": "int", "cohesion_score": "double", "nearest_neighbor_margin": "double", "source_ids": "array<string>", "ocr_model": "string", "ocr_confidence": "double",
}
TEXT_TYPES = ("text_span", "utterance_span", "message_span", "ocr_text_span")


def provenance(**known: Column) -> Column:
    return F.struct(*(known.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in PROVENANCE.items()))


def _rows(df: DataFrame, own: Column, modality: str, kind: str, text: Column, origin: Column, source: Column | None = None) -> DataFrame:
    flags = F.coalesce(F.col("risk_flags"), F.array().cast("array<string>"))
    return df.select(own.alias("evidence_id"), (F.col("source_id") if source is None else source).alias("source_id"), F.lit(modality).alias("source_modality"), F.lit(kind).alias("evidence_type"), text.alias("text"), origin.alias("provenance"), flags.alias("risk_flags"))


def _same(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def of_messages(messages: DataFrame) -> DataFrame:
    origin = provenance(**_same("conversation_id", "thread_id", "message_id", "sender_id", "sender_display_name", "sender_role", "timestamp"), char_start=F.lit(0), char_end=F.length("text"))
    return _rows(messages, stable_id("ev_msg", source_id=json_string(F.col("source_id")), message_id=json_string(F.col("message_id"))), "chat", "message_span", F.col("text"), origin)


def of_blocks(blocks: DataFrame) -> DataFrame:
    """Headers and footers are no evidence."""
    own = stable_id("ev_pdf", source_id=json_string(F.col("source_id")), block_id=json_string(F.col("block_id")))
    origin = provenance(**_same("page", "block_id", "block_no", "bbox", "char_start", "char_end", "section_path", "extractor"))
    return _rows(blocks.where(~F.col("block_type").isin("header", "footer")), own, "pdf", "text_span", F.col("text"), origin)


def of_utterances(utterances: DataFrame) -> DataFrame:
    """With the source's duration, which is its last end and no less than 0."""
    ends = utterances.groupBy(F.col("source_id").alias("s")).agg(F.greatest(F.max("end"), F.lit(0.0)).alias("source_duration"))
    own = stable_id("ev_audio", source_id=json_string(F.col("source_id")), utterance_id=json_string(F.col("utterance_id")))
    origin = provenance(**_same("utterance_id", "speaker", "start", "end", "source_duration", "asr_confidence", "diarization_confidence"))
    return _rows(utterances.join(ends, F.col("source_id") == F.col("s")), own, "audio", "utterance_span", F.col("text"), origin)


def of_regions(regions: DataFrame) -> DataFrame:
    own = stable_id("ev_img", source_id=json_string(F.col("source_id")), region_id=json_string(F.col("region_id")))
    origin = provenance(**_same("image_id", "region_id", "bbox", "crop_path", "mask_path", "proposal_method", "proposal_score"))
    return _rows(regions, own, "image", "visual_region", F.lit(None).cast("string"), origin)


def of_ocr(texts: DataFrame) -> DataFrame:
    """Of texts read several times at one place by one model, the most certain reading counts."""
    box = F.when(F.col("bbox").isNull(), "null").otherwise(F.concat(F.lit("["), F.array_join(F.col("bbox").cast("array<string>"), ","), F.lit("]")))
    own = stable_id("ev_ocr", source_id=json_string(F.col("source_id")), image_id=json_string(F.col("image_id")), bbox=box, text=json_string(F.col("text")), ocr_model=json_string(F.col("ocr_model")))
    rows = _rows(texts, own, "image", "ocr_text_span", F.col("text"), provenance(**_same("image_id", "bbox", "ocr_model", "ocr_confidence")))
    rest = [c for c in rows.columns if c != "evidence_id"]
    return rows.groupBy("evidence_id").agg(F.max_by(F.struct(*rest), F.coalesce("provenance.ocr_confidence", F.lit(-1.0))).alias("r")).select("evidence_id", "r.*")


def of_clusters(clusters: DataFrame, regions: DataFrame) -> DataFrame:
    """With crops and boxes of the representatives, in their order; a cluster without sources is a source of its own."""
    r = regions.select(F.col("region_id").alias("r"), F.col("crop_path").alias("r_crop"), F.col("bbox").cast("array<double>").alias("r_box"))
    named = clusters.select("feature_cluster_id", F.posexplode("representative_region_ids").alias("pos", "rep")).join(r, F.col("rep") == F.col("r"))
    seen = named.groupBy(F.col("feature_cluster_id").alias("c")).agg(F.array_sort(F.collect_list(F.struct("pos", "r_crop", "r_box"))).alias("reps"))  # two a cluster
    j = clusters.join(seen, F.col("feature_cluster_id") == F.col("c"), "left").withColumn("reps", F.coalesce("reps", F.array().cast("array<struct<pos:int,r_crop:string,r_box:array<double>>>")))
    sources = F.when(F.size("source_ids") > 0, F.col("source_ids")).otherwise(F.array("feature_cluster_id"))
    origin = provenance(
        **_same("feature_cluster_id", "embedding_model", "clustering_method", "member_region_ids", "representative_region_ids", "cluster_size", "cohesion_score", "nearest_neighbor_margin"), source_ids=sources,
        representative_crop_paths=F.filter(F.transform("reps", lambda x: x["r_crop"]), lambda x: x.isNotNull() & (x != "")), representative_bboxes=F.transform("reps", lambda x: x["r_box"]))
    return _rows(j, stable_id("ev_vf", feature_cluster_id=json_string(F.col("feature_cluster_id"))), "image", "visual_cluster", F.lit(None).cast("string"), origin, F.element_at(sources, 1))
