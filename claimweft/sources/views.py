"""Domain tables made from the generated tables: messages, blocks, utterances, vectors, sources, reviews, jobs, gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = (" The lift was not moved.", " It may be 14 meters high.", " Was Lund on board?", "", " Lund had three ropes.", " Call 415-555-0187 or mail jo.lund@example.org.")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chat_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with a suffix by id, so that questions, negation, doubt and personal data occur."""
    pick = F.element_at(F.array(*map(F.lit, SUFFIXES)), (F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(len(SUFFIXES))) + 1).cast("int"))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.concat("text", pick).alias("text"))


def pdf_blocks(spark: SparkSession, sf_dir: str, per_page: int = 5) -> DataFrame:
    """Lines of documents that are not blank, ``per_page`` to a page."""
    docs = load(spark, sf_dir, "documents")
    lines = docs.select(F.col("doc_id").alias("source_id"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
    return lines.where(F.col("text").rlike("\\S")).select("source_id", (F.floor(F.col("pos") / per_page) + 1).cast("int").alias("page"), (F.col("pos") % per_page).cast("int").alias("block_no"), "text")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    start = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) / F.lit(1e6)
    return e.select(
        F.concat(F.lit("src_"), (F.col("user_id") % 100).cast("string")).alias("source_id"), F.concat(F.lit("utt_"), F.col("event_id").cast("string")).alias("utterance_id"), F.col("user_id").cast("string").alias("speaker"),
        start.alias("start"), (start + F.greatest(F.coalesce("value", F.lit(0.0)), F.lit(0.0))).alias("end"), F.concat(F.lit("It was a "), F.col("event_type"), F.lit(".")).alias("text"),
        ((F.col("event_id") % 100) / 100.0).alias("asr_confidence"), ((F.col("event_id") % 37) / 37.0).alias("diarization_confidence"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("src_"), F.col("o_orderkey").cast("string")).alias("source_id"), F.when(F.col("o_orderkey") % 2 == 0, "chat").otherwise("pdf").alias("modality"), F.col("o_orderdate").alias("ingested_at"), (F.col("o_custkey") % 7 == 0).alias("sensitive"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    decision = F.when(F.col("event_type") == "purchase", "accept").when(F.col("event_type") == "error", "reject").otherwise("needs-review")
    return e.select(F.col("event_id").alias("review_id"), F.concat(F.lit("claim_"), (F.col("event_id") % 500).cast("string")).alias("claim_id"), F.concat(F.lit("rev_"), (F.col("user_id") % 5).cast("string")).alias("reviewer_id"), decision.alias("decision"), F.col("ts").alias("reviewed_at"))


# Facts of origin from events, with gaps and faults by number. {list} opens an array, so that one text serves every dialect.
PROVENANCE = {
    "evidence_id": "CAST(event_id AS STRING)", "modality": "CASE event_id % 6 WHEN 0 THEN 'chat' WHEN 1 THEN 'pdf' WHEN 2 THEN 'audio' ELSE 'image' END",
    "evidence_type": "CASE event_id % 6 WHEN 0 THEN 'message_span' WHEN 1 THEN 'text_span' WHEN 2 THEN 'utterance_span' WHEN 3 THEN 'visual_region' WHEN 4 THEN 'visual_cluster' ELSE 'ocr_text_span' END",
    "conversation_id": "CAST(user_id AS STRING)", "message_id": "CASE WHEN event_type = 'click' THEN ' ' ELSE 'm' END", "sender_id": "CASE WHEN user_id % 7 <> 0 THEN 'u' END",
    "page": "CASE WHEN user_id % 4 = 0 THEN 0 ELSE 1 END", "block_id": "CASE WHEN event_type <> 'view' THEN 'b' END", "extractor": "CASE WHEN user_id % 2 = 0 THEN 'PyMuPDF' ELSE 'pypdf' END",
    "bbox": "CASE WHEN user_id % 3 <> 0 THEN {list}0, 0, user_id % 2, 5{end} END", "utterance_id": "CAST(event_id AS STRING)", "speaker": "CASE WHEN user_id % 5 = 0 THEN '' ELSE 's' END",
    "start": "CASE WHEN event_type <> 'error' THEN CAST(user_id % 10 AS DOUBLE) END", "end": "CAST(user_id % 13 AS DOUBLE)", "source_duration": "CASE WHEN user_id % 6 = 1 THEN CAST(-1 AS DOUBLE) WHEN user_id % 6 <> 0 THEN CAST(8 AS DOUBLE) END",
    "asr_confidence": "CASE WHEN user_id % 8 <> 0 THEN CAST(event_id % 120 AS DOUBLE) / 100 END", "diarization_confidence": "CASE WHEN user_id % 9 <> 0 THEN CAST(event_id % 37 AS DOUBLE) / 30 END",
    "image_id": "CASE WHEN user_id % 5 <> 1 THEN 'i' END", "region_id": "CASE WHEN user_id % 5 <> 2 THEN 'r' END", "proposal_method": "'grid'", "crop_path": "CASE WHEN user_id % 2 = 0 THEN 'c' END",
    "feature_cluster_id": "CASE WHEN user_id % 5 <> 3 THEN 'f' END", "embedding_model": "CASE WHEN user_id % 5 <> 4 THEN 'e' END", "clustering_method": "CASE WHEN user_id % 7 <> 1 THEN 'k' END",
    "member_region_ids": "CASE WHEN user_id % 7 <> 2 THEN {list}'r'{end} END", "representative_region_ids": "CASE WHEN user_id % 7 <> 3 THEN {list}'r'{end} END", "ocr_model": "CASE WHEN user_id % 7 <> 4 THEN 'o' END",
    "ocr_confidence": "CASE WHEN user_id % 7 <> 5 THEN CAST(event_id % 110 AS DOUBLE) / 100 END",
}
IMAGE_CLAIMS = {
    "claim_id": "CAST(event_id AS STRING)", "claim_type": "CASE WHEN event_id % 2 = 0 THEN 'named_visual_classification' ELSE 'unnamed_visual_feature_cluster' END",
    "review_decision": "CASE user_id % 4 WHEN 0 THEN 'accept' WHEN 1 THEN 'reject' WHEN 2 THEN 'needs_review' END", "human_confirmed": "user_id % 9 = 0", "confidence": "CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 100 AS DOUBLE) / 100 END",
    "cluster_size": "event_id % 10", "cohesion_score": "CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 50 AS DOUBLE) / 50 END", "source_count": "event_id % 5",
}
LOOSE_CLAIMS = {
    "line": "event_id",
    "payload": """concat('{', CASE WHEN event_id % 7 <> 0 THEN '"source_id":"s1",' ELSE '' END, CASE WHEN event_id % 3 = 0 THEN '"claim_id":"given",' ELSE '' END, '"evidence_id":"e', CAST(event_id AS STRING), '","source_modality":"',
      CASE event_id % 4 WHEN 0 THEN 'chat' WHEN 1 THEN 'pdf' WHEN 2 THEN 'image' ELSE 'web' END, '","', CASE event_id % 5 WHEN 0 THEN 'claim' WHEN 1 THEN 'claim_text' WHEN 2 THEN 'text' ELSE 'source_faithful_claim' END, '":"It was a ', event_type, '.","',
      CASE event_id % 3 WHEN 0 THEN 'evidence' WHEN 1 THEN 'supporting_text' ELSE 'evidence_text' END, '":"', CASE WHEN event_id % 8 = 0 THEN '' ELSE event_type END, '","attribution":', CASE WHEN event_id % 2 = 0 THEN '"kim"' ELSE '{"type":"speaker","agent":"bob"}' END,
      CASE event_id % 6 WHEN 0 THEN ',"confidence":"82%"' WHEN 1 THEN ',"confidence":64' WHEN 2 THEN ',"confidence":0.5' WHEN 3 THEN ',"confidence":250' ELSE '' END, CASE WHEN event_id % 4 = 0 THEN ',"risk_flags":"x"' ELSE '' END, '}')""",
}


def from_events(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(*(f"{e.format(list='array(', end=')') if '{list}' in e else e} AS `{c}`" for c, e in columns.items()))


def events_sql(columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{e.format(list="[", end="]") if "{list}" in e else e} AS "{c}"' for c, e in columns.items()) + " FROM events"


def with_faults(c: DataFrame) -> DataFrame:
    """Faults by place, so that each rule of the validator has something to find."""
    n = F.length("evidence") + F.col("message_index")
    return (
        c.withColumn("n", n).withColumn("evidence_text", F.when(F.col("n") % 5 == 0, F.upper("evidence_text")).otherwise(F.col("evidence_text")))
        .withColumn("claim_text", F.when(F.col("n") % 7 == 0, F.regexp_replace(F.regexp_replace("claim_text", "three", "four"), " not ", " ")).when(F.col("n") % 11 == 0, F.regexp_replace(F.concat("claim_text", F.lit(" Captain Nemo agreed.")), " may ", " will ")).otherwise(F.col("claim_text")))
        .withColumn("agent", F.when(F.col("n") % 13 == 0, "someone").otherwise(F.col("agent"))).drop("n")
    )
