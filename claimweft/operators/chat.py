"""The chat path: messages, evidence, context windows, spans, claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id


def messages(export: DataFrame, source_id: str = "src_chat") -> DataFrame:
    role = F.lower("role")
    return export.where(F.col("text").rlike("\\S")).select(
        F.lit(source_id).alias("source_id"), F.col("conv_id").cast("string").alias("conversation_id"), F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"), F.col("turn").alias("message_index"),
        F.col("role").alias("sender_id"), F.when(role.isin("user", "assistant", "system", "external"), role).when(role.isin("bot", "ai"), "assistant").otherwise("external").alias("sender_role"), "text",
    )


def evidence(msgs: DataFrame) -> DataFrame:
    return msgs.withColumn("evidence_id", stable_id("ev_msg", source_id=json_string(F.col("source_id")), message_id=json_string(F.col("message_id")))).withColumn("char_end", F.length("text"))


def context_windows(ev: DataFrame, previous: int = 2) -> DataFrame:
    """Each message with the ``previous`` ones of its conversation, as labelled lines."""
    w = Window.partitionBy("source_id", "conversation_id").orderBy("message_index", "message_id").rowsBetween(-previous, 0)
    out = ev.withColumn("w", F.collect_list(F.struct("evidence_id", F.concat_ws(": ", "sender_id", "text").alias("line"))).over(w))
    out = out.withColumn("chunk_text", F.array_join(F.transform("w", lambda x: x["line"]), "\n")).withColumn("evidence_ids", F.array_join(F.transform("w", lambda x: x["evidence_id"]), ","))
    return out.withColumn("overlap", F.size("w") - 1).withColumn("chunk_id", stable_id("chunk_chat", evidence_id=json_string(F.col("evidence_id")), previous=F.lit(str(previous)))).drop("w")


def spans(chunks: DataFrame) -> DataFrame:
    """Claim-bearing sentences of each chunk's own message, with score and risk flags."""
    s = chunks.select("*", F.posexplode(T.sentences(F.col("text"))).alias("sentence_no", "sentence")).withColumn("score", T.span_score(F.col("sentence"))).where(F.col("score").isNotNull())
    flags = F.array_compact(F.array(
        F.when(F.col("sender_role") == "assistant", "assistant_generated_text"), F.when(T.has_word(F.col("sentence"), T.COREFERENCE), "context_dependent_coreference"), F.when(F.endswith("sentence", F.lit("?")), "question_speech_act")))
    return s.withColumn("risk_flags", F.array_join(flags, ",")).withColumn("span_id", stable_id("span_chat", chunk_id=json_string(F.col("chunk_id")), sentence=F.col("sentence_no").cast("string")))


def claims(sp: DataFrame) -> DataFrame:
    m = T.modality(F.col("sentence"))
    framed = F.concat(F.when(m == "question_asked", "The speaker asked: ").otherwise("The speaker asserted: "), F.col("sentence"))
    truth = F.lit("speaker_asserted_unverified")
    return sp.select(
        stable_id("claim", span_id=json_string(F.col("span_id")), extractor=F.lit('"deterministic"')).alias("claim_id"), "span_id", "evidence_id", "source_id", F.col("text").alias("evidence"), F.col("sentence").alias("evidence_text"),
        framed.alias("claim_text"), m.alias("modality"), truth.alias("truth_status"), F.col("sender_id").alias("agent"), "sender_id", F.col("score").alias("confidence"), "risk_flags", "message_index",
        F.when(F.contains("risk_flags", F.lit("coreference")) & (F.col("overlap") > 0), F.col("chunk_text")).alias("context_used"),
    )
