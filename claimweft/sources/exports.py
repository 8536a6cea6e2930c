"""Inputs of the modal paths made from the generated tables: chat exports, transcripts, blocks, images, OCR, faults.

Everything here is test data for queries; nothing of it is an operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweft.frames import computed
from claimweft.functions import text as T
from claimweft.sources.views import load

# Expressions that Spark and DuckDB read alike: what is said, by number, so that each rule of the validator has work.
SAID = """CASE event_id % 8 WHEN 0 THEN concat('The pump is a ', event_type, ' pump.') WHEN 1 THEN 'It has not failed since yesterday.' WHEN 2 THEN concat('There may be ', CAST(event_id % 9 AS STRING), ' leaks. Who saw them?')
 WHEN 3 THEN 'Harbour Master Lund measured 14 meters.' WHEN 4 THEN 'ok' WHEN 5 THEN 'They replaced two engines in 2024-03-01. Thanks' WHEN 6 THEN 'Nothing to add' ELSE 'Was the valve open?' END"""
PRINTED = """CASE p_partkey % 5 WHEN 0 THEN concat('Berth ', CAST(p_size AS STRING), ' is closed.') WHEN 1 THEN 'Gate Two was not locked. It may rain.' WHEN 2 THEN concat(p_type, ' contains 5 kg') WHEN 3 THEN 'No claim' ELSE concat('  The ', p_brand, ' tank has 20 liters.  ') END"""
BLOCK_TEXT = "CASE WHEN (doc_id + pos) % 9 = 0 THEN replace(text, ' ', concat(' ', chr(10))) WHEN (doc_id + pos) % 11 = 0 THEN replace(text, ' ', '  ') WHEN pos = 0 AND doc_id % 2 = 0 THEN concat(CAST(doc_id % 7 + 1 AS STRING), '. Findings of the survey') WHEN pos % 5 = 0 AND doc_id % 3 = 0 THEN concat('Harbour Survey, page ', CAST(pos AS STRING)) WHEN (doc_id + pos) % 13 = 0 THEN concat(text, ' The hull has 12 frames. It may not leak.') ELSE text END"

#: Faults of claims by the last digit of their id: what a claim says, quotes, names and points to.
CLAIM_FAULTS = {
    "evidence_text": "CASE right(claim_id, 1) WHEN '0' THEN upper(evidence_text) WHEN '1' THEN '' WHEN '2' THEN replace(evidence_text, ' ', '  ') ELSE evidence_text END",
    "source_faithful_claim": "CASE right(claim_id, 1) WHEN '3' THEN replace(replace(source_faithful_claim, ' not ', ' '), ' may ', ' will ') WHEN '4' THEN concat(source_faithful_claim, ' Captain Nemo took 77 days.') WHEN 'b' THEN NULL ELSE source_faithful_claim END",
    "att_agent": "CASE right(claim_id, 1) WHEN '5' THEN 'someone' WHEN 'd' THEN NULL ELSE att_agent END", "att_type": "CASE right(claim_id, 1) WHEN '6' THEN 'unknown' ELSE att_type END",
    "span_id": "CASE right(claim_id, 1) WHEN '7' THEN 'span_missing' ELSE span_id END", "evidence_id": "CASE right(claim_id, 1) WHEN '8' THEN 'ev_missing' ELSE evidence_id END", "source_id": "CASE right(claim_id, 1) WHEN '9' THEN 'elsewhere' ELSE source_id END",
    "context_used": "CASE right(claim_id, 1) WHEN 'a' THEN NULL ELSE context_used END", "context_dependent": "CASE right(claim_id, 1) WHEN 'c' THEN false ELSE context_dependent END", "modality": "CASE right(claim_id, 1) WHEN '3' THEN 'asserted' ELSE modality END",
}
#: The same in Spark, whose upper is another.
_SPARK_FAULTS = {c: e.replace("upper(evidence_text)", T.simple_upper("evidence_text")) for c, e in CLAIM_FAULTS.items()}
#: Faults of evidence by the last two digits of its id.
EVIDENCE_FAULTS = {
    "conversation_id": "CASE right(evidence_id, 2) WHEN '01' THEN ' ' ELSE conversation_id END", "message_id": "CASE right(evidence_id, 2) WHEN '02' THEN '' ELSE message_id END", "sender_id": "CASE right(evidence_id, 2) WHEN '03' THEN NULL ELSE sender_id END",
    "page": "CASE right(evidence_id, 2) WHEN '04' THEN 0 ELSE page END", "block_id": "CASE right(evidence_id, 2) WHEN '05' THEN NULL ELSE block_id END", "extractor": "CASE right(evidence_id, 1) WHEN '6' THEN 'PyMuPDF' ELSE extractor END",
    "utterance_id": "CASE right(evidence_id, 2) WHEN '07' THEN NULL ELSE utterance_id END", "speaker": "CASE right(evidence_id, 2) WHEN '08' THEN ' ' ELSE speaker END", "start": "CASE right(evidence_id, 2) WHEN '09' THEN NULL WHEN '0a' THEN -1 ELSE start END",
    "source_duration": "CASE right(evidence_id, 2) WHEN '0b' THEN NULL WHEN '0c' THEN -1 WHEN '0d' THEN 0 ELSE source_duration END", "asr_confidence": "CASE right(evidence_id, 2) WHEN '0e' THEN NULL WHEN '0f' THEN 1.5 ELSE asr_confidence END",
    "diarization_confidence": "CASE right(evidence_id, 2) WHEN '10' THEN NULL WHEN '11' THEN -0.5 ELSE diarization_confidence END", "image_id": "CASE right(evidence_id, 2) WHEN '12' THEN '' ELSE image_id END", "region_id": "CASE right(evidence_id, 2) WHEN '13' THEN NULL ELSE region_id END",
    "proposal_method": "CASE right(evidence_id, 2) WHEN '14' THEN NULL ELSE proposal_method END", "ocr_model": "CASE right(evidence_id, 2) WHEN '15' THEN '' ELSE ocr_model END", "ocr_confidence": "CASE right(evidence_id, 2) WHEN '16' THEN 2 WHEN '17' THEN NULL ELSE ocr_confidence END",
}
#: Reviews of claims: decision by the last digit but one.
DECISION = "CASE substring(claim_id, length(claim_id) - 1, 1) WHEN '0' THEN 'accept' WHEN '1' THEN 'accept' WHEN '2' THEN 'reject' WHEN '3' THEN 'needs_review' END"


def _numbered(parts: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """Add first_index: the items of source g before a part (its items xs) in ``order``.

    Counted within stretches s of the order, and over the stretches by rows (g, s), so that no task gets a whole source.
    """
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("g").alias("g_"), F.col("s").alias("s_")).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("g_", "s_", F.coalesce(F.sum("n").over(ahead(Window.partitionBy("g_").orderBy("s_"))), F.lit(0)).alias("start"))
    within = F.coalesce(F.sum(F.size("xs")).over(ahead(Window.partitionBy("g", "s").orderBy(*order))), F.lit(0))
    j = parts.withColumn("within", within).join(starts, F.col("g").eqNullSafe(F.col("g_")) & F.col("s").eqNullSafe(F.col("s_")))
    return j.withColumn("first_index", (F.col("start") + F.col("within")).cast("int"))


def chat_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven exports of conversations, in parts of a conversation or 1,000 of its turns, their messages in six spellings."""
    c = load(spark, sf_dir, "conversations")
    conv, k = F.col("conv_id").cast("string"), F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(6))
    key, t = F.concat_ws(":", "conv_id", "turn"), F.concat("text", F.lit(" "), F.expr(SAID.replace("event_id", "(conv_id + turn)").replace("event_type", "role")))
    stamp = F.date_format(F.timestamp_add("SECOND", F.col("conv_id") * 60 + F.col("turn"), F.lit("2026-01-01 00:00:00").cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss")
    ts = F.concat(stamp, F.lit("Z"))
    shape = lambda **columns: F.to_json(F.struct(*(x.alias(n) for n, x in columns.items())))
    role = F.col("role")
    message = F.when(k == 0, shape(message_id=key, conversation_id=conv, author=F.struct(role.alias("id"), F.concat(F.lit("The "), role).alias("display_name")), role=role, text=t, timestamp=ts)).when(
        k == 1, shape(id=key, channel_id=conv, sender=F.struct(role.alias("username")), sender_role=role, content=t, created_at=ts)).when(
        k == 2, shape(conversation_id=conv, sender_id=role, sender_name=F.lit("N"), role=F.lit("BOT"), body=t, ts=ts, edit_history=F.array(F.lit("old")))).when(
        k == 3, shape(conversation_id=conv, user_id=role, message=F.array(t, F.lit("more")), risk_flags=F.lit("flagged"))).when(
        k == 4, shape(message_id=F.lit(" "), author=F.struct(role.alias("name")), text=t, thread_id=F.lit("t1"))).otherwise(
        shape(id=F.col("conv_id") * 1000 + F.col("turn"), chat_id=conv, sender=F.lit("plain"), role=F.lit("weird"), text=t, timestamp=F.concat(stamp, F.lit(".250000Z"))))
    dealt = c.select((F.col("conv_id") % 7).alias("g"), F.expr("conv_id div 7000").alias("s"), "conv_id", F.expr("turn div 1000").alias("t"), F.struct("turn", message.alias("m")).alias("x"))
    rows = _numbered(dealt.groupBy("g", "s", "conv_id", "t").agg(F.array_sort(F.collect_list("x")).alias("xs")), dealt, ["conv_id", "t"])
    body = F.array_join(F.transform("xs", lambda x: x["m"]), ",")
    return rows.select(F.concat(F.lit("chat_"), F.col("g").cast("string")).alias("source_id"), "first_index", F.concat(F.lit('{"conversation_id":"conv_default","metadata":{"team":"a","year":2026},"messages":['), body, F.lit("]}")).alias("payload"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten transcripts of events, in parts of 50, their utterances in three spellings."""
    e = load(spark, sf_dir, "events")
    start, k = F.col("event_id") * 4 + 0.5, F.col("event_id") % 3
    end, said = start + 2 + F.col("event_id") % 5, F.expr(SAID)
    speaker, asr, dia = F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")), (F.col("event_id") % 100) / 100.0, (F.col("event_id") % 37) / 37.0
    shape = lambda **columns: F.to_json(F.struct(*(x.alias(n) for n, x in columns.items())))
    u = F.when(k == 0, shape(utterance_id=F.concat(F.lit("utt_"), F.col("event_id").cast("string")), speaker=speaker, start=start, end=end, text=said, asr_confidence=asr, diarization_confidence=dia)).when(
        k == 1, shape(id=F.concat(F.lit("utt_"), F.col("event_id").cast("string")), speaker_label=speaker, start_seconds=start, end_seconds=end, transcript=said)).otherwise(
        shape(speaker=speaker, start=start, end=end, text=said, asr_confidence=asr, diarization_confidence=dia, risk_flags=F.array(F.lit("noisy"))))
    part = F.floor(F.col("event_id") / 50)
    dealt = e.select((part % 10).alias("g"), F.floor(part / 10_000).alias("s"), part.alias("p"), F.struct("event_id", u.alias("u")).alias("x"))
    rows = _numbered(dealt.groupBy("g", "s", "p").agg(F.array_sort(F.collect_list("x")).alias("xs")), dealt, ["p"])
    body = F.array_join(F.transform("xs", lambda x: x["u"]), ",")
    return rows.select(F.concat(F.lit("audio_"), F.col("g").cast("string")).alias("source_id"), "first_index", F.concat(F.lit('{"language":"en","utterances":['), body, F.lit("]}")).alias("payload"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as blocks, five to a page, some wrapped, some as headings, some as page furniture."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text")).where(F.col("text").rlike("\\S"))
    boxed = F.col("doc_id") % 3 == 0
    return lines.select(
        F.concat(F.lit("pdf_"), F.col("doc_id").cast("string")).alias("source_id"), (F.floor(F.col("pos") / 5) + 1).cast("int").alias("page"), (F.col("pos") % 5).cast("int").alias("block_no"), F.expr(BLOCK_TEXT).alias("text"),
        F.when(boxed, F.array(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.col("pos") + 1.0)).alias("bbox"), F.when(boxed, "pymupdf").otherwise("pypdf").alias("extractor"), F.when(~boxed, F.array(F.lit("missing_bbox"))).alias("risk_flags"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return p.select(
        F.concat(F.lit("img_"), key).alias("image_id"), F.concat(F.lit("pic_"), (F.col("p_partkey") % 50).cast("string")).alias("source_id"), F.concat(F.lit("pics/p"), key, F.lit(".png")).alias("source_file"),
        (F.col("p_size") * 20 + 30).cast("int").alias("width"), (F.col("p_size") * 11 + 50).cast("int").alias("height"))


def ocr_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One OCR export a part: a list, a single object, or an object with a list; the image named in three ways."""
    p = load(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    shape = lambda **columns: F.to_json(F.struct(*(x.alias(n) for n, x in columns.items())))
    printed, sure, box = F.expr(PRINTED), (F.col("p_partkey") % 100) / 100.0, F.array(F.lit(1), F.lit(2), F.col("p_size"), F.lit(9))
    k = F.col("p_partkey") % 3
    item = F.when(k == 0, shape(image_id=F.concat(F.lit("img_"), key), text=printed, bbox=box, ocr_confidence=sure, ocr_model=F.lit("reader"))).when(
        k == 1, shape(image_file=F.concat(F.lit("p"), key, F.lit(".png")), ocr_text=printed, model=F.lit("Other Reader"), risk_flags=F.lit("blurred"))).otherwise(shape(source_id=F.concat(F.lit("pic_"), (F.col("p_partkey") % 50).cast("string")), text=printed, bbox=box, ocr_confidence=sure))
    payload = F.when(k == 0, F.concat(F.lit("["), item, F.lit("]"))).when(k == 1, item).otherwise(F.concat(F.lit('{"texts":['), item, F.lit("]}")))
    return computed(p, payload=payload).select("payload")  # else it is written into each expression that reads it, over what compiles


def with_claim_faults(claims: DataFrame) -> DataFrame:
    """Claims, or some columns of them with their ids, with faults."""
    if "attribution" not in claims.columns:
        return claims.select(*(F.expr(_SPARK_FAULTS.get(c, c)).alias(c) for c in claims.columns))
    flat = claims.withColumn("att_type", F.col("attribution.type")).withColumn("att_agent", F.col("attribution.agent"))
    flat = flat.select(*(F.expr(_SPARK_FAULTS.get(c, c)).alias(c) for c in flat.columns))
    return flat.withColumn("attribution", F.struct(F.col("att_type").alias("type"), F.col("att_agent").alias("agent"))).drop("att_type", "att_agent")


def with_evidence_faults(evidence: DataFrame) -> DataFrame:
    names = evidence.schema["provenance"].dataType.names
    kinds = dict(zip(names, (f.dataType for f in evidence.schema["provenance"].dataType.fields)))
    flat = evidence.select("evidence_id", "source_id", "source_modality", "evidence_type", "text", "risk_flags", *(F.col(f"provenance.{n}") for n in names))
    fixed = flat.select("evidence_id", "source_id", "source_modality", "evidence_type", "text", "risk_flags", F.struct(*(F.expr(EVIDENCE_FAULTS.get(n, f"`{n}`")).cast(kinds[n]).alias(n) for n in names)).alias("provenance"))
    return fixed.select(*evidence.columns)


def reviews(claims: DataFrame) -> DataFrame:
    return claims.select(F.concat(F.lit("rev_"), "claim_id").alias("review_id"), "claim_id", F.lit("person").alias("reviewer_id"), F.expr(DECISION).alias("decision"), F.lit("2026-02-01T00:00:00+00:00").alias("reviewed_at")).where(F.col("decision").isNotNull())
