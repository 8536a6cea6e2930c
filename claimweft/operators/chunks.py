"""Chunks: evidence with its surroundings, as extraction reads it.

chunk_id, source_id, source_modality, evidence_ids, primary_evidence_ids, overlap_evidence_ids, text and a summary.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.functions.ids import json_string, stable_id

PREVIOUS_MESSAGES, PREVIOUS_UTTERANCES, MAX_TOKENS, TARGET_TOKENS, OVERLAP_TOKENS, CHARS_A_TOKEN = 2, 1, 1200, 1200, 150, 4


def _window(df: DataFrame, keys: list[str], order: list[Column], previous: int) -> DataFrame:
    """Add w: the row and the ``previous`` ones before it, as structs of all columns."""
    if previous < 0:
        raise ValueError("previous must not be negative")
    return df.withColumn("w", F.collect_list(F.struct(*df.columns)).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-previous, 0)))


def _pick(name: str, of: Column | None = None) -> Column:
    return F.transform(F.col("w") if of is None else of, lambda x: x[name])


def _with_evidence(rows: DataFrame, evidence: DataFrame, modality: str, kind: str, key: str) -> DataFrame:
    """Left join, so that rows without evidence still are context; of several evidence rows of a key the last id counts."""
    e = evidence.where((F.col("source_modality") == modality) & (F.col("evidence_type") == kind)).groupBy(F.col(f"provenance.{key}").alias("k")).agg(F.max("evidence_id").alias("evidence_id"))
    return rows.join(e, F.col(key) == F.col("k"), "left").drop("k")


def _windowed(df: DataFrame, modality: str, id_fields: dict[str, int], summary: Column) -> DataFrame:
    ids = lambda w: F.filter(_pick("evidence_id", w), lambda x: x.isNotNull())
    w = F.col("w")
    out = df.where(F.col("evidence_id").isNotNull())
    own = stable_id(f"chunk_{modality}", primary_evidence_id=json_string(F.col("evidence_id")), **{k: F.lit(str(v)) for k, v in id_fields.items()})
    return out.select(own.alias("chunk_id"), "source_id", F.lit(modality).alias("source_modality"), ids(w).alias("evidence_ids"), F.array("evidence_id").alias("primary_evidence_ids"), ids(F.slice(w, 1, F.size(w) - 1)).alias("overlap_evidence_ids"), F.array_join(_pick("line"), "\n").alias("text"), summary.alias("summary"))


def of_chat(messages: DataFrame, evidence: DataFrame, previous: int = PREVIOUS_MESSAGES, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """A chunk a message with evidence: its text and that of the messages before it in the thread, by time."""
    m = _with_evidence(messages, evidence, "chat", "message_span", "message_id")
    label = F.coalesce(F.nullif("sender_display_name", F.lit("")), "sender_id")
    m = m.select("source_id", "conversation_id", F.coalesce(F.nullif("thread_id", F.lit("")), "conversation_id").alias("thread_id"), "message_id", "evidence_id", F.coalesce("timestamp", F.lit("")).alias("t"), F.coalesce("message_index", F.lit(0)).alias("i"), F.concat_ws(": ", label, "text").alias("line"))
    w = _window(m, ["source_id", "conversation_id", "thread_id"], [F.col("t"), F.col("i"), F.col("message_id")], previous)
    summary = F.to_json(F.struct("conversation_id", "thread_id", _pick("message_id").alias("message_ids"), F.col("message_id").alias("primary_message_id")))
    return _windowed(w, "chat", {"previous_messages": previous, "max_tokens": max_tokens}, summary)


def of_audio(utterances: DataFrame, evidence: DataFrame, previous: int = PREVIOUS_UTTERANCES, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """A chunk an utterance with evidence: its text and that of the utterances before it in the source."""
    u = _with_evidence(utterances, evidence, "audio", "utterance_span", "utterance_id")
    u = u.select("source_id", "utterance_id", "evidence_id", "start", "end", "speaker", F.concat_ws(": ", "speaker", "text").alias("line"))
    w = _window(u, ["source_id"], [F.col("start"), F.col("end"), F.col("utterance_id")], previous)
    first = F.element_at("w", 1)
    summary = F.to_json(F.struct(_pick("utterance_id").alias("utterance_ids"), F.col("utterance_id").alias("primary_utterance_id"), first["start"].alias("start"), F.col("end"), F.array_sort(F.array_distinct(_pick("speaker"))).alias("speakers")))
    return _windowed(w, "audio", {"previous_utterances": previous, "max_tokens": max_tokens}, summary)


def packed(rows: DataFrame, budget: int) -> DataFrame:
    """A row a chunk: source_id, overlap (the last evidence of the chunk before, if the budget ended it) and w, the chunk's rows.

    ``rows`` has source_id, page, block_no, evidence_id, section and n (characters), and what else w shall hold.
    Consecutive rows of a source are put together until the section changes or the budget would be passed. A pass over each
    source in order, which holds one batch and one chunk: a source may be of any length, and rows are shuffled once.
    """
    inner = rows.select("source_id", F.struct(*(c for c in rows.columns if c not in ("source_id", "section", "n"))).alias("b"), "section", "n")
    kind = inner.schema["b"].dataType.simpleString()
    schema = f"source_id string, overlap string, w array<{kind}>"

    def run(batches):
        source = section = last = over = None
        used, begun, held = 0, False, []  # held: the rows so far of the chunk that is not ended, as slices

        def chunk():
            return pa.concat_arrays(held)

        def out(sources, overs, arrays):
            values = pa.concat_arrays(arrays)
            ends = [0]
            for x in arrays:
                ends.append(ends[-1] + len(x))
            return pa.RecordBatch.from_arrays([pa.array(sources, pa.string()), pa.array(overs, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["source_id", "overlap", "w"])

        for batch in batches:
            blocks, done, at = batch.column("b"), ([], [], []), 0
            ids = blocks.field("evidence_id").to_pylist()
            for i, (s, e, sec, n) in enumerate(zip(batch.column("source_id").to_pylist(), ids, batch.column("section").to_pylist(), batch.column("n").to_pylist())):
                other = not begun or s != source
                if other or sec != section or used + n > budget:
                    if begun:
                        held.append(blocks.slice(at, i - at))
                        for to, x in zip(done, (source, over, chunk())):
                            to.append(x)
                        held.clear()
                    at, used, over = i, 0, None if other or sec != section else last
                source, section, last, used, begun = s, sec, e, used + n, True
            held.append(blocks.slice(at))
            if done[0]:
                yield out(*done)
        if begun:
            yield out([source], [over], [chunk()])

    order = ["source_id", "b.page", "b.block_no", "b.evidence_id"]
    return inner.repartition("source_id").sortWithinPartitions(*order).mapInArrow(run, schema)


def of_pdf(evidence: DataFrame, target_tokens: int = TARGET_TOKENS, overlap_tokens: int = OVERLAP_TOKENS, texts: bool = True) -> DataFrame:
    """Consecutive blocks of a section up to the target; after a break by length the last block's id overlaps.

    Without ``texts`` the text and summary of a chunk are null, and blocks are packed without theirs.
    """
    p = lambda k: F.col(f"provenance.{k}")
    rows = evidence.where(F.col("source_modality") == "pdf").select(
        "source_id", "evidence_id", F.coalesce(p("page"), F.lit(0)).alias("page"), F.coalesce(p("block_no"), F.lit(0)).alias("block_no"), F.coalesce("text", F.lit("")).alias("text"), p("block_id").alias("block_id"), F.coalesce(p("section_path"), F.array().cast("array<string>")).alias("path"), p("page").alias("known_page"))
    rows = rows.withColumn("section", F.to_json("path")).withColumn("n", F.length("text"))
    g = packed(rows if texts else rows.drop("text", "block_id", "path", "known_page"), max(1, target_tokens * CHARS_A_TOKEN))
    over = F.when(F.col("overlap").isNull(), F.array().cast("array<string>")).otherwise(F.array("overlap"))
    primary = _pick("evidence_id")
    own = stable_id("chunk_pdf", primary_evidence_ids=F.concat(F.lit("["), F.array_join(F.transform(primary, json_string), ","), F.lit("]")), target_tokens=F.lit(str(target_tokens)), overlap_tokens=F.lit(str(overlap_tokens)))
    text = summary = F.lit(None).cast("string")
    if texts:
        pages = F.array_sort(F.array_distinct(F.filter(_pick("known_page"), lambda x: x.isNotNull())))
        text, summary = F.array_join(_pick("text"), "\n\n"), F.to_json(F.struct(pages.alias("pages"), _pick("block_id").alias("block_ids"), F.array_distinct(F.filter(_pick("path"), lambda x: F.size(x) > 0)).alias("section_paths")))
    return g.select(own.alias("chunk_id"), "source_id", F.lit("pdf").alias("source_modality"), F.concat(over, primary).alias("evidence_ids"), primary.alias("primary_evidence_ids"), over.alias("overlap_evidence_ids"), text.alias("text"), summary.alias("summary"))


def of_ocr(evidence: DataFrame) -> DataFrame:
    e = evidence.where((F.col("source_modality") == "image") & (F.col("evidence_type") == "ocr_text_span"))
    one = F.array("evidence_id")
    summary = F.to_json(F.struct(F.col("provenance.image_id").alias("image_id"), F.col("evidence_id").alias("ocr_evidence_id"), F.col("provenance.bbox").alias("bbox")))
    return e.select(stable_id("chunk_ocr", evidence_id=json_string(F.col("evidence_id"))).alias("chunk_id"), "source_id", F.lit("image").alias("source_modality"), one.alias("evidence_ids"), one.alias("primary_evidence_ids"), F.array().cast("array<string>").alias("overlap_evidence_ids"), F.coalesce("text", F.lit("")).alias("text"), summary.alias("summary"))


def union(*tables: DataFrame) -> DataFrame:
    """Rows of all modalities, one below the other."""
    return reduce(DataFrame.unionByName, tables)
