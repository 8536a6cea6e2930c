"""Blocks of documents, utterances, reviews, governance and measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweft.frames import computed
from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id


def furniture(blocks: DataFrame, most_chars: int = 120, least_pages: int = 2) -> DataFrame:
    """First or last blocks of pages whose signature stands on several pages of the source: header or footer.

    A signature is on several pages where its least and its largest page differ; what that takes is aggregated on the map
    side, and only the first and last block of a page, found by an aggregate too, are joined with it.
    """
    b = computed(blocks.select("source_id", "page", "block_no", "text"), clean=T.clean_block(F.col("text"))).drop("text")
    b = computed(b, signature=T.furniture_signature(F.col("clean"), cleaned=True)).drop("clean")
    usable = (F.length("signature") > 0) & (F.length("signature") <= most_chars)
    pages = (F.min("page") != F.max("page")) if least_pages == 2 else (F.count_distinct("page") >= least_pages)
    several = b.where(usable).groupBy("source_id", "signature").agg(pages.alias("several")).where("several").select("source_id", "signature")
    ends = b.groupBy("source_id", "page").agg(F.min(F.struct("block_no", "signature")).alias("low"), F.max(F.struct("block_no", "signature")).alias("high"))
    kinds = F.array(F.struct(F.col("low.block_no").alias("block_no"), F.col("low.signature").alias("signature"), F.lit("header").alias("kind")), F.struct(F.col("high.block_no").alias("block_no"), F.col("high.signature").alias("signature"), F.lit("footer").alias("kind")))
    each = ends.select("source_id", "page", F.col("low.block_no").alias("first"), F.explode(kinds).alias("k")).where((F.col("k.kind") == "header") | (F.col("k.block_no") != F.col("first")))
    marked = each.select("source_id", "page", F.col("k.block_no").alias("block_no"), F.col("k.signature").alias("signature"), F.col("k.kind").alias("kind"))
    return marked.join(several, ["source_id", "signature"], "left_semi").where(usable).select("source_id", "page", "block_no", "kind")


def char_offsets(blocks: DataFrame) -> DataFrame:
    w = Window.partitionBy("source_id").orderBy("page", "block_no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0))
    return blocks.withColumn("char_start", start).withColumn("char_end", F.col("char_start") + F.length("text")).select("source_id", "page", "block_no", "char_start", "char_end")


def overlaps():
    """Whether an utterance (source_id, start, end, utterance_id) overlaps another of its source.

    Overlap needs no self-join: an utterance overlaps an earlier one iff it starts before the running maximum of ends
    ahead of it in (start, end, id) order, and a later one iff the least later start with an end beyond it is before
    its end, which in that order is the next one's start.
    """
    order = Window.partitionBy("source_id").orderBy("start", "end", "utterance_id")
    earlier = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = F.lead("start").over(order)
    return F.coalesce(earlier > F.col("start"), F.lit(False)) | (F.coalesce(later < F.col("end"), F.lit(False)))


def utterance_risk(u: DataFrame) -> DataFrame:
    """Flags for low confidence and for speech that overlaps in its source."""
    over = overlaps()
    flags = F.array_compact(F.array(F.when(F.col("asr_confidence") < 0.55, "low_asr_confidence"), F.when(over, "overlapping_speech"), F.when(F.col("diarization_confidence") < 0.5, "speaker_uncertain")))
    return u.withColumn("risk_flags", F.array_join(flags, ",")).select("utterance_id", "source_id", "risk_flags")


def source_durations(u: DataFrame) -> DataFrame:
    return u.groupBy("source_id").agg(F.count(F.lit(1)).alias("utterances"), F.max("end").alias("duration"))


def audio_windows(u: DataFrame, previous: int = 1) -> DataFrame:
    """Each utterance with the ``previous`` ones of its source: text of labelled lines, start, end and speakers."""
    w = Window.partitionBy("source_id").orderBy("start", "end", "utterance_id").rowsBetween(-previous, 0)
    out = u.withColumn("w", F.collect_list(F.struct("utterance_id", "speaker", "start", "end", F.concat_ws(": ", "speaker", "text").alias("line"))).over(w))
    pick = lambda k: F.transform("w", lambda x: x[k])
    return out.select("source_id", "utterance_id", F.array_join(pick("line"), "\n").alias("chunk_text"), F.element_at("w", 1)["start"].alias("chunk_start"), F.element_at("w", -1)["end"].alias("chunk_end"), F.array_join(F.array_sort(F.array_distinct(pick("speaker"))), ",").alias("speakers"))


def latest_reviews(r: DataFrame) -> DataFrame:
    """The last decision on each claim, later rows winning ties; an aggregate, not a sort."""
    d = r.withColumn("decision", F.regexp_replace(F.lower(T.strip(F.col("decision"))), "-", "_"))
    return d.groupBy("claim_id").agg(F.max_by(F.struct("decision", "reviewer_id", "review_id"), F.struct("reviewed_at", "review_id")).alias("l")).select("claim_id", "l.*")


def disagreement(r: DataFrame) -> DataFrame:
    last = r.groupBy("claim_id", "reviewer_id").agg(F.max_by("decision", F.struct("reviewed_at", "review_id")).alias("decision"))
    per = last.groupBy("claim_id").agg(F.count(F.lit(1)).alias("reviewers"), F.count_distinct("decision").alias("decisions")).where("reviewers >= 2")
    return per.agg(F.count(F.lit(1)).alias("claims"), F.count_if(F.col("decisions") > 1).alias("disagreeing"))


def pii_findings(rows: DataFrame, key: str) -> DataFrame:
    found = lambda kind, p: F.transform(F.regexp_extract_all("text", F.lit(p), F.lit(0)), lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("match")))
    each = rows.select(F.col(key).alias("record_id"), F.explode(F.array_distinct(F.concat(found("email", T.EMAIL), found("phone", T.PHONE), found("ssn", T.SSN)))).alias("f"))
    hidden = F.when(F.col("f.kind") == "email", F.concat(F.substring("f.match", 1, 1), F.lit("***@"), F.substring_index("f.match", "@", -1))).when(F.col("f.kind") == "phone", F.concat(F.lit("***-***-"), F.right("f.match", F.lit(4)))).otherwise(F.concat(F.lit("***-**-"), F.right("f.match", F.lit(4))))
    return each.select("record_id", "f.kind", hidden.alias("preview"), F.sha2("f.match", 256).alias("match_sha256"))


#: Patterns and placeholders of redact, in order: the whole rules, and those of pii_redact's SQL. The latter leave the second
#: of two phone numbers that one character parts, and read words as ASCII; use the whole rules where text is given away.
WHOLE_RULES = ((T.EMAIL, "[EMAIL]"), (T.PHONE, "[PHONE]"), (T.SSN, "[SSN]"))
SQL_RULES = ((T.SQL_EMAIL, "[EMAIL]"), (T.SQL_PHONE, "$1[PHONE]$2"), (T.SQL_SSN, "[SSN]"))


def redact(text, rules=WHOLE_RULES):
    return reduce(lambda t, rule: F.regexp_replace(t, *rule), rules, text)


def retention(sources: DataFrame, now: str, days: int = 365) -> DataFrame:
    age = F.floor((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("ingested_at")) / 86400).cast("long")
    return sources.withColumn("age_days", age).where(F.col("age_days") >= days).select("source_id", "modality", "age_days")


def privacy_violations(claims: DataFrame, sources: DataFrame, local: tuple[str, ...] = ("local", "deterministic")) -> DataFrame:
    """Claims of sensitive sources made by a provider that isn't local."""
    return claims.where(~F.col("provider").isin(*local)).join(sources.where("sensitive").select("source_id"), "source_id", "left_semi").select("claim_id", "source_id", "provider")


def grid_boxes(images: DataFrame, patch: int = 224, stride: int = 224) -> DataFrame:
    """Boxes of a grid over each image; the last position is flush with the edge."""
    def positions(size, p):
        last = size - p
        return F.array_sort(F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last))))
    w, h = F.least("width", F.lit(patch)), F.least("height", F.lit(patch))
    xs = images.select("image_id", w.alias("w"), h.alias("h"), F.explode(positions(F.col("width"), w)).alias("x"), "height")
    return xs.select("image_id", "x", F.explode(positions(F.col("height"), F.col("h"))).alias("y"), "w", "h")


def proposal_method(patch: int, stride: int) -> str:
    return f"grid_{patch}_stride{stride}"


def region_id(image_id, x, y, w, h, method: str):
    box = F.concat(F.lit("["), F.concat_ws(",", *(c.cast("string") for c in (x, y, w, h))), F.lit("]"))
    return stable_id("img_region", image_id=json_string(image_id), bbox=box, proposal_method=json_string(F.lit(method)))


def propose_regions(images: DataFrame, patch: int = 224, stride: int = 112) -> DataFrame:
    """Regions of a grid over images (image_id, source_id, width, height); edge_patch where the image is smaller than one."""
    method = proposal_method(patch, stride)
    boxes = grid_boxes(images, patch, stride).join(images.select("image_id", "source_id"), "image_id")
    own = region_id(F.col("image_id"), F.col("x"), F.col("y"), F.col("w"), F.col("h"), method)
    flags = F.when((F.col("w") < patch) | (F.col("h") < patch), F.array(F.lit("edge_patch"))).otherwise(F.array().cast("array<string>"))
    nothing = F.lit(None).cast("string")
    return boxes.select(own.alias("region_id"), "image_id", "source_id", F.lit("patch").alias("region_type"), "x", "y", "w", "h", F.array("x", "y", "w", "h").alias("bbox"), nothing.alias("crop_path"), nothing.alias("mask_path"), F.lit(method).alias("proposal_method"), F.lit(None).cast("double").alias("proposal_score"), flags.alias("risk_flags"))
