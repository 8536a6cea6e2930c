"""Records from JSON exports and from extracted blocks: messages, utterances, document blocks, OCR texts, files.

An export is one JSON document a row (source_id, payload). A long one may come in several rows, each a whole document with
some of the items; first_index then is the number of items before. Fields have several spellings; the first that is there
and not null counts. Rows that break a table's constraints are left to ``tables.violations``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweft.frames import computed
from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id
from claimweft.operators import records, sections

LOW_ASR, LOW_DIARIZATION, LOW_OCR = 0.55, 0.50, 0.75


def _get(v: Column, key: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{key}", kind)


def first_present(v: Column, keys: tuple[str, ...], default: Column | None = None) -> Column:
    """The text of the first key that is there and not null."""
    found = [_get(v, k) for k in keys]
    return F.coalesce(*found, *([] if default is None else [default]))


def _truthy(v: Column, keys: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.nullif(_get(v, k), F.lit("")) for k in keys))


def as_list(v: Column, key: str) -> Column:
    """A list of texts: of a list its items, of a single value that value, else none."""
    return F.coalesce(_get(v, key, "array<string>"), F.when(_get(v, key).isNotNull(), F.array(_get(v, key))), F.array().cast("array<string>"))


def items(exports: DataFrame, keys: tuple[str, ...], single: bool = False, head: Callable[[Column], Column] | None = None) -> DataFrame:
    """source_id, index and item (a variant): the objects of each export's list; with ``head`` what it takes from the document.

    The list is the document itself or under one of ``keys`` of an object; ``single`` lets an object stand for a list of
    one. Anything else fails, also a list with something that is no object. A null payload has no items. An item's row
    holds nothing else of the document, because a document may be as large as all its items.
    """
    v = computed(exports.where(F.col("payload").isNotNull()), whole=F.try_parse_json("payload"))  # else the filter of empty lists parses it anew for each key
    whole = F.col("whole")
    found = F.coalesce(*(_get(whole, k, "array<variant>") for k in keys), F.try_variant_get(whole, "$", "array<variant>"))
    if single:
        found = F.coalesce(found, F.when(F.schema_of_variant(whole).startswith("OBJECT"), F.array(whole)))
    found = F.coalesce(found, F.raise_error(F.lit(f"an export must be a JSON list or an object with one of: {', '.join(keys)}")).cast("array<variant>"))
    kept = [c for c in exports.columns if c not in ("payload", "first_index")]
    own = [] if head is None else ["head"]
    before = F.col("first_index").cast("int") if "first_index" in exports.columns else F.lit(0)
    parts = v.select(*kept, *(head(whole).alias(c) for c in own), before.alias("before"), found.alias("found"))  # below the explode, so that it doesn't copy documents
    out = parts.select(*kept, *own, "before", F.posexplode("found").alias("pos", "item"))
    is_object = F.schema_of_variant("item").startswith("OBJECT")
    item = F.when(is_object, F.col("item")).otherwise(F.raise_error(F.lit("every item of an export must be a JSON object")).cast("variant"))
    return out.select(*kept, *own, (F.col("before") + F.col("pos")).alias("index"), item.alias("item"))


def iso(ts: Column) -> Column:
    """A point in time as text in UTC, with microseconds only where there are some. What is no time is null."""
    t = ts.try_cast("timestamp")
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.date_format(t, "SSSSSS") != "000000", F.date_format(t, ".SSSSSS")).otherwise(""), F.lit("+00:00"))


# ---- messages -----------------------------------------------------------------------------------------------------


def sender_role(raw: Column) -> Column:
    low = F.lower(raw)
    return F.when(low.isin("user", "assistant", "system", "external"), low).when(low.isin("bot", "ai"), "assistant").otherwise("external")


def chat_messages(exports: DataFrame, metadata: dict[str, str] | None = None) -> DataFrame:
    """Messages of exports, with defaults of the file. ``metadata`` overrides that of the file, key by key."""
    known = lambda h: F.struct(_truthy(h, ("conversation_id", "channel_id")).alias("conversation"), _truthy(h, ("thread_id",)).alias("thread"), _get(h, "metadata", "map<string,string>").alias("metadata"))
    each = items(exports, ("messages",), head=known)
    m = F.col("item")
    person = lambda of, keys: _truthy(_get(m, of, "variant"), keys)
    is_object = lambda of: F.coalesce(F.schema_of_variant(_get(m, of, "variant")).startswith("OBJECT"), F.lit(False))
    ids, shown = ("id", "username", "name"), ("display_name", "name", "username")
    sender = F.when(is_object("author"), F.coalesce(person("author", ids), F.lit("unknown"))).when(is_object("sender"), F.coalesce(person("sender", ids), F.lit("unknown")))
    sender = sender.otherwise(first_present(m, ("sender_id", "user_id", "author_id", "sender"), F.lit("unknown")))
    display = F.when(is_object("author"), person("author", shown)).when(is_object("sender"), person("sender", shown)).otherwise(first_present(m, ("sender_display_name", "sender_name", "author_name", "username")))
    text = F.coalesce(*(c for k in ("text", "content", "body", "message") for c in (F.array_join(_get(m, k, "array<string>"), "\n"), _get(m, k))), F.lit(""))
    conversation = first_present(m, ("conversation_id", "channel_id", "chat_id", "room_id"), F.coalesce("head.conversation", F.col("source_id")))
    flags = as_list(m, "risk_flags")
    history = F.transform(F.coalesce(_get(m, "edit_history", "array<variant>"), F.when(F.coalesce(_get(m, "edit_history"), F.lit("")) != "", F.array(_get(m, "edit_history", "variant")))), lambda x: F.to_json(x))
    own = dict(metadata or {})
    given = F.create_map(*(F.lit(x) for kv in own.items() for x in kv)) if own else F.create_map().cast("map<string,string>")
    file_metadata = F.coalesce("head.metadata", F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(file_metadata, lambda k, _: ~k.isin(*own)) if own else file_metadata, given)
    raw_time = first_present(m, ("timestamp", "created_at", "ts", "date"))
    rows = each.select(
        "source_id", F.col("index").alias("message_index"), conversation.alias("conversation_id"), sender.alias("sender_id"), display.alias("sender_display_name"),
        sender_role(first_present(m, ("sender_role", "role"), F.lit("external"))).alias("sender_role"), text.alias("text"), raw_time.alias("raw_time"), iso(raw_time).alias("timestamp"),
        first_present(m, ("message_id", "id")).alias("raw_id"), F.coalesce(_get(m, "thread_id"), F.col("head.thread")).alias("thread"), first_present(m, ("reply_to_message_id", "reply_to", "parent_id")).alias("reply_to_message_id"),
        as_list(m, "quoted_message_ids").alias("quoted_message_ids"), F.coalesce(history, F.array().cast("array<string>")).alias("edit_history"), flags.alias("flags"), merged.alias("metadata"),
    )
    made = stable_id("msg", source_id=json_string(F.col("source_id")), index=F.col("message_index").cast("string"), sender_id=json_string(F.col("sender_id")), timestamp=json_string(F.col("raw_time")), text=json_string(F.col("text")))
    edited = (F.size("edit_history") > 0) & ~F.array_contains("flags", "edited_message")
    return rows.select(
        F.when(T.strip(F.col("raw_id")) != "", F.col("raw_id")).otherwise(made).alias("message_id"), "source_id", "conversation_id", F.coalesce("thread", "conversation_id").alias("thread_id"), "sender_id", "sender_display_name", "sender_role",
        "timestamp", "text", "reply_to_message_id", "quoted_message_ids", "edit_history", "message_index", "metadata", F.when(edited, F.concat("flags", F.array(F.lit("edited_message")))).otherwise(F.col("flags")).alias("risk_flags"),
    )


# ---- utterances ---------------------------------------------------------------------------------------------------


def utterances(exports: DataFrame) -> DataFrame:
    """Utterances of transcripts with flags of low confidence and of speech that overlaps in its source."""
    each = items(exports, ("utterances",), head=lambda h: F.struct(_get(h, "language").alias("language")))
    u = F.col("item")
    number = lambda keys: F.coalesce(*(_get(u, k, "double") for k in keys), F.lit(0.0))
    rows = each.select(
        "source_id", F.col("index").alias("utterance_index"), first_present(u, ("utterance_id", "id")).alias("raw_id"), first_present(u, ("speaker", "speaker_label"), F.lit("SPEAKER_UNKNOWN")).alias("speaker"),
        number(("start", "start_seconds")).alias("start"), number(("end", "end_seconds")).alias("end"), first_present(u, ("start", "start_seconds"), F.lit("0")).alias("start_json"), first_present(u, ("end", "end_seconds"), F.lit("0")).alias("end_json"),
        first_present(u, ("text", "transcript"), F.lit("")).alias("text"), _get(u, "asr_confidence", "double").alias("asr_confidence"), _get(u, "diarization_confidence", "double").alias("diarization_confidence"),
        F.coalesce(_get(u, "language"), F.col("head.language")).alias("language"), as_list(u, "risk_flags").alias("flags"),
    )
    made = stable_id("utt", source_id=json_string(F.col("source_id")), index=F.col("utterance_index").cast("string"), speaker=json_string(F.col("speaker")), start=F.col("start_json"), end=F.col("end_json"), text=json_string(F.col("text")))
    rows = rows.withColumn("utterance_id", F.when(T.strip(F.col("raw_id")) != "", F.col("raw_id")).otherwise(made))
    low = F.array_compact(F.array(F.when(F.col("asr_confidence") < LOW_ASR, "low_asr_confidence"), F.when(F.col("diarization_confidence") < LOW_DIARIZATION, "speaker_uncertain")))
    flagged = rows.withColumn("flags", F.array_union("flags", low)).withColumn("over", records.overlaps())
    flags = F.when(F.col("over"), F.array_sort(F.array_union("flags", F.array(F.lit("overlapping_speech"))))).otherwise(F.col("flags"))
    return flagged.select("utterance_id", "source_id", "utterance_index", "speaker", "start", "end", "text", "asr_confidence", "diarization_confidence", "language", flags.alias("risk_flags"))


def transcript_sources(exports: DataFrame, utterance_rows: DataFrame) -> DataFrame:
    """source_id, utterance_count and duration_seconds (the last end, 0 without utterances) of each transcript."""
    per = utterance_rows.groupBy(F.col("source_id").alias("s")).agg(F.count(F.lit(1)).alias("n"), F.max("end").alias("d"))
    return exports.select("source_id").distinct().join(per, F.col("source_id") == F.col("s"), "left").select("source_id", F.coalesce("n", F.lit(0)).alias("utterance_count"), F.coalesce("d", F.lit(0.0)).alias("duration_seconds"))


# ---- blocks of documents ------------------------------------------------------------------------------------------


def pdf_blocks(blocks: DataFrame) -> DataFrame:
    """Block records of extracted blocks (source_id, page, block_no, text, bbox, extractor, risk_flags).

    Repeated page furniture becomes header or footer, texts are cleaned, headings give section paths, and characters are
    counted over the source with one between blocks. A null text is blank and left out.
    """
    b = blocks.where(F.col("text").rlike("\\S"))
    keys = ["source_id", "page", "block_no"]
    furniture = records.furniture(b)
    paths = sections.section_paths(b, furniture, as_text=False).select(*(F.col(k).alias(f"p_{k}") for k in keys), F.col("section").alias("section_path"))
    j = b.join(furniture.select(*(F.col(k).alias(f"f_{k}") for k in keys), "kind"), reduce(lambda x, y: x & y, (F.col(k) == F.col(f"f_{k}") for k in keys)), "left")
    j = j.join(paths, reduce(lambda x, y: x & y, (F.col(k) == F.col(f"p_{k}") for k in keys)), "left")
    clean = computed(j.withColumnRenamed("text", "original_text"), text=T.clean_block(F.col("original_text")))
    before = Window.partitionBy("source_id").orderBy("page", "block_no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)).cast("int")
    page_furniture = F.col("kind").isNotNull()
    actions = F.concat(T.cleanup_actions(F.col("original_text"), F.col("text")), F.when(page_furniture, F.array(F.lit("classify_repeated_page_furniture"))).otherwise(F.array().cast("array<string>")))
    flags = F.array_sort(F.array_union(F.coalesce("risk_flags", F.array().cast("array<string>")), F.when(page_furniture, F.array(F.lit("page_furniture"))).otherwise(F.array().cast("array<string>"))))
    own = stable_id("pdf_blk", source_id=json_string(F.col("source_id")), page=F.col("page").cast("string"), block_no=F.col("block_no").cast("string"), text=json_string(F.col("text")))
    return clean.withColumn("char_start", start).select(
        own.alias("block_id"), "source_id", "page", "block_no", F.coalesce("kind", F.lit("text")).alias("block_type"), "text", "original_text", actions.alias("cleanup_actions"), "bbox", "char_start", (F.col("char_start") + F.length("text")).alias("char_end"),
        F.coalesce("section_path", F.array().cast("array<string>")).alias("section_path"), "extractor", flags.alias("risk_flags"),
    )


# ---- OCR texts ----------------------------------------------------------------------------------------------------


def ocr_items(exports: DataFrame, images: DataFrame) -> DataFrame:
    """OCR texts with the image that each names by image_id, source_id or file name; an unknown image or no text fails.

    ``images`` has image_id, source_id and source_file; where a key names several images, the last image_id counts.
    """
    i = F.col("item")
    each = items(exports.select("payload"), ("ocr", "regions", "texts"), single=True)
    name = F.element_at(F.split("source_file", "/"), -1)
    keys = images.select("image_id", F.col("source_id").alias("image_source"), F.explode(F.array("image_id", "source_id", name)).alias("k"))
    lookup = keys.where(F.col("k").isNotNull()).groupBy("k").agg(F.max_by(F.struct("image_id", "image_source"), "image_id").alias("image"))
    key = _truthy(i, ("image_id", "source_id", "image_file"))
    text = F.coalesce(_truthy(i, ("text", "ocr_text")), F.lit(""))
    confidence = _get(i, "ocr_confidence", "double")
    low = F.when(confidence < LOW_OCR, F.array(F.lit("low_ocr_confidence"))).otherwise(F.array().cast("array<string>"))
    box = _get(i, "bbox", "array<int>")
    rows = each.select(
        key.alias("key"), text.alias("text"), F.when(F.size(box) == 4, box).alias("bbox"), F.coalesce(_truthy(i, ("ocr_model", "model")), F.lit("unknown_ocr_model")).alias("ocr_model"), confidence.alias("ocr_confidence"),
        F.array_sort(F.array_union(F.filter(as_list(i, "risk_flags"), lambda f: f != ""), low)).alias("risk_flags"),
    )
    j = computed(rows, text=T.strip(F.col("text"))).join(lookup, F.col("key") == F.col("k"), "left")
    fail = lambda message: F.raise_error(F.concat(F.lit(message), F.coalesce("key", F.lit("")))).cast("string")
    return j.select(
        F.when(F.col("image").isNull(), fail("an OCR item names an unknown image: ")).otherwise(F.col("image.image_id")).alias("image_id"), F.col("image.image_source").alias("source_id"),
        F.when(F.col("text") == "", fail("an OCR item has no text: ")).otherwise(F.col("text")).alias("text"), "bbox", "ocr_model", "ocr_confidence", "risk_flags",
    )


# ---- files --------------------------------------------------------------------------------------------------------


def register_files(spark: SparkSession, path: str, modality: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """source_id, source_modality, source_file, sha256 and size of the files below a path; equal contents are one source."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffixes:
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(s for x in suffixes for s in (x, x.upper())) + "}")
    files = reader.load(path).select(F.col("path").alias("source_file"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    own = stable_id("src", modality=json_string(F.lit(modality)), sha256=json_string(F.col("sha256")))
    first = files.groupBy("sha256").agg(F.min("source_file").alias("source_file"), F.first("size").alias("size"))
    return first.select(own.alias("source_id"), F.lit(modality).alias("source_modality"), "source_file", "sha256", "size")


IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "gif", "bmp", "webp", "tiff")


def images(spark: SparkSession, path: str) -> DataFrame:
    """Image records of the files below a path: ids, format, width and height from the header of PNG, GIF, BMP and JPEG.

    Other formats have a null size. Files without a known suffix aren't read.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(s for x in IMAGE_SUFFIXES for s in (x, x.upper())) + "}").load(path)
    hexed = lambda at, n: F.hex(F.substring("content", F.lit(at) if isinstance(at, int) else at, F.lit(n)))
    number = lambda h: F.conv(h, 16, 10).cast("int")
    turned = lambda at, n: number(F.concat(*(hexed(at + k, 1) for k in reversed(range(n)))))
    head = hexed(1, 8)
    kind = F.when(head == "89504E470D0A1A0A", "PNG").when(head.startswith("47494638"), "GIF").when(head.startswith("424D"), "BMP").when(head.startswith("FFD8FF"), "JPEG").when(head.startswith("52494646"), "WEBP").when(head.startswith("49492A00") | head.startswith("4D4D002A"), "TIFF")
    # a JPEG's size is in its frame segment, which follows others of stated lengths
    start = F.struct(F.lit(2).alias("at"), F.lit(None).cast("int").alias("w"), F.lit(None).cast("int").alias("h"))

    def segment(s, _):
        framed = s["w"].isNull() & F.substring(hexed(s["at"] + 1, 2), 1, 3).eqNullSafe("FFC") & hexed(s["at"] + 2, 1).isin("C0", "C1", "C2", "C3")
        at = F.when(s["w"].isNull() & ~framed, s["at"] + 2 + F.coalesce(number(hexed(s["at"] + 3, 2)), F.lit(1 << 30))).otherwise(s["at"])
        return F.struct(F.least(at, F.lit(1 << 30)).alias("at"), F.when(framed, number(hexed(s["at"] + 8, 2))).otherwise(s["w"]).alias("w"), F.when(framed, number(hexed(s["at"] + 6, 2))).otherwise(s["h"]).alias("h"))

    frame = F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, segment)
    width = F.when(kind == "PNG", number(hexed(17, 4))).when(kind == "GIF", turned(7, 2)).when(kind == "BMP", turned(19, 4)).when(kind == "JPEG", frame["w"])
    height = F.when(kind == "PNG", number(hexed(21, 4))).when(kind == "GIF", turned(9, 2)).when(kind == "BMP", turned(23, 4)).when(kind == "JPEG", frame["h"])
    files = raw.select(F.col("path").alias("source_file"), F.sha2("content", 256).alias("sha256"), kind.alias("format"), width.alias("width"), height.alias("height"))
    source = stable_id("src", modality=json_string(F.lit("image")), sha256=json_string(F.col("sha256")))
    return files.withColumn("source_id", source).select(F.concat(F.lit("img_"), F.substring("sha256", 1, 24)).alias("image_id"), "source_id", "source_file", "sha256", "format", "width", "height")


def decode_pdf(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of PDF files with a PDF library on the executors (fitz, else pypdf without boxes); fails where neither is.

    Columns are those that ``pdf_blocks`` reads, and source_file.
    """
    import importlib.util

    if not any(importlib.util.find_spec(m) for m in ("fitz", "pypdf")):
        raise RuntimeError("decoding PDF files needs the fitz or pypdf library; extracted blocks can be read without")

    def run(batches):
        import hashlib
        import io

        import pandas as pd

        for batch in batches:
            out = []
            for path_, content in zip(batch["path"], batch["content"]):
                sha = hashlib.sha256(content).hexdigest()
                try:
                    import fitz

                    for page, p in enumerate(fitz.open(stream=content, filetype="pdf"), 1):
                        out += [(path_, sha, page, no, str(b[4]), [float(x) for x in b[:4]], "pymupdf", []) for no, b in enumerate(p.get_text("blocks")) if len(b) > 4 and str(b[4]).strip()]
                except ImportError:
                    from pypdf import PdfReader

                    for page, p in enumerate(PdfReader(io.BytesIO(content)).pages, 1):
                        if (text := p.extract_text() or "").strip():
                            out.append((path_, sha, page, 0, text, None, "pypdf", ["missing_bbox"]))
            yield pd.DataFrame(out, columns=["source_file", "sha256", "page", "block_no", "text", "bbox", "extractor", "risk_flags"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    blocks = files.mapInPandas(run, "source_file string, sha256 string, page int, block_no int, text string, bbox array<double>, extractor string, risk_flags array<string>")
    return blocks.withColumn("source_id", stable_id("src", modality=json_string(F.lit("pdf")), sha256=json_string(F.col("sha256"))))


# ---- audio normalisation ------------------------------------------------------------------------------------------


def normalization_plans(files: DataFrame, folder: str, sample_rate: int = 16_000, channels: int = 1) -> DataFrame:
    """For each audio file (source_id, source_file) the converter's command and what it will write: a plan, not run."""
    if sample_rate < 1 or channels < 1:
        raise ValueError("sample_rate and channels must be positive")
    rate = f"{sample_rate // 1000}khz" if sample_rate % 1000 == 0 else f"{sample_rate}hz"
    layout = {1: "mono", 2: "stereo"}.get(channels, f"{channels}ch")
    stem = F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), "\\.[^.]*$", "")
    target = F.concat(F.lit(folder.rstrip("/") + "/"), stem, F.lit(f"_{rate}_{layout}.wav"))
    policy = stable_id("audio_norm", 16, normalizer=F.lit('"audio_normalization.v1"'), normalized_file=json_string(F.col("normalized_file")), sample_rate=F.lit(str(sample_rate)), channels=F.lit(str(channels)))
    command = F.array(F.lit("ffmpeg"), F.lit("-y"), F.lit("-i"), F.col("source_file"), F.lit("-ac"), F.lit(str(channels)), F.lit("-ar"), F.lit(str(sample_rate)), F.col("normalized_file"))
    rows = files.withColumn("normalized_file", target).withColumn("status", F.lit("planned"))
    return rows.select("source_id", "source_file", policy.alias("policy_id"), "normalized_file", "status", command.alias("command"), F.lit(sample_rate).alias("sample_rate"), F.lit(channels).alias("channels"))


def merge_normalizations(existing: DataFrame, plans: DataFrame) -> DataFrame:
    """One row a source and policy, the new one instead of the old; what was created is not planned anew."""
    both = existing.withColumn("age", F.lit(0)).unionByName(plans.withColumn("age", F.lit(1)), allowMissingColumns=True)
    names = [c for c in both.columns if c not in ("source_id", "policy_id", "age")]
    best = both.groupBy("source_id", "policy_id").agg(F.max_by(F.struct(*names), F.struct((F.col("status") == "created").cast("int"), "age")).alias("r"))
    return best.select("source_id", "policy_id", "r.*")
