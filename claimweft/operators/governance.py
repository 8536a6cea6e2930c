"""Personal data, privacy of sources, retention and routing of models."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.functions import text as T
from claimweft.functions.ids import json_string, stable_id

# Kinds of personal data in the order in which they are looked for, with what stands for them, and the text
# fields and ids of the tables that have some.
PII = (("email", T.EMAIL, "[EMAIL]"), ("phone", T.PHONE, "[PHONE]"), ("ssn", T.SSN, "[SSN]"))
#: The same as the SQL of the queries has them, which leaves the second of two phone numbers that one character parts.
SQL_PII = (("email", T.SQL_EMAIL, "[EMAIL]"), ("phone", T.SQL_NUMBER, "[PHONE]", *T.SQL_AROUND), ("ssn", T.SQL_SSN, "[SSN]"))
FIELDS = {
    "chat_messages": ("message_id", ("text",)),
    "pdf_blocks": ("block_id", ("text",)),
    "audio_utterances": ("utterance_id", ("text",)),
    "evidence": ("evidence_id", ("text",)),
    "spans": ("span_id", ("text", "context_text")),
    "claims_raw": ("claim_id", ("source_faithful_claim", "evidence_text", "context_used")),
}
LOCAL_ONLY, NOT_LOCAL = "local_only_sensitive_sources", "sensitive_source_non_local_provider"
#: Noncharacters that mark where a match begins and ends.
OPEN, SHUT = "﷐", "﷑"


def preview(kind: Column, match: Column) -> Column:
    """What may be shown of a match."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    tail = F.right(digits, F.lit(4))
    return F.when((kind == "email") & F.contains(match, F.lit("@")), F.concat(F.substring(match, 1, 1), F.lit("***@"), F.regexp_replace(match, "^[^@]*@", ""))).when((kind == "phone") & (F.length(digits) >= 4), F.concat(F.lit("***-***-"), tail)).when((kind == "ssn") & (F.length(digits) >= 4), F.concat(F.lit("***-**-"), tail)).otherwise("[redacted]")


def _whole(pattern: str, before: str = "", after: str = "") -> str:
    """In groups: what a match takes before itself, the match, and what it takes after."""
    return f"({before})({pattern})({after})"


def matches(text: Column, pattern: str, *around: str) -> Column:
    """Array of (match, char_start, char_end) in order: the text is marked at the matches, and lengths give the places."""
    parts = F.split(F.regexp_replace(text, _whole(pattern, *around), f"$1{OPEN}$2{SHUT}$3"), OPEN, -1)
    size = lambda p, i: F.length(p) - F.when(i > 0, 1).otherwise(0)
    sizes = F.transform(parts, size)
    found = F.transform(parts, lambda p, i: F.struct(F.substring_index(p, SHUT, 1).alias("match"), F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, n: a + n).alias("char_start"), i.alias("i")))
    return F.transform(F.filter(found, lambda x: x["i"] > 0), lambda x: F.struct(x["match"], x["char_start"], (x["char_start"] + F.length(x["match"])).alias("char_end")))


def _record_id(df: DataFrame, artifact: str) -> Column:
    return F.coalesce(F.nullif(F.col(FIELDS[artifact][0]).cast("string"), F.lit("")), F.lit(f"{artifact}:unnamed"))


def pii_findings(df: DataFrame, artifact: str, kinds: tuple[tuple[str, ...], ...] = PII) -> DataFrame:
    """Findings in the text fields of a table: a value that stands several times in a field of a record is found once, at
    its first place. The value itself is not kept, only its hash and a preview. Null and empty texts have none.
    """
    if artifact not in FIELDS:
        raise ValueError(f"findings are made in {', '.join(sorted(FIELDS))}")
    known = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    each = []
    for field in FIELDS[artifact][1]:
        for kind, pattern, _, *around in kinds:
            hit = F.explode(matches(F.coalesce(F.col(field), F.lit("")), pattern, *around)).alias("m")
            each.append(df.select(_record_id(df, artifact).alias("record_id"), known("source_id").alias("source_id"), known("evidence_id").alias("evidence_id"), known("claim_id").alias("claim_id"), F.lit(field).alias("field"), F.lit(kind).alias("pii_type"), hit))
    rows = reduce(DataFrame.unionByName, each).withColumn("match_hash", F.sha2("m.match", 256))
    own = stable_id("pii", artifact=json_string(F.lit(artifact)), record_id=json_string(F.col("record_id")), field=json_string(F.col("field")), pii_type=json_string(F.col("pii_type")), match_hash=json_string(F.col("match_hash")))
    rows = rows.select(own.alias("finding_id"), F.lit(artifact).alias("artifact"), "record_id", "source_id", "evidence_id", "claim_id", "field", "pii_type", "match_hash", preview(F.col("pii_type"), F.col("m.match")).alias("redacted_preview"), F.col("m.char_start").alias("char_start"), F.col("m.char_end").alias("char_end"))
    rest = [c for c in rows.columns if c != "finding_id"]
    return rows.groupBy("finding_id").agg(F.min_by(F.struct(*rest), F.col("char_start")).alias("r")).select("finding_id", "r.*")


def redact(text: Column, kinds: tuple[tuple[str, ...], ...] = PII) -> tuple[Column, Column]:
    """The text with placeholders, and how many there are: one kind after the other, each on what the last one left."""
    n = F.lit(0)
    for _, pattern, to, *around in kinds:
        whole = _whole(pattern, *around)
        n = n + F.regexp_count(text, F.lit(whole))
        text = F.regexp_replace(text, whole, f"$1{to}$3")
    return text, n


def redactions(df: DataFrame, artifact: str, output: str, kinds: tuple[tuple[str, ...], ...] = PII) -> tuple[DataFrame, DataFrame]:
    """The table with redacted text fields; and a row a record with replacements: fields, count and where it is written."""
    out, counts = df, {}
    for field in FIELDS[artifact][1]:
        text, n = redact(F.col(field), kinds)
        out = out.withColumn(f"__n_{field}", F.coalesce(n, F.lit(0))).withColumn(field, text)
        counts[field] = F.col(f"__n_{field}")
    fields = F.array_compact(F.array(*(F.when(n > 0, f) for f, n in counts.items())))
    total = reduce(lambda a, b: a + b, counts.values())
    made = out.withColumn("__fields", fields).withColumn("__total", total)
    known = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    names = F.concat(F.lit("["), F.array_join(F.transform("__fields", json_string), ","), F.lit("]"))
    own = stable_id("redact", artifact=json_string(F.lit(artifact)), record_id=json_string(_record_id(df, artifact)), fields=names, output_path=json_string(F.lit(output)))
    manifest = made.where("__total > 0").select(own.alias("redaction_id"), F.lit(artifact).alias("artifact"), _record_id(df, artifact).alias("record_id"), known("source_id").alias("source_id"), known("evidence_id").alias("evidence_id"), known("claim_id").alias("claim_id"), F.col("__fields").alias("fields"), F.col("__total").alias("replacement_count"), F.lit(output).alias("output_path"))
    return made.select(*df.columns), manifest


# ---- privacy ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PrivacyPolicy:
    """Which metadata make a source sensitive, and which providers are local."""

    enabled: bool = True
    sensitive_keys: tuple[str, ...] = ("contains_sensitive_data", "local_only", "sensitive")
    local_providers: tuple[str, ...] = ("deterministic", "local")


def truthy(text: Column) -> Column:
    """Whether a metadata value, as text, means yes: a number other than 0, or a word for yes. Null means no."""
    low = F.lower(T.strip(text))
    number = low.try_cast("double")
    return F.coalesce(low.isin("1", "true", "yes", "y", "sensitive", "local_only") | (number.isNotNull() & (number != 0)), F.lit(False))


def sensitive_sources(sources: DataFrame, policy: PrivacyPolicy = PrivacyPolicy()) -> DataFrame:
    """source_id and the sorted keys that make it sensitive, from sources with metadata (map of texts)."""
    if not policy.enabled:
        return sources.limit(0).select("source_id", F.array().cast("array<string>").alias("sensitive_metadata_keys"))
    keys = F.array_sort(F.array_compact(F.array(*(F.when(truthy(F.col("metadata")[k]), k) for k in policy.sensitive_keys))))
    return sources.select("source_id", keys.alias("sensitive_metadata_keys")).where(F.size("sensitive_metadata_keys") > 0)


def invocation_decisions(invocations: DataFrame, sources: DataFrame, policy: PrivacyPolicy = PrivacyPolicy()) -> DataFrame:
    """For each invocation (source_id, provider, model) whether the policy allows it: a sensitive source needs a local
    provider. A null or blank provider is unknown, which is not local.
    """
    label = lambda c: F.coalesce(F.nullif(T.strip(F.col(c)), F.lit("")), F.lit("unknown"))
    s = sensitive_sources(sources, policy).withColumnRenamed("source_id", "s")
    j = invocations.join(s, F.col("source_id") == F.col("s"), "left").withColumn("sensitive_metadata_keys", F.coalesce("sensitive_metadata_keys", F.array().cast("array<string>")))
    local = F.lower(label("provider")).isin(*(p.strip().lower() for p in policy.local_providers if p.strip()))
    blocked = (F.size("sensitive_metadata_keys") > 0) & ~local
    rest = [c for c in invocations.columns if c not in ("provider", "model")]
    return j.select(*rest, label("provider").alias("provider"), label("model").alias("model"), (~blocked).alias("allowed"), F.lit(LOCAL_ONLY).alias("policy"), F.when(blocked, NOT_LOCAL).alias("reason_code"), "sensitive_metadata_keys")


def require_allowed(decisions: DataFrame) -> DataFrame:
    """The decisions, if all are allowed; else reading them fails and names the first that isn't."""
    message = F.concat_ws(" ", F.lit("model invocation blocked by"), "policy", F.concat(F.lit("provider="), "provider"), F.concat(F.lit("source_id="), "source_id"), F.concat(F.lit("reason="), "reason_code"))
    return decisions.where(F.when(F.col("allowed"), True).otherwise(F.raise_error(message).cast("boolean")))


def violations(claims: DataFrame, sources: DataFrame, policy: PrivacyPolicy = PrivacyPolicy()) -> DataFrame:
    """Claims of sensitive sources that a provider made which isn't local."""
    d = invocation_decisions(claims.select("claim_id", "source_id", "evidence_id", F.col("model.provider").alias("provider"), F.col("model.model").alias("model")), sources, policy).where(~F.col("allowed"))
    own = stable_id("privacy", claim_id=json_string(F.col("claim_id")), source_id=json_string(F.col("source_id")), provider=json_string(F.col("provider")), model=json_string(F.col("model")), policy=json_string(F.col("policy")))
    return d.select(own.alias("violation_id"), "source_id", "claim_id", "evidence_id", "provider", "model", "policy", "reason_code", "sensitive_metadata_keys").dropDuplicates(["violation_id"])


def retention_plan(sources: DataFrame, now: str, days: int = 365) -> DataFrame:
    """Sources (source_id, source_modality, source_file, ingested_at) that are ``days`` old or older at ``now``."""
    age = F.floor((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("ingested_at")) / 86_400).cast("long")
    own = stable_id("retention", source_id=json_string(F.col("source_id")), retention_days=F.lit(str(days)))
    return sources.withColumn("age_days", age).where(F.col("age_days") >= days).select(own.alias("retention_id"), "source_id", "source_modality", "source_file", "age_days", F.lit(days).alias("retention_days"), F.lit("retention_period_elapsed").alias("reason_code"), F.lit("review_for_deletion").alias("recommended_action"))


# ---- routing ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Routing:
    """When the stronger model is asked, and the names of the models."""

    span_score_lt: float | None = 0.6
    span_flags: tuple[str, ...] = ("context_dependent_coreference",)
    claim_confidence_lt: float | None = 0.65
    claim_modalities: tuple[str, ...] = ("image",)
    claim_flags: tuple[str, ...] = ("speaker_uncertain", "weak_cluster_margin")
    extraction: tuple[str, str] = ("cheap_structured_json_model", "strong_reasoning_model")
    validation: tuple[str, str] = ("cheap_validator_model", "strong_validator_model")


def _route(df: DataFrame, stage: str, kind: str, id_: str, role: str, score: str, reasons: Column, models: tuple[str, str]) -> DataFrame:
    tier = F.when(F.size("reasons") > 0, "strong").otherwise("default")
    model = F.when(F.size("reasons") > 0, models[1]).otherwise(models[0])
    listed = F.concat(F.lit("["), F.array_join(F.transform("reasons", json_string), ","), F.lit("]"))
    own = stable_id("route", stage=json_string(F.lit(stage)), record_type=json_string(F.lit(kind)), record_id=json_string(F.col(id_)), selected_model=json_string(model), reasons=listed)
    return df.withColumn("reasons", reasons).select(own.alias("routing_id"), F.lit(stage).alias("stage"), F.lit(kind).alias("record_type"), F.col(id_).alias("record_id"), "source_id", "source_modality", F.lit(role).alias("model_role"), tier.alias("selected_tier"), model.alias("selected_model"), "reasons", F.col(score).alias("score"))


def _flagged(flags: tuple[str, ...]) -> Column:
    return F.transform(F.array_sort(F.filter(F.coalesce("risk_flags", F.array().cast("array<string>")), lambda f: f.isin(*flags))), lambda f: F.concat(F.lit("risk_flag:"), f))


def route(spans: DataFrame | None, claims: DataFrame | None, rules: Routing = Routing()) -> DataFrame:
    """Which model each span and each claim should go to, and why; either table may be left out."""
    none = F.array().cast("array<string>")
    below = lambda c, x, name: none if x is None else F.when(F.col(c) < x, F.array(F.lit(f"{name}:{x}"))).otherwise(none)
    out = []
    if spans is not None:
        out.append(_route(spans, "extract_claims", "span", "span_id", "extraction", "score", F.concat(below("score", rules.span_score_lt, "span_score_lt"), _flagged(rules.span_flags)), rules.extraction))
    if claims is not None:
        modal = F.when(F.col("source_modality").isin(*rules.claim_modalities), F.array(F.concat(F.lit("modality:"), "source_modality"))).otherwise(none)
        out.append(_route(claims, "validate_claims", "claim_raw", "claim_id", "validation", "confidence", F.concat(below("confidence", rules.claim_confidence_lt, "raw_claim_confidence_lt"), modal, _flagged(rules.claim_flags)), rules.validation))
    return reduce(DataFrame.unionByName, out)
