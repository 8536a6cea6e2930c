"""Counters and rates of a run, as one table and as Markdown; export of tables into SQLite."""

from __future__ import annotations

import sqlite3

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.operators import validate


def counters(validated: DataFrame, normalized: DataFrame) -> DataFrame:
    """counter, value, n: how often each value occurs in the columns that reports list."""
    def count(df, column):
        return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(column).alias("counter"), "value", "n")
    out = count(validated, "modality").union(count(validated, "truth_status")).union(count(validated, "status"))
    out = out.union(validate.quarantine_reasons(validated).select(F.lit("reason"), "reason", "claims"))
    return out.union(count(normalized, "predicate"))


def quality_rates(validated: DataFrame, normalized: DataFrame) -> DataFrame:
    """rate, value: shares of 1, null where nothing is to be counted."""
    share = lambda test: F.avg(F.when(test, 1.0).otherwise(0.0))
    has = lambda code: F.array_contains(F.split("errors", ","), code)
    v = validated.agg(
        share(~has("evidence_not_exact_substring")).alias("exact_evidence"), share(F.col("status") == "quarantined").alias("quarantine"), share(has("unsupported_entities_introduced")).alias("unsupported_entity"),
        share(~has("negation_dropped")).alias("negation_preserved"), share(~has("uncertainty_dropped")).alias("uncertainty_preserved"), share(~has("quantity_mismatch")).alias("quantity_preserved"), share(~has("attribution_agent_mismatch")).alias("attribution_preserved"))
    rates = v.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, v.columns)), F.array(*v.columns))).alias("rate", "value"))
    groups = validate.duplicate_groups(normalized, singletons=True)
    duplicates = groups.agg((F.sum(F.when(F.col("members") > 1, F.col("members")).otherwise(0)) / F.sum("members")).alias("value")).select(F.lit("duplicate").alias("rate"), "value")
    return rates.union(duplicates).select("rate", F.round("value", 6).alias("value"))


def job_rates(jobs: DataFrame, validated: DataFrame) -> DataFrame:
    """Cost of an accepted claim and seconds of a source, from jobs (source_id, cost_usd, latency_seconds); null if unknown."""
    accepted = validated.agg(F.count_if(F.col("status") == "accepted_extracted").alias("accepted"))
    both = jobs.agg(F.sum("cost_usd").alias("cost"), F.sum("latency_seconds").alias("seconds"), F.count_distinct("source_id").alias("sources")).crossJoin(accepted)
    part = lambda a, b: F.try_divide(F.col(a), F.nullif(F.col(b), F.lit(0)))
    return both.select(F.round(part("cost", "accepted"), 4).alias("cost_per_accepted_claim"), F.round(part("seconds", "sources"), 2).alias("latency_per_source"))


def markdown(tables: dict[str, DataFrame]) -> str:
    """Report tables (a row a counter, a rate or a check) under headings, rows in order of their values."""
    out = []
    for title, df in tables.items():
        out += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if x is None else str(x).replace("|", "\\|").replace("\n", " ") for x in row) + " |" for row in df.orderBy(*df.columns).toLocalIterator()] + [""]
    return "\n".join(out)


def export_sqlite(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Write (record_key, line_number, payload_json) tables and their counts; a repeated key keeps its last row.

    Rows stream through the driver a partition at a time: a SQLite file has one writer.
    """
    counts = {}
    with sqlite3.connect(path) as db:
        for name, df in tables.items():
            db.execute(f'DROP TABLE IF EXISTS "{name}"')
            db.execute(f'CREATE TABLE "{name}" (record_key TEXT PRIMARY KEY, line_number INTEGER, payload_json TEXT)')
            counts[name] = 0
            for row in df.select("record_key", "payload_json").toLocalIterator():
                counts[name] += 1
                db.execute(f'INSERT OR REPLACE INTO "{name}" VALUES (?, ?, ?)', (row[0], counts[name], row[1]))
        db.execute("DROP TABLE IF EXISTS artifact_counts")
        db.execute("CREATE TABLE artifact_counts (name TEXT PRIMARY KEY, count INTEGER)")
        db.executemany("INSERT INTO artifact_counts VALUES (?, ?)", counts.items())
    return counts
