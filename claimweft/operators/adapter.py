"""Extraction of JSON by a provider: requests go in, payloads come back, schemas are checked; providers are plug-ins.

A provider is a function from a list of requests (dicts with prompt, schema_name, provider, model, metadata) to a list of
payloads (dicts). It runs on the executors, a batch at a time. The only one that comes with the package is deterministic:
it gives back the payload that stands in the request's metadata.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Provider = Callable[[list[dict]], list[dict]]


def deterministic(requests: list[dict]) -> list[dict]:
    """The payloads that the requests carry."""
    out = []
    for r in requests:
        if r.get("provider") not in ("deterministic", None):
            raise ValueError(f"the deterministic provider can't answer for {r['provider']}")
        if not isinstance(r.get("metadata"), dict) or not isinstance(r["metadata"].get("payload"), dict):
            raise ValueError("a deterministic request must carry its payload")
        out.append(r["metadata"]["payload"])
    return out


def check(payload: object, required: tuple[str, ...], known: tuple[str, ...] | None) -> None:
    """Fails for a payload that is no object, lacks a field, or has one that isn't known."""
    if not isinstance(payload, dict):
        raise ValueError("a payload must be a JSON object")
    if missing := [k for k in required if payload.get(k) is None]:
        raise ValueError(f"a payload lacks {', '.join(missing)}")
    if known is not None and (extra := sorted(set(payload) - set(known))):
        raise ValueError(f"a payload has unknown fields: {', '.join(extra)}")


def extract(requests: DataFrame, provider: Provider = deterministic, required: tuple[str, ...] = (), known: tuple[str, ...] | None = None) -> DataFrame:
    """request_id and payload (JSON with sorted keys) for requests (request_id, request as JSON). An invalid payload fails.

    No retries and no network here: these are a provider's own affair. Null requests fail, an empty table gives none.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

    def run(batches):
        for batch in batches:
            asked = [json.loads(r) for r in batch["request"]]
            got = provider(asked)
            if len(got) != len(asked):
                raise ValueError("a provider must answer every request")
            for p in got:
                check(p, required, known)
            yield pd.DataFrame({"request_id": batch["request_id"], "payload": [json.dumps(p, sort_keys=True, ensure_ascii=False) for p in got]})

    return requests.select("request_id", F.col("request")).mapInPandas(run, "request_id string, payload string")


def prompt(template: str, span: DataFrame, evidence: DataFrame) -> DataFrame:
    """request_id and prompt: a template, the span and its evidence as JSON, and what is to come back."""
    e = evidence.select(F.col("evidence_id").alias("e"), F.to_json(F.struct(*evidence.columns)).alias("evidence_json"))
    j = span.withColumn("span_json", F.to_json(F.struct(*span.columns))).join(e, F.col("evidence_id") == F.col("e"))
    context = F.concat(F.lit('{"evidence":'), "evidence_json", F.lit(',"span":'), "span_json", F.lit("}"))
    return j.select(F.col("span_id").alias("request_id"), F.concat_ws("\n\n", F.lit(template), F.lit("The span and its evidence:"), context, F.lit("Answer with one JSON object, a raw claim.")).alias("prompt"))
