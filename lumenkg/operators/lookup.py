"""External calls as joins against stored responses.

Requests are keyed, deduplicated and answered from a response table. What it
doesn't hold is either left unanswered (replay) or asked through a client once
per key; answers are written before anything reads them, so that no re-run of a
task or plan repeats a paid call.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESPONSE = "api string, key string, body string, status string, attempts int"
#: Responses with what each attempt came to; ``preview`` is the beginning of an answer that couldn't be used.
TRACED = RESPONSE + ", trace array<struct<attempt:int,status:string,error:string,preview:string>>"
#: Models are asked for JSON by these requests (expansion rounds are numbered); others may answer anything but nothing.
OBJECT_APIS = ("detect", "triples", "cross_plan", "cross_triples", "expand_plan", "expand_triples", "canonical_names", "aliases")
ARRAY_APIS = ("questions",)
PREVIEW = 240


def holds_json(raw: str) -> bool:
    """Does a model's answer hold JSON: in a code fence, or from the first brace to the one that closes it?"""
    text = raw.strip()
    if text.startswith("```") and "\n" not in text:
        return False
    start = text.find("{")
    # braces open after each place; those inside strings count, as for the column function that reads the answers
    depth = list(accumulate((c == "{") - (c == "}") for c in text[start:])) if start >= 0 else []
    block = text[start : start + depth.index(0) + 1] if 0 in depth else None
    fenced = text.partition("\n")[2].removesuffix("```").strip() if text.startswith("```") else None
    return _parses(fenced) or _parses(block)


def holds_array(raw: str) -> bool:
    """As ``holds_json``; from the first square bracket to the last comes first."""
    grabbed = re.search(r"\[.*\]", raw, re.DOTALL)
    return _parses(grabbed and grabbed[0]) or holds_json(raw)


def _parses(text: str | None) -> bool:
    try:
        return text is not None and json.loads(text) is not None
    except ValueError:
        return False


def usable(api: str, body: str | None) -> str:
    """Status of an answer: ``ok``, ``empty_response`` or ``json_parse_failed``."""
    name = re.sub(r"_\d+$", "", api)
    holds = holds_json if name in OBJECT_APIS else holds_array if name in ARRAY_APIS else None
    if holds and not (body or "").strip():
        return "empty_response"
    return "ok" if holds is None or holds(body) else "json_parse_failed"


def misses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """One request per (api, key) that has no stored response."""
    asked = requests.groupBy("api", "key").agg(F.min("payload").alias("payload"))
    return asked.join(responses.filter("status = 'ok'").select("api", "key"), ["api", "key"], "left_anti")


def answered(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with the body of their response, null where there is none."""
    stored = responses.filter("status = 'ok'").select("api", "key", "body")
    return requests.join(stored, ["api", "key"], "left")


def call_missing(
    missing: DataFrame, client: Callable[[], Callable[[str, str], str]], callers: int, retries: int = 3, pause: float = 0.0, check: Callable[[str, str | None], str] = usable
) -> DataFrame:
    """Responses to ``missing`` through a client made once per partition; at most ``callers`` partitions call at a time.

    A call is repeated, ``retries`` times at most, until it doesn't fail and ``check`` finds its answer usable. ``trace`` has a
    row per attempt: ``call_error`` with the error, or what ``check`` said. What stays without a usable answer gives a row
    with its last status and no body; it never fails the task.
    """

    def attempt(ask: Callable[[str, str], str], api: str, payload: str) -> tuple[str | None, str, str, str | None]:
        """(body, status of the response, status of the attempt, error)"""
        try:
            body = ask(api, payload)
        except Exception as error:  # kept as data: one bad call must not stop the others
            said = f"{type(error).__name__}: {error}"
            return None, said, "call_error", said
        status = check(api, body)
        return body, status, status, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        ask = client()
        for batch in batches:
            rows = []
            for api, key, payload in zip(batch["api"], batch["key"], batch["payload"]):
                body, status, trace = None, "none", []
                while len(trace) < retries and status != "ok":
                    body, status, told, error = attempt(ask, api, payload)
                    trace.append({"attempt": len(trace) + 1, "status": told, "error": error, "preview": (body or "")[:PREVIEW].replace("\n", " ") if told == "json_parse_failed" else None})
                    if status != "ok":
                        body = None
                        time.sleep(pause * len(trace))
                rows.append((api, key, body, status, len(trace), trace))
            yield pd.DataFrame(rows, columns=["api", "key", "body", "status", "attempts", "trace"])

    return missing.select("api", "key", "payload").repartition(callers).mapInPandas(run, TRACED)


def attempts(responses: DataFrame) -> DataFrame:
    """(api, key, attempt, status, error, preview): one row per attempt of the traced responses."""
    return responses.select("api", "key", F.explode("trace").alias("t")).select("api", "key", "t.*")


def refresh(requests: DataFrame, store: str, client, callers: int) -> DataFrame:
    """Append responses to what ``store`` (a Parquet path) lacks, then answer the requests from it."""
    spark = requests.sparkSession
    stored = spark.read.schema(TRACED).parquet(store)
    call_missing(misses(requests, stored), client, callers).write.mode("append").parquet(store)
    return answered(requests, spark.read.schema(TRACED).parquet(store))
