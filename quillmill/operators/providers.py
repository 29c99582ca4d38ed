"""External recognition and language services: contracts, retries, bounded concurrency, cache, ledger, verifier.

A provider is any object that meets a contract. Requests are rows; a task sends its rows with a bounded number
under way at once. Every answer, failures too, is a row of the ledger, so a job that is run again finds what was paid for.
"""

from __future__ import annotations

import asyncio
import random
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.text import cache_key
from quillmill.operators import recognition
from quillmill.operators.graph import cut
from quillmill.operators.understanding import cited_in_order
from quillmill.schemas import SCORE
from quillmill.sources import files


@dataclass(frozen=True)
class Result:
    """What a service gives for one request, free of any vendor's types."""

    content: str
    raw_score: float | None
    request_id: str
    latency: float | None = None
    tokens: int | None = None
    cost: float | None = None


class ProviderError(Exception):
    """A failed call: kind is timeout, reset, contract, or an HTTP status."""

    def __init__(self, kind: str | int):
        super().__init__(str(kind))
        self.kind = str(kind)


class Provider(Protocol):
    name: str
    model: str


class TextOCR(Provider, Protocol):
    async def recognize(self, image: bytes) -> Result: ...


class FormulaOCR(Provider, Protocol):
    async def recognize(self, image: bytes) -> Result: ...


class TableRecognition(Provider, Protocol):
    async def recognize(self, image: bytes) -> Result: ...


class Vision(Provider, Protocol):
    async def recognize(self, image: bytes) -> Result: ...


class LLM(Provider, Protocol):
    async def recognize(self, prompt: bytes) -> Result: ...


def retryable(kind: str) -> bool:
    """Timeouts, resets, 429 and 5xx pass; everything else fails at once."""
    return kind in ("timeout", "reset", "429") or len(kind) == 3 and kind.startswith("5")


async def attempted(provider, payload: bytes, tries: int, delay: float, limit: float) -> tuple[Result | None, str | None]:
    """(result, None) or (None, kind of the last failure), with exponential back-off and jitter between tries."""
    kind = None
    for attempt in range(tries):
        try:
            result = await asyncio.wait_for(provider.recognize(payload), limit)
            if not isinstance(result, Result) or not isinstance(result.content, str) or not result.request_id:
                return None, "contract"
            return result, None
        except (TimeoutError, ConnectionResetError, ProviderError) as error:
            kind = error.kind if isinstance(error, ProviderError) else "timeout" if isinstance(error, TimeoutError) else "reset"
        if not retryable(kind) or attempt + 1 == tries:
            break
        await asyncio.sleep(delay * 2**attempt * (0.5 + random.random()))
    return None, kind


LEDGER = "cache_key string, provider string, model string, request_id string, prompt_version string, task string, latency double, tokens long, cost double, raw_score decimal(9,6), content string, error string"


def call(requests: DataFrame, provider, concurrency: int, tasks: int | None = None, tries: int = 4, delay: float = 0.5, limit: float = 60.0) -> DataFrame:
    """Ledger rows, one for each of requests (cache_key, task, prompt_version, payload).

    The requests go to `tasks` tasks (as many as there are cores, if not said), each with concurrency / tasks calls
    under way at once, so all together keep to the provider's limit. A task holds the calls under way and one batch.
    """
    tasks = max(1, min(tasks or requests.sparkSession.sparkContext.defaultParallelism, concurrency))
    each = max(1, concurrency // tasks)

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from decimal import Decimal

        async def one(gate, row):
            async with gate:
                began = time.monotonic()
                result, error = await attempted(provider, bytes(row.payload), tries, delay, limit)
                took = result.latency if result and result.latency is not None else time.monotonic() - began
                score = None if result is None or result.raw_score is None else Decimal(str(round(result.raw_score, 6)))
                told = (None, None, None, None) if result is None else (result.request_id, result.tokens, result.cost, result.content)
                return (row.cache_key, provider.name, provider.model, told[0], row.prompt_version, row.task, took, told[1], told[2], score, told[3], error)

        async def every(batch):
            gate = asyncio.Semaphore(each)
            return await asyncio.gather(*[one(gate, row) for row in batch.itertuples(index=False)])

        names = [c.split()[0] for c in LEDGER.split(", ")]
        for batch in batches:
            yield pd.DataFrame(asyncio.run(every(batch)), columns=names).astype({"tokens": "Int64"})

    return requests.select("cache_key", "task", "prompt_version", "payload").repartition(tasks).mapInPandas(sent, LEDGER)


class Ledger:
    """One table of all calls of all runs, which only grows. A call's row is there before anything is made of it."""

    def __init__(self, spark: SparkSession, path: str, more: DataFrame | None = None):
        self.spark, self.path, self.more = spark, path, more

    def read(self) -> DataFrame:
        kept = self.spark.read.schema(f"{LEDGER}, part string").parquet(self.path) if files.exists(self.path) else self.spark.createDataFrame([], f"{LEDGER}, part string")
        return kept if self.more is None else kept.unionByName(self.more.drop("cache_hit").withColumn("part", F.lit("given")), allowMissingColumns=True)

    def append(self, made: DataFrame) -> DataFrame:
        """Write rows, and give them back as they were written."""
        part = uuid.uuid4().hex
        made.withColumn("part", F.lit(part)).write.mode("append").parquet(self.path)
        return self.read().where(F.col("part") == part).drop("part")


#: Requests that are sent before their answers are written to a kept ledger: what a run that stops may have to send again.
ROUND = 10_000


def through(requests: DataFrame, ledger: Ledger | DataFrame | None, provider, concurrency: int, **options) -> DataFrame:
    """Ledger rows for requests (content_hash, task, prompt_version, payload): from the ledger where it has a good one, else by calls.

    Equal requests are one call. Any other version is another key. New rows are written to a kept ledger round by
    round, or else cut off from their lineage, so that nothing later sends a call again.
    """
    if isinstance(ledger, Ledger):
        return _kept(requests, ledger, provider, concurrency, **options)
    key = cache_key(F.col("content_hash"), F.lit(provider.name), F.lit(provider.model), F.col("prompt_version"), F.col("task"))
    keyed = requests.withColumn("cache_key", key).dropDuplicates(["cache_key"])
    if ledger is None:
        return cut(call(keyed, provider, concurrency, **options)).withColumn("cache_hit", F.lit(False))
    good = ledger.where("error IS NULL").dropDuplicates(["cache_key"])
    hits = good.join(keyed.select("cache_key"), "cache_key", "left_semi").withColumn("cache_hit", F.lit(True))
    missing = keyed.join(good.select("cache_key"), "cache_key", "left_anti")
    made = cut(call(missing, provider, concurrency, **options)).withColumn("cache_hit", F.lit(False))
    return hits.select(*made.columns).unionByName(made)  # a ledger may have more columns: what was made of its rows


def _kept(requests: DataFrame, ledger: Ledger, provider, concurrency: int, **options) -> DataFrame:
    key = cache_key(F.col("content_hash"), F.lit(provider.name), F.lit(provider.model), F.col("prompt_version"), F.col("task"))
    keyed = requests.withColumn("cache_key", key).dropDuplicates(["cache_key"])
    before = cut(ledger.read().where("error IS NULL").drop("part").join(keyed.select("cache_key"), "cache_key", "left_semi").dropDuplicates(["cache_key"]))
    missing = cut(keyed.join(before.select("cache_key"), "cache_key", "left_anti").select("cache_key", "task", "prompt_version", "payload"))
    made, rounds = before.withColumn("cache_hit", F.lit(True)), -(-missing.count() // ROUND)
    for r in range(rounds):
        some = missing.where(F.pmod(F.xxhash64("cache_key"), F.lit(rounds)) == r)
        made = made.unionByName(ledger.append(call(some, provider, concurrency, **options)).withColumn("cache_hit", F.lit(False)))
    return made


def recognised(assets: DataFrame, primary, fallback, calibration: DataFrame, ledger: Ledger | DataFrame | None, concurrency: int, prompt_version: str = "v1", **options) -> tuple[DataFrame, DataFrame]:
    """(settled results by block_id, calls) for assets (block_id, task, is_critical, content).

    The fallback gets only what the accept ladder leaves open after the primary. Calls are ledger rows with their
    normalized_score and, for the fallback's, fallback_reason: LOW_SCORE, as no other result is asked again.
    """
    requests = assets.withColumns({"content_hash": F.sha2("content", 256), "payload": F.col("content"), "prompt_version": F.lit(prompt_version)})

    def asked(rows: DataFrame, provider, reason: str | None) -> tuple[DataFrame, DataFrame]:
        made = through(rows, ledger, provider, concurrency, **options)
        key = cache_key(F.col("content_hash"), F.lit(provider.name), F.lit(provider.model), F.col("prompt_version"), F.col("task"))
        back = rows.select("block_id", "is_critical", key.alias("cache_key")).join(made, "cache_key")
        return recognition.calibrated(back, calibration), recognition.calibrated(made, calibration).withColumn("fallback_reason", F.lit(reason).cast("string"))

    first, calls = asked(requests, primary, None)
    if fallback is not None:
        open_ = first.where(recognition.ladder(F.col("normalized_score"), F.col("is_critical")) == "fallback").select("block_id")
        second, more = asked(requests.join(open_, "block_id", "left_semi"), fallback, "LOW_SCORE")
        first, calls = first.unionByName(second), calls.unionByName(more)
    return recognition.settled(first), calls


def verdicts(pairs: DataFrame, verifier, ledger: Ledger | DataFrame | None, prompt: str, prompt_version: str, concurrency: int, **options) -> tuple[DataFrame, DataFrame]:
    """((question_id, answer_id, verdict, verifier_score, reason, cache_key), ledger rows) for pairs (question_id, answer_id, question, answer, block_ids).

    The verifier answers in JSON with the fields verdict, score, reason and cited_blocks alone. Any other field, a
    verdict that is not listed, or cited blocks that the pair does not have make the verdict FAIL.
    """
    said = F.to_json(F.struct("question", "answer", "block_ids"))
    asked = pairs.withColumns({"payload": F.encode(F.concat(F.lit(prompt + "\n"), said), "UTF-8"), "task": F.lit("answer_verify"), "prompt_version": F.lit(prompt_version)})
    asked = asked.withColumn("content_hash", F.sha2("payload", 256))
    made = through(asked, ledger, verifier, concurrency, **options)
    key = cache_key(F.col("content_hash"), F.lit(verifier.name), F.lit(verifier.model), F.col("prompt_version"), F.col("task"))
    back = asked.select("question_id", "answer_id", "block_ids", key.alias("cache_key")).join(made.select("cache_key", "content"), "cache_key", "left")
    return back.select("question_id", "answer_id", *_verdict(F.col("content"), F.col("block_ids")), "cache_key"), made


def _verdict(content: Column, ids: Column) -> list[Column]:
    fields = F.json_object_keys(content)
    told = F.from_json(content, "verdict string, score decimal(9,6), reason string, cited_blocks array<string>")
    legal = (F.size(F.array_except(fields, F.array(*map(F.lit, ("verdict", "score", "reason", "cited_blocks"))))) == 0) & told["verdict"].isin("PASS", "FAIL") & cited_in_order(told["cited_blocks"], ids)
    legal = F.coalesce(legal, F.lit(False))
    return [F.when(legal, told["verdict"]).otherwise("FAIL").alias("verdict"), F.when(legal, told["score"].cast(SCORE)).alias("verifier_score"), told["reason"].alias("reason")]


def boundaries(documents: DataFrame, model, ledger: Ledger | DataFrame | None, prompt: str, prompt_version: str, concurrency: int, **options) -> tuple[DataFrame, DataFrame]:
    """((document_id, proposal_id, first, last), ledger rows): the questions that a model proposes for documents (document_id, blocks array of block_id and raw_text).

    The model answers in JSON with the field questions alone, each with first and last alone, ids of blocks. Anything else
    is no proposal. Whether proposals can be taken is splitting.interval_faults' to say; no text of a model is used.
    """
    asked = documents.withColumns({"payload": F.encode(F.concat(F.lit(prompt + "\n"), F.to_json(F.struct("blocks"))), "UTF-8"), "task": F.lit("question_split"), "prompt_version": F.lit(prompt_version)})
    asked = asked.withColumn("content_hash", F.sha2("payload", 256))
    made = through(asked, ledger, model, concurrency, **options)
    key = cache_key(F.col("content_hash"), F.lit(model.name), F.lit(model.model), F.col("prompt_version"), F.col("task"))
    back = asked.select("document_id", key.alias("cache_key")).join(made.select("cache_key", "content"), "cache_key")
    told = F.from_json("content", "questions array<map<string, string>>")["questions"]
    fields = F.array(F.lit("first"), F.lit("last"))
    legal = (F.json_object_keys("content") == F.array(F.lit("questions"))) & F.forall(told, lambda q: F.array_sort(F.map_keys(q)) == fields)
    each = back.select("document_id", F.posexplode(F.when(legal, told)).alias("at", "q"))
    return each.select("document_id", F.concat_ws("_p", "document_id", "at").alias("proposal_id"), F.col("q")["first"].alias("first"), F.col("q")["last"].alias("last")), made
