"""Run state, provider cache and result files, as tables that only grow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Legal moves between the states of a stage.
MOVES = {("PENDING", "RUNNING"), ("RUNNING", "COMPLETED"), ("RUNNING", "FAILED"), ("RUNNING", "REJECTED"), ("FAILED", "RUNNING")}


def fingerprint(files: DataFrame, config_hash: str, version: str) -> str:
    """One hash of the inputs (by their digests, in any order), the configuration and the version."""
    per_file = files.select(F.xxhash64("source_sha256").cast("decimal(38,0)").alias("h"))
    total = per_file.agg(F.count("*").alias("n"), F.sum("h").alias("s")).select(F.sha2(F.concat_ws("\x00", "n", "s", F.lit(config_hash), F.lit(version)), 256)).first()[0]
    return total


def latest(states: DataFrame) -> DataFrame:
    """The last state of each (run_id, stage, item)."""
    return states.groupBy("run_id", "stage", "item").agg(F.max_by("state", "seq").alias("state"), F.max("seq").alias("seq"))


def first_incomplete(states: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """(run_id, first_open): of each run the first stage, in this order, that it has not completed for all items it has there; null if none."""
    done = latest(states).groupBy("run_id", "stage").agg(F.bool_and(F.col("state") == "COMPLETED").alias("done"))
    whole = done.groupBy("run_id").agg(F.collect_set(F.when(F.col("done"), F.col("stage"))).alias("whole"))
    return whole.select("run_id", F.get(F.array_except(F.array(*map(F.lit, stages)), "whole"), F.lit(0)).alias("first_open"))


def illegal(states: DataFrame) -> DataFrame:
    """Rows whose state may not follow the one before it."""
    before = F.coalesce(F.lag("state").over(W.partitionBy("run_id", "stage", "item").orderBy("seq")), F.lit("PENDING"))
    legal = F.concat_ws(">", before, "state").isin([">".join(m) for m in sorted(MOVES)]) | ((F.col("state") == "PENDING") & (before == "PENDING"))
    row = F.struct(*[F.col(f"`{c}`") for c in states.columns]).alias("row")
    return states.select(row, legal.alias("legal")).where("NOT legal").select("row.*")


def pending(items: DataFrame, states: DataFrame, stage: str, run_id: str) -> DataFrame:
    """The items that the stage has not completed: what a resumed run does."""
    done = latest(states.where((F.col("stage") == stage) & (F.col("run_id") == run_id))).where("state = 'COMPLETED'").select("item")
    return items.join(done, "item", "left_anti")


def through_cache(requests: DataFrame, cache: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """(hits with their payload, misses): requests looked up by a key that holds all versions."""
    keyed = requests.withColumn("cache_key", key)
    return keyed.join(cache.select("cache_key", "payload"), "cache_key"), keyed.join(cache.select("cache_key"), "cache_key", "left_anti")
