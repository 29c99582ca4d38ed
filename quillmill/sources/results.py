"""Result files: image files and the run report."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.operators import report
from quillmill.sources import files


def write_images(assets: DataFrame, questions: DataFrame, folder: str) -> int:
    """Write each image that an accepted question shows to the folder, once, and return how many there are.

    The folder is one that all executors share. A file appears whole or not at all, and a task that runs again
    writes the same bytes.
    """
    named = questions.select(F.explode(F.regexp_extract_all("text_question", F.lit(r'<img src="image/(img_[0-9a-f]+)\.'), F.lit(1))).alias("asset_id")).distinct()

    folder = files.qualified(folder)

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, ext, content in zip(batch["asset_id"], batch["ext"], batch["content"], strict=True):
                files.write(f"{folder}/{name}.{ext}", content)
            yield pd.DataFrame({"n": [len(batch)]})

    return assets.join(named, "asset_id", "left_semi").select("asset_id", "ext", "content").mapInPandas(written, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def run_report(outcomes: DataFrame, n_documents: int, ledger: DataFrame | None, seconds: float, meta: dict) -> dict:
    """Counts of a run: documents, candidates, reasons, calls by task, cache hits, errors, fallbacks, time, tokens, cost. All are aggregates."""
    out = {**meta, "documents": n_documents, **report.acceptance(outcomes).first().asDict(), "reasons": {r.reason_code: r.n for r in outcomes.where("reason_code IS NOT NULL").groupBy("reason_code").agg(F.count("*").alias("n")).orderBy("reason_code").collect()}}
    calls = []
    if ledger is not None:
        ledger = ledger if "fallback_reason" in ledger.columns else ledger.withColumn("fallback_reason", F.lit(None).cast("string"))
        sums = ledger.groupBy("task", "provider").agg(
            F.count_if(F.col("fallback_reason").isNotNull()).alias("fallbacks"),
            F.count_if(~F.col("cache_hit")).alias("calls"), F.round(F.avg(F.col("cache_hit").cast("double")), 6).alias("cache_hit_rate"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.round(F.sum("latency"), 3).alias("seconds"),
            F.round(F.avg("latency"), 4).alias("mean_seconds"), F.sum("tokens").alias("tokens"), F.round(F.sum("cost"), 6).alias("cost"),
        )
        calls = [r.asDict() for r in sums.orderBy("task", "provider").collect()]
    return {**out, "calls": calls, "seconds": round(seconds, 3)}


def write_json(value: dict, path: str) -> None:
    """Write a small value as one file, whole or not at all."""
    files.write(path, (json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2, default=str) + "\n").encode())
