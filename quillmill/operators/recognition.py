"""Recognition results: routes, calibrated scores, the accept ladder, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.operators.calibration import read_off
from quillmill.schemas import SCORE

#: Which service takes an image of a class.
ROUTES = {"TEXT_IMAGE": "text_ocr", "FORMULA_IMAGE": "formula", "TABLE_IMAGE": "table", "QUESTION_SCREENSHOT": "vision_llm", "MIXED": "multimodal", "UNKNOWN": "multimodal"}


def route(image_class: Column) -> Column:
    """Figures of all kinds are kept as images and described."""
    return F.coalesce(*[F.when(image_class == k, F.lit(v)) for k, v in ROUTES.items()], F.when(image_class.isNotNull(), F.lit("keep_vision")), F.lit("multimodal"))


def ladder(score: Column, critical: Column, noncritical_accept: str = "0.95", critical_accept: str = "0.98", floor: str = "0.90") -> Column:
    """accept, fallback or reject. Scores are decimals, so the edges are exact. No score is no trust."""
    s, d = score.cast(SCORE), lambda v: F.lit(v).cast(SCORE)
    needed = F.when(F.coalesce(critical, F.lit(True)), d(critical_accept)).otherwise(d(noncritical_accept))
    return F.when(s.isNull() | (s < d(floor)), "reject").when(s >= needed, "accept").otherwise("fallback")


def calibrated(results: DataFrame, calibration: DataFrame) -> DataFrame:
    """results with normalized_score of its (provider, model, task), null without a calibration, or without a score.

    A calibration is a row of calibration.KNOTS, whose knots are read off piecewise, or has slope and shift: slope * raw + shift.
    """
    if "knots" in calibration.columns:
        joined = results.join((calibration.select("provider", "model", "task", "knots")), ["provider", "model", "task"], "left")
        return joined.withColumn("normalized_score", read_off(F.col("knots"), F.col("raw_score"))).drop("knots")
    joined = results.join(calibration.select("provider", "model", "task", "slope", "shift"), ["provider", "model", "task"], "left")
    value = F.least(F.lit(1).cast(SCORE), F.greatest(F.lit(0).cast(SCORE), (F.col("slope") * F.col("raw_score") + F.col("shift")).cast(SCORE)))
    return joined.withColumn("normalized_score", F.when(F.col("slope").isNotNull(), value)).drop("slope", "shift")


def settled(results: DataFrame, high: str = "0.95") -> DataFrame:
    """(block_id, content, normalized_score, action): the decision for each block over all its results.

    Two different contents with a high score are a conflict, which is rejected; the higher one does not win.
    """
    score, good = F.col("normalized_score").cast(SCORE), F.lit(high).cast(SCORE)
    best = results.groupBy("block_id").agg(
        F.count_distinct(F.when(score >= good, F.col("content"))).alias("contents"), F.max_by("content", score).alias("content"), F.max(score).alias("normalized_score"), F.bool_or("is_critical").alias("is_critical"), F.count("*").alias("calls"),
    )
    step = ladder(F.col("normalized_score"), F.col("is_critical"))
    action = F.when(F.col("contents") > 1, "reject").when((step == "fallback") & (F.col("calls") > 1), "reject").otherwise(step)
    return best.select("block_id", "content", "normalized_score", action.alias("action"))
