"""Calibration of providers' scores by isotonic regression over binned counts, versioned and piecewise linear."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.schemas import SCORE

KEY = ("provider", "model", "task")
KNOTS = "provider string, model string, task string, version string, knots array<struct<at: decimal(9,6), value: decimal(9,6)>>, n long"


def pooled(points: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """(score, n, right) by rising score, with neighbours pooled whose shares of right ones fall; a pool's score is the mean of its members'.

    This is the isotonic regression of the shares, weighted by n. Shares are compared as whole numbers, so ties are exact.
    """
    stack: list[list] = []
    for at, n, right in points:
        stack.append([at * n, n, right])
        while len(stack) > 1 and stack[-2][2] * stack[-1][1] >= stack[-1][2] * stack[-2][1]:
            last = stack.pop()
            stack[-1] = [x + y for x, y in zip(stack[-1], last, strict=True)]
    return [(total / n, n, right) for total, n, right in stack]


def fit(labelled: DataFrame, version: str, bins: int = 1000) -> DataFrame:
    """A row of KNOTS for each (provider, model, task) of labelled (provider, model, task, raw_score, correct).

    Scores, in 0 to 1, are counted in `bins` bins of equal width, so what is fitted is bounded by the bins whatever the number of
    results. A bin's score is the mean of its results'. Null scores or labels do not count. An empty table gives none.
    """
    score = F.col("raw_score").cast(SCORE)
    rows = labelled.where("raw_score IS NOT NULL AND correct IS NOT NULL").withColumn("bin", F.least(F.floor(score * bins), F.lit(bins - 1)))
    counted = rows.groupBy(*KEY, "bin").agg(F.avg(score).cast("double").alias("at"), F.count("*").alias("n"), F.count_if("correct").alias("right"))

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        exact = lambda x: Decimal(str(x)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        knots = [{"at": exact(at), "value": exact(right / n)} for at, n, right in pooled(list(zip(group["at"], group["n"].tolist(), group["right"].tolist(), strict=True)))]
        return pd.DataFrame([(*(group[k].iat[0] for k in KEY), version, knots, int(group["n"].sum()))], columns=[*KEY, "version", "knots", "n"])

    return counted.groupBy(*KEY).applyInPandas(fitted, KNOTS)


def read_off(knots: Column, score: Column) -> Column:
    """The value between the knots on both sides of a score, in a straight line; beyond the first and last knot theirs."""
    s = score.cast(SCORE)
    below = F.try_element_at(F.filter(knots, lambda k: k["at"] <= s), F.lit(-1))
    above = F.get(F.filter(knots, lambda k: k["at"] > s), F.lit(0))
    share = (s - below["at"]).cast("double") / (above["at"] - below["at"]).cast("double")
    between = below["value"].cast("double") + share * (above["value"] - below["value"]).cast("double")
    value = F.when(below.isNull(), above["value"].cast("double")).when(above.isNull(), below["value"].cast("double")).otherwise(between)
    return F.when(s.isNotNull() & (F.size(knots) > 0), F.round(value, 6).cast(SCORE))
