"""Aggregates of a run: acceptance, reasons, calls, gold metrics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def acceptance(outcomes: DataFrame, *by: str) -> DataFrame:
    ok = F.col("reason_code").isNull()
    return outcomes.groupBy(*by).agg(F.count("*").alias("candidates"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"), F.round(F.avg(ok.cast("double")), 6).alias("acceptance_rate"))


def rejects(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("reason_code IS NOT NULL").groupBy("stage", "reason_code").agg(F.count("*").alias("n"))


def calls(ledger: DataFrame, service: str, latency: Column, failed: Column, hit: Column) -> DataFrame:
    return ledger.groupBy(service).agg(F.count("*").alias("calls"), F.count_if(failed).alias("errors"), F.round(F.avg(hit.cast("double")), 6).alias("hit_rate"), F.round(F.sum(latency), 3).alias("total"), F.round(F.avg(latency), 4).alias("mean"))


def gold_metrics(actual: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """One row over (key, answer) of both sides: precision, wrong answers, recall. Empty sides give null ratios."""
    both = actual.select(key, F.col("answer").alias("got"), F.lit(True).alias("a")).join(gold.select(key, F.col("answer").alias("want"), F.lit(True).alias("g")), key, "full")
    right = F.col("a") & F.col("g") & F.col("got").eqNullSafe(F.col("want"))
    sums = both.agg(F.count_if(F.coalesce("a", F.lit(False))).alias("accepted"), F.count_if(F.coalesce("g", F.lit(False))).alias("gold"), F.count_if(F.coalesce(right, F.lit(False))).alias("correct"), F.count_if(F.coalesce(F.col("a") & F.col("g") & ~F.col("got").eqNullSafe(F.col("want")), F.lit(False))).alias("wrong_answers"))
    return sums.select("*", F.round(F.col("correct") / F.nullif(F.col("accepted"), F.lit(0)), 6).alias("precision"), F.round(F.col("correct") / F.nullif(F.col("gold"), F.lit(0)), 6).alias("recall"))


def binomial_bounds(k: int, n: int, risk: float = 0.05) -> tuple[float, float]:
    """The exact two-sided bounds of a share of k in n: outside of them, k or fewer (or k or more) has a chance below risk / 2. (0, 1) for n = 0."""

    def tail(low: int, high: int, p: float) -> float:
        if p <= 0 or p >= 1:
            return float(low <= (0 if p <= 0 else n) <= high)
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(low, high + 1)]
        return math.fsum(map(math.exp, terms))

    def edge(inside) -> float:
        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if inside(middle) else (middle, high)
        return low

    if n == 0:
        return 0.0, 1.0
    lower = 0.0 if k == 0 else edge(lambda p: tail(k, n, p) > risk / 2)
    upper = 1.0 if k == n else edge(lambda p: tail(0, k, p) < risk / 2)
    return lower, upper


def gold_regression(before: DataFrame, after: DataFrame, gold: DataFrame, key: str, risk: float = 0.05) -> DataFrame:
    """One row: how a changed run (key, answer) does on gold cases against the run before it.

    accepted and correct are of the changed run; precision_low and precision_high bound its precision exactly. lost are gold
    cases that were right and are no longer (wrong or not accepted), won the other way, wrong_new those accepted wrongly that
    were not before. chance is the exact two-sided chance of such a split of lost and won if both were equally likely.
    refused: there is a new wrong answer, or more was lost than won with a chance below `risk`. Keys that repeat count once, by their least answer.
    """
    one = lambda df, name: df.groupBy(key).agg(F.min("answer").alias(name), F.lit(True).alias(f"{name}_there"))
    both = one(gold, "want").join(one(before, "old"), key, "left").join(one(after, "new"), key, "left")
    right = lambda name: F.coalesce(F.col(f"{name}_there") & F.col(name).eqNullSafe(F.col("want")), F.lit(False))
    wrong = lambda name: F.coalesce(F.col(f"{name}_there") & ~F.col(name).eqNullSafe(F.col("want")), F.lit(False))
    sums = both.agg(
        F.count_if(F.coalesce("new_there", F.lit(False))).alias("accepted"), F.count_if(right("new")).alias("correct"), F.count_if(right("old") & ~right("new")).alias("lost"), F.count_if(right("new") & ~right("old")).alias("won"), F.count_if(wrong("new") & ~wrong("old")).alias("wrong_new"),
    )

    @F.pandas_udf("precision_low double, precision_high double, chance double")
    def judged(accepted: pd.Series, correct: pd.Series, lost: pd.Series, won: pd.Series) -> pd.DataFrame:
        rows = []
        for n, k, x, y in zip(accepted, correct, lost, won, strict=True):
            few = sum(math.comb(int(x + y), i) for i in range(int(min(x, y)) + 1))
            rows.append((*binomial_bounds(int(k), int(n), risk), min(1.0, 2 * few / 2 ** int(x + y))))
        return pd.DataFrame(rows, columns=["precision_low", "precision_high", "chance"])

    told = sums.withColumn("j", judged("accepted", "correct", "lost", "won")).select(*sums.columns, *[F.round(f"j.{c}", 6).alias(c) for c in ("precision_low", "precision_high", "chance")])
    return told.withColumn("refused", (F.col("wrong_new") > 0) | ((F.col("lost") > F.col("won")) & (F.col("chance") < risk)))
