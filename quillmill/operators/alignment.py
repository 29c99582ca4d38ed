"""Best order-keeping chains of weighted pairs, by blocks that are worked on apart from each other.

Pairs (qp, ap, gain) of places of two sequences are chained so that both places rise; the best chain gains most. A cluster's pairs
are cut into blocks of question places. What a block does to the chains before it is a matrix over (max, +): for
each answer place x that a chain may go on at and each place y that it must stay below, the most that the block can add.
Matrices are as wide as the answer places that blocks share, which the pairs' distance from the diagonal bounds. Each is made in a
task of its own; a cluster's matrices alone, one for each block, are multiplied up in order, forwards and backwards; and with what comes
in from both sides each block knows of each of its pairs the best chain up to it and from it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.operators.graph import cut

_NEVER = -(1 << 60)


class Block:
    """Pairs of one block. Places to go on at are low..high, and one more for all places above high."""

    def __init__(self, frame: pd.DataFrame):
        first = frame.iloc[0]
        self.entry, self.exit = (int(first.in_low), int(first.in_high)), (int(first.out_low), int(first.out_high))
        # of one question at most one pair is in a chain: larger answer places come first
        self.order = np.lexsort((-frame["ap"].to_numpy(), frame["qp"].to_numpy()))
        self.ap, self.gain = frame["ap"].to_numpy()[self.order], frame["gain"].to_numpy()[self.order]
        self.base, self.width = int(self.ap.min()), int(self.ap.max() - self.ap.min()) + 1

    @staticmethod
    def size(bounds: tuple[int, int]) -> int:
        return max(0, bounds[1] - bounds[0] + 1) + 1

    @classmethod
    def place(cls, bounds: tuple[int, int], ap: int) -> int:
        return ap - bounds[0] if ap <= bounds[1] else cls.size(bounds) - 1

    def upto(self, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best of each answer place at which a chain ends, best chain up to each pair), for each row of `before` (by entry place)."""
        ends = np.full((len(before), self.width), _NEVER, np.int64)
        best = np.empty((len(before), len(self.ap)), np.int64)
        for i, (ap, gain) in enumerate(zip(self.ap.tolist(), self.gain.tolist(), strict=True)):
            at = ap - self.base
            here = before[:, self.place(self.entry, ap)]
            if at:
                here = np.maximum(here, ends[:, :at].max(axis=1))
            best[:, i] = here + gain
            ends[:, at] = np.maximum(ends[:, at], best[:, i])
        return ends, best

    def matrix(self) -> np.ndarray:
        """[y, x]: the most that the block adds to a chain that goes on at x and stays below y."""
        n, m = self.size(self.entry), self.size(self.exit)
        start = np.where(np.eye(n, dtype=bool), 0, _NEVER)
        ends, _ = self.upto(start)
        out = np.full((m, n), _NEVER, np.int64)
        for y in range(m):
            below = self.width if y == m - 1 else max(0, min(self.width, self.exit[0] + y - self.base))
            if below:
                out[y] = ends[:, :below].max(axis=1)
            through = self.place(self.entry, self.exit[0] + y) if y < m - 1 else n - 1  # no pair of the block
            out[y, through] = max(out[y, through], 0)
        return out

    def onwards(self, after: np.ndarray) -> np.ndarray:
        """The best chain from each pair, with what comes after the block (by exit place)."""
        best, starts = np.empty(len(self.ap), np.int64), np.full(self.width, _NEVER, np.int64)
        for i in range(len(self.ap) - 1, -1, -1):
            at = int(self.ap[i]) - self.base
            later = int(starts[at + 1 :].max(initial=_NEVER))
            low = max(0, int(self.ap[i]) + 1 - self.exit[0])
            last = len(after) - 1
            beyond = int(after[min(low, last) :].max())
            best[i] = self.gain[i] + max(later, beyond)
            starts[at] = max(starts[at], best[i])
        return best


def _matrix(frame: pd.DataFrame) -> pd.DataFrame:
    block = Block(frame)
    made = block.matrix()
    return pd.DataFrame({"cluster_id": [frame["cluster_id"].iat[0]], "block": [frame["block"].iat[0]], "wide": [made.shape[1]], "m": [made.ravel()]})


def _multiplied(frame: pd.DataFrame) -> pd.DataFrame:
    """For each block of a cluster: what comes in before it and what comes after it, and the best of all."""
    frame = frame.sort_values("block")
    matrices = [np.asarray(m, np.int64).reshape(-1, int(w)) for m, w in zip(frame["m"], frame["wide"], strict=True)]
    before = [np.zeros(matrices[0].shape[1], np.int64)]
    for m in matrices:
        before.append(np.maximum((m + before[-1]).max(axis=1), _NEVER))
    after = [np.zeros(matrices[-1].shape[0], np.int64)]
    for m in matrices[::-1]:
        after.append(np.maximum((m + after[-1][:, None]).max(axis=0), _NEVER))
    after = after[::-1]
    return pd.DataFrame({"cluster_id": frame["cluster_id"], "block": frame["block"], "before": before[:-1], "after": after[1:], "best": int(before[-1][-1])})


def _scored(frame: pd.DataFrame) -> pd.DataFrame:
    block = Block(frame)
    before, after = np.asarray(frame["before"].iat[0], np.int64), np.asarray(frame["after"].iat[0], np.int64)
    _, upto = block.upto(before[None, :])
    out = frame.iloc[block.order][["cluster_id", "q", "a", "qp", "ap", "gain", "best"]].copy()
    return out.assign(upto=upto[0], onwards=block.onwards(after))


def chains(pairs: DataFrame, block: int = 512) -> DataFrame:
    """pairs (cluster_id, q, a, qp, ap, gain), each with upto, onwards, best, optimal and sure.

    upto and onwards are what the best chain gains up to and from the pair, both with it, and best is what the best chain of the
    cluster gains. A pair is optimal if some best chain has it, and sure if every one has. Optimal pairs gain from
    upto - gain to upto, and those of a best chain lie end to end; so a pair is in every best chain where no other
    optimal pair gains any of the same. Gains are whole numbers above 0. Places are whole and stand for one item each. An empty table gives an empty one.
    """
    rows = pairs.select(F.col("cluster_id").cast("string").alias("cluster_id"), F.col("q").cast("string").alias("q"), F.col("a").cast("string").alias("a"), F.col("qp").cast("long").alias("qp"), F.col("ap").cast("long").alias("ap"), F.col("gain").cast("long").alias("gain"))
    # all below reads the pairs several times: what makes them is worked out once
    rows = cut(rows.withColumn("block", F.floor(F.col("qp") / block).cast("long")))
    bounds = rows.groupBy("cluster_id", "block").agg(F.min("ap").alias("low"), F.max("ap").alias("high"))
    along, back = W.partitionBy("cluster_id").orderBy("block"), W.partitionBy("cluster_id").orderBy(F.desc("block"))
    past, rest = along.rowsBetween(W.unboundedPreceding, -1), back.rowsBetween(W.unboundedPreceding, 0)
    # places that this block or later ones may go on at, up to the highest one used before; none before the first block or after the last
    bounds = bounds.select("cluster_id", "block", F.min("low").over(rest).alias("in_low"), F.coalesce(F.max("high").over(past), F.lit(-1)).alias("in_high"), F.max("high").over(along).alias("high"))
    ends = F.lead("in_low").over(along)
    bounds = bounds.select("cluster_id", "block", "in_low", F.coalesce("in_high", F.lit(-1)).alias("in_high"), F.coalesce(ends, F.lit(0)).alias("out_low"), F.when(ends.isNotNull(), F.col("high")).otherwise(F.lit(-1)).alias("out_high"))
    placed = cut(rows.join(bounds, ["cluster_id", "block"]))
    # Python works long on few bytes, by which small partitions are else put together in one task
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matrices = placed.repartition(tasks, "cluster_id", "block").groupBy("cluster_id", "block").applyInPandas(_matrix, "cluster_id string, block long, wide int, m array<long>")
    sums = matrices.repartition(tasks, "cluster_id").groupBy("cluster_id").applyInPandas(_multiplied, "cluster_id string, block long, before array<long>, after array<long>, best long")
    scored = placed.join(sums, ["cluster_id", "block"]).repartition(tasks, "cluster_id", "block").groupBy("cluster_id", "block").applyInPandas(_scored, "cluster_id string, q string, a string, qp long, ap long, gain long, best long, upto long, onwards long")
    scored = scored.withColumn("optimal", F.col("upto") + F.col("onwards") - F.col("gain") == F.col("best"))
    by = W.partitionBy("cluster_id", "optimal").orderBy(F.col("upto") - F.col("gain"), "upto", "q", "a")
    earlier, next_ = F.max("upto").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lead(F.col("upto") - F.col("gain")).over(by)
    alone = F.coalesce(earlier <= F.col("upto") - F.col("gain"), F.lit(True)) & F.coalesce(next_ >= F.col("upto"), F.lit(True))
    return scored.withColumn("sure", F.col("optimal") & alone)
