"""Nearest vectors by inverted lists, with exact similarities of all candidates.

A bounded sample is clustered into centres; every row goes into the list of its nearest centre, and a query looks through the
lists of its nearest ones. Candidates are compared in blocks, a matrix product each, so neither a list that holds
many of the rows nor one that many queries look through is one task, and pairs are rows only once they are among a block's best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.operators.graph import cut

#: Lists at most, and rows and queries of a block on average.
LISTS, ROWS, QUERIES = 4096, 4096, 512


def _sound(vector: Column) -> Column:
    """Vectors of numbers that are not all zero."""
    value = vector.cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(value.isNotNull() & F.forall(value, finite) & F.exists(value, lambda x: x != 0), F.lit(False))


def _units(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(units: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centres of unit vectors by spherical k-means; as many as there are different vectors, at most `lists`."""
    units = np.unique(units, axis=0)
    rng = np.random.default_rng(seed)
    out = units[rng.permutation(len(units))[:lists]]
    for _ in range(rounds):
        nearest = (units @ out.T).argmax(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, nearest, units)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        out = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), out)
    return out


def neighbours(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 10, group: str | None = None, lists: int | None = None, probes: float = 0.3, sample: int = 20_000) -> DataFrame:
    """(query, key, similarity, rank): for each query the k rows of the largest cosine among those of the lists it looks through.

    rows and queries have the same columns; with `group` only rows of a query's group count. A query that is a row finds itself first. Equal
    similarities go to the smaller key. Null vectors, those with null, infinite or only zero components, and those of another length than
    the sample's first have no neighbours and are none; rows without a key or group are passed over. `sample` rows, taken by a hash of the key,
    fit the centres; every row is indexed. Lists are as many as the root of the rows (LISTS at most), of which a query looks through the share `probes`, so
    few rows are one list and compared exactly.
    """
    pick = lambda df: df.where(F.col(key).isNotNull() & _sound(F.col(vector))).select(F.col(key).alias("k"), (F.col(group) if group else F.lit(0)).alias("g"), F.col(vector).cast("array<double>").alias("v")).where("g IS NOT NULL")
    index, asked = pick(rows), pick(queries)
    some = index.orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(sample).collect()
    width = len(some[0].v) if some else 0
    n = index.count()
    fitted = centres(_units([r.v for r in some if len(r.v) == width]), lists or max(1, min(LISTS, int(n**0.5) // 2))) if some else np.zeros((1, 0))
    wanted = max(1, -(-len(fitted) * round(probes * 1000) // 1000))

    def nearest(p: int) -> Column:
        @F.pandas_udf("array<int>")
        def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                far = -(_units(batch) @ fitted.T) if len(batch) else np.zeros((0, len(fitted)))
                best = np.argpartition(far, p - 1, axis=1)[:, :p] if p < len(fitted) else np.tile(np.arange(len(fitted)), (len(far), 1))
                yield pd.Series(list(best.astype(np.int32)))

        return udf("v")

    fit = lambda df, p: df.where(F.size("v") == width).select("k", "g", "v", F.explode(nearest(p)).alias("list"))
    listed, asking = cut(fit(index, 1)), cut(fit(asked, wanted))
    blocks = lambda df, most, name: df.groupBy("g", "list").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    sizes = blocks(listed, ROWS, "rb").join(blocks(asking, QUERIES, "qb"), ["g", "list"])
    dealt = lambda df, own, other, name: df.join(sizes, ["g", "list"]).select("k", "g", "v", "list", F.pmod(F.xxhash64("k"), F.col(own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other))
    left, right = dealt(listed, "rb", "qb", "row"), dealt(asking, "qb", "rb", "query")

    def compared(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query": b["k"][:0], "k": a["k"][:0], "similarity": np.zeros(0)})
        a = a.sort_values("k").reset_index(drop=True)
        near = _units(b["v"]) @ _units(a["v"]).T
        best = np.argsort(-near, axis=1, kind="stable")[:, :k]  # of equal ones the smaller key
        at = np.repeat(np.arange(len(b)), best.shape[1])
        return pd.DataFrame({"query": b["k"].to_numpy()[at], "k": a["k"].to_numpy()[best.ravel()], "similarity": near[at, best.ravel()]})

    kind = index.schema["k"].dataType.simpleString()
    found = left.groupBy("g", "list", "rb", "qb").cogroup(right.withColumnsRenamed({"g": "g2", "list": "list2", "rb": "rb2", "qb": "qb2"}).groupBy("g2", "list2", "rb2", "qb2")).applyInPandas(compared, f"query {kind}, k {kind}, similarity double")
    # sums of products differ in their last digits by how they are blocked
    found = found.withColumn("similarity", F.round("similarity", 9))
    best = W.partitionBy("query").orderBy(F.desc("similarity"), "k")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", F.col("k").alias(key), "similarity", "rank")


def near_in_meaning(questions: DataFrame, answers: DataFrame, k: int = 3, least: float = 0.5, **kinds) -> DataFrame:
    """(cluster_id, q, a): the pairs of one cluster whose vectors are near: the answer is among the question's k nearest, with a cosine of `least` or more.

    Both sides have cluster_id, id and vector.
    """
    side = lambda df: df.select(F.col("cluster_id").cast("string").alias("cluster_id"), F.col("id").cast("string").alias("id"), "vector")
    found = neighbours(side(answers), side(questions), "id", "vector", k, "cluster_id", **kinds).where(F.col("similarity") >= least)
    return found.join(side(questions).select("cluster_id", F.col("id").alias("query")), "query").select("cluster_id", F.col("query").alias("q"), F.col("id").alias("a"))
