"""Compression of vectors to codes, one byte for each part, by codebooks that are exact in whole numbers.

A vector's nearest entries are screened by a matrix product in float32. Its rounding error is bounded (for a product of
d terms of rounded factors by gamma(d + 2) times the two norms), so each entry's squared distance lies in an interval. Entries
whose interval does not reach down to the best one's upper end are out; if several are left, their distances are worked out
in whole numbers, and of equal ones the first is taken. The result is that of whole numbers throughout, whatever
order a matrix library adds in.

Codebooks are refined by rounds over all vectors: each task adds up its vectors by entry, the sums of the tasks are added
by Spark, and the driver holds one codebook, which the number of parts, entries and components bounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import ship, staged

#: Rows whose intervals are held at once.
ROWS = 4096
_TOP = (1 << 63) - 1


def gamma(n: int) -> float:
    """Bound of the relative error of n roundings to float32."""
    u = 2.0**-24
    return n * u / (1 - n * u)


def screened(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each row of whole numbers; none of their squared distances may exceed an int64."""
    n, d = x.shape
    own, entry = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)), (book.astype(np.float64) ** 2).sum(axis=1)
    product = (x.astype(np.float32) @ book.astype(np.float32).T).astype(np.float64)
    reach = np.outer(own, np.sqrt(entry))
    middle = entry - 2 * product
    radius = (2 * gamma(d + 2) * reach + 2.0**-50 * (entry + 2 * reach)) * (1 + 2.0**-20)
    open_ = middle - radius <= (middle + radius).min(axis=1, keepdims=True)
    code = open_.argmax(axis=1)
    several = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(several):
        row, e = np.nonzero(open_[several])
        exact = np.full((len(several), len(book)), _TOP, np.int64)
        exact[row, e] = ((x[several[row]] - book[e]) ** 2).sum(axis=1)
        code[several] = exact.argmin(axis=1)  # the first of equal ones
    return code, ((x - book[code]) ** 2).sum(axis=1)


def _by_hand(x: list[int], book: list[list[int]]) -> tuple[int, int]:
    far = [sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)) for entry in book]
    best = min(far)
    return far.index(best), best


def nearest(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(codes by row and part, the row's summed squared distance); numbers too large for an int64 are worked on as they are."""
    parts, entries, d = books.shape
    codes, errors = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), object)
    if not len(vectors):
        return codes, []
    most = max([abs(int(v)) for v in (books.max(initial=0), books.min(initial=0))])
    # (2 m)^2 for each component in an int64
    limit = int((2**62 / max(1, parts * d)) ** 0.5 / 2)
    small = ((vectors >= -limit) & (vectors <= limit)).all(axis=1) if most <= limit else np.zeros(len(vectors), bool)
    for at in range(0, len(vectors), ROWS):
        here = at + np.flatnonzero(small[at : at + ROWS])
        for p in range(parts):
            codes[here, p], far = screened(vectors[here, p * d : (p + 1) * d], books[p])
            errors[here] += far
    for i in np.flatnonzero(~small):
        for p in range(parts):
            codes[i, p], far = _by_hand(vectors[i, p * d : (p + 1) * d].tolist(), books[p].tolist())
            errors[i] += far
    return codes, errors.tolist()


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """The vectors as rows, with zeros at the end up to the width."""
    lists = [np.asarray(v, np.int64) for v in column]
    if all(len(v) == width for v in lists):
        return np.array(lists, np.int64).reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    for row, v in zip(out, lists, strict=True):
        row[: len(v)] = v
    return out


def _sums(vectors: DataFrame, books: np.ndarray) -> list:
    """(part, entry, pos, sum, n) over all vectors."""
    parts, entries, d = books.shape

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n = np.zeros((parts, entries, d), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = _matrix(batch["v"], parts * d)
            codes, _ = nearest(x, books)
            plain = len(x) * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < 1 << 53  # sums are exact in float64
            for p in range(parts):
                n[p] += np.bincount(codes[:, p], minlength=entries)
                for j in range(d):
                    values = x[:, p * d + j]
                    if plain:
                        sums[p, :, j] += np.array([int(s) for s in np.bincount(codes[:, p], values, entries)], object)
                    else:
                        for c, v in zip(codes[:, p].tolist(), values.tolist(), strict=True):
                            sums[p, c, j] += v
        used = np.argwhere(n > 0)
        yield pd.DataFrame([(int(p), int(e), j, str(sums[p, e, j]), int(n[p, e])) for p, e in used for j in range(d)], columns=["part", "entry", "pos", "s", "n"])

    partial = vectors.select("v").mapInPandas(added, "part int, entry int, pos int, s string, n long")
    return partial.groupBy("part", "entry", "pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256), a row for each row of df whose vector is not null and holds numbers alone.

    Each component becomes floor(scale x), at most the ends of a long; vectors are cut into `parts` equal parts. The first
    codebooks are the parts of the `entries` vectors (256 at most) with the smallest keys, null keys last, of equal keys the
    smaller vector; fewer vectors make fewer entries. Vectors shorter than the longest, or than a multiple of
    the parts, have zeros at their end; an empty vector is all zeros. Repeated rows give a row each. Errors beyond a
    long are the largest long. Null labels are one label. An empty table, or one without such vectors, gives an
    empty result. Other columns of df are not read.
    """
    spark = df.sparkSession
    ship(spark)
    value = df[f"`{vector}`"].cast("array<double>")
    sound = value.isNotNull() & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    top = lambda x: F.when(x >= 2.0**63, F.lit(_TOP)).when(x <= -(2.0**63), F.lit(-_TOP)).otherwise(F.floor(x))
    rows = df.where(sound).select(df[f"`{key}`"].alias("k"), df[f"`{label}`"].alias("l"), F.transform(value, lambda x: top(x * float(scale))).alias("v"))
    rows = staged(rows, "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return rows.select(F.col("k").alias(key), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = -(-max(width, 1) // parts) * parts
    first = rows.orderBy(F.col("k").asc_nulls_last(), "v").select("v").limit(min(entries, 256)).collect()
    books = _matrix(pd.Series([r.v for r in first]), width).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(rows, books):
            books[r.part, r.entry, r.pos] = int(r.s) // r.n
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(books)

    @F.pandas_udf("code string, error long")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, errors = nearest(_matrix(batch, width), shared.value)
            yield pd.DataFrame({"code": [c.tobytes().hex() for c in codes], "error": [min(e, _TOP) for e in errors]}, columns=["code", "error"])

    done = staged(rows.select("k", "l", coded("v").alias("c")).select("k", "l", "c.*"), "codes")
    return _with_label_errors(done).select(F.col("k").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _with_label_errors(done: DataFrame, share: int = 1000) -> DataFrame:
    """done with the sum of errors over equal labels. Labels that over a `share`-th of the rows have are at most `share`:

    their sums are broadcast. The others are joined by sort and merge, and none of them is on more rows than that.
    """
    sums = done.groupBy("l").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_TOP).cast("decimal(38,0)")).cast("long").alias("label_error"), F.count("*").alias("n"))
    sums = staged(sums, "labels").withColumnRenamed("l", "of")
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot = sums.where(F.col("n") * share > total).select("of", "label_error", F.lit(True).alias("hot"))
    told = done.join(F.broadcast(hot), F.col("l").eqNullSafe(F.col("of")), "left").drop("of")
    cold = sums.where(F.col("n") * share <= total).select("of", F.col("label_error").alias("e"))
    rest = told.where("hot IS NULL").drop("label_error").join(cold.hint("merge"), F.col("l").eqNullSafe(F.col("of")))
    return told.where("hot").select("k", "code", "error", "label_error").unionByName(rest.select("k", "code", "error", F.col("e").alias("label_error")))
