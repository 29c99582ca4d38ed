"""Packing of tokenised documents into windows by non-negative least squares over length combinations.

Documents are cut into whole windows and one rest. The histogram of the rests (at most `window` bins, whatever the
corpus) is fitted by repeat counts of shallow combinations, two or three lengths that fill a window exactly:
min ||A x - h|| with x >= 0. The counts are rounded to what the histogram has, and each rest takes its place by
its rank among those of its length. What is left over is packed greedily end to end and cut at window borders;
the last partial window is cut into sequences whose lengths are powers of two. So nothing is padded.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.llm.common import ship, staged
from quillmill.llm.tokens import byte_symbols

#: Characters whose classes all versions of Unicode and both regular-expression engines agree on.
_SETTLED = regex.compile(r"[^\t\n\r -~\u00a1-\u0233\u0391-\u03a1\u03a3-\u03ce\u0400-\u045f\u2010-\u2027\u20ac\u3001\u3002\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\uff01\uff0c]")
#: The split of byte-level vocabularies of this kind: a fixed value of their format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    Where the file's merges go by the order of its ids, the same vocabulary as byte ranks gives the same ids several
    times faster, for texts without special strings whose characters are settled ones. All others go to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.ranked = self._ranked(json.loads(open(path, encoding="utf-8").read()))

    def _ranked(self, spec: dict):
        import tiktoken

        model, split = spec["model"], spec["pre_tokenizer"] or {}
        made = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", ""), -1) for m in model["merges"]]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec["normalizer"] and not model.get("ignore_merges")
        if model["type"] != "BPE" or not plain or any(x >= y for x, y in pairwise(made)):
            return None
        byte = {c: b for b, c in enumerate(byte_symbols())}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def settled(self, text: str) -> bool:
        return (text.isascii() and text.isprintable() or not _SETTLED.search(text)) and not any(s in text for s in self.special)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        for text in texts:
            if not text:
                yield b""
            elif self.ranked is not None and self.settled(text):
                yield np.asarray(self.ranked.encode_ordinary(text), "<u4").tobytes()
            else:
                yield np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _tokenised(text: Column, path: str, window: int, end_id: int) -> Column:
    """Of each document: its number of tokens, the checksums of its whole windows, and its rest with checksum."""
    end = np.array([end_id], "<u4").tobytes()

    @F.pandas_udf("n long, crcs array<long>, rest_crc long, rest binary")
    def tokenised(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode
        for batch in texts:
            rows = []
            for ids in encode(list(batch)):
                ids += end
                full = len(ids) // (4 * window)
                rest = ids[full * 4 * window :]
                rows.append((len(ids) // 4, [zlib.crc32(ids[i * 4 * window : (i + 1) * 4 * window]) for i in range(full)], zlib.crc32(rest), rest))
            yield pd.DataFrame(rows, columns=["n", "crcs", "rest_crc", "rest"])

    return tokenised(text)


def combinations(lengths: np.ndarray, window: int, grid: int) -> np.ndarray:
    """Rows (a, b, c) with a >= b >= c >= 0 and a + b + c = window: all pairs, and triples with a multiple of the grid."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    a = np.arange(1, window)
    pairs = np.stack([a, window - a, 0 * a], 1)
    g = np.arange(grid, window, grid)
    x, y = (v.ravel() for v in np.meshgrid(a, g, indexing="ij"))
    triples = np.stack([x, y, window - x - y], 1)
    rows = np.concatenate([pairs, triples[triples[:, 2] > 0]])
    rows = np.unique(-np.sort(-rows, axis=1), axis=0)
    there[0] = True
    return rows[there[rows].all(axis=1)]


def least_squares(rows: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that minimises ||A x - h||, where A counts the lengths in each row, by multiplicative updates."""
    flat, n = rows.ravel(), len(rows)
    used = (rows > 0).astype(float)

    def gather(v):
        return (v[rows] * used).sum(axis=1)

    target = gather(histogram)
    x = np.where(target > 0, target / 3, 0) / max(1, n / max(1, (histogram > 0).sum()))
    for _ in range(rounds):
        fitted = np.bincount(flat, (x[:, None] * used).ravel(), minlength=len(histogram))
        x = x * target / np.maximum(gather(fitted), 1e-12)
    return x


def rounded(rows: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole repeat counts near x whose lengths the histogram has: the fractions go to the largest first."""
    left, counts = histogram.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
    for r in np.argsort(-x, kind="stable").tolist():
        parts, need = np.unique(rows[r][rows[r] > 0], return_counts=True)
        take = min(int(np.rint(x[r])), int((left[parts] // need).min()))
        if take > 0:
            counts[r] = take
            left[parts] -= take * need
    for r in np.argsort(-x, kind="stable").tolist():  # the greedy end: whatever still fits a combination
        parts, need = np.unique(rows[r][rows[r] > 0], return_counts=True)
        take = int((left[parts] // need).min())
        if take > 0:
            counts[r] += take
            left[parts] -= take * need
    return counts


class Plan:
    """Where the rest with rank k among those of its length goes. Its size depends on the window alone."""

    def __init__(self, histogram: np.ndarray, window: int, grid: int):
        rows = combinations(np.flatnonzero(histogram), window, grid)
        counts = rounded(rows, least_squares(rows, histogram.astype(float)), histogram) if len(rows) else np.zeros(0, np.int64)
        rows, counts = rows[counts > 0], counts[counts > 0]
        self.window = window
        #: Of each length: (first rank, first sequence, offset) for each run of ranks that a combination takes.
        runs: dict[int, list[tuple[int, int, int]]] = {}
        taken, base = np.zeros(window + 1, np.int64), 0
        for row, count in zip(rows.tolist(), counts.tolist(), strict=True):
            offset = 0
            for length in row:
                if length:
                    runs.setdefault(length, []).append((int(taken[length]), base, offset))
                    taken[length] += count
                    offset += length
            base += count
        self.runs = {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in runs.items()}
        self.taken, self.sequences = taken, base
        left = (histogram - taken) * np.arange(window + 1)
        self.before = np.concatenate([[0], np.cumsum(left)[:-1]])  # tokens left over of shorter lengths
        self.total = int(left.sum())

    def place(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each rank; left-overs have sequence -1 and their place in the stream of left-overs."""
        stream = self.before[length] + (ranks - self.taken[length]) * length
        if length not in self.runs:
            return np.full(len(ranks), -1), stream
        first, base, offset = self.runs[length]
        at = np.searchsorted(first, ranks, "right") - 1
        held = ranks < self.taken[length]
        return np.where(held, base[at] + ranks - first[at], -1), np.where(held, offset[at], stream)

    def cuts(self, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Pieces of a left-over that begins at `start` of the stream: (skip, length, sequence, offset)."""
        at, stop, full = start, start + length, self.total // self.window * self.window
        while at < stop:
            if at < full:
                sequence, low, high = at // self.window, at // self.window * self.window, (at // self.window + 1) * self.window
            else:  # powers of two, largest first
                sequence, low, tail = full // self.window, full, self.total - full
                while True:
                    high = low + (1 << (tail.bit_length() - 1))
                    if at < high:
                        break
                    tail, low, sequence = tail - (high - low), high, sequence + 1
            end = min(stop, high)
            yield at - start, end - at, sequence, at - low
            at = end


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1, grid: int = 64, group_rows: int = 1 << 20) -> DataFrame:
    """Pieces of all documents: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each row of df is a document of its own, also where keys repeat or are null. A null or empty text is its end
    id alone. A text of any length is cut freely; each of its ids lies in exactly one piece. Every sequence is
    full or, at most a few of all, a power of two long. An empty table gives an empty result. Columns other than
    the two named ones are not read. The driver holds the histogram and the plan, both bounded by the window; ranks
    are dealt over groups for each length, as many as keep a group at `group_rows` rows on average if all documents
    have one length (64 at least), so that a length that a third of all documents have is split.
    """
    spark = df.sparkSession
    ship(spark)
    docs = df.select(df[f"`{key}`"].alias("doc_id"), _tokenised(df[f"`{text}`"], path, window, end_id).alias("t"))
    docs = docs.select("doc_id", "t.*").withColumn("uid", F.monotonically_increasing_id())
    docs = staged(docs, "tokens")  # uid is fixed from here on
    salts = max(64, -(-docs.count() // group_rows))
    lengths = docs.select("uid", "doc_id", "n", "crcs", "rest_crc", (F.col("n") % window).alias("rest"), F.floor(F.col("n") / window).alias("full"), F.pmod(F.xxhash64("uid"), F.lit(salts)).alias("salt"))
    sums = staged(lengths.groupBy("rest", "salt").agg(F.count("*").alias("docs"), F.sum("full").alias("fulls")), "sums")
    bins = sums.groupBy("rest").agg(F.sum("docs").alias("docs"), F.sum("fulls").alias("fulls")).orderBy("rest").collect()  # at most `window` rows
    histogram = np.zeros(window + 1, np.int64)
    histogram[[b.rest for b in bins]] = [b.docs for b in bins]
    histogram[0] = 0
    plan = Plan(histogram, window, grid)
    before, fulls = 0, {}
    for b in bins:
        fulls[b.rest] = before
        before += b.fulls
    plan_b = spark.sparkContext.broadcast((plan, fulls, before))
    earlier = W.partitionBy("rest").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("rest", "salt", F.coalesce(F.sum("docs").over(earlier), F.lit(0)).alias("docs_before"), F.coalesce(F.sum("fulls").over(earlier), F.lit(0)).alias("fulls_before"))
    group = W.partitionBy("rest", "salt").orderBy("uid")
    ranked = lengths.select("*", (F.row_number().over(group) - 1).alias("rank"), (F.sum("full").over(group.rowsBetween(W.unboundedPreceding, 0)) - F.col("full")).alias("run"))
    ranked = ranked.join(offsets, ["rest", "salt"]).select("uid", "doc_id", "n", "crcs", "rest_crc", "rest", "full", (F.col("rank") + F.col("docs_before")).alias("rank"), (F.col("run") + F.col("fulls_before")).alias("run"))

    pieces_of = "array<struct<start: long, length: long, crc: long, sequence: long, offset: long>>"

    @F.pandas_udf(f"{pieces_of}")
    def placed(frame: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        plan, fulls, whole = plan_b.value
        for full, rest, rank, run, crcs, rest_crc in frame:
            sequence, offset = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
            for length in np.unique(rest):
                here = np.flatnonzero(rest == length)
                if length:
                    sequence[here], offset[here] = plan.place(int(length), rank.to_numpy()[here])
            out = []
            for f, r, g, c, rc, s, o in zip(full, rest, run, crcs, rest_crc, sequence.tolist(), offset.tolist(), strict=True):
                rows = [(i * window, window, int(c[i]), fulls[r] + g + i, 0) for i in range(f)]
                if r and s >= 0:
                    rows.append((f * window, r, rc, whole + s, o))
                elif r:
                    cut = list(plan.cuts(o, r))
                    rows += [(f * window + skip, size, rc if len(cut) == 1 else -1, whole + plan.sequences + q, at) for skip, size, q, at in cut]
                out.append([dict(zip(("start", "length", "crc", "sequence", "offset"), x, strict=True)) for x in rows])
            yield pd.Series(out)

    pieces = ranked.select("uid", "doc_id", "n", "full", F.explode(placed("full", "rest", "rank", "run", "crcs", "rest_crc")).alias("p")).select("uid", "doc_id", "n", "full", "p.*")
    pieces = staged(pieces, "pieces")
    cut = pieces.where("crc = -1").join(docs.select("uid", F.col("rest").alias("ids")), "uid")
    checksum = F.crc32(F.expr(f"substring(ids, cast((start - full * {window}) * 4 + 1 AS int), cast(length * 4 AS int))"))
    cut = cut.withColumn("crc", checksum).drop("ids")
    return pieces.where("crc <> -1").unionByName(cut).select(F.col("doc_id").alias(key), "start", "length", F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), F.col("sequence").alias("sequence_id"), "offset")
