"""SimHash near-duplicates: byte-position inverted index with count filtering, exact at up to `distance` bits.

A fingerprint has eight bytes at eight positions. Two fingerprints that differ in at most d bits share at least
8 - d of these positional bytes: the guaranteed minimum. The index has postings by positional bytes. A posting of one
byte would hold a 256th of the corpus, so the positions are dealt into d + 2 blocks and a posting is named by the
bytes of two blocks: of d + 2 blocks at least two are shared whole, so no pair is missed. Within a posting, the shared
positional bytes of each pair are tallied, pairs below the guaranteed minimum go, and the others are verified by
their exact Hamming distance. A posting with more than MOST members is split by further positional bytes, until all
of the guaranteed minimum are in its name; it then holds at most 256^d different fingerprints (65,536 for two bits)
whatever the size of the corpus, each pair's tally is reached, and the verification tries the bits that may differ.

From each posting goes one edge for each member, to the smallest member that it reaches there; components then grow
across postings by joins. Copies of a fingerprint are one member throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import ship, staged

SEED = 42
#: Shingles that are hashed and tallied at once, so that a text of any length takes bounded memory.
BLOCK = 1 << 15
#: Members of a posting whose pairs are tallied; larger postings are split by more positional bytes.
MOST = 512


def shingle_hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """The 64-bit hashes of a text's shingles of `size` words, in blocks. A shorter text is one shingle; one without words has none."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    shingles = max(1, len(words) - size + 1)
    starts, ends = starts[:shingles].tolist(), ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, shingles, BLOCK):
        yield np.fromiter((digest(flat[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)), np.uint64)


def fingerprint_of(text: str | None, size: int = 3) -> int:
    """The 64-bit SimHash of a text's shingles of `size` words, as an unsigned integer."""
    shingles, tally = 0, np.zeros(64, np.int64)
    for values in shingle_hashes(text, size):
        shingles += len(values)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for part in np.array_split(bits, max(1, len(bits) // 255)):  # sums of a part fit into a byte's range in few steps
            tally += part.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(tally * 2 > shingles, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, size: int = 3) -> Column:
    @F.pandas_udf("long")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint_of(t, size) for t in batch], np.uint64).view(np.int64))

    return fingerprints(text)


def tallied(members: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) of members, by index, that share at least `least` of their eight positional bytes."""
    signs = members.view(np.uint8).reshape(-1, 8)
    tally = np.zeros((len(members), len(members)), np.uint8)
    for position in range(8):
        tally += signs[:, None, position] == signs[None, :, position]
    return np.nonzero(np.triu(tally >= least, 1))


def neighbours(members: np.ndarray, free: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) of sorted members, by index, within the distance; free has ones where members may differ.

    Each change of at most `distance` of these bits is tried: work and memory follow the number of members.
    """
    bits, left, right = [1 << b for b in range(64) if free >> b & 1], [], []
    for k in range(1, distance + 1):
        for change in combinations(bits, k):
            wanted = members ^ np.uint64(sum(change))
            at = np.minimum(np.searchsorted(members, wanted), len(members) - 1)
            here = np.flatnonzero((members[at] == wanted) & (wanted > members))
            left.append(here)
            right.append(at[here])
    return np.concatenate(left), np.concatenate(right)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n members and their links, the smallest index that each reaches."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def verified(members: np.ndarray, mask: int, distance: int, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Edges (later member, smallest member it reaches) among the sorted members of one posting; mask has ones in the bytes of its name."""
    if len(members) <= most:
        a, b = tallied(members, 8 - distance)
        near = np.bitwise_count(members[a] ^ members[b]) <= distance
        a, b = a[near], b[near]
    else:
        a, b = neighbours(members, ~mask & (1 << 64) - 1, distance)
    root = local_roots(len(members), a, b)
    later = np.flatnonzero(root != np.arange(len(members)))
    return members[later], members[root[later]]


def _mask(positions) -> int:
    """Ones in these bytes, as a signed number."""
    return int(np.uint64(sum(0xFF << 8 * int(p) for p in positions)).view(np.int64))


def index(fingerprints: DataFrame, distance: int, most: int = MOST) -> DataFrame:
    """(mask, members): the postings with several members, each with the mask of the bytes that name it."""
    names = [sorted({*x, *y}) for x, y in combinations([x.tolist() for x in np.array_split(np.arange(8), distance + 2)], 2)]
    masks = F.explode(F.array(*[F.lit(_mask(n)) for n in names]))
    rows = fingerprints.select("fp", masks.alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    several = staged(rows.join(sizes.hint("merge"), ["mask", "key"]), "postings")
    small = several.where(F.col("n") <= most).groupBy("mask", "key").agg(F.collect_set("fp").alias("members"))
    rest = [[p for p in range(8) if p not in n] for n in names]
    longer = [[_mask([*n, *more]) for more in combinations(r, 8 - distance - len(n))] if len(n) < 8 - distance else [_mask(n)] for n, r in zip(names, rest, strict=True)]
    finer = F.coalesce(*[F.when(F.col("mask") == _mask(n), F.array(*map(F.lit, m))) for n, m in zip(names, longer, strict=True)])
    split = several.where(F.col("n") > most).select("fp", F.explode(finer).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
    large = split.groupBy("mask", "key").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    return small.unionByName(large).select("mask", "members")


def links(fingerprints: DataFrame, distance: int = 2, most: int = MOST) -> DataFrame:
    """Edges (a, b), a after b, that connect exactly the fingerprints (distinct, in column `fp`) within the distance (0 to 2 bits).

    Each member of a posting has an edge to the smallest member that it reaches there by links. Edges thus stand
    for chains of verified links; no link is lost and none is added.
    """
    if not 0 <= distance <= 2:
        raise ValueError("the byte index bounds its postings for a distance of 0, 1 or 2")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [verified(np.sort(np.asarray(values, np.int64).view(np.uint64)), int(mask), distance, most) for mask, values in zip(batch["mask"], batch["members"], strict=True)]
            yield pd.DataFrame({name: np.concatenate([pair[i] for pair in out] or [np.zeros(0, np.uint64)]).view(np.int64) for i, name in enumerate("ab")})

    return index(fingerprints, distance, most).mapInPandas(joined, "a long, b long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): connected components of edges (a, b) of longs by alternating large and small stars.

    Each round is two joins and is written to the shared folder, so lost executors cost one round. No node's
    neighbours are gathered. Ends when a round changes nothing; the roots are the smallest nodes.
    """
    edges = staged(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").selectExpr("b AS a", "low AS b").where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        edges = staged(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError("components did not settle")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, distance: int = 2) -> DataFrame:
    """Per row of df: the key, fingerprint (16 lowercase hex digits) and component_id.

    component_id is the smallest key in the row's component, its own included; null keys are passed over, and a
    component without any other has null. A null, empty or blank text has the fingerprint zero and is linked like
    any other. Rows with repeated keys or texts each give a row. An empty table gives an empty result. Columns of
    df other than the two named ones are not read.
    """
    ship(df.sparkSession)
    docs = staged(df.select(df[f"`{key}`"].alias("doc_id"), fingerprint(df[f"`{text}`"], size).alias("fp")), "fingerprints")
    distinct = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), distance))
    placed = staged(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(first, "root").select("fp", "component_id")
    return docs.join(named, "fp").select(F.col("doc_id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, distance: int = 2) -> DataFrame:
    """df with one row of each component: that with the smallest key.

    Rows without a key all stay. Where several rows have the key that stays, one stays, of those with equal text
    any, else that whose text has the smallest digest. Columns stay as they are.
    """
    found = near_duplicates(df.select(f"`{key}`", f"`{text}`"), key, text, size, distance)
    return first_rows(df, found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("k")).distinct(), key, text)


def first_rows(df: DataFrame, stay: DataFrame, key: str, text: str) -> DataFrame:
    """One row of df for each key in `stay` (column k), and all rows without a key; of several rows that whose text has the smallest digest."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = df.select(F.col(f"`{key}`").alias("k"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("digest"), row)
    first = rows.join(stay, "k", "left_semi").groupBy("k").agg(F.min_by("row", "digest").alias("row"))
    return first.select("row").unionByName(rows.where("k IS NULL").select("row")).select("row.*")
