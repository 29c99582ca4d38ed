"""Components of sets that similar pairs link, of pairs that share a key; the keys are the caller's.

Pairs of keys with few members are rows, each once. Members of larger keys are not all paired: at first each is
compared with the one that has the most neighbours, and the links found are grown to components; then, round by round, each with
the nearest member that is in another component, so large groups become one in few rounds. The members that may then still be similar
to one in another component are all compared, in blocks: a key's members are dealt into blocks of bounded size, and each pair of
blocks is one group, whatever the size of the key. So every proposed pair is either decided or inside one component,
pairs of large keys are never rows, and nothing is capped.

Before sets are compared their sketches are: bits that say whether an odd number of a set's shingles falls on a place. They
differ in no more bits than the sets in shingles, so pairs that differ in too many cannot be similar and go without their sets.
The caller has the sketches beforehand; it is asked for the sets of those nodes alone that are in a pair which sketches leave.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import staged
from quillmill.llm.simhash import components, local_roots
from quillmill.llm.similar import BLOCK_MEMBERS, BLOCK_SHINGLES, block_pairs, one_sided, similar_pairs

#: At most so many rounds with nearest members before all pairs left are compared.
ROUNDS = 3
#: Members of a posting whose pairs are rows, at most.
SMALL = 6
#: Pairs of sketches that are compared at once.
PAIRS = 1 << 18


def odd_sketch(shingles: np.ndarray) -> bytes:
    """A bit for each of B places, B a power of two of at least twice the set's size: whether an odd number of shingles falls on it.

    Sets that differ in d shingles have sketches that differ in d bits at most. Folded in half, a sketch is that of half the places.
    """
    places = 64
    while places < 2 * len(shingles):
        places *= 2
    at = (shingles.view(np.uint64) >> np.uint64(7)) % np.uint64(places)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=places) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch of as many 64-bit words."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def may_be_similar(a: bytes, b: bytes, n: int, m: int, similarity: float) -> bool:
    """False only if sets of n and m shingles with these sketches cannot reach the similarity."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    return min(n, m) >= similarity * max(n, m) - 1e-9 and int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()) <= (n + m) * (1 - similarity) / (1 + similarity) + 1e-6


def signs(sketches: list[np.ndarray], words: int) -> np.ndarray:
    """The bits of sketches, folded to this length, as ones and minus ones."""
    return np.unpackbits(np.array([folded(s, words) for s in sketches]).view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def nearest(sketches: list[bytes], sizes: np.ndarray, roots: np.ndarray, blocks: np.ndarray, similarity: float) -> np.ndarray:
    """For each member the index of the nearest other one, by sketch, that may be similar and has another root; -1 without one. Of two blocks, only across them."""
    own = [np.frombuffer(x, np.uint64) for x in sketches]
    words, out = np.array([len(x) for x in own]), np.full(len(own), -1)
    best, two, sizes = np.full(len(own), np.inf, np.float32), len(np.unique(blocks)) > 1, sizes.astype(np.float32)
    sides = [np.flatnonzero(blocks == b) for b in np.unique(blocks)] if two else [np.arange(len(own))] * 2
    for level in np.unique(words):  # pairs whose shorter sketch has this length
        a, b = (side[words[side] >= level] for side in sides)
        if not len(a) or not len(b):
            continue
        right = signs([own[j] for j in b], level)
        for at in range(0, len(a), max(1, PAIRS // len(b))):
            rows = a[at : at + max(1, PAIRS // len(b))]
            fits = (roots[rows][:, None] != roots[b]) & np.logical_or.outer(words[rows] == level, words[b] == level)
            fits &= np.minimum.outer(sizes[rows], sizes[b]) >= np.float32(similarity) * np.maximum.outer(sizes[rows], sizes[b]) - 1e-3
            if not fits.any():
                continue
            # of ones and minus ones the product is exact below 2^24
            far = (64 * level - signs([own[i] for i in rows], level) @ right.T) / 2
            far = np.where(fits & (far <= np.add.outer(sizes[rows], sizes[b]) * np.float32((1 - similarity) / (1 + similarity)) + 0.1), far, np.float32(np.inf))
            for mine, others, d in ((rows, b, far), (b, rows, far.T)) if two else ((rows, b, far),):
                j = d.argmin(axis=1)
                value = d[np.arange(len(mine)), j]
                better = value < best[mine]
                best[mine[better]], out[mine[better]] = value[better], others[j[better]]
    return out


def _verified(pairs: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles reach the similarity. Sketches are compared first: they are short, and sets are made for what they leave."""

    @F.pandas_udf("boolean")
    def screened(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for a, b, n, m in batches:
            yield pd.Series([may_be_similar(*x, similarity) for x in zip(a, b, n, m, strict=True)], dtype=bool)

    left, right = (sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"s{c}"), F.col("size").alias(f"n{c}")) for c in "ab")
    pairs = staged(pairs.join(left, "a").join(right, "b").where(screened("sa", "sb", "na", "nb")).select("a", "b"), "screened")
    if pairs.isEmpty():
        return pairs
    sets = staged(sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "sets")
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")
    # of n and m shingles as many are shared as s (n + m) / (1 + s) at least
    least = (F.size("_a") + F.size("_b")) * (similarity / (1 + similarity)) - 1e-6
    return pairs.join(left, "a").join(right, "b").where(F.size(F.array_intersect("_a", "_b")) >= least).select("a", "b")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffles of tables that are written: it does so when the driver collects its garbage, which may be late in a short job."""
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt out by these columns to as many tasks as the session shuffles to: Python works long on few bytes, by which small partitions are else put together."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _near_by_sketch(placed: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """(key, node, root, other, size): of members (key, node, root, size) those that may be similar to one of their band with another root, each with the nearest such one.

    A pair of blocks is a group: its size is bounded by the blocks, so a large band is many groups on many tasks.
    """
    members = block_pairs(placed, sketches.select("node", "size", "sketch"), 16 * BLOCK_SHINGLES, 4 * BLOCK_MEMBERS)

    def tried(frame: pd.DataFrame) -> pd.DataFrame:
        nodes = frame["node"].to_numpy()
        near = np.full(len(frame), -1) if one_sided(frame) else nearest(list(frame["sketch"]), frame["size"].to_numpy(), frame["root"].to_numpy(), frame["block"].to_numpy(), similarity)
        stay = near >= 0
        return frame.loc[stay, ["key", "node", "root", "size"]].assign(other=nodes[near[stay]])

    return spread(members, "key", "low", "high").groupBy("key", "low", "high").applyInPandas(tried, "key long, node long, root long, size long, other long")


def _blockwise(left: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect what all similar pairs of members of a band with different roots connect, of members (key, node, root, size), in pairs of blocks."""
    members = block_pairs(left, sets.select("node", "shingles"), BLOCK_SHINGLES, BLOCK_MEMBERS)

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        nodes = frame["node"].to_numpy()
        if one_sided(frame):
            return pd.DataFrame({"a": nodes[:0], "b": nodes[:0]})
        a, b = similar_pairs([np.asarray(x, np.int64) for x in frame["shingles"]], frame["root"].to_numpy(), frame["block"].to_numpy(), similarity)
        root = local_roots(len(nodes), a, b)
        later = np.flatnonzero(root != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[later], "b": nodes[root[later]]})

    return spread(members, "key", "low", "high").groupBy("key", "low", "high").applyInPandas(compared, "a long, b long").distinct()


def connected(postings: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """(node, root): the components of the nodes that similar sets link, of pairs that share a key of postings (node, key).

    sketches has (node, size, sketch) of all nodes, with the sketch of `odd_sketch`; sets_of gives (node, shingles) for a table of nodes. Nodes without links may be missing.
    """
    several = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    placed = staged(postings.join(several, "key").select("key", "node", "n"), "postings")
    weights = staged(placed.groupBy("node").agg(F.sum("n").alias("weight")), "weights")
    sketches = staged(sketches.join(weights.select("node"), "node", "left_semi").select("node", "size", "sketch"), "sketched")
    release(placed.sparkSession)
    of = lambda pairs: pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    star = lambda found: found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    verified = lambda pairs: staged(_verified(staged(of(pairs), "pairs"), sketches, sets_of, similarity), "links")
    # the pairs of small postings, each once however many postings it is in
    few = placed.where(F.col("n") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list("node")).alias("m"))
    pair = F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", F.lit(1), i), lambda y: F.struct(x.alias("a"), y.alias("b"))))))
    roots = components(verified(few.select(pair.alias("p")).select("p.a", "p.b")))
    # of larger ones at first each member with the one that has the most neighbours, if it is not yet in its component; a member does so for three of its keys
    listed = placed.where(F.col("n") > SMALL).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("k")).join(weights, "node").join(sketches.select("node", "size"), "node")
    keys, last = staged(listed.select("node", "weight", "size", F.col("k.key").alias("keys")), "keys"), False
    members = keys.join(roots, "node", "left").select("node", "weight", F.coalesce(roots.root, "node").alias("root"), "keys")
    hub = members.select("node", "weight", "root", F.explode("keys").alias("key")).groupBy("key").agg(F.max_by(F.struct("node", "root"), F.struct("weight", "node")).alias("hub")).select("key", F.col("hub.node").alias("b"), F.col("hub.root").alias("other"))
    some = F.array_distinct(F.array(*[F.get("keys", F.floor((F.size("keys") - 1) * x).cast("int")) for x in (0.0, 0.5, 1.0)]))  # the smallest, the middle and the largest
    pairs = members.select(F.col("node").alias("a"), "root", F.explode(some).alias("key")).join(hub, "key").where("root <> other").select("a", "b")
    roots = components(verified(pairs).union(star(roots)))
    nodes = weights.count()
    release(placed.sparkSession)
    for turn in range(ROUNDS + 1):
        if turn:  # who has nobody left in another component gets nobody later, as components only grow
            placed = near.select("key", "node", "size").distinct().join(roots, "node", "left").select("key", "node", F.coalesce(roots.root, "node").alias("root"), "size")
        else:  # a node finds its root once for all its postings
            placed = keys.join(roots, "node", "left").select("node", F.coalesce(roots.root, "node").alias("root"), "size", F.explode("keys").alias("key"))
        near = staged(_near_by_sketch(staged(placed, "placed"), sketches, similarity), "near")
        left = near.count()
        if not left:
            return roots
        last = last or left <= 2 * nodes  # few are left: they are compared whole at once
        if turn < ROUNDS and not last:  # each member with the nearest one that is not yet in its component
            links = verified(near.select(F.col("node").alias("a"), F.col("other").alias("b")))
            last = links.isEmpty()  # what is nearest is not similar; the rest is compared whole
        if turn == ROUNDS or last:
            sets = staged(sets_of(near.select("node").distinct()), "sets")
            links, last = staged(_blockwise(near.select("key", "node", "root", "size").distinct(), sets, similarity), "links"), True
        if not links.isEmpty():
            roots = components(links.union(star(roots)))
        if last:
            return roots
