"""Near-duplicates by the similarity of word shingles: SimHash postings by positional bytes, then MinHash bands propose pairs, exact Jaccard similarity decides.

First the texts' fingerprints go through the index of `simhash`: postings by positional bytes, a tally of the shared bytes of
each pair, and the Hamming distance. What this links is verified by the texts' shingles and grown to components. Bands are for the similar
texts whose fingerprints are farther apart. Two texts of similarity s agree in a band of ROWS minima with probability s^ROWS, so a pair at 0.8 is in none of the
BANDS bands with probability (1 - 0.8^5)^24, below one in ten thousand. The positional bytes of a SimHash cannot do
this: such pairs differ in up to a dozen bits or more, and of eight bytes not even one then has to be equal.

Members of a band are not all paired at first. In each round one member of each band, that with the most neighbours of
those not tried yet, is compared with those that are not yet in its component, and the links found are grown to
components: large groups become one in few rounds. The pairs that are then left, of members of a band in different
components, are all compared, in blocks: a band's members are dealt into blocks of bounded size, and each pair of
blocks is one group, whatever the size of the band. So every proposed pair is either decided or inside one component,
pairs are never rows, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import ship, staged
from quillmill.llm.simhash import components, fingerprint_of, first_rows, links as byte_links, local_roots, shingle_hashes

SIZE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: Bits that fingerprints linked by their positional bytes may differ in.
DISTANCE = 2
#: At most so many rounds with single members before all pairs left are compared, and no more if so few pairs a text are left.
ROUNDS, LEFT = 4, 500
#: Shingles and members in a block, on average at most.
BLOCK_SHINGLES, BLOCK_MEMBERS = 1 << 15, 512
_RNG = np.random.default_rng(42)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
#: Shingles that are permuted at once, so that a text of any length takes bounded memory.
BLOCK = 1 << 10


def bands_of(text: str | None, size: int = SIZE) -> np.ndarray:
    """One 64-bit key for each band, with the band's number hashed in. Texts without words have the same keys."""
    import xxhash

    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for hashes in shingle_hashes(text, size):
        for at in range(0, len(hashes), BLOCK):
            np.minimum(least, (hashes[at : at + BLOCK, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    return np.array([xxhash.xxh64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)], np.uint64).view(np.int64)


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    parts = list(shingle_hashes(text, size))
    return np.unique(np.concatenate(parts)).view(np.int64) if parts else np.zeros(0, np.int64)


def is_similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the Jaccard similarity of two sets reaches the bound; two empty sets are equal."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def similar_pairs(sets: list[np.ndarray], roots: np.ndarray, blocks: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """The similar pairs, by index, of sets with different roots; of two blocks, only pairs across them."""
    sizes = np.array([len(x) for x in sets])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.int64)
    several, place = np.unique(flat, return_inverse=True)
    bits = np.zeros((len(sets), len(several) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (np.repeat(np.arange(len(sets)), sizes), place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))
    left, right, both_blocks = [], [], len(np.unique(blocks)) > 1
    for i in range(len(sets) - 1):
        j = np.arange(i + 1, len(sets))
        fits = (roots[j] != roots[i]) & (np.minimum(sizes[j], sizes[i]) >= similarity * np.maximum(sizes[j], sizes[i]) - 1e-9)
        j = j[fits & (blocks[j] != blocks[i])] if both_blocks else j[fits]
        common = np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64)
        j = j[common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9]
        left.append(np.full(len(j), i))
        right.append(j)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def _node(text: str) -> Column:
    """Rows of equal text are one node."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles reach the similarity."""

    @F.pandas_udf("boolean")
    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([is_similar(a, b, similarity) for a, b in zip(left, right, strict=True)], dtype=bool)

    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").where(similar("_a", "_b")).select("a", "b")


def byte_pairs(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b), a after b, of nodes (node, fp) that the index by positional bytes links: nodes of one fingerprint, and of fingerprints within the distance."""
    first = staged(nodes.groupBy("fp").agg(F.min("node").alias("b"), F.count("*").alias("n")), "fingerprints")
    equal = nodes.join(first.where("n > 1").select("fp", "b"), "fp").select(F.col("node").alias("a"), "b")
    found = byte_links(first.select("fp"), distance)
    ends = lambda c: first.select(F.col("fp").alias(c), F.col("b").alias(f"{c}_node"))
    linked = found.join(ends("a"), "a").join(ends("b"), "b").select(F.greatest("a_node", "b_node").alias("a"), F.least("a_node", "b_node").alias("b"))
    return equal.unionByName(linked).where("a <> b").distinct()


def block_pairs(placed: DataFrame, own: DataFrame, most: int, members: int) -> DataFrame:
    """Rows (node, the other columns of own, key, root, low, high, block) of pairs of blocks, a group (key, low, high) for each, that hold all pairs of a key's members with different roots.

    placed has (key, node, root, size), own (node, ...) has a row a node. A block has `most` of the summed size and this many members, on average at
    most. The root that most members of a key have is its main one; where that saves rows its members have blocks of their own, which are
    paired with those of the others alone, so a large group that is one component goes once to each block of the others.
    Keys whose members have one root are passed over. Columns of own are joined to each node once, not to each row.
    """
    blocks = lambda size, n: F.ceil(F.greatest(size / most, n / members)).cast("int")
    roots = placed.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    keys = roots.groupBy("key").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "root", "size")).alias("main")).where("n > main.n")
    more = keys.select("*", blocks(F.col("size"), F.col("n")).alias("all"), blocks(F.col("main.size"), F.col("main.n")).alias("mains"), blocks(F.col("size") - F.col("main.size"), F.col("n") - F.col("main.n")).alias("others"))
    saves = F.expr("main.n * others + (n - main.n) * (mains + others) < n * all")
    dealt = more.select("key", F.when(saves, F.col("main.root")).alias("main"), F.when(saves, F.col("mains")).otherwise(0).alias("mains"), F.when(saves, F.col("others")).otherwise(F.col("all")).alias("others"))
    is_main, at = F.col("root").eqNullSafe(F.col("main")), F.xxhash64("node", "key")
    block = F.when(is_main, F.pmod(at, "mains")).otherwise(F.col("mains") + F.pmod(at, "others")).cast("int")
    place = F.struct("key", "root", block.alias("block"), F.when(is_main, F.col("mains")).otherwise(0).alias("first"), (F.col("mains") + F.col("others") - 1).alias("last"))
    places = placed.join(dealt.hint("merge"), "key").groupBy("node").agg(F.collect_list(place).alias("places"))
    rows = places.join(own.hint("merge"), "node").select(*own.columns, F.explode("places").alias("p"))
    rows = rows.select(*own.columns, "p.key", "p.root", "p.block", F.explode(F.sequence("p.first", "p.last")).alias("other"))
    return rows.select(*own.columns, "key", "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block")


def one_sided(frame: pd.DataFrame) -> bool:
    """Whether one of two blocks has no members."""
    return frame["low"].iat[0] != frame["high"].iat[0] and frame["block"].min() == frame["block"].max()


def _blockwise(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect what all similar pairs of members of a band in different components connect.

    A pair of blocks is a group: its size is bounded by the blocks, so a large band is many groups on many tasks.
    """
    sized = placed.select("key", "node", "root").join(sets.select("node", F.size("shingles").alias("size")), "node")
    members = block_pairs(sized, sets.select("node", "shingles"), BLOCK_SHINGLES, BLOCK_MEMBERS)

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        nodes, blocks = frame["node"].to_numpy(), frame["block"].to_numpy()
        if one_sided(frame):
            return pd.DataFrame({"a": nodes[:0], "b": nodes[:0]})
        a, b = similar_pairs([np.asarray(x, np.int64) for x in frame["shingles"]], frame["root"].to_numpy(), blocks, similarity)
        root = local_roots(len(nodes), a, b)
        later = np.flatnonzero(root != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[later], "b": nodes[root[later]]})

    return members.groupBy("key", "low", "high").applyInPandas(compared, "a long, b long").distinct()


def similar_groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of df with a key: the key and component_id, the smallest key that the row reaches by similar texts.

    Similar are texts whose sets of shingles of `size` words (ASCII lower case; a shorter text is one shingle) have a Jaccard similarity
    of at least `similarity`. Null, empty and blank texts are all similar to each other. Repeated rows each give a row. An empty table gives an empty result.
    Columns other than the two named ones are not read.
    """
    ship(df.sparkSession)

    @F.pandas_udf("fp long, bands array<long>")
    def signs(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"fp": np.array([fingerprint_of(t, size) for t in batch], np.uint64).view(np.int64), "bands": [bands_of(t, size) for t in batch]})

    @F.pandas_udf("array<long>")
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t, size) for t in batch])

    rows = df.where(df[f"`{key}`"].isNotNull()).select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), _node(text).alias("node"))
    docs = staged(rows.select("doc_id", "node", signs("text").alias("s")).select("doc_id", "node", "s.*"), "bands")
    distinct = staged(docs.groupBy("node").agg(F.min("doc_id").alias("least"), F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands")), "distinct")
    near = staged(byte_pairs(distinct.select("node", "fp")), "pairs")
    postings = distinct.select("node", F.explode("bands").alias("key"))
    several = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    placed = staged(postings.join(several, "key").select("key", "node", "n"), "postings")
    weights = staged(placed.groupBy("node").agg(F.sum("n").alias("weight")), "weights")
    asked = staged(weights.select("node").union(near.select("a")).union(near.select("b")).distinct(), "asked")
    sets = staged(rows.join(asked, "node", "left_semi").groupBy("node").agg(F.any_value("text").alias("text")).select("node", shingles("text").alias("shingles")), "sets")
    roots, nodes = components(staged(_verified(near, sets, similarity), "links")), weights.count()
    placed = placed.join(weights, "node").join(roots, "node", "left").select("key", "node", F.coalesce(roots.root, "node").alias("root"), "weight")
    for turn in range(ROUNDS + 1):
        counts = placed.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
        mixed = staged(counts.where("groups > 1"), "counts")
        placed = staged(placed.join(mixed.select("key"), "key", "left_semi"), "mixed")
        left = mixed.agg(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first()[0] or 0
        last = turn == ROUNDS or turn > 0 and left <= LEFT * nodes
        if last:
            links = _blockwise(placed, sets, similarity)
        else:  # one member a band: in round 0 the best connected one, then another one each time
            best = F.struct("weight", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
            hub = placed.groupBy("key").agg(F.max_by(F.struct("node", "root"), best).alias("hub")).select("key", F.col("hub.node").alias("b"), F.col("hub.root").alias("other"))
            pairs = placed.withColumnRenamed("node", "a").join(hub, "key").where("root <> other").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
            links = _verified(staged(pairs, "pairs"), sets, similarity)
        roots = components(staged(links, "links").union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        if last:
            break
        placed = placed.select("key", "node", "weight").join(roots, "node", "left").select("key", "node", F.coalesce(roots.root, "node").alias("root"), "weight")
    found = staged(distinct.join(roots, distinct.node == roots.node, "left").select(distinct.node, "least", F.coalesce("root", distinct.node).alias("root")), "roots")
    first = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.join(first, "root").select("node", "component_id")
    return docs.join(named, "node").select(F.col("doc_id").alias(key), "component_id")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """df with one row of each group of similar texts: that with the smallest key.

    Rows without a key all stay. Where several rows have the key that stays, one stays, of those with equal text
    any, else that whose text has the smallest digest. Columns stay as they are.
    """
    found = similar_groups(df, key, text, size, similarity)
    return first_rows(df, found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("k")).distinct(), key, text)
