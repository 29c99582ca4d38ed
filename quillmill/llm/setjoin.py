"""Exact Jaccard self-join of shingle sets by partitions of the universe and the pigeonhole principle.

Two sets of r <= s shingles whose similarity reaches num / den differ in at most (r + s) (den - num) / (den + num)
shingles, and s is at most r den / num, so they differ in less than a budget of r (den - num) / num + 1 that follows the smaller one alone.
Sizes are cut into bands by a factor of 3 / 2. A band's scheme hashes all shingles into as many segments as the budget of its largest
size. A set is in the scheme of its band, and in the next one if it reaches up to sizes there; so every similar pair shares a scheme.

A segment's part of a set is indexed by a hash that adds up over its shingles, together with the segment. A segment has two
units to buy: with the first its parts are indexed as they are (found if two sets do not differ in it), with the second also
each part less one shingle, its one-deletion neighbourhood (found if they differ in one shingle at most). The units of a scheme are
put in one order by cost: all parts of all sets are counted first, so a segment that many sets agree in (it is empty in
them, or holds what all of them quote) comes late. Each set buys units in this order up to its budget. Of two sets the smaller one's
units are the larger one's too, and if they were all missed, the sets would differ in as many shingles as the budget has units.

Sets that share an index entry are verified exactly and grown to components as in `connect`; equal sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.llm.common import ship, staged
from quillmill.llm.connect import connected, odd_sketch, release, spread
from quillmill.llm.similar import shingle_set

#: Segments of a scheme at most.
_SLOT = 1 << 40
#: Texts wanted, at most, whose names are sent to all executors; where more are wanted, all texts are shuffled.
NAMES = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _golden(times: int) -> np.uint64:
    return np.uint64(int(_GOLDEN) * times % (1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Schemes:
    """The bands of sizes, each with its scheme of segments, for a similarity of num / den."""

    def __init__(self, num: int, den: int, most: int = 1 << 40):
        self.num, self.den, low = num, den, 1
        self.low, self.high = [], []
        while low <= most:
            self.low.append(low)
            self.high.append(max(low, low * 3 // 2, low * den // num))
            low = self.high[-1] + 1
        self.starts = np.array(self.low, np.int64)

    def budget(self, size: int) -> int:
        """One more than the shingles in which the set and a similar one that is no smaller can differ."""
        return size * (self.den - self.num) // self.num + 1

    def of(self, size: int) -> list[int]:
        """The schemes of a set that can find sets other than equal ones."""
        reach = size * self.den // self.num
        band = int(np.searchsorted(self.starts, size, "right")) - 1
        if reach == size:  # nor does a smaller set reach it then
            return []
        return [band, band + 1] if reach >= self.low[band + 1] else [band]

    def segments(self, scheme: int) -> int:
        return self.budget(self.high[scheme])


def parts_of(shingles: np.ndarray, scheme: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment of each shingle, hash of each shingle, sum of hashes of each segment)."""
    values = shingles.view(np.uint64)
    segment = (mixed(values + _golden(scheme + 1)) % np.uint64(segments)).astype(np.int64)
    hashes = mixed(values ^ _GOLDEN)
    sums = np.zeros(segments, np.uint64)
    np.add.at(sums, segment, hashes)
    return segment, hashes, sums


def entry(sums: np.ndarray, scheme: int, segment: np.ndarray) -> np.ndarray:
    """The index entries of segments' parts, by their sums."""
    place = segment.astype(np.uint64) + (np.uint64(scheme + 1) << np.uint64(40))
    return mixed(mixed(sums) + mixed(place * _GOLDEN)).view(np.int64)


def entries(shingles: np.ndarray, scheme: int, segments: int) -> np.ndarray:
    """The entry of each segment's part as it is."""
    return entry(parts_of(shingles, scheme, segments)[2], scheme, np.arange(segments))


def less_one(shingles: np.ndarray, scheme: int, segments: int, chosen: list[int]) -> np.ndarray:
    """The entries of the chosen segments' parts less one shingle."""
    segment, hashes, sums = parts_of(shingles, scheme, segments)
    here = np.flatnonzero(np.isin(segment, chosen))
    return entry(sums[segment[here]] - hashes[here], scheme, segment[here])


def _sketch(text: Column, schemes: Schemes, size: int) -> Column:
    """(n, node, sketch, schemes, entries): the set's size, hash and odd sketch, its schemes, and the entries of its parts, scheme after scheme."""
    import xxhash

    @F.pandas_udf("n long, node long, sketch binary, schemes array<int>, entries array<long>")
    def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                shingles = shingle_set(text, size)
                own = schemes.of(len(shingles)) if len(shingles) else []
                made = [entries(shingles, c, schemes.segments(c)) for c in own]
                node = int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))
                rows.append((len(shingles), node, odd_sketch(shingles), np.array(own, np.int32), np.concatenate(made) if made else np.zeros(0, np.int64)))
            yield pd.DataFrame(rows, columns=["n", "node", "sketch", "schemes", "entries"])

    return sketch(text)


def ordered_units(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """(scheme, segment, unit, rank): the units of each scheme by rising cost, from (scheme, segment, n) of all entries that n > 1 sets share and (scheme, segments, sets, size).

    A unit costs its index rows and the pairs that share an entry: the first one a row for each set, the second one as many more as a
    part has shingles, and the pairs again; it comes after the first. The rows here are as many as all schemes have
    segments, which the largest set bounds.
    """
    pairs = shared.groupBy("scheme", "segment").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    every = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)).alias("segment")).join(pairs, ["scheme", "segment"], "left")
    agreed = F.coalesce("pairs", F.lit(0.0))
    first = F.col("sets") + agreed
    second = F.greatest(first, F.col("size") / F.col("segments") + agreed)
    units = every.select("scheme", "segment", F.explode(F.array(F.struct(F.lit(1).alias("unit"), first.alias("cost")), F.struct(F.lit(2).alias("unit"), second.alias("cost")))).alias("u"))
    by = W.partitionBy("scheme").orderBy("u.cost", "u.unit", "segment")
    return units.select("scheme", "segment", "u.unit", (F.row_number().over(by) - 1).alias("rank"))


def joined_sets(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """(key, n_shingles, component_id), a row for each row of df.

    A row's set holds its different shingles of `size` words (ASCII lower case; a text with fewer words is one shingle). Two rows are linked
    if den times the intersection is at least num times the union. component_id is the smallest key that links reach,
    the row's own included; null keys are passed over, and a component without another has null. Null, empty and blank
    texts have no shingles and are linked with nothing. Repeated rows each give a row. An empty table gives an
    empty result. Columns other than the two named ones are not read. Sets are told apart by a hash of 64 bits.
    """
    ship(df.sparkSession)
    schemes = Schemes(num, den)
    rows = df.select(df[f"`{key}`"].alias("k"), df[f"`{text}`"].cast("string").alias("text"))
    named = F.struct(F.xxhash64("text").alias("x"), F.xxhash64(F.lit("text"), "text").alias("y"))  # texts are found again by 128 bits
    docs = staged(rows.select("k", named.alias("name"), _sketch(F.col("text"), schemes, size).alias("s")).select(F.monotonically_increasing_id().alias("row"), "k", "name", "s.*"), "sketches")
    distinct = staged(docs.where("n > 0").groupBy("node").agg(F.min("k").alias("least"), F.min_by(F.struct("row", "name", "n", "sketch", "schemes"), "row").alias("s")).select("node", "least", "s.*"), "distinct")

    @F.pandas_udf("array<long>")
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t, size) for t in batch])

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = staged(distinct.join(nodes, "node", "left_semi").select("node", "name"), "wanted")
        texts = rows.select(named.alias("name"), "text").join(F.broadcast(wanted) if wanted.count() <= NAMES else wanted, "name")
        # copies of a text go no further than their task
        return spread(texts.groupBy("node").agg(F.any_value("text").alias("text")), "node").select("node", shingles("text").alias("shingles"))

    # a place counts the segments of both schemes through: those of the second begin where those of the first end
    segments = F.create_map(*[F.lit(x) for c in range(len(schemes.low) - 1) for x in (c, schemes.segments(c))])
    own = docs.select("row", "node", "entries", segments[F.get("schemes", F.lit(0))].alias("first"), "schemes").join(distinct.select("row"), "row", "left_semi")
    placed = own.where("size(entries) > 0").select("node", "schemes", "first", F.posexplode("entries").alias("place", "entry"))
    second = F.col("place") >= F.col("first")
    scheme, segment = F.get("schemes", second.cast("int")), F.col("place") - F.when(second, F.col("first")).otherwise(0)
    parts = placed.select("entry", "node", (scheme.cast("long") * _SLOT + segment).alias("slot"))
    several = parts.groupBy("entry").agg(F.count("*").alias("n_sets")).where("n_sets > 1")
    shared = staged(parts.join(several.hint("merge"), "entry").select("entry", "node", F.floor(F.col("slot") / _SLOT).cast("int").alias("scheme"), (F.col("slot") % _SLOT).cast("int").alias("segment"), "n_sets"), "shared")
    each = distinct.select("node", "n", F.explode("schemes").alias("scheme"))
    sets = each.groupBy("scheme").agg(F.count("*").alias("sets"), F.sum("n").alias("size")).withColumn("segments", segments[F.col("scheme")].cast("int"))
    heads = shared.groupBy("scheme", "segment", "entry").agg(F.max("n_sets").alias("n"))
    units = staged(ordered_units(heads, sets), "units")
    budget = F.floor(F.col("n") * (den - num) / num) + 1
    first_units = units.where("unit = 1").select("scheme", "segment", "rank")
    whole = shared.join(first_units, ["scheme", "segment"]).join(distinct.select("node", "n"), "node").where(F.col("rank") < budget).select("node", F.col("entry").alias("key"))

    @F.pandas_udf("array<long>")
    def neighbourhoods(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sets_, chosen in batches:
            yield pd.Series([np.concatenate([less_one(np.asarray(s, np.int64), c["scheme"], schemes.segments(c["scheme"]), list(c["segments"])) for c in cs]) for s, cs in zip(sets_, chosen, strict=True)])

    # second units that come so early that the largest sets of their scheme buy them
    double = units.where("unit = 2").join(sets.select("scheme", "segments"), "scheme").where("rank < segments").select("scheme", "segment", "rank")
    bought = each.join(double, "scheme").where(F.col("rank") < budget).groupBy("node", "scheme").agg(F.sort_array(F.collect_list("segment")).alias("segments"))
    chosen = staged(bought.groupBy("node").agg(F.collect_list(F.struct("scheme", "segments")).alias("chosen")), "chosen")
    release(df.sparkSession)
    if not chosen.isEmpty():
        near = sets_of(chosen.select("node")).join(chosen, "node").select("node", F.explode(neighbourhoods("shingles", "chosen")).alias("key"))
        # neighbourhoods meet parts that no other set has as they are
        slots = double.select((F.col("scheme").cast("long") * _SLOT + F.col("segment")).alias("slot"), "rank")
        alone = parts.join(slots, "slot").join(distinct.select("node", "n"), "node").where(F.col("rank") < budget).select("node", F.col("entry").alias("key"))
        whole = whole.unionByName(near).unionByName(alone).distinct()
    roots = connected(whole, distinct.select("node", F.col("n").alias("size"), "sketch"), sets_of, num / den)
    found = staged(distinct.join(roots, distinct.node == roots.node, "left").select(distinct.node, "least", F.coalesce("root", distinct.node).alias("root")), "roots")
    first = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named_ = found.join(first, "root").select("node", "component_id")
    full = docs.where("n > 0").select("k", "n", "node").join(named_, "node").select("k", "n", "component_id")
    out = full.unionByName(docs.where("n = 0").select("k", "n", F.col("k").alias("component_id")))
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id")
