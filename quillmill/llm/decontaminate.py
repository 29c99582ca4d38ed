"""Benchmark decontamination: random-walk embedding of edit distance, bit-sampling LSH, exact verification.

Texts and items are sequences of words (lower case, ASCII punctuation is a blank). The embedding walks along a
sequence: each step writes the word under the pointer, and a random bit for (step, word) says whether the pointer
moves on. Two sequences within a few edits fall back into step, so edits become few differing places. A repetition
samples some places of the walk over an item-sized window and hashes them; repetitions are added until edited copies
of the items, made at the largest allowed distance, are found with the target recall. Items that miss it after
`most` repetitions are searched exactly: each window that holds enough words of the item is verified. Collisions are verified by
the exact edit distance of the item to its best place around the window. Only windows are walked that hold as many
words of the items as any window within the distance must, which loses none.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import batched, pairwise, repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import plus, ship

_BLANKED = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
#: Words that are worked on at once: memory stays bounded for texts of any number.
BLOCK = 1 << 20


def words_of_text(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANKED).split()


class _Class:
    """Items of like length: their walks are sampled at the same steps."""

    def __init__(self, members: list[int], sizes: list[int], allowed: float):
        self.members = members
        self.low, high = min(sizes), max(sizes)
        self.least = self.low - int(allowed * high)  # words of items in the first `low` words of any match
        self.steps = max(1, int(1.6 * self.low))


class Matcher:
    """Finds items in texts. Its size follows the items alone."""

    def __init__(self, items: list[tuple[object, str | None]], similarity: float = 0.8, recall: float = 0.95, samples: int = 2, most: int = 64, seed: int = 7):
        split = [(key, words_of_text(text)) for key, text in items]
        self.keys, self.words = [k for k, w in split if w], [w for _, w in split if w]
        self.vocabulary = {w: i for i, w in enumerate(sorted({x for w in self.words for x in w}), 1)}
        self.items = [np.array([self.vocabulary[x] for x in w], np.int32) for w in self.words]
        self.allowed, self.base = round(1 - similarity, 9), len(self.vocabulary) + 2
        self.edits = [int(self.allowed * len(w) + 1e-9) for w in self.words]
        self.masks: list[dict[int, int]] = []
        for ids in self.items:
            mask: dict[int, int] = defaultdict(int)
            for i, x in enumerate(ids.tolist()):
                mask[x] |= 1 << i
            self.masks.append(dict(mask))
        groups: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(self.words):
            groups[int(np.log(len(w)) / np.log(1.25))].append(i)
        self.classes = [_Class(g, [len(self.words[i]) for i in g], self.allowed) for _, g in sorted(groups.items())]
        #: For each word, a bit for each class that has it.
        self.holders = [np.zeros(self.base, bool) for _ in self.classes]
        for c, holder in zip(self.classes, self.holders, strict=True):
            for i in c.members:
                holder[self.items[i]] = True
        rng = np.random.default_rng(seed)
        longest = max([c.steps for c in self.classes], default=1)
        self.bits = rng.integers(0, 1 << 63, (most, longest // 63 + 1, self.base), np.int64)
        self.rounds = [self._rounds(c, rng, recall, samples, most) for c in self.classes]
        #: For each class, whether its repetitions reach the recall.
        self.reached = [bool(r) for r in self.rounds]
        self.bits = self.bits[: max(map(len, self.rounds), default=0)].copy()

    def _rounds(self, c: _Class, rng, recall: float, samples: int, most: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(steps, sorted keys of the items, their items) for as many repetitions as the recall needs; none if `most` are too few."""
        some = [c.members[i] for i in rng.permutation(len(c.members))[:100]]
        copies = [(i, self._edited(self.items[i], self.edits[i], rng)) for i in some for _ in range(max(1, 400 // len(some)))]
        pad = np.full(c.steps, self.base - 1, np.int32)
        laid = np.concatenate([np.concatenate([ids, pad]) for _, ids in copies])
        starts = np.concatenate([[0], np.cumsum([len(ids) + len(pad) for _, ids in copies])[:-1]])
        own = np.concatenate([np.concatenate([self.items[i], pad]) for i in c.members])
        own_at = np.concatenate([[0], np.cumsum([len(self.items[i]) + len(pad) for i in c.members])[:-1]])
        place = {i: k for k, i in enumerate(c.members)}
        which, found, out = np.array([place[i] for i, _ in copies]), np.zeros(len(copies), bool), []
        for r in range(most):
            steps = np.sort(rng.choice(c.steps, min(samples, c.steps), replace=False))
            keys = self.walk(own, own_at, r, steps)
            found |= self.walk(laid, starts, r, steps) == keys[which]
            order = np.argsort(keys, kind="stable")
            out.append((steps, keys[order], np.array(c.members)[order]))
            if found.mean() >= recall:
                return out
        return []

    def _edited(self, ids: np.ndarray, edits: int, rng) -> np.ndarray:
        out = ids.tolist()
        for kind in rng.integers(0, 3, edits):
            at = int(rng.integers(0, max(1, len(out))))
            out[at : at + (kind != 1)] = [0] if kind != 2 else []
        return np.array(out, np.int32)

    def walk(self, ids: np.ndarray, starts: np.ndarray, repetition: int, steps: np.ndarray) -> np.ndarray:
        """The hash of the sampled places of the walks that begin at `starts`; ids go on for as many words as a walk can take."""
        at, key, wanted = starts.astype(np.int64), np.zeros(len(starts), np.int64), set(steps.tolist())
        for j in range(int(steps[-1]) + 1):
            here = ids[at]
            if j in wanted:
                key = key * self.base + here
            at += self.bits[repetition, j // 63][here] >> (j % 63) & 1
        return key

    def distance(self, item: int, region: list[int]) -> tuple[int, int]:
        """(least edit distance of the item to a part of the region, where that part ends)."""
        n, mask = len(self.items[item]), self.masks[item].get
        whole, top = (1 << n) - 1, 1 << (n - 1)
        plus_, minus, now = whole, 0, n
        best, end = n, 0
        for i, x in enumerate(region, 1):
            same = mask(x, 0)
            vertical = same | minus
            same |= (((same & plus_) + plus_) ^ plus_)
            up, down = (minus | ~(same | plus_)) & whole, plus_ & same
            now += bool(up & top) - bool(down & top)
            up, down = up << 1 & whole, down << 1 & whole
            plus_, minus = (down | ~(vertical | up)) & whole, up & vertical
            if now < best:
                best, end = now, i
        return best, end

    def search(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        """For each text, given by its words: (item, distance, word after its best place) of each item found in it."""
        out: list[list[tuple[int, int, int]]] = []
        parts, sizes = [], []

        def flush():
            if sizes:
                out.extend(self._search(np.concatenate(parts), np.array(sizes)))
                parts.clear()
                sizes.clear()

        for words in texts:
            parts.append(np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words)))
            sizes.append(len(words))
            if sum(sizes) > BLOCK:
                flush()
        flush()
        return out

    def _search(self, ids: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        results: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
        if not len(ids) or not self.classes:
            return results
        pairs, padded = [], np.concatenate([ids, np.zeros(max(c.steps for c in self.classes), np.int32)])
        for c, holder, rounds, reached in zip(self.classes, self.holders, self.rounds, self.reached, strict=True):
            for i in () if reached else c.members:  # exactly
                own = np.zeros(self.base, bool)
                own[self.items[i]] = True
                held = np.concatenate([[0], np.cumsum(own[ids], dtype=np.int32)])
                n, k = len(self.items[i]), self.edits[i]
                starts = np.flatnonzero(held[np.minimum(np.arange(len(ids)) + n + k, len(ids))] - held[:-1] >= n - k)
                if len(starts):
                    pairs.append(np.stack([np.full(len(starts), i), starts]))
            held = np.concatenate([[0], np.cumsum(holder[ids], dtype=np.int32)])
            ends = np.minimum(np.arange(len(ids)) + c.low, len(ids))
            starts = np.flatnonzero(held[ends] - held[:-1] >= c.least)
            for r, (steps, keys, members) in enumerate(rounds if len(starts) else ()):
                mine = self.walk(padded, starts, r, steps)
                first, stop = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                hit = np.flatnonzero(stop > first)
                while len(hit):
                    pairs.append(np.stack([members[first[hit]], starts[hit]]))
                    first[hit] += 1
                    hit = hit[stop[hit] > first[hit]]
        if not pairs:
            return results
        item, start = np.unique(np.concatenate(pairs, axis=1), axis=1)
        doc = np.searchsorted(bounds, start, "right") - 1
        cuts = np.flatnonzero((np.diff(item) != 0) | (np.diff(doc) != 0)) + 1
        for a, b in pairwise([0, *cuts.tolist(), len(item)]):
            i, d = int(item[a]), int(doc[a])
            found = self._verified(i, ids, start[a:b].tolist(), int(bounds[d]), int(bounds[d + 1]))
            if found is not None:
                results[d].append((i, found[0], found[1] - int(bounds[d])))
        return results

    def _verified(self, item: int, ids: np.ndarray, starts: list[int], low: int, high: int) -> tuple[int, int] | None:
        n, k = len(self.items[item]), self.edits[item]
        reach, mask = n + 2 * k, self.masks[item]
        regions: list[list[int]] = []
        for s in starts:
            if regions and s - 2 * k <= regions[-1][1]:
                regions[-1][1] = min(high, s + reach)
            else:
                regions.append([max(low, s - 2 * k), min(high, s + reach)])
        best = None
        for a, b in regions:
            region = ids[a:b].tolist()
            if sum(map(mask.__contains__, region)) >= n - k:
                distance, end = self.distance(item, region)
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, a + end)
        return best


def _blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about `block_bytes` at most, each of a size that a task holds. Items without words are passed over."""
    rows = items.select(items[f"`{key}`"].cast("string").alias("k"), items[f"`{text}`"].cast("string").alias("t")).where("t IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for b in range(blocks):
        yield [(r.k, r.t) for r in rows.where(F.pmod(F.xxhash64("t", "k"), F.lit(blocks)) == b).orderBy("k", "t").collect()]


def find_items(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", similarity: float = 0.8, recall: float = 0.95, block_bytes: int = 1 << 18, together: int = 8) -> DataFrame:
    """(key, item key, item_words, distance, end_word): the items found in each row of df, at their best place.

    An item of n words is found where a part of the text is within (1 - similarity) n word edits. Null, empty or
    blank texts hold no item, and null, empty or blank items are in no text. Items with equal keys are items of
    their own; rows of df give their finds each, also where keys repeat or are null. Empty tables give an empty
    result. Other columns are not read. The items are taken in blocks of bounded size, `together` of them in each
    pass over all texts, without a shuffle.
    """
    spark = df.sparkSession
    ship(spark)
    # keys go through Python as text: a batch with a null makes numbers of other keys inexact
    docs = df.select(df[f"`{key}`"].cast("string").alias("k"), df[f"`{text}`"].alias("t"))
    kind, item_kind = df.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    out = None
    for blocks in batched(_blocks(items, item_key, item_text, block_bytes), together):
        shared = [spark.sparkContext.broadcast(Matcher(block, similarity, recall)) for block in blocks]

        def found(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                texts = [words_of_text(t) for t in batch["t"]]
                rows = [(k, m.keys[i], len(m.items[i]), d, e) for m in (b.value for b in shared) for k, hits in zip(batch["k"], m.search(texts), strict=True) for i, d, e in hits]
                yield pd.DataFrame(rows, columns=["k", "i", "n", "d", "e"])

        part = docs.mapInPandas(found, "k string, i string, n int, d int, e long")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("k").cast(kind).alias(key), F.col("i").cast(item_kind).alias(item_key), F.col("n").alias("item_words"), F.col("d").alias("distance"), F.col("e").alias("end_word"))


def drop_contaminated(df: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", similarity: float = 0.8, recall: float = 0.95, block_bytes: int = 1 << 18, together: int = 8) -> DataFrame:
    """The rows of df in which find_items finds nothing, with the columns of df. No shuffle."""
    spark = df.sparkSession
    ship(spark)
    out = df
    for blocks in batched(_blocks(items, item_key, item_text, block_bytes), together):
        out = out.where(_clean([spark.sparkContext.broadcast(Matcher(block, similarity, recall)) for block in blocks], out[f"`{text}`"]))
    return out


def _clean(shared: list[Broadcast], text: Column) -> Column:
    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            words, clean = [words_of_text(t) for t in batch], np.ones(len(batch), bool)
            for b in shared:
                clean &= np.array([not hits for hits in b.value.search(words)], bool)
            yield pd.Series(clean)

    return clean(text)
