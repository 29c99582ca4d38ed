"""Alignment of two tokenizers' tokens by an event sweep.

Each token is an event at the byte where it ends. The events of both tokenizers are united, dealt out by document,
sorted by offset within each task, and streamed through a small state machine: where the events of both sides meet, a
group of tokens is closed, and every stretch between two events beside each other is covered by one token of each
side, which is a link. So links are as many as different offsets, and no token is compared with any other.

An event row holds the events of one side that fall into BLOCK bytes of a text, so a row is bounded whatever the text. An
event is its id alone: an id's bytes are known, so offsets add up along the events of a side. The state is the open
group: the events since both sides met last.

The counts of linked id pairs need all documents. A sweep cuts its links into batches of bounded size, each with a
dictionary of its different id pairs and their numbers. Only the dictionaries are shuffled by pair; the counts come
back to the dictionary's place, and a batch's documents look up their pairs there. So a pair that most documents have
is one row a batch and not one row a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import ship, staged
from quillmill.llm.packing import Encoder
from quillmill.llm.tokens import byte_symbols

#: Bytes of text whose events are one row.
BLOCK = 1 << 12
#: Links and documents of a batch, at most (a document may close a batch beyond it by one block).
BATCH_LINKS, BATCH_DOCS = 1 << 20, 1 << 16


class ByteLevel:
    """Ids and byte lengths of tokens of a byte-level BPE file; special strings in texts are plain text."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.encoder.library.encode_special_tokens = True
        byte, library = {c: b for b, c in enumerate(byte_symbols())}, self.encoder.library
        entries = [library.id_to_token(i) for i in range(library.get_vocab_size())]
        self.bytes = [bytes(byte[c] for c in t) if t is not None and all(c in byte for c in t) else (t or "").encode() for t in entries]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(next(iter(self.encoder.encode([text]))), "<u4")


class Pieces:
    """Ids and byte lengths of tokens of a piece model, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(self.model.id_to_piece(i)[1:-1], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), "<u4")


@lru_cache(maxsize=4)
def _side(kind: type, path: str):
    return kind(path)


def encoded(text: str | None, a, b) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a text by both; none if it is null or empty or if either side's bytes are not a space and the text."""
    none = np.zeros(0, np.uint32)
    if not text:
        return none, none
    try:
        whole = f" {text}".encode()
    except UnicodeEncodeError:  # half a surrogate pair is no text of any tokenizer
        return none, none
    ids_a, ids_b = a.ids(f" {text}"), b.ids(text)
    same = all(b"".join(map(side.bytes.__getitem__, ids.tolist())) == whole for side, ids in ((a, ids_a), (b, ids_b)))
    return (ids_a, ids_b) if same else (none, none)


def _sign(sizes: np.ndarray) -> str:
    """How ids of a vocabulary are written."""
    return "<u2" if len(sizes) <= 1 << 16 else "<u4"


def end_events(df: DataFrame, path_a: str, path_b: str, key: str, text: str, block: int = BLOCK) -> DataFrame:
    """(row, name, at, side, ids): the end events of both sides of each row of df, in rows for `block` bytes each.

    `row` numbers the rows of df, `name` is the key as text, `at` the number of the block, `side` 0 or 1. An event's offset is the
    sum of the bytes of its id and of those before it. A text without tokens has one row without events.
    """
    docs = df.select(F.monotonically_increasing_id().alias("row"), df[f"`{key}`"].cast("string").alias("name"), df[f"`{text}`"].cast("string").alias("t"))

    def events(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _side(ByteLevel, path_a), _side(Pieces, path_b)
        columns, signs = ["row", "name", "at", "side", "ids"], [_sign(x.sizes) for x in (a, b)]
        for batch in batches:
            out, held = [], 0
            for row, name, t in zip(batch["row"], batch["name"], batch["t"], strict=True):
                both = encoded(t, a, b)
                if not len(both[0]):
                    out.append((row, name, 0, 0, b""))
                for side, ids, of in zip((0, 1), both, (a, b), strict=True):
                    places = (np.cumsum(of.sizes[ids]) - 1) // block
                    cuts = np.flatnonzero(np.diff(places)) + 1
                    for first, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                        if stop > first:
                            out.append((row, name, int(places[first]), side, ids[first:stop].astype(signs[side]).tobytes()))
                held += len(t or "")
                if held > 1 << 24:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=columns)

    return docs.mapInPandas(events, "row long, name string, at long, side int, ids binary")


class Stretch:
    """Tokens of both sides from one meeting of their ends to another, with groups and links."""

    def __init__(self, ids: list[np.ndarray], ends: list[np.ndarray]):
        self.ids, self.ends = ids, ends
        self.offsets = np.union1d(*ends)
        self.links = [np.searchsorted(e, self.offsets, "left") for e in ends]
        met = (ends[0][self.links[0]] == self.offsets) & (ends[1][self.links[1]] == self.offsets)
        #: For each group, its end and the tokens of each side up to it.
        self.group_ends, self.stops = self.offsets[met], [l[met] + 1 for l in self.links]

    def pairs(self) -> np.ndarray:
        """Of each link the id pair as one number."""
        return self.ids[0][self.links[0]].astype(np.int64) << 32 | self.ids[1][self.links[1]].astype(np.int64)

    def spelled(self) -> bytes:
        """``;a1,a2|b1`` for each group."""
        (a, b), (sa, sb) = self.ids, self.stops
        of_a, of_b = np.searchsorted(sa, np.arange(len(a)), "right"), np.searchsorted(sb, np.arange(len(b)), "right")
        first_a, first_b = np.diff(of_a, prepend=-1) > 0, np.diff(of_b, prepend=-1) > 0
        signs = np.empty(len(a) + len(b), object)
        top = int(max(a.max(initial=0), b.max(initial=0))) + 1
        table = _decimals(1 << max(16, top.bit_length()))
        size = len(table) // 3
        signs[np.arange(len(a)) + np.concatenate([[0], sb])[of_a]] = table[a + size * first_a]
        signs[np.arange(len(b)) + sa[of_b]] = table[b + 2 * size * first_b]
        return b"".join(signs.tolist())


@lru_cache(maxsize=2)
def _decimals(n: int) -> np.ndarray:
    return np.array([b"%c%d" % (c, i) for c in b",;|" for i in range(n)], object)


def sweep(batches: Iterator[pd.DataFrame], sizes: list[np.ndarray]) -> Iterator[tuple[int, str | None, Stretch | None]]:
    """(row, name, stretch) for the sorted event rows of whole texts, with the bytes of each side's ids; a text ends with (row, name, None).

    The state is the open group. It is joined with a block's events only where the block holds an offset at which both
    sides end, so the work is in proportion to the events.
    """
    last, name, held, at, signs = None, None, ([], []), [0, 0], [_sign(s) for s in sizes]
    empty = np.zeros(0, np.int64)

    def pieces(rows: list) -> Iterator[Stretch]:
        """Add the events of one block; a stretch up to the block's last meeting."""
        new = [(empty, empty), (empty, empty)]
        for side, written in rows:
            ids = np.frombuffer(written, signs[side])
            ends = at[side] + np.cumsum(sizes[side][ids])
            at[side] = int(ends[-1]) if len(ends) else at[side]
            new[side] = (ids, ends)
        common = np.intersect1d(new[0][1], new[1][1], assume_unique=True)
        if not len(common):
            for side in (0, 1):
                if len(new[side][0]):
                    held[side].append(new[side])
            return
        whole = []
        for side in (0, 1):
            cut = int(np.searchsorted(new[side][1], common[-1], "right"))
            parts = [*held[side], (new[side][0][:cut], new[side][1][:cut])]
            whole.append([np.concatenate([p[i] for p in parts]) for i in (0, 1)])
            held[side].clear()
            if cut < len(new[side][0]):
                held[side].append((new[side][0][cut:], new[side][1][cut:]))
        yield Stretch([whole[0][0].astype(np.int64), whole[1][0].astype(np.int64)], [whole[0][1], whole[1][1]])

    block, waiting = None, []
    for batch in batches:
        for row, label, place, side, written in zip(batch["row"].tolist(), batch["name"], batch["at"].tolist(), batch["side"].tolist(), batch["ids"], strict=True):
            if (row, place) != block:
                for s in pieces(waiting):
                    yield last, name, s
                waiting, block = [], (row, place)
            if row != last:
                if last is not None:
                    yield last, name, None
                last, name, at = row, label, [0, 0]
                for h in held:
                    h.clear()
            waiting.append((side, written))
    for s in pieces(waiting):
        yield last, name, s
    if last is not None:
        yield last, name, None


def _sizes(path_a: str, path_b: str) -> list[np.ndarray]:
    return [_side(ByteLevel, path_a).sizes, _side(Pieces, path_b).sizes]


def _swept(events: DataFrame) -> DataFrame:
    return events.repartition("row").sortWithinPartitions("row", "at", "side")


def groups(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(key, row, start, stop, a, b, links): the groups of each text, with their bytes of space+text, ids, and links.

    Links are structs of the places of an A and a B token in the group. `row` numbers the rows of df, as keys may repeat or be null.
    A text that is null or empty, or that one of the two changes, has none. Columns other than the two named ones are not read.
    """
    ship(df.sparkSession)
    kind, sizes = df.schema[key].dataType.simpleString(), _sizes(path_a, path_b)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, begin = [], 0
        for row, name, s in sweep(batches, sizes):
            if s is None:
                begin = 0
                continue
            ends, low, at = s.group_ends, [0, 0], 0
            for g in range(len(ends)):
                high = [int(x[g]) for x in s.stops]
                stop = int(np.searchsorted(s.offsets, ends[g], "right"))
                links = [{"a": int(x) - low[0], "b": int(y) - low[1]} for x, y in zip(s.links[0][at:stop], s.links[1][at:stop], strict=True)]
                out.append((row, name, begin, int(ends[g]), s.ids[0][low[0] : high[0]].tolist(), s.ids[1][low[1] : high[1]].tolist(), links))
                begin, low, at = int(ends[g]), high, stop
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["row", "name", "start", "stop", "a", "b", "links"])
                out = []
        yield pd.DataFrame(out, columns=["row", "name", "start", "stop", "a", "b", "links"])

    found = _swept(end_events(df, path_a, path_b, key, text, block)).mapInPandas(listed, "row long, name string, start long, stop long, a array<long>, b array<long>, links array<struct<a: int, b: int>>")
    return found.select(F.col("name").cast(kind).alias(key), "row", "start", "stop", "a", "b", "links")


def _batches(sizes: list[np.ndarray], most_links: int, most_docs: int):
    """The sweep's consumer: a row for each text (and batch) with its pairs as places in the batch's dictionary, and the dictionaries."""
    from pyspark import TaskContext

    columns = ["batch", "row", "name", "n_a", "n_b", "n_groups", "n_links", "digest", "places", "times", "pairs", "numbers"]

    def consumed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch, part = 0, TaskContext.get().partitionId() << 32
        rows, codes, times, kept = [], [], [], 0
        sums, sha, own, links, fresh = [0, 0, 0, 0], hashlib.sha256(), [], 0, True

        def add(row, name, last: bool) -> None:
            """A row for what the text has given to this batch."""
            nonlocal own, links, kept, sums, sha, fresh
            pairs, n = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            rows.append([row, name, *sums, ("" if fresh else sha.hexdigest()) if last else None])
            codes.append(pairs)
            times.append(n)
            kept, own, links, sums = kept + links, [], 0, [0, 0, 0, 0]
            if last:
                sha, fresh = hashlib.sha256(), True

        def flush() -> pd.DataFrame:
            nonlocal batch, rows, codes, times, kept
            table, place = np.unique(np.concatenate(codes), return_inverse=True)
            numbers = np.bincount(place, np.concatenate(times), len(table)).astype(np.int64)
            cuts = np.split(place.astype("<u4"), np.cumsum([len(c) for c in codes])[:-1])
            out = [(part + batch, *r, c.tobytes(), t.astype("<u4").tobytes(), None, None) for r, c, t in zip(rows, cuts, times, strict=True)]
            out.append((part + batch, None, None, 0, 0, 0, 0, None, None, None, table, numbers))
            frame = pd.DataFrame(out, columns=columns)
            frame["row"] = frame["row"].astype("Int64")
            batch, rows, codes, times, kept = batch + 1, [], [], [], 0
            return frame

        for row, name, s in sweep(batches, sizes):
            if s is None:
                add(row, name, True)
            else:
                own.append(s.pairs())
                links += len(s.offsets)
                sums = [x + y for x, y in zip(sums, (len(s.ids[0]), len(s.ids[1]), len(s.group_ends), len(s.offsets)), strict=True)]
                spelled = s.spelled()
                sha.update(spelled[1:] if fresh else spelled)
                fresh = False
                if kept + links >= most_links:
                    add(row, name, False)
            if kept >= most_links or len(rows) >= most_docs:
                yield flush()
        if rows:
            yield flush()

    return consumed


def align(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", block: int = BLOCK, most_links: int = BATCH_LINKS, most_docs: int = BATCH_DOCS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row for each row of df.

    A is a byte-level BPE file, to which a space and the text are given, B a piece model, which adds the space. A null or empty
    text, and one whose joined bytes either side changes, has zeros and an empty digest. Rows with repeated or null
    keys each give a row. An empty table gives an empty result. Columns other than the two named ones are not read.
    An id pair's count is of links in all rows; n_best is how many links have a pair that is, ties included, the most frequent of its B id.
    """
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    schema = "batch long, row long, name string, n_a long, n_b long, n_groups long, n_links long, digest string, places binary, times binary, pairs array<long>, numbers array<long>"
    swept = staged(_swept(end_events(df, path_a, path_b, key, text, block)).mapInPandas(_batches(_sizes(path_a, path_b), most_links, most_docs), schema), "swept")
    each = swept.where("row IS NULL").select("batch", F.explode(F.arrays_zip("pairs", "numbers")).alias("p")).select("batch", F.col("p.pairs").alias("pair"), F.col("p.numbers").alias("n"))
    counts = staged(each.groupBy("pair").agg(F.sum("n").alias("count")), "counts")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    best = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))  # as many rows as B has ids
    told = counts.join(F.broadcast(best), b_id == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    dictionary = each.select("batch", "pair").join(told, "pair").select(F.col("batch").alias("of"), "pair", "count", "best")

    def looked_up(texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("pair")  # a batch's dictionary is sorted by pair
        count, best = table["count"].to_numpy(np.int64), table["best"].to_numpy(bool)
        sums, bests = [], []
        for places, times in zip(texts["places"], texts["times"], strict=True):
            at, n = np.frombuffer(places, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
            sums.append(int((count[at] * n).sum()))
            bests.append(int(n[best[at]].sum()))
        return texts.drop(columns=["batch", "places", "times"]).assign(n_best=bests, count_sum=sums)

    texts = swept.where("row IS NOT NULL").select("batch", "row", "name", "n_a", "n_b", "n_groups", "n_links", "digest", "places", "times")
    found = texts.groupBy("batch").cogroup(dictionary.groupBy("of")).applyInPandas(looked_up, "row long, name string, n_a long, n_b long, n_groups long, n_links long, digest string, n_best long, count_sum long")
    total = found.groupBy("row").agg(F.max("name").alias("name"), *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], F.max("digest").alias("groups_sha256"))
    return total.select(F.col("name").cast(kind).alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
