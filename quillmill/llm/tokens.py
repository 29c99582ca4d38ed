"""Token counts of every prefix of a text, by dynamic programming over the merges of a word-end BPE.

For a word of n symbols the table has, for each i, the last token of the encoding of the first i symbols. The
encoding of a prefix ends with the one token t for which the prefix before t ends with a token that the merges
leave beside t. So the count at i is the count at i - len(t) plus one, and each count is exact: it is what the
library gives for that prefix as a text of its own. Words are looked up in a bounded memo, so a frequent word is
worked out once a task process.

A table has an entry for each prefix of the caller's own text, in characters, also where normalisation joins or
lengthens characters. It is stored as differences, a byte each, with a whole count and the least count at every block
of BLOCK prefixes. Totals, limits and cuts are read from the stored table without looking at the text again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, islice, pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import plus, ship, staged

#: Texts of these characters alone need no Unicode normalisation, and lower case keeps their length.
_PLAIN = regex.compile(r"[^\t\n\r -~¡-įı-ſ–—‘’“”…]")
#: A character with what normalisation may join to it: marks, and the later letters of a Hangul syllable.
_CLUSTER = regex.compile(r"(?s).[\p{M}\u1161-\u1175\u11a8-\u11c2\U00016d67]*")
#: Pieces up to this length may be fixed strings of a split pattern, whose beginnings are split otherwise.
_FIXED = 24
#: Longer pieces are worked out by arrays; the beginnings of shorter ones are remembered.
_LONG = 64
#: Prefixes in a block of a stored table.
BLOCK = 256
#: What stands for a difference of zero, by the bytes that a difference takes.
_ZERO = {1: 64, 4: 1 << 31}


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


#: The byte of each difference that a byte can hold.
_STEP = {d: bytes([d + _ZERO[1]]) for d in range(-_ZERO[1], 256 - _ZERO[1])}


def _bytes(counts: list[int]) -> bytes:
    """Counts as differences, a byte each."""
    return b"".join([_STEP[b - a] for a, b in pairwise([0, *counts])])


#: What no merge makes.
_SYMBOL = (-1, "", "")


class _Memo(dict):
    """A dictionary that works out what it lacks. Of keys that are not asked for, it forgets all but the last `most` to twice `most`."""

    def __init__(self, work, most: int):
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PrefixCounter:
    """Exact token counts of prefixes under one tokenizer file of the kind: NFC, white space, lower case; BPE with word ends."""

    def __init__(self, path: str, memo: int = 300_000):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        model, self.end = spec["model"], spec["model"].get("end_of_word_suffix")
        if model["type"] != "BPE" or not self.end:
            raise ValueError("prefix counts need a BPE vocabulary with an end-of-word suffix")
        self.vocab = frozenset(model["vocab"])
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        #: The merge that makes each token: its rank and its two parts. Single symbols are made by none.
        self.made = {a + b: (i, a, b) for (a, b), i in reversed(self.rank.items())}
        #: The tokens that a word may go on after.
        self.inner = frozenset(t for t in self.vocab if not t.endswith(self.end))
        self.longest = max(map(len, self.vocab))
        #: The tokens that end a word, by what stands before the end.
        self.closing = {t.removesuffix(self.end): t for t in self.vocab if t.endswith(self.end)}.get
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split).findall
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_at = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.library = Tokenizer.from_file(path)
        self.symbols = byte_symbols()
        self.alone = _Memo(self._alone, memo)
        self.kept = _Memo(self._kept, memo)
        #: What is known of each beginning of a word that was met: words share their beginnings.
        self.states, self.most = {"": ("", 0, 0, b"")}, 2 * memo
        self.chunk = _Memo(self._chunk, memo)
        self.normal = _Memo(self.library.normalizer.normalize_str, memo)

    def merged(self, symbols: list[str]) -> list[str]:
        """The merges applied to some symbols, best rank first."""
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:], strict=False), key=lambda p: self.rank.get(p, 1 << 30))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _kept(self, key: tuple[str, str]) -> bool:
        """Whether the merges leave two neighbouring tokens as they are.

        Goes back through the merges that made the two. Whatever stood at the border just before such a merge
        would have been joined across the border if the pair there had a better rank (at equal ranks, the
        leftmost pair is joined first). An empty left side asks whether the merges make the right token at all.
        """
        left, right = key
        if not left:
            return self._alone(right)
        rank, made, until = self.rank.get, self.made.get, 1 << 30
        while True:
            if rank((left, right), 1 << 30) < until:
                return False
            (a, _, after), (b, before, _) = made(left, _SYMBOL), made(right, _SYMBOL)
            if a < 0 and b < 0:
                return True
            if a > b:
                left, until = after, a
            else:
                right, until = before, b + 1

    def _alone(self, token: str) -> bool:
        if token not in self.made:
            return True
        _, a, b = self.made[token]
        return self.alone[a] and self.alone[b] and self._parted(a, b)

    def _parted(self, left: str, right: str) -> bool:
        """Whether two parts stand side by side until they are joined themselves."""
        joined, rank, made = self.rank[left, right], self.rank.get, self.made.get
        while True:
            (a, _, after), (b, before, _) = made(left, _SYMBOL), made(right, _SYMBOL)
            if a < 0 and b < 0:
                return True
            if max(a, b) > joined:  # a part that comes later than the joining
                return False
            if a > b:
                left, until = after, a
            else:
                right, until = before, b + 1
            if rank((left, right), 1 << 30) < until:
                return False

    def word(self, piece: str) -> bytes:
        """The differences of the counts of piece[:i] as texts, for i = 1 to len(piece), a byte each."""
        if len(piece) > _LONG:
            return _bytes(self._long(piece))
        if piece.isascii() and piece.isprintable():
            out = self._met(piece)
        else:
            counts = list(accumulate(x - _ZERO[1] for x in self._met("".join([self.symbols[b] for b in piece.encode()]))))
            out = _bytes([counts[i - 1] for i in accumulate(len(c.encode()) for c in piece)])
        if 1 < len(piece) <= _FIXED and not piece.isalpha() and any(map(str.isalpha, piece)):
            counts = list(accumulate(x - _ZERO[1] for x in out))
            for i in range(1, len(piece)):
                if len(cut := self.pieces(piece[:i])) > 1:
                    counts[i - 1] = sum(map(self.whole, cut))
            out = _bytes(counts)
        return out

    def _met(self, text: str) -> bytes:
        """The differences for each beginning of some symbols. Words share their beginnings, so each is worked out once."""
        states, known = self.states, len(text)
        if len(states) > self.most:
            states.clear()
            states[""] = ("", 0, 0, b"")
        while (state := states.get(text[:known])) is None:
            known -= 1
        for stop in range(known + 1, len(text) + 1):
            begun = text[:stop]
            state = states[begun] = self._state(begun, state)
        return state[3]

    def _state(self, text: str, before: tuple[str, int, int, bytes]) -> tuple[str, int, int, bytes]:
        """Of the symbols that a word begins with: the last token and the tokens if the word goes on, the tokens if it ends here, and the differences.

        The states of all shorter beginnings are there; `before` is that of the longest.
        """
        last, count, closed, states, kept, inner, closing = "", 0, 0, self.states, self.kept, self.inner, self.closing
        for start in range(len(text) - 1, -1, -1):
            token, left = text[start:], states[text[:start]]
            if not count and token in inner and kept[left[0], token]:
                last, count = token, left[1] + 1
            if not closed and (end := closing(token)) is not None and kept[left[0], end]:
                closed = left[1] + 1
            if count and closed:
                return last, count, closed, before[3] + _STEP[closed - before[2]]
        if not closed:
            raise ValueError(f"the vocabulary lacks a symbol of {text!r}")
        return last, count, closed, before[3] + _STEP[closed - before[2]]

    def _long(self, piece: str) -> list[int]:
        """The counts of a long piece by arrays, whose size follows its length."""
        text = "".join([self.symbols[b] for b in piece.encode()])
        n, inner, closing, kept, longest = len(text), self.inner, self.closing, self.kept, self.longest
        last, count, closed = [""] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for stop in range(1, n + 1):
            for start in range(stop - 1, max(-1, stop - longest - 1), -1):
                token = text[start:stop]
                if not count[stop] and token in inner and kept[last[start], token]:
                    last[stop], count[stop] = token, count[start] + 1
                if not closed[stop] and (end := closing(token)) is not None and kept[last[start], end]:
                    closed[stop] = count[start] + 1
                if count[stop] and closed[stop]:
                    break
        return [closed[i] for i in accumulate(len(c.encode()) for c in piece)]

    def whole(self, piece: str) -> int:
        return sum(self.word(piece)) - _ZERO[1] * len(piece)

    def _chunk(self, chunk: str) -> bytes:
        """The differences for each prefix of a lower-cased text without white space."""
        if chunk.isalpha():
            return self.word(chunk)
        return b"".join(map(self.word, self.pieces(chunk)))

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at special strings; each with whether it is one."""
        at = 0
        if any(s in text for s in self.special):
            for found in self.special_at.finditer(text):
                yield text[at : found.start()], False
                yield found.group(), True
                at = found.end()
        yield text[at:], False

    def steps(self, text: str | None) -> np.ndarray:
        """The differences of the table: one for each character of the text.

        White space adds nothing. Inside a special string the counts are those of the ordinary characters; its
        end counts the one token.
        """
        parts, before = [], ""
        for part, special in self.segments(text or ""):
            if part.isascii() and part.isprintable() or not _PLAIN.search(part):
                flat = part.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ")
                steps = np.frombuffer(bytes([_ZERO[1]]).join(map(self.chunk.__getitem__, flat.split(" "))), np.uint8).astype(np.int64) - _ZERO[1]
            else:
                steps = np.diff(self._mapped(part), prepend=0)
            if special:
                end = before[max(before.rfind(" "), before.rfind("\n")) + 1 :]  # what the beginning of the string may be one piece with
                steps = np.diff(self._mapped(end + part))[len(end) - 1 :] if end else steps.copy()
                steps[-1] = 1 - steps[:-1].sum()
            before = "" if special else part
            parts.append(steps)
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def table(self, text: str | None) -> np.ndarray:
        """t[i] is the count for the first i characters of the text."""
        return np.concatenate([[0], np.cumsum(self.steps(text))])

    def _pieces_at(self, normal: str) -> list[tuple[int, int]]:
        return [at for _, at in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _mapped(self, text: str) -> list[int]:
        """Counts for each prefix of any text, by the table of its normal form and the places in it."""
        spans = [m.span() for m in _CLUSTER.finditer(text)]
        parts = [self.normal[text[a:b]] for a, b in spans]
        normal = "".join(parts)
        pieces, counts, bounds = self._pieces_at(normal), [0], []
        for a, b in pieces:
            counts.extend([counts[-1]] * (a + 1 - len(counts)))
            counts.extend(islice(accumulate((x - _ZERO[1] for x in self.word(normal[a:b])), initial=counts[-1]), 1, None))
        counts.extend([counts[-1]] * (len(normal) + 1 - len(counts)))
        bounds, k, at, out = [a for a, _ in pieces], 0, 0, []
        for (a, b), part in zip(spans, parts, strict=True):
            for i in range(a + 1, b):
                begun = self.normal[text[a:i]]
                if part.startswith(begun):
                    out.append(counts[at + len(begun)])
                else:  # the characters so far are not what the whole cluster begins with: split the end anew
                    while k < len(bounds) and bounds[k] < at:
                        k += 1
                    back = bounds[max(0, k - 2)] if bounds else 0
                    end = normal[min(back, at) : at] + begun
                    out.append(counts[min(back, at)] + sum(self.whole(end[x:y]) for x, y in self._pieces_at(end)))
            at += len(part)
            out.append(counts[at])
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


_TABLE = "marks array<int>, least array<int>, width int, steps binary"


def stored(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, bytes]:
    """A table as it is stored: the count before each block and in all, the least count in each block, and the differences."""
    counts = np.cumsum(steps, dtype=np.int32)
    marks = np.concatenate([[0], counts[BLOCK - 1 : len(counts) - 1 : BLOCK], counts[-1:]]).astype(np.int32)
    least = np.minimum.reduceat(counts, np.arange(0, len(counts), BLOCK)) if len(counts) else counts
    width = 1 if not len(steps) or steps.min() >= -_ZERO[1] and steps.max() < 256 - _ZERO[1] else 4
    return marks, least, width, (steps + _ZERO[width]).astype("u1" if width == 1 else ">u4").tobytes()


def restored(width: int, steps: bytes) -> np.ndarray:
    """The table, one count for each prefix, of stored differences."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, "u1" if width == 1 else ">u4").astype(np.int64) - _ZERO[width])])


def prefix_table(text: Column, path: str) -> Column:
    """The stored table of each text; that of a null or empty text has the one count 0."""

    @F.pandas_udf(_TABLE)
    def tables(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for batch in texts:
            yield pd.DataFrame([stored(count.steps(t)) for t in batch], columns=["marks", "least", "width", "steps"])

    return tables(text)


def total(table: Column) -> Column:
    """Native: the tokens of the whole text, from its stored table."""
    return F.element_at(table["marks"], -1).cast("long")


def truncation_point(table: Column, budget: int) -> Column:
    """Native: the longest prefix, in characters, of at most `budget` tokens, from a stored table; 0 if there is none.

    Counts can fall within a word, so this is the last prefix that fits. The last block whose least count fits is
    found, and it alone is read.
    """
    block = F.size(table["least"]) - F.coalesce(F.nullif(F.array_position(F.transform(F.reverse(table["least"]), lambda n: n <= budget), True), F.lit(0)), F.size(table["least"]) + 1).cast("int")
    width = table["width"]
    part = F.substring(table["steps"], block * BLOCK * width + 1, width * BLOCK)
    zero = F.when(width == 1, _ZERO[1]).otherwise(_ZERO[4]).cast("long")
    begin = F.struct(F.lit(0).alias("i"), F.get(table["marks"], block).cast("long").alias("n"), F.lit(0).alias("best"))

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + x
        return F.struct((a["i"] + 1).alias("i"), n.alias("n"), F.when(n <= budget, a["i"] + 1).otherwise(a["best"]).alias("best"))

    moves = F.transform(F.sequence(F.lit(0), (F.octet_length(part) / width).cast("int") - 1), lambda i: F.conv(F.hex(F.substring(part, i * width + 1, width)), 16, 10).cast("long") - zero)
    inside = F.aggregate(moves, begin, step)["best"]
    return F.when(table.isNull() | (block < 0), 0).otherwise(block * BLOCK + inside).cast("long")


def tabled(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """df with n_bytes and prefix_tokens: the stored table of the counts at every prefix of the text.

    A null or empty text has the table of the count 0. Rows are independent, so repeated rows and null keys stay; columns of df with a
    name of the result are replaced. An empty table gives an empty one.
    """
    ship(df.sparkSession)
    value = df[f"`{text}`"]
    return plus(df, n_bytes=F.octet_length(F.coalesce(value, F.lit(""))).cast("long"), prefix_tokens=prefix_table(value, path))


def answers(tables: DataFrame, limit: int = 2048, table: str = "prefix_tokens") -> DataFrame:
    """Native: tables with n_tokens, over_limit, and fit_chars, the longest prefix (in characters) within the limit; from stored tables alone.

    Rows are independent and all stay; other columns stay, those with a name of the result are replaced. An empty table gives an empty one.
    """
    column = tables[f"`{table}`"]
    out = plus(tables, n_tokens=total(column))
    whole = (F.octet_length(column["steps"]) / column["width"]).cast("long")
    return plus(out, over_limit=out.n_tokens > limit, fit_chars=F.when(out.n_tokens > limit, truncation_point(column, limit)).otherwise(whole))


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """df with n_bytes, prefix_tokens, n_tokens, over_limit and fit_chars; the tables are stored and then read.

    A null or empty text has 0 bytes and 0 tokens (its table is the count 0). Every text is counted whole, at any
    length. Rows are independent, so repeated rows and null keys stay as they are, and an empty table gives an empty
    one. Columns of df with one of the names of the result are replaced. One pass over the texts, no shuffle.
    """
    return answers(staged(tabled(df, path, text), "tokens"), limit)
