"""Line dedup by winnowing over line hashes, in DataFrame operations alone.

A text is the sequence of the hashes of its lines that have a word; other lines are passed over. Windows are the shortest
stretches of `least_words` words that begin at a line, and the shortest that end at one. The minimum of a window's
hashes (the first of equal ones) is its fingerprint, and windows beside each other mostly share one, so the index
holds the distinct minima with the windows that chose them. Any repeated run of `least_words` words holds a whole window, which
chooses the same line in both texts: a guaranteed fingerprint. So a fingerprint that the corpus has once cannot be part
of a repeated run, and its windows go no further. Those of repeated fingerprints are compared by all their lines and joined, at
their fingerprint, to the first of all places that have them.

A match extends both ways by the windows beside it. Every line of a run lies in a window that begins in the run and ends in it: to
the left, where a window that begins at the line still fits, and at the right end, where it does not, in one that ends
at the run's last line. Each window finds an earlier place of its own, so a run is matched from end to end, whatever texts
hold its parts, and no text is compared with another one line by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.llm.common import staged

#: Any character that is not white space separating words.
_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, th, hashes, sizes, places): for each text its key, its own hash, and hash, number of words and place of each line with a word."""
    docs = df.select(df[f"`{key}`"].alias("k"), df[f"`{text}`"].alias("t"))
    placed = F.filter(F.transform(_lines(F.col("t")), lambda line, i: F.struct(line.alias("line"), i.alias("i"))), lambda p: p["line"].rlike(_WORD))
    split = docs.select("k", F.xxhash64("t").alias("th"), placed.alias("lines"))
    sizes = F.transform("lines", lambda p: F.size(F.array_remove(F.split(F.translate(p["line"], "\t\x0b\f\r", "    "), " "), "")))
    return split.select("k", "th", F.transform("lines", lambda p: F.xxhash64(p["line"])).alias("hashes"), sizes.alias("sizes"), F.col("lines.i").alias("places"))


def _taken(sizes: str, least_words: int) -> Column:
    """From each line on, how many lines hold the words of a window, and how many words these are."""
    return F.expr(f"""
        transform({sizes}, (size, i) -> aggregate(slice({sizes}, i + 1, {least_words}), named_struct('words', 0, 'lines', 0),
            (a, w) -> if(a.words >= {least_words}, a, named_struct('words', a.words + w, 'lines', a.lines + 1))))""")


def fingerprints(lines: DataFrame, least_words: int) -> DataFrame:
    """(k, th, print, windows): each distinct window minimum and the windows that chose it, with their places and a hash of all their lines.

    Places are first and stop in the sequence of lines with words, and low and high in the text.
    """
    counted = lines.select("k", "th", "hashes", "places", _taken("sizes", least_words).alias("begin"), _taken("reverse(sizes)", least_words).alias("end"))
    begin = f"transform(begin, (w, i) -> if(w.words >= {least_words}, named_struct('first', i, 'stop', i + w.lines), null))"
    end = f"transform(end, (w, i) -> if(w.words >= {least_words}, named_struct('first', size(hashes) - i - w.lines, 'stop', size(hashes) - i), null))"
    cut = counted.select("k", "th", "hashes", "places", F.expr(f"array_sort(array_distinct(array_compact(concat({begin}, {end}))))").alias("parts")).where("size(parts) > 0")
    each = F.expr("transform(transform(parts, w -> named_struct('first', w.first, 'stop', w.stop, 'part', slice(hashes, w.first + 1, w.stop - w.first))), w -> named_struct('first', w.first, 'stop', w.stop, 'at', int(w.first + array_position(w.part, array_min(w.part)) - 1), 'key', xxhash64(w.part)))")
    windows = cut.select("k", "th", "hashes", "places", each.alias("w"))
    # windows move to the right and so do their minima: those with one minimum stand side by side
    starts = F.expr("filter(transform(w, (x, n) -> if(n = 0 OR x.at <> get(w, n - 1).at, n, null)), n -> n IS NOT NULL)")
    begun = windows.select("k", "th", "hashes", "places", "w", starts.alias("starts"))
    groups = F.expr("zip_with(starts, concat(slice(starts, 2, size(starts)), array(size(w))), (a, b) -> slice(w, a + 1, b - a))")
    found = begun.select("k", "th", "hashes", "places", F.explode(groups).alias("g"))
    placed = F.expr("transform(g, w -> named_struct('first', w.first, 'stop', w.stop, 'low', get(places, w.first), 'high', get(places, w.stop - 1), 'key', w.key))")
    return found.select("k", "th", F.expr("get(hashes, g[0].at)").alias("print"), placed.alias("windows"))


def matches(found: DataFrame) -> DataFrame:
    """(k, th, low, high): the windows of each text that an earlier text has, or an earlier place of the same text that does not overlap."""
    found = staged(found, "fingerprints")
    repeated = found.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    windows = staged(found.join(repeated.hint("merge"), "print").select("k", "th", "print", F.explode("windows").alias("w")).select("k", "th", "print", "w.*"), "windows")
    order = F.struct(F.col("k").isNull().alias("none"), "k", "th", "first")
    first = windows.groupBy("print", "key").agg(F.min(order).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = first.select("print", "key", F.col("f.k").alias("k0"), F.col("f.th").alias("th0"), F.col("f.first").alias("first0"))
    same = F.col("k").eqNullSafe(F.col("k0")) & (F.col("th") == F.col("th0"))
    return windows.join(first.hint("merge"), ["print", "key"]).where(~same | (F.col("first") >= F.col("first0") + F.col("stop") - F.col("first"))).select("k", "th", "low", "high")


def repeated_runs(lines: DataFrame, least_words: int) -> DataFrame:
    """(k, th, gone): the places of the lines of each text, with any lines without words between them, that are in a later repeated run."""
    along = W.partitionBy("k", "th").orderBy("low", "high")
    marked = matches(fingerprints(lines, least_words)).withColumn("begins", F.coalesce(F.col("low") > F.max("high").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(True)).cast("int"))
    islands = marked.withColumn("island", F.sum("begins").over(along)).groupBy("k", "th", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return islands.groupBy("k", "th").agg(F.flatten(F.collect_list(F.sequence("low", "high"))).alias("gone"))


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 50) -> DataFrame:
    """df with the text without its later repeated runs, and n_lines and n_removed (of lines with a word).

    A run of lines with `least_words` words or more goes where the same lines stand in a text with a smaller key,
    or earlier in the same text without overlap; the first occurrence stays. So a line goes if any run that holds it does, whichever
    earlier texts hold the parts of its text. Order is by key, then by
    by a hash of the text; null keys come last. Rows that repeat both key and text are one document and are
    treated alike. A null text stays null, an empty one empty; a text may become empty. Lines without a word stay.
    Single long lines are runs of one. A passage inside a line is not a line run. An empty table gives an empty
    one. Columns of df with a name of the result are replaced; other columns stay.
    """
    lines = staged(line_hashes(df, key, text).groupBy("k", "th").agg(F.first(F.struct("hashes", "sizes", "places")).alias("l")).select("k", "th", "l.*"), "lines")
    runs = staged(repeated_runs(lines, least_words), "runs").withColumnsRenamed({"k": "_k", "th": "_th", "gone": "_gone"})
    # all joins are by sort and merge: their sides grow with the corpus, and skewed parts can be split
    names = [c for c in df.columns if c.lower() not in ("n_lines", "n_removed")]
    value = df[f"`{text}`"]
    joined = df.join(runs.hint("merge"), (F.xxhash64(value) == runs["_th"]) & df[f"`{key}`"].eqNullSafe(runs["_k"]), "left")
    rows = joined.select(F.struct(*[df[f"`{c}`"] for c in names]).alias("row"), value.alias("text"), _lines(value).alias("split"), runs["_gone"].alias("gone"))
    blank = F.filter(F.transform("split", lambda line, i: F.struct(line.alias("line"), i.alias("i"))), lambda p: ~p["line"].rlike(_WORD))
    rows = rows.select("*", F.transform(blank, lambda p: p["i"]).alias("blank"))
    kept = F.array_sort(F.array_union(F.array_except(F.sequence(F.lit(0), F.size("split") - 1), "gone"), "blank"))
    rows = rows.select("*", F.when(F.col("gone").isNotNull(), kept).alias("kept"))
    left = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join(F.transform("kept", lambda i: F.get("split", i)), "\n"))
    removed = F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.size("split") - F.size("kept"))
    out = [left.alias(c) if c.lower() == text.lower() else F.col("row").getField(c).alias(c) for c in names]
    return rows.select(*out, (F.size("split") - F.size("blank")).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


def renewed(df: DataFrame, key: str = "doc_id", text: str = "text", count: str = "n_chars", least_words: int = 50) -> DataFrame:
    """df after dedup_lines, with the columns of df; where df has the count column, it counts the characters left."""
    apart = df.select(df[f"`{key}`"].alias("_key"), df[f"`{text}`"].alias("_text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    done = dedup_lines(apart, "_key", "_text", least_words)
    size = F.when(F.col("n_removed") > 0, F.char_length("_text"))
    made = {text: F.col("_text"), count: F.coalesce(size.cast(df.schema[count].dataType), F.col("_row").getField(count))} if count in df.columns else {text: F.col("_text")}
    return done.select(*[made.get(c, F.col("_row").getField(c)).alias(c) for c in df.columns])
