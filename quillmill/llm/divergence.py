"""Quality rules by distribution divergence, in DataFrame operations alone.

Each document has a histogram of character classes and one of common words of its language. Both are compared by
the Jensen-Shannon distance to references of the language. References are an input: `references` adds up the
histograms of a trusted corpus's documents that pass the base rules, by language; without one, the judged corpus itself
gives them, all of it. Short documents are not judged by a histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import staged, words_of

#: Common words by language: fixed values.
COMMON_WORDS = {
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
SYMBOLS = "#*$%&|<>"
_WORD = r"[^\x20\x09-\x0D]"
#: Letters of other kinds than these character classes are the rest.
_CLASSES = {"upper": r"[^\p{Lu}]+", "digit": r"[^0-9]+", "mark": r"[^.,;:!?'\"()-]+"}


def _repeated_words(n: str = "n_words", size: int = 8) -> list[dict[str, str]]:
    """Columns, step by step, up to n_repeat_words. Hashes of 2, 4, ... words grow from those of half as many."""
    steps, width = [{"h1": "transform(words, w -> xxhash64(w))"}], 1
    while width < size:
        steps.append({f"h{2 * width}": f"if({n} < {size}, cast(array() AS array<bigint>), zip_with(slice(h{width}, 1, size(h{width}) - {width}), slice(h{width}, {width + 1}, size(h{width}) - {width}), (x, y) -> xxhash64(x, y)))"})
        width *= 2
    steps.append({"some": f"size(array_distinct(h{size})) < size(h{size})"})
    steps.append({"sorted": f"if(some, sort_array(transform(h{size}, (h, i) -> struct(h, i))), cast(array() AS array<struct<h: bigint, i: int>>))"})
    steps.append({"again": "if(some, zip_with(slice(sorted, 1, size(sorted) - 1), slice(sorted, 2, size(sorted) - 1), (x, y) -> x.h = y.h), cast(array() AS array<boolean>))"})
    steps.append({"starts": "if(some, sort_array(filter(zip_with(sorted, zip_with(concat(array(false), again), concat(again, array(false)), (x, y) -> x OR y), (s, r) -> if(r, s.i, null)), i -> i IS NOT NULL)), cast(array() AS array<int>))"})
    steps.append({"n_repeat_words": f"cast(if(some, aggregate(zip_with(starts, slice(starts, 2, size(starts)), (a, b) -> if(b IS NULL, {size}, least({size}, b - a))), 0, (s, x) -> s + x), 0) AS bigint)"})
    return steps


def measured(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """The key, language, base counts and both histograms of each row."""
    value = F.coalesce(df[f"`{text}`"], F.lit(""))
    out = df.select(df[f"`{key}`"].alias("k"), F.coalesce(df[f"`{lang}`"], F.lit("")).alias("lang"), value.alias("t")).withColumn("words", words_of(F.col("t")))
    bare = F.col("t")
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(_WORD))
    out = out.select("k", "lang", "t", "words", F.size("words").cast("long").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"), (F.octet_length("t") - F.octet_length(bare)).cast("long").alias("n_symbols"), lines.alias("lines"))
    classes = [F.char_length(F.regexp_replace("t", pattern, "")).cast("long") for pattern in _CLASSES.values()]
    listed = F.coalesce(*[F.when(F.col("lang") == k, F.array(*map(F.lit, v))) for k, v in COMMON_WORDS.items()], F.array().cast("array<string>"))
    out = out.select("*", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.array(*classes, F.col("n_symbols")).alias("classes"), listed.alias("listed"))
    common = F.array(*[F.coalesce(F.col("n_words") - F.size(F.array_remove("words", F.get("listed", i))), F.lit(0)) for i in range(12)])
    out = out.select("k", "lang", "words", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.concat("classes", F.array(F.greatest(F.lit(0), F.expr("word_chars - aggregate(classes, 0L, (a, b) -> a + b)")))).alias("char_counts"), common.alias("common"))
    out = out.withColumn("word_counts", F.concat("common", F.array(F.expr("n_words - aggregate(common, 0L, (a, b) -> a + b)")))).drop("common")
    for step in _repeated_words():
        out = out.select("*", *[F.expr(v).alias(k) for k, v in step.items()])
    kept = ["k", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_counts", "word_counts"]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(*kept, failed.alias("base_failed"))


def references(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, char_reference, word_reference) of a corpus: the added histograms of its documents that pass the base rules."""
    return staged(_added(measured(df, text, text, lang)), "references")


def _added(rows: DataFrame) -> DataFrame:
    good = rows.where("NOT base_failed")
    sums = [F.sum(F.get(c, i)).alias(f"{c}_{i}") for c, n in (("char_counts", 5), ("word_counts", 13)) for i in range(n)]
    return good.groupBy("lang").agg(*sums).select("lang", F.array(*[f"char_counts_{i}" for i in range(5)]).alias("char_reference"), F.array(*[f"word_counts_{i}" for i in range(13)]).alias("word_reference"))


def distance(counts: str, reference: str) -> Column:
    """The Jensen-Shannon distance, 0 to 1, of two histograms; null if one of them is empty."""
    part = "if(p > 0, p * log2(2 * p / (p + q)), 0D) + if(q > 0, q * log2(2 * q / (p + q)), 0D)"
    shares = lambda c: f"transform({c}, x -> x / nullif(aggregate({c}, 0L, (a, b) -> a + b), 0L))"
    return F.expr(f"sqrt(greatest(0D, aggregate(zip_with({shares(counts)}, {shares(reference)}, (p, q) -> {part}), 0D, (a, b) -> a + b) / 2))")


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", char_limit: float = 0.27, word_limit: float = 0.28, least_chars: int = 300, least_words: int = 100, trusted: DataFrame | None = None) -> DataFrame:
    """The key, base counts, base_failed, both distances and kept, for each row.

    kept is false if a base rule fails, if the document has `least_chars` characters in words and its character
    classes are further than `char_limit` from its language's reference, or if it has `least_words` words and its
    common words are further than `word_limit` from it. `trusted` are references of another corpus; without them
    they are added up over all rows of df, so that a document's verdict depends on the corpus. A distance that is not judged is null. A null text is
    empty. A null language is a language of its own; a language without a word list is judged by characters alone,
    and one without a reference by base rules alone. Repeated rows and null keys give a row each; an empty table
    gives an empty result. Columns other than the three named ones are not read. One pass over the texts.
    """
    rows = staged(measured(df, key, text, lang), "measured")
    judged = rows.join((staged(_added(rows), "references") if trusted is None else trusted), "lang", "left")
    listed = F.col("lang").isin(*COMMON_WORDS)
    judged = judged.withColumn("char_distance", F.when(F.col("word_chars") >= least_chars, distance("char_counts", "char_reference")))
    judged = judged.withColumn("word_distance", F.when((F.col("n_words") >= least_words) & listed, distance("word_counts", "word_reference")))
    kept = ~F.col("base_failed") & F.coalesce(F.col("char_distance") <= char_limit, F.lit(True)) & F.coalesce(F.col("word_distance") <= word_limit, F.lit(True))
    return judged.select(F.col("k").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", kept.alias("kept"))
