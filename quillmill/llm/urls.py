"""URL filters: rules on host and path, then a character language-model ratio, in DataFrame operations alone.

Two variable-order Markov models of characters, one of accepted and one of rejected URLs, share one set of contexts:
the longest one of up to three characters that the examples of both kinds have often enough is used: one that only
one kind has would compare a sharp guess with a vague one. Each is smoothed down to its
shorter contexts (a context's own counts against its number of different followers, Witten and Bell's weights). A URL's
score is the mean over its characters of the log ratio of the two probabilities: the difference of its log-likelihoods, by its length.

Examples are the URLs that rules decide, each as often as it stands there, and those that the caller adds; no words are built in.
The whole URL behind the scheme is learned and scored, host, path, query and fragment. The threshold is calibrated on
examples of hosts that the models have not seen: it rejects a given share of the accepted ones. What the filter does to
unseen examples of both kinds is measured by error_rates.

URLs are read in an alphabet of 40 characters (letters in lower case, one sign for any digit, some punctuation, one
for all else, one for the start), so the models have at most 40^3 contexts, whatever the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import staged

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The model's alphabet: start, letters, one digit, punctuation, anything else.
ALPHABET = "^abcdefghijklmnopqrstuvwxyz0./-_?=&:%+~"
OTHER = "*"
SIGNS = len(ALPHABET)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, with A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is this one or a domain above it and whose path begins this one; else null.

    Of rules of equal length the first in order is taken.
    """
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # later ones are laid over earlier ones
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def url_text(url: Column) -> Column:
    """What is learned and scored of a URL: all behind the first ://, in the model's alphabet; nothing without one."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    plain = F.regexp_replace(F.lower(rest), "[0-9]", "0")
    return F.concat(F.lit("^^^"), F.regexp_replace(plain, r"[^a-z0./\-_?=&:%+~]", OTHER))


def _grams(texts: DataFrame, *keep: str) -> DataFrame:
    """keep and, for each character: ctx (the three before it) and c (its number in the alphabet)."""
    at = texts.select(*keep, "s", F.explode(F.sequence(F.lit(4), F.char_length("s"))).alias("i")).where("char_length(s) > 3")
    return at.select(*keep, F.expr("substring(s, i - 3, 3)").alias("ctx"), F.expr(f"cast(if(substring(s, i, 1) = '{OTHER}', {SIGNS}, locate(substring(s, i, 1), '{ALPHABET}') - 1) AS int)").alias("c"))


def train(examples: DataFrame, least: int = 20) -> list[DataFrame]:
    """Models of orders 3, 2, 1, 0 from (s, good, n), n being how often an example stands there: (ctx, ratios), with the log ratio of each next character.

    A context is kept if the examples of both kinds have it `least` times. Work after the counts depends on the alphabet alone.
    """
    long = _grams(examples, "good", "n").groupBy("ctx", "c").agg(F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("yes"), F.sum(F.when(F.col("good"), F.lit(0)).otherwise(F.col("n"))).alias("no"))
    counts = staged(long, "grams")
    models, below = [], None
    flat = F.expr(f"transform(sequence(0, {SIGNS}), i -> struct({1 / (SIGNS + 1)}D AS yes, {1 / (SIGNS + 1)}D AS no))")
    for order in range(4):
        part = counts.groupBy(F.expr(f"right(ctx, {order})").alias("ctx"), "c").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        seen = part.groupBy("ctx").agg(F.map_from_entries(F.collect_list(F.struct("c", F.struct("yes", "no")))).alias("m"), F.sum("yes").alias("n_yes"), F.sum("no").alias("n_no"), F.count_if(F.col("yes") > 0).alias("t_yes"), F.count_if(F.col("no") > 0).alias("t_no"))
        if order:
            seen = seen.where((F.col("n_yes") >= least) & (F.col("n_no") >= least))
            shorter = below.select(F.col("ctx").alias("short"), F.col("p").alias("q"))
            seen = seen.join(shorter, F.expr(f"right(ctx, {order - 1})") == F.col("short"))
        else:
            seen = seen.withColumn("q", flat)
        smoothed = F.expr(f"""
            transform(sequence(0, {SIGNS}), i -> named_struct(
                'yes', if(n_yes > 0, (coalesce(m[i].yes, 0L) + t_yes * q[i].yes) / (n_yes + t_yes), q[i].yes),
                'no', if(n_no > 0, (coalesce(m[i].no, 0L) + t_no * q[i].no) / (n_no + t_no), q[i].no)))""")
        below = staged(seen.select("ctx", smoothed.alias("p")), "model")
        models.append(below.select("ctx", F.transform("p", lambda p: F.ln(p["yes"]) - F.ln(p["no"])).alias("ratios")))
    return models[::-1]


def scored(texts: DataFrame, models: list[DataFrame], key: str) -> DataFrame:
    """(key, score): the mean log ratio over the characters of each s. Texts without characters have no row.

    The models are broadcast: the alphabet bounds them.
    """
    out = _grams(texts, key)
    for order, model in zip((3, 2, 1, 0), models, strict=True):
        named = F.broadcast(model.select(F.col("ctx").alias(f"ctx{order}"), F.col("ratios").alias(f"r{order}")))
        out = out.join(named, F.expr(f"right(ctx, {order})") == F.col(f"ctx{order}"), "left")
    ratio = F.coalesce(*[F.get(f"r{order}", F.col("c")) for order in (3, 2, 1, 0)], F.lit(0.0))
    return out.select(key, ratio.alias("ratio")).groupBy(key).agg(F.avg("ratio").alias("score"))


def filter_urls(df: DataFrame, url: str = "url", rules=RULES, examples: DataFrame | None = None, share: float = 0.01, least: int = 20, margin: float = 0.05) -> DataFrame:
    """df with host, path, rule, score and verdict (allow or block).

    A rule that fits decides. Else the method does: block if the score is below the threshold. The examples are the URLs of df that rules decide, with what they decide,
    and those of `examples` (columns url and good). Four fifths of them (by a hash of the host, so that no host is on both sides) train the models, the rest
    calibrates: the threshold rejects `share` of the accepted among them, but is -margin at most, the log ratio that the model of the
    rejected must have over the other at each character on average. Equal URLs have equal
    verdicts. A null or malformed URL has an empty host and path, no rule, a score of 0 and is allowed. Repeated rows give a row
    each, and an empty table gives an empty one. Columns of df with a name of the result are replaced; other columns stay.
    """
    value = df[f"`{url}`"].cast("string")
    scores, cut, _ = _scores(df.select(value.alias("url")), rules, examples, share, least, margin)
    host, path = host_of(value), path_of(value)
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), host.alias("host"), path.alias("path"), url_text(value).alias("s"))
    own = own.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    out = own.join(scores, "s")
    blocked = [r for r, verdict in rules if verdict == "block"]
    ruled = F.when(F.col("rule").isin(blocked), "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNotNull(), ruled).when(F.col("score") < cut, "block").otherwise("allow")
    made = ["host", "path", "rule", "score", "verdict"]
    names = [c for c in df.columns if c.lower() not in made]
    return out.select(*[F.col("_row").getField(c).alias(c) for c in names], "host", "path", "rule", "score", verdict.alias("verdict"))


def _scores(urls: DataFrame, rules, examples: DataFrame | None, share: float, least: int, margin: float) -> tuple[DataFrame, float, DataFrame]:
    """((s, score) of each text, the threshold, (s, good, unseen) of each example)."""
    blocked = [r for r, verdict in rules if verdict == "block"]
    parsed = urls.select(url_text(F.col("url")).alias("s"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    told = parsed.withColumn("rule", rule).where("rule IS NOT NULL").select("s", "host", (~F.col("rule").isin(blocked)).alias("good"))
    if examples is not None:
        value = F.col("url").cast("string")
        told = told.unionByName(examples.where("good IS NOT NULL AND url IS NOT NULL").select(url_text(value).alias("s"), host_of(value).alias("host"), F.col("good").cast("boolean").alias("good")))
    told = told.select("s", "good", (F.pmod(F.xxhash64("host"), F.lit(5)) == 0).alias("unseen"))
    counted = staged(told.groupBy("s", "good", "unseen").agg(F.count("*").alias("n")), "examples")
    models = train(counted.where("NOT unseen"), least)
    texts = parsed.select("s").union(counted.select("s")).distinct()
    scores = scored(texts.withColumn("id", F.col("s")), models, "id").withColumnRenamed("id", "s")
    scores = staged(texts.join(scores, "s", "left").select("s", F.coalesce("score", F.lit(0.0)).alias("score")), "scores")
    held = told.where("unseen AND good").join(scores, "s").agg(F.percentile_approx("score", share, 10_000)).first()[0]
    return scores, -margin if held is None else min(-margin, held), told


def error_rates(df: DataFrame, url: str = "url", rules=RULES, examples: DataFrame | None = None, share: float = 0.01, least: int = 20, margin: float = 0.05) -> DataFrame:
    """One row: accepted and rejected, the numbers of unseen examples, and accepted_blocked and rejected_allowed, what the scores alone do to them.

    Null URLs are no examples; an example counts as often as it stands there. An empty table gives zeros.
    """
    scores, cut, told = _scores(df.select(df[f"`{url}`"].cast("string").alias("url")), rules, examples, share, least, margin)
    block = F.col("score") < cut
    return told.where("unseen").join(scores, "s").agg(F.count_if("good").alias("accepted"), F.count_if(~F.col("good")).alias("rejected"), F.count_if(F.col("good") & block).alias("accepted_blocked"), F.count_if(~F.col("good") & ~block).alias("rejected_allowed"))
