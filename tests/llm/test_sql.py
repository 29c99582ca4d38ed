"""Queries with SQL give what DuckDB gives; the URL models give what brute force gives."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quillmill.llm import urls
from quillmill.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    df = QUERIES[name](spark, DATA)
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def brute_score(s, examples, least):
    """The mean log ratio of s by counting in the examples for each character."""
    signs = [*urls.ALPHABET, urls.OTHER]

    def counts(ctx, good):
        seen = {}
        for text, kind in examples:
            for i in range(3, len(text)):
                if kind == good and text[i - len(ctx) : i] == ctx:
                    seen[text[i]] = seen.get(text[i], 0) + 1
        return seen

    def chance(ctx, c, good):
        below = chance(ctx[1:], c, good) if ctx else 1 / len(signs)
        seen = counts(ctx, good)
        n = sum(seen.values())
        return (seen.get(c, 0) + len(seen) * below) / (n + len(seen)) if n else below

    total = 0.0
    for i in range(3, len(s)):
        often = lambda ctx: all(sum(counts(ctx, good).values()) >= least for good in (True, False))
        ctx = next((s[i - k : i] for k in (3, 2, 1) if often(s[i - k : i])), "")
        total += math.log(chance(ctx, s[i], True)) - math.log(chance(ctx, s[i], False))
    return total / (len(s) - 3)


def test_url_models(spark):
    rnd = random.Random(8)
    make = lambda letters: "^^^" + "".join(rnd.choices(letters, k=rnd.randrange(1, 9)))
    examples = [(make("aab/"), True) for _ in range(30)] + [(make("abb*"), False) for _ in range(30)]
    texts = [(i, make("ab/*z")) for i in range(12)] + [(99, "^^^")]
    models = urls.train(spark.createDataFrame(examples, "s string, good boolean").withColumn("n", F.lit(1)), least=6)
    got = {r.id: r.score for r in urls.scored(spark.createDataFrame(texts, "id int, s string"), models, "id").collect()}
    assert set(got) == set(range(12))
    for i, s in texts[:-1]:
        assert got[i] == pytest.approx(brute_score(s, examples, 6), abs=1e-9)
