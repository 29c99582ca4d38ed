"""Best chains, weighted alignment, nearest vectors, calibration, gold regression, walks."""

import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from quillmill.operators import calibration, graph, matching, recognition, report, vectors
from quillmill.operators.alignment import chains


def brute_chains(pairs):
    """Of one cluster's (qp, ap, gain): the best gain, and what every best chain has, by trying all chains."""
    best, every, some = 0, None, set()
    walk = [(0, 0, 0, ())]
    while walk:
        q, a, total, chain = walk.pop()
        if chain and total >= best:
            if total > best:
                best, every, some = total, None, set()
            every = set(chain) if every is None else every & set(chain)
            some |= set(chain)
        walk += [(p[0], p[1], total + p[2], (*chain, p)) for p in pairs if p[0] > q and p[1] > a]
    return best, every or set(), some


def test_chains(spark):
    rnd, rows, want = random.Random(3), [], {}
    for c in range(40):
        wide, n = rnd.choice([1, 2, 9]), rnd.randrange(1, 8)
        pairs = sorted({(q, a) for q in range(1, n + 1) for a in range(max(1, q - wide), q + wide + 1) if rnd.random() < 0.5})
        pairs = [(q, a, rnd.choice([1, 1, 2, 5])) for q, a in pairs]
        rows += [(c, f"q{q}", f"a{a}", q, a, g) for q, a, g in pairs]
        want[str(c)] = brute_chains(pairs)
    df = spark.createDataFrame(rows, "cluster_id int, q string, a string, qp int, ap int, gain long")
    for block in (1, 2, 3, 100):
        got = chains(df, block).collect()
        assert len(got) == len(rows)
        for r in got:
            best, every, some = want[r.cluster_id]
            pair = (r.qp, r.ap, r.gain)
            assert (r.best, r.optimal, r.sure) == (best, pair in some, pair in every), (block, r)
    assert chains(df.limit(0)).count() == 0


def sides(spark, questions, answers):
    schema = "cluster_id string, ord int, number int, id string, document string, file string, fields array<string>"
    q = [("c", i, n, f"q{i}", "Q", "exam", ["数学"], kind, stem) for i, (n, kind, stem) in enumerate(questions)]
    a = [("c", i, n, f"a{i}", "A", "exam", ["数学"], text) for i, (n, text) in enumerate(answers)]
    return spark.createDataFrame(q, schema + ", kind string, stem string"), spark.createDataFrame(a, schema + ", answer string")


def test_weighed(spark):
    """Answers that were renumbered, with one put in and one missing, find their questions by what they are and where they stand."""
    choice, blank = ("选择题", "x A. 1 B. 2"), ("填空题", "____")
    questions = [(1, *choice), (2, *blank), (3, *choice), (4, *choice), (5, *blank), (6, *choice)]
    right = ["A", "3", "B", "A", "7", "B"]
    aligned = lambda answers: {(r.q, r.aligned) for r in matching.weighed(*sides(spark, questions, answers), block=2).collect()}
    assert aligned([(i + 1, t) for i, t in enumerate(right)]) == {(f"q{i}", f"a{i}") for i in range(6)}
    shifted = aligned([(i + 11, t) for i, t in enumerate(right)])  # other numbers throughout
    assert shifted == {(f"q{i}", f"a{i}") for i in range(6)}
    more = [(1, "A"), (2, "3"), (90, "(("), (3, "B"), (4, "A"), (5, "7"), (6, "B")]  # a line that is no answer
    assert aligned(more) >= {("q0", "a0"), ("q1", "a1"), ("q2", "a3"), ("q3", "a4"), ("q4", "a5"), ("q5", "a6")}
    gone = [(1, "A"), (2, "3"), (4, "A"), (5, "7"), (6, "B")]
    assert aligned(gone) == {("q0", "a0"), ("q1", "a1"), ("q3", "a2"), ("q4", "a3"), ("q5", "a4")}


def test_meaning(spark):
    q, a = sides(spark, [(1, "未知", "one"), (2, "未知", "two")], [(1, "eins"), (2, "zwei")])
    told = lambda df, n: df.withColumn("vector", F.when(F.col("ord") == 0, F.array(*map(F.lit, (1.0, 0.0)))).otherwise(F.array(*map(F.lit, (0.0, n)))))
    near = vectors.near_in_meaning(told(q, 1.0), told(a, 3.0), 1)
    assert {(r.q, r.a) for r in near.collect()} == {("q0", "a0"), ("q1", "a1")}
    got = {(r.q, r.a): r.semantic for r in matching.signals(q, a, meaning=near).collect()}
    assert got == {("q0", "a0"): 1, ("q1", "a1"): 1, ("q0", "a1"): 0, ("q1", "a0"): 0}


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(30, 24))
    x = middles[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24)) * 0.5
    x[500:600] = x[0]  # one vector many times
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 24), (9002, [math.nan] * 24), (9003, [1.0] * 3), (None, [1.0] * 24)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    got = vectors.neighbours(df, df.where("id % 100 = 0"), "id", "v", 10).collect()
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, 3000, 100):
        mine = {r.id: r.similarity for r in got if r.query == q}
        near = units[q] @ units.T
        assert len(mine) == 10 and all(abs(near[k] - s) < 1e-8 for k, s in mine.items())
        tenth = np.sort(near)[-10]
        hits, total = hits + sum(near[k] >= tenth - 1e-9 for k in mine), total + 10
    assert hits >= 0.9 * total and {r.query for r in got} == set(range(0, 3000, 100))
    few = df.where("id < 50")
    exact = vectors.neighbours(few, few, "id", "v", 3, lists=1).collect()
    assert {(r.query, r.rank): r.id for r in exact} == {(q, i + 1): int(k) for q in range(50) for i, k in enumerate(np.lexsort((np.arange(50), -np.round(units[q] @ units[:50].T, 9)))[:3])}
    assert vectors.neighbours(df.limit(0), df, "id", "v").count() == 0 == vectors.neighbours(df, df.limit(0), "id", "v").count()


def test_calibration(spark):
    rnd = random.Random(6)
    rows = [("p", m, "t", f"{rnd.randrange(100) / 100:.2f}", rnd.random() < 0.4 + 0.5 * (m == "b")) for m in "ab" for _ in range(300)] + [("p", "a", "t", None, True), ("p", "a", "t", "0.5", None), ("p", "c", "t", "0.7", True)]
    labelled = spark.createDataFrame(rows, "provider string, model string, task string, raw_score string, correct boolean")
    fitted = calibration.fit(labelled, "v7", 20)
    got = {r.model: r for r in fitted.collect()}
    assert {m: r.n for m, r in got.items()} == {"a": 300, "b": 300, "c": 1} and {r.version for r in got.values()} == {"v7"}
    for m in "ab":
        bins = {}
        for _, model, _, s, right in rows:
            if model == m and s is not None and right is not None:
                bins.setdefault(min(19, int(float(s) * 100) * 20 // 100), []).append(right)
        shares = [bins[b] for b in sorted(bins)]
        mean = lambda j, k, shares=shares: sum(map(sum, shares[j : k + 1])) / sum(map(len, shares[j : k + 1]))
        want = sorted({round(max(min(mean(j, k) for k in range(i, len(shares))) for j in range(i + 1)), 6) for i in range(len(shares))})
        assert [float(k.value) for k in got[m].knots] == want and [k.at for k in got[m].knots] == sorted(k.at for k in got[m].knots)
    results = spark.createDataFrame([("p", "k", "t", s) for s in ("0.1", "0.2", "0.35", "0.5", "0.9", None)] + [("p", "none", "t", "0.5")], "provider string, model string, task string, raw_score string")
    knots = spark.createDataFrame([("p", "k", "t", "v1", [("0.2", "0.5"), ("0.5", "0.8")], 2)], "provider string, model string, task string, version string, knots array<struct<at: string, value: string>>, n long").withColumn("knots", F.col("knots").cast("array<struct<at: decimal(9,6), value: decimal(9,6)>>"))
    read = {r.raw_score if r.model == "k" else "other": r.normalized_score for r in recognition.calibrated(results, knots).collect()}
    assert {k: None if v is None else float(v) for k, v in read.items()} == {"0.1": 0.5, "0.2": 0.5, "0.35": 0.65, "0.5": 0.8, "0.9": 0.8, None: None, "other": None}


def test_gold(spark):
    for n, k in ((0, 0), (1, 0), (10, 10), (50, 47), (400, 3)):
        low, high = report.binomial_bounds(k, n)
        tail = lambda p, ks, n=n: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in ks)
        assert n == 0 or (k == 0 and low == 0 or abs(tail(low, range(k, n + 1)) - 0.025) < 1e-6) and (k == n and high == 1 or abs(tail(high, range(k + 1)) - 0.025) < 1e-6)
    frame = lambda rows: spark.createDataFrame(rows, "id int, answer string")
    gold = frame([(i, "x") for i in range(40)])
    before = frame([(i, "x") for i in range(30)] + [(31, "bad"), (99, "y")])
    judge = lambda rows: report.gold_regression(before, frame(rows), gold, "id").first()
    same, fewer, wrong, better = judge([(i, "x") for i in range(30)]), judge([(i, "x") for i in range(20)]), judge([(i, "x") for i in range(38)] + [(39, "z")]), judge([(i, "x") for i in range(38)])
    assert (same.accepted, same.correct, same.lost, same.won, same.wrong_new, same.chance, same.refused) == (30, 30, 0, 0, 0, 1, False)
    assert (fewer.lost, fewer.won, fewer.refused) == (10, 0, True) and fewer.chance == round(2 / 2**10, 6)
    assert (wrong.wrong_new, wrong.refused) == (1, True) and (better.won, better.lost, better.refused) == (8, 0, False)
    assert judge([]).refused and report.gold_regression(before, before, gold.limit(0), "id").first().accepted == 0


def test_walk(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(40), rnd.randrange(40)) for _ in range(60)] + [(None, 1), (1, None), (3, 3)]
    got = {(r.start, r.node): r.steps for r in graph.reached(spark.createDataFrame(edges, "source int, target int"), spark.createDataFrame([(i,) for i in (0, 1, 2, 77, None)], "start int")).collect()}
    want = {}
    for s in (0, 1, 2, 77):
        want[s, s], layer = 0, {s}
        for step in itertools.count(1):
            layer = {t for a, t in edges if a in layer and t is not None} - {n for x, n in want if x == s}
            if not layer:
                break
            want |= {(s, n): step for n in layer}
    assert got == want
