"""Questions and answers of one cluster: candidate scores, alignment, abstention."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.operators.alignment import chains
from quillmill.schemas import SCORE

#: Weights of the evidence, version 1. Values chosen here; they add up to 1.
WEIGHTS = {"number": 0.35, "sequence": 0.15, "file": 0.1, "type": 0.1, "counts": 0.05, "format": 0.05, "order": 0.1, "semantic": 0.05, "title": 0.05}


def candidate_pairs(questions: DataFrame, answers: DataFrame, reach: int) -> DataFrame:
    """(cluster_id, q, a): pairs of one cluster, from (cluster_id, q, qp, qn, low, last_qp) and (cluster_id, a, ap, an).

    An answer within `reach` places of a question is a candidate, counted from the beginning or from the last aligned
    question (last_qp, with its answer at low), and so is one of the same number, if the number stands once on one
    side: a number that both sides repeat tells nothing, and its pairs would grow with the square of a cluster.
    """
    expected = F.coalesce(F.col("low") + F.col("qp") - F.col("last_qp"), F.col("qp")).cast("int")
    near = F.array_union(F.sequence(F.col("qp") - reach, F.col("qp") + reach), F.sequence(expected - reach, expected + reach))
    placed = questions.select("cluster_id", "q", F.explode(near).alias("ap")).join(answers.select("cluster_id", "ap", "a"), ["cluster_id", "ap"]).select("cluster_id", "q", "a")
    counted = lambda df, n, c: df.groupBy("cluster_id", F.col(n).alias("number")).agg(F.count("*").alias(c))
    telling = counted(questions, "qn", "nq").join(counted(answers, "an", "na"), ["cluster_id", "number"]).where("nq = 1 OR na = 1").select("cluster_id", "number")
    mine = questions.select("cluster_id", F.col("qn").alias("number"), "q").join(telling, ["cluster_id", "number"])
    same = mine.join(answers.select("cluster_id", F.col("an").alias("number"), "a"), ["cluster_id", "number"]).select("cluster_id", "q", "a")
    return placed.union(same).distinct()


def evidence_score(signals: dict[str, Column], conflict: Column | None = None) -> Column:
    """The weighted sum of signals in 0 to 1; absent ones count 0. A conflict makes it 0."""
    unknown = set(signals) - set(WEIGHTS)
    if unknown:
        raise ValueError(f"no weight for {sorted(unknown)}")
    total = sum((F.lit(WEIGHTS[k]).cast(SCORE) * F.coalesce(v.cast(SCORE), F.lit(0).cast(SCORE)) for k, v in signals.items()), F.lit(0).cast(SCORE)).cast(SCORE)
    return total if conflict is None else F.when(F.coalesce(conflict, F.lit(True)), F.lit(0).cast(SCORE)).otherwise(total)


def top_two(scored: DataFrame, question: str, candidate: str, score: str) -> DataFrame:
    """(question, candidate, top1, top2): the best candidate of each question, and the second score (0 without one).

    Ties go to the smaller candidate.
    """
    order = W.partitionBy(question).orderBy(F.col(score).desc(), F.col(candidate))
    ranked = scored.where(F.col(score).isNotNull()).withColumn("rank", F.row_number().over(order)).where("rank <= 2")
    value = F.col(score).cast(SCORE)
    return ranked.groupBy(question).agg(F.max(F.when(F.col("rank") == 1, F.col(candidate))).alias(candidate), F.max(value).alias("top1"), F.coalesce(F.max(F.when(F.col("rank") == 2, value)), F.lit(0).cast(SCORE)).alias("top2"))


def abstention(top1: Column, top2: Column, verifier: Column, verdict: Column | None = None, match: str = "0.995", margin: str = "0.10", verify: str = "0.995") -> Column:
    """PASS or the reason for none. Scores are decimals: the margin is exact."""
    d = lambda v: F.lit(v).cast(SCORE)
    a, b, v = top1.cast(SCORE), F.coalesce(top2.cast(SCORE), d("0")), verifier.cast(SCORE)
    passed = F.lit(True) if verdict is None else F.coalesce(verdict == "PASS", F.lit(False))
    return (
        F.when(a.isNull(), "ANSWER_NOT_FOUND").when((a < d(match)) | (a - b < d(margin)), "ANSWER_MATCH_AMBIGUOUS")
        .when(v.isNull() | (v < d(verify)) | ~passed, "ANSWER_VERIFICATION_FAILED").otherwise("PASS")
    )


def _sure(group: pd.DataFrame) -> pd.DataFrame:
    """The rows that are in every longest rising sequence of answer places, in order of question places."""
    places = group.sort_values("qp")["ap"].tolist()

    def lengths(values: list[int]) -> list[int]:
        """Of each place, the length of the longest rising sequence that ends there."""
        tops: list[int] = []
        out = []
        for v in values:
            at = bisect_left(tops, v)
            tops[at : at + 1] = [v]
            out.append(at + 1)
        return out

    ends, starts = lengths(places), lengths([-v for v in places[::-1]])[::-1]
    longest = max(ends)
    on = Counter(e for e, s in zip(ends, starts, strict=True) if e + s - 1 == longest)
    keep = [e + s - 1 == longest and on[e] == 1 for e, s in zip(ends, starts, strict=True)]
    return group.sort_values("qp")[keep]


def align(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """(cluster_id, op, question_id, answer_id) from (cluster_id, ord, number, id) of both sides: match, skip-question or skip-answer.

    Numbers that stand once on each side pair up; others are ambiguous or alone and are skipped. Of these pairs, those
    match that every longest order-keeping sequence has, so a missing answer does not shift later ones and what order
    leaves open is skipped. A pair that all pairs before it precede on both sides is in every such sequence; it is
    found by windows, and only the disordered stretches between such pairs are aligned in a task. Null numbers pair
    with none; an empty side gives skips alone.
    """
    pick = lambda df: df.select(F.col("cluster_id").cast("string").alias("cluster_id"), F.col("ord"), F.col("number").cast("string").alias("number"), F.col("id").cast("string").alias("id"))
    once = lambda df, o, i: df.where("number IS NOT NULL").groupBy("cluster_id", "number").agg(F.min("ord").alias(o), F.min("id").alias(i), F.count("*").alias("n")).where("n = 1").drop("n")
    q, a = pick(questions), pick(answers)
    pairs = once(q, "qo", "question_id").join(once(a, "ao", "answer_id"), ["cluster_id", "number"])
    of = W.partitionBy("cluster_id")
    pairs = pairs.withColumn("ap", F.row_number().over(of.orderBy("ao", "answer_id"))).withColumn("qp", F.row_number().over(of.orderBy("qo", "question_id")))
    along = of.orderBy("qp").rowsBetween(W.unboundedPreceding, 0)
    pairs = pairs.withColumn("anchor", (F.col("ap") == F.col("qp")) & (F.max("ap").over(along) == F.col("qp")))
    pairs = pairs.withColumn("stretch", F.sum(F.col("anchor").cast("long")).over(along)).select("cluster_id", "stretch", "anchor", "qp", "ap", "question_id", "answer_id")
    loose = pairs.where("NOT anchor").groupBy("cluster_id", "stretch").applyInPandas(_sure, pairs.schema)
    matched = pairs.where("anchor").unionByName(loose).select("cluster_id", F.lit("match").alias("op"), "question_id", "answer_id")
    none = F.lit(None).cast("string")
    lone = lambda df, c: df.withColumnRenamed("id", c).join(matched.select("cluster_id", c), ["cluster_id", c], "left_anti")
    skipped_q = lone(q, "question_id").select("cluster_id", F.lit("skip-question").alias("op"), "question_id", none.alias("answer_id"))
    skipped_a = lone(a, "answer_id").select("cluster_id", F.lit("skip-answer").alias("op"), none.alias("question_id"), "answer_id")
    return matched.unionByName(skipped_q).unionByName(skipped_a)


def signals(questions: DataFrame, answers: DataFrame, reach: int = 2, aligned: DataFrame | None = None, meaning: DataFrame | None = None) -> DataFrame:
    """(cluster_id, q, a, qp, ap, conflict, and a column for each of WEIGHTS): the evidence for pairs of one cluster, each signal 0 or 1.

    Both sides have cluster_id, ord, number (int), id, document, file (what file names of one exam share) and fields (an
    array of what the document says of itself); questions have kind and stem, answers have answer. The pairs are those of
    candidate_pairs, so an answer under another number is seen and no cluster is paired with itself. Places qp and ap count
    from 1 in their cluster. `aligned` has the aligned pairs (cluster_id, q, aligned); without it they are those of align.

    number: equal. sequence: aligned in the sequences of both sides. order: the answers of the nearest aligned questions
    before and after stand before and after this one, of which one at least is there, or both sides have one
    item. file: one document, or file names of one exam. title: of the fields that both documents name one agrees; if one
    differs, the pair is in conflict. type: letters for a choice and no others. counts: not more answers than questions.
    format: letters of a choice in rising order; else text with even brackets and dollar signs and no number of a question
    before it. semantic: the pair is in `meaning` (cluster_id, q, a; see vectors.near_in_meaning), where that is given; without it the letters
    are offered; as many parts as blanks; else a sign of substance (a number, a Latin word or two Chinese characters) is in both
    texts. What cannot be said is 0.
    """
    of, by = W.partitionBy("cluster_id"), lambda c: W.partitionBy("cluster_id").orderBy("ord", c)
    if aligned is None:
        aligned = align(questions, answers).where("op = 'match'").select("cluster_id", F.col("question_id").alias("q"), F.col("answer_id").alias("aligned"))
    a = answers.select(F.col("cluster_id").cast("string").alias("cluster_id"), "ord", F.col("number").alias("an"), F.col("id").cast("string").alias("a"), F.col("document").alias("ad"), F.col("file").alias("af"), F.col("fields").alias("afields"), "answer")
    a = a.withColumn("ap", F.row_number().over(by("a"))).withColumn("na", F.count("*").over(of))
    q = questions.select(F.col("cluster_id").cast("string").alias("cluster_id"), "ord", F.col("number").alias("qn"), F.col("id").cast("string").alias("q"), F.col("document").alias("qd"), F.col("file").alias("qf"), F.col("fields").alias("qfields"), "kind", "stem")
    q = q.withColumn("qp", F.row_number().over(by("q"))).withColumn("nq", F.count("*").over(of)).join(aligned, ["cluster_id", "q"], "left")
    q = q.join(a.select("cluster_id", F.col("a").alias("aligned"), F.col("ap").alias("at")), ["cluster_id", "aligned"], "left")
    past, next_ = by("q").rowsBetween(W.unboundedPreceding, -1), by("q").rowsBetween(1, W.unboundedFollowing)
    q = q.withColumns({"low": F.last("at", ignorenulls=True).over(past), "high": F.first("at", ignorenulls=True).over(next_), "last_qp": F.last(F.when(F.col("at").isNotNull(), F.col("qp")), ignorenulls=True).over(past)})
    pairs = candidate_pairs(q, a, reach).join(q.drop("ord"), ["cluster_id", "q"]).join(a.drop("ord"), ["cluster_id", "a"])
    letters = F.coalesce(F.col("answer").rlike("^[A-H]{1,8}$"), F.lit(False))
    each = F.split("answer", "")
    both = F.zip_with("qfields", "afields", lambda x, y: F.when(x.isNotNull() & y.isNotNull(), x == y))
    one = F.col("qd") == F.col("ad")
    choice = F.col("kind") == "选择题"
    even = (F.regexp_count("answer", F.lit(r"[(（\[【{]")) == F.regexp_count("answer", F.lit(r"[)）\]】}]"))) & (F.regexp_count("answer", F.lit(r"\$")) % 2 == 0) & ~F.col("answer").rlike(r"^\s*\d{1,3}\s*[.．、)）](?!\d)") & (F.trim("answer") != "")
    marks = lambda c: F.array_union(F.regexp_extract_all(c, F.lit(r"[0-9]+|[A-Za-z]+"), F.lit(0)), F.regexp_extract_all(c, F.lit(r"(?=([一-龥]{2}))"), F.lit(1)))
    blanks = F.regexp_count("stem", F.lit(r"_{3,}|（\s*）"))
    order = (F.col("low").isNull() | (F.col("low") < F.col("ap"))) & (F.col("high").isNull() | (F.col("ap") < F.col("high"))) & (F.col("low").isNotNull() | F.col("high").isNotNull() | ((F.col("nq") == 1) & (F.col("na") == 1)))
    semantic = F.when(choice, letters & F.forall(each, lambda x: F.contains("stem", x))).when(blanks > 0, F.size(F.split("answer", "[;；]")) == blanks).otherwise(F.arrays_overlap(marks("stem"), marks("answer")))
    if meaning is not None:
        near = meaning.select("cluster_id", "q", "a", F.lit(True).alias("near")).distinct()
        pairs, semantic = pairs.join(near, ["cluster_id", "q", "a"], "left"), F.col("near")
    made = {
        "number": F.col("qn") == F.col("an"), "sequence": F.col("aligned") == F.col("a"), "file": one | (F.col("qf") == F.col("af")), "type": choice == letters, "counts": F.col("na") <= F.col("nq"),
        "format": F.when(letters, F.array_join(F.array_sort(F.array_distinct(each)), "") == F.col("answer")).otherwise(even), "order": order, "semantic": semantic, "title": one | F.exists(both, lambda x: x),
    }
    conflict = F.coalesce(~one & F.exists(both, lambda x: ~x), F.lit(False))
    return pairs.select("cluster_id", "q", "a", "qp", "ap", conflict.alias("conflict"), *[F.coalesce(made[k], F.lit(False)).cast("int").alias(k) for k in WEIGHTS])


def weighed(questions: DataFrame, answers: DataFrame, reach: int = 2, gap: float = 0.1, block: int = 512, meaning: DataFrame | None = None) -> DataFrame:
    """(cluster_id, q, aligned): the pairs that every best alignment of the two sequences has.

    An alignment keeps the order of both sides. It gains the evidence of its pairs, of all signals that need no alignment, and pays
    `gap` for each item of either side that it skips. Pairs in conflict or without evidence are never aligned. So items that were renumbered, or
    have others put in before them, find their partners by what they are and where they stand, and what several best
    alignments settle differently stays open. See chains for how it is worked out.
    """
    found = signals(questions, answers, reach, meaning=meaning)
    score = evidence_score({k: F.col(k) for k in WEIGHTS if k not in ("sequence", "order")})
    gain = (score * 1_000_000).cast("long")
    pairs = found.where(~F.col("conflict")).select("cluster_id", "q", "a", "qp", "ap", gain.alias("gain")).where("gain > 0")
    # to skip both sides costs two gaps; so a pair is worth its evidence and two gaps more than none
    return chains(pairs.withColumn("gain", F.col("gain") + F.lit(round(gap * 2_000_000))), block).where("sure").select("cluster_id", "q", F.col("a").alias("aligned"))
