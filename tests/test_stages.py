from pyspark.sql import functions as F

from quillmill.operators import gates, splitting
from quillmill.sources import runs


def blocks(spark, texts):
    rows = [("d", f"b{i:03}", i, "paragraph", t, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "document_id string, block_id string, ord int, type string, raw_text string, resolved_label string")


def test_split(spark):
    df = blocks(spark, ["title", "1. stem", "A. x B. y", "2. fill ____", "（1）sub", "4. jump"])
    got = sorted(splitting.split_questions(df).collect(), key=lambda r: r.question_candidate_id)
    assert [(r.question_number, r.content_blocks, r.question_type_candidate, str(r.split_score)) for r in got] == [
        ("1", ["b001", "b002"], "选择题", "0.990000"), ("2", ["b003", "b004"], "填空题", "0.990000"), ("4", ["b005"], "未知", "0.950000"),
    ]


def test_answers(spark):
    df = blocks(spark, ["1. A 2. B 3. C", "4. 【答案】x=2【解析】because", "5. 【解析】only", "plain", "6. 3.14"])
    got = splitting.extract_answers(df)
    assert {(r.question_number, r.answer, r.analysis) for r in got.collect()} == {("1", "A", "略"), ("2", "B", "略"), ("3", "C", "略"), ("4", "x=2", "because"), ("6", "3.14", "略")}
    assert splitting.unsupported(got, df).count() == 0
    long = blocks(spark, ["参考答案", "1. first step x=1", "hence y=2", "【解析】why", "and so", "2. B", "答案与解析", "loose", "3. 【答案】C", "3. 【解析】as said"])
    whole = splitting.extract_answers(long)
    assert {(r.question_number, r.answer, r.analysis, tuple(r.source_blocks)) for r in whole.collect()} == {("1", "first step x=1\nhence y=2", "why\nand so", ("b001", "b002", "b003", "b004")), ("2", "B", "略", ("b005",)), ("3", "C", "as said", ("b008", "b009"))}
    assert splitting.unsupported(whole, long).count() == 0 and splitting.unsupported(whole, long.where("block_id <> 'b002'")).count() == 1
    made_up = got.withColumn("answer", F.when(F.col("question_number") == "4", "x=7").otherwise(F.col("answer")))
    assert [r.question_number for r in splitting.unsupported(made_up, df).collect()] == ["4"]


def test_runs(spark):
    states = spark.createDataFrame([("r", "parse", "a", "RUNNING", 1), ("r", "parse", "a", "COMPLETED", 2), ("r", "parse", "b", "RUNNING", 3), ("r", "parse", "b", "FAILED", 4), ("r", "ocr", "a", "COMPLETED", 5)], "run_id string, stage string, item string, state string, seq long")
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "item string")
    assert {r.item for r in runs.pending(items, states, "parse", "r").collect()} == {"b", "c"}
    assert [r.seq for r in runs.illegal(states).collect()] == [5]
    files = spark.createDataFrame([("x",), ("y",)], "source_sha256 string")
    assert runs.fingerprint(files, "c", "1") == runs.fingerprint(files.orderBy(F.desc("source_sha256")), "c", "1") != runs.fingerprint(files, "c", "2")
    hits, misses = runs.through_cache(items, spark.createDataFrame([("a", "p")], "cache_key string, payload string"), F.col("item"))
    assert (hits.count(), misses.count()) == (1, 2)


def test_gates(spark):
    df = spark.createDataFrame([(1, True, True), (2, False, True), (3, False, False), (4, None, False)], "id int, a boolean, b boolean")
    got = gates.outcome(df, [("file", "DOCUMENT_PARSE_FAILED", F.col("a")), ("match", "ANSWER_NOT_FOUND", F.col("b"))])
    assert {r.id: r.reason_code for r in got.collect()} == {1: "DOCUMENT_PARSE_FAILED", 2: "ANSWER_NOT_FOUND", 3: None, 4: "DOCUMENT_PARSE_FAILED"}
    assert gates.accepted(got).count() + gates.rejected(got, F.col("id")).count() == 4
