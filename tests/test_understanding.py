from pyspark.sql import functions as F

from quillmill.operators import understanding as U
from quillmill.operators.graph import groups

BLOCKS = "document_id string, block_id string, ord int, type string, raw_text string, resolved_label string"


def blocks(spark, **docs):
    return spark.createDataFrame([(d, f"{d}{i}", i, "paragraph", t, None) for d, texts in docs.items() for i, t in enumerate(texts)], BLOCKS)


def test_classes(spark):
    df = blocks(
        spark, q=["2024年北京市中考数学试卷", "1. 1+1= A. 1 B. 2", "2. x ____"], a=["参考答案", "1. B", "2. 5"], both=["卷", "1. 1+1= A. 1 B. 2", "参考答案", "1. B"], mixed=["1. 1+1= A. 1 B. 2", "【答案】B", "2. 3+3 ="], none=["text", None],
    )
    got = {r.document_id: r for r in U.classify(U.features(df)).collect()}
    assert {k: r.document_class for k, r in got.items()} == {"q": "QUESTION", "a": "ANSWER", "both": "QUESTION_AND_ANSWER", "mixed": "MIXED", "none": "UNKNOWN"}
    assert got["q"].question_numbers == ["1", "2"] and got["a"].answer_numbers == ["1", "2"] and got["both"].answer_numbers == ["1"]


def test_model_class(spark):
    df = spark.createDataFrame([("UNKNOWN", "ANSWER", ["a", "c"]), ("UNKNOWN", "ESSAY", ["a"]), ("UNKNOWN", "ANSWER", ["c", "a"]), ("UNKNOWN", "ANSWER", ["z"]), ("UNKNOWN", "ANSWER", []), ("QUESTION", "ANSWER", ["a"])], "rule string, model string, cited array<string>")
    ids = F.array(*map(F.lit, "abc"))
    assert [r[0] for r in df.select(U.fused_class(F.col("rule"), F.col("model"), F.col("cited"), ids)).collect()] == ["ANSWER", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", "QUESTION"]


def test_metadata(spark):
    names = spark.createDataFrame([("d", "2023年上海市高二物理试卷.docx")], "document_id string, source_file string")
    values = U.metadata_values(names, blocks(spark, d=["北京市2024年高考数学真题"]))
    best = {r.field: (r.value, r.source) for r in U.prioritised(values, "document_id").collect()}
    assert best == {"course": ("数学", "document"), "year": ("2024", "document"), "city": ("北京", "document"), "exam": ("高考", "document"), "level": ("高中二年级", "file_name")}


def documents(spark, rows):
    return spark.createDataFrame(rows, "document_id string, source_file string, title string, document_class string, question_numbers array<string>, answer_numbers array<string>, course string, level string, year string, city string, exam string")


def test_clusters(spark):
    row = lambda d, f, k, q=(), a=(), course=None: (d, f, None, k, list(q), list(a), course, None, None, None, None)
    df = documents(spark, [
        row("a", "期中数学.docx", "QUESTION", "123"), row("b", "期中数学答案.docx", "ANSWER", a="123"),  # a pair
        row("c", "期末物理卷.docx", "QUESTION", "12", course="物理"), row("d", "期末物理卷答案.docx", "ANSWER", a="12", course="化学"),  # they disagree
        row("e", "月考语文.docx", "QUESTION", "12"), row("f", "月考语文试卷.docx", "QUESTION", "12"), row("g", "月考语文答案.docx", "ANSWER", a="12"),  # whose answers?
        row("h", "x.docx", "QUESTION", "1"), row("i", "单元测试.docx", "QUESTION", "1"), row("j", "单元测试答案.docx", "ANSWER", a="789"),
    ])
    got = {r.document_id: r.cluster_id for r in U.clusters(df).collect()}
    assert got == {k: "exam_" + {"b": "a"}.get(k, k) for k in "abcdefghij"}
    assert U.clusters(df.limit(0)).count() == 0


def test_groups(spark):
    chain = spark.createDataFrame([(i, k) for i in range(12) for k in (i, i + 1)] + [(50, None), (60, 99), (61, 99)], "n int, k int")
    assert {r.n: r.group_id for r in groups(chain, "n", "k").collect()} == {**dict.fromkeys(range(12), 0), 50: 50, 60: 60, 61: 60}
