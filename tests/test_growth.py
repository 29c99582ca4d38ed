"""What work and memory follow: tables are made once, tasks follow the rows, Python gets only what it must."""

import re
import sys
import unicodedata

from pyspark.sql import functions as F

from quillmill.functions import text
from quillmill.operators import alignment, graph, splitting


def test_cut_makes_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    out = graph.cut(spark.range(10).mapInPandas(counted, "id long"))
    assert sorted(r.id for r in out.collect()) == list(range(10)) and made.value == 10


def test_answer_tasks_follow_lines(spark, monkeypatch):
    monkeypatch.setattr(splitting, "LINES", 10)
    rows = [(f"d{d}", f"d{d}_{i}", i, "paragraph", f"{i + 1}. A") for d in range(20) for i in range(5)]
    blocks = spark.createDataFrame(rows, "document_id string, block_id string, ord int, type string, raw_text string")
    found = splitting.extract_answers(blocks)
    assert found.rdd.getNumPartitions() == 10 and found.count() == 100


def test_blocks_are_spread(spark):
    pairs = spark.range(40).select(F.col("id").alias("cluster_id"), F.lit("q").alias("q"), F.lit("a").alias("a"), F.lit(1).alias("qp"), F.lit(1).alias("ap"), F.lit(5).alias("gain"))
    found = alignment.chains(pairs)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString() and found.where("sure").count() == 40


def test_only_what_may_compose_goes_to_python(spark):
    """Signs left out neither change alone, nor reorder, nor compose with what stands before them."""
    signs = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    parts = [unicodedata.decomposition(c).split() for c in signs]
    second = {chr(int(p[1], 16)) for p in parts if len(p) == 2 and not p[0].startswith("<")} | {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    left_out = [c for c in signs if not re.match(text.MAY_COMPOSE, c)]
    assert len(left_out) > 30000 and not [c for c in left_out if unicodedata.normalize("NFC", c) != c or unicodedata.combining(c) or c in second]
    values = [None, "", "plain", "é", "각", "각", "が", "Å", "יִ", "中文。", "naïve"]
    got = spark.createDataFrame(list(enumerate(values)), "i int, t string").select("i", text.nfc(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in got} == {i: None if v is None else unicodedata.normalize("NFC", v) for i, v in enumerate(values)}
