"""Each stage of the corpus pipeline on odd tables: columns stay, rows are kept or gone as they should, empty tables pass."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    rnd = random.Random(2)
    prose = lambda n: " ".join(rnd.choice([f"word{rnd.randrange(3000)}", "the", "of", "and"]) for _ in range(n)) + "."
    junk = lambda n: " ".join(rnd.choice(["BUY!!", "$$$", "###", "CLICK|HERE"]) for _ in range(n))
    item, shared, copied = prose(40), prose(70), prose(300)
    texts = [prose(200) if i % 4 else junk(60) for i in range(200)]
    texts[1], texts[5] = copied, copied.replace("the", "a", 1)  # near copies
    texts[2], texts[6] = f"{prose(80)}\n{shared}\n{prose(80)}", f"{prose(90)}\n{shared}\n{prose(70)}"  # a passage of both
    texts[3] = f"{prose(60)} {item} {prose(60)}"  # a benchmark item
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)] + [(None, prose(120), "en", None, None), (300, prose(150), None, "a", 7), (300, prose(150), None, "a", 7)]
    docs = spark.createDataFrame(rows, COLUMNS)
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality classifier"](spark, docs, str(tmp_path))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and {1, 2, 3, 5, 6, 300, None} <= ids and not ids & set(range(0, 200, 4))
    lines = stage["line dedup"](spark, docs, str(tmp_path))
    at = {r.doc_id: r for r in lines.collect()}
    assert lines.columns == docs.columns and lines.count() == len(rows) and shared in at[2].text and shared not in at[6].text
    assert at[6].n_chars == len(at[6].text) and at[2].n_chars == len(texts[2]) and at[7].text == texts[7]
    near = stage["near-duplicates"](spark, docs, str(tmp_path))
    left = [r.doc_id for r in near.collect()]
    assert near.columns == docs.columns and sorted(x for x in left if x is not None) == [i for i in [*range(200), 300] if i != 5] and left.count(None) == 1
    clean = stage["benchmark decontamination"](spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and sorted(r.doc_id for r in docs.exceptAll(clean).collect()) == [3]
    pieces = stage["packing"](spark, docs, str(tmp_path))
    assert pieces.where("start = 0").count() == len(rows)
    for name, run in corpus_pipeline.STAGES:
        assert run(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    done = corpus_pipeline.run(spark, str(tmp_path))
    found = {r.doc_id for r in done.collect()}
    assert {1, 2, 6, 300, None} <= found and not found & {3, 5, *range(0, 200, 4)}
    assert done.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n <> 2048").count() <= 12
