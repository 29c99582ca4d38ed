import asyncio
import json

import pytest
from pyspark.sql import functions as F
from fakes import Fake
from test_docx import T, write

from quillmill import cli
from quillmill.operators import graph
from quillmill.operators import providers as P
from quillmill.plans import pipeline
from quillmill.sources import config as C



def paragraphs(*texts):
    return "".join(f"<w:p>{T(t)}</w:p>" for t in texts)


def exam(folder):
    folder.mkdir()
    write(folder / "期中数学.docx", paragraphs("2024年北京市初一数学期中", "1. 1+1= A. 1 B. 2", "2. 2+2= A. 4 B. 5", "3. 3+3= ____", "4. 4+4= ____"))
    write(folder / "期中数学答案.docx", paragraphs("参考答案", "1. B", "2. A", "4. 8【解析】4+4"))
    write(folder / "口算练习题.docx", f"<w:p>{T('1. 已知 ')}<m:oMath><m:f><m:num><m:r><m:t>1</m:t></m:r></m:num><m:den><m:r><m:t>x</m:t></m:r></m:den></m:f></m:oMath>{T(' in x, 求 ____')}</w:p>")
    write(folder / "期末物理卷.docx", paragraphs("高二物理期末", "1. g= ____"))
    (folder / "broken.docx").write_bytes(b"no package")
    return str(folder)


def test_run(spark, tmp_path):
    source, out = exam(tmp_path / "in"), str(tmp_path / "out")
    config = C.validated({"providers": {"llm": {"verifier": "fakes:verifier"}}})
    done = pipeline.run(spark, source, out, config)
    rows = [json.loads(line) for f in (tmp_path / "out" / done.run_id / "questions.jsonl").glob("*.json") for line in f.read_text(encoding="utf-8").splitlines()]
    assert {(r["text_question"], r["text_answer"], r["answer_analysis"]) for r in rows} == {("1. 1+1= A. 1 B. 2", "B", "略"), ("2. 2+2= A. 4 B. 5", "A", "略"), ("4. 4+4= ____", "8", "4+4")}
    assert all(len(r) == 19 and (r["text_course"], r["text_grade_level"], r["text_grade"], r["text_year"], r["text_city"], r["language"]) == ("数学", "初中一年级", "初中", "2024", "北京", "zh") for r in rows)
    rejected = [json.loads(line) for f in (tmp_path / "out" / done.run_id / "rejected.jsonl").glob("*.json") for line in f.read_text(encoding="utf-8").splitlines()]
    assert sorted(r["reason_code"] for r in rejected) == ["ANSWER_NOT_FOUND", "ANSWER_NOT_FOUND", "ANSWER_NOT_FOUND", "DOCUMENT_PARSE_FAILED"]
    assert (done.report["candidates"], done.report["accepted"], done.report["documents"], done.report["calls"][0]["calls"]) == (6, 3, 5, 3)
    inline = spark.read.parquet(f"{out}/workspace/{done.run_id}/outcomes").where("source_file = '口算练习题.docx'").first()
    assert (inline.text_question, inline.language) == (r"1. 已知 $\frac{1}{x}$ in x, 求 ____", "zh")
    work = f"{out}/workspace/{done.run_id}"
    some = spark.read.parquet(f"{work}/outcomes").where("reason_code IS NULL").first().question_candidate_id
    assert {r.side: r.source_file for r in pipeline.trace(spark, work, some).collect()} == {"question": "期中数学.docx", "answer": "期中数学答案.docx"}
    edges = pipeline.lineage(spark, work)
    rests = {r.node for r in graph.reached(edges, spark.createDataFrame([(f"candidate:{some}",)], "start string")).collect()}
    assert {"file:期中数学.docx", "file:期中数学答案.docx", "model:judge/fake-1/answer_verify/v1", f"configuration:{config.digest}"} <= rests and "file:期末物理卷.docx" not in rests
    # the same run again sends no call and gives the same id; without a good verifier nothing is accepted
    config_again = C.validated({"providers": {"llm": {"verifier": "fakes:verifier"}}})
    assert pipeline.run(spark, source, out, config_again).run_id == done.run_id and pipeline.Workspace(spark, work).first_incomplete() is None
    other = pipeline.run(spark, source, out, C.validated({"providers": {"llm": {"verifier": "fakes:meddler"}}}))
    assert other.run_id != done.run_id and other.report["accepted"] == 0 and other.report["reasons"]["ANSWER_VERIFICATION_FAILED"] == 3
    assert cli.main(["report", done.run_id, "--output", out]) == 0


def test_resume(spark, tmp_path, monkeypatch):
    """No finished call is sent again: not after a stop at any stage, not with another threshold."""
    source, out, notes = exam(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "calls"
    notes.touch()
    monkeypatch.setenv("FAKE_CALLS", str(notes))
    providers = {"llm": {"verifier": "fakes:counting"}}
    config = C.validated({"providers": providers})
    done = pipeline.run(spark, source, out, config)
    assert len(notes.read_text()) == 3 and done.report["accepted"] == 3
    work = tmp_path / "out" / "workspace" / done.run_id
    for stage in ("verdicts", "calls_verify", "matches", "outcomes"):
        (work / stage).rename(tmp_path / f"gone-{stage}")
        again = pipeline.run(spark, source, out, config)
        assert (again.run_id, again.report["accepted"], len(notes.read_text())) == (done.run_id, 3, 3)
    other = pipeline.run(spark, source, out, C.validated({"providers": providers, "quality": {"split_accept": 0.97}}))
    assert other.run_id != done.run_id and len(notes.read_text()) == 3 and other.report["accepted"] == 4 - 1
    assert other.report["calls"][0]["cache_hit_rate"] == 1


def test_retry():
    def tried(*failures, tries=3):
        fake = Fake("f", lambda p: "x", failures=failures)
        return asyncio.run(P.attempted(fake, b"", tries, 0.001, 1.0)), len(fake.failures)

    assert tried("429", "503")[0][0].content == "x"
    assert tried("401", "429") == ((None, "401"), 1) and tried("contract")[0] == (None, "contract")
    assert tried("timeout", "reset", "500")[0] == (None, "500")


def test_recognition(spark):
    assets = spark.createDataFrame([("a", "text_ocr", True, b"1"), ("b", "text_ocr", True, b"2"), ("c", "text_ocr", False, b"1"), ("d", "text_ocr", True, b"3")], "block_id string, task string, is_critical boolean, content binary")
    scale = spark.createDataFrame([("one", "fake-1", "text_ocr", "1", "0"), ("two", "fake-1", "text_ocr", "1", "0")], "provider string, model string, task string, slope string, shift string")
    scale = scale.withColumns({c: F.col(c).cast("decimal(9,6)") for c in ("slope", "shift")})
    one, two = Fake("one", {b"1": "one", b"2": "two", b"3": "three"}, 0.97), Fake("two", {b"1": "one", b"2": "other", b"3": "three"}, 0.99)
    settled, calls = P.recognised(assets, one, two, scale, None, 4)
    assert {r.block_id: (r.action, r.content) for r in settled.collect()} == {"a": ("accept", "one"), "b": ("reject", "other"), "c": ("accept", "one"), "d": ("accept", "three")}
    assert calls.count() == 6
    never = Fake("one", lambda p: 1 / 0, 0.97), Fake("two", lambda p: 1 / 0, 0.97)
    again, calls = P.recognised(assets, *never, scale, calls, 4)
    assert again.count() == 4 and calls.where("cache_hit").count() == 6 == calls.count()
    untrusted, _ = P.recognised(assets, one, None, scale.limit(0), None, 2, tasks=2)
    assert {r.action for r in untrusted.collect()} == {"reject"}


def test_config(tmp_path):
    assert C.validated({}).digest == C.validated({}).digest != C.validated({"quality": {"split_accept": 0.97}}).digest
    for bad in ({"quality": {"split_accept": 2}}, {"quality": {"recognition_fallback_floor": 0.99}}, {"providers": {"llm": {"api_key": "x"}}}, {"concurrency": {"llm": 0}}, {"surprise": 1}):
        with pytest.raises(C.ConfigError):
            C.validated(bad)
    (tmp_path / "c.yaml").write_text("quality:\n  split_accept: 3\n")
    assert cli.main(["config", "validate", "--config", str(tmp_path / "c.yaml")]) == 2 and cli.main(["config", "validate"]) == 0
    assert all(C.prompt(t) for t in ("document_classify", "question_split", "answer_extract", "answer_verify", "metadata"))
