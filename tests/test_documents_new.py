"""Embedded equations, lines without loss, image classes, boundaries by a model, exam clusters under constraints, answers by place."""

import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from fakes import Fake
from pyspark.sql import functions as F
from test_docx import T, W, write
from test_stages import blocks
from test_understanding import documents

from quillmill.operators import images, providers, splitting
from quillmill.operators import understanding as U
from quillmill.plans import pipeline
from quillmill.sources import config as C
from quillmill.sources import docx, equations

V = 'xmlns:v="urn:schemas-microsoft-com:vml" xmlns:o="urn:schemas-microsoft-com:office:office"'


# equation records of version 5
def line(*items):
    return b"\x01\x00" + b"".join(items) + b"\x00"


NULL = b"\x01\x01"


def sign(c):
    return b"\x02\x00\x83" + struct.pack("<H", ord(c))


def template(selector, variation, *items):
    return bytes([3, 0, selector, variation, 0]) + b"".join(items) + b"\x00"


def equation(*items):
    head = b"\x05\x01\x00\x06\x00DSMT6\x00\x00"
    prefs = b"\x13WinAllBasicCodePages\x00" + b"\x11\x05Times\x00" + b"\x12\x00" + b"\x02\x2f\x3f" + b"\x01\x4f" + b"\x02\x01\x00\x00" + b"\x0a"
    return head + prefs + line(*items) + b"\x00"


def compound(stream, name="Equation Native", small=True):
    """A compound file with one stream, in small sectors or in whole ones."""
    data = struct.pack("<HIHI4I", 28, 0x20000, 0, len(stream), 0, 0, 0, 0) + stream
    if not small:
        data += bytes(max(0, 4096 - len(data)))
    free, last, table = 0xFFFFFFFF, 0xFFFFFFFE, [0xFFFFFFFD]
    sectors = lambda b: -(-len(b) // 512)
    entry = lambda n, kind, start, size: (n + "\0").encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBB3I", len(n) * 2 + 2, kind, 1, free, free, free) + bytes(36) + struct.pack("<IIi", start, size, 0)
    chain = lambda n: [len(table) + i + 1 for i in range(n - 1)] + [last]
    table += chain(1)  # sector 1: the directory
    body = []
    if small:
        count = -(-len(data) // 64)
        table += chain(1)  # sector 2: which small sectors follow
        body.append(struct.pack("<128I", *([*range(1, count), last] + [free] * (128 - count))))
        start = len(table)
        table += chain(sectors(data))
        entries = entry("Root Entry", 5, start, count * 64) + entry(name, 2, 0, len(data))
    else:
        start = len(table)
        table += chain(sectors(data))
        entries = entry("Root Entry", 5, last, 0) + entry(name, 2, start, len(data))
    body.append(data.ljust(sectors(data) * 512, b"\0"))
    header = equations._SIGNATURE + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<9I", 0, 1, 1, 0, 4096, 2 if small else last, int(small), last, 0) + struct.pack("<109I", 0, *[free] * 108)
    return header + struct.pack("<128I", *table, *[free] * (128 - len(table))) + entries.ljust(512, b"\0") + b"".join(body)


HALF = template(11, 0, line(sign("a")), line(sign("2")))


def test_equations():
    shown = {
        r"x=\frac{a}{2}": (sign("x"), sign("="), HALF), r"\sqrt{x}": (template(10, 0, line(sign("x")), NULL),), r"\sqrt[3]{x}": (template(10, 1, line(sign("x")), line(sign("3"))),),
        "x^{2}": (sign("x"), template(28, 0, NULL, line(sign("2")))), "x_{1}^{2}": (sign("x"), template(29, 0, line(sign("1")), line(sign("2")))), r"\left(a\times b\right)": (template(1, 3, line(sign("a"), sign("×"), sign("b"))),),
        r"\frac{\sqrt{x}}{y_{n}}": (template(11, 0, line(template(10, 0, line(sign("x")), NULL)), line(sign("y"), template(27, 0, line(sign("n")), NULL))),),
    }
    for want, items in shown.items():
        for small in (True, False):
            assert equations.formula(compound(equation(*items), small=small)) == want
    whole = compound(equation(HALF))
    for bad in (b"", whole[:700], b"PK" + whole, compound(equation(HALF), "Other"), compound(equation(template(16, 0, line(sign("x"))))), compound(equation(sign(""))), compound(equation(template(28, 0, NULL, line(sign("2"))))), compound(b"\x03" + equation(HALF)[1:]), compound(equation(HALF)[:-12])):
        with pytest.raises(equations.EquationError):
            equations.formula(bad)
    looped = bytearray(compound(equation(HALF), small=False))
    looped[512 + 4 * 2 : 512 + 4 * 3] = struct.pack("<I", 2)  # the stream's first sector follows itself
    with pytest.raises(equations.EquationError):
        equations.formula(bytes(looped))
    rng = np.random.default_rng(2)
    for _ in range(300):  # nothing that is damaged stops the reader in another way
        damaged = bytearray(whole)
        for at in rng.integers(0, len(damaged), 3):
            damaged[at] = rng.integers(0, 256)
        try:
            equations.formula(bytes(damaged))
        except equations.EquationError:
            pass


def with_objects(path, *objects):
    body = "".join(f'<w:p>{T(f"{i + 1}. x is ____ ")}<w:r><w:object {V}><v:shape><v:imagedata r:id="r1"/></v:shape><o:OLEObject r:id="o{i}"/></w:object></w:r></w:p>' for i in range(len(objects)))
    write(path, body)
    rels = "".join(f'<Relationship Id="o{i}" Target="embeddings/o{i}.bin"/>' for i in range(len(objects)))
    with zipfile.ZipFile(path) as old:
        kept = {n: old.read(n) for n in old.namelist()}
    kept["word/_rels/document.xml.rels"] = f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="media/i.png"/>{rels}</Relationships>'.encode()
    kept["word/media/i.png"] = b"preview"
    with zipfile.ZipFile(path, "w") as new:
        for name, content in [*kept.items(), *[(f"word/embeddings/o{i}.bin", o) for i, o in enumerate(objects)]]:
            new.writestr(name, content)


def test_objects_in_a_run(spark, tmp_path):
    """An equation object is read; one that is damaged is asked about by its preview, and the accepted answer is its formula."""
    (tmp_path / "in").mkdir()
    with_objects(tmp_path / "in" / "期中数学.docx", compound(equation(HALF)), compound(equation(HALF))[:900])
    parts = docx.parse((tmp_path / "in" / "期中数学.docx").read_bytes())[1]
    assert [(p[1], p[5]) for p in parts[:4]] == [("paragraph", None), ("formula", r"\frac{a}{2}"), ("paragraph", None), ("unresolved", None)] and parts[3][6] is not None
    run = lambda **kinds: pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), C.validated({"providers": {"formula_ocr": {"primary": "fakes:formula_reader"}}}), **kinds)
    shown = lambda done: {r.question_number: (r.text_question, r.reason_code) for r in spark.read.parquet(f"{tmp_path}/out/workspace/{done.run_id}/outcomes").collect()}
    scale = spark.createDataFrame([("formula", "fake-1", "formula_ocr", [("0.5", "0.5"), ("0.99", "0.99")])], "provider string, model string, task string, knots array<struct<at: string, value: string>>")
    scale = scale.withColumn("knots", F.col("knots").cast("array<struct<at: decimal(9,6), value: decimal(9,6)>>"))
    got = shown(run(calibration=scale))
    assert got == {"1": (r"1. x is ____ $\frac{a}{2}$", "ANSWER_NOT_FOUND"), "2": (r"2. x is ____ $\frac{1}{2}$", "ANSWER_NOT_FOUND")}


def test_lines_without_loss(tmp_path):
    run = lambda inner, props="": f"<w:r>{props}{inner}</w:r>"
    high, low = '<w:rPr><w:vertAlign w:val="superscript"/></w:rPr>', '<w:rPr><w:vertAlign w:val="subscript"/></w:rPr>'
    odd = (
        T("x") + run("<w:t>2</w:t>", high) + run("<w:t>n</w:t>", high) + T("+a") + run("<w:t>1</w:t>", low) + T(" p") + run("<w:noBreakHyphen/>") + T("q ") + run('<w:sym w:font="Symbol" w:char="F0B4"/>') + run('<w:sym w:font="Arial" w:char="2264"/>')
        + run("<w:ruby><w:rubyPr/><w:rt><w:r><w:t>zi</w:t></w:r></w:rt><w:rubyBase><w:r><w:t>字</w:t></w:r></w:rubyBase></w:ruby>") + run('<w:footnoteReference w:id="3"/>')
    )
    write(tmp_path / "a.docx", f"<w:p>{odd}</w:p><w:tbl><w:tr><w:tc><w:p>{odd}</w:p></w:tc></w:tr></w:tbl><w:p>{run('<w:sym w:font=\"Wingdings\" w:char=\"F041\"/>')}{run('<w:pgNum/>')}</w:p>")
    with zipfile.ZipFile(tmp_path / "a.docx", "a") as z:
        z.writestr("word/footnotes.xml", f'<w:footnotes {W}><w:footnote w:id="3"><w:p>{run("<w:footnoteRef/>")}{T(" said below")}</w:p></w:footnote></w:footnotes>')
    status, parts, _ = docx.parse((tmp_path / "a.docx").read_bytes())
    text = "x$^{2n}$+a$_{1}$ p-q ×≤字（zi）[^f3]"
    assert status == "ok" and [(p[1], p[2]) for p in parts[:4]] == [("paragraph", text), ("textbox", "[^f3]: said below"), ("table", f"| {text} |\n|---|"), ("textbox", "[^f3]: said below")]
    assert [p[1] for p in parts[4:]].count("unresolved") == 2
    write(tmp_path / "b.docx", f"<w:p>{T('x')}{run('<w:endnoteReference w:id=\"9\"/>')}</w:p>")
    assert docx.parse((tmp_path / "b.docx").read_bytes())[0] == "relation_broken"


def png(image, filters=(0,)):
    image = np.asarray(image, np.uint8)
    height, width, samples = image.shape
    rows, before = [], np.zeros(width * samples, int)
    for i, row in enumerate(image.reshape(height, -1).astype(int)):
        kind, left, corner = filters[i % len(filters)], np.concatenate([np.zeros(samples, int), row[:-samples]]), np.concatenate([np.zeros(samples, int), before[:-samples]])
        far = np.stack([abs(before - corner), abs(left - corner), abs(left + before - 2 * corner)])
        guess = [0 * row, left, before, (left + before) // 2, np.choose(far.argmin(axis=0), [left, before, corner])][kind]
        rows.append(bytes([kind]) + ((row - guess) & 255).astype(np.uint8).tobytes())
        before = row
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return images._PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, {1: 0, 2: 4, 3: 2, 4: 6}[samples], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def drawn(kind, rng):
    page = np.full((rng.integers(120, 200), rng.integers(240, 320), 3), 255, np.uint8)
    h, w = page.shape[:2]
    if kind == "TABLE_IMAGE":
        page[:: h // rng.integers(4, 7)] = page[:, :: w // rng.integers(4, 7)] = 0
    elif kind == "TEXT_IMAGE":
        for y in range(6, h - 12, rng.integers(16, 20)):
            page[y : y + 9, 5 : w - 5][rng.random((9, w - 10)) < 0.5] = 0
    elif kind == "FORMULA_IMAGE":
        page = page[:60, :90]
        page[30, 20:70] = page[8:24, 30:60:4] = page[36:54, 30:60:4] = 0
    else:  # a figure in colours
        yy, xx = np.mgrid[:h, :w]
        page[(yy - h / 2) ** 2 + (xx - w / 2) ** 2 < (h / rng.uniform(2.5, 3.5)) ** 2] = (220, 30, 30)
    return page


def test_images(spark):
    rng = np.random.default_rng(3)
    for samples in (1, 2, 3, 4):
        page = rng.integers(0, 256, (9, 11, samples), np.uint8)
        if samples in (2, 4):
            page[:, :, -1] = 255
        want = np.repeat(page[:, :, :1], 3, axis=2) if samples < 3 else page[:, :, :3]
        assert all((images.pixels(png(page, f)) == want).all() for f in ((0,), (1, 2), (3, 4), (4,)))
    kinds = ("TABLE_IMAGE", "TEXT_IMAGE", "FORMULA_IMAGE", "CHART")
    make = lambda n: [(f"{k}{i}", png(drawn(k, rng)), k) for k in kinds for i in range(n)]
    schema = "asset_id string, content binary, image_class string"
    models = images.fit(spark.createDataFrame(make(6) + [("x", b"no image", "TEXT_IMAGE"), ("y", None, "TEXT_IMAGE")], schema))
    odd = [("jpeg", b"\xff\xd8\xff", None), ("null", None, None), ("cut", png(drawn("CHART", rng))[:60], None), ("blank", png(np.full((50, 50, 3), 255)), None), ("noise", png(rng.integers(0, 256, (90, 20, 3))), None)]
    shown = spark.createDataFrame(make(5) + odd, schema).withColumnRenamed("image_class", "want")
    got = [(r.want, r.image_class) for r in images.classified(shown, models).collect()]
    assert all(b in (a, "UNKNOWN") for a, b in got if a) and sum(a == b for a, b in got if a) >= 18 and all(b == "UNKNOWN" for a, b in got if not a)
    plain = {(r.want, r.image_class) for r in images.classified(shown).collect() if r.want in ("TABLE_IMAGE", "TEXT_IMAGE", "CHART")}
    assert plain == {("TABLE_IMAGE", "TABLE_IMAGE"), ("TEXT_IMAGE", "TEXT_IMAGE"), ("CHART", "UNKNOWN")}


def test_boundaries(spark):
    texts = ["head", "Which? first", "more", "Who? second", "A. x B. y", "What? third"]
    df = blocks(spark, texts).withColumn("is_critical", F.col("ord") > 0)
    rules = splitting.split_questions(df)
    assert rules.count() == 0
    told = lambda *pairs: spark.createDataFrame([("d", f"p{i}", f"b{a:03}", f"b{b:03}") for i, (a, b) in enumerate(pairs)], "document_id string, proposal_id string, first string, last string")
    faults = lambda *pairs: {(r.proposal_id, r.block_id, r.problem) for r in splitting.interval_faults(told(*pairs), df).collect()}
    assert faults((1, 2), (3, 4), (5, 5)) == set()
    assert faults((1, 2), (2, 4), (5, 5)) == {("p1", None, "overlap")} and faults((1, 2), (3, 4)) == {(None, "b005", "not covered")}
    assert faults((1, 2), (4, 3), (5, 9)) == {("p1", None, "reversed"), ("p2", None, "unknown block"), (None, "b003", "not covered"), (None, "b004", "not covered"), (None, "b005", "not covered")}
    taken = splitting.chosen_boundaries(rules, told((1, 2), (3, 4), (5, 5)), df)
    assert [(r.content_blocks, r.question_type_candidate, str(r.split_score)) for r in taken.orderBy("question_candidate_id").collect()] == [(["b001", "b002"], "未知", "0.985000"), (["b003", "b004"], "选择题", "0.985000"), (["b005"], "未知", "0.985000")]
    assert splitting.chosen_boundaries(rules, told((1, 2), (3, 4)), df).count() == 0
    asked = df.groupBy("document_id").agg(F.collect_list(F.struct("block_id", "raw_text")).alias("blocks"))
    answer = lambda content: providers.boundaries(asked, Fake("m", lambda p: content), None, "split", "v1", 2)[0].collect()
    assert [(r.first, r.last) for r in answer({"questions": [{"first": "b001", "last": "b002"}]})] == [("b001", "b002")]
    assert answer({"questions": [{"first": "b001", "last": "b002", "text": "better"}]}) == [] == answer({"questions": [], "text": "x"}) == answer("no JSON")


def test_boundaries_in_a_run(spark, tmp_path):
    """Numbers that jump make the rules unsure; a model's boundaries settle the document, from the source's own blocks."""
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "月考语文.docx", "".join(f"<w:p>{T(t)}</w:p>" for t in ("3. Which one? ____", "7. Who then? ____", "and why")))
    told = lambda providers_: pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), C.validated({"providers": providers_}))
    rows = lambda done: sorted((r.text_question, r.reason_code) for r in spark.read.parquet(f"{tmp_path}/out/workspace/{done.run_id}/outcomes").collect())
    assert {r for _, r in rows(told({}))} == {"QUESTION_SPLIT_LOW_CONFIDENCE"}
    assert rows(told({"llm": {"primary": "fakes:splitter"}})) == [("3. Which one? ____", "ANSWER_NOT_FOUND"), ("7. Who then? ____\nand why", "ANSWER_NOT_FOUND")]


def test_parts(spark):
    df = blocks(spark, ["一、选择题（每题3分）", "1. stem", "2. other", "二、解答题", "1. prove", "3. jump"])
    got = splitting.split_questions(df).orderBy("question_candidate_id").collect()
    assert [(r.question_number, r.content_blocks, r.question_type_candidate, str(r.split_score)) for r in got] == [("1", ["b001"], "选择题", "0.990000"), ("2", ["b002"], "选择题", "0.990000"), ("1", ["b004"], "问答题", "0.990000"), ("3", ["b005"], "问答题", "0.950000")]


def test_answers_by_place(spark):
    """Decimals, dates and steps begin no answer; twelve answers of one block keep their order."""
    df = blocks(spark, ["参考答案", " ".join(f"{i}. {'ABCD'[i % 4]}" for i in range(1, 13)), "13. the height is\n2.5 m", "14. 7", "15. on 3. 5 it is\n1. first step\n2. second step", "16. x"])
    got = splitting.extract_answers(df).orderBy("place").collect()
    assert [(r.question_number, r.answer) for r in got] == [(str(i), "ABCD"[i % 4]) for i in range(1, 13)] + [("13", "the height is\n2.5 m"), ("14", "7"), ("15", "on 3. 5 it is\n1. first step\n2. second step"), ("16", "x")]
    assert splitting.extract_answers(blocks(spark, ["1. A", "900. far", "2. B"])).count() == 2


def test_twelve_answers_in_a_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paragraphs = lambda *texts: "".join(f"<w:p>{T(t)}</w:p>" for t in texts)
    write(tmp_path / "in" / "期中数学.docx", paragraphs("2024年北京市初一数学期中", *[f"{i}. {i}+1= A. 1 B. 2 C. 3 D. 4" for i in range(1, 13)]))
    write(tmp_path / "in" / "期中数学答案.docx", paragraphs("参考答案", " ".join(f"{i}. {'ABCD'[i % 4]}" for i in range(1, 13))))
    done = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), C.validated({"providers": {"llm": {"verifier": "fakes:verifier"}}}))
    lines = [json.loads(line) for f in (tmp_path / "out" / done.run_id / "questions.jsonl").glob("*.json") for line in f.read_text(encoding="utf-8").splitlines()]
    assert {r["text_question"].split(".")[0]: r["text_answer"] for r in lines} == {str(i): "ABCD"[i % 4] for i in range(1, 13)}


def test_constraints(spark):
    """What cannot be one exam parts, and the rest stays together."""
    row = lambda d, f, k, q=(), a=(), year=None, title=None, course=None: (d, f, title, k, list(q), list(a), course, None, year, None, None)
    df = documents(spark, [
        row("a1", "期中数学.docx", "QUESTION", "123", year="2023"), row("a2", "期中数学答案.docx", "ANSWER", a="123", year="2023"), row("a3", "期中数学试卷.docx", "QUESTION", "12", year="2024"), row("a4", "期中数学解析.docx", "ANSWER", a="12", year="2024"), row("a5", "期中数学word版.docx", "ANSWER", a="1"),
        row("b1", "月考语文.docx", "QUESTION", "12"), row("b2", "月考语文试卷.docx", "QUESTION", "1234"), row("b3", "月考语文答案.docx", "ANSWER", a="1234"),
        row("c1", "x.docx", "QUESTION", "123", year="2024", title="红星中学高二期末联合考试试卷", course="物理"), row("c2", "y.docx", "ANSWER", a="123", year="2024", title="红星中学高二期末联合考试答案", course="物理"), row("c3", "z.docx", "ANSWER", a="123", year="2024", title="蓝天实验学校初一入学摸底测试", course="物理"),
        row("d1", "单元测试.docx", "QUESTION", "1"), row("d2", "单元测试答案.docx", "ANSWER", a="789"),
    ])
    got = {r.document_id: r.cluster_id for r in U.clusters(df).collect()}
    together = {"a2": "a1", "a4": "a3", "b3": "b2", "c2": "c1"}
    assert got == {d: f"exam_{together.get(d, d)}" for d in got} and len(got) == 13
    meant = df.where("document_id IN ('c1', 'c3')").withColumn("meaning", F.lit("near"))
    assert len({r.cluster_id for r in U.clusters(meant).collect()}) == 1
