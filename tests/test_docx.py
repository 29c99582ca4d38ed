import random
import zipfile
from itertools import combinations, pairwise

from pyspark.sql import functions as F

from quillmill.operators import gates, matching, recognition
from quillmill.sources import docx

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
T = lambda t: f"<w:r><w:t>{t}</w:t></w:r>"
NUM = '<w:pPr><w:numPr><w:ilvl w:val="0"/><w:numId w:val="1"/></w:numPr></w:pPr>'
BODY = (
    f"<w:p>{NUM}{T('one')}<m:oMath><m:f><m:num><m:r><m:t>1</m:t></m:r></m:num><m:den><m:r><m:t>x</m:t></m:r></m:den></m:f></m:oMath>{T('after')}</w:p>"
    f'<w:p>{NUM}<w:r><w:drawing><a:blip r:embed="r1"/></w:drawing></w:r>{T("two")}</w:p>'
    f"<w:tbl><w:tr><w:tc><w:p>{T('a')}</w:p></w:tc><w:tc><w:p>{T('b')}</w:p></w:tc></w:tr><w:tr><w:tc><w:p>{T('c')}</w:p></w:tc><w:tc><w:p>{T('d')}</w:p></w:tc></w:tr></w:tbl>"
    f'<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr><w:p>{T("wide")}</w:p></w:tc></w:tr></w:tbl>'
    "<w:p><m:oMath><m:nary/></m:oMath></w:p>"
)


def write(path, body=BODY, media=True):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="media/i.png"/></Relationships>')
        z.writestr("word/numbering.xml", f'<w:numbering {W}><w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/><w:lvlText w:val="（%1）"/></w:lvl></w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num></w:numbering>')
        z.writestr("word/header1.xml", f"<w:hdr {W}><w:p>{T('head')}</w:p></w:hdr>")
        if media:
            z.writestr("word/media/i.png", b"png")


def test_docx(spark, tmp_path):
    write(tmp_path / "a.docx")
    write(tmp_path / "b.docx", media=False)
    (tmp_path / "c.docx").write_bytes(b"no package")
    (tmp_path / "d.txt").write_text("no")
    parsed = docx.read_docx(spark, str(tmp_path)).cache()
    status = {r.source_file: (r.status, r.document_id) for r in parsed.collect()}
    assert {k: v[0] for k, v in status.items()} == {"a.docx": "ok", "b.docx": "relation_broken", "c.docx": "parse_failed"}
    rows = sorted((r for r in docx.blocks(parsed).collect() if r.document_id == status["a.docx"][1]), key=lambda r: r.ord)
    assert [(r.type, r.resolved_label) for r in rows] == [("paragraph", "（1）"), ("formula", None), ("paragraph", None), ("paragraph", "（2）"), ("image", None), ("paragraph", None), ("table", None), ("table", None), ("unresolved", None), ("header", None)]
    assert rows[1].latex == r"\frac{1}{x}" and rows[6].raw_text == "| a | b |\n|---|---|\n| c | d |" and 'colspan="2"' in rows[7].raw_text
    assert [r.asset_id for r in docx.assets(parsed).collect()] == [rows[4].asset_id]
    good = gates.block_gate(docx.blocks(parsed), docx.assets(parsed)).collect()
    assert all(r.stable and r.images_there for r in good)


def m(tag, *kids, **props):
    inner = "".join(f'<m:{k} m:val="{v}"/>' for k, v in props.items())
    return f"<m:{tag}>" + (f"<m:{tag}Pr>{inner}</m:{tag}Pr>" if props else "") + "".join(kids) + f"</m:{tag}>"


def test_no_silent_loss(tmp_path):
    """What stands in a document is read in its place or named unresolved; nothing stops the reader."""
    x, y = m("r", "<m:t>x</m:t>"), m("r", "<m:t>y</m:t>")
    formula = lambda *k: f"<m:oMath>{''.join(k)}</m:oMath>"
    picture = '<w:r><w:drawing><a:blip r:embed="r1"/></w:drawing></w:r>'
    inner = f"<w:tbl><w:tr><w:tc><w:p>{T('deep')}</w:p></w:tc></w:tr></w:tbl>"
    body = (
        f"<w:sdt><w:sdtPr/><w:sdtContent><w:p>{T('controlled')}</w:p></w:sdtContent></w:sdt>"
        f"<w:p>{formula(m('d', m('e', x), begChr='|', endChr='|'))}{formula(m('d', m('e', x), m('e', y), begChr='[', endChr=''))}{formula(m('nary', m('sub', x), m('sup', y), m('e', x), chr='∑'))}</w:p>"
        f"<w:tbl><w:tr><w:tc><w:p>{T('a ')}{formula(m('f', m('num', x), m('den', y)))}{picture}</w:p></w:tc><w:tc>{inner}<w:p>{formula('<m:box/>')}</w:p></w:tc></w:tr></w:tbl>"
        f'<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr><w:p>{T("w")}</w:p></w:tc><w:tc><w:tcPr><w:vMerge w:val="restart"/></w:tcPr><w:p>{T("t")}</w:p></w:tc></w:tr><w:tr><w:tc><w:p>{T("1")}</w:p></w:tc><w:tc><w:p>{T("2")}</w:p></w:tc><w:tc><w:tcPr><w:vMerge/></w:tcPr><w:p/></w:tc></w:tr></w:tbl>'
        f'<w:p><w:r><w:object><v:shape xmlns:v="urn:schemas-microsoft-com:vml"><v:imagedata r:id="r1"/></v:shape></w:object></w:r></w:p>'
        f"<w:p><w:r><w:drawing><w:txbxContent><w:p>{T('boxed')}</w:p></w:txbxContent></w:drawing></w:r></w:p>"
        f"<w:strange>{T('kept')}</w:strange>"
    )
    write(tmp_path / "a.docx", body)
    status, parts, media = docx.parse((tmp_path / "a.docx").read_bytes())
    assert status == "ok" and [p[0] for p in parts] == list(range(len(parts)))
    shown = [(p[1], p[5] or p[2]) for p in parts]
    assert shown[:4] == [("paragraph", "controlled"), ("formula", r"\left|x\right|"), ("formula", r"\left[x,y\right."), ("formula", r"\sum_{x}^{y}{x}")]
    assert shown[4][0] == "table" and r"$\frac{x}{y}$" in shown[4][1] and '<img src="image/img_' in shown[4][1] and "deep" in shown[4][1] and shown[5][0] == "unresolved"
    assert shown[6] == ("table", '<table><tr><td colspan="2">w</td><td rowspan="2">t</td></tr><tr><td>1</td><td>2</td></tr></table>')
    assert parts[7][1] == "unresolved" and parts[7][6] is not None and media[parts[7][6]][1] == b"png" and shown[8] == ("textbox", "boxed")
    assert shown[9][0] == "unresolved" and "kept" in shown[9][1]
    with zipfile.ZipFile(tmp_path / "a.docx") as z:
        entry = next(i for i in z.infolist() if i.filename == "word/media/i.png")
    raw = bytearray((tmp_path / "a.docx").read_bytes())
    raw[raw.index(b"png", entry.header_offset + 40 + len("word/media/i.png") - 10)] ^= 255  # the picture's checksum no longer holds
    damaged = docx.parse(bytes(raw))
    assert damaged[0] == "relation_broken" and any(p[1] == "unresolved" for p in damaged[1])
    for broken in (b"", raw[:200], b"PK" + bytes(100)):
        assert docx.parse(bytes(broken))[0] == "parse_failed"


def test_labels():
    want = {"chineseCounting": {1: "一", 10: "十", 11: "十一", 20: "二十", 100: "一百", 105: "一百零五", 110: "一百一十", 1010: "一千零一十"}, "upperRoman": {4: "IV", 1999: "MCMXCIX"}, "lowerLetter": {1: "a", 26: "z", 27: "aa"}, "decimalEnclosedCircle": {1: "①", 21: "21"}}
    assert {f: {n: docx._spelled(n, f) for n in v} for f, v in want.items()} == want
    level = '<w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/><w:lvlText w:val="%1."/></w:lvl>'
    xml = f'<w:numbering {W}><w:abstractNum w:abstractNumId="0">{level}</w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num><w:num w:numId="2"><w:abstractNumId w:val="0"/><w:lvlOverride w:ilvl="0"><w:startOverride w:val="5"/></w:lvlOverride></w:num></w:numbering>'
    styles = f'<w:styles {W}><w:style w:styleId="Q"><w:pPr><w:numPr><w:numId w:val="2"/></w:numPr></w:pPr></w:style></w:styles>'
    numbering = docx.Numbering(xml.encode(), styles.encode())
    assert [numbering.label("1", "0"), numbering.label(*numbering.styled["Q"]), numbering.label("2", "0"), numbering.label("1", "0"), numbering.label("9", "0")] == ["1.", "5.", "6.", "2.", None]
    assert docx.valid_formula(r"\frac{1}{x}") and not any(map(docx.valid_formula, ("", "{}", "{x", r"\left(x")))


def test_alignment(spark):
    q = spark.createDataFrame([("c", i, str(i), f"q{i}") for i in range(1, 6)], "cluster_id string, ord int, number string, id string")
    a = spark.createDataFrame([("c", i, str(i), f"a{i}") for i in (1, 2, 4, 5)], q.schema)
    got = {r.question_id: (r.op, r.answer_id) for r in matching.align(q, a).collect()}
    assert got == {"q1": ("match", "a1"), "q2": ("match", "a2"), "q3": ("skip-question", None), "q4": ("match", "a4"), "q5": ("match", "a5")}
    twice = matching.align(q.unionByName(spark.createDataFrame([("c", 9, "5", "q9")], q.schema)), a).collect()
    assert not [r for r in twice if r.op == "match" and r.answer_id == "a5"]
    rnd = random.Random(2)
    rows = {"q": [], "a": []}
    for c in range(16):
        for side in "qa":
            numbers = sorted(rnd.sample(range(10), 8) + rnd.choices(range(10), k=c % 3))
            for _ in range(c % 4):  # some numbers out of order, some twice
                i, j = rnd.randrange(len(numbers)), rnd.randrange(len(numbers))
                numbers[i], numbers[j] = numbers[j], numbers[i]
            rows[side] += [(c, i, str(n), f"{side}{c}.{i}") for i, n in enumerate(numbers)]
    got = {(r.question_id, r.answer_id) for r in matching.align(*[spark.createDataFrame(rows[s], "cluster_id int, ord int, number string, id string") for s in "qa"]).collect() if r.op == "match"}
    want = set()
    for c in range(16):
        once = {s: {n: i for k, i, n, _ in rows[s] if k == c and [x[2] for x in rows[s] if x[0] == c].count(n) == 1} for s in "qa"}
        pairs = sorted((once["q"][n], once["a"][n]) for n in once["q"].keys() & once["a"].keys())
        chains = [x for k in range(len(pairs), -1, -1) for x in combinations(pairs, k) if all(a[1] < b[1] for a, b in pairwise(x))]
        longest = [set(x) for x in chains if len(x) == len(chains[0])]
        want |= {(f"q{c}.{i}", f"a{c}.{j}") for i, j in set.intersection(*longest)}
    assert got == want and 20 < len(want) < 90


def test_signals(spark):
    """Equal numbers do not make a match: contrary evidence, or none, keeps a pair below the line."""
    schema = "cluster_id string, ord int, number int, id string, document string, file string, fields array<string>"
    question = [("c", i, i, f"q{i}", "Q", "exam", ["数学", None], "填空题", f"{i}+{i}= ____") for i in range(1, 5)]
    answer = [("c", i, i, f"a{i}", "A", "exam", ["数学", "2024"], str(2 * i)) for i in (1, 2, 4)]
    cases = {"all agree": ({}, {}), "another exam's file": ({"file": "other exam"}, {}), "another subject": ({"fields": ["物理", None]}, {}), "no title": ({"fields": [None, None]}, {}), "letters for a blank": ({}, {"a2": "B"}), "two parts for one blank": ({}, {"a4": "1;2"}), "open bracket": ({}, {"a1": "(2"})}
    for name, (change, answers) in cases.items():
        q = spark.createDataFrame([tuple({**dict(zip(["cluster_id", "ord", "number", "id", "document", "file", "fields", "kind", "stem"], r, strict=True)), **change}.values()) for r in question], schema + ", kind string, stem string")
        a = spark.createDataFrame([(*r[:-1], answers.get(r[3], r[-1])) for r in answer], schema + ", answer string")
        found = matching.signals(q, a)
        top = {r.q: (r.a, float(r.top1), float(r.top2)) for r in matching.top_two(found.withColumn("score", matching.evidence_score({k: F.col(k) for k in matching.WEIGHTS}, F.col("conflict"))), "q", "a", "score").collect()}
        passed = {k for k, (_, one, two) in top.items() if one >= 0.995 and one - two >= 0.1}
        assert passed == {"all agree": {"q1", "q2", "q4"}, "letters for a blank": {"q1", "q4"}, "two parts for one blank": {"q1", "q2"}, "open bracket": {"q2", "q4"}}.get(name, set()), name
        assert name != "all agree" or all(top[k][0] == "a" + k[1:] for k in passed)
    shifted = spark.createDataFrame([("c", i, i + 1, f"a{i}", "A", "exam", ["数学", None], str(2 * i)) for i in (1, 2, 3)], schema + ", answer string")
    assert {(r.q, r.a) for r in matching.signals(spark.createDataFrame(question, schema + ", kind string, stem string"), shifted).where("number = 0").collect()} >= {("q1", "a1"), ("q2", "a2")}


def test_ladder(spark):
    rows = [("0.98", True, "accept"), ("0.97", True, "fallback"), ("0.89", True, "reject"), ("0.95", False, "accept"), (None, False, "reject")]
    df = spark.createDataFrame(rows, "s string, critical boolean, want string")
    assert all(r.got == r.want for r in df.select("want", recognition.ladder(df.s, df.critical).alias("got")).collect())
