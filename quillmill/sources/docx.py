"""The .docx source: files to documents, blocks in source order, and assets.

Spark lists and reads the files; a small helper takes one package apart. A file that cannot be read gives a row with
its status instead of an error.
"""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.sources import equations

# The namespaces of the format.
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_V = "{urn:schemas-microsoft-com:vml}"
_O = "{urn:schemas-microsoft-com:office:office}"
#: Parts of a paragraph or body that show nothing of their own.
_SILENT = {_W + x for x in ("pPr", "rPr", "sectPr", "bookmarkStart", "bookmarkEnd", "proofErr", "lastRenderedPageBreak", "commentRangeStart", "commentRangeEnd", "permStart", "permEnd", "del", "delText", "instrText", "fldChar", "sdtPr", "sdtEndPr", "commentReference", "annotationRef", "footnoteRef", "endnoteRef", "separator", "continuationSeparator", "rubyPr", "moveFrom", "tblPr", "tblGrid", "trPr", "tcPr")}
#: Signs of the symbol font that papers use, by their codes: fixed values of that font.
_SYMBOLS = {0xB4: "×", 0xB8: "÷", 0xB1: "±", 0xA3: "≤", 0xB3: "≥", 0xB9: "≠", 0xBB: "≈", 0xA5: "∞", 0xD0: "∠", 0x5E: "⊥", 0xB0: "°", 0x70: "π", 0x61: "α", 0x62: "β", 0x67: "γ", 0x71: "θ", 0x6C: "λ", 0x6D: "μ", 0x77: "ω", 0x44: "Δ", 0xD7: "·", 0xAE: "→", 0xCE: "∈", 0xC8: "∪", 0xC7: "∩"}
#: Containers in a line whose own tags show nothing.
_HOLDERS = {_W + x for x in ("r", "hyperlink", "smartTag", "ins", "moveTo", "fldSimple", "sdt", "sdtContent", "customXml", "p", "drawing", "pict", "rubyBase", "rt", "dir", "bdo")}
#: Errors that a damaged package may raise on reading.
_DAMAGE = (zipfile.BadZipFile, zlib.error, KeyError, ValueError, ET.ParseError, RuntimeError, NotImplementedError, OSError, EOFError)
PARTS = "array<struct<ord: int, type: string, raw_text: string, style_id: string, resolved_label: string, latex: string, asset: int, is_critical: boolean, para: int>>"
PARSED = f"document_id string, source_file string, source_sha256 string, status string, parts {PARTS}, media array<struct<ext: string, content: binary>>"


class FormulaError(ValueError):
    """A formula outside the supported kinds."""


def latex_of(node: ET.Element) -> str:
    """Fractions, super- and subscripts, roots, groups, big operators and functions; anything else stops the conversion."""
    tag, kids = node.tag, {c.tag: c for c in node}
    part = lambda name: latex_of(kids[_M + name]) if _M + name in kids else ""
    if tag == _M + "r":
        return "".join(t.text or "" for t in node.iter(_M + "t"))
    if tag == _M + "f":
        return rf"\frac{{{part('num')}}}{{{part('den')}}}"
    if tag in (_M + "sSup", _M + "sSub", _M + "sSubSup"):
        low, high = part("sub"), part("sup")
        return f"{{{part('e')}}}" + (f"_{{{low}}}" if _M + "sub" in kids else "") + (f"^{{{high}}}" if _M + "sup" in kids else "")
    if tag == _M + "rad":
        degree = part("deg")
        return rf"\sqrt[{degree}]{{{part('e')}}}" if degree else rf"\sqrt{{{part('e')}}}"
    if tag == _M + "d":
        about = {c.tag: c.get(_M + "val", "") for c in kids.get(_M + "dPr", ())}
        begin, end, between = (about.get(_M + name, default) for name, default in (("begChr", "("), ("endChr", ")"), ("sepChr", ",")))
        shown = lambda c: rf"\{c}" if c in ("{", "}") else c or "."
        return rf"\left{shown(begin)}{between.join(latex_of(e) for e in node.findall(_M + 'e'))}\right{shown(end)}"
    if tag == _M + "nary":
        sign = next((c.get(_M + "val", "∫") for c in kids.get(_M + "naryPr", ()) if c.tag == _M + "chr"), "∫")
        if sign not in _BIG or not part("e"):
            raise FormulaError(sign)
        low, high = part("sub"), part("sup")
        return _BIG[sign] + (f"_{{{low}}}" if low else "") + (f"^{{{high}}}" if high else "") + f"{{{part('e')}}}"
    if tag == _M + "func":
        name = part("fName")
        return (f"\\{name}" if name in _FUNCTIONS else name) + f"{{{part('e')}}}"
    if tag in (_M + x for x in ("oMath", "oMathPara", "e", "num", "den", "sub", "sup", "deg", "fName")):
        return "".join(latex_of(c) for c in node if not c.tag.endswith("Pr"))
    raise FormulaError(tag.rpartition("}")[2])


#: The commands of big operators and the functions that have one.
_BIG = {"∫": r"\int", "∑": r"\sum", "∏": r"\prod"}
_FUNCTIONS = ("sin", "cos", "tan", "cot", "log", "ln", "lg", "lim", "max", "min", "exp")


def valid_formula(latex: str) -> bool:
    """Whether a converted formula is whole: some content, braces and delimiters in pairs, no control characters."""
    depth = 0
    for sign in re.sub(r"\\[{}]", "", latex):
        depth += (sign == "{") - (sign == "}")
        if depth < 0 or ord(sign) < 32:
            return False
    return depth == 0 and latex.count(r"\left") == latex.count(r"\right") and bool(re.sub(r"\\left|\\right|[{}\s.]", "", latex))


_CHINESE = "零一二三四五六七八九"
_ROMAN = ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I"))


def _counted(n: int) -> str:
    """Chinese counting below ten thousand."""
    out, gap = "", False
    for size, name in ((1000, "千"), (100, "百"), (10, "十"), (1, "")):
        digit, n = divmod(n, size)
        if digit:
            out += ("零" if gap and out else "") + ("" if digit == 1 and name == "十" and not out else _CHINESE[digit]) + name
        gap = not digit
    return out or _CHINESE[0]


def _spelled(n: int, form: str) -> str:
    """A number as a numbering form writes it; in digits where the form has no sign for it."""
    if form in ("chineseCounting", "chineseCountingThousand") and 0 <= n < 10_000:
        return _counted(n)
    if form in ("decimalEnclosedCircle", "decimalEnclosedCircleChinese") and 0 < n <= 20:
        return chr(0x2460 + n - 1)
    if form in ("upperLetter", "lowerLetter") and n > 0:  # after Z come AA, BB, ...
        return chr((65 if form == "upperLetter" else 97) + (n - 1) % 26) * ((n - 1) // 26 + 1)
    if form in ("upperRoman", "lowerRoman") and 0 < n < 4000:
        out = ""
        for size, sign in _ROMAN:
            out += sign * (n // size)
            n %= size
        return out if form == "upperRoman" else out.lower()
    return str(n)


class Numbering:
    """Labels of numbered paragraphs, in order of the document."""

    def __init__(self, xml: bytes | None, styles: bytes | None = None):
        root = ET.fromstring(xml) if xml else ET.Element("none")
        value = lambda e, name, default: next((x.get(_W + "val") for x in e.findall(_W + name)), default)
        levels = {a.get(_W + "abstractNumId"): {v.get(_W + "ilvl"): (value(v, "numFmt", "decimal"), value(v, "lvlText", "%1."), int(value(v, "start", "1"))) for v in a.findall(_W + "lvl")} for a in root.findall(_W + "abstractNum")}
        self.levels = {n.get(_W + "numId"): levels.get(value(n, "abstractNumId", ""), {}) for n in root.findall(_W + "num")}
        for n in root.findall(_W + "num"):  # a list that begins at another number than its form says
            for over in n.findall(_W + "lvlOverride"):
                level, start = over.get(_W + "ilvl"), value(over, "startOverride", None)
                own = self.levels[n.get(_W + "numId")] = dict(self.levels[n.get(_W + "numId")])
                if start is not None and level in own:
                    own[level] = (*own[level][:2], int(start))
        self.counts: dict[str, dict[int, int]] = {}
        #: The numbering that a style gives its paragraphs.
        self.styled = {}
        for style in ET.fromstring(styles).findall(_W + "style") if styles else ():
            number = style.find(f"{_W}pPr/{_W}numPr")
            if number is not None:
                self.styled[style.get(_W + "styleId")] = (value(number, "numId", "0"), value(number, "ilvl", "0"))

    def label(self, num: str, level: str) -> str | None:
        forms = self.levels.get(num, {})
        if level not in forms:
            return None
        counts, at = self.counts.setdefault(num, {}), int(level)
        counts[at] = counts.get(at, forms[level][2] - 1) + 1
        for deeper in [k for k in counts if k > at]:  # a deeper level starts anew
            del counts[deeper]
        text = forms[level][1]
        for k in range(at + 1):
            form, _, start = forms.get(str(k), ("decimal", "", 1))
            text = text.replace(f"%{k + 1}", _spelled(counts.get(k, start), form))
        return text


def _table(node: ET.Element, cell_text) -> str:
    """Markdown where all cells are plain, HTML where some are merged or hold tables; cell_text gives a cell's content in order."""
    rows: list[list[tuple[str, int, str | None, int]]] = []  # content, columns, merge down, column
    rich = False
    for r in node.findall(_W + "tr"):
        at, row = 0, []
        for c in r.findall(_W + "tc"):
            span, merge = c.find(f"{_W}tcPr/{_W}gridSpan"), c.find(f"{_W}tcPr/{_W}vMerge")
            wide = 1 if span is None else max(1, int(span.get(_W + "val", "1")))
            text = cell_text(c)
            rich = rich or wide > 1 or merge is not None or c.find(f".//{_W}tbl") is not None
            row.append((text, wide, None if merge is None else merge.get(_W + "val", "continue"), at))
            at += wide
        rows.append(row)
    if not rich:
        lines = ["| " + " | ".join(t.replace("|", r"\|").replace("\n", " ") for t, *_ in r) + " |" for r in rows]
        return "\n".join([*lines[:1], "|" + "---|" * max(1, len(rows[0]) if rows else 1), *lines[1:]])
    out = []
    for i, r in enumerate(rows):
        cells = []
        for text, wide, merge, column in r:
            if merge is not None and merge != "restart":
                continue
            down = 1
            while merge is not None and i + down < len(rows) and any(x[3] == column and x[2] not in (None, "restart") for x in rows[i + down]):
                down += 1
            cells.append("<td" + (f' colspan="{wide}"' if wide > 1 else "") + (f' rowspan="{down}"' if down > 1 else "") + f">{text}</td>")
        out.append(f"<tr>{''.join(cells)}</tr>")
    return f"<table>{''.join(out)}</table>"


def _script(run: ET.Element) -> str:
    """^ or _ for a run that is set above or below the line."""
    set_ = run.find(f"{_W}rPr/{_W}vertAlign") if run.tag == _W + "r" else None
    return {"superscript": "^", "subscript": "_"}.get("" if set_ is None else set_.get(_W + "val", ""), "")


def _scripted(text: str, script: str) -> str:
    return f"${script}{{{text}}}$" if script and text.strip() and not text.startswith("[^") else text


def _joined(texts: list[str]) -> str:
    """Texts of runs; a script that goes on over several runs is one."""
    out = "".join(texts)
    while (one := re.sub(r"(\$([\^_])\{[^{}$]*)\}\$\$\2\{", r"\1", out)) != out:
        out = one
    return out


class _Package:
    """One package taken apart: parts in order of the source, media, and whether something of it is missing."""

    def __init__(self, content: bytes):
        self.package = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.package.namelist())
        read = lambda name: self.package.read(name) if name in self.names else None
        self.body = ET.fromstring(self.package.read("word/document.xml")).find(_W + "body")
        rels = read("word/_rels/document.xml.rels")
        self.numbering = Numbering(read("word/numbering.xml"), read("word/styles.xml"))
        self.targets = {r.get("Id"): r.get("Target", "") for r in (ET.fromstring(rels) if rels else ()) if r.get("TargetMode") != "External"}
        #: Foot- and endnotes by kind and id.
        self.notes = {(kind, n.get(_W + "id")): n for kind in ("footnote", "endnote") if (xml := read(f"word/{kind}s.xml")) for n in ET.fromstring(xml).findall(_W + kind)}
        self.parts: list[tuple] = []
        self.media: list[tuple[str, bytes]] = []
        self.broken = self.body is None
        #: Notes that were referred to and are not laid out yet.
        self.waiting: list[tuple] = []
        #: The number of the paragraph or table that is being read.
        self.para = 0

    def add(self, kind, text=None, style=None, label=None, latex=None, asset=None, critical=False) -> None:
        self.parts.append((len(self.parts), kind, text, style, label, latex, asset, critical, self.para))

    def medium(self, rel: str | None) -> int | None:
        """The place among the media of what a relation names; None if it is not there or damaged."""
        path = "word/" + self.targets.get(rel, "?").removeprefix("/word/")
        try:
            self.media.append((path.rpartition(".")[2].lower(), self.package.read(path)))
        except _DAMAGE:
            self.broken = True
            return None
        return len(self.media) - 1

    def picture(self, node: ET.Element) -> None:
        shown = [b.get(_R + "embed") for b in node.iter(_A + "blip")] + [b.get(_R + "id") for b in node.iter(_V + "imagedata")]
        for rel in shown:
            at = self.medium(rel)
            if at is None:
                self.add("unresolved", self.targets.get(rel, rel), critical=True)
            else:
                self.add("image", asset=at)
        if not shown:
            self.add("unresolved", ET.tostring(node, encoding="unicode"), critical=True)

    def formula(self, node: ET.Element) -> str | None:
        """The LaTeX of a formula; None, with an unresolved part, where it is not understood."""
        try:
            latex = latex_of(node)
        except FormulaError:
            latex = ""
        if valid_formula(latex):
            return latex
        self.add("unresolved", ET.tostring(node, encoding="unicode"), critical=True)
        return None

    def embedded(self, node: ET.Element) -> str | None:
        """The LaTeX of an embedded equation; of any other object None, with an unresolved part that has its preview image, if there is one."""
        for rel in [x.get(_R + "id") for x in node.iter(_O + "OLEObject")]:
            path = "word/" + self.targets.get(rel, "?").removeprefix("/word/")
            try:
                latex = equations.formula(self.package.read(path))
            except (equations.EquationError, *_DAMAGE):
                continue
            if valid_formula(latex):
                return latex
        previews = [at for b in node.iter(_V + "imagedata") if (at := self.medium(b.get(_R + "id"))) is not None]
        self.add("unresolved", ET.tostring(node, encoding="unicode"), asset=previews[0] if previews else None, critical=True)
        return None

    def sign(self, x: ET.Element) -> str | None:
        """What an element of a line shows as text; None if it is no text."""
        tag = x.tag.removeprefix(_W)
        if tag == "t":
            return x.text or ""
        if tag in ("br", "cr", "tab", "ptab"):
            return "\t" if tag.endswith("tab") else "\n"
        if tag in ("noBreakHyphen", "softHyphen"):
            return "-" if tag == "noBreakHyphen" else "\u00ad"
        if tag == "sym":
            code = int(x.get(_W + "char", "FFFD"), 16)
            if 0xF000 <= code <= 0xF0FF:  # a place in a font and not a sign
                if x.get(_W + "font", "").lower() != "symbol" or code - 0xF000 not in _SYMBOLS:
                    self.add("unresolved", ET.tostring(x, encoding="unicode"), critical=True)
                    return "\ufffd"
                return _SYMBOLS[code - 0xF000]
            return chr(code)
        if tag == "ruby":
            parts = ["".join(t.text or "" for part in x.findall(_W + name) for t in part.iter(_W + "t")) for name in ("rubyBase", "rt")]
            return parts[0] + (f"（{parts[1]}）" if parts[1] else "")
        if tag in ("footnoteReference", "endnoteReference"):
            kind, number = tag.removesuffix("Reference"), x.get(_W + "id")
            note = self.notes.get((kind, number))
            if note is None:
                self.broken = True
            else:
                self.waiting.append((kind, number, note))
            return f"[^{kind[0]}{number}]"
        return None

    def noted(self) -> None:
        """The notes that the line before refers to, as blocks of their own."""
        while self.waiting:
            kind, number, note = self.waiting.pop(0)
            at = len(self.parts)
            self.blocks(note, "textbox")
            if len(self.parts) == at:
                self.add("textbox", "")
            first = self.parts[at]
            self.parts[at] = (*first[:2], f"[^{kind[0]}{number}]: {(first[2] or '').lstrip()}", *first[3:])

    def cell(self, c: ET.Element) -> str:
        """A cell's text, formulas, pictures and inner tables, in order. What is not understood becomes a part of its own too."""
        out: list[str] = []

        def walk(node: ET.Element) -> None:
            script = _script(node)
            for x in node:
                if (shown := self.sign(x)) is not None:
                    plain = shown.replace("&", "&amp;").replace("<", "&lt;")
                    out.append(" " if shown in ("\n", "\t") else _scripted(plain, script))
                elif x.tag == _M + "oMath":
                    latex = self.formula(x)
                    out.append("" if latex is None else f"${latex}$")
                elif x.tag == _W + "tbl":
                    out.append(_table(x, self.cell))
                elif x.tag == _W + "object":
                    latex = self.embedded(x)
                    out.append("" if latex is None else f"${latex}$")
                elif x.tag in (_W + "drawing", _W + "pict") and x.find(f".//{_W}txbxContent") is None:
                    for rel in [b.get(_R + "embed") for b in x.iter(_A + "blip")] + [b.get(_R + "id") for b in x.iter(_V + "imagedata")]:
                        at = self.medium(rel)
                        if at is None:
                            self.add("unresolved", self.targets.get(rel, rel), critical=True)
                        else:
                            ext, content = self.media[at]
                            out.append(f'<img src="image/img_{hashlib.sha256(content).hexdigest()[:16]}.{ext}">')
                elif x.tag not in _SILENT and not x.tag.endswith("}Fallback"):
                    walk(x)
                    if x.tag == _W + "p":
                        out.append(" ")

        walk(c)
        return _joined(out).strip()

    def paragraph(self, p: ET.Element, kind: str = "paragraph") -> None:
        self.para += 1
        props = p.find(_W + "pPr")
        style = None if props is None else next((x.get(_W + "val") for x in props.findall(_W + "pStyle")), None)
        number = None if props is None else props.find(_W + "numPr")
        named = self.numbering.styled.get(style) if number is None else [next((x.get(_W + "val") for x in number.findall(_W + n)), "0") for n in ("numId", "ilvl")]
        label = self.numbering.label(*named) if named else None
        text: list[str] = []

        def flush() -> None:
            nonlocal label
            if text or label:
                self.add(kind, _joined(text), style, label)
                text.clear()
                label = None

        def walk(node: ET.Element) -> None:
            script = _script(node)
            for c in node:
                if (shown := self.sign(c)) is not None:
                    text.append(_scripted(shown, script))
                elif c.tag == _M + "oMath":
                    flush()
                    latex = self.formula(c)
                    if latex is not None:
                        self.add("formula", ET.tostring(c, encoding="unicode"), latex=latex, critical=True)
                elif c.tag == _W + "txbxContent":
                    flush()
                    self.blocks(c, "textbox")
                elif c.tag in (_W + "drawing", _W + "pict") and c.find(f".//{_W}txbxContent") is None:
                    flush()
                    self.picture(c)
                elif c.tag == _W + "object":
                    flush()
                    latex = self.embedded(c)
                    if latex is not None:
                        self.add("formula", ET.tostring(c, encoding="unicode"), latex=latex, critical=True)
                elif c.tag not in _SILENT and not c.tag.endswith("}Fallback"):
                    if len(c) == 0 and c.tag not in _HOLDERS and not c.tag.startswith((_A, _V)) and (c.tag.startswith(_W) or (c.text or "").strip()):
                        flush()
                        self.add("unresolved", ET.tostring(c, encoding="unicode"), critical=True)
                    walk(c)

        walk(p)
        flush()
        self.noted()

    def blocks(self, parent: ET.Element, kind: str = "paragraph") -> None:
        """The parts of a body, text box or content control; what is not known becomes unresolved, and nothing is dropped."""
        for node in parent:
            if node.tag == _W + "p":
                self.paragraph(node, kind)
            elif node.tag == _W + "tbl":
                self.para += 1
                self.add("table", None, critical=True)
                at = len(self.parts) - 1
                self.parts[at] = (*self.parts[at][:2], _table(node, self.cell), *self.parts[at][3:])
                self.noted()
            elif node.tag == _M + "oMathPara":
                for x in node.iter(_M + "oMath"):
                    latex = self.formula(x)
                    if latex is not None:
                        self.add("formula", ET.tostring(x, encoding="unicode"), latex=latex, critical=True)
            elif node.tag in (_W + "sdt", _W + "sdtContent", _W + "customXml", _W + "ins", _W + "moveTo", _W + "smartTag"):
                self.blocks(node, kind)
            elif node.tag not in _SILENT and not node.tag.endswith("Pr"):
                self.add("unresolved", ET.tostring(node, encoding="unicode"), critical=True)


def parse(content: bytes) -> tuple[str, list[tuple], list[tuple[str, bytes]]]:
    """(status, parts, media) of one package. No package stops the job, whatever is in it."""
    try:
        taken = _Package(content)
        taken.blocks(taken.body if taken.body is not None else ())
    except (*_DAMAGE, IndexError, TypeError, AttributeError, RecursionError):
        return "parse_failed", [], []
    for name in sorted(n for n in taken.names if n.startswith(("word/header", "word/footer")) and n.endswith(".xml")):
        try:
            for p in ET.fromstring(taken.package.read(name)).iter(_W + "p"):
                taken.paragraph(p, "header" if "header" in name else "footer")
        except (*_DAMAGE, IndexError, TypeError, AttributeError):
            taken.broken = True
    return "relation_broken" if taken.broken else "ok", taken.parts, taken.media


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """A row for each .docx file below a path: id, name, digest, status, parts in order, media."""
    return taken_apart(spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(path))


def taken_apart(files: DataFrame) -> DataFrame:
    """A row for each package of files (path, content): id, name, digest, status, parts in order, media. A null content is a package that cannot be read."""

    def taken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                content = content or b""
                digest = hashlib.sha256(content).hexdigest()
                status, parts, media = parse(content)
                keys = ("ord", "type", "raw_text", "style_id", "resolved_label", "latex", "asset", "is_critical", "para")
                rows.append((f"doc_{digest[:16]}", name.rpartition("/")[2], digest, status, [dict(zip(keys, p, strict=True)) for p in parts], [{"ext": e, "content": c} for e, c in media]))
            yield pd.DataFrame(rows, columns=["document_id", "source_file", "source_sha256", "status", "parts", "media"])

    return files.select("path", "content").mapInPandas(taken, PARSED)


def blocks(parsed: DataFrame) -> DataFrame:
    """(document_id, block_id, ord, type, ...): each block, with the asset it shows."""
    each = parsed.select("document_id", "media", F.explode("parts").alias("p"))
    asset = F.concat(F.lit("img_"), F.substring(F.sha2(F.get("media.content", F.col("p.asset")), 256), 1, 16))
    return each.select("document_id", F.concat_ws("_", "document_id", F.lpad(F.col("p.ord").cast("string"), F.greatest(F.lit(5), F.length(F.col("p.ord").cast("string"))), F.lit("0"))).alias("block_id"), "p.ord", "p.type", "p.raw_text", F.trim("p.raw_text").alias("normalized_text"), "p.style_id", "p.resolved_label", "p.latex", asset.alias("asset_id"), "p.is_critical", "p.para")


def assets(parsed: DataFrame) -> DataFrame:
    """(asset_id, sha256, ext, content): each image once, by its digest."""
    each = parsed.select(F.explode("media").alias("m")).select(F.sha2("m.content", 256).alias("sha256"), "m.ext", "m.content")
    return each.dropDuplicates(["sha256"]).select(F.concat(F.lit("img_"), F.substring("sha256", 1, 16)).alias("asset_id"), "sha256", "ext", "content")
