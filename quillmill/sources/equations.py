"""Formulas of embedded equation editors: a compound file's stream of equation records, and LaTeX of them.

Both formats are read from their published layouts. What is not certain to be understood raises EquationError, so that the
caller keeps the object unresolved with its preview; nothing is guessed.
"""

from __future__ import annotations

from struct import error as StructError
from struct import unpack_from

# Fixed values of the compound file format: its signature, the marks in sector chains, the size of its entries.
_SIGNATURE = bytes.fromhex("d0cf11e0a1b11ae1")
_LAST, _ENTRY = 0xFFFFFFFA, 128
#: The stream that equation editors write, and the length of its own header.
STREAM, _HEADER = "Equation Native", 28
#: Sectors and records that are followed at most; a chain that is longer is damaged.
MOST = 1 << 20


class EquationError(ValueError):
    """Not an equation, damaged, or outside the supported records."""


def stream(content: bytes, name: str = STREAM) -> bytes:
    """The stream of that name in a compound file."""
    try:
        return _stream(content, name)
    except (StructError, IndexError) as damage:
        raise EquationError("damaged compound file") from damage


def _stream(content: bytes, name: str) -> bytes:
    if content[:8] != _SIGNATURE:
        raise EquationError("no compound file")
    shift, small_shift = unpack_from("<HH", content, 30)
    tables, first, cutoff, small_first = unpack_from("<I", content, 44)[0], unpack_from("<I", content, 48)[0], unpack_from("<I", content, 56)[0], unpack_from("<I", content, 60)[0]
    if not 7 <= shift <= 16 or not 4 <= small_shift < shift:
        raise EquationError("sizes of sectors")
    size = 1 << shift
    sector = lambda i: content[(i + 1) * size : (i + 2) * size]
    # the sectors of the allocation table: 109 in the header, the others in a chain of their own
    places, more = list(unpack_from("<109I", content, 76)), unpack_from("<I", content, 68)[0]
    while more < _LAST and len(places) < tables:
        numbers = unpack_from(f"<{size // 4}I", sector(more))
        places, more = [*places, *numbers[:-1]], numbers[-1]
    allocated = [n for p in places[:tables] for n in unpack_from(f"<{size // 4}I", sector(p))]

    def chain(at: int, table: list[int]) -> list[int]:
        seen: list[int] = []
        while at < _LAST:
            if at >= len(table) or len(seen) > min(len(table), MOST):
                raise EquationError("damaged chain")
            seen.append(at)
            at = table[at]
        return seen

    whole = lambda at: b"".join(map(sector, chain(at, allocated)))
    directory = whole(first)
    entries = {}
    for at in range(0, len(directory) - _ENTRY + 1, _ENTRY):
        length, kind = unpack_from("<HB", directory, at + 64)
        if kind in (2, 5) and 2 <= length <= 64:  # a stream, or the root, which holds the small sectors
            entries["" if kind == 5 else directory[at : at + length - 2].decode("utf-16-le", "replace")] = unpack_from("<II", directory, at + 116)
    if name not in entries:
        raise EquationError(f"no {name}")
    start, length = entries[name]
    if length >= cutoff:
        data = whole(start)
    else:
        inner, small = whole(entries.get("", (_LAST, 0))[0]), 1 << small_shift
        table = [n for i in chain(small_first, allocated) for n in unpack_from(f"<{size // 4}I", sector(i))]
        data = b"".join(inner[i << small_shift : (i << small_shift) + small] for i in chain(start, table))
    if len(data) < length:
        raise EquationError("stream too short")
    return data[:length]


# Fixed values of the equation records, version 5: kinds of records, options, selectors of templates.
_END, _LINE, _CHAR, _TEMPLATE, _PILE, _MATRIX, _EMBELL, _RULER, _STYLE, _SIZE, _FULL, _SUBSYM, _COLOR, _COLOR_DEF, _FONT, _PREFS, _ENCODING, _FUTURE = 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 14, 15, 16, 17, 18, 19, 100
_NUDGE, _NULL, _HAS_RULER, _SPACING, _EMBELLISHED, _CHAR8, _CHAR16, _NO_CODE = 8, 1, 2, 4, 1, 4, 16, 32
_FENCES = {1: ("(", ")"), 2: (r"\{", r"\}"), 3: ("[", "]"), 4: ("|", "|")}
_ROOT, _FRACTION, _SUB, _SUP, _BOTH = 10, 11, 27, 28, 29
_SCRIPTS = {_SUB: "_", _SUP: "^", _BOTH: "_^"}
#: Signs with a command of their own; letters and digits of the Latin and Greek alphabets stand for themselves.
_SIGNS = {
    "−": "-", "×": r"\times ", "÷": r"\div ", "·": r"\cdot ", "±": r"\pm ", "≤": r"\le ", "≥": r"\ge ", "≠": r"\ne ", "≈": r"\approx ", "∞": r"\infty ", "π": r"\pi ", "α": r"\alpha ", "β": r"\beta ", "γ": r"\gamma ", "θ": r"\theta ",
    "λ": r"\lambda ", "μ": r"\mu ", "ω": r"\omega ", "Δ": r"\Delta ", "∠": r"\angle ", "△": r"\triangle ", "⊥": r"\perp ", "∥": r"\parallel ", "°": r"^{\circ}", "∈": r"\in ", "∪": r"\cup ", "∩": r"\cap ", "→": r"\to ", "{": r"\{", "}": r"\}", "%": r"\%", "#": r"\#", "&": r"\&", "$": r"\$", "_": r"\_", "\\": r"\backslash ", "^": r"\hat{}", "~": r"\sim ",
}


class _Records:
    """Equation records, read once from front to back."""

    def __init__(self, data: bytes):
        self.data, self.at, self.read = data, 0, 0

    def byte(self) -> int:
        if self.at >= len(self.data):
            raise EquationError("records end early")
        self.at += 1
        return self.data[self.at - 1]

    def word(self) -> int:
        return self.byte() | self.byte() << 8

    def number(self) -> int:
        """A byte, or after 255 two."""
        value = self.byte()
        return self.word() if value == 255 else value

    def text(self) -> str:
        out = bytearray()
        while sign := self.byte():
            out.append(sign)
        return out.decode("latin-1")

    def nudge(self, options: int) -> None:
        if options & _NUDGE and (self.byte(), self.byte()) == (128, 128):
            self.word(), self.word()

    def nibbles(self, values: int) -> None:
        """Values as half bytes: a unit and digits, up to a half byte of ones."""
        half = []
        while values:
            if not half:
                pair = self.byte()
                half = [pair >> 4, pair & 15]
            values -= half.pop(0) == 15

    def silent(self, kind: int) -> bool:
        """Reads a record that shows nothing; whether it was one."""
        if kind >= _FUTURE:
            self.at += self.number()
        elif kind == _RULER:
            self.at += 3 * self.byte()
        elif kind == _STYLE:
            self.number(), self.byte()
        elif kind == _SIZE:
            first = self.byte()
            self.at += 2 if first == 101 else 3 if first == 100 else 1
        elif kind == _COLOR:
            self.number()
        elif kind == _COLOR_DEF:
            options = self.byte()
            self.at += 8 if options & 1 else 6
            if options & 4:
                self.text()
        elif kind == _FONT:
            self.number(), self.text()
        elif kind == _ENCODING:
            self.text()
        elif kind == _PREFS:
            self.byte()
            self.nibbles(self.byte())
            self.nibbles(self.byte())
            for _ in range(self.byte()):
                if self.byte():
                    self.byte()
        else:
            return _FULL <= kind <= _SUBSYM
        return True

    def items(self, depth: int) -> list[str]:
        """What a list of records shows, up to its end."""
        out: list[str] = []
        while True:
            self.read += 1
            if self.read > MOST or depth > 60:
                raise EquationError("too many records")
            kind = self.byte()
            if kind == _END:
                return out
            if self.silent(kind):
                continue
            if kind == _LINE:
                out.append(self.line(depth))
            elif kind == _CHAR:
                out.append(self.char())
            elif kind == _TEMPLATE:
                self.template(out, depth)
            else:  # piles, matrices and embellishments have no certain form here
                raise EquationError(f"record {kind}")

    def line(self, depth: int) -> str:
        options = self.byte()
        self.nudge(options)
        if options & _SPACING:
            self.word()
        if options & _HAS_RULER and self.byte() == _RULER:
            self.silent(_RULER)
        return "" if options & _NULL else "".join(self.items(depth + 1))

    def char(self) -> str:
        options = self.byte()
        self.nudge(options)
        self.byte()  # typeface
        if options & (_NO_CODE | _EMBELLISHED):
            raise EquationError("sign of a font, or with marks")
        sign = chr(self.word())
        self.at += (1 if options & _CHAR8 else 0) + (2 if options & _CHAR16 else 0)
        if sign in _SIGNS:
            return _SIGNS[sign]
        if sign.isspace():
            return " "
        if not ("!" <= sign <= "~" or "Α" <= sign <= "ω" or "一" <= sign <= "鿿"):
            raise EquationError(f"sign {ord(sign):x}")
        return sign

    def template(self, out: list[str], depth: int) -> None:
        options = self.byte()
        self.nudge(options)
        selector, variation = self.byte(), self.byte()
        if variation & 128:
            variation = variation & 127 | self.byte() << 8
        self.byte()
        parts = self.items(depth + 1)
        if selector == _FRACTION and len(parts) == 2 and all(parts):
            out.append(rf"\frac{{{parts[0]}}}{{{parts[1]}}}")
        elif selector == _ROOT and parts and parts[0] and (variation == 0 or len(parts) > 1 and parts[1]):
            out.append(rf"\sqrt[{parts[1]}]{{{parts[0]}}}" if variation else rf"\sqrt{{{parts[0]}}}")
        elif selector in _SCRIPTS and len(parts) == 2 and not variation & 1 and out:
            low, high = parts
            if bool(low) != ("_" in _SCRIPTS[selector]) or bool(high) != ("^" in _SCRIPTS[selector]):
                raise EquationError("scripts")
            out.append((f"_{{{low}}}" if low else "") + (f"^{{{high}}}" if high else ""))
        elif selector in _FENCES and parts and variation & 3:
            begin, end = _FENCES[selector]
            out.append(rf"\left{begin if variation & 1 else '.'}{parts[0]}\right{end if variation & 2 else '.'}")
        else:
            raise EquationError(f"template {selector}")


def latex(records: bytes) -> str:
    """The LaTeX of equation records of version 5."""
    r = _Records(records)
    if r.byte() != 5:
        raise EquationError("version")
    r.at += 4
    r.text()
    r.byte()
    try:
        return "".join(r.items(0)).strip()
    except RecursionError as deep:
        raise EquationError("too deep") from deep


def formula(content: bytes) -> str:
    """The LaTeX of an embedded equation object."""
    data = stream(content)
    if len(data) < _HEADER or unpack_from("<H", data)[0] != _HEADER:
        raise EquationError("header")
    length = unpack_from("<I", data, 8)[0]
    if length > len(data) - _HEADER:
        raise EquationError("records end early")
    return latex(data[_HEADER : _HEADER + length])
