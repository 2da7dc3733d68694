"""Personal data with exact source offsets (operator 1).

Base detectors run over the text as it stands. The method adds what is
disguised: a cascade of transducers rewrites homoglyphs and invisible
characters, spelled digits and at/dot disguises; each transducer keeps an
alignment from its output back to its input, the same detectors run over the
normalised text, and what they find is mapped back through the alignments to
source characters.

Every scan is linear in the text, so a long run without spaces costs no more
than prose. Spark partitions the rows; each row is handled on its own, with no
shuffle.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from arenaspark.llm.common import lean

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]
Edit = tuple[int, int, str]

# ---------------------------------------------------------------- detectors
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# every ip, card and phone match lies inside one such run
_NUMERIC_RUN = re.compile(r"[0-9+][\x20().0-9+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> list[Span]:
    out, floor = [], 0
    for m in _EMAIL_TAIL.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            floor = m.end()
            out.append((start, floor))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def detect(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping matches of each kind; failing matches are dropped, not retried."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    for run in _NUMERIC_RUN.finditer(text):
        lo, hi = run.span()
        if hi - lo < 7:
            continue
        for m in _IP.finditer(text, lo, hi):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found["ip"].append(m.span())
        for m in _CARD.finditer(text, lo, hi):
            digits = _NON_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found["card"].append(m.span())
        for m in _PHONE.finditer(text, lo, hi):
            if 8 <= len(_NON_DIGIT.sub("", m.group())) <= 15:
                found["phone"].append(m.span())
    return found


# ------------------------------------------------------------- transducers
class Alignment:
    """Piecewise map from an output text back to the input it was rewritten from."""

    def __init__(self, text: str, edits: list[Edit]):
        out: list[str] = []
        self.out_at, self.src_at, self.src_len = [], [], []  # one entry per piece
        self.rewritten: list[bool] = []
        pos = length = 0

        def piece(s: str, src: int, n: int, new: bool) -> None:
            nonlocal length
            self.out_at.append(length)
            self.src_at.append(src)
            self.src_len.append(n)
            self.rewritten.append(new)
            out.append(s)
            length += len(s)

        for start, end, new in edits:
            if start > pos:
                piece(text[pos:start], pos, start - pos, False)
            piece(new, start, end - start, True)
            pos = end
        if pos < len(text) or not edits:
            piece(text[pos:], pos, len(text) - pos, False)
        self.text = "".join(out)

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of output characters [start, end), and whether any of them was rewritten."""
        i, j = bisect_right(self.out_at, start) - 1, bisect_right(self.out_at, end - 1) - 1
        lo = self.src_at[i] + (0 if self.rewritten[i] else start - self.out_at[i])
        hi = self.src_at[j] + (self.src_len[j] if self.rewritten[j] else end - self.out_at[j])
        return lo, hi, any(self.rewritten[i:j + 1])


# Letters of other scripts that look like ASCII letters, and characters that do not show.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "ɡ": "g", "ӏ": "l", "А": "A", "В": "B", "Е": "E",
    "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ѕ": "S",
    "Ј": "J", "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "Α": "A", "Β": "B",
    "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "ı": "i", "。": ".", "∙": ".", "•": ".", "·": ".", "‐": "-", "‒": "-", "–": "-", "—": "-", "−": "-",
}
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"


def _char_table() -> dict[str, str]:
    """Non-ASCII character -> ASCII, by compatibility normalisation, decimal value and the lists above."""
    table = {}
    for cp in (*range(0x80, 0x3000), *range(0xFE00, 0x10000), *range(0x1D400, 0x1D800)):
        c = chr(cp)
        n = unicodedata.normalize("NFKC", c)
        if (d := unicodedata.decimal(c, None)) is not None:
            table[c] = str(d)
        elif len(n) == 1 and " " <= n < "\x7f":
            table[c] = n
    return table | _LOOKALIKES | dict.fromkeys(_INVISIBLE, "")


_CHARS = _char_table()
_HOMOGLYPH = re.compile("[" + re.escape("".join(c for c in _CHARS if c < "\U00010000")) + "\U0001d400-\U0001d7ff]")
_NOT_PLAIN = re.compile("[\xa0-\xbf\u0131\u017f\u0250-\U0010ffff]")  # no homoglyph lies outside these ranges

# Digit words and what may stand between them.
_DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
                "seven": "7", "eight": "8", "nine": "9"}
_NUMBER_MARKS = {"dot": ".", "point": ".", "dash": "-", "hyphen": "-"}
_REPEATS = {"double": 2, "triple": 3}
_TOKEN = "|".join([*_DIGIT_WORDS, *_NUMBER_MARKS, *_REPEATS, "[0-9]++"])
_SPELLED = re.compile(rf"(?i)(?<![A-Za-z0-9])(?:plus[\s-]{{1,3}})?(?:{_TOKEN})(?:[\s,-]{{1,3}}(?:{_TOKEN}))+(?![A-Za-z0-9])")
_SPELLED_HINT = re.compile(rf"(?:{'|'.join(_DIGIT_WORDS)})[\s,-]{{1,3}}(?:{_TOKEN})[\s,-]|"
                           rf"(?:dot|point)[\s,-]{{1,3}}(?:{'|'.join(_DIGIT_WORDS)})(?![a-z])")
_PART = re.compile(r"[A-Za-z]+|[0-9]+")
MIN_SPELLED = 4  # digit words in a run, figures may stand between them, before it is read as a number
ADDRESS_MARKS = 3  # or so many spelled dots with a digit word

_DOT = r"(?:[ \t]*[\[({<][ \t]*(?:dot|punkt|punto|\.)[ \t]*[\])}>][ \t]*|[ \t]+dot[ \t]+)"
_AT = r"(?:[ \t]*[\[({<][ \t]*(?:at|arroba|@)[ \t]*[\])}>][ \t]*|[ \t]+at[ \t]+|@)"
_AT_CORE = re.compile(rf"(?i)(?P<at>{_AT})[A-Za-z0-9-]+(?:(?:\.|{_DOT})[A-Za-z0-9-]+)+")
_DOT_RE = re.compile(rf"(?i){_DOT}")
_IP_DOTS = re.compile(rf"(?i)(?<![0-9])[0-9]{{1,3}}(?:(?:\.|{_DOT})[0-9]{{1,3}}){{3}}(?![0-9])")
_DISGUISE_HINT = re.compile(r"(?i)[\[({<][ \t]*(?:at|arroba|@|dot|punkt|punto|\.)[ \t]*[\])}>]|[ \t]dot[ \t]")


def homoglyph_edits(text: str) -> list[Edit]:
    if text.isascii() or not _NOT_PLAIN.search(text):
        return []
    return [(m.start(), m.end(), _CHARS.get(m.group(), m.group())) for m in _HOMOGLYPH.finditer(text)
            if m.group() in _CHARS]


def spelled_digit_edits(text: str) -> list[Edit]:
    """Runs of digit words, which figures may interrupt. Next to a figure a space or hyphen stays, so that
    numbers keep their groups; between two figures the source stays as it is."""
    if not _SPELLED_HINT.search(text.lower()):
        return []
    edits = []
    for m in _SPELLED.finditer(text):
        out, spelled, dots, times = [], 0, 0, 1
        before, end = "", m.start()  # kind and end of the part before
        for x in _PART.finditer(m.group()):
            w, at = x.group().lower(), m.start() + x.start()
            if w in _REPEATS:
                times = _REPEATS[w]
                continue
            kind = "figure" if w[0].isdigit() else "word" if w in _DIGIT_WORDS else "mark"
            if before == kind == "figure":
                out.append(text[end:at])
            elif {before, kind} == {"figure", "word"}:
                out.append("-" if "-" in text[end:at] else " ")
            out.append("+" if w == "plus" else _DIGIT_WORDS.get(w, _NUMBER_MARKS.get(w, w)) * times)
            spelled += kind == "word"
            dots += _NUMBER_MARKS.get(w) == "."
            before, end, times = kind, m.start() + x.end(), 1
        if spelled >= MIN_SPELLED or (spelled and dots >= ADDRESS_MARKS):
            edits.append((m.start(), m.end(), "".join(out)))
    return edits


def _local_dots(text: str, end: int, floor: int, dot_at: dict[int, int]) -> list[Span] | None:
    """Disguised dots inside the local part that ends at ``end``; None without a local part.

    Walks left over the part's characters and the disguised dots between them (``dot_at``: end to start), at most to
    ``floor``, the end of the address before, so all walks of a text together are linear in it."""
    out: list[Span] = []
    at = end
    while True:
        stop = at
        while at > floor and text[at - 1] in _LOCAL:
            at -= 1
        if at == stop:  # no character of the local part here: what was taken last is no dot of it
            return out[:-1] if out else None
        start = dot_at.get(at, -1)
        if start < floor or start < 0:
            return out
        out.append((start, at))
        at = start


def at_dot_edits(text: str) -> list[Edit]:
    """A bare " at " counts only when a disguised dot follows it; a plain "@" likewise needs no rewriting."""
    if not _DISGUISE_HINT.search(text):
        return []
    edits: dict[int, Edit] = {}
    dot_at: dict[int, int] | None = None
    floor = 0
    for m in _AT_CORE.finditer(text):
        at = m.group("at")
        dots = [d.span() for d in _DOT_RE.finditer(text, m.end("at"), m.end())]
        if not dots and (at == "@" or not re.search(r"[\[({<]", at)):
            continue
        if dot_at is None:
            dot_at = {b: a for a, b in (d.span() for d in _DOT_RE.finditer(text))}
        local = _local_dots(text, m.start(), floor, dot_at)
        if local is None:
            continue
        floor = m.end()
        if at != "@":
            edits[m.start("at")] = (m.start("at"), m.end("at"), "@")
        for a, b in [*local, *dots]:
            edits[a] = (a, b, ".")
    for m in _IP_DOTS.finditer(text):
        for d in _DOT_RE.finditer(text, m.start(), m.end()):
            edits.setdefault(d.start(), (d.start(), d.end(), "."))
    out: list[Edit] = []
    for e in sorted(edits.values()):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


TRANSDUCERS: tuple[Callable[[str], list[Edit]], ...] = (homoglyph_edits, spelled_digit_edits, at_dot_edits)


def disguised(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans found only after normalisation, in source offsets.

    A span counts if a rewritten character lies in it and it does not overlap a
    base span, unless it holds that span whole and is longer."""
    steps, now = [], text
    for edits_of in TRANSDUCERS:
        edits = edits_of(now)
        if edits:
            steps.append(Alignment(now, edits))
            now = steps[-1].text
    if not steps:
        return {}
    taken = [s for spans in base.values() for s in spans]
    out: dict[str, list[Span]] = {}
    for kind, spans in detect(now).items():
        for start, end in spans:
            touched = False
            for step in reversed(steps):
                start, end, new = step.source(start, end)
                touched |= new
            clash = [(a, b) for a, b in taken if a < end and start < b]
            if touched and all(start <= a and b <= end and (a, b) != (start, end) for a, b in clash):
                out.setdefault(kind, []).append((start, end))
    return out


def scan(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base spans, all spans) of one text, each by kind and ordered by start."""
    text = text or ""
    base = detect(text)
    extra = disguised(text, base)
    if not extra:
        return base, base
    return base, {k: sorted(base[k] + extra.get(k, [])) for k in KINDS}


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def mask_text(text: str, spans: dict[str, list[Span]]) -> str:
    """Replace each span by its kind in angle brackets; overlapping spans become one, named after the first."""
    every = sorted((a, -b, k) for k in KINDS for a, b in spans[k])
    out, pos = [], 0
    for a, b, k in ((a, -nb, k) for a, nb, k in every):
        if a >= pos:
            out += [text[pos:a], f"<{k.upper()}>"]
        pos = max(pos, b)
    return "".join(out) + text[pos:]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base counts, base digest and all spans.

    Null text counts as empty (no spans, digest of the empty string); null ids
    and repeated rows pass through as they are; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: dict[str, list] = {f"n_{k}": [] for k in KINDS} | {"base_sha256": [], "spans": []}
            for t in b.column(1).to_pylist():
                base, every = scan(t)
                for k in KINDS:
                    cols[f"n_{k}"].append(len(base[k]))
                cols["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest())
                cols["spans"].append(_listed(every))
            kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(v, t) for v, t in zip(cols.values(), kinds))], names=[id_col, *cols])

    src = docs.select(id_col, text_col)
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(lean(run), f"`{id_col}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                               "base_sha256 string, spans string")


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by a placeholder and ``length_col`` brought up to date.

    Null texts stay null. All columns are kept, in order."""
    names = docs.columns
    at = names.index(text_col)
    len_at = names.index(length_col) if length_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arrays = list(b.columns)
            texts = [None if t is None else mask_text(t, scan(t)[1]) for t in b.column(at).to_pylist()]
            arrays[at] = pa.array(texts, pa.string())
            if len_at is not None:
                old = b.column(len_at)
                arrays[len_at] = pa.array([o if t is None else len(t) for o, t in zip(old.to_pylist(), texts)], old.type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(lean(run), docs.schema)
