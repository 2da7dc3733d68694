"""Benchmark decontamination by template canonicalisation (operator 8).

Words become template tokens: numbers (digits or spelled), units and names
(title-case words, whose value matters less than its consistent use) are
replaced by typed placeholders that remember the value; everything else is
lower-cased without outer marks. Windows of ``WINDOW`` template tokens are
hashed; windows of the documents are joined with windows of the benchmark by
hash. A benchmark item re-asked with other names or numbers keeps its windows.
Windows of fewer than ``MIN_LITERALS`` literal words would match by chance and
are not joined as templates; every window with a slot is joined a second time by
its plain words, values instead of placeholders and without case, so lists of
names, arithmetic and copies in other letters are found as they stand.
What was joined must then fill its slots consistently: the same value of the
item has to become the same value in the document throughout an occurrence.
Windows of one occurrence lie about as far from their places in the item; they
are grouped in half-overlapping bands of that distance, narrower than the item,
so that copies in a row stay apart. The whole document is tried as one more
occurrence, for a copy that other words have stretched over several bands.

The documents are scanned where they lie: a task drops every window that is not
among the benchmark's window hashes, which it holds in blocks of at most
``BLOCK_HASHES`` (a larger benchmark is a few more scans, not a larger block),
so only hits are shuffled.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.llm.common import lean, shared_table, small_side
from arenaspark.llm.tokens import batches_of

WINDOW = 8
MIN_LITERALS = 4  # words of a template window that are no placeholder
MIN_ITEM_TOKENS = 3  # an item shorter than a window is one window of its own length, from so many tokens on
ENOUGH_WINDOWS = 6  # 13 words in a row
MIN_SHARE = 0.5
MIN_CONSISTENCY = 0.7
BLOCK_HASHES = 1_000_000
CACHE_WORDS = 250_000

# Number words and units.
_NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen".split())
_UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers g mg kg gram "
    "grams kilogram kilograms ton tons pound pounds lb lbs oz ounce ounces l ml liter liters litre litres gallon gallons "
    "s ms sec second seconds min minute minutes h hr hour hours day days week weeks month months year years kmh mph "
    "dollar dollars euro euros cent cents usd eur percent degree degrees celsius fahrenheit kelvin watt watts volt volts".split())
_MARKS = "\"'`.,;:!?()[]{}<>*#$%&|_~-–—…“”‘’«»¿¡/\\"
_NUMBER = re.compile(r"[+-]?[$€£]?([0-9][0-9.,:/]*)%?")
_QUANTITY = re.compile(r"[+-]?([0-9][0-9.,]*)([A-Za-z]+)")
_NUM, _UNIT, _NAME = "\x00num", "\x00unit", "\x00name"
_KNOWN = dict.fromkeys(_NUMBERS, _NUM) | dict.fromkeys(_UNITS - _NUMBERS, _UNIT)


def template_tokens(word: str) -> list[tuple[str, str | None]]:
    """(template token, slot value or None for a literal) of one word; a word of marks only has none."""
    bare = word.strip(_MARKS)
    if not bare:
        return []
    low = bare.lower()
    if bare[0].isalpha():  # neither a number in digits nor a quantity
        if low in _KNOWN:
            return [(_KNOWN[low], low)]
        if bare[0].isupper() and (len(bare) == 1 or not bare.isupper()):
            return [(_NAME, low)]
    elif m := _NUMBER.fullmatch(bare):
        return [(_NUM, m.group(1).rstrip(".,:/"))]
    elif (m := _QUANTITY.fullmatch(bare)) and m.group(2).lower() in _UNITS:
        return [(_NUM, m.group(1).rstrip(".,")), (_UNIT, m.group(2).lower())]
    return [(low, None)]


def _code(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), 7)


_KIND_CODES = {k: _code(k) for k in (_NUM, _UNIT, _NAME)}


class Canonicaliser:
    """Template tokens of texts as arrays, through a bounded cache of words."""

    def __init__(self) -> None:
        self._reset()

    def _reset(self) -> None:
        self.places: dict[str, int] = {}
        # per token: hash of the template token, hash of the plain word, slot value, whether it is a slot
        self.codes, self.plain = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.values, self.slot = np.zeros(0, object), np.zeros(0, bool)
        self.starts, self.lens = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token numbers (places in ``codes``, ``plain``, ``values`` and ``slot``) per text."""
        words = [(t or "").split() for t in texts]
        if len(self.places) > CACHE_WORDS:
            self._reset()
        fresh = list(set().union(*words).difference(self.places))
        if fresh:
            made = list(map(template_tokens, fresh))
            lens = np.fromiter(map(len, made), np.int64, len(made))
            at = len(self.lens)
            self.starts = np.concatenate([self.starts, len(self.codes) + np.cumsum(lens) - lens])
            self.lens = np.concatenate([self.lens, lens])
            flat = list(chain.from_iterable(made))
            digest = xxhash.xxh64_intdigest
            plain = np.array([digest((t if v is None else v).encode("utf-8", "surrogatepass"), 7) for t, v in flat], np.uint64)
            codes = plain.copy()
            values = np.empty(len(flat), object)
            values[:] = [v for _, v in flat]
            slot = np.array([v is not None for _, v in flat], bool)
            for i in np.flatnonzero(slot).tolist():
                codes[i] = _KIND_CODES[flat[i][0]]
            self.codes, self.plain = np.concatenate([self.codes, codes]), np.concatenate([self.plain, plain])
            self.values, self.slot = np.concatenate([self.values, values]), np.concatenate([self.slot, slot])
            self.places.update(zip(fresh, range(at, at + len(fresh))))
        out = []
        for ws in words:
            idx = np.fromiter(map(self.places.__getitem__, ws), np.int64, len(ws))
            n = self.lens[idx]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ws) else 0
            out.append(np.repeat(self.starts[idx] - ends + n, n) + np.arange(total))
        return out


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.ones(1, np.uint64), np.full(max(0, n - 1), base, np.uint64)))


def window_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` tokens: a polynomial modulo 2^64, from differences of its prefix sums."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(codes * _powers(_BASE, len(codes))))
    h = (sums[length:] - sums[:n]) * _powers(_BASE_INVERSE, n) + np.uint64(length)
    h ^= h >> np.uint64(32)
    return h * np.uint64(_BASE)


def _lengths(n_tokens: int) -> int:
    return WINDOW if n_tokens >= WINDOW else n_tokens


def _least(length: int) -> int:
    return min(MIN_LITERALS, -(-length // 2))


_SCHEMA = [("pos", pa.int32()), ("length", pa.int32()), ("h", pa.int64()), ("n_windows", pa.int32()), ("n_templates", pa.int32()),
           ("row", pa.int32()), ("template", pa.bool_()), ("plain", pa.bool_()), ("slot_at", pa.list_(pa.int32())),
           ("slot_value", pa.list_(pa.string()))]
_FIELDS = ("pos int, length int, h bigint, n_windows int, n_templates int, row int, template boolean, plain boolean, "
           "slot_at array<int>, slot_value array<string>")


def _rows(key, wanted, canon: Canonicaliser, at: np.ndarray, length: int, row: int = 0):
    """Rows of one text's windows of ``length``; ``wanted`` picks hashes, None: all; ``row`` tells texts of one id apart.

    A window without a slot is one row for template and plain words; one with slots is a row by its plain words,
    without slots, and if it has enough literals one as a template."""
    slot = canon.slot[at]
    h = window_hashes(canon.codes[at], length)
    if not len(h):
        return
    before = np.append(0, np.cumsum(slot))
    slots = before[length:] - before[:len(h)]
    good = length - slots >= _least(length)
    n, n_good = (len(h), int(good.sum())) if wanted is None else (0, 0)
    pick = good if wanted is None else good & wanted(h)
    for p in np.flatnonzero(pick).tolist():
        offs = np.flatnonzero(slot[p:p + length]).tolist()
        yield (key, p, length, int(h[p].astype(np.int64)), n, n_good, row, True, not offs, offs, [canon.values[at[p + o]] for o in offs])
    some = slots > 0
    if some.any():
        h = window_hashes(canon.plain[at], length)
        pick = some if wanted is None else some & wanted(h)
        for p in np.flatnonzero(pick).tolist():
            yield (key, p, length, int(h[p].astype(np.int64)), n, n_good, row, False, True, [], [])


def _batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    types = [key_type, *(t for _, t in _SCHEMA)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", *(n for n, _ in _SCHEMA)])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """All windows of the items: key, pos, length, h, n_windows and n_templates (of the item), template, plain, slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canonicaliser()
        for b in batches:
            rows = []
            for key, at in zip(b.column(0).to_pylist(), canon.texts(b.column(1).to_pylist())):
                if len(at) >= MIN_ITEM_TOKENS:
                    rows += _rows(key, None, canon, at, _lengths(len(at)))
            if rows:
                yield _batch(rows, b.column(0).type)

    src = benchmark.select(id_col, text_col)
    return src.mapInArrow(lean(run), f"key {src.schema[id_col].dataType.simpleString()}, {_FIELDS}")


def _picker(hashes: np.ndarray):
    """Membership in ``hashes``: a bitmap first, then a search."""
    hashes = np.unique(hashes)
    bits = np.zeros(1 << 22, bool)
    bits[hashes >> np.uint64(42)] = True

    def wanted(h: np.ndarray) -> np.ndarray:
        out = bits[h >> np.uint64(42)]
        some = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(hashes, h[some]), len(hashes) - 1)
        out[some] = hashes[at] == h[some]
        return out

    return wanted


def document_hits(docs: DataFrame, hashes: np.ndarray, lengths: list[int], id_col: str, text_col: str) -> DataFrame:
    """Windows of the documents whose hash is among ``hashes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon, wanted = Canonicaliser(), _picker(hashes)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for part in batches_of(texts):
                rows = []
                for key, text, at in zip(keys[part], texts[part], canon.texts(texts[part])):
                    row = zlib.crc32((text or "").encode("utf-8", "surrogatepass")) >> 1
                    for length in lengths:
                        rows += _rows(key, wanted, canon, at, length, row)
                    if len(rows) >= 4096:
                        yield _batch(rows, b.column(0).type)
                        rows = []
                if rows:
                    yield _batch(rows, b.column(0).type)

    src = docs.select(id_col, text_col)
    return src.mapInArrow(lean(run), f"key {src.schema[id_col].dataType.simpleString()}, {_FIELDS}")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item it contains: id, item id, n_matched, n_windows, consistency, verbatim.

    A pair counts when in one occurrence at least ``ENOUGH_WINDOWS`` template windows of the item, or half of them if
    that is fewer, occur, and at least ``MIN_CONSISTENCY`` of the filled slots agree with the commonest filling of their
    value (no slots: 1); or when as many of all its windows occur in their plain words. ``verbatim``: the latter, or
    every filled slot has the item's own value. n_matched and n_windows count windows of either kind once. The
    figures are those of the best occurrence: a verbatim one before others, then a consistent one, then that of most windows. Null and empty
    texts and items of fewer than three tokens match nothing; rows of one id are taken as one document; null ids come
    back as null; an empty table gives an empty result; other columns are not read."""
    items = shared_table(benchmark_windows(benchmark, item_col, item_text_col), "benchmark-windows")
    n_hashes = items.select("h").distinct().count()
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())
    found = None
    for block in range(max(1, -(-n_hashes // BLOCK_HASHES))):
        of = F.pmod(F.col("h"), F.lit(max(1, -(-n_hashes // BLOCK_HASHES))))
        own = items.where(of == block).select("h").distinct().collect()
        hashes = np.array([r["h"] for r in own], dtype=np.int64).view(np.uint64)
        if not len(hashes):
            continue
        part = document_hits(docs, hashes, lengths, id_col, text_col)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = document_hits(docs.limit(0), np.zeros(1, np.uint64), lengths, id_col, text_col)
    hits = shared_table(found.select("key", "h", "row", F.col("pos").alias("at"), F.col("template").alias("as_template"),
                                     F.col("plain").alias("as_plain"), F.col("slot_value").alias("filled")), "window-hits")
    side = items.select("h", F.col("key").alias("item"), "pos", "n_windows", "n_templates", "template", "plain", "slot_at",
                        F.col("slot_value").alias("asked"))
    half = F.greatest(F.lit(1), F.floor(F.col("n_windows") / 4))  # bands of twice that stay below the item's length
    band = F.shiftleft(F.col("row").cast("long"), 32) + F.floor((F.col("at") - F.col("pos")) / half) + (1 << 31)
    pairs = (hits.join(small_side(side, 200_000), "h")
             .withColumns({"template": F.col("template") & F.col("as_template"), "plain": F.col("plain") & F.col("as_plain")})
             .where("template or plain").withColumn("place", F.explode(F.array(F.lit(-1).cast("long"), band, band - 1))))

    def enough(found: str, of: str) -> F.Column:
        return (F.col(found) > 0) & (F.col(found) >= F.least(F.lit(ENOUGH_WINDOWS), F.ceil(F.col(of) * MIN_SHARE)))

    counts = (pairs.groupBy("key", "item", "place")
              .agg(F.countDistinct("pos").alias("n_matched"), F.countDistinct(F.when(F.col("template"), F.col("pos"))).alias("n_t"),
                   F.countDistinct(F.when(F.col("plain"), F.col("pos"))).alias("n_p"),
                   F.max("n_windows").alias("n_windows"), F.max("n_templates").alias("n_templates"))
              .select("key", "item", "place", "n_matched", "n_windows", enough("n_t", "n_templates").alias("enough"),
                      enough("n_p", "n_windows").alias("word_for_word")).where("enough or word_for_word"))
    counts = shared_table(counts, "window-counts")
    same = (F.col("key").eqNullSafe(F.col("k")) & F.col("item").eqNullSafe(F.col("i")) & (F.col("place") == F.col("p")))
    near = pairs.join(counts.select(F.col("key").alias("k"), F.col("item").alias("i"), F.col("place").alias("p")), same, "left_semi")
    slots = near.where("template").select("key", "item", "place", "pos", F.inline(F.arrays_zip("slot_at", "asked", "filled")))
    one = slots.groupBy("key", "item", "place", "asked", "filled").agg(F.countDistinct(F.col("pos") + F.col("slot_at")).alias("n"))
    by_value = one.groupBy("key", "item", "place", "asked").agg(F.max("n").alias("best"), F.sum("n").alias("all"),
                                                                F.min(F.col("asked") == F.col("filled")).alias("same"))
    fit = by_value.groupBy(F.col("key").alias("k"), F.col("item").alias("i"), F.col("place").alias("p")).agg(
        (F.sum("best") / F.sum("all")).alias("consistency"), F.min("same").alias("verbatim"))
    places = (counts.join(fit, same, "left")
              .select("key", "item", "word_for_word", F.struct(
                  (F.col("word_for_word") | F.coalesce("verbatim", F.lit(True))).alias("verbatim"),
                  (F.coalesce("consistency", F.lit(1.0)) >= MIN_CONSISTENCY).alias("fits"), "n_matched",
                  F.coalesce("consistency", F.lit(1.0)).alias("consistency"), "n_windows").alias("x"))
              .where("word_for_word or x.fits"))
    return (places.groupBy("key", "item").agg(F.max("x").alias("x"))
            .select(F.col("key").alias(id_col), F.col("item").alias("item_id"), "x.n_matched", "x.n_windows", "x.consistency",
                    "x.verbatim"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that contain a benchmark item."""
    leaks = small_side(shared_table(contaminated(docs, benchmark, id_col, text_col)
                                    .select(F.col(id_col).alias("leak_id")).distinct(), "leaks"), 1_000_000)
    return docs.join(leaks, docs[id_col].eqNullSafe(leaks["leak_id"]), "left_anti")
