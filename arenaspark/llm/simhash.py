"""SimHash near-duplicates with pigeonring candidate filtering (operator 2).

Fingerprints: majority vote over the XXH64 values of word shingles. Links:
fingerprints within ``max_bits`` = 3 differing bits. Searching them uses the
pigeonring principle on four 16-bit segments arranged in a ring: when two
fingerprints differ in at most 3 bits, some segment i starts a chain whose
cumulative differences over its first 1, 2, 3, 4 segments stay within the
proportional budgets floor(3l/4) = 0, 1, 2, 3. The first three budgets become
equality keys: segment i agrees, and of the four 8-bit halves of segments
i+1 and i+2 at least two agree (their differences sum to at most 2). So each
distinct fingerprint is keyed 4 x 6 times by 32 bits, fingerprints that share
a key are checked for the whole chain, and only then comes the full Hamming
check.

Copies with equal fingerprints are collapsed before the join, so a group of
thousands of copies is one row; a pair is emitted at its first matching key
only. A key holds 32 of the 64 bits, so
distinct fingerprints that agree in these crowd it; adaptive execution splits a
crowded key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.llm.common import lean, shared_table, small_side
from arenaspark.llm.components import components

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 3
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash; null or wordless text gives 0.

    ASCII letters are lower-cased; words are split at ASCII white space; a text
    of fewer words than a shingle is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams: list[bytes] = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(grams), 1 << 16):
        h = np.array([digest(g, seed) for g in grams[start:start + (1 << 16)]], dtype=">u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * votes > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp): one signed 64-bit fingerprint per row of ``docs``, whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    src = docs.select(id_col, text_col)
    return src.mapInArrow(lean(run), f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def ring_masks() -> list[int]:
    """Bit masks of the 24 keys: segment i and two of the four halves that follow it."""
    seg = [0xFFFF << (48 - 16 * i) for i in range(4)]
    out = []
    for i in range(4):
        halves = []
        for j in (1, 2):
            s = 48 - 16 * ((i + j) % 4)
            halves += [0xFF << (s + 8), 0xFF << s]
        out += [seg[i] | x | y for x, y in combinations(halves, 2)]
    return out


def chain_holds(x, budget: int = MAX_BITS):
    """Column: the four-segment ring of difference word ``x`` has a chain whose
    first l segments differ in at most floor(budget * l / 4) bits, l = 1..4."""
    d = [F.bit_count(F.shiftrightunsigned(x, 48 - 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    found = F.lit(False)
    for i in range(4):
        ok, total = F.lit(True), F.lit(0)
        for length in range(1, 5):
            total = total + d[(i + length - 1) % 4]
            ok = ok & (total <= budget * length // 4)
        found = found | ok
    return found


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): all pairs a < b of distinct values of column ``fp`` within
    ``MAX_BITS`` bits, each once."""
    masks = [_signed(m) for m in ring_masks()]
    key = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])
    keyed = fps.select("fp", F.posexplode(key).alias("k", "bits"))
    left = keyed.select("k", "bits", F.col("fp").alias("a"))
    right = keyed.select(F.col("k").alias("k2"), F.col("bits").alias("bits2"), F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*[F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(n)) for n, m in enumerate(masks)])
    on = ((F.col("k") == F.col("k2")) & (F.col("bits") == F.col("bits2")) & (F.col("a") < F.col("b"))
          & chain_holds(x) & (F.bit_count(x) <= MAX_BITS) & (first == F.col("k")))
    return left.join(right, on).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most three
    differing bits. Null and empty texts have fingerprint zero and link like any
    other; repeated rows give repeated rows; null ids keep their fingerprint and
    class but never name a class unless the class has no other id; an empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    fps = shared_table(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = shared_table(fps.groupBy("fp").agg(F.min(id_col).alias("first_id")), "distinct-fp")
    root = components(fingerprint_links(distinct))
    classed = (distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = classed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = shared_table(classed.join(smallest, "root").select("fp", "component_id"), "fp-class")
    return fps.join(label, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pipeline stage: of each near-duplicate class the row with the smallest id stays.

    A repeated id (repeated rows) keeps one row: the one with the smallest content hash."""
    classes = shared_table(near_duplicates(docs, id_col, text_col), "classes")
    own = F.col(id_col)
    copies = small_side(classes.where(~own.eqNullSafe(F.col("component_id"))).select(own.alias("copy_id")).distinct(), 1_000_000)
    kept = docs.join(copies, docs[id_col].eqNullSafe(copies["copy_id"]), "left_anti")
    twice = shared_table(classes.where(own.eqNullSafe(F.col("component_id"))).groupBy(own.alias("twice_id")).count()
                         .where("count > 1").select("twice_id"), "repeated-ids")
    if not twice.limit(1).count():
        return kept
    side = small_side(twice, 1_000_000)
    on = docs[id_col].eqNullSafe(side["twice_id"])
    first = F.min(F.struct(F.xxhash64(*docs.columns).alias("order"), F.struct(*docs.columns).alias("row"))).alias("first")
    again = kept.join(side, on, "left_semi").groupBy(id_col).agg(first).select("first.row.*")
    return kept.join(side, on, "left_anti").unionByName(again)
