"""Language identification with hyperdimensional profiles (operator 10).

Every letter has a random vector of +1/-1. A trigram's vector binds (multiplies)
its letters' vectors, each permuted (rotated) by its place; a document's vector
bundles (adds) the vectors of all its trigrams; a language's prototype bundles
the unit vectors of its training documents. The prediction is the prototype of
the highest cosine.

Letters are folded to ``ALPHABET`` classes: white space and marks are one
border symbol, so trigrams also see how words begin and end. Document vectors
are written once and serve both training and prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.llm.common import lean, shared_table

DIMENSIONS = 512
ALPHABET = 48  # border, a-z, and 21 classes that other letters are dealt to by code point
SEED = 20_240_601
MAX_LANGUAGES = 5_000


@lru_cache(1)
def letter_classes() -> np.ndarray:
    """Class of every code point; 0: no letter. Letters beyond the basic plane share one class.

    Case is folded; a-z have classes of their own."""
    out = np.zeros(0x110000, dtype=np.int8)
    rest = ALPHABET - 27
    for cp in range(0x10000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()[:1]
            out[cp] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % rest
    for cp in range(0x10000, 0x110000):  # emoji and digits of the other planes are no letters
        if chr(cp).isalpha():
            out[cp] = 27
    return out


@lru_cache(1)
def trigram_vectors() -> np.ndarray:
    """(ALPHABET ** 3, DIMENSIONS) bound vectors of all trigrams; those without a letter are zero."""
    letters = np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), (ALPHABET, DIMENSIONS))
    a, b, c = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters
    out = (a[:, None, None, :] * b[None, :, None, :] * c[None, None, :, :]).reshape(-1, DIMENSIONS)
    out[0] = 0
    return out


def document_vector(text: str) -> tuple[np.ndarray | None, bool]:
    """(unit vector, has a letter); no vector without a letter. Whole text, any length."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    classes = letter_classes().take(points)
    if not classes.any():
        return None, False
    classes = np.concatenate([[0], classes, [0]]).astype(np.int32)
    classes = classes[np.append(True, (classes[1:] != 0) | (classes[:-1] != 0))]  # one border between words
    code = (classes[:-2] * ALPHABET + classes[1:-1]) * ALPHABET + classes[2:]
    counts = np.bincount(code, minlength=ALPHABET ** 3)
    seen = np.flatnonzero(counts)
    vector = counts[seen].astype(np.float32) @ trigram_vectors()[seen].astype(np.float32)
    size = float(np.linalg.norm(vector))
    return (vector / size if size else vector), True


def document_vectors(docs: DataFrame, id_col: str, text_col: str, label_col: str | None) -> DataFrame:
    """id, label, has_letter and the unit vector (16-bit floats) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, 2048) for i in range(0, b.num_rows, 2048)):
                made = [document_vector(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([x for _, x in made]),
                     pa.array([None if v is None else v.astype("<f2").tobytes() for v, _ in made], pa.binary())],
                    names=["id", "label", "has_letter", "vector"])

    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), label.alias("label"))
    return src.mapInArrow(lean(run), f"id {src.schema['id'].dataType.simpleString()}, label string, has_letter boolean, vector binary")


def prototypes(vectors: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototype per label. Each task adds up its own rows, so only one vector per task and label is shuffled;
    at most ``MAX_LANGUAGES`` labels reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for label, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(raw, dtype="<f2").astype(np.float64)
                sums[label] = sums[label] + v if label in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["label", "part"])

    parts = vectors.select("label", "vector").mapInArrow(lean(add), "label string, part array<double>")
    # sums of halves and small integers of a fixed step: rounding to 1e-6 makes them free of the order of addition
    sums = (parts.select("label", F.posexplode("part").alias("i", "x")).groupBy("label", "i")
            .agg(F.sum(F.col("x").cast("decimal(28,10)")).alias("x"))
            .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", F.col("x").cast("double").alias("x")))).alias("v")))
    rows = sums.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for r in sorted(rows, key=lambda r: r["label"]):
        v = np.array([x["x"] for x in r["v"]])
        out[r["label"]] = v / (np.linalg.norm(v) or 1.0)
    return out


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score.

    Held out (never learned from): rows whose crc32 of the id as text leaves remainder 2 by 4. Learned from: the
    others with text, a letter and a label. ``und`` with score 0 for null text, text without a letter, or when
    nothing could be learned. ``score`` is the best cosine, not below 0; ties go to the label first in order. A null
    id is not held out; repeated rows pass through; an empty table gives an empty result; other columns are not read."""
    vectors = shared_table(document_vectors(docs, id_col, text_col, label_col), "language-vectors")
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    known = prototypes(vectors.where(~held & F.col("label").isNotNull() & F.col("vector").isNotNull()))
    names = list(known)
    table = np.stack(list(known.values())).astype(np.float32) if known else np.zeros((0, DIMENSIONS), np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = [], []
            for raw in b.column(2).to_pylist():
                if raw is None or not names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                cosine = table @ np.frombuffer(raw, dtype="<f2").astype(np.float32)
                best = int(np.argmax(cosine))
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosine[best]))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[id_col, "held_out", "lang_pred", "score"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", held.alias("held_out"), "vector").mapInArrow(
        lean(predict), f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")
