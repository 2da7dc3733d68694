"""Best-fit packing of documents into fixed-length sequences (operator 5).

Only the histogram of piece lengths (at most one count per length, so never
more than the sequence length) is planned, on the driver: the counts
by length serve as the index of single, pair and triple sums, combinations that
fill a gap exactly are consumed under their availability counts, and what is left goes best-fit,
longest first. The plan maps ranks within a length to sequences and offsets;
ranks are dealt out by Spark: each task numbers its pieces per length while it
tokenises, and the counts of earlier tasks are added. A length that holds a
third of all rows is thus never gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenaspark.llm.common import lean, shared_table
from arenaspark.llm.tokens import ids_crc32, public_tokenizer, slices_of, worker_encoder

CAPACITY = 2048
END_ID = 0
SLICE_BYTES = 1 << 22
TOKENIZER = "byte_bpe_50k.json"

Group = tuple[int, list[tuple[int, int]]]  # number of sequences, [(length, how many of it in each)]


def _common(avail: np.ndarray, lengths: tuple[int, ...]) -> int:
    """How often the combination can be taken at once."""
    return min(int(avail[x]) // lengths.count(x) for x in set(lengths))


def _best_pair(avail: np.ndarray, total: int, most: int, used: tuple[int, ...]) -> tuple[int, int] | None:
    """The pair a >= b with a + b = total, a <= most, that is available beside ``used``; the largest a."""
    lo, hi = (total + 1) // 2, min(most, total - 1)
    if hi < lo:
        return None
    a = np.arange(lo, hi + 1)
    for i in np.flatnonzero((avail[a] > 0) & (avail[total - a] > 0))[::-1]:
        pair = (int(a[i]), total - int(a[i]))
        if _common(avail, used + pair) > 0:
            return pair
    return None


def _exact(avail: np.ndarray, capacity: int, first: int) -> tuple[int, ...] | None:
    """Lengths that fill the gap beside ``first`` exactly: one, two or three of them, none longer than it."""
    gap = capacity - first
    if gap <= first and _common(avail, (first, gap)) > 0:
        return (gap,)
    if pair := _best_pair(avail, gap, first, (first,)):
        return pair
    for a in range(min(first, gap - 2), (gap + 2) // 3 - 1, -1):
        if avail[a] and _common(avail, (first, a)) > 0:
            if pair := _best_pair(avail, gap - a, a, (first, a)):
                return a, *pair
    return None


def plan_groups(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Sequences as groups of equal make-up, for ``counts`` pieces of each length."""
    avail = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        avail[length] = n
    groups: list[Group] = []

    def take(lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            avail[x] -= times
        groups.append((times, [(x, lengths.count(x)) for x in sorted(set(lengths), reverse=True)]))

    if avail[capacity]:
        take((capacity,), int(avail[capacity]))
    for length in range(capacity - 1, 0, -1):
        while avail[length] and 4 * length >= capacity:
            rest = _exact(avail, capacity, length)
            if rest is None:
                break
            take((length, *rest), _common(avail, (length, *rest)))

    # best fit, longest first; open sequences are grouped by gap
    gaps: dict[int, list[Group]] = {}

    def put(gap: int, group: Group) -> None:
        if gap:
            gaps.setdefault(gap, []).append(group)
        else:
            groups.append(group)

    for length in range(capacity - 1, 0, -1):
        left = int(avail[length])
        while left:
            fit = min((g for g in gaps if g >= length), default=None)
            if fit is None:
                each = capacity // length
                if left >= each:
                    put(capacity - each * length, (left // each, [(length, each)]))
                if left % each:
                    put(capacity - left % each * length, (1, [(length, left % each)]))
                left = 0
                continue
            times, made = gaps[fit].pop()
            if not gaps[fit]:
                del gaps[fit]
            each = min(fit // length, max(1, left // times))
            now = min(times, left // each)
            if now < times:
                gaps.setdefault(fit, []).append((times - now, made))
            put(fit - each * length, (now, [*made, (length, each)]))
            left -= now * each
    for open_groups in gaps.values():
        groups += open_groups
    return groups


def plan_rows(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, how many in each sequence, offset) per part of a group."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for times, made in groups:
        offset = 0
        for length, each in made:
            lo = ranks.get(length, 0)
            ranks[length] = lo + times * each
            rows.append((length, lo, ranks[length], sequence, each, offset))
            offset += length * each
        sequence += times
    return rows


def cut_pieces(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first may be shorter."""
    first = n % capacity or capacity if n > capacity else n
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def piece_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
                capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per piece, with the task that made it and its rank among that task's pieces of its length.

    ``slice_bytes`` of text are tokenised at once; fewer take less memory and more time."""
    path = tokenizer_path or public_tokenizer(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = worker_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            texts, keys = b.column(1), b.column(0)
            for part in slices_of(texts, slice_bytes):
                ids, counts = encoder.encode(texts[part])
                rows, at = [], 0
                for k, n in enumerate(counts.tolist(), part.start):
                    own = np.append(ids[at:at + n], np.uint32(end_id))
                    at += n
                    for p, (start, length) in enumerate(cut_pieces(n + 1, capacity)):
                        piece = own[start:start + length]
                        rows.append((k, p, start, length, ids_crc32(piece), int(seen[length]),
                                     piece.tolist() if with_ids else None))
                        seen[length] += 1
                if rows:
                    k, p, start, length, crc, rank, own = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(k)), pa.array(p, pa.int32()), pa.array(start, pa.int64()),
                         pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(k), pa.int32()),
                         pa.array(rank, pa.int64()), pa.array(own, pa.list_(pa.int64()))],
                        names=[id_col, "piece", "start", "length", "ids_crc32", "task", "task_rank", "ids"])

    src = docs.select(id_col, text_col)
    out = src.mapInArrow(lean(run, 2048), f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, piece int, start bigint, "
                              "length bigint, ids_crc32 bigint, task int, task_rank bigint, ids array<bigint>")
    return out if with_ids else out.drop("ids")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids on request).

    Null and empty texts are one piece that holds the end id. Repeated rows and null ids are packed like any
    other row; an empty table gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    pieces = shared_table(piece_table(docs, id_col, text_col, tokenizer_path, capacity, end_id, with_ids, slice_bytes), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = shared_table(per_task.select("length", "task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")),
                           "piece-counts")
    counts = {r["length"]: r["n"] for r in earlier.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan_rows(plan_groups(counts, capacity))
    plan = spark.createDataFrame(rows or [(0, 0, 0, 0, 1, 0)],
                                 "length long, lo long, hi long, first_sequence long, each long, base long")
    ranked = pieces.join(earlier.drop("n"), ["length", "task"]).withColumn("rank", F.col("earlier") + F.col("task_rank"))
    at = F.col("rank") - F.col("lo")
    placed = ranked.join(F.broadcast(plan), "length").where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return placed.select(id_col, "piece", "start", "length", "ids_crc32",
                         (F.col("first_sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("base") + F.pmod(at, F.col("each")) * F.col("length")).alias("offset"),
                         *(["ids"] if with_ids else []))
