"""Hard-negative mining by L2AP-style threshold joins (operator 12).

Anchors are a stated query set against all rows, in tiles: a block of anchors
meets a block of rows, both of bounded size and dealt by hash. In a tile the
rows form an inverted index by dimension, dimensions of most energy first. A
row's dimensions from the first one on whose suffix norm times the largest
anchor norm stays under the threshold are not indexed: no row is found by them
alone. Partial scores are accumulated panel by panel, and a pair goes as soon
as its partial score plus the product of the remaining norms is under the
threshold; what is left is verified with the whole vectors, in whole numbers.
A search starts at a high threshold, which is lowered only for anchors whose
windows have not filled.

Two searches (positives, then negatives in the score windows these give), each
of two passes: first every anchor meets one block of rows with falling
thresholds, whose k-th best score then is the threshold for all blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenaspark.llm.common import release_memory, shared_table

ANCHOR_EVERY, POSITIVES, NEGATIVES = 50, 5, 3
ANCHOR_BLOCK, ROW_BLOCK = 2048, 16384   # tile sides: bound the memory of a task, never the result
SLICE_A, SLICE_B = 512, 4096            # a tile is worked through in slices of so many anchors and rows
PANEL = 16                              # dimensions accumulated between two prunings
SPARSE = 0.05                           # share of live pairs under which they are accumulated one by one
LOWERINGS = 4                           # steps from the starting threshold down to the floor
_FIELDS = "rid bigint, w int, vec_id bigint, score bigint"
_SCORES = (-(1 << 62), 1 << 62)         # windows are open at these ends; larger scores are clipped to them


def matrix(vectors: pa.ChunkedArray, order: list[int]) -> np.ndarray:
    """Rows of floor(256 * x), dimensions in ``order``; shorter vectors are filled up with zeros."""
    lists = vectors.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks == 1 else lists
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(lengths), len(order)))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out[:, order]


def suffix_norms(m: np.ndarray) -> np.ndarray:
    """Column k: the norm of dimensions k and on; one column more than dimensions, the last zero."""
    squares = np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(m), 1))]))


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whole-number inner products of matching rows: as doubles while these are exact, else as Python numbers."""
    if not len(x) or np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, x.shape[1]) < 2.0 ** 53:
        return np.einsum("ij,ij->i", x, y).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(p, q, strict=True)) for p, q in zip(x, y, strict=True)], dtype=object)


def threshold_join(x: np.ndarray, xn: np.ndarray, y: np.ndarray, yn: np.ndarray, least: np.ndarray,
                   allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the ``allowed`` pairs with score >= ``least`` of the anchor.

    ``xn`` and ``yn`` are suffix norms. Bounds carry a slack above their rounding error."""
    slack = 1.0 + 1e-9 * xn[:, :1].max(initial=0) * yn[:, 0].max(initial=0)
    # suffixes that no anchor can lift to the lowest threshold stay out of the index
    omitted = yn * xn[:, 0].max(initial=0) + slack < least.min(initial=np.inf)
    cut = np.where(omitted.any(axis=1), omitted.argmax(axis=1), y.shape[1])
    rows = np.flatnonzero(cut > 0) if np.isfinite(least.min(initial=np.inf)) else np.arange(len(y))
    postings = np.where(np.arange(y.shape[1])[None, :] < cut[:, None], y, 0.0)[rows]
    live = allowed[:, rows]
    kind = np.float32 if slack < 2.0 ** 20 * 1e-9 + 1 else np.float64  # whole numbers up to 2^24 are exact in the short form
    partial = np.zeros(live.shape, kind)
    need = (least - slack)[:, None]
    k, width = 0, y.shape[1]
    while k < width and len(rows) and live.mean() > SPARSE:
        end = min(k + PANEL, width)
        partial += x[:, k:end].astype(kind) @ postings[:, k:end].T.astype(kind)
        # what is to come: indexed dimensions after this panel and those omitted
        at = np.minimum(cut[rows], end)
        ahead = xn[:, end][:, None] * yn[rows, at][None, :]
        short = at < end
        if short.any():  # an omitted part that overlaps this panel is bounded by the norms from the cut on
            ahead[:, short] = xn[:, at[short]] * yn[rows[short], at[short]][None, :]
        live &= partial + ahead >= need
        keep = live.any(axis=0)
        if not keep.all():
            rows, postings, live, partial = rows[keep], postings[keep], live[:, keep], partial[:, keep]
        k = end
    a, b = np.nonzero(live)
    part, b = partial[a, b].astype(np.float64), rows[b]
    while k < width and len(a):  # few pairs left: only their own dimensions
        end = min(k + PANEL, width)
        indexed = np.arange(k, end)[None, :] < cut[b][:, None]
        part += np.einsum("ij,ij->i", x[a, k:end], np.where(indexed, y[b, k:end], 0.0))
        at = np.minimum(cut[b], end)
        stay = part + xn[a, at] * yn[b, at] >= need[a, 0]
        a, b, part, k = a[stay], b[stay], part[stay], end
    score = _exact(x[a], y[b])
    ok = score >= least[a] if len(score) else np.zeros(0, bool)
    ok = np.asarray(ok, bool)
    return a[ok], b[ok], score[ok]


def _first(keys: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of every key by falling score, then smaller id."""
    if score.dtype == object:
        order = np.array(sorted(range(len(keys)), key=lambda i: (keys[i], -score[i], ids[i])), dtype=np.int64)
    else:
        order = np.lexsort((ids, -score, keys))
    sorted_keys = keys[order]
    start = np.searchsorted(sorted_keys, sorted_keys)
    return order[np.arange(len(order)) - start < k]


def fill_windows(x, xn, y, yn, ids, allowed, low, high, k, lowerings=LOWERINGS):
    """(anchor, window, row, score): the first ``k`` rows of each window [low, high] (anchors x windows).

    The threshold falls from under the top of the windows to their floor, in ``lowerings``
    steps at most, only for anchors with an unfilled window."""
    wide = low <= high
    floor = np.nextafter(np.where(wide, low, np.inf).min(axis=1, initial=np.inf), -np.inf)
    floor[floor <= _SCORES[0]] = -np.inf
    reach = xn[:, 0] * yn[:, 0].max(initial=0)
    top = np.minimum(np.where(wide, high, -np.inf).max(axis=1, initial=-np.inf), reach)
    open_ = np.flatnonzero(wide.any(axis=1) & (floor <= reach + 1 + 1e-9 * reach))
    out = []
    for step in range(lowerings + 1):
        if not len(open_):
            break
        base = np.maximum(floor[open_], -reach[open_])
        least = floor[open_] if step == lowerings else base + (top[open_] - base) * 0.75 * (1 - step / lowerings)
        a, b, score = threshold_join(x[open_], xn[open_], y, yn, least, allowed[open_])
        full = np.ones(len(open_), bool)
        found = []
        for w in range(low.shape[1]):
            lo, hi = low[open_, w], high[open_, w]
            fits = np.asarray(((score >= lo[a]) | (lo[a] == _SCORES[0])) & ((score <= hi[a]) | (hi[a] == _SCORES[1])), bool)
            aw, bw, sw = a[fits], b[fits], score[fits]
            at = _first(aw, sw, ids[bw], k)
            found.append((aw[at], w, bw[at], sw[at]))
            need = wide[open_, w] & (least > low[open_, w])
            full &= ~need | (np.bincount(aw, minlength=len(open_)) >= k)
        done = full | (least <= floor[open_])
        for aw, w, bw, sw in found:
            sel = done[aw]
            out.append((open_[aw[sel]], np.full(sel.sum(), w), bw[sel], sw[sel]))
        open_ = open_[~done]
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate([np.asarray(o[i], object) if o[3].dtype == object and i == 3 else o[i] for o in out]) for i in range(4))


def _tile(order: list[int], same: bool, k: int, lowerings: int):
    """Search of one tile: anchors with their windows against a block of rows."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        parts = []
        if anchors.num_rows and rows.num_rows:
            x, y = matrix(anchors["vec"], order), matrix(rows["vec"], order)
            xn, yn = suffix_norms(x), suffix_norms(y)
            rid, ids, number = (np.asarray(t.to_numpy(), np.int64) for t in (anchors["rid"], rows["vec_id"], rows["rid"]))
            xl, yl = anchors["label"].to_numpy(), rows["label"].to_numpy()
            low = np.array(anchors["low"].to_pylist(), np.int64)
            high = np.array(anchors["high"].to_pylist(), np.int64)
            for i in range(0, len(x), SLICE_A):
                p = slice(i, i + SLICE_A)
                for j in range(0, len(y), SLICE_B):
                    q = slice(j, j + SLICE_B)
                    allowed = (xl[p][:, None] == yl[q][None, :]) == same
                    allowed &= rid[p][:, None] != number[q][None, :]
                    a, w, b, s = fill_windows(x[p], xn[p], y[q], yn[q], ids[q], allowed, low[p], high[p], k, lowerings)
                    parts.append((rid[p][a], w, ids[q][b], s))
        cols = [np.concatenate([c[i] for c in parts]) if parts else np.zeros(0, np.int64) for i in range(4)]
        if cols[3].dtype == object:
            cols[3] = np.array([min(max(int(v), _SCORES[0]), _SCORES[1]) for v in cols[3]], np.int64)
        at = np.zeros(0, np.int64)
        if len(cols[0]):
            _, key = np.unique(np.stack([cols[0], cols[1]]), axis=1, return_inverse=True)
            at = _first(np.asarray(key).ravel(), cols[3], cols[2], k)
        out = pa.table([pa.array(cols[0][at], pa.int64()), pa.array(cols[1][at].astype(np.int32)),
                        pa.array(cols[2][at], pa.int64()), pa.array(cols[3][at].astype(np.int64))],
                       names=["rid", "w", "vec_id", "score"])
        release_memory()
        return out

    return run


def _search(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, order: list[int],
            same: bool, k: int, seed: bool) -> DataFrame:
    """First ``k`` rows of each window of ``anchors``; with ``seed`` in one block of rows only."""
    everyone = F.sequence(F.lit(0), F.lit(groups - 1))
    mine = F.filter(everyone, lambda g: F.pmod(g, F.lit(blocks)) == F.col("r")) if seed else everyone
    left = anchors.withColumn("r", F.explode(F.array(F.pmod(F.col("g"), F.lit(blocks))) if seed else
                                             F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = rows.withColumn("g", F.explode(mine))
    found = left.groupBy("g", "r").cogroup(right.groupBy("g", "r")).applyInArrow(
        _tile(order, same, k, LOWERINGS if seed else 0), _FIELDS)
    place = F.row_number().over(Window.partitionBy("rid", "w").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _both_passes(rows, anchors, blocks, groups, order, same, k, name) -> DataFrame:
    """The seed pass raises the floor of each window that it fills; the second pass covers all rows."""
    seeds = shared_table(_search(rows, anchors, blocks, groups, order, same, k, True), f"seed-{name}")
    raised = (seeds.where(F.col("rank") == k).groupBy("rid")
              .agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("floor")))
    own = F.transform("low", lambda v, i: F.greatest(v, F.coalesce(F.try_element_at("floor", i.cast("int")), v)))
    lifted = anchors.join(raised, "rid", "left").withColumn("low", own).drop("floor")
    return shared_table(_search(rows, lifted, blocks, groups, order, same, k, False), name)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null id, label or vector, or with a null or non-finite component
    (also one that overflows times 256), take no part. Vectors of different
    lengths are compared as if filled up with zeros, so an empty vector scores
    zero with all. Ties go to the smaller id; rows that repeat an id count one by
    one, as anchors, positives and negatives. Anchors without a positive, and
    positives without a fitting negative, give no row; an empty table gives an
    empty result. Scores beyond 2^62 are clipped to it. Other columns are not read.
    """
    spark = vectors.sparkSession
    src = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                         F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v * 256) == float("inf")))
    rows = (src.where("vec_id is not null and label is not null and vec is not null").where(~F.coalesce(bad, F.lit(True)))
            .withColumn("rid", F.monotonically_increasing_id()))
    rows = shared_table(rows, "vectors")
    anchors = shared_table(rows.where(F.col("vec_id") % anchor_every == 0), "anchors")
    n, queries = rows.count(), anchors.count()
    blocks, groups = max(1, -(-n // ROW_BLOCK)), max(1, -(-queries // ANCHOR_BLOCK))
    energy = rows.select(F.posexplode("vec")).groupBy("pos").agg(F.sum(F.pow(F.floor(F.col("col") * 256), 2.0)).alias("e"))
    order = [r.pos for r in energy.orderBy(F.desc("e"), "pos").collect()]
    # one row per dimension: bounded by the length of a vector
    dealt = rows.withColumn("r", F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int"))
    mark = F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(groups)).cast("int")
    base = anchors.withColumn("g", mark)
    every = base.withColumn("low", F.array(F.lit(_SCORES[0]))).withColumn("high", F.array(F.lit(_SCORES[1])))
    first = _both_passes(dealt, every, blocks, groups, order, True, positives, "positives")

    listed = (first.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
              .select("rid", F.transform("p", lambda p: p["score"]).alias("ps"), "p"))
    # 50 p <= 100 s <= 95 p in whole numbers, without overflow; a missing positive has an empty window
    def down(p, by: int):
        return F.call_function("div", p - F.pmod(p, F.lit(by)), F.lit(by).cast("bigint"))

    low = F.transform("ps", lambda p: down(p, 2) + F.pmod(p, F.lit(2)))
    high = F.transform("ps", lambda p: p - down(p, 20) - F.when(F.pmod(p, F.lit(20)) > 0, 1).otherwise(0))

    def padded(col, value: int):
        return F.slice(F.concat(col, F.array_repeat(F.lit(value), positives)), 1, positives)

    asked = base.join(listed, "rid").withColumn("low", padded(low, _SCORES[1])).withColumn("high", padded(high, _SCORES[0])).drop("ps", "p")
    second = _both_passes(dealt, asked, blocks, groups, order, False, negatives, "negatives")
    pos = first.select("rid", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (second.select("rid", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pos, ["rid", "w"]).join(base.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
