"""Fuzzy passages that repeat across documents, by collinear chaining (operator 9).

1. Copies of one text are one key; only one of them goes on.
2. Seeds: hashes of five words, thinned to window minimisers, so any run of
   ``SEED_WORDS + SEED_WINDOW - 1`` equal words has a seed in common.
3. A seed that one text alone holds is dropped, and so are seeds that do not
   stand dense enough to be part of a passage of ``MIN_WORDS`` words.
4. Candidate pairs: every holder of a seed is paired with the holder of the
   smallest and of the largest key. Both come from one aggregate, so a seed that
   a million texts hold makes two million rows and no more. Pairs with too few
   common seeds go.
5. Each pair is one row with the two word sequences around its seeds. The
   matches are chained in order, with a cost for the words skipped on either
   side, through a Fenwick tree of prefix maxima; chains are aligned word by word,
   and the longest parts that are, extended at both ends, long and equal enough
   are passages: a chain over two passages with other words between gives both.
6. A second round of 5 for seeds that still lie in no found passage and stand
   dense enough for one. Those that at most ``FEW_HOLDERS`` texts hold meet all of
   them, however little of a pair's passage they span. In the regions of the others
   all windows of ``MIN_WORDS`` words are grouped by hash, and every holder of a
   window has the passage with the smallest one, so exact passages need no pairing.
   For fuzzy ones these regions are seeded anew with hashes of ``LONG_WORDS`` words,
   which meet all holders if few hold them and are paired as in 4 otherwise.
7. What 4 to 6 leave out is the rest: texts of different classes with seeds in
   common, and seeds that still lie in no passage, meet every other holder of
   them around whose seed a passage can lie. Seeds of few holders need no more than
   to stand apart in both texts. Of the others either the words around a seed are
   alike, as in a passage with no word left out on one side alone, or two seeds
   stand in order, ``NEAR`` words apart at most but not equally far, and enough of
   the words around them are in the other text. Both are bounds on what alignment
   can find there, so a short line that many texts hold makes no pairs.
   Not met are texts of widely held seeds alone whose passage has over ``NEAR``
   words without a common seed where words are left out.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.llm.common import lean, shared_table, small_side
from arenaspark.llm.components import components
from arenaspark.llm.tokens import batches_of

SEED_WORDS, SEED_WINDOW = 5, 10
MIN_WORDS, MIN_IDENTITY = 50, 0.8
MAX_GAP = 30  # words between neighbouring seeds of one passage
MIN_SEED_SPAN = MIN_WORDS - 2 * SEED_WINDOW  # words from the first to the last seed of a passage
GAP_COST = 0.1  # per word skipped on either side
MARGIN = 80  # words taken along before the first and after the last common seed
FEW_HOLDERS = 32
MANY_SEEDS = 64  # seeds of a text up to which the last round joins texts by two of them
SALT_HOLDERS = 200  # holders of a key that meet the others in one part of the last round's join
CELL_HOLDERS = 1000  # holders of a key that meet as many others in one part of the join of surroundings
AROUND = 64  # words on either side of a seed that tell whether a passage can lie there
MOST_OTHER = 18  # of 30 words beside a seed that may differ in a passage: a fifth of up to 94
LEAST_SAME = round(MIN_WORDS * MIN_IDENTITY)  # equal words of a passage
SHIFT = 16  # words by which the surroundings compared are shorter than those they are looked up in
NEAR = 2 * MAX_GAP  # words between two seeds of a passage with words left out on one side
LONG_WORDS, LONG_WINDOW = 31, 20  # 31 + 20 - 1 = 50
MANY_MATCHES = 64  # pairs of one seed's places in two texts up to which all are taken
DROP = 8  # an end is extended until it has lost so much against its best
CACHE_WORDS = 150_000
_MARKS = ".,;:!?\"'()[]"


class _Places(dict):
    """Word -> its hash, computed at first sight."""

    def __missing__(self, word: str) -> int:
        value = self[word] = zlib.crc32((word.lower().strip(_MARKS) or word).encode("utf-8", "surrogatepass"))
        return value


class WordHasher:
    """32-bit hashes of the words of texts; case and outer marks do not count."""

    def __init__(self) -> None:
        self.places = _Places()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if len(self.places) > CACHE_WORDS:
            self.places = _Places()
        return np.fromiter(map(self.places.__getitem__, words), dtype=np.uint32, count=len(words))


def seeds(words: np.ndarray, length: int = SEED_WORDS, window: int = SEED_WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, run) of the minimisers; a run of equal neighbours (periodic text) is one seed."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.full(n, 17, dtype=np.uint64)
    words = words.astype(np.uint64)
    for j in range(length):
        h = (h ^ words[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    m = max(1, n - window + 1)
    w = n - m + 1
    least = _sliding(np.minimum, h, w)
    # a hash is picked if it is the least of a window that it lies in: the largest of their least ones
    around = np.zeros(m + 2 * (w - 1), dtype=np.uint64)
    around[w - 1:w - 1 + m] = least
    picked = _sliding(np.maximum, around, w) == h
    picked[1:] &= h[1:] != h[:-1]
    starts = np.flatnonzero(picked)
    # a run ends before the next other hash
    ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, n)
    runs = ends[np.searchsorted(ends, starts, side="right")] - starts
    return h[starts].view(np.int64), starts.astype(np.int64), runs


def _sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` of every ``width`` neighbours, from those of windows half as wide."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def dense(places: np.ndarray) -> np.ndarray:
    """Which of the ascending places stand in a cluster (gaps up to ``MAX_GAP``) wide enough for a passage."""
    if not len(places):
        return np.zeros(0, bool)
    group = np.cumsum(np.append(0, np.diff(places) > MAX_GAP))
    first = places[np.searchsorted(group, np.arange(group[-1] + 1))]
    last = places[np.searchsorted(group, np.arange(group[-1] + 1), side="right") - 1]
    return (last - first + SEED_WORDS >= MIN_SEED_SPAN)[group]


class PrefixMaxima:
    """Fenwick tree: best (value, index) among places below a bound."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)

    def put(self, place: int, value: float, index: int) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place][0]:
                self.best[place] = (value, index)
            place += place & -place

    def below(self, place: int) -> tuple[float, int]:
        out = (-1e18, -1)
        while place > 0:
            if self.best[place][0] > out[0]:
                out = self.best[place]
            place -= place & -place
        return out


def chains(matches: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Best local chains of matches (x, y, words), x and y strictly ascending, by falling score; each match in one at most.

    A chain scores its words less ``GAP_COST`` per word between its first starts and its last ones on either
    side, so the best predecessor of a match is a prefix maximum over y."""
    matches = sorted(matches)
    ys = sorted({y for _, y, _ in matches})
    score, back = [0.0] * len(matches), [-1] * len(matches)
    tree = PrefixMaxima(len(ys))
    i = 0
    while i < len(matches):
        j = i
        while j < len(matches) and matches[j][0] == matches[i][0]:  # equal x cannot follow one another
            x, y, w = matches[j]
            value, index = tree.below(bisect_left(ys, y))
            gain = value - GAP_COST * (x + y)
            score[j], back[j] = (w + gain, index) if gain > 0 else (float(w), -1)
            j += 1
        for k in range(i, j):
            x, y, _ = matches[k]
            tree.put(bisect_left(ys, y), score[k] + GAP_COST * (x + y), k)
        i = j
    out, used = [], [False] * len(matches)
    for k in sorted(range(len(matches)), key=lambda k: -score[k]):
        path = []
        while k >= 0 and not used[k]:
            used[k] = True
            path.append(matches[k])
            k = back[k]
        if path:
            out.append(path[::-1])
    return out


def _common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the best alignment of two gaps: place by place, or the longest common subsequence if lengths differ."""
    if len(a) == len(b):
        return int((a == b).sum())
    row = [0] * (len(b) + 1)
    bl = b.tolist()
    for x in a.tolist():
        diagonal = 0
        for j, y in enumerate(bl, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words taken, of them equal) of the best common beginning of a and b, mismatches counting twice."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    good = best = taken = equal = 0
    for lo in range(0, n, 32):
        for at, same in enumerate((a[lo:lo + 32] == b[lo:lo + 32]).tolist(), lo + 1):
            good += same
            value = good - 2 * (at - good)
            if value > best:
                best, taken, equal = value, at, good
            if value < best - DROP:
                return taken, equal
    return taken, equal


def _partners(left: list[int], right: list[int]) -> set[tuple[int, int]]:
    """Matches of one seed. All pairs while they are few; of a seed that both texts repeat often, the pairs in
    order from the front and from the back: they cover the repeated stretch, and where another pair would have
    helped a chain, the gap it leaves is aligned word by word."""
    if len(left) * len(right) <= MANY_MATCHES:
        return {(i, j) for i in left for j in right}
    return {*zip(left, right), *zip(left[::-1], right[::-1])}


def align(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Passages common to two word sequences: (start, end in a, start, end in b, equal words)."""
    ha, pa_, ra = seeds(a)
    hb, pb, rb = seeds(b)
    la, lb = ha.tolist(), hb.tolist()
    common = set(la).intersection(lb)
    at: dict[int, list[int]] = defaultdict(list)
    for j, h in enumerate(lb):
        if h in common:
            at[h].append(j)
    own: dict[int, list[int]] = defaultdict(list)
    for i, h in enumerate(la):
        if h in common:
            own[h].append(i)
    matches = [(int(pa_[i]), int(pb[j]), SEED_WORDS - 1 + int(min(ra[i], rb[j])))
               for h, left in own.items() for i, j in _partners(left, at[h])]
    found: list[tuple[int, int, int, int, int]] = []
    for chain in chains(matches):
        blocks: list[tuple[int, int, int, int]] = []  # x, y, words, equal words of the gap before it
        x1 = y1 = 0
        for x, y, w in chain:
            if blocks and (x < x1 or y < y1):  # overlaps the last match: only what is new counts
                cut = max(x1 - x, y1 - y)
                if cut >= w:
                    continue
                x, y, w = x + cut, y + cut, w - cut
            blocks.append((x, y, w, _common_words(a[x1:x], b[y1:y]) if blocks else 0))
            x1, y1 = x + w, y + w
        for x0, x1, y0, y1, equal in _best_parts(a, b, blocks):
            if not any(p <= x0 and x1 <= q and r <= y0 and y1 <= s for p, q, r, s, _ in found):
                found.append((x0, x1, y0, y1, equal))
    return found


def _best_parts(a: np.ndarray, b: np.ndarray, blocks: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Passages along a chain: the longest part that is long and equal enough, then the same before and after it.

    A part runs from one block to another and is extended at both ends, up to the neighbouring blocks."""
    n = len(blocks)
    (x0, y0, _, _), (x1, y1, w1, _) = blocks[0], blocks[-1]
    if min(x1 - x0, y1 - y0) + w1 < MIN_WORDS:  # all parts lie within the widest one
        beside = _extend(a[:x0][::-1], b[:y0][::-1])[0] + _extend(a[x1 + w1:], b[y1 + w1:])[0]
        if min(x1 - x0, y1 - y0) + w1 + beside < MIN_WORDS:
            return []
    x, y, w, gap = np.array(blocks, dtype=np.int64).T
    left, right = np.zeros((n, 2), np.int64), np.zeros((n, 2), np.int64)  # (words, equal words) of the extensions
    for i in range(n):
        px, py = (x[i - 1] + w[i - 1], y[i - 1] + w[i - 1]) if i else (0, 0)
        nx, ny = (x[i + 1], y[i + 1]) if i + 1 < n else (len(a), len(b))
        left[i] = _extend(a[px:x[i]][::-1], b[py:y[i]][::-1])
        right[i] = _extend(a[x[i] + w[i]:nx], b[y[i] + w[i]:ny])
    upto = np.cumsum(w + gap)  # equal words up to the end of each block, gaps included
    from_ = upto - w  # and up to its start
    ends = np.stack([x + w + right[:, 0], y + w + right[:, 0], upto + right[:, 1]])
    starts = np.stack([x - left[:, 0], y - left[:, 0], from_ - left[:, 1]])
    out, todo = [], [(0, n)]
    while todo:
        lo, hi = todo.pop()
        best, at = 0, None
        for i in range(lo, hi):
            if min(ends[0, hi - 1] - starts[0, i], ends[1, hi - 1] - starts[1, i]) < max(MIN_WORDS, best + 1):
                break  # later starts leave even less
            la, lb, equal = ends[:, i:hi] - starts[:, i, None]
            short, long = np.minimum(la, lb), np.maximum(la, lb)
            good = np.flatnonzero((short >= MIN_WORDS) & (equal >= MIN_IDENTITY * long) & (short > best))
            if len(good):
                j = good[np.argmax(short[good])]
                best, at = int(short[j]), (i, i + int(j))
        if at is not None:
            i, j = at
            out.append((int(starts[0, i]), int(ends[0, j]), int(starts[1, i]), int(ends[1, j]), int(ends[2, j] - starts[2, i])))
            todo += [(lo, i), (j + 1, hi)]
    return out


# ------------------------------------------------------------------ on Spark
def _texts_by_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(members: id, key; copies: key, first id, number of ids). A key is 64 bits of the text's digest."""
    digest = F.conv(F.substring(F.md5(F.col(text_col)), 1, 15), 16, 10).cast("long")
    members = shared_table(docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), digest.alias("key")),
                           "members")
    return members, members.groupBy("key").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))


def _seed_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, seed, place) of every text; texts shorter than a passage have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for part in batches_of(texts):
                hs, ps, ks = [], [], []
                for key, text in zip(keys[part], texts[part]):
                    words = hasher(text)
                    if len(words) >= MIN_WORDS:
                        h, p, _ = seeds(words)
                        hs.append(h)
                        ps.append(p)
                        ks.append(np.full(len(h), key, dtype=np.int64))
                if hs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(ks)), pa.array(np.concatenate(hs)),
                         pa.array(np.concatenate(ps).astype(np.int32))], names=["key", "seed", "place"])

    return docs.select("key", F.col(text_col).alias("text")).mapInArrow(lean(run), "key bigint, seed bigint, place int")


def _dense_seeds(rows: DataFrame) -> DataFrame:
    """Rows (key, seed, place) that stand dense; one text's seeds are one row while that is decided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ks, ss, ps = [], [], []
            for key, places, own in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                p, s = np.asarray(places.values), np.asarray(own.values)
                if len(p) < 2:
                    continue  # no cluster
                order = np.argsort(p, kind="stable")
                keep = order[dense(p[order])]
                if len(keep):
                    ks.append(np.full(len(keep), key, np.int64))
                    ss.append(s[keep])
                    ps.append(p[keep])
            if ks:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (ks, ss, ps)], names=["key", "seed", "place"])

    grouped = rows.groupBy("key").agg(F.collect_list(F.struct("place", "seed")).alias("x"))
    return grouped.select("key", "x.place", "x.seed").mapInArrow(lean(run), "key bigint, seed bigint, place int")


def _word_table(docs: DataFrame, keys: DataFrame, text_col: str) -> DataFrame:
    """(key, words): word hashes of the texts with the given keys, one row per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([hasher(t).astype("<u4").tobytes() for t in part.column(1).to_pylist()], pa.binary())],
                    names=["key", "words"])

    own = docs.join(small_side(keys, 1_000_000), "key", "left_semi")
    return own.select("key", F.col(text_col).alias("text")).mapInArrow(lean(run), "key bigint, words binary")


def _long_seeds(rest: DataFrame, words: DataFrame, length: int = LONG_WORDS, window: int = LONG_WINDOW) -> DataFrame:
    """(key, seed, place) of the seeds of ``length`` words around the given seeds; a ``window`` of 1 takes every place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, places, raw in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                own, at = np.frombuffer(raw, "<u4"), np.sort(np.asarray(places.values))
                cut = np.flatnonzero(np.diff(at) > MAX_GAP) + 1
                for part in np.split(at, cut):
                    lo = max(0, int(part[0]) - MIN_WORDS)
                    h, p, _ = seeds(own[lo:int(part[-1]) + SEED_WORDS + MIN_WORDS], length, window)
                    # a seed must touch the region; those beside it are other text
                    near = (p + lo + length > part[0]) & (p + lo < part[-1] + SEED_WORDS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(int(near.sum()), key, np.int64)), pa.array(h[near]),
                         pa.array((p[near] + lo).astype(np.int32))], names=["key", "seed", "place"])

    regions = rest.groupBy("key").agg(F.collect_list("place").alias("places")).join(words, "key")
    return regions.select("key", "places", "words").mapInArrow(lean(run), "key bigint, seed bigint, place int").distinct()


def _end_holders(own: DataFrame) -> DataFrame:
    """The rows of ``own`` that the smallest and the largest key of their seed hold."""
    ends = own.groupBy("seed").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi")
    return own.join(ends.select("seed", F.explode(F.array("lo", "hi")).alias("key")), ["seed", "key"], "left_semi")


def _few_holders(own: DataFrame) -> DataFrame:
    """The seeds of ``own`` that at most ``FEW_HOLDERS`` texts hold."""
    return own.groupBy("seed").agg(F.countDistinct("key").alias("holders")).where(F.col("holders") <= FEW_HOLDERS).select("seed")


def _same_windows(windows: DataFrame) -> DataFrame:
    """Passages of every holder of a window of ``MIN_WORDS`` words with the smallest one."""
    first = windows.groupBy("seed").agg(F.min(F.struct("key", "place")).alias("first"), F.max("key").alias("hi")).where("first.key < hi")
    return windows.join(first, "seed").where("key > first.key").select(
        F.col("first.key").alias("a"), F.col("key").alias("b"), F.col("first.place").cast("long").alias("a_start"),
        (F.col("first.place") + MIN_WORDS).cast("long").alias("a_end"), F.col("place").cast("long").alias("b_start"),
        (F.col("place") + MIN_WORDS).cast("long").alias("b_end"), F.lit(MIN_WORDS).cast("long").alias("equal"))


def _wider(more: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs of ``more`` that are not among ``known`` or reach beyond the places they were aligned over."""
    old = known.select("a", "b", *[F.col(c).alias(f"{c}_old") for c in ("a0", "a1", "b0", "b1")])
    return (more.join(old, ["a", "b"], "left")
            .where("a0_old is null or a0 < a0_old or a1 > a1_old or b0 < b0_old or b1 > b1_old")
            .select("a", "b", *[F.expr(f"coalesce({f}({c}, {c}_old), {c})").alias(c) for c, f in
                                (("a0", "least"), ("a1", "greatest"), ("b0", "least"), ("b1", "greatest"))]))


def _edges(rows: DataFrame, key: str) -> DataFrame:
    """(seed, text, first and last place of the seed in it)."""
    return rows.groupBy("seed", F.col("key").alias(key)).agg(F.min("place").alias(f"{key}0"), F.max("place").alias(f"{key}1"))


def _spanned(both: DataFrame, seed_words: int, least: int) -> DataFrame:
    """Pairs with ``least`` words spanned by their common seeds, one row of ``both`` each, and the places spanned on both sides."""
    swap = F.col("a") > F.col("b")
    both = both.where("a <> b").select(*[F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in
                                         (("a", "b"), ("b", "a"), ("a0", "b0"), ("a1", "b1"), ("b0", "a0"), ("b1", "a1"))])
    return (both.groupBy("a", "b").agg(F.min("a0").alias("a0"), F.max("a1").alias("a1"),
                                       F.min("b0").alias("b0"), F.max("b1").alias("b1"))
            .where(f"a1 - a0 + {seed_words} >= {least} and b1 - b0 + {seed_words} >= {least}")
            .select("a", "b", "a0", "a1", "b0", "b1"))


def _pair_rows(left: DataFrame, right: DataFrame, seed_words: int = SEED_WORDS, least: int = MIN_SEED_SPAN // 2) -> DataFrame:
    """Pairs of two seed tables with ``least`` words spanned by common seeds, and the places these span on both sides.

    Only the first and last place of a seed in a text count, so a text that repeats a seed is one row of it."""
    return _spanned(_edges(left, "a").join(_edges(right, "b"), "seed"), seed_words, least)


def _rest_rows(own: DataFrame, rest: DataFrame, root: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs of texts of different classes (``root``: key, class; others are a class by themselves), and of the texts of the
    seed rows ``rest`` with all others, over common seeds of ``own``.

    Only the pairs of ``_far_pairs`` over seeds of few holders, of ``_same_surroundings`` and of ``_shifted_pairs`` are
    compared, over all their common seeds."""
    held = own.select("seed", F.col("key").alias("a"), "place").join(
        root.select(F.col("key").alias("a"), "class"), "a", "left").withColumn("class", F.coalesce("class", "a"))
    held = held.join(rest.select("seed", F.col("key").alias("a"), F.lit(True).alias("open")).distinct(), ["seed", "a"], "left")
    held = shared_table(held.withColumn("open", F.coalesce("open", F.lit(False))), "held-seeds")
    held = shared_table(held.join(_largest_class(held, "seed").select("seed"), "seed", "left_semi"), "rest-seeds")
    edges = held.groupBy("seed", "a", "class", "open").agg(F.min("place").alias("a0"), F.max("place").alias("a1"))
    few = edges.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") <= FEW_HOLDERS).select("seed")
    pairs = (_far_pairs(edges.join(few, "seed", "left_semi"), MIN_SEED_SPAN // 2 - SEED_WORDS)
             .union(_same_surroundings(held, words)).union(_shifted_pairs(held, words)).distinct())
    pairs = shared_table(pairs, "rest-candidates")
    other = edges.select("seed", *[F.col(f"a{x}").alias(f"b{x}") for x in ("", "0", "1")],
                         F.col("class").alias("b_class"), F.col("open").alias("b_open"))
    both = pairs.join(edges, "a").join(other, ["b", "seed"]).where("class <> b_class or open or b_open")
    return _spanned(both, SEED_WORDS, SEED_WORDS)


def _largest_class(rows: DataFrame, key: str, needed: str = "true", holders: int = SALT_HOLDERS) -> DataFrame:
    """(key, top, parts) of the keys that make pairs: their largest class, and a part for each ``holders`` holders.

    ``needed`` must hold for one of a key's rows."""
    return (rows.groupBy(key, "class").agg(F.count("*").alias("n"), F.max("open").alias("open"), F.max(F.expr(needed)).alias("needed"))
            .groupBy(key).agg(F.max(F.struct("n", "class")).alias("top"), F.sum("n").alias("n"), F.max("open").alias("any_open"),
                              F.max("needed").alias("needed"))
            .where("needed and (n > top.n or (any_open and n > 1))")
            .select(key, F.col("top.class").alias("top"), F.floor(F.col("n") / holders + 1).alias("parts")))


def _met(rows: DataFrame, key: str, more: list[str], of_b: dict) -> DataFrame:
    """Rows of a key beside one another, those of different classes or open ones; the second's columns ``more`` are ``b_..``,
    as ``of_b`` says. The holders of a key are dealt over cells of ``CELL_HOLDERS`` by ``CELL_HOLDERS``."""
    rows = rows.join(_largest_class(rows, key, holders=CELL_HOLDERS), key).withColumns(
        {"outside": F.expr("class <> top or open"), "own": F.pmod(F.xxhash64("a"), "parts"),
         "each": F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))})
    left = rows.where("outside").select(key, "a", "class", "open", *more, F.col("own").alias("x"), F.col("each").alias("y"))
    right = rows.select(key, F.col("a").alias("b"), F.col("class").alias("b_class"), F.col("outside").alias("b_outside"),
                        *[of_b.get(c, F.col(c)).alias(f"b_{c}") for c in more], F.col("each").alias("x"), F.col("own").alias("y"))
    # few small rows make many pairs: a fixed number of parts, which are not merged by their size before the join
    n = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (left.repartition(n, key, "x", "y").hint("merge").join(right.repartition(n, key, "x", "y"), [key, "x", "y"])
            .where("a <> b and (a < b or not b_outside) and (class <> b_class or open)"))


def _surroundings(held: DataFrame, words: DataFrame) -> DataFrame:
    """(seed, a, class, open, left0.., right0.., n_left, n_right): the ``AROUND`` words on either side of every seed, nearest
    first, four bits of each word (not zero; zero: no word), and how many there are."""
    names = [f"{side}{k}" for side in ("left", "right") for k in range(AROUND // 16)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for a, group, seeds_, places, opens, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *b.columns[2:5],
                                                            b.column(5).to_pylist()):
                own, at = np.frombuffer(raw, "<u4"), np.asarray(places.values)
                counts = np.stack([np.minimum(at, AROUND), np.minimum(len(own) - at - SEED_WORDS, AROUND)], axis=1)
                rows = np.concatenate([np.asarray(seeds_.values)[:, None], np.asarray(opens.values)[:, None],
                                       surrounding_codes(own, at).view(np.int64), counts], axis=1)
                rows = np.unique(rows, axis=0)  # a line that a text repeats is one row while its surroundings are the same
                out.append(np.concatenate([np.full((len(rows), 2), (a, group)), rows], axis=1))
            if out:
                a, group, seed, free, *rest = np.concatenate(out).T.copy()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (seed, a, group, free != 0, *rest)],
                                                 names=["seed", "a", "class", "open", *names, "n_left", "n_right"])

    return _by_text(held, words).mapInArrow(
        lean(run), "seed bigint, a bigint, class bigint, open boolean, " + ", ".join(f"{n} bigint" for n in [*names, "n_left", "n_right"]))


def surrounding_codes(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Four bits for each of the ``AROUND`` words before (nearest first) and after the seeds at ``places``, 16 words a number.

    They depend on the word and on how far off it is, so two runs of one word each differ in most places."""
    steps = np.arange(AROUND)
    at = np.concatenate([places[:, None] - 1 - steps, places[:, None] + SEED_WORDS + steps], axis=1)
    there = (at >= 0) & (at < len(words))
    h = (words.astype(np.uint64)[np.where(there, at, 0)] + (np.arange(2 * AROUND, dtype=np.uint64) << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = np.where(there, (h >> np.uint64(40)) % np.uint64(14) + np.uint64(2), np.uint64(0))
    return np.bitwise_or.reduce(bits.reshape(len(places), -1, 16) << np.arange(0, 64, 4, dtype=np.uint64), axis=2)


def can_span(same: np.ndarray, first: int, last: np.ndarray | int) -> np.ndarray:
    """For each row of ``same``, whether a passage can lie there that holds the words ``first`` to ``last``: at least ``MIN_WORDS``
    words from one on, ``MIN_IDENTITY`` of them same.

    A passage begins and ends with three equal words, for an extension gains at each of its ends. What reaches an end
    of the row may go on there, so less of it need be same."""
    m = np.ascontiguousarray(same.T)  # a word of all rows after the other
    width, n = m.shape
    three = m[2:] & m[1:-1] & m[:-2]
    least, found = np.empty((first + 1, n), np.int16), np.zeros(n, bool)
    for gain, loss, inside in ((10 - round(10 * MIN_IDENTITY), round(10 * MIN_IDENTITY), True), (3, 7, False)):
        step = np.where(m, np.int16(gain), np.int16(-loss))
        upto = np.zeros((width + 1, n), np.int16)
        for j in range(width):
            np.add(upto[j], step[j], out=upto[j + 1])
        starts = np.where(three[:first + 1], upto[:first + 1], np.int16(1 << 14))
        least[0] = starts[0]
        for j in range(first):
            np.minimum(least[j], starts[j + 1], out=least[j + 1])
        for j in range(max(MIN_WORDS, first + SEED_WORDS), width + 1):  # it ends before word j
            found |= three[j - 3] & (j > last) & (upto[j] >= (least[min(first, j - MIN_WORDS)] if inside else 0))
        if not inside:
            found |= upto[width] >= np.minimum(least[min(first, width - MIN_WORDS)], 0)
    return found


def diagonal_passage(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each two seeds' surroundings (``surrounding_codes``, two times n rows) whether a passage over the seed with no word
    left out on one side alone can be there."""
    z = (left ^ right).astype("<u8").view(np.uint8)  # two words a byte
    same = np.stack([(z & 15) == 0, z < 16], axis=2).reshape(len(z), 2, AROUND)
    return can_span(np.concatenate([same[:, 0, ::-1], np.ones((len(z), SEED_WORDS), bool), same[:, 1]], axis=1),
                    AROUND, AROUND + SEED_WORDS - 1)


def shifted_passage(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """For each row of ``near_codes`` of two texts whether a passage over a seed and the one ``apart`` words behind it in ``a`` can be
    there: enough words of ``a`` stand anywhere around the seeds in ``b``."""
    held = np.zeros((len(a), 256), bool)
    np.put_along_axis(held, b.astype(np.int64), True, axis=1)
    held[:, 0] = False  # no word
    same = np.take_along_axis(held, a[:, SHIFT:-SHIFT].astype(np.int64), axis=1)
    return can_span(same, AROUND - SHIFT, AROUND - SHIFT + apart + SEED_WORDS - 1)


def near_codes(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A byte for each word from ``AROUND`` before to twice as many behind the seeds at ``places``; zero: no word."""
    at = places[:, None] + np.arange(-AROUND, 2 * AROUND)
    there = (at >= 0) & (at < len(words))
    h = (words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return np.where(there, (h % np.uint64(255) + np.uint64(1))[np.where(there, at, 0)], np.uint64(0)).astype(np.uint8)


def _same_surroundings(held: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b), a < b: the texts with a seed in common around which a passage can lie that leaves no word out on one side alone.

    Of the 30 words after, before or around (15 and 15) the seeds at most ``MOST_OTHER`` may differ, and of all that is known
    ``LEAST_SAME`` must be equal, which the join tells from the bits of ``_surroundings``; what it lets through is looked at
    word by word in ``diagonal_passage``."""
    # numbers that cannot be null: the join's condition is then small enough to be compiled
    rows = shared_table(_surroundings(held, words), "seed-surroundings").na.fill(0)
    codes = [f"{side}{k}" for side in ("left", "right") for k in range(AROUND // 16)]
    ones = 0x1111111111111111

    def marked(c: str):  # a word that is not there is unlike any, and unlike none
        n = F.col(f"n_{c[:-1]}") - 16 * int(c[-1])
        return F.when(n >= 16, F.col(c)).when(n <= 0, F.lit(ones)).otherwise(
            F.col(c).bitwiseOR(F.expr(f"shiftleft({ones}L, cast(4 * (n_{c[:-1]} - {16 * int(c[-1])}) as int))")))

    met = _met(rows, "seed", codes, {c: marked(c) for c in codes})

    def other(c: str, n: int) -> str:  # differing words among the first n of the 16
        z = f"({c} ^ b_{c})"
        z = f"({z} | shiftrightunsigned({z}, 2))"
        return f"bit_count(({z} | shiftrightunsigned({z}, 1)) & {ones & ((1 << 4 * n) - 1)}L)"

    def side(s: str) -> str:
        return f"{other(s + '0', 16)} + {other(s + '1', 14)}"

    met = met.where(f"({side('right')} <= {MOST_OTHER} or {side('left')} <= {MOST_OTHER} or "
                    f"{other('left0', 15)} + {other('right0', 15)} <= {MOST_OTHER}) and "
                    f"{' + '.join(other(c, 16) for c in codes)} <= {2 * AROUND + SEED_WORDS - LEAST_SAME}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c, *bits = [np.asarray(x) for x in b.columns]
            bits = np.stack(bits, axis=1).view(np.uint64)
            keep = diagonal_passage(bits[:, :len(codes)], bits[:, len(codes):])
            yield _two(a[keep], c[keep])

    return met.select("a", "b", *codes, *[f"b_{c}" for c in codes]).mapInArrow(lean(run), "a bigint, b bigint").distinct()


def _shifted_pairs(held: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b), a < b: the texts with two seeds in common that stand in the same order up to ``NEAR`` words apart in both, but
    not equally far, if a passage can lie there by ``shifted_passage``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, codes = [], []
            for a, group, seeds_, places, opens, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *b.columns[2:5],
                                                            b.column(5).to_pylist()):
                at, words_ = np.asarray(places.values), np.frombuffer(raw, "<u4")
                order = np.argsort(at, kind="stable")
                at, own, free = at[order], np.asarray(seeds_.values)[order], np.asarray(opens.values)[order]
                ends = np.searchsorted(at, at + NEAR, side="right")
                for k in range(1, int((ends - np.arange(len(at))).max())):
                    near = np.flatnonzero((at[k:] > at[:-k]) & (at[k:] - at[:-k] <= NEAR))
                    if len(near):
                        two = own[near] * np.int64(-7046029254386353131) ^ own[near + k]
                        out.append(np.stack([two, np.full(len(near), a), np.full(len(near), group), free[near] | free[near + k],
                                             at[near + k] - at[near]], axis=1))
                        codes += map(bytes, near_codes(words_, at[near]))
            if out:
                key, a, group, free, apart = np.concatenate(out).T.copy()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (key, a, group, free != 0, apart)] + [pa.array(codes, pa.binary())],
                                                 names=["key", "a", "class", "open", "apart", "codes"])

    rows = _by_text(held, words).mapInArrow(
        lean(run), "key bigint, a bigint, class bigint, open boolean, apart bigint, codes binary")
    rows = shared_table(rows.distinct(), "near-seeds")
    # of a key that all hold equally far apart nobody is shifted
    uneven = rows.groupBy("key").agg(F.min("apart").alias("lo"), F.max("apart").alias("hi")).where("lo < hi").select("key")
    met = _met(rows.join(uneven, "key", "left_semi"), "key", ["apart", "codes"], {}).where("apart <> b_apart")

    def fits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in b.columns[2:4])
            keep = shifted_passage(one, two, np.asarray(b.column(4)))
            keep[keep] &= shifted_passage(two[keep], one[keep], np.asarray(b.column(5))[keep])
            yield _two(np.asarray(b.column(0))[keep], np.asarray(b.column(1))[keep])

    return met.select("a", "b", "codes", "b_codes", "apart", "b_apart").mapInArrow(lean(fits), "a bigint, b bigint").distinct()


def _two(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Pairs of texts, the smaller key first, each once."""
    two = np.unique(np.sort(np.stack([a, b], axis=1), axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy())], names=["a", "b"])


def _by_text(held: DataFrame, words: DataFrame) -> DataFrame:
    """(a, class, seed, place, open, words): one row for each text, its seeds as arrays, ``open`` as numbers."""
    rows = held.groupBy("a", "class").agg(F.collect_list(F.struct("seed", "place", F.col("open").cast("long").alias("open"))).alias("x"))
    return rows.join(words.withColumnRenamed("key", "a"), "a").select("a", "class", "x.seed", "x.place", "x.open", "words")


def _far_pairs(held: DataFrame, far: int) -> DataFrame:
    """(a, b), a < b: all texts that can have seeds in common that start ``far`` words apart.

    Such texts have two seeds in common that stand so far apart in one of them, or one that both repeat so far apart;
    so the key of a row is two seeds of a text, not one, and of two rows of a key one must be far. Texts
    that share a short line alone do not meet. A text of more than ``MANY_SEEDS`` seeds meets all holders of each of them
    instead. Of two texts of different classes one at least is outside the key's largest class, so the left side leaves
    that class out. The left holders of a key are dealt over parts of about ``SALT_HOLDERS``, each beside all holders."""
    own = held.groupBy("a", "class").agg(F.sort_array(F.collect_list(F.struct("seed", "a0", "a1", "open"))).alias("x"))

    def two(s, i):
        return F.transform(F.slice("x", i + 1, F.size("x") - i), lambda t: F.struct(
            F.xxhash64(s["seed"], t["seed"]).alias("key"), (s["seed"] == t["seed"]).alias("same"),
            (F.greatest(s["a1"], t["a1"]) - F.least(s["a0"], t["a0"]) >= far).alias("far"), (s["open"] | t["open"]).alias("open")))

    twos = own.where(F.size("x") <= MANY_SEEDS).select("a", "class", F.inline(F.flatten(F.transform("x", two))))
    ones = own.select("a", "class", (F.size("x") > MANY_SEEDS).alias("far"), F.explode("x").alias("s"))
    rows = (twos.where("far or not same").select("key", "a", "class", "far", "open")
            .union(ones.select("s.seed", "a", "class", "far", "s.open")))
    rows = shared_table(rows, "seed-pairs")
    rows = shared_table(rows.join(_largest_class(rows, "key", "far"), "key"), "far-pairs")
    left = rows.where("class <> top or open").withColumn("part", F.pmod(F.xxhash64("a"), "parts")).drop("top", "parts")
    right = rows.select("key", F.col("a").alias("b"), F.col("class").alias("b_class"), F.col("far").alias("b_far"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    # few small rows make many pairs: a fixed number of parts, which are not merged by their size before the join
    n = max(held.sparkSession.sparkContext.defaultParallelism, int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = [x.repartition(n, "key", "part").join(y.repartition(n, "key", "part"), ["key", "part"])
           .where("a <> b and (class <> b_class or open)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
           for x, y in ((left.where("far"), right), (left.where("not far"), right.where("b_far")))]
    return met[0].union(met[1]).distinct()


def _passages(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b, a_start, a_end, b_start, b_end, equal) of the passages of each pair."""

    def side(key: str, lo: str, hi: str) -> DataFrame:
        start = F.greatest(F.col(lo) - MARGIN, F.lit(0))
        cut = F.substring("words", 1 + 4 * start, 4 * (F.col(hi) + SEED_WORDS + MARGIN - start))
        return pairs_now.join(words.withColumnRenamed("key", key), key).withColumns({f"{key}_words": cut, f"{key}_at": start}).drop("words")

    pairs_now = pairs
    pairs_now = side("a", "a0", "a1")
    pairs_now = side("b", "b0", "b1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, at_a, at_b, wa, wb in zip(*(c.to_pylist() for c in batch.columns)):
                for x0, x1, y0, y1, equal in align(np.frombuffer(wa, "<u4"), np.frombuffer(wb, "<u4")):
                    rows.append((a, b, at_a + x0, at_a + x1, at_b + y0, at_b + y1, equal))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["a", "b", "a_start", "a_end", "b_start", "b_end", "equal"])

    return pairs_now.select("a", "b", "a_at", "b_at", "a_words", "b_words").mapInArrow(
        lean(run), "a bigint, b bigint, a_start bigint, a_end bigint, b_start bigint, b_end bigint, equal bigint")


def _spans(passages: DataFrame) -> DataFrame:
    return (passages.select(F.col("a").alias("key"), F.col("a_start").alias("start"), F.col("a_end").alias("end"))
            .union(passages.select("b", "b_start", "b_end")).distinct())


def _uncovered(own: DataFrame, spans: DataFrame) -> DataFrame:
    """Seed rows in no span of their text; a text's spans are one array beside its seeds."""
    merged = spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    inside = F.exists(F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")),
                      lambda s: (F.col("place") >= s["start"]) & (F.col("place") + SEED_WORDS <= s["end"]))
    return own.join(merged, "key", "left").where(~inside).select("key", "seed", "place")


def shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, copies, passages, classes): ids and keys, texts by key, the passages between texts of different keys, and
    the class of every key with a passage. The passages connect every class, but not each two of its texts by themselves."""
    members, copies = _texts_by_key(docs, id_col, text_col)
    copies = shared_table(copies, "copies")
    # one text per key: that of the smallest id; of repeated rows of that id any, they are equal
    digest = F.conv(F.substring(F.md5(F.col(text_col)), 1, 15), 16, 10).cast("long")
    again = shared_table(members.join(copies.where("n > 1").select("key", "first_id"), "key")
                         .where("not id <=> first_id").select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct(),
                         "further-copies")
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__doc"), F.col(text_col), digest.alias("key"))
    texts = texts.join(small_side(again, 1_000_000), F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")),
                       "left_anti").select("key", text_col)
    every = shared_table(_seed_rows(texts, text_col), "seeds")
    ends = every.groupBy("seed").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi")
    held = every.join(ends.select("seed"), "seed", "left_semi")
    own = shared_table(_dense_seeds(held.distinct()), "dense-seeds")
    pairs = shared_table(_pair_rows(own, _end_holders(own)), "passage-pairs")
    words = shared_table(_word_table(texts, own.select("key").distinct(), text_col).dropDuplicates(["key"]), "passage-words")
    found = shared_table(_passages(pairs, words), "passages")
    rest = shared_table(_dense_seeds(_uncovered(own, _spans(found))), "uncovered-seeds")
    few = shared_table(_few_holders(own), "few-holders")
    wide = shared_table(rest.join(few, "seed", "left_anti"), "wide-seeds")
    same = _same_windows(shared_table(_long_seeds(wide, words, MIN_WORDS, 1), "windows"))
    long = shared_table(_long_seeds(wide, words), "long-seeds")
    few_long = long.join(_few_holders(long), "seed", "left_semi")
    more = (_pair_rows(rest.join(few, "seed", "left_semi"), own, least=SEED_WORDS)
            .unionByName(_pair_rows(few_long, few_long, LONG_WORDS))
            .unionByName(_pair_rows(long, _end_holders(long), LONG_WORDS))
            .groupBy("a", "b").agg(F.min("a0").alias("a0"), F.max("a1").alias("a1"), F.min("b0").alias("b0"), F.max("b1").alias("b1")))
    more = shared_table(_wider(more, pairs), "more-pairs")
    found = shared_table(found.unionByName(shared_table(_passages(more, words), "more-passages")).unionByName(same), "paired-passages")
    root = shared_table(components(found.select("a", "b")).select(F.col("node").alias("key"), F.col("root").alias("class")), "classes")
    done = (pairs.unionByName(more).groupBy("a", "b").agg(F.min("a0").alias("a0"), F.max("a1").alias("a1"),
                                                          F.min("b0").alias("b0"), F.max("b1").alias("b1")))
    left_out = _rest_rows(own, _uncovered(rest, _spans(found)), root, words)
    last = shared_table(_passages(shared_table(_wider(left_out, done), "rest-pairs"), words), "rest-passages")
    return members, copies, found.unionByName(last), _joined_classes(root, last)


def _joined_classes(root: DataFrame, last: DataFrame) -> DataFrame:
    """The classes ``root`` (key, class) after the passages ``last`` join some of them."""
    def of(key: str) -> DataFrame:
        return root.select(F.col("key").alias(key), F.col("class").alias(f"{key}_class"))

    links = last.select("a", "b").distinct().join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        "a", "b", F.coalesce("a_class", "a").alias("a_class"), F.coalesce("b_class", "b").alias("b_class"))
    links = shared_table(links, "class-links")
    every = root.unionByName(links.select(F.col("a").alias("key"), F.col("a_class").alias("class")))
    every = every.unionByName(links.select(F.col("b").alias("key"), F.col("b_class").alias("class"))).distinct()
    again = components(links.where("a_class <> b_class").select(F.col("a_class").alias("a"), F.col("b_class").alias("b")))
    return shared_table(every.join(again.select(F.col("node").alias("class"), "root"), "class", "left")
                        .select("key", F.coalesce("root", "class").alias("root")), "joined-classes")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with a passage of at least 50 words that another document has too.

    Columns: id, class_id (smallest id reachable over common passages or equal texts), n_links (other texts it is
    linked with, directly or over others: those of its class, plus further copies of the own text), n_copies, spans
    (``start:end`` in words, merged, comma-joined; the whole text when there are only copies). Words are compared
    without case and outer marks, a passage may differ in up to a fifth of them. Null and empty texts and texts of fewer than 50 words have no row;
    repeated rows count as copies and give repeated rows; an empty table gives an empty result; other columns are
    not read."""
    members, copies, found, root = shared_passages(docs, id_col, text_col)
    found = shared_table(found, "all-passages")
    sizes = root.groupBy("root").agg((F.count("*") - 1).alias("links"))
    links = root.join(sizes, "root")
    # overlapping spans of a text become one
    spans = _spans(found).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("s"))
    joined = F.aggregate(
        "s", F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]), F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1),
            F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                             F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))
    spans = spans.select("key", F.array_join(F.transform(joined, lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"))
    long_copies = _long_copies(docs, copies, text_col)
    texts = (copies.join(links, "key", "left").join(long_copies, "key", "left").where("links is not null or n_words is not null")
             .join(spans, "key", "left").withColumn("root", F.coalesce("root", "key")))
    named = texts.groupBy("root").agg(F.min("first_id").alias("class_id"))
    texts = texts.join(named, "root").select(
        "key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.col("n").alias("n_copies"),
        F.coalesce("spans", F.concat(F.lit("0:"), F.col("n_words"))).alias("spans"))
    return members.join(texts, "key").select(F.col("id").alias(id_col), "class_id", "n_links", "n_copies", "spans")


def _long_copies(docs: DataFrame, copies: DataFrame, text_col: str) -> DataFrame:
    """(key, n_words) of the texts with copies that are long enough to be a passage."""
    digest = F.conv(F.substring(F.md5(F.col(text_col)), 1, 15), 16, 10).cast("long")
    words = F.size(F.filter(F.split(F.trim(F.col(text_col)), r"(?U)\s+"), lambda w: w != ""))
    own = docs.select(digest.alias("key"), F.col(text_col)).join(
        small_side(shared_table(copies.where("n > 1").select("key"), "copied"), 1_000_000), "key", "left_semi")
    return own.groupBy("key").agg(F.max(words).alias("n_words")).where(F.col("n_words") >= MIN_WORDS)
