"""N-gram Jaccard join by multiple-global-order filtering (operator 11).

A document's set holds its distinct word shingles, as 64-bit hashes. Two sets
link when 100 * intersection >= percent * union. What a linked pair must have
in common under *any* total order of the tokens: with |a| <= |b|, the first
|a| - ceil(2p|a| / (100+p)) + 1 tokens of a (its index prefix) and the first
|b| - ceil(p|b| / 100) + 1 tokens of b (its probe prefix) share a token. Three
orders are used, and a candidate must pass all of them before it is verified:

* H: ascending hash. A whole-corpus screen: prefixes that are l tokens longer share l
  tokens more, so of the first |x| - ceil(p|x|/100) + ceil(|x|/20) tokens of x at least
  ceil(ceil(p|x|/100)/20), what its smallest partner grants, lead another set, too. Only
  those leading tokens are ever shuffled for all documents.
* R1: rarest first among the sets left, ties by hash. Candidates come from an
  equality join on prefix tokens of this order, with length, rare-token and
  position bounds in the join.
* R2: rarest first, ties by another hash.

Groups of near copies are not expanded into pairs. First each set meets only
the hub of each of its tokens; what these star rounds link becomes one
component. Then, without exception, sets of different components that share a
token meet, where one side is always outside the token's largest component.
Equal sets are one node from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.llm.common import lean, shared_table, small_side
from arenaspark.llm.components import components

SHINGLE_WORDS, PERCENT = 5, 80
SIGNATURE_WORDS = 4   # 64-bit words of the parity signature that bounds the difference of two sets
SCREEN_PART = 20      # the screen asks for one in SCREEN_PART tokens (at least one) beyond what a partner may lack
STAR_ROUNDS = 3       # star rounds at most; the exhaustive step after them makes the links whole
WORD_CACHE = 500_000  # word hashes kept per task; restarted when full
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = [int(xxhash.xxh64_intdigest(b"place %d" % i, 11)) | 1 for i in range(64)]


class _Words(dict):
    """Word -> 64-bit hash, computed at first sight."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 5)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, shingle: int = SHINGLE_WORDS, words: dict | None = None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text; none for a null or wordless one.

    ASCII letters are lower-cased, words split at ASCII white space; a text of
    fewer words than a shingle is one shingle."""
    split = (text or b"").translate(_LOWER).split()
    if not split:
        return np.empty(0, np.int64)
    table = _Words() if words is None else words
    w = np.fromiter(map(table.__getitem__, split), np.uint64, len(split))
    span = min(shingle, len(w))
    total = np.full(len(w) - span + 1, span, np.uint64)
    for i in range(span):
        total += w[i:len(w) - span + 1 + i] * np.uint64(_ODD[i])
    return np.unique(_mix(total).view(np.int64))


def lacking(n, percent: int = PERCENT):
    """How many tokens of a set of ``n`` a linked partner can lack."""
    return n - -(-percent * n // 100)


def set_marks(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(id, n, digest, head): set size, digest of the whole set and its leading tokens under order H."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            sizes, digests, heads = [], [], []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(t, shingle, words)
                n = len(s)
                sizes.append(n)
                digests.append(hashlib.sha256(s.tobytes()).digest())
                heads.append(s[:lacking(n, percent) + -(-n // SCREEN_PART)])
            ends = np.cumsum([0, *map(len, heads)]).astype(np.int32)
            flat = np.concatenate([*heads, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc", "n", "digest", "head"])

    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = src.schema["doc"].dataType.simpleString()
    return src.mapInArrow(lean(run), f"doc {kind}, n bigint, digest binary, head array<bigint>")


def _whole_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(s, n, toks): whole sets of the classes in ``wanted`` (s, digest, doc), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            sets = [shingle_set(t, shingle, words) for t in b.column(0).cast(pa.binary()).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(s.tobytes()).digest() for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))],
                names=["digest", "toks"])

    ids = small_side(wanted.select("doc").distinct(), 1_000_000)
    src = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text"))
    src = src.join(ids, F.col("own").eqNullSafe(F.col("doc")), "left_semi").select("text")
    sets = src.mapInArrow(lean(run), "digest binary, toks array<bigint>")
    once = sets.join(small_side(wanted.select("s", "digest"), 100_000), "digest").groupBy("s").agg(F.first("toks").alias("toks"))
    return once.select("s", F.size("toks").cast("long").alias("n"), "toks")


def _ceil_div(a, b: int):
    """Column: a / b rounded up, in whole numbers."""
    return F.call_function("div", a + F.lit(b - 1), F.lit(b))


def _peeled(sets: DataFrame, percent: int) -> DataFrame:
    """The sets of which enough tokens occur in another set of ``sets``; the others have no partner."""
    tokens = sets.select("s", F.explode("toks").alias("t"))
    common = tokens.groupBy("t").agg(F.count("*").alias("df")).where("df > 1").select("t")
    held = tokens.join(common, "t", "left_semi").groupBy("s").agg(F.count("*").alias("held"))
    return sets.join(held, "s").where(F.col("held") >= _ceil_div(F.col("n") * percent, 100)).drop("held")


def _forms(sets: DataFrame, percent: int) -> DataFrame:
    """(s, n, u, sig, ix, pr, r1, r2, h, toks): sets that share enough tokens, with their prefixes under three orders.

    ``u`` tokens occur in no other set; they lead under R1 and R2 and match nothing, so the
    prefixes hold only what follows them."""
    tokens = sets.select("s", F.explode("toks").alias("t"))
    common = tokens.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    rows = tokens.join(common, "t").groupBy("s").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("c1"))
    other = F.sort_array(F.transform("c1", lambda c: F.struct(c["df"].alias("df"), F.xxhash64(c["t"]).alias("x"), c["t"].alias("t"))))
    n = F.col("n")
    least = _ceil_div(n * percent, 100)
    pr = n - least + 1
    ix = n - _ceil_div(n * 2 * percent, 100 + percent) + 1
    # parity of the common tokens per bit: bits that differ prove tokens that differ
    place = F.transform("c1", lambda c: F.pmod(F.xxhash64(c["t"], F.lit(3)), F.lit(64 * SIGNATURE_WORDS)).cast("int"))
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def word(w: int):
        mine = F.filter("place", lambda i: (i >= 64 * w) & (i < 64 * (w + 1)))
        return F.aggregate(mine, zero, lambda a, i: a.bitwiseXOR(F.call_function("shiftleft", one, i - 64 * w)))

    rows = rows.withColumn("place", place).select("s", "c1", F.array(*[word(w) for w in range(SIGNATURE_WORDS)]).alias("sig"))
    out = sets.join(rows, "s").select(
        "s", "n", "sig", (n - F.size("c1")).alias("u"), ix.alias("ix"), pr.alias("pr"), "c1", other.alias("c2"), "toks", least.alias("least"))
    left = F.greatest(F.col("pr") - F.col("u"), F.lit(0)).cast("int")
    return out.where("n - u >= least").select(
        "s", "n", "u", "sig", "ix", "pr", F.slice(F.col("c1.t"), F.lit(1), left).alias("r1"),
        F.slice(F.col("c2.t"), F.lit(1), left).alias("r2"),
        F.slice("toks", F.lit(1), F.col("pr").cast("int")).alias("h"), "toks")


def _may_link(percent: int):
    """Join condition on an index row a and a probe row b of one token: length, rare tokens, position,
    and at most |a| + |b| - 2 * need tokens that only one has, rare ones and those of the signature."""
    c = F.col
    need = _ceil_div((c("a_n") + c("b_n")) * percent, 100 + percent)
    order = (c("a_n") < c("b_n")) | ((c("a_n") == c("b_n")) & (c("a") < c("b")))
    rare = F.least(c("a_n") - c("a_u"), c("b_n") - c("b_u")) >= need
    place = (F.least(c("a_at") - c("a_u"), c("b_at") - c("b_u"))
             + F.least(c("a_n") - c("a_at"), c("b_n") - c("b_at"))) >= need
    differ = c("a_u") + c("b_u") + sum(F.bit_count(c("a_sig")[w].bitwiseXOR(c("b_sig")[w])) for w in range(SIGNATURE_WORDS))
    return (order & (c("a_n") * 100 >= c("b_n") * percent) & rare & place
            & (differ <= c("a_n") + c("b_n") - need * 2))


def _side(rows: DataFrame, p: str) -> DataFrame:
    return rows.select("t", F.col("s").alias(p), *[F.col(x).alias(f"{p}_{x}") for x in ("n", "u", "sig", "at", "comp")])


def _verified(pairs: DataFrame, forms: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), |a| <= |b|: orders R2 and H first, then whole sets."""
    def of(p: str, *cols: str) -> DataFrame:
        return forms.select(F.col("s").alias(p), *[F.col(x).alias(f"{p}_{x}") for x in cols])

    own = F.greatest(F.col("a_ix") - F.col("a_u"), F.lit(0)).cast("int")
    passed = (pairs.join(of("a", "u", "ix", "r2", "h"), "a").join(of("b", "r2", "h"), "b")
              .where(F.arrays_overlap(F.slice("a_r2", F.lit(1), own), F.col("b_r2"))
                     & F.arrays_overlap(F.slice("a_h", F.lit(1), F.col("a_ix").cast("int")), F.col("b_h")))
              .select("a", "b"))
    passed = shared_table(passed, "jaccard-candidates")
    both = F.size(F.array_intersect("a_toks", "b_toks"))
    return (passed.join(of("a", "n", "toks"), "a").join(of("b", "n", "toks"), "b")
            .where(both * 100 >= (F.col("a_n") + F.col("b_n") - both) * percent).select("a", "b"))


def _merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """(node, root) after the links ``found`` (a, b): only links between components so far are searched for paths."""
    def root_of(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))

    ends = found.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(
        "a", "b", F.coalesce("a_root", "a").alias("x"), F.coalesce("b_root", "b").alias("y"))
    ends = shared_table(ends, "jaccard-ends")
    across = ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    over = components(across).select(F.col("node").alias("root"), F.col("root").alias("top"))
    every = labels.union(ends.select("a", "x")).union(ends.select("b", "y")).distinct()
    return shared_table(every.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "jaccard-components")


def set_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, root) of every linked set of ``sets`` (s, n, toks): components of the Jaccard links."""
    spark = sets.sparkSession
    # what only sets without a partner share counts as rare from then on
    sets = shared_table(_peeled(sets, percent), "jaccard-peeled")
    forms = shared_table(_forms(sets, percent), "jaccard-forms")
    postings = shared_table(forms.select("s", "n", "u", "sig", "ix", F.posexplode("r1").alias("k", "t")).select(
        "t", "s", "n", "u", "sig", (F.col("u") + F.col("k")).alias("at"),
        (F.col("u") + F.col("k") < F.col("ix")).alias("indexed")), "jaccard-postings")
    labels = spark.createDataFrame([], "node bigint, root bigint")

    def labelled() -> DataFrame:
        """Postings with the component so far, of tokens whose holders are not all of one component."""
        rows = (postings.join(labels.withColumnRenamed("node", "s"), "s", "left")
                .select(*postings.columns, F.coalesce("root", "s").alias("comp")))
        rows = shared_table(rows, "jaccard-labelled")
        mixed = rows.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("t")
        return shared_table(rows.join(mixed, "t", "left_semi"), "jaccard-mixed")

    for turn in range(STAR_ROUNDS):
        rows = labelled()
        # the first hub is the smallest set, later ones are picked by a hash that changes with the round
        rank = F.struct("n", "s") if turn == 0 else F.struct(F.xxhash64("s", F.lit(turn)), "s")
        hub = rows.where("indexed").groupBy("t").agg(
            F.min_by(F.struct("s", "n", "u", "sig", "at", "comp"), rank).alias("hub")).select("t", "hub.*")
        both = _side(hub, "a").join(_side(rows, "b"), "t").where("a_comp <> b_comp").where(_may_link(percent))
        found = shared_table(_verified(both.select("a", "b").distinct(), forms, percent), "jaccard-links")
        if not found.limit(1).count():
            break
        labels = _merged(labels, found)
    rows = labelled()
    per = rows.groupBy("t", "comp").agg(F.count("*").alias("rows"))
    most = per.groupBy("t").agg(F.max_by("comp", F.struct("rows", "comp")).alias("most"))
    rows = shared_table(rows.join(most, "t").withColumn("outside", F.col("comp") != F.col("most")).drop("most"), "jaccard-sides")
    out_a = _side(rows.where("indexed and outside"), "a").join(_side(rows, "b"), "t")
    out_b = _side(rows.where("indexed and not outside"), "a").join(_side(rows.where("outside"), "b"), "t")
    pairs = [x.where((F.col("a_comp") != F.col("b_comp")) & _may_link(percent)).select("a", "b") for x in (out_a, out_b)]
    found = shared_table(_verified(pairs[0].union(pairs[1]).distinct(), forms, percent), "jaccard-links")
    if not found.limit(1).count():
        return labels
    return _merged(labels, found)


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links, the own one
    included. Rows without words (null or empty text) have no shingle and keep
    their own id; equal sets are linked, repeated rows give repeated rows; a null
    id never names a class that has another id; an empty table gives an empty
    result. Other columns of ``docs`` are not read. ``percent`` is 1 to 100.
    """
    if not 1 <= percent <= 100 or not 1 <= shingle <= len(_ODD):
        raise ValueError("percent must be 1 to 100 and shingle 1 to 64 words")
    marks = shared_table(set_marks(docs, id_col, text_col, shingle, percent)
                         .withColumn("row", F.monotonically_increasing_id()), "jaccard-marks")
    filled = marks.where("n > 0")
    # order H: leading tokens that another row has among its own; copies pass, too, and are one set from then on
    heads = filled.select("row", F.explode("head").alias("t"))
    shared = heads.groupBy("t").agg(F.count("*").alias("rows")).where("rows > 1").select("t")
    hits = heads.join(shared, "t", "left_semi").groupBy("row").agg(F.count("*").alias("hits"))
    asked = _ceil_div(_ceil_div(F.col("n") * percent, 100), SCREEN_PART)
    live = (filled.select("row", "doc", "n", "digest").join(hits, "row").where(F.col("hits") >= asked)
            .groupBy("digest").agg(F.min("doc").alias("doc")))
    live = shared_table(live.withColumn("s", F.monotonically_increasing_id()), "jaccard-live")
    sets = shared_table(_whole_sets(docs, id_col, text_col, shingle, live), "jaccard-sets")
    roots = set_links(sets, percent)

    classes = shared_table(filled.groupBy("digest").agg(F.min("doc").alias("first")), "jaccard-classes")
    named = roots.join(live.select(F.col("s").alias("node"), "digest"), "node").join(classes, "digest")
    named = shared_table(named.select("digest", "root", "first"), "jaccard-named")
    smallest = named.groupBy("root").agg(F.min("first").alias("least"))
    linked = named.join(smallest, "root").select("digest", "least")
    label = shared_table(classes.join(linked, "digest", "left")
                         .select("digest", F.coalesce("least", "first").alias("component_id")), "jaccard-label")
    flat = marks.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "digest")
    with_words = flat.where("n_shingles > 0").join(label, "digest").select(id_col, "n_shingles", "component_id")
    without = flat.where("n_shingles = 0").select(id_col, "n_shingles", F.col(id_col).alias("component_id"))
    return with_words.unionByName(without)
