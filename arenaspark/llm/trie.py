"""Prefix trie of conversations with count-min screening of prefix digests (operator 13).

Every conversation is a sequence of turns; a node is a distinct sequence of
first d turns. Turns are replaced by digests in the scan, so no text is
shuffled. A prefix digest is the polynomial of its turn digests modulo a
255-bit prime; it composes, so a conversation that spans range partitions is
put together from its parts.

A count-min sketch of all prefix digests, of a fixed greatest size, is built by
one aggregate; only whether a cell counted more than one is kept, as bitmaps.
An estimate of one proves that a prefix has one member, and so have all longer
ones of that conversation: these tail nodes are written where they are found.
Only prefixes that may be shared are shuffled and grouped exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenaspark.llm.common import shared_table

GROUP_IDS, HEAD_KINDS = 100, 6        # fixed values of the contract: conversations per base, head lengths 0 to 5
MODULUS = (1 << 255) - 19
_BASE = int.from_bytes(hashlib.sha256(b"prefix").digest(), "big") % MODULUS
SKETCH_ROWS, MAX_CELLS = 2, 1 << 27   # at most SKETCH_ROWS bitmaps of MAX_CELLS bits: 32 MB
CELLS_PER_PREFIX = 8
PIECE_CHARS = 1 << 16                 # listed ids are joined to pieces of about so many characters
ROOT = b""
_RUN = ["conv_id", "depth", "prefix", "is_last", "chars", "dig"]
_RUN_TYPES = "conv_id bigint, depth bigint, prefix binary, is_last boolean, chars bigint, dig binary"


def _extend(prefix: int, turn: bytes) -> int:
    return (prefix * _BASE + int.from_bytes(turn, "big") + 1) % MODULUS


def chained(rows: DataFrame, order: list[str]) -> DataFrame:
    """(conv_id, depth, prefix, is_last, chars, dig): turns numbered from 1 in ``order``, with prefix digests.

    Range-partitioned by conversation and order, so one very long conversation is
    dealt to several tasks; each numbers and digests its run, and what precedes a
    run (at most two conversations of a partition reach over its edges) is added after."""
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, depth, prefix, held = None, 0, 0, None

        def out(c, d, p, last, chars, dig):
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(c), pa.int32()), pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(p, pa.binary()),
                 pa.array(last, pa.bool_()), pa.array(chars, pa.int64()), pa.array(dig, pa.binary())], names=["part", *_RUN])

        for b in batches:
            c, d, p, last, chars, dig = ([x] for x in held) if held else ([], [], [], [], [], [])
            for own, turn, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if own != conv:
                    conv, depth, prefix = own, 0, 0
                    if last:
                        last[-1] = True
                depth, prefix = depth + 1, _extend(prefix, turn)
                c.append(own)
                d.append(depth)
                p.append(prefix.to_bytes(32, "big"))
                last.append(False)
                chars.append(size)
                dig.append(turn)
            if c:  # the last row waits for its successor
                held = [x.pop() for x in (c, d, p, last, chars, dig)]
                yield out(c, d, p, last, chars, dig)
        if held:
            held[3] = True
            yield out(*([x] for x in held))

    sorted_ = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order).select("conv_id", "dig", "chars")
    runs = shared_table(sorted_.mapInArrow(run, f"part int, {_RUN_TYPES}"), "runs")
    ends = runs.where("is_last").select("conv_id", "part", "depth", "prefix")
    split = ends.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select("conv_id")
    # at most two rows a partition: a conversation over an edge is a partition's first or last
    edges = ends.join(split, "conv_id").collect()
    if not edges:
        return runs.drop("part")
    before: dict[tuple[int, int], tuple[int, bytes]] = {}
    final: dict[int, int] = {}
    state: dict[int, tuple[int, int]] = {}
    for e in sorted(edges, key=lambda e: (e.conv_id, e.part)):
        length, value = state.get(e.conv_id, (0, 0))
        before[e.conv_id, e.part] = (length, value.to_bytes(32, "big"))
        joined = (value * pow(_BASE, e.depth, MODULUS) + int.from_bytes(e.prefix, "big")) % MODULUS
        state[e.conv_id] = (length + e.depth, joined)
        final[e.conv_id] = e.part
    carry = spark.sparkContext.broadcast((before, final))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last_part = carry.value
        for b in batches:
            part, conv, depth, prefix, last = (b.column(i).to_pylist() for i in range(5))
            for i, key in enumerate(zip(conv, part, strict=True)):
                if key in known:
                    length, value = known[key]
                    if length:
                        p = int.from_bytes(value, "big") * pow(_BASE, depth[i], MODULUS) + int.from_bytes(prefix[i], "big")
                        prefix[i] = (p % MODULUS).to_bytes(32, "big")
                        depth[i] += length
                    last[i] = last[i] and part[i] == last_part[conv[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(prefix, pa.binary()),
                 pa.array(last, pa.bool_()), b.column(5), b.column(6)], names=_RUN)

    return shared_table(runs.mapInArrow(mend, _RUN_TYPES), "mended")


def _cells(prefix: bytes, width: int) -> list[int]:
    return [xxhash.xxh64_intdigest(prefix, seed) % width + seed * width for seed in range(SKETCH_ROWS)]


def shared_cells(nodes: DataFrame, width: int) -> bytes:
    """Bitmap over all rows of the sketch: the cells that counted more than one prefix of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = [c + 1 for p in b.column(0).to_pylist() for c in _cells(p, width)]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64())], names=["cell"])

    counted = nodes.select("prefix").mapInArrow(run, "cell bigint").groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    maps = counted.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    out = np.zeros(-(-SKETCH_ROWS * width // 32768) * 4096, np.uint8)
    for r in maps.toLocalIterator():  # 4 kB per 32,768 cells: bounded by the sketch
        bits = np.frombuffer(bytes(r.bits), np.uint8)
        out[(r.bucket - 1) * 4096:(r.bucket - 1) * 4096 + len(bits)] = bits
    return out.tobytes()


def screened(nodes: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """``nodes`` with ``state``: 2 may be shared, 1 first prefix of a run proven single, 0 single behind such a one."""
    width = 1 << 10
    total = nodes.count()
    while width < min(CELLS_PER_PREFIX * total, max_cells):
        width *= 2
    sketch = nodes.sparkSession.sparkContext.broadcast(shared_cells(nodes, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        conv, depth, single = None, 0, False
        for b in batches:
            state = []
            for own, d, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if own != conv or d != depth + 1:
                    single = False
                conv, depth = own, d
                if single:
                    state.append(0)
                    continue
                single = any(not bits[c >> 3] >> (c & 7) & 1 for c in _cells(p, width))
                state.append(1 if single else 2)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(state, pa.int32())], names=[*b.schema.names, "state"])

    return nodes.select("conv_id", "depth", "prefix", "is_last", "chars").mapInArrow(
        run, "conv_id bigint, depth bigint, prefix binary, is_last boolean, chars bigint, state int")


def listed_digest(members: DataFrame) -> DataFrame:
    """(prefix, ends_sha256): SHA-256 of each prefix's conversation ids, ascending, comma-joined.

    Ids are joined to pieces where a range partition has sorted them, so a prefix with very many
    conversations is gathered by many tasks and only its pieces meet, read as a stream."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, ids, size = None, 0, [], 0

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([held], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)], pa.string())],
                names=["prefix", "first", "piece"])

        for b in batches:
            for prefix, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if prefix != held or size > PIECE_CHARS:
                    if ids:
                        yield out()
                    held, first, ids, size = prefix, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for b in batches:
            keys, values = [], []
            for prefix, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if prefix != held:
                    if digest is not None:
                        keys.append(held)
                        values.append(digest.hexdigest())
                    held, digest = prefix, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.string())], names=["prefix", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([digest.hexdigest()])], names=["prefix", "ends_sha256"])

    cut = members.repartitionByRange("prefix", "conv_id").sortWithinPartitions("prefix", "conv_id").select("prefix", "conv_id")
    cut = cut.mapInArrow(pieces, "prefix binary, first bigint, piece string")
    return (cut.repartition("prefix").sortWithinPartitions("prefix", "first").select("prefix", "piece")
            .mapInArrow(hashed, "prefix binary, ends_sha256 string"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations (conv_id), their rebuilt turns as ``chained`` gives them); ``turns``: conv_id, turn, role, dig, chars."""
    placed = chained(turns, ["turn", "role", "dig"]).select("conv_id", F.col("depth").alias("at"), "dig", "chars")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_KINDS
    convs = placed.where("at = 1").select("conv_id")
    asked = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP_IDS).alias("base"), head.alias("h"))
    heads = placed.where((F.col("conv_id") % GROUP_IDS == 0) & (F.col("at") < HEAD_KINDS)).select(
        F.col("conv_id").alias("base"), "at", "dig", "chars")
    copied = asked.join(heads, "base").where("at <= h").select("conv_id", F.lit(0).alias("kind"), "at", "dig", "chars")
    own = placed.where(F.col("at") > head).select("conv_id", F.lit(1).alias("kind"), "at", "dig", "chars")
    return convs, chained(copied.union(own), ["kind", "at"])


def prefix_trie(conversations: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role or text is an empty one; turns are ordered by turn (null first),
    equal turn numbers by role and text digest; repeated rows are turns of their
    own. Rows with a null conv_id take no part. An empty table has no node, not
    even a root. Texts of any length are read whole; columns other than conv_id,
    turn, role and text are not read. Ids keep the sign rule of SQL's remainder.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat_ws(":", F.length(role), role, text).cast("binary"), 256)).alias("dig"),
        F.length(text).cast("bigint").alias("chars"))
    convs, nodes = rebuilt(turns)
    total = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).first()
    shape = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
             "saved_tokens bigint, ends_sha256 string")
    if not total.n:
        return spark.createDataFrame([], shape)
    flagged = shared_table(screened(nodes, max_cells), "screened")
    open_ = flagged.where("state = 2")
    stats = open_.groupBy("prefix").agg(F.count("*").alias("n"), F.min("conv_id").alias("rep"),
                                        F.sum(F.col("is_last").cast("bigint")).alias("n_ends"))
    exact = open_.join(stats, "prefix").select("conv_id", "depth", "prefix", "is_last", "chars", "state", "n", "rep", "n_ends")
    single = flagged.where("state = 1").select(
        "conv_id", "depth", "prefix", "is_last", "chars", "state", F.lit(1).cast("bigint").alias("n"),
        F.col("conv_id").alias("rep"), F.col("is_last").cast("bigint").alias("n_ends"))

    # deepest first, so that the sum over the deeper part of a conversation is a running one
    up = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    so_far = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("conv_id") == F.col("rep")
    above, below = F.lead("depth").over(up), F.lag("depth").over(up)
    parent = (F.when(F.col("depth") == 1, F.lit(total.least)).when(above == F.col("depth") - 1, F.lead("rep").over(up))
              .otherwise(F.col("conv_id")))
    child = (~F.col("is_last")) & F.when(below == F.col("depth") + 1, F.lag("rep").over(up) == F.col("conv_id")).otherwise(True)
    deepest = F.first(F.struct("is_last", (own & (F.col("n") == F.col("n_ends"))).alias("leaf"))).over(so_far)
    members = shared_table(exact.unionByName(single).select(
        "conv_id", "depth", "prefix", "is_last", "state", parent.alias("parent"), child.cast("bigint").alias("child"),
        F.when(deepest["is_last"], deepest["leaf"]).otherwise(True).cast("bigint").alias("leaf"),
        F.sum(F.when(own, (F.col("n") - 1) * F.col("chars")).otherwise(0)).over(so_far).alias("saved")), "members")

    turnless = convs.join(nodes.where("depth = 1").select("conv_id"), "conv_id", "left_anti").select(
        F.lit(ROOT).alias("prefix"), "conv_id")
    ends = shared_table(listed_digest(members.where("state = 2 and is_last").select("prefix", "conv_id").union(turnless)), "ends")
    none = hashlib.sha256(b"").hexdigest()

    def alone(last):
        return F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(none)

    grouped = (members.where("state = 2").groupBy("prefix").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent_conv_id"),
        F.count("*").alias("n_convs"), F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        .join(ends, "prefix", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))).drop("prefix"))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    first = members.where("state = 1").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), one.alias("n_convs"), F.col("child").alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved_tokens"), alone(F.col("is_last")).alias("ends_sha256"))
    tails = flagged.where("state = 0").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(F.col("is_last"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        alone(F.col("is_last")).alias("ends_sha256"))
    body = shared_table(grouped.unionByName(first).unionByName(tails), "trie")
    top = body.where("depth = 1").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
    listed = ends.where(F.col("prefix") == F.lit(ROOT)).first()
    root = spark.createDataFrame([(total.least, 0, None, total.n, top.children, top.leaves or 1, top.saved or 0,
                                   listed.ends_sha256 if listed else none)], shape)
    return root.unionByName(body.select(*root.columns))
