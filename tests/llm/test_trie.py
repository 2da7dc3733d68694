"""Operator 13 against brute force, and its edge cases."""

import collections
import hashlib
import random
import zlib

import pytest

from arenaspark.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, prefix string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)


def digest(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def brute(rows):
    conv = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            conv[c].append(((t is not None, t or 0, r, hashlib.sha256(f"{len(r)}:{r}:{x}".encode()).digest()), (r, x)))
    members, ends, kids = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c in sorted(conv):
        h, base = zlib.crc32(str(c).encode()) % 6, c - c % 100
        seq = [x for _, x in sorted(conv.get(base, []))[:h]] + [x for _, x in sorted(conv[c])[h:]]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                kids[tuple(seq[:d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[q] for q in kids[k]) if kids[k] else 1
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1]) if k else 0) + sum(saved[q] for q in kids[k])
    return order((members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(kids[k]), leaves[k], saved[k],
                  digest(ends[k])) for k in members)


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(-1 if v is None else v for v in r))


def talk(seed, n=260):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1000), n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 8, 8, 9])):
            text = rng.choice(["hello", "hello", "yes", "", None, "naïve 𝄞", f"own {rng.random()}"])
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "user", "bot", None]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, cells", [(1, trie.MAX_CELLS), (2, 1 << 10), (3, 1)])
def test_equals_brute_force(spark, seed, cells):
    """Also with sketches so small that nothing, or hardly anything, is proven single."""
    rows = talk(seed)
    assert order(trie.prefix_trie(frame(spark, rows), cells).collect()) == brute(rows)


def test_long_and_common_conversations_span_partitions(spark):
    """One conversation holds over a third of all turns; copies of another are many."""
    rows = [(700, t, "user", f"line {t // 3}") for t in range(3000)]
    rows += [(c, t, "bot", "same") for c in range(1000, 1900) for t in range(3)]
    rows += [(5000 + c, t, "user", f"{c} {t}") for c in range(300) for t in range(4)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert order(trie.prefix_trie(frame(spark, rows)).collect()) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_turnless_conversations_end_at_the_root(spark):
    # 3 copies 5 turns of conversation 0, which is absent: with no more turns of its own it is turnless
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    got = trie.prefix_trie(frame(spark, rows)).collect()
    assert list(map(tuple, got)) == [(c, 0, None, 1, 0, 1, 0, digest([c]))]
    assert order(map(tuple, got)) == brute(rows)


def test_null_ids_repeats_long_text_and_empty_table(spark):
    rows = [(None, 0, "user", "x"), (-7, 0, None, None), (200, 0, "user", "x" * 300_000), (200, 0, "user", "x" * 300_000), (201, None, "", "y")]
    kept = [r for r in rows if r[0] != -7]
    assert order(trie.prefix_trie(frame(spark, kept)).collect()) == brute(kept)
    assert len(trie.prefix_trie(frame(spark, rows)).collect()) > 0
    assert trie.prefix_trie(frame(spark, [])).collect() == []


def test_an_estimate_of_one_proves_a_singleton(spark):
    rows = talk(9)
    turns = frame(spark, [(c, t, r or "", x or "") for c, t, r, x in rows])
    from pyspark.sql import functions as F
    turns = turns.select("conv_id", "turn", "role", F.unhex(F.sha2(F.concat("role", F.lit(":"), "text").cast("binary"), 256)).alias("dig"),
                         F.length("text").cast("bigint").alias("chars"))
    _, nodes = trie.rebuilt(turns)
    held = collections.Counter(r.prefix for r in nodes.collect())
    for cells in (1 << 10, trie.MAX_CELLS):
        flagged = trie.screened(nodes, cells).collect()
        assert all(held[r.prefix] == 1 for r in flagged if r.state < 2)
        assert {r.prefix for r in flagged} == set(held)
