"""Operators 5 and 7: exact round trips, packing quality, edge cases."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arenaspark.llm import mixcoder, packing, tokenfile, tokens
from arenaspark.llm.common import read
from arenaspark.llm.queries import REGISTRY
from conftest import SF_SMALL

BYTE, WORD = (tokens.public_tokenizer(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TOKENIZERS = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
ENCODERS = {p: tokens.WordEncoder(p, cache_words=50) for p in (BYTE, WORD)}


def ids_of(path, text):
    return TOKENIZERS[path].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab  Zé́É.,!#\n\t\x1c\x00\xa0'sß日İ1<|>", max_size=30)), max_size=6))
def test_encoder_equals_the_tokenizer(texts):
    for path, encoder in ENCODERS.items():
        ids, counts = encoder.encode(texts)
        want = [ids_of(path, t) for t in texts]
        assert counts.tolist() == list(map(len, want))
        assert ids.tolist() == [i for w in want for i in w]


def test_encoder_on_documents(spark):
    texts = [d.text for d in read(spark, SF_SMALL, "documents").collect()] + [
        "<|endoftext|> it's<|endoftext|>", " lead", "trail ", "a  b", "", None, "x" * 5000, "don't 'll we've"]
    for path in (BYTE, WORD):
        ids, counts = tokens.WordEncoder(path).encode(texts)
        want = [ids_of(path, t) for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def check_pieces(rows, docs):
    """rows of one packing; docs: (id, ids with the end id), ids may repeat."""
    want = Counter()
    for key, ids in docs:
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        spans = [(0, first)] + [(s, 2048) for s in range(first, len(ids), 2048)]
        want.update((key, p, s, n, crc(ids[s:s + n])) for p, (s, n) in enumerate(spans))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    place = {}
    for r in rows:
        place.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(place), -(-sum(n for p in place.values() for _, n in p) // 2048)


def test_packing_query(spark):
    docs = [(d.doc_id, ids_of(BYTE, d.text) + [0]) for d in read(spark, SF_SMALL, "documents").collect()]
    used, least = check_pieces(REGISTRY["op5_packing"](spark, SF_SMALL).collect(), docs)
    assert used <= least + 1 + least // 50


def test_packing_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (7, "word " * 9000)] + [(i, "same text") for i in range(50, 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("length", "task", "rank", "lo", "hi", "each", "base", "earlier", "n", "ids")}).repartition(5)
    out = packing.pack(df, with_ids=True).collect()
    check_pieces(out, [(k, ids_of(BYTE, t) + [0]) for k, t in rows])
    assert all(crc(r.ids) == r.ids_crc32 for r in out)
    assert packing.pack(df.limit(0)).count() == 0


def test_plans_are_valid_and_close_to_the_bound():
    for seed in range(12):
        rng = random.Random(seed)
        n = rng.randint(1, 20000)
        lengths = [min(2048, int(rng.lognormvariate(6.2, 1.2)) + 1) for _ in range(n)]
        counts = Counter(lengths)
        groups = packing.plan_groups(counts)
        got = Counter()
        for times, made in groups:
            assert times > 0 and sum(a * b for a, b in made) <= 2048
            for a, b in made:
                got[a] += times * b
        assert got == counts
        assert sum(t for t, _ in groups) <= -(-sum(lengths) // 2048) * 1.02 + 1


def test_exact_fills_come_first():
    # one, two and three partners that fill the gap exactly
    assert sum(t for t, _ in packing.plan_groups({2000: 5, 48: 5})) == 5
    assert sum(t for t, _ in packing.plan_groups({1500: 4, 500: 4, 48: 4})) == 4
    assert sum(t for t, _ in packing.plan_groups({1024: 3, 600: 3, 400: 3, 24: 3})) == 3
    assert packing.plan_groups({}) == [] and packing.plan_groups({2048: 2}) == [(2, [(2048, 1)])]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, mixcoder.MAX_ID), max_size=80), st.integers(1, 60))
def test_coder_round_trip(ids, times):
    x = np.array(ids * times, dtype=np.uint32)
    assert np.array_equal(mixcoder.unpack_chunk(mixcoder.pack_chunk(x)), x)


def test_coder_on_streams_of_each_kind():
    rng = np.random.default_rng(5)
    for x in (np.zeros(5000), np.full(3000, mixcoder.MAX_ID), rng.integers(0, 49408, 7000), np.arange(2049) % 3,
              np.tile(rng.integers(0, 49408, 37), 200)):
        x = x.astype(np.uint32)
        data = mixcoder.pack_chunk(x)
        assert np.array_equal(mixcoder.unpack_chunk(data), x)
    assert len(data) < 0.7 * 2 * len(x)  # the repeating stream is predicted
    with pytest.raises(ValueError):
        mixcoder.pack_chunk(np.array([65535], dtype=np.uint32))


def test_blocks_stand_alone_and_damage_is_found():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 900, 5 * mixcoder.BLOCK_IDS).astype(np.uint32)
    blocks = mixcoder.encode_blocks(x)
    n = mixcoder.BLOCK_IDS
    assert np.array_equal(mixcoder.decode_blocks(blocks[3:4], n), x[3 * n:4 * n])
    data = bytearray(mixcoder.pack_chunk(x))
    data[-5] ^= 1
    with pytest.raises(ValueError):
        mixcoder.unpack_chunk(bytes(data))
    with pytest.raises(ValueError):
        mixcoder.unpack_chunk(b"XXXX" + bytes(data[4:]))


def check_files(rows, docs):
    at, want = 0, []
    for key, text in docs:
        ids = ids_of(WORD, text) + [2]
        want.append((key, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1]) == want


def test_token_query(spark):
    docs = sorted((d.doc_id, d.text) for d in read(spark, SF_SMALL, "documents").collect())
    check_files(REGISTRY["op7_tokens"](spark, SF_SMALL).collect(), docs)


def test_token_files_edges_and_small_chunks(spark, monkeypatch, tmp_path):
    rows = [(None, "no id"), (1, None), (2, ""), (4, "same words"), (4, "same words"), (9, "Word " * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("key", "keys", "counts", "file_no", "chunk_no", "n_ids", "payload")}).repartition(3)
    check_files(tokenfile.token_files(df).collect(), rows)
    assert tokenfile.token_files(df.limit(0)).count() == 0
    tokenfile.write_token_files(df, str(tmp_path / "f"))
    back = {r.doc_id: r.ids for r in tokenfile.read_token_files(spark, str(tmp_path / "f"), with_ids=True).collect()}
    assert back[9] == ids_of(WORD, "Word " * 4000) + [2] and back[1] == [2]


def test_words_of_plain_letters_are_kept_once():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encoder = tokens.WordEncoder(tokens.public_tokenizer(name))
        texts = ["one Plain mUsic words", "one Plain, words école wordsé straße", "Plain", "x" * 40 + " " + "Qz" * 30]
        ids, counts = encoder.encode(texts)
        whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for x in whole for i in x] and counts.tolist() == [len(x) for x in whole]
        assert encoder.lens.size and not {" mUsic", " words"} & set(encoder.parts)
