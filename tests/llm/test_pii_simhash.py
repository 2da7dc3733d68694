"""Operators 1 and 2 against brute force, and their edge cases."""

import hashlib
import random
import re
import unicodedata

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arenaspark.llm import pii, simhash
from arenaspark.llm.common import read
from arenaspark.llm.components import components
from arenaspark.llm.queries import REGISTRY
from conftest import SF_SMALL

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    ok = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
          "card": lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m)),
          "phone": lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15}
    return {k: [m.span() for m in re.finditer(p, text) if ok[k](m.group())] for k, p in BASE.items()}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+%_ ()0123459\n", max_size=60))
def test_base_detectors_equal_the_patterns(text):
    assert pii.detect(text) == brute(text)


def test_query_on_documents(spark):
    got = {r.doc_id: r for r in REGISTRY["op1_pii"](spark, SF_SMALL).collect()}
    docs = read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = brute(d.text or "")
        r = got[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in pii.KINDS]
        listed = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in want[k]]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}


@pytest.mark.parametrize("text, found", [
    ("mail john [at] example [dot] com now", {"email": ["john [at] example [dot] com"]}),
    ("john dot smith at example dot co dot uk ok", {"email": ["john dot smith at example dot co dot uk"]}),
    ("x jоhn@exаmple.com y", {"email": ["jоhn@exаmple.com"]}),
    ("user＠example．com", {"email": ["user＠example．com"]}),
    ("call plus one five five five one two three four five six seven now",
     {"phone": ["plus one five five five one two three four five six seven"]}),
    ("call plus 4 four 1 one 5 five 5 five 0 zero 1 now", {"phone": ["plus 4 four 1 one 5 five 5 five 0 zero 1"]}),
    ("card 4111-one one one one-1111-1111 ok", {"card": ["4111-one one one one-1111-1111"]}),
    ("host 10 dot 0 dot 0 dot one up", {"ip": ["10 dot 0 dot 0 dot one"]}),
    ("call +44 20 7946 0958 two people", {"phone": ["+44 20 7946 0958"]}),
    ("one of 12 two 5 men, 3 four", {}),
    ("x " + " dot ".join(["ab"] * 50) + " at site dot com", {"email": [" dot ".join(["ab"] * 50) + " at site dot com"]}),
    ("me at ex dot com and you at wy dot org", {"email": ["me at ex dot com", "you at wy dot org"]}),
    ("card " + " ".join(["four"] + ["one"] * 15) + " end", {"card": [" ".join(["four"] + ["one"] * 15)]}),
    ("at 192[.]168[.]0[.]1 x", {"ip": ["192[.]168[.]0[.]1"]}),
    ("one nine two dot one six eight dot zero dot one", {"ip": ["one nine two dot one six eight dot zero dot one"]}),
    ("4111​1111 1111 1111", {"card": ["4111​1111 1111 1111"]}),
    ("look at example.com, one of three at most. Élan vital à 3 €", {}),
    ("", {}), ("a" * 100_000, {}), ("@" * 50_000, {}), ("1" * 100_000, {}), ("1." * 30_000, None),
])
def test_disguises_keep_source_offsets(text, found):
    base, every = pii.scan(text)
    assert all(set(base[k]) <= set(every[k]) for k in pii.KINDS)
    if found is not None:
        assert {k: [text[a:b] for a, b in v] for k, v in every.items() if v} == found


def test_alignment_maps_back():
    a = pii.Alignment("abXXcdY", [(2, 4, "1"), (6, 7, "")])
    assert a.text == "ab1cd"
    assert a.source(0, 2) == (0, 2, False) and a.source(2, 3) == (2, 4, True) and a.source(3, 5) == (4, 6, False)
    assert a.source(1, 4) == (1, 5, True)
    assert pii.Alignment("", []).text == ""


def frame(spark, rows):
    """Documents with further columns whose names operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = ["id", "key", "fp", "a", "b", "root", "t", "w", "raw", "text_hash", "label", "copy_id", "twice_id", "leak_id", "poor_id", "n", "line", "h", "place"]
    return df.withColumns({c: F.lit("x") for c in extra} | {"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})


EDGES = [(1, None), (2, ""), (3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e f g"), (5, "word " * 30000), (6, "   \n\t ")]


def test_pii_edges_and_mask(spark):
    out = pii.find_pii(frame(spark, EDGES + [(9, "x a@b.co +1 (743) 555-3824")])).collect()
    assert len(out) == 8
    one = {r.doc_id: r for r in out}
    empty = hashlib.sha256(b"").hexdigest()
    assert one[1].base_sha256 == one[2].base_sha256 == empty and one[9].spans == "email:2:8,phone:9:26"
    m = {r.doc_id: r for r in pii.mask_pii(frame(spark, EDGES + [(9, "x a@b.co +1 (743) 555-3824")])).collect()}
    assert m[9].text == "x <EMAIL> <PHONE>" and m[9].n_chars == len(m[9].text) and m[1].text is None
    assert pii.mask_pii(frame(spark, EDGES)).columns == frame(spark, EDGES).columns
    assert pii.find_pii(frame(spark, [])).count() == 0 and pii.mask_pii(frame(spark, [])).count() == 0


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    g = [" ".join(w)] if len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="AaBb É \t\n\x1c\xa0é", max_size=40)))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def classes(fps):
    """Smallest id of the component of each (id, fingerprint)."""
    parent = {i: i for i, _ in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= 3:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in fps}


def test_simhash_query_against_brute_force(spark):
    docs = read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    fps = [(d.doc_id, slow_fingerprint(d.text)) for d in docs]
    want = classes(fps)
    got = {r.doc_id: r for r in REGISTRY["op2_simhash"](spark, SF_SMALL).collect()}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{f:016x}", want[i]) for i, f in fps}


def test_pigeonring_loses_no_link(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    fps = set(base)
    for f in base:
        for _ in range(25):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 4)):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 3}
    sign = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(sign(f),) for f in fps], "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.fingerprint_links(df).collect()]
    assert len(links) == len(set(links))
    assert {(min(x), max(x)) for x in links} == want


def test_simhash_edges(spark):
    out = simhash.near_duplicates(frame(spark, EDGES)).collect()
    assert len(out) == len(EDGES)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fp == by[2][0].fp == by[6][0].fp == 0 and {by[k][0].component_id for k in (1, 2, 6)} == {1}
    assert len(by[3]) == 2 and by[None][0].component_id in (None, 3)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    kept = simhash.keep_one(frame(spark, EDGES))
    assert kept.columns == frame(spark, EDGES).columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) [:3] == [(False, 1), (False, 3), (False, 5)]
    assert simhash.keep_one(frame(spark, [])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(500, 500 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 181)} | {i: 500 for i in range(500, 560)}


def test_homoglyph_table_reads_as_ascii():
    assert all(len(v) <= 1 and v.isascii() for v in pii._CHARS.values())
    assert all(pii._NOT_PLAIN.match(c) for c in pii._CHARS)
    assert pii._CHARS[unicodedata.lookup("ARABIC-INDIC DIGIT FOUR")] == "4"
