"""Operators 3 and 4 against brute force, and their edge cases."""

import hashlib
import math
import re
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F

from arenaspark.llm import licenses, warc
from arenaspark.llm.common import read
from arenaspark.llm.queries import REGISTRY
from conftest import SF_SMALL


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))


def base(text):
    w = words(text)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def contained(text):
    """(labels, best containment) by comparing every block with every template."""
    labels, best = set(), 0.0
    w = words(text)
    for label, t in licenses.TEMPLATES:
        own = {x for x in re.split(r"[^0-9a-z]+", t.lower()) if x}
        g = 8
        while g < len(re.findall(r"[0-9A-Za-z]+", t)):
            g *= 2
        for s in range(0, max(0, len(w) - g - 1) + 1, g):
            block = set(w[s:s + 2 * g])
            if len(own & block) >= math.ceil(licenses.THRESHOLD * len(own) - 1e-9):
                labels.add(label)
                best = max(best, len(own & block) / len(own))
    return labels, best


def check(rows, docs):
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        n, k, lo, hi, own = base(text)
        more, best = contained(text)
        for r in got[doc_id]:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, k, lo, hi, own)
            assert r.labels == ",".join(sorted(more | set(filter(None, own.split(",")))))
            assert abs(r.score - best) < 1e-12


def test_query_on_documents(spark):
    docs = [(d.doc_id, d.text) for d in read(spark, SF_SMALL, "documents").collect()]
    check(REGISTRY["op3_licenses"](spark, SF_SMALL).collect(), docs)


DOCS = [
    (1, None), (2, ""), (3, "MIT License mit-license MIT\nLICENSE"), (4, "Released under the MIT License."),
    (5, "Released under the BSD License."), (6, "x " * 400 + "Licensed under CC BY-NC 4.0. " + "y " * 400),
    (7, "licensed under the apache license version 2"), (8, "a mit licenseb, General  Public # License"),
    (9, "Ünder the MİT License K mit license"), (10, "word " * 30000), (11, "\x00mit\x7flicense\x00"),
    (12, " ".join(licenses.TEMPLATES[10][1].split()[:24])), (13, "!!! ###"),
]


def test_planted_lines_and_edges(spark):
    df = spark.createDataFrame(DOCS + [DOCS[3]], "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("id", "t", "w", "raw", "label", "template", "tokens", "line", "size", "least", "ranks", "x", "own", "r", "n", "text_hash")})
    rows = licenses.scan_licenses(df).collect()
    assert len(rows) == len(DOCS) + 1
    check(rows, DOCS)
    by = {r.doc_id: r for r in rows}
    assert by[4].labels == "mit" and by[5].labels == "" and by[6].labels == "cc-by-nc" and by[3].n_base == 3
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_wrapped_notices_are_found_and_scattered_words_are_not(spark):
    """Every template wrapped at 40 and 72 columns, with comment marks, between lines of other text."""
    other = "\n".join(" ".join(f"w{i}{j}" for j in range(11)) for i in range(30))
    rows, want = [], {}
    for no, (label, t) in enumerate(licenses.TEMPLATES):
        for width in (40, 72):
            for mark in ("", "# ", " * "):
                doc_id = len(rows)
                rows.append((doc_id, other[no:] + "\n" + "\n".join(mark + x for x in textwrap.wrap(t, width, break_long_words=False)) + "\n" + other))
                want[doc_id] = label
    gaps = " ".join(f"x{i}" for i in range(9))
    apart = [(1000 + no, f" {gaps} ".join(t.split())) for no, (_, t) in enumerate(licenses.TEMPLATES)]
    df = spark.createDataFrame(rows + apart, "doc_id long, text string")
    out = licenses.scan_licenses(df).collect()
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in out}
    assert all(want[d] in got[d] for d in want) and all(r.score == 1.0 for r in out if r.doc_id in want)
    assert all(not got[d] for d, _ in apart)
    check(out, rows + apart)


def test_no_python_in_the_plan(spark):
    p = licenses.scan_licenses(read(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", p)


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit(1) for c in ("id", "d", "rid", "value", "body", "first_id", "record_id")})


def want_captures(rows):
    first, out = {}, {}
    for page, _, html in sorted(rows, key=lambda r: r[0]):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        source = first.setdefault(digest, page) if len(data) >= 100 else page
        out[page] = (len(data), digest, "response" if source == page else "revisit", None if source == page else source)
    return out


def test_captures_with_copies_nulls_and_hostile_text(spark):
    long_text = "é" * 60 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(10, "http://a/", long_text), (3, "http://b/\r\nX: y", long_text), (4, None, None), (5, "u", ""), (6, "u", "short"),
            (7, "u", "short"), (8, "http://c", "x" * 99), (9, "http://c", "x" * 99), (11, "u: v", "x" * 100),
            (12, "u", "x" * 100), (13, "u", "\x00\r\n" * 40000)]
    got = warc.captures(pages(spark, rows)).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want_captures(rows)
    for r in got:
        assert r.request.record_id != r.response.record_id != r.metadata.record_id
        assert r.request.block_bytes > 0 and r.metadata.block_bytes > 0
    assert warc.captures(pages(spark, [])).count() == 0


def test_null_and_repeated_page_ids(spark):
    """Every row of the pages is one capture, whatever its id."""
    x, y = "x" * 120, "y" * 120
    rows = [(1, "u", x), (1, "u", x), (1, "v", x), (2, "u", x), (2, "u", x), (3, None, x), (1, "u", y), (2, None, y), (None, "u", x),
            (None, "u", x), (None, None, None), (9, "u", "short"), (9, "u", "short")]
    got = warc.captures(pages(spark, rows)).collect()
    want = [(p, len(h or ""), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if p in (2, 3) else "response",
             1 if p in (2, 3) else None) for p, _, h in rows]
    order = lambda t: tuple(str(v) for v in t)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=order) == sorted(want, key=order)
    assert len({r.response.record_id for r in got}) == len(rows) and all(r.request and r.metadata for r in got)


def test_query_on_pages(spark):
    rows = [(p.page_id, p.url, p.html) for p in read(spark, SF_SMALL, "pages").collect()]
    got = REGISTRY["op4_warc"](spark, SF_SMALL).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want_captures(rows)


def test_large_and_cut_archives(spark, tmp_path):
    rows = [(i, f"http://p/{i}", f"<p>{i}</p>" + "z" * 3000) for i in range(700)]
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, rows), path)
    recs = warc.read_archives(spark, path, with_block=True)
    blocks = {r.page_id: bytes(r.block).decode() for r in recs.where("record_type = 'response'").collect()}
    assert blocks == {i: h for i, _, h in rows}
    assert recs.count() == 3 * len(rows)
    raw = next((tmp_path / "warc").glob("*.gz")).read_bytes()
    data = zlib.decompress(raw, 31)
    with pytest.raises(ValueError):
        list(warc.parse_records(data[:-7]))


def test_assembly_takes_missing_parts(spark):
    recs = spark.createDataFrame(
        [("r1", "response", None, 1), ("q1", "request", "r1", None), ("r2", "revisit", None, 2), ("m9", "metadata", "gone", None)],
        "record_id string, record_type string, concurrent_to string, page_id long")
    recs = recs.withColumns({c: F.lit(None).cast("string") for c in ("refers_to_id", "target_uri", "declared_digest", "block_digest")}
                            | {"block_bytes": F.lit(1).cast("long"), "block": F.lit(None).cast("binary")})
    got = {r.page_id: r for r in warc.assemble(recs).collect()}
    assert got[1].request.record_id == "q1" and got[1].metadata is None and got[2].request is None
