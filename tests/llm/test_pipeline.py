"""The pipeline against a brute-force version of its stages."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from arenaspark.llm import packing, pii, simhash, tokens
from arenaspark.llm.common import read
from arenaspark.llm.queries import REGISTRY
from conftest import SF_MID, SF_SMALL


def brute(spark):
    """Kept documents and their masked texts."""
    verdict = {r.doc_id: r.kept for r in REGISTRY["op6_quality"](spark, SF_SMALL).collect()}
    docs = {d.doc_id: d.text for d in read(spark, SF_SMALL, "documents").collect() if verdict[d.doc_id]}
    fps = {i: simhash.fingerprint(t) for i, t in docs.items()}
    left, keep = sorted(fps), set()
    while left:  # flood each class from its smallest id
        seen, todo = {left[0]}, [left[0]]
        while todo:
            x = todo.pop()
            near = {y for y in left if y not in seen and (fps[x] ^ fps[y]).bit_count() <= 3}
            seen |= near
            todo += near
        keep.add(left[0])
        left = [y for y in left if y not in seen]
    leaks = {r.doc_id for r in REGISTRY["op8_decontamination"](spark, SF_SMALL).collect()}
    return {i: pii.mask_text(docs[i], pii.scan(docs[i])[1]) for i in keep - leaks}


def test_run_equals_brute_force(spark):
    want, tok = {}, Tokenizer.from_file(tokens.public_tokenizer("byte_bpe_50k.json"))
    for i, t in brute(spark).items():
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        for p, (s, n) in enumerate([(0, first)] + [(s, 2048) for s in range(first, len(ids), 2048)]):
            want[(i, p)] = (s, n, zlib.crc32(ids[s:s + n].tobytes()))
    got = P.run(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)


def test_stages_keep_the_columns_of_documents(spark):
    docs = read(spark, SF_SMALL, "documents")
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "best_fit_packing"]
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_and_odd_tables(spark, k):
    docs = read(spark, SF_SMALL, "documents")
    assert P.STAGES[k][1](spark, docs.limit(0), SF_SMALL).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0),
                                 (None, "x " * 30, "en", "s", 60), (5, "word " * 20000, "en", "s", 100000)], docs.schema)
    assert P.STAGES[k][1](spark, odd, SF_SMALL).count() >= 0


def test_workers_get_small_batches(spark):
    """A written stage sends its rows to the Python workers in small batches, and the session keeps its setting."""
    from arenaspark.llm.common import BATCH_ROWS, shared_table

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    got = shared_table(spark.range(0, 9000, 1, 1).mapInArrow(rows, "n long"), "batches").collect()
    assert sum(r.n for r in got) == 9000 and max(r.n for r in got) <= BATCH_ROWS and spark.conf.get(name) == before


def test_small_slices_pack_alike(spark):
    docs = read(spark, SF_MID, "documents").limit(200).coalesce(1)
    want, got = ({tuple(r) for r in packing.pack(docs, slice_bytes=n).collect()} for n in (1 << 22, 1 << 12))
    assert got == want and want
