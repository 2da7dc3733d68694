"""Operators 6 and 10: exact statistics, learned lists, held-out accuracy, edge cases."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from arenaspark.llm import langid, quality
from arenaspark.llm.common import read
from arenaspark.llm.queries import REGISTRY
from conftest import SF_MID, SF_SMALL


def counts(text):
    x = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", x)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(covered))


def row(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)


def test_query_on_documents(spark):
    got = {r.doc_id: r for r in REGISTRY["op6_quality"](spark, SF_SMALL).collect()}
    docs = read(spark, SF_SMALL, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        r, want = got[d.doc_id], counts(d.text)
        assert row(r) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


TEXTS = [None, "", "  \n\t", "a", "one two three four five six seven eight", "a b c d e f g h a b c d e f g h",
         "x y " * 20, "l1 w\nl1 w\n\n\n l1 w\nl1 w", "é#|<> \x1c \xa0 z", "w " * 25000, "q " + "a b c d e f g h i " * 2 + "a b c d e f g h"]


def test_statistics_edges(spark):
    rows = list(enumerate(TEXTS)) + [(4, TEXTS[4]), (None, "null id " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("id", "t", "w", "h", "h8", "n", "raw", "win", "again", "twice", "n_words", "quality", "bad")})
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (99, 1)], "doc_id long, quality int")
    out = quality.quality_verdicts(df, labels).collect()
    assert len(out) == len(rows)
    for r in out:
        assert row(r) == counts("null id " * 9 if r.doc_id is None else TEXTS[r.doc_id])
    assert quality.quality_verdicts(df.limit(0), labels.limit(0)).count() == 0
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in out)


def learned(spark, n, seed):
    """Texts of two kinds with labels: many symbols are poor, a few wrong labels."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        poor = i % 4 == 0
        words = ["w" + "".join(rng.choice(list("abcdefgh"), 4)) + ("###" if poor and rng.random() < 0.8 else "") for _ in range(40)]
        rows.append((i, " ".join(words), int(not poor) if rng.random() > 0.01 else int(poor)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_rules_are_learned_and_generalise(spark):
    train, test = learned(spark, 800, 1), learned(spark, 400, 2)
    rules = quality.learn_rules(quality.statistics(train), train.select("doc_id", "quality"))
    assert rules and all(1 <= len(r) <= quality.MAX_CONDITIONS for r in rules)
    assert {f for r in rules for f, _, _ in r} <= set(quality.FEATURES)
    got = quality.statistics(test).select("id", quality.decision_list(rules).alias("kept")).collect()
    assert sum(r.kept == (r.id % 4 != 0) for r in got) >= 0.98 * len(got)
    only_good = train.where("quality = 1").select("doc_id", "quality")
    assert quality.learn_rules(quality.statistics(train), only_good) == []


def test_clean_labelled_documents_stay(spark):
    v = REGISTRY["op6_quality"](spark, SF_MID).join(read(spark, SF_MID, "labels"), "doc_id").where("not base_failed")
    good, kept = v.where("quality = 1").agg(F.count("*"), F.count_if("kept")).first()
    assert kept >= 0.98 * good


def test_no_python_in_the_plan(spark):
    df = quality.quality_verdicts(read(spark, SF_SMALL, "documents"), read(spark, SF_SMALL, "labels"))
    stats = quality.statistics(read(spark, SF_SMALL, "documents"))
    for x in (df, stats):
        assert not re.search("Python|Pandas|Arrow", x._jdf.queryExecution().executedPlan().toString())


def test_held_out_accuracy(spark):
    docs = read(spark, SF_MID, "documents").select("doc_id", "lang")
    got = REGISTRY["op10_language"](spark, SF_MID)
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0.0 <= r.score <= 1.0
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_held_out_labels_are_not_learned_from(spark):
    rows = [(i, "the house and the garden were there " * 3 if i % 2 else "der hund und die katze waren nicht hier " * 3,
             "en" if i % 2 else "de") for i in range(60)]
    rows = [(i, t, "wrong" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df).collect()}
    assert all(got[i] == ("en" if i % 2 else "de") for i in range(60))


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !? ", "en"), (4, "hello there", None), (None, "hello there", "en"),
            (6, "a " * 40000, "en"), (6, "a " * 40000, "en"), (8, "日本語", "ja"), (9, "\U0001d400", "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit(1) for c in ("id", "label", "vector", "has_letter", "held_out", "score")})
    out = langid.identify(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0.0
    assert by[None].held_out is False and by[8].lang_pred != "und"
    assert langid.identify(df.limit(0)).count() == 0
    unlabelled = langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_trigram_vectors_bind_and_permute():
    v = langid.trigram_vectors()
    assert v.shape == (langid.ALPHABET ** 3, langid.DIMENSIONS) and set(np.unique(v[1:])) == {-1, 1}
    abc, cba = ((1 * 48 + 2) * 48 + 3), ((3 * 48 + 2) * 48 + 1)
    assert abs(int(v[abc].astype(int) @ v[cba].astype(int))) < 0.3 * langid.DIMENSIONS  # order matters
    a, letter = langid.document_vector("Ab")
    b, _ = langid.document_vector(" ab ")
    assert letter and np.allclose(a, b)


def test_only_letters_count_as_letters():
    """Emoji and digits beyond the basic plane are no letters; letters there are."""
    for text in ("😀😃 🚀", "𝟘𝟙𝟚 12", "🀄🂡", "\U0010fffd", " .,"):
        assert langid.document_vector(text) == (None, False)
    for text in ("𝒜𝒷𝒸", "𐍈𐌰", "😀 a", "é"):
        assert langid.document_vector(text)[1]
