"""Operators 8 and 9 against brute force, and their edge cases."""

import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arenaspark.llm import decontam, passages
from arenaspark.llm.common import read
from arenaspark.llm.queries import REGISTRY
from conftest import SF_MID

ITEM = ("Anna buys 12 apples and 5 pears at the market for 30 dollars. How many pieces of fruit does Anna carry home "
        "when her brother Tom eats 3 apples on the way?")
SWAPPED = ("Maria buys 40 apples and 9 pears at the market for 75 euros. How many pieces of fruit does Maria carry home "
           "when her brother Luke eats 11 apples on the way?")
MIXED = ("Maria buys 40 apples and 9 pears at the market for 75 euros. How many pieces of fruit does Peter carry home "
         "when her brother Paul eats 11 apples on the way? " * 1)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("key", "item", "item_id", "h", "pos", "n", "k", "i", "copy_id", "twice_id", "leak_id", "poor_id", "seed", "place", "a", "b", "words", "n_words")})


def test_template_tokens():
    t = decontam.template_tokens
    assert t("5km,") == [("\x00num", "5"), ("\x00unit", "km")] and t("$1,200.50") == [("\x00num", "1,200.50")]
    assert t("Seven") == [("\x00num", "seven")] and t("Anna's") == [("\x00name", "anna's")] and t("LOUD") == [("loud", None)]
    assert t("...") == [] and t("hours") == [("\x00unit", "hours")] and t("word.") == [("word", None)]


def test_reparameterised_items_are_caught(spark):
    bench = spark.createDataFrame([(7, ITEM), (8, None), (9, "Too short"), (10, "")], "item_id long, text string")
    noise = "some other words that stand before and after it all "
    rows = [(1, noise + ITEM + " " + noise), (2, noise + SWAPPED), (3, noise * 5), (4, None), (5, ""), (6, "apples and pears at the market"),
            (11, noise + ITEM), (11, noise + ITEM), (None, ITEM), (12, " ".join([ITEM] * 300))]
    out = decontam.contaminated(docs(spark, rows), bench).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == 5 and set(got) == {1, 2, 11, None, 12}
    assert got[1].verbatim and got[1].consistency == 1.0 and not got[2].verbatim and got[2].item_id == 7
    kept = decontam.drop_contaminated(docs(spark, rows), bench)
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5, 6} and kept.columns == docs(spark, rows).columns
    assert decontam.contaminated(docs(spark, rows).limit(0), bench).count() == 0
    assert decontam.contaminated(docs(spark, rows), bench.limit(0)).count() == 0


def test_each_occurrence_is_checked_by_itself(spark):
    """A document with an item twice or more, each time with other values, is as contaminated as with one copy."""
    third = ITEM.replace("Anna", "Olga").replace("12", "70").replace("30", "8").replace("Tom", "Ivo")
    noise = "some other words that stand before and after it all "
    rows = [(1, ITEM + " " + noise + SWAPPED), (2, " ".join([SWAPPED, third])), (3, " ".join([SWAPPED, third, ITEM]) + noise),
            (4, ITEM), (4, SWAPPED), (5, noise)]
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    got = {r.doc_id: (r.verbatim, r.consistency) for r in decontam.contaminated(docs(spark, rows), bench).collect()}
    assert got == {1: (True, 1.0), 2: (False, 1.0), 3: (True, 1.0), 4: (True, 1.0)}


def test_inconsistent_slots_are_no_match(spark):
    item = "Anna met Anna and Anna saw Anna while Anna told Anna that Anna and Anna went with Anna to see Anna there again"
    names = iter("Bob Carl Dora Emil Fred Gina Hans Ida Jon Kurt Lea Max".split())
    mixed = " ".join(next(names) if w == "Anna" else w for w in item.split())
    same = item.replace("Anna", "Zoe")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontam.contaminated(docs(spark, [(1, mixed), (2, same)]), bench)
    assert [r.doc_id for r in got.collect()] == [2]


def test_items_without_literals_and_copies_in_other_letters(spark):
    """Lists of names, arithmetic and short items as they stand, copies without capitals or all in capitals."""
    sums = "12 + 7 = 19, 30 - 4 = 26, 5 x 8 = 40, 81 / 9 = 9, 14 + 14 = 28"
    names = ("Paris London Berlin Madrid Rome", "Anna Ben Carl Dora Emil Fred Gina Hans Ida Jon Kurt Lea")
    bench = spark.createDataFrame([(1, names[0]), (2, names[1]), (3, sums), (4, ITEM), (5, "What is 5?")], "item_id long, text string")
    noise = "some other words that stand before and after it all "
    rows = [(1, noise + names[0] + " " + noise), (2, noise + names[1].lower()), (3, sums + " " + noise), (4, noise + ITEM.lower()),
            (5, ITEM.upper() + noise), (6, "Rome Paris London Madrid Berlin"), (7, "Otto Emil Rosa Carl Nora Ben Vera Hans Mia Jon"),
            (8, "1 + 2 = 3, 4 - 1 = 3, 2 x 2 = 4, 6 / 2 = 3"), (9, "and what is 5 " + noise), (10, "what is 6 then")]
    got = {(r.doc_id, r.item_id): r.verbatim for r in decontam.contaminated(docs(spark, rows), bench).collect()}
    assert got == dict.fromkeys([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (9, 5)], True)


def test_window_hashes_are_equal_exactly_for_equal_windows():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 63, 4).astype(np.uint64)
    codes = words[rng.integers(0, 4, 3000)]
    for length in (1, 3, 8):
        h = decontam.window_hashes(codes, length)
        own = [tuple(codes[i:i + length].tolist()) for i in range(len(codes) - length + 1)]
        assert len(set(zip(h.tolist(), own))) == len(set(h.tolist())) == len(set(own))
        assert (decontam.window_hashes(codes[100:], length) == h[100:]).all()
    assert len(decontam.window_hashes(codes[:2], 3)) == 0


def test_reparameterised_questions_are_found(spark):
    """Recall over generated questions whose names, numbers and units are all exchanged: all of them, and no other."""
    rng = random.Random(8)
    verbs = words(rng, 400)

    def name():
        return "".join(rng.choices("abcdefgh", k=5)).title()

    def fill(parts):
        new = {}
        return " ".join(new.setdefault(p, name() if p[0] == "N" else str(rng.randint(2, 999))) if p[:1] in "N#" else p for p in parts)

    asked, rows = [], []
    for i in range(60):
        parts = rng.sample(verbs, 30)
        for at in sorted(rng.sample(range(30), 6)):
            parts[at] = rng.choice(["N1", "N2", "#1", "#2"])
        asked.append((i, fill(parts)))
        rows.append((i, " ".join(rng.sample(verbs, 40)) + " " + fill(parts) + " " + " ".join(rng.sample(verbs, 40))))
    bench = spark.createDataFrame(asked, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(spark, rows), bench).collect()}
    assert got == {(i, i) for i in range(60)}


def test_blocks_of_hashes_change_nothing(spark, monkeypatch):
    want = {(r.doc_id, r.item_id, r.n_matched) for r in REGISTRY["op8_decontamination"](spark, SF_MID).collect()}
    monkeypatch.setattr(decontam, "BLOCK_HASHES", 400)
    got = {(r.doc_id, r.item_id, r.n_matched) for r in REGISTRY["op8_decontamination"](spark, SF_MID).collect()}
    assert got == want and want


def test_query_finds_every_verbatim_passage(spark):
    import re
    norm = lambda s: " ".join(re.findall(r"\w+", (s or "").lower()))
    items = {b.item_id: norm(b.text) for b in read(spark, SF_MID, "benchmark").collect()}
    want = {(d.doc_id, i) for d in read(spark, SF_MID, "documents").select("doc_id", "text").collect()
            for t in [norm(d.text)] for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in REGISTRY["op8_decontamination"](spark, SF_MID).collect()}
    assert got == want


# ------------------------------------------------------------------ passages
def best_chain(matches):
    """Score of the best chain by trying all predecessors."""
    m, best = sorted(matches), []
    for j, (x, y, w) in enumerate(m):
        prev = [best[i] - passages.GAP_COST * (x - m[i][0] + y - m[i][1]) for i in range(j) if m[i][0] < x and m[i][1] < y]
        best.append(w + max([0.0, *prev]))
    return max(best, default=0.0)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=40))
def test_chains_are_optimal_and_ordered(points):
    matches = [(x, y, 5) for x, y in points]
    found = passages.chains(matches)
    assert sorted(m for c in found for m in c) == sorted(matches)
    for c in found:
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(c, c[1:]))
    if found:
        c = found[0]
        score = sum(w for *_, w in c) - passages.GAP_COST * sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(c, c[1:]))
        assert abs(score - best_chain(matches)) < 1e-9


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]


def test_align_finds_exact_and_fuzzy_passages():
    rng, hasher = random.Random(1), passages.WordHasher()
    p = words(rng, 70)
    fuzzy = [w if i % 9 else "changed" for i, w in enumerate(p)]
    fuzzy.insert(33, "added")
    for other, equal in ((p, 70), (fuzzy, 55)):
        a = hasher(" ".join(words(rng, 40) + p + words(rng, 25)))
        b = hasher(" ".join(words(rng, 90) + other + words(rng, 10)))
        found = passages.align(a, b)
        assert len(found) == 1
        x0, x1, y0, y1, same = found[0]
        assert abs(x0 - 40) <= 3 and abs(x1 - 110) <= 3 and abs(y0 - 90) <= 3 and same >= equal
    assert passages.align(hasher(" ".join(p[:40])), hasher(" ".join(p[:40]))) == []
    assert passages.align(hasher(""), hasher("a b")) == []


def test_seeds_cover_every_equal_run():
    rng = random.Random(2)
    run = words(rng, passages.SEED_WORDS + passages.SEED_WINDOW - 1)
    hasher = passages.WordHasher()
    for _ in range(30):
        sides = [set(passages.seeds(hasher(" ".join(words(rng, rng.randint(0, 30)) + run + words(rng, rng.randint(0, 30)))))[0].tolist())
                 for _ in range(2)]
        assert sides[0] & sides[1]


def exact_classes(texts, n=50):
    """Documents that share n words in a row with another, and their classes."""
    clean = lambda w: w.lower().strip(passages._MARKS) or w
    at = defaultdict(set)
    for i, t in texts.items():
        w = list(map(clean, (t or "").split()))
        for k in range(len(w) - n + 1):
            at[tuple(w[k:k + n])].add(i)
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    hit = set()
    for s in at.values():
        if len(s) > 1:
            hit |= s
            for y in s:
                a, b = find(min(s)), find(y)
                parent[max(a, b)] = min(a, b)
    return hit, {i: find(i) for i in hit}


def test_query_misses_no_exact_passage(spark):
    texts = {d.doc_id: d.text for d in read(spark, SF_MID, "documents").collect()}
    hit, root = exact_classes(texts)
    got = {r.doc_id: r for r in REGISTRY["op9_passages"](spark, SF_MID).collect()}
    assert hit and hit <= set(got)
    for i in hit:  # what brute force joins is joined here too
        assert got[i].class_id == got[root[i]].class_id
        assert got[i].n_links >= 1


def test_shared_passages_in_a_hot_group(spark):
    """One passage in very many documents, some of which hold only a part of it: nobody is missed."""
    rng = random.Random(5)
    p = words(rng, 60)
    rows, want = [], set()
    for i in range(400):
        part = p if i % 4 else p[(i % 30):(i % 30) + 30]
        rows.append((i, " ".join(words(rng, 60) + part + words(rng, 60))))
        want |= {i} if i % 4 else set()
    rows += [(1000 + i, " ".join(words(rng, 150))) for i in range(100)]
    rows += [(2000, None), (2001, ""), (2002, " ".join(p)), (2002, " ".join(p)), (2003, "a " * 30000), (None, " ".join(words(rng, 80)))]
    got = {r.doc_id: r for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert want <= set(got) and not any(k is not None and 1000 <= k < 2000 for k in got)
    assert {got[i].class_id for i in want} == {min(want)} and got[2002].n_copies == 2
    assert not {i for i in range(0, 400, 4)} & set(got)
    assert passages.repeated_passages(docs(spark, []).limit(0)).count() == 0


def test_copies_are_links(spark):
    rng = random.Random(8)
    long, short = " ".join(words(rng, 55)), " ".join(words(rng, 20))
    rows = [(5, long), (3, long), (9, long), (1, short), (2, short)]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies, r.spans) for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert got == {i: (3, 2, 3, "0:55") for i in (3, 5, 9)}


def test_longer_passages_behind_a_very_common_line(spark):
    """A line that very many documents hold is no passage; the few that share more around it are found."""
    rng = random.Random(11)
    line, tail = words(rng, 40), words(rng, 15)
    rows = [(i, " ".join(words(rng, 45) + line + (tail if i % 6 == 3 else []) + words(rng, 45))) for i in range(180)]
    got = {r.doc_id: r.class_id for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert got == {i: 3 for i in range(180) if i % 6 == 3}


def test_passages_of_one_chain_are_told_apart():
    """A common header and footer around own content: both are passages, whatever lies between."""
    rng, hasher = random.Random(21), passages.WordHasher()
    for n, gap in ((60, 40), (60, 100), (60, 150), (200, 120), (200, 500), (200, 30)):
        head, foot = words(rng, n), words(rng, n)
        a = hasher(" ".join(words(rng, 20) + head + words(rng, gap) + foot + words(rng, 20)))
        b = hasher(" ".join(words(rng, 35) + head + words(rng, gap + 3) + foot + words(rng, 5)))
        inside = np.zeros(len(a), bool)
        for x0, x1, y0, y1, equal in passages.align(a, b):
            assert min(x1 - x0, y1 - y0) >= passages.MIN_WORDS and equal >= passages.MIN_IDENTITY * max(x1 - x0, y1 - y0)
            inside[x0:x1] = True
        assert inside[20:20 + n].all() and inside[20 + n + gap:20 + 2 * n + gap].all()


def test_middle_holders_of_a_common_line_meet(spark):
    """Two documents share more than a very common line, and neither is an end holder of the line's seeds."""
    rng = random.Random(31)
    line = words(rng, 45)
    rows, pairs = [(i, " ".join(words(rng, 45) + line + words(rng, 45))) for i in range(150)], []
    for i in range(1000, 1040, 2):
        tail = words(rng, 10)
        pairs.append((i, i + 1))
        rows += [(j, " ".join(words(rng, 45) + line + tail + words(rng, 45))) for j in (i, i + 1)]
    got = {r.doc_id: r.class_id for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert got == {j: i for i, k in pairs for j in (i, k)}


def test_group_sizes_are_links(spark):
    """Windows that more than a few texts hold are links of all their holders, though only one of them is paired."""
    rng = random.Random(32)
    line, tail = words(rng, 45), words(rng, 6)
    rows = [(i, " ".join(words(rng, 45) + line + (tail if i % 6 == 3 else words(rng, 6)) + words(rng, 45))) for i in range(240)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert got == {i: (3, 39) for i in range(3, 240, 6)}


def test_pairs_of_texts_that_repeat_a_seed_stay_in_proportion(spark):
    """60 texts that hold one seed 30 times: a row per text meets a row per text, the pairs and their places are those of all places."""
    rows = [(k, s, p) for k in range(60) for s, p in [(7, 10 * i + k) for i in range(30)] + [(100 + k // 2, 5)]]
    own = spark.createDataFrame(rows, "key bigint, seed bigint, place int")
    got = {(r.a, r.b): (r.a0, r.a1, r.b0, r.b1) for r in passages._pair_rows(own, passages._end_holders(own)).collect()}
    ends = {7: {0, 59}} | {100 + i: {2 * i, 2 * i + 1} for i in range(30)}
    places: dict = {}
    for k, s, p in rows:
        places.setdefault(s, {}).setdefault(k, []).append(p)
    want: dict = {}
    for s, held in places.items():
        for a in held:
            for b in held:
                if a < b and (a in ends[s] or b in ends[s]):
                    x = want.setdefault((a, b), ([], []))
                    x[0].extend(held[a])
                    x[1].extend(held[b])
    least = passages.MIN_SEED_SPAN // 2
    want = {k: (min(x), max(x), min(y), max(y)) for k, (x, y) in want.items()
            if max(x) - min(x) + passages.SEED_WORDS >= least and max(y) - min(y) + passages.SEED_WORDS >= least}
    assert got == want


def test_no_link_of_widely_held_seeds_is_left_out(spark):
    """A common line with two of ten common phrases behind it: only equal pairs of phrases make a passage, and the end
    holders of every seed mostly have other ones."""
    rng, hasher = random.Random(4), passages.WordHasher()
    line, first, second = words(rng, 30), [words(rng, 14) for _ in range(5)], [words(rng, 14) for _ in range(5)]
    rows = []
    for i in range(300):
        part = [*line, *rng.choice(first), *rng.choice(second)]
        for at in rng.sample(range(10, 44), 2):
            part[at] = words(rng, 1)[0]
        rows.append((i, " ".join(words(rng, 90) + part + words(rng, 90))))
    coded = [hasher(t) for _, t in rows]
    at = [dict(zip(*(x.tolist() for x in passages.seeds(c)[:2]))) for c in coded]
    held = Counter(h for own in at for h in own)
    at = [{h: k for h, k in own.items() if held[h] > 1} for own in at]  # by rule, in a cluster wide enough for a passage
    at = [{h: k for (h, k), keep in zip(own.items(), passages.dense(np.array(list(own.values())))) if keep} for own in at]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            same = at[i].keys() & at[j].keys()
            if same and all(max(s[h] for h in same) - min(s[h] for h in same) >= 15 for s in (at[i], at[j])):
                if passages.align(coded[i], coded[j]):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    want = defaultdict(set)
    for i in range(len(rows)):
        want[find(i)].add(i)
    want = {frozenset(s) for s in want.values() if len(s) > 1}
    got = defaultdict(set)
    for r in passages.repeated_passages(docs(spark, rows)).collect():
        got[r.class_id].add(r.doc_id)
        assert r.class_id >= 0 and r.n_links >= 1
    assert len(want) >= 20 and all(any(w <= g for g in got.values()) for w in want)


def test_every_text_of_a_class_has_the_same_number_of_links(spark):
    rng = random.Random(80)
    p = words(rng, 120)
    rows = [(i, " ".join(words(rng, 30) + [w if rng.random() > 0.05 else "changed" for w in p] + words(rng, 30))) for i in range(80)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert got == {i: (0, 79) for i in range(80)}


def test_only_texts_with_far_seeds_in_common_meet(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(s, f"t{t:02d}", 100 + 6 * s, 100 + 6 * s, t // 2, False) for t in range(40) for s in (0, 1)]  # a short line of all
    for t in range(40):
        for s in rng.sample(range(2, 40), 5):
            at = rng.randrange(60, 160)
            rows.append((s, f"t{t:02d}", at, at + rng.choice((0, 0, 12)), t // 2, rng.random() < 0.1))
    held = spark.createDataFrame(rows, "seed long, a string, a0 int, a1 int, class long, open boolean")
    texts = defaultdict(dict)
    for s, a, lo, hi, c, o in rows:
        texts[a][s] = (lo, hi, c, o)

    def far(own, seeds):
        return max(own[s][1] for s in seeds) - min(own[s][0] for s in seeds) >= 10

    names, due, short = sorted(texts), set(), set()
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            both = [s for s in texts[a] if s in texts[b] and (texts[a][s][2] != texts[b][s][2] or texts[a][s][3] or texts[b][s][3])]
            if both and far(texts[a], both) and far(texts[b], both):
                due.add((a, b))
            if set(both) == {0, 1}:
                short.add((a, b))
    assert due and short
    for most in (64, 3):  # 3: texts of more seeds meet all holders
        monkeypatch.setattr(passages, "MANY_SEEDS", most)
        found = {tuple(r) for r in passages._far_pairs(held, 10).collect()}
        assert due <= found
        if most == 64:
            assert not found & short
