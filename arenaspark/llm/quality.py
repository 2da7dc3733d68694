"""Quality rules: text statistics and a learned decision list (operator 6, native).

Statistics are array and string expressions on each row, nothing is shuffled.
Rules are learned by sequential covering from labelled statistics: a rule grows
by adding the threshold condition with the best information gain on the growing
part of the labels, is pruned on the other part to the prefix with the best
precision balance, and is kept while its precision there is high; what it covers
is taken out and the next rule starts. Each step is one aggregate over all
labelled rows (counts per feature and bin), so only a few hundred counts reach
the driver, however many labels there are. The list becomes one ordered Spark
conditional expression.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenaspark.llm.common import WORD_SPACE, shared_table, small_side

WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
BINS = 32
MAX_RULES, MAX_CONDITIONS = 8, 3
MIN_PRECISION, MIN_COVER = 0.9, 8

FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
            "upper_share", "shout_share")


def _pair_up(h: Column, shift: int, n: Column) -> Column:
    """Hash of h[i] and h[i + shift] for the first n places."""
    return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(1 + shift), n), lambda a, b: F.xxhash64(a, b))


def _covered(p: Column) -> Column:
    """Words covered by windows that start at the ascending places ``p``."""
    return F.when(F.size(p) == 0, F.lit(0)).otherwise(
        WINDOW + F.aggregate(
            F.zip_with(F.slice(p, F.lit(2), F.size(p)), F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))),
                       lambda b, a: F.least(b - a, F.lit(WINDOW))),
            F.lit(0), lambda s, x: s + x))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_hash, the contract's counts and the features.

    Null and empty texts have zero counts. Windows are compared as hashes first; only where two
    hashes of a text agree are the windows themselves compared."""
    a = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("t")).select("*", F.split("t", WORD_SPACE).alias("raw"))
    skip = F.when(F.get("raw", F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size("raw") > 1) & (F.element_at("raw", -1) == ""), 1).otherwise(0)
    a = a.select("id", "text_hash", "t", F.slice("raw", 1 + skip, F.size("raw") - skip - tail).alias("w"))
    a = a.select("*", F.size("w").alias("n"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    room = lambda k: F.greatest(F.col("n") - k, F.lit(0))
    a = a.select("*", F.size(F.array_distinct("h")).alias("n_distinct"),
                 _pair_up(_pair_up(_pair_up(F.col("h"), 1, room(1)), 2, room(3)), 4, room(7)).alias("h8"))
    a = a.select("*", (F.size(F.array_distinct("h8")) < F.size("h8")).alias("again"))
    windows = F.array_sort(F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), lambda i: F.struct(
        F.get("h8", i).alias("h"), F.array_join(F.slice("w", i + 1, F.lit(WINDOW)), " ").alias("s"), i.alias("i"))))
    a = a.select("*", F.when(F.col("again"), windows).alias("win"))
    same = lambda x, k: F.get("win", k)["s"].eqNullSafe(x["s"])
    twice = F.array_sort(F.transform(F.filter("win", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    a = a.select(
        "id", "text_hash", F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).alias("n_lines"), "n_distinct", "again", twice.alias("twice"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}+", ""))).alias("n_upper"),
        (F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit("")))).alias("n_shout"))
    a = a.select("*", F.when(F.col("again"), _covered(F.col("twice"))).otherwise(0).cast("long").alias("n_repeat_words"))
    per = lambda x, of: F.when(F.col(of) > 0, F.col(x) / F.col(of)).otherwise(0.0)
    return a.select(
        "id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per("word_chars", "n_words").alias("mean_word"), per("n_symbols", "word_chars").alias("symbol_share"),
        per("n_dup_lines", "n_lines").alias("dup_line_share"), per("n_repeat_words", "n_words").alias("repeat_share"),
        per("n_distinct", "n_words").alias("distinct_share"), per("n_upper", "word_chars").alias("upper_share"),
        per("n_shout", "n_words").alias("shout_share"))


Condition = tuple[str, str, float]  # feature, ">" or "<=", threshold
Rule = list[Condition]


def condition_column(c: Condition) -> Column:
    f, op, at = c
    return F.col(f) > F.lit(at) if op == ">" else F.col(f) <= F.lit(at)


def rule_column(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, map(condition_column, rule))


def decision_list(rules: list[Rule]) -> Column:
    """Ordered conditional: false at the first rule that fires, true when none does."""
    out = F
    for rule in rules:
        out = out.when(rule_column(rule), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Add the condition of the best gain until none of the other class is left or no condition gains."""
    rule: Rule = []
    while len(rule) < MAX_CONDITIONS:
        left = rows.where(rule_column(rule)) if rule else rows
        cells = F.inline(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"bin_{f}").alias("b")) for f in cuts]))
        hist: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in cuts}
        for r in left.select("bad", cells).groupBy("f", "b").agg(F.sum("bad").alias("p"), F.count("*").alias("n")).collect():
            hist[r["f"]][r["b"]] = (r["p"], r["n"] - r["p"])
        p0, n0 = (sum(x) for x in zip((0, 0), *next(iter(hist.values())).values()))
        if not p0 or (rule and not n0):
            break
        best, choice = 1e-9, None
        for f, at in cuts.items():
            p = n = 0
            for b, cut in enumerate(at):  # bin b holds the values above cut b-1 up to cut b
                dp, dn = hist[f].get(b, (0, 0))
                p, n = p + dp, n + dn
                for gain, c in ((_gain(p, n, p0, n0), (f, "<=", cut)), (_gain(p0 - p, n0 - n, p0, n0), (f, ">", cut))):
                    if gain > best:
                        best, choice = gain, c
        if choice is None:
            break
        rule.append(choice)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of ``rule`` with the best (p - n) / (p + n) on ``rows``, and its p and n."""
    parts = [rule_column(rule[:k]) for k in range(1, len(rule) + 1)]
    got = rows.agg(*[F.coalesce(F.sum(F.when(c & (F.col("bad") == v), 1).otherwise(0)), F.lit(0)).alias(f"c{k}_{v}")
                     for k, c in enumerate(parts) for v in (0, 1)]).first()
    scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n)
              for k, (p, n) in enumerate((got[f"c{k}_1"], got[f"c{k}_0"]) for k in range(len(parts)))]
    _, k, p, n = max(scored)
    return rule[:1 - k], p, n


def learn_rules(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                features: tuple[str, ...] = FEATURES) -> list[Rule]:
    """Rules that reject, in order. ``labels``: 0 is poor; null labels are left out; of several labels
    of one id the smallest counts. Without labels of both classes there is no rule."""
    own = labels.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("q")).where("q is not null")
    rows = shared_table(stats.join(own, "id").select(
        "id", *features, F.when(F.col("q") == 0, 1).otherwise(0).alias("bad")), "labelled")
    points = [i / BINS for i in range(1, BINS)]
    marks = rows.groupBy("bad").agg(*[F.percentile_approx(f, points, 1000).alias(f) for f in features]).collect()
    if len(marks) < 2:
        return []
    seen = {f: sorted({float(v) for r in marks for v in r[f]}) for f in features}
    # thresholds lie halfway between neighbouring quantiles, so that a rule keeps a margin to what it separates
    cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in seen.items() if len(v) > 1}
    if not cuts:
        return []
    below = lambda f: lambda c: c < F.col(f)
    binned = [F.size(F.filter(F.array(*map(F.lit, at)), below(f))).alias(f"bin_{f}") for f, at in cuts.items()]
    rows = shared_table(rows.select("*", *binned, (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("pruning")), "labelled-binned")
    rules: list[Rule] = []
    for _ in range(MAX_RULES):
        open_rows = rows.where(decision_list(rules)) if rules else rows
        rule = _grow(open_rows.where("not pruning"), cuts)
        if not rule:
            break
        rule, p, n = _prune(open_rows.where("pruning"), rule)
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
    return rules


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts, base_failed, kept (and text_hash, which tells rows of one id apart).

    Null text has no words, so it fails the base rule. Repeated rows and null ids pass through (a null id has
    no label); an empty table gives an empty result; other columns are not read."""
    stats = shared_table(statistics(docs, id_col, text_col), "statistics")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rules = learn_rules(stats.where(~failed), labels, id_col)
    return stats.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & decision_list(rules)).alias("kept"), "text_hash")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the base rule or a learned rule rejects."""
    poor = (quality_verdicts(docs, labels, id_col, text_col).where("not kept")
            .select(F.col(id_col).alias("poor_id"), F.col("text_hash").alias("poor_hash")).distinct())
    poor = small_side(shared_table(poor, "rejected"), 1_000_000)
    on = docs[id_col].eqNullSafe(poor["poor_id"]) & (F.xxhash64(docs[text_col]) == poor["poor_hash"])
    return docs.join(poor, on, "left_anti")
