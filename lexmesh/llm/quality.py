"""Quality rules: ordered threshold conjunctions learned by sequential covering.

All text statistics are DataFrame expressions. The rules are learned on a
bounded sample of labelled statistics (`sample_rows`, a parameter): each rule is
grown condition by condition on one part of the sample by FOIL's information
gain, pruned from its end on the other part, and kept while it is precise there;
the examples that it covers are then set aside (Fuernkranz and Widmer, 1994;
Cohen, 1995). The result is one conditional expression that Spark evaluates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample

#: White space of the word definition, and the counted symbols.
SPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that rules may test: shares and means that don't drift with a text's length.
TESTED = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "digit_share", "line_words"]


def _repeat_words(grams: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice; grams holds a hash per window."""

    def covered(pairs: Column) -> Column:
        hits = F.filter(pairs, lambda x, k: (F.coalesce(F.get(pairs, k - 1)["h"] == x["h"], F.lit(False))) | (F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False))))
        at = F.sort_array(F.transform(hits, lambda x: x["i"]))
        # let-binding: the sorted positions are computed once
        steps = F.transform(F.array(at), lambda p: F.aggregate(p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"]))
        return F.get(steps, F.lit(0))

    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    whole = F.get(F.transform(F.array(pairs), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), whole).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, the five counts and the tested statistics of each text.

    A null or empty text has no words; its shares are 0. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))
    a = docs.select(*keep, text.alias("_text"), words.alias("_words"), F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("_lines"))
    hashes = F.transform(F.col("_words"), lambda w: F.xxhash64(w))
    b = a.select("*", hashes.alias("_hashes"), F.array_join("_words", "").alias("_solid"))
    grams = F.when(F.size("_words") < 3, F.array().cast("array<bigint>")).otherwise(F.slice(F.transform(F.col("_hashes"), lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2))), F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))))
    c = b.select("*", grams.alias("_grams"))
    n = F.size("_words").cast("long")
    chars = F.length("_solid").cast("long")
    kept_of = lambda gap: F.length(F.regexp_replace("_solid", gap, "")).cast("long")
    d = c.select(
        *keep,
        n.alias("n_words"),
        chars.alias("word_chars"),
        kept_of(NOT_SYMBOL).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_grams")).cast("long").alias("n_repeat_words"),
        kept_of("[^A-Z]+").alias("_upper"),
        kept_of("[^!?]+").alias("_marks"),
        kept_of("[^0-9]+").alias("_digits"),
        F.size("_lines").alias("_n_lines"),
    )
    per = lambda x, y: F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(y)), F.lit(0.0))
    return d.select(
        *keep,
        *COUNTS,
        per("word_chars", "n_words").alias("mean_word"),
        per("n_symbols", "word_chars").alias("symbol_share"),
        per("n_dup_lines", "_n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"),
        per("_upper", "word_chars").alias("upper_share"),
        per("_marks", "word_chars").alias("mark_share"),
        per("_digits", "word_chars").alias("digit_share"),
        per("n_words", "_n_lines").alias("line_words"),
    )


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.name)]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        return F.col(self.name) > F.lit(self.threshold) if self.above else F.col(self.name) <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def _grow(x: np.ndarray, y: np.ndarray, names: list[str], depth: int, steps: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < depth:
        p, n = int(y[inside].sum()), int(inside.sum())
        if p == 0 or p == n:
            break
        now, best = math.log2(p / n), (0.0, None)
        for k, name in enumerate(names):
            v = x[inside, k]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, steps + 2)[1:-1], method="lower"))
            for t in np.unique(np.concatenate([cuts, (cuts[1:] + cuts[:-1]) / 2])):
                for above in (True, False):
                    hit = v > t if above else v <= t
                    pp, nn = int(y[inside][hit].sum()), int(hit.sum())
                    if pp and (gain := pp * (math.log2(pp / nn) - now)) > best[0] + 1e-12:
                        best = (gain, Condition(name, above, float(t)))
        if best[1] is None:
            break
        found = best[1]
        v = x[inside, names.index(found.name)]
        gap = (v[v <= found.threshold].max(initial=-np.inf), v[v > found.threshold].min(initial=np.inf))
        if np.isfinite(gap).all():  # the middle of the gap, so that values near either side keep theirs
            found = Condition(found.name, found.above, float(sum(gap) / 2))
        rule.append(found)
        inside &= found.holds(x, names)
    return tuple(rule)


def learn_rules(x: np.ndarray, y: np.ndarray, names: list[str], most_rules: int = 12, depth: int = 4, steps: int = 48, precision: float = 0.9, least: int = 8) -> list[Rule]:
    """Ordered rules for y = 1 (bad). Every third example prunes; the others grow.

    No example, or none that is bad, gives no rules. A rule is kept if, on the
    pruning examples that earlier rules left, it covers some and is at least
    `precision` precise.
    """
    if not len(y) or not y.any():
        return []
    prune = np.arange(len(y)) % 3 == 2
    left, rules = np.ones(len(y), bool), []
    while len(rules) < most_rules:
        grow_at, prune_at = left & ~prune, left & prune
        if y[grow_at].sum() < least:
            break
        rule = _grow(x[grow_at], y[grow_at], names, depth, steps)
        if not rule:
            break

        def worth(r: Rule, at: np.ndarray = prune_at) -> float:
            hit = _covers(r, x[at], names)
            p, n = y[at][hit].sum(), hit.sum()
            return (p - (n - p) * precision / (1 - precision) / 4) if n else -1.0

        options = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(options, key=lambda r: (worth(r), -len(r)))
        hit = _covers(rule, x[prune_at], names)
        if not hit.any() or y[prune_at][hit].mean() < precision:
            break
        rules.append(rule)
        left &= ~_covers(rule, x, names)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where no rule fires: the decision list as one conditional expression."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> list[Rule]:
    """Rules from `sample_rows` labelled documents at most, chosen by a hash of the id.

    The sample's ids are few, so they are broadcast and no text is shuffled. Rows
    whose id or label is null teach nothing, nor do ids with both labels.
    """
    some = labelled_sample(labels, "quality", sample_rows)
    stats = statistics(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id"), keep=("doc_id", "quality"))
    got = stats.select("doc_id", "quality", *TESTED).toPandas().sort_values(["doc_id", *TESTED], kind="stable")
    return learn_rules(got[TESTED].to_numpy(float), (got["quality"].to_numpy() == 0).astype(int), TESTED)


def judge(docs: DataFrame, rules: list[Rule], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, the counts, the tested statistics, base_failed and kept for each row of docs.

    Null texts have no words and fail the base rule, and so do null ids with such
    texts; repeated rows each get their row; an empty table gives none; without
    labels the base rule alone decides. Other columns are ignored.
    """
    return statistics(docs, keep=keep).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def passing(rows: DataFrame, rules: list[Rule], *keep: str) -> DataFrame:
    """The columns `keep` of the rows that are kept.

    The row number stops the optimizer from moving the test below the projections,
    where it would compute every statistic anew for each mention.
    """
    judged = judge(rows, rules, keep=keep).withColumn("_at", F.monotonically_increasing_id())
    return judged.where((F.col("_at") >= 0) & F.col("kept")).select(*keep)
