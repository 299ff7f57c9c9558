"""Quality rules: an ordered decision list learned by sequential covering.

Each rule is a conjunction of ``statistic >= cut`` / ``statistic < cut`` that
picks out low-quality documents.  Rules are grown on one part of the labelled
rows (FOIL gain), pruned on another, and kept while they stay pure.  The list
becomes one ordered Spark ``CASE`` expression, so applying it is a narrow map
over whole texts: no shuffle, no join.

Learning reads at most ``LABEL_ROWS`` labelled documents (lowest hash of the
id first).  Every grow or prune step is one small aggregate over their
statistics; the driver only sees counts per (statistic, bin).

Defined results: a null text has no words; a text of fewer than 50 words, or
with more than half of its words in repeated three-word windows, fails the
base rule; with no usable labels the list is empty and the base rule decides
alone.  Equal rows get equal verdicts.  Other columns pass through untouched
(the added columns win a clash of names).
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import let, staged, words

#: Bound of the labelled sample that rules are learned from.
LABEL_ROWS = 20_000
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
SYMBOLS = "[#*$%&|<>]"
NOT_BLANK = r"[^\x20\x09-\x0D]"

#: Statistic -> (numerator, denominator) of the ratios that rules test.
RATIOS = {
    "word_len": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(w: Column) -> Column:
    """Words covered by a three-word window that occurs at least twice."""
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        twice = let(pairs, lambda s: F.filter(
            s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])))
        starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
        # a window at p adds the words behind the last counted one: min(3, p - last)
        return F.aggregate(starts, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                           lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                           lambda a: a["n"])

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(
        let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def _stats(t: Column) -> Column:
    bare = t
    for space in (" ", "\n", "\t", "\r", "\x0b", "\x0c"):
        bare = F.replace(bare, F.lit(space), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_BLANK))
    by_word = let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        _repeated(w).cast("long").alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return let(F.struct(by_word.alias("w"), by_line.alias("l")), lambda s: F.struct(
        s["w"]["n_words"].alias("n_words"), F.length(bare).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        s["l"]["n_dup_lines"].alias("n_dup_lines"), s["w"]["n_repeat_words"].alias("n_repeat_words"),
        s["l"]["n_lines"].alias("n_lines"), s["w"]["n_distinct"].alias("n_distinct"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper")))


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add struct ``__q`` of the text's counts.

    A one-element ``explode`` keeps the optimizer from copying the counts into
    each place that names them (filters above would compute them many times).
    """
    return df.select("*", F.explode(F.array(_stats(F.coalesce(F.col(text), F.lit(""))))).alias("__q"))


def _base_failed() -> Column:
    n = F.col("__q.n_words")
    return (n < MIN_WORDS) | (100 * F.col("__q.n_repeat_words") > MAX_REPEAT_PCT * n)


def _ratio(name: str) -> Column:
    num, den = RATIOS[name]
    return F.coalesce(F.try_divide(F.col(f"__q.{num}").cast("double"), F.col(f"__q.{den}")), F.lit(0.0))


@dataclass(frozen=True)
class Test:
    """``statistic >= cut`` (at_least) or ``statistic < cut``."""
    stat: str
    cut: float
    at_least: bool

    def column(self, value: Column) -> Column:
        return value >= self.cut if self.at_least else value < self.cut

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.at_least else '<'} {self.cut:.6g}"


Rule = tuple[Test, ...]


def _all_of(rule: Rule, value) -> Column:
    out = F.lit(True)
    for t in rule:
        out = out & t.column(value(t.stat))
    return out


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, cuts: dict[str, list[float]], max_tests: int) -> Rule:
    """Add the test of the highest FOIL gain until no good document is left or none gains."""
    rule: Rule = ()
    while len(rule) < max_tests:
        bins = F.explode(F.array(*[
            F.struct(F.lit(s).alias("stat"), sum((F.when(F.col(s) >= c, 1).otherwise(0) for c in cuts[s]), F.lit(0)).alias("bin"))
            for s in cuts])).alias("b")
        hist = (rows.where(_all_of(rule, F.col)).select("bad", bins).groupBy("b.stat", "b.bin")
                .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect())
        best, first = (0.0, None), {}
        for s in cuts:
            own = {r["bin"]: (r["p"], r["n"]) for r in hist if r["stat"] == s}
            p0, n0 = sum(v[0] for v in own.values()), sum(v[1] for v in own.values())
            first[s] = (p0, n0)
            for i, cut in enumerate(cuts[s]):
                p = sum(v[0] for b, v in own.items() if b > i)
                n = sum(v[1] for b, v in own.items() if b > i)
                for test, pp, nn in ((Test(s, cut, True), p, n), (Test(s, cut, False), p0 - p, n0 - n)):
                    if pp and p0 and (g := _gain(p0, n0, pp, nn)) > best[0] + 1e-9:
                        best = (g, test, nn)
        if best[1] is None:
            break
        rule += (best[1],)
        if best[2] == 0:
            break
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of the rule with the best (bad - good) / (bad + good) on the pruning rows."""
    row = rows.agg(*[x for i in range(1, len(rule) + 1) for x in (
        F.count_if(_all_of(rule[:i], F.col) & F.col("bad")).alias(f"p{i}"),
        F.count_if(_all_of(rule[:i], F.col) & ~F.col("bad")).alias(f"n{i}"))]).first()
    best = max(range(1, len(rule) + 1),
               key=lambda i: ((row[f"p{i}"] - row[f"n{i}"]) / max(1, row[f"p{i}"] + row[f"n{i}"]), -i))
    return rule[:best], row[f"p{best}"], row[f"n{best}"]


def learn(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_rows: int = LABEL_ROWS,
          max_rules: int = 8, max_tests: int = 3, n_cuts: int = 24, min_purity: float = 0.9, min_cover: int = 5) -> list[Rule]:
    """Sequential covering over a labelled sample: the rules that mark ``quality = 0``, in order.

    A rule is accepted when at least ``min_purity`` of the pruning rows it
    covers are bad and it covers ``min_cover`` of them; a rule that fails bars
    the statistic it began with, and the list ends when nothing more can grow.
    """
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("__id")).agg((F.min("quality") == 0).alias("bad")))
    total = known.count()
    # hash threshold first, so that the ordered limit sees about twice the bound
    share = min(1.0, 2 * label_rows / max(1, total))
    order = F.pmod(F.xxhash64("__id"), F.lit(1 << 30))
    sample = known.where(order < int(share * (1 << 30)) + 1).orderBy(order, "__id").limit(label_rows)
    rows = with_stats(df.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
                      .join(F.broadcast(sample), "__id"), "__text")
    rows = staged(rows.where(~_base_failed()).select(
        "bad", (F.pmod(F.crc32(F.col("__id").cast("string")), F.lit(3)) == 0).alias("prune"),
        *[_ratio(s).alias(s) for s in RATIOS]).repartition(4), "labelled")
    at = [(i + 1) / (n_cuts + 1) for i in range(n_cuts)]
    # cuts at quantiles of the bad rows and of the good ones, so that rare kinds of junk get cuts too
    quantiles = rows.groupBy("bad").agg(*[F.percentile_approx(s, at, 10_000).alias(s) for s in RATIOS]).collect()
    cuts = {s: sorted({v for q in quantiles for v in q[s]}) for s in RATIOS}
    grow, prune, rules = rows.where(~F.col("prune")), rows.where("prune"), []
    while any(cuts.values()) and len(rules) < max_rules:
        grown = _grow(grow, cuts, max_tests)
        if not grown:
            break
        rule, p, n = _prune(prune, grown)
        if p < min_cover or p < min_purity * (p + n):
            cuts[grown[0].stat] = []        # this statistic led astray: grow from the others
            continue
        rules.append(rule)
        grow, prune = (x.where(~_all_of(rule, F.col)) for x in (grow, prune))
    return rules


def decision(rules: list[Rule]) -> Column:
    """The ordered list as one expression over ``__q``: the number of the first rule that fires, else null."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        out = F.when(_all_of(rule, _ratio), F.lit(i)).otherwise(out)
    return out


def apply_rules(df: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Add the counts, ``base_failed``, ``kept`` and ``rule`` (text of the rule that rejected the row)."""
    names = F.array(*[F.lit(" and ".join(map(str, r))) for r in rules]) if rules else F.array().cast("array<string>")
    return (with_stats(df, text).withColumn("__rule", decision(rules))
            .withColumns({c: F.col(f"__q.{c}") for c in COUNTS})
            .withColumn("base_failed", _base_failed())
            .withColumn("kept", ~F.col("base_failed") & F.col("__rule").isNull())
            .withColumn("rule", F.get(names, F.col("__rule")))
            .drop("__q", "__rule"))
