"""Quality rules: base statistics of a text, and a decision list learned over them by sequential covering.

Statistics, learning counts and the verdict are Spark expressions throughout. Each rule is a conjunction of thresholds: it
is grown literal by literal on one part of the labelled rows, pruned on the other, and kept if it holds there. The
list is emitted as one ordered conditional expression that names the first rule a text meets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windgrid.llm.common import GAP_PATTERN, stored

# The signs that count as symbols, and the separators of words.
SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\x0b\x0c\r"
WINDOW = 5


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP_PATTERN), lambda w: w != "")


def shifted(values: Column, by: int) -> Column:
    """The values from position ``by`` on."""
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def repeat_words(hashes: Column, n_words: Column) -> Column:
    """Words inside windows of five that come twice or more, the first one included.

    Windows are compared by a 64-bit hash. Most texts have no such window and end at the count of different hashes;
    else windows are sorted by hash, equal neighbours marked, and the marked places' union measured.
    """

    def covered(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            before = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(s, lambda x: x["h"]))
            after = F.concat(shifted(F.transform(s, lambda x: x["h"]), 1), F.array(F.lit(None).cast("bigint")))
            zipped = F.arrays_zip(s.alias("s"), F.slice(before, F.lit(1), F.size(s)).alias("b"), after.alias("a"))
            hit = F.filter(zipped, lambda z: F.coalesce(z["s"]["h"] == z["b"], F.lit(False)) | F.coalesce(z["s"]["h"] == z["a"], F.lit(False)))
            return F.array_sort(F.transform(hit, lambda z: z["s"]["i"]))

        def union(places: Column) -> Column:
            gaps = F.zip_with(F.slice(places, F.lit(1), F.size(places) - 1), shifted(places, 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
            return F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda s, x: s + x)

        return let(let(placed, marked), union)

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered(windows))

    def of_hashes(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return let(F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))), of_windows)

    return F.when(n_words < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(hashes, of_hashes))


def statistics(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """The given columns and _s, a struct of whole-text counts. A null text counts as empty, with all counts 0."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, GAPS, "")) > 0)
    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    of_hashes = let(
        hashes,
        lambda h: F.struct(
            F.size(h).cast("long").alias("n_words"),
            repeat_words(h, F.size(h)).alias("n_repeat_words"),
            F.size(F.array_distinct(h)).cast("long").alias("n_distinct_words"),
            F.size(F.filter(F.zip_with(h, shifted(h, 1), lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x)).cast("long").alias("n_adjacent"),
        ),
    )
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    count = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
    return documents.select(
        "*",
        F.struct(
            of_hashes.alias("h"),
            of_lines.alias("l"),
            F.length(F.translate(text, GAPS, "")).cast("long").alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"),
            count("0123456789").alias("n_digits"),
            count("!?").alias("n_marks"),
            count("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        ).alias("_s"),
    )


def features() -> dict[str, Column]:
    """What rules may test, by name; shares are of words, lines or characters."""
    s = lambda name: F.col(f"_s.{name}")
    share = lambda a, b: a / F.greatest(b, F.lit(1))
    return {
        "words": s("h.n_words").cast("double"),
        "symbols_per_word": share(s("n_symbols"), s("h.n_words")),
        "marks_per_word": share(s("n_marks"), s("h.n_words")),
        "repeat_share": share(s("h.n_repeat_words"), s("h.n_words")),
        "adjacent_share": share(s("h.n_adjacent"), s("h.n_words")),
        "distinct_share": share(s("h.n_distinct_words"), s("h.n_words")),
        "dup_line_share": share(s("l.n_dup_lines"), s("l.n_lines")),
        "chars_per_word": share(s("word_chars"), s("h.n_words")),
        "words_per_line": share(s("h.n_words"), s("l.n_lines")),
        "digit_share": share(s("n_digits"), s("word_chars")),
        "capital_share": share(s("n_capitals"), s("word_chars")),
    }


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(f"_f.{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Literal, ...]
Counts = dict[tuple[str, int], tuple[int, int]]  # (feature, bin) to bad rows and good rows


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for literal in rule:
        out = out & literal.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The text of the first rule met, else null."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        out = out.when(holds(rule), F.lit(" and ".join(map(str, rule))))
    return out


def labelled(described: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """bad (1 for quality 0), prune (true for a third of the rows, by hash) and _f. Null or other labels are left
    out; a document labelled twice is bad if any label says so."""
    known = labels.select(F.col(id_column).alias("_id"), F.col("quality").alias("_q")).filter("_id IS NOT NULL AND _q IN (0, 1)")
    known = known.groupBy("_id").agg((1 - F.min("_q")).cast("int").alias("bad"))
    rows = described.select(F.col(id_column).alias("_d"), "_f").join(known, F.col("_d") == F.col("_id"))
    return rows.select("bad", (F.pmod(F.xxhash64("_d"), F.lit(3)) == 0).alias("prune"), "_f")


def learn(rows: DataFrame, most_literals: int = 4, grid: int = 64, least_bad: int = 5, precision: float = 0.95) -> list[Rule]:
    """Sequential covering over all labelled rows (bad, prune, _f); only counts by threshold reach the driver.

    A rule must cover ``least_bad`` bad rows, however many there are, and be right for a share of ``precision`` on the rows for pruning; if
    it is not, no rule begins as it did until another one is kept. Learning ends when no beginning gains. Without rows of both classes the list is empty.

    Ties of gain go to the earlier feature, the lower threshold and then the rows below it. Rows are reduced to counts by bins first, so
    that copies are one row. Counts are kept by beginning (of no literal, one, two ...) and each is made once, over the rows that the beginning
    covers; when a rule is kept, what its rows add to any of them is subtracted in one pass over these rows. So a beginning that is refused and
    tried again later costs no further pass. A row's bins are made rows of their own once, stored, and read by every pass, so the rows made
    follow the binned rows and not the number of passes.
    """
    names = list(features())
    split = rows.agg(F.count(F.when(F.col("bad") == 1, 1)).alias("p"), F.count(F.when(F.col("bad") == 0, 1)).alias("n")).first()
    if not split["p"] or not split["n"]:
        return []
    thresholds = cuts_of(rows, names, grid)
    bins = F.array(*(_bin(F.col(f"_f.{n}"), thresholds[n]) for n in names))
    rows = rows.groupBy("bad", "prune", bins.alias("_b")).agg(F.count("*").alias("_c"))
    rows = stored(rows.withColumn("_f", F.struct(*(F.col("_b")[k].alias(n) for k, n in enumerate(names)))), "binned")

    def binned(rule: Rule) -> Column:
        """As holds, on bins: a value is above a threshold if its bin is above the threshold's place."""
        return holds(tuple(Literal(x.feature, x.above, thresholds[x.feature].index(x.threshold)) for x in rule))

    places = stored(rows.filter(~F.col("prune")).select("bad", "_c", "_f", F.posexplode("_b")), "places")

    def counted(where: Column) -> Counts:
        found = places.filter(where).groupBy("pos", "col").agg(F.sum(F.col("bad") * F.col("_c")).alias("p"), F.sum("_c").alias("c")).collect()
        return {(names[r["pos"]], r["col"]): (r["p"], r["c"] - r["p"]) for r in found}

    def added_by(rule: Rule, beginnings: list[Rule]) -> dict[Rule, Counts]:
        """What a rule's open rows add to the counts of other beginnings."""
        covered = places.filter(open_rows & binned(rule)).select("bad", "_c", F.array(*map(binned, beginnings)).alias("_in"), "pos", "col")
        sums = []
        for k in range(len(beginnings)):
            share = F.when(F.col("_in")[k], F.col("_c")).otherwise(0)
            sums += [F.sum(F.col("bad") * share).alias(f"p{k}"), F.sum(share).alias(f"c{k}")]
        found = covered.groupBy("pos", "col").agg(*sums).collect()
        return {b: {(names[r["pos"]], r["col"]): (r[f"p{k}"], r[f"c{k}"] - r[f"p{k}"]) for r in found} for k, b in enumerate(beginnings)}

    rules: list[Rule] = []
    refused: set[tuple[str, bool]] = set()
    open_rows = F.lit(True)
    known: dict[Rule, Counts] = {(): counted(open_rows)}
    while True:
        rule: Rule = ()
        while len(rule) < most_literals:
            counts = known[rule]
            literal = best_literal(counts, names, thresholds, least_bad, set() if rule else refused)
            if literal is None:
                break
            rule = (*rule, literal)
            if not good_left(counts, thresholds, literal) or len(rule) == most_literals:
                break
            if rule not in known:
                known[rule] = counted(open_rows & binned(rule))
        if not rule:
            return rules
        grown, rule = rule, pruned(rows.filter(open_rows & F.col("prune")), rule, binned, precision, least_bad)
        if rule is None:
            refused.add((grown[0].feature, grown[0].above))
            continue
        # A beginning of the rule loses all of the rule's rows; others lose those that they share with it.
        own = [b for b in known if b == rule[: len(b)]]
        others = [b for b in known if b not in own]
        covered = {b: known[rule] for b in own} if rule in known and not others else added_by(rule, [*own, *others])
        for b, gone in covered.items():
            known[b] = {k: (p - gone.get(k, (0, 0))[0], n - gone.get(k, (0, 0))[1]) for k, (p, n) in known[b].items()}
        rules.append(rule)
        refused.clear()
        open_rows = open_rows & ~binned(rule)


def cuts_of(rows: DataFrame, names: list[str], grid: int) -> dict[str, list[float]]:
    """Thresholds of each feature, halfway between values seen, so that a rule keeps its distance from both sides.

    Seen are each class's shares by ``grid``, ever smaller shares in both tails, and its ends; and for bad rows the values next to the ends
    of the good ones, so that a kind is cut off there however small its share is.
    """
    tails = [0.5**k for k in range(7, 18)]
    shares = sorted({*(k / grid for k in range(1, grid)), *tails, *(1 - t for t in tails), 0.0, 1.0})
    wanted = [F.percentile_approx(f"_f.{n}", shares, 10_000).alias(n) for n in names]
    ends = [f(f"_f.{n}").alias(f"{k}_{n}") for n in names for k, f in (("low", F.min), ("high", F.max))]
    by_class = rows.groupBy("bad").agg(*wanted, *ends).collect()
    good = next(r for r in by_class if r["bad"] == 0)
    bad = rows.filter("bad = 1")
    beside = []
    for n in names:
        value, low, high = F.col(f"_f.{n}"), good[f"low_{n}"], good[f"high_{n}"]
        beside += [F.max(F.when(value < low, value)).alias(f"low_{n}"), F.min(F.when(value > high, value)).alias(f"high_{n}")]
    found = [*by_class, bad.agg(*beside).first()]
    out = {}
    for n in names:
        values = {float(x) for r in by_class for x in r[n] or []} | {float(r[k]) for r in found for k in (f"low_{n}", f"high_{n}") if r[k] is not None}
        ordered = sorted(values)
        out[n] = sorted({(a + b) / 2 for a, b in zip(ordered, ordered[1:])})
    return out


def _bin(value: Column, thresholds: list[float]) -> Column:
    """How many thresholds are below the value."""
    cuts = F.array(*map(F.lit, thresholds)) if thresholds else F.array().cast("array<double>")
    return F.size(F.filter(cuts, lambda t: t < value))


def best_literal(counts: Counts, names: list[str], thresholds: dict[str, list[float]], least_bad: int, refused: set[tuple[str, bool]]) -> Literal | None:
    """The threshold with the largest information gain for bad rows, not on a refused (feature, direction)."""
    by: dict[str, dict[int, tuple[int, int]]] = {n: {} for n in names}
    for (name, at), both in counts.items():
        by[name][at] = both
    found: list[tuple[float, Literal]] = []
    for name in names:
        p_all, n_all = (sum(x[k] for x in by[name].values()) for k in (0, 1))
        if not p_all or not n_all:
            continue
        before = math.log2(p_all / (p_all + n_all))
        p_low = n_low = 0
        for k, t in enumerate(thresholds[name]):
            p, n = by[name].get(k, (0, 0))
            p_low, n_low = p_low + p, n_low + n
            for above, pp, nn in ((False, p_low, n_low), (True, p_all - p_low, n_all - n_low)):
                if pp >= least_bad and pp + nn < p_all + n_all:
                    gain = pp * (math.log2(pp / (pp + nn)) - before)
                    if gain > 1e-9 and (name, above) not in refused:
                        found.append((gain, Literal(name, above, t)))
    return max(found, key=lambda x: x[0])[1] if found else None


def good_left(counts: Counts, thresholds: dict[str, list[float]], literal: Literal) -> int:
    """How many good rows the counts leave under one more literal."""
    cut = thresholds[literal.feature].index(literal.threshold)
    return sum(n for (name, at), (_, n) in counts.items() if name == literal.feature and (at > cut) == literal.above)


def pruned(rows: DataFrame, rule: Rule, held, precision: float, least_bad: int) -> Rule | None:
    """The shortest best beginning of the rule on held-out rows, or None if none is precise enough. ``held`` gives a rule's condition."""
    wanted = []
    for k in range(1, len(rule) + 1):
        hit = F.when(held(rule[:k]), F.col("_c"))
        wanted += [F.coalesce(F.sum(hit * F.col("bad")), F.lit(0)).alias(f"p{k}"), F.coalesce(F.sum(hit), F.lit(0)).alias(f"c{k}")]
    r = rows.agg(*wanted).first()
    options = [((2 * r[f"p{k}"] - r[f"c{k}"]) / r[f"c{k}"], r[f"p{k}"], -k) for k in range(1, len(rule) + 1) if r[f"c{k}"]]
    options = [o for o in options if o[1] >= max(1, least_bad // 3) and (o[0] + 1) / 2 >= precision]
    return rule[: -max(options)[2]] if options else None


def described(documents: DataFrame) -> DataFrame:
    """The given columns, _s (counts) and _f (features)."""
    counted = statistics(documents)
    return counted.withColumn("_f", F.struct(*(c.alias(n) for n, c in features().items())))


def base_failed() -> Column:
    n = F.col("_s.h.n_words")
    return (n < 10) | (100 * F.col("_s.h.n_repeat_words") > 20 * n)


def judge(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """The documents' columns but text, with _s, _f, base_failed, rule (the learned rule met, or null) and kept.

    Counts of all documents are stored once, without texts, and serve both learning and verdicts. A null text has no words and fails the
    base rules; a document with a null id is judged, but no label is its own. Repeated rows are judged alike, each on its own row.
    """
    narrow = stored(described(documents).drop("text"), "statistics")
    rules = learn(stored(labelled(narrow, labels), "labelled"))
    out = narrow.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def passes(rules: list[Rule]) -> Column:
    """Whether a described row meets neither the base rules nor a learned one."""
    return ~base_failed() & verdict(rules).isNull()
