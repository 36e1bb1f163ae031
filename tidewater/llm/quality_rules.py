"""Quality rules with risk-controlled thresholds.

Each rule rejects documents whose measure is at or over a cutoff. The cutoffs come from a grid that is
fixed beforehand. Labelled documents are the holdout: for a stratum, a rule and a cutoff, the exact
binomial tail P(Bin(n, risk) <= wrongly rejected) tests "good documents are rejected more often than
`risk`". Cutoffs are tested from the most lenient on and the first that fails ends the sequence; the
sequences of all strata and rules share the error level (Bonferroni). Only certified cutoffs are used.

Native: built-in column functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_small, staged, whole_row

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Share of good documents that all rules together may reject in a stratum, and the chance that some bound is wrong.
RISK, LEVEL = 0.04, 0.05
#: Good documents lost that one bad document caught is worth.
WORTH = 0.2
#: Cutoffs of each rule, from lenient to strict.
GRID: Mapping[str, Sequence[float]] = {
    "symbols_per_word": (2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1),
    "dup_line_share": (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeat_share": (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "word_chars_mean": (40.0, 30.0, 20.0, 16.0, 13.0, 11.0),
}

#: What `measures` adds.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Low bits of a packed window that hold its place: as many as a place in an array can have. The 33 bits above hold
#: its hash; windows whose hashes meet by chance are told apart by their words afterwards.
PLACE_BITS = 31


def words(text: Column) -> Column:
    """Words of a text that isn't null; blanks are made equal first, because a one-character split needs no regex."""
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _symbols(text: Column) -> Column:
    bare = text
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    return F.length(text) - F.length(bare)


def _suspects(w: Column) -> Column:
    """Places of 3-word windows whose hash turns up twice: hash and place in one long each, sorted, neighbours compared."""
    size = F.size(w)
    starts = F.when(size >= 3, F.sequence(F.lit(0), size - 3)).otherwise(F.array().cast("array<int>"))
    high = F.lit(-1 << PLACE_BITS)
    return F.sort_array(F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(high) + i))


def _suspect_places(packed: Column) -> Column:
    key = lambda x: F.shiftright(x, PLACE_BITS)
    same = lambda x, k: F.coalesce(key(F.get(packed, k)) == key(x), F.lit(False))
    return F.transform(F.filter(packed, lambda x, k: same(x, k + 1) | same(x, k - 1)), lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))


def _covered(ranked: Column, n: int = 3) -> Column:
    """Words that lie in an n-word window found twice or more.

    `ranked` holds the suspect windows sorted with their places, so equal windows are neighbours and
    hashes that met by chance are told apart; get() is null beyond the ends.
    """
    same = lambda x, k: F.coalesce(F.get(ranked, k)["s"] == x["s"], F.lit(False))
    places = F.filter(F.transform(ranked, lambda x, k: F.when(same(x, k + 1) | same(x, k - 1), x["i"])), lambda i: i.isNotNull())
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(i, i + n - 1)))))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (long).

    A null text counts as empty: all zero. What is used more than once is a column of its own behind
    a one-row explode, so that the optimiser doesn't repeat it.
    """
    once = lambda c: F.explode(F.array(c))
    body, w = F.col("body"), F.col("w")
    held = docs.select(whole_row(docs).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    held = held.select("*", once(words(body)).alias("w"))
    held = held.select("*", once(F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))).alias("lines"))
    held = held.select("*", once(_suspects(w)).alias("packed"))
    held = held.select("*", once(F.sort_array(F.transform(
        _suspect_places(F.col("packed")),
        lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("s"), i.alias("i")),
    ))).alias("ranked"))
    return held.select(
        *[F.col("row")[c].alias(c) for c in docs.columns],
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _symbols(body).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("ranked")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def stratum(lang: Column) -> Column:
    """The language code if it is two letters, else 'other': at most 677 strata."""
    low = F.lower(lang)
    return F.when(low.rlike("^[a-z]{2}$"), low).otherwise("other")


def _values() -> dict[str, Column]:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "word_chars_mean": per("word_chars", "n_words"),
    }


def binomial_tail(n: Column, k: Column, p: Column) -> Column:
    """P(Bin(n, p) <= k) for k <= n p, exactly: the sum of its terms, each from the one before, in logarithms."""
    first = n * F.log1p(-p)
    odds = F.log(p) - F.log1p(-p)
    start = F.struct(first.alias("term"), F.exp(first).alias("total"))

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (acc["total"] + F.exp(term)).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, step, lambda acc: acc["total"])


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, grid: Mapping[str, Sequence[float]] = GRID) -> DataFrame:
    """(stratum, rule, cutoff): certified cutoffs, of each stratum and rule the one that is worth most.

    `labels` holds doc_id and quality (1 good, 0 bad; other rows are passed over; of several labels of a
    document the lowest counts). Each labelled doc_id is one trial, however many rows it has: the row that
    comes first by stratum and measures stands for it. At most strata x rules rows, whatever the size of the tables.
    """
    truth = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_good"))
    rules = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"), (_values()[name] >= c).alias("hit"))
        for name, steps in grid.items() for i, c in enumerate(steps)
    ])
    once = measured.groupBy("doc_id").agg(F.min(F.struct(stratum(F.col("lang")).alias("stratum"), *MEASURES)).alias("_m")).select("doc_id", "_m.*")
    counted = staged(  # read three times below
        once.join(truth, "doc_id").select("stratum", "_good", F.inline(rules))
        .groupBy("stratum", "rule", "step", "cutoff").agg(
            F.sum("_good").cast("long").alias("n"), F.sum((F.col("hit") & (F.col("_good") == 1)).cast("long")).alias("k"),
            F.sum((F.col("hit") & (F.col("_good") == 0)).cast("long")).alias("caught"))
    )
    n_strata = counted.agg(F.count_distinct("stratum")).scalar()
    each = risk / len(grid)
    tested = (
        counted.withColumn("n_strata", n_strata)
        .withColumn("tail", F.when(F.col("k") <= F.col("n") * each, binomial_tail(F.col("n"), F.col("k"), F.lit(each))).otherwise(F.lit(1.0)))
        .withColumn("fails", (F.col("tail") > level / (F.col("n_strata") * len(grid))).cast("int"))
    )
    ends = tested.groupBy("stratum", "rule").agg(F.min(F.when(F.col("fails") == 1, F.col("step"))).alias("end"))
    worth = F.col("caught") * WORTH - F.col("k")
    return (
        tested.join(F.broadcast(ends), ["stratum", "rule"])  # at most strata x rules rows
        .filter((F.col("end").isNull() | (F.col("step") < F.col("end"))) & (worth > 0))
        .groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(worth, -F.col("step"))).alias("cutoff"))
    )


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """`docs` with the measures, base_failed and kept (columns of these names are replaced).

    base_failed: fewer than 50 words, or over half of the words in repeated windows. The rest is kept
    unless a certified cutoff of its stratum rejects it. Strata without enough labels have no cutoffs,
    so without labels only the base rules reject. Labels are joined by doc_id; a document without an id
    is judged but no holdout. Repeated rows stay. Labelled documents are measured twice, once for the
    cutoffs: cheaper than writing all texts beside their measures.
    """
    own = (*MEASURES, "base_failed", "kept")
    columns = [c for c in docs.columns if c not in own]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns])
    known = broadcast_if_small(staged(labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()))
    holdout = rows.select("doc_id", "lang", "text").join(known, "doc_id", "left_semi")
    best = cutoffs(measures(holdout).drop("text"), labels, risk, level)
    measured = measures(rows.select(whole_row(rows).alias("row"), "lang", "text")).drop("text")
    wide = best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"_c_{name}") for name in GRID])
    hit = F.lit(False)
    for name, value in _values().items():
        hit = hit | F.coalesce(value >= F.col(f"_c_{name}"), F.lit(False))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured.withColumn("stratum", stratum(F.col("lang"))).join(F.broadcast(wide), "stratum", "left")  # one row per stratum
        .select(*[F.col("row")[c].alias(c) for c in columns], *MEASURES, failed.alias("base_failed"), (~failed & ~hit).alias("kept"))
    )
