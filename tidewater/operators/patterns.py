"""Names against a table of LIKE rules, met through an index of literal pieces.

Every rule is filed under one piece of text that any name it fits must hold: the start or the end of the pattern, or up to
three letters in a row from between its wildcards, whichever fewest other rules have. Names are looked up
by their own pieces, so a name meets only the rules that share one with it, and ILIKE decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.staging import stage

#: Letters of the longest piece.
GRAM = 3
_WILD = "\\\\.|[%_]"


def _grams(text: Column, n: int) -> Column:
    """All stretches of n letters."""
    last = F.char_length(text) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i + 1, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def _piece(kind: str, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), text.alias("text"))


def _rule_pieces(pattern: Column) -> Column:
    """The longest pieces that the lower-cased pattern offers; escaped letters count as wildcards here."""
    parts = F.split(pattern, _WILD)
    start, end = F.element_at(parts, 1), F.element_at(parts, -1)
    found = F.array().cast("array<struct<kind: string, text: string>>")
    for n in range(1, GRAM + 1):  # longer pieces replace shorter ones
        inner = F.transform(F.flatten(F.transform(parts, lambda p: _grams(p, n))), lambda g: _piece("in", g))
        ends = F.filter(F.array(_piece("start", F.substring(start, 1, n)), _piece("end", F.right(end, F.lit(n)))), lambda x: F.char_length(x["text"]) == n)
        here = F.concat(ends, inner)
        found = F.when(F.size(here) > 0, here).otherwise(found)
    return F.when(F.size(found) > 0, found).otherwise(F.array(_piece("any", F.lit(""))))


def _name_pieces(name: Column) -> Column:
    """Every piece that a rule which fits the lower-cased name may be filed under."""
    inner = [F.transform(_grams(name, n), lambda g: _piece("in", g)) for n in range(1, GRAM + 1)]
    ends = [_piece(kind, take(name, F.lit(n))) for n in range(1, GRAM + 1) for kind, take in (("start", F.left), ("end", F.right))]
    return F.array_distinct(F.concat(F.array(_piece("any", F.lit("")), *ends), *inner))


def index_rules(rules: DataFrame, pattern: str = "pattern", action: str = "action") -> DataFrame:
    """(kind, text, pattern, action): each pattern once, under its rarest piece; of several actions the smallest stays.

    Patterns of wildcards alone fit by length; of those that fit the same names only the preferred one is kept, so
    that what every name has to meet is as small as the number of different lengths.
    """
    each = rules.filter(F.col(pattern).isNotNull()).groupBy(F.col(pattern).alias("pattern")).agg(F.min(action).alias("action"))
    filed = stage(each.withColumn("piece", F.explode(F.array_distinct(_rule_pieces(F.lower("pattern"))))))
    spread = filed.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    best = filed.join(spread, "piece").groupBy("pattern", "action").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"))
    kept = best.select("piece.kind", "piece.text", "pattern", "action")
    bare = (kept.filter("kind = 'any'").withColumn("letters", F.char_length(F.regexp_replace("pattern", "%", "")))
            .groupBy("letters", F.contains("pattern", F.lit("%")).alias("open"), F.when(F.contains("pattern", F.lit("\\")), F.col("pattern")).alias("own"))
            .agg(F.min(F.struct((-F.char_length("pattern")).alias("n"), "pattern", "action")).alias("s")))
    return stage(kept.filter("kind <> 'any'").union(bare.select(F.lit("any"), F.lit(""), "s.pattern", "s.action")))


def match_rules(names: DataFrame, rules: DataFrame, name: str = "name", pattern: str = "pattern", action: str = "action") -> DataFrame:
    """Attach to each name the action of the best matching LIKE pattern (case-insensitive), NULL when none fits.

    A name that is spelled out beats a pattern, then the longest pattern wins, then the smaller text. Both sides
    are tables of any size: rules are an index, different names are looked up once, and the rules are broadcast only
    where the planner sees that they are small.
    """
    index = index_rules(rules, pattern, action)
    different = names.select(F.col(name).alias("_name")).filter(F.col("_name").isNotNull()).distinct()
    asked = different.withColumn("_piece", F.explode(_name_pieces(F.lower("_name")))).select("_name", F.col("_piece.kind").alias("kind"), F.col("_piece.text").alias("text"))
    met = asked.join(index, ["kind", "text"]).filter("_name ILIKE pattern").select("_name", F.lit(1).alias("_how"), "pattern", "action")
    # Spelled out as it stands, wildcards and all.
    spelled = different.withColumn("_low", F.lower("_name")).join(
        rules.filter(F.col(pattern).isNotNull()).select(F.lower(F.col(pattern)).alias("_low"), F.col(pattern).alias("pattern"), F.col(action).alias("action")), "_low")
    every = met.union(spelled.select("_name", F.lit(0), "pattern", "action"))
    best = every.groupBy("_name").agg(F.min_by("action", F.struct("_how", (-F.char_length("pattern")).alias("n"), "pattern", "action")).alias("_action"))
    kept = [c for c in names.columns if c != action]
    return names.select(*kept).join(best, F.col(name) == F.col("_name"), "left").select(*kept, F.col("_action").alias(action))
