"""Text work that needs a join: dictionaries and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import words

# The texts given when there is nothing to give.
NO_WORD = "There is no such word"
NO_WANDS = "No one was buying magic wands this year."


def substitute_words(df: DataFrame, key: str, col: str, dictionary: DataFrame, source: str, target: str) -> DataFrame:
    """(key, text) with each word replaced by its partner; words without one are dropped.

    Swap `source` and `target` for the other direction. A word with several partners takes all, sorted.
    """
    tokens = df.select(key, F.posexplode(words(F.col(col))).alias("_pos", "_w"))
    pairs = dictionary.filter(F.col(target) != "").select(F.col(source).alias("_w"), F.col(target).alias("_t"))
    found = tokens.join(pairs, "_w").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_t"))).alias("_s"))
    return found.select(key, F.array_join(F.transform("_s", lambda x: x["_t"]), " ").alias("text"))


def lookup(df: DataFrame, col: str, dictionary: DataFrame, source: str, target: str, out: str, default: str = NO_WORD) -> DataFrame:
    """Partner of a whole value, or a default text."""
    pairs = dictionary.select(F.col(source).alias("_w"), F.col(target).alias(out))
    return df.join(pairs, F.col(col) == F.col("_w"), "left").drop("_w").withColumn(out, F.coalesce(out, F.lit(default)))


def sentence_of(df: DataFrame, key: str, name: Column, material: Column, when: str) -> DataFrame:
    """(key, sentence) listing the buyers and materials of one period, in order of name."""
    entries = df.select(key, F.concat(name, F.lit(" (material - "), material, F.lit(")")).alias("_e")).distinct()
    return entries.groupBy(key).agg(F.expr("listagg(_e, ', ') WITHIN GROUP (ORDER BY _e)").alias("_l")).select(
        key, F.coalesce(F.concat(F.lit(f"In {when} the following people bought a wand: "), F.col("_l"), F.lit(".")), F.lit(NO_WANDS)).alias("sentence"))
