"""Spelling variants through a dictionary of trie-node pairs.

The words are sorted and numbered as nodes of a trie, and their reversals as nodes of another. A word with one
place left out is a pair (prefix node, suffix node): words that share such a pair differ in that place
alone, and a word that is cut between the two nodes of the pair is the other with that place deleted. So equal
integers give exactly the words at one edit's distance, and no candidate has to be confirmed.

Numbering needs one pass over sorted words: nodes up to the common prefix with the word before are known, the others
are new. Only nodes that two words share can meet, so the pass keeps a word's nodes down to its longest common
prefix with a neighbour. A pair is shared by as many words as there are letters, at most, and by one whole word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_rows, staged

#: Code points of the shortest word, occurrences of the rarest, and how much commoner a form is.
LEAST_LETTERS, LEAST_COUNT, COMMONER = 7, 2, 10
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
_SLICE_BITS = 40
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, change=None, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of at least `letters` code points that occur `least` times or more.

    Words are maximal runs of letters in the whole text, A-Z lower-cased; `change(doc_id, run)` may alter them. Null
    and empty texts have none. Runs that are too short are left out before `change`, which must not lengthen them.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{letters},}}"), F.lit(0)))
    words = docs.select(F.col("doc_id"), run.alias("run")).withColumn("run", F.translate("run", _UPPER, _LOWER))
    words = words.select((change(F.col("doc_id"), F.col("run")) if change else F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def drop_one_letter(doc_id: Column, run: Column, one_in: int = 31) -> Column:
    """The run without its letter h % length, if `one_in` divides h, the crc32 of `doc_id:run`; a null id counts as the empty text."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


_NUMBERED = pa.schema([("word", pa.string()), ("carried", pa.int64()), ("slice", pa.int32()), ("id", pa.int64()), ("nodes", pa.list_(pa.int64()))])


def _number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node numbers along one slice of sorted, different words.

    Numbers begin with the slice. Those up to the first word's length are the depths on its path, which an earlier
    slice may have numbered too; all others are new. The first and last word keep whole paths.
    """
    first = last = None
    path: list[int] = []
    row = shared = 0
    waiting = None  # the last word, until the next one tells how deep they agree

    def done(deep: int) -> tuple:
        word, carried, where, place, nodes, before = waiting
        return word, carried, where, place, nodes[: max(deep, before) + 1]

    for batch in batches:
        out = []
        for word, carried, where in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            base = where << _SLICE_BITS
            if first is None:
                first, before, shared = word, len(word), len(word) + 1
                path = list(range(base, base + len(word) + 1))
            else:
                before = _common(last, word)
                out.append(done(before))
                path = path[: before + 1] + list(range(base + shared, base + shared + len(word) - before))
                shared += len(word) - before
            waiting = (word, carried, where, base + row, path, before)
            last, row = word, row + 1
        if out:
            yield arrow_rows(_NUMBERED, dict(zip(_NUMBERED.names, zip(*out))))
    if waiting is not None:
        yield arrow_rows(_NUMBERED, dict(zip(_NUMBERED.names, ([x] for x in done(len(last))))))


def _trie(words: DataFrame) -> DataFrame:
    """(word, carried, id, nodes) of (word, carried): ids rise with the words; nodes by depth, from 0 on, as deep as they are shared.

    A slice's first word may continue paths of the slice before. The borders (two words and a path per slice) are
    put together on the driver: their number is that of the slices, whatever the size of the dictionary.
    """
    spark = words.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = words.repartitionByRange(n, "word").sortWithinPartitions("word").withColumn("slice", F.spark_partition_id())
    numbered = staged(ranged.mapInArrow(_number, "word string, carried long, slice int, id long, nodes array<long>"))
    borders = numbered.groupBy("slice").agg(F.min("word").alias("first"), F.max(F.struct("word", "nodes")).alias("last")).orderBy("slice").collect()
    known: dict[int, list[int]] = {}
    for before, here in zip(borders, borders[1:]):
        earlier = known.get(before["slice"], [])
        path = before["last"]["nodes"][: _common(before["last"]["word"], here["first"]) + 1]
        places = [x & (1 << _SLICE_BITS) - 1 if x >> _SLICE_BITS == before["slice"] else len(earlier) for x in path]
        known[here["slice"]] = [earlier[p] if p < len(earlier) else x for p, x in zip(places, path)]
    table = spark.createDataFrame(list(known.items()), "slice int, known array<long>")
    place = lambda x: x.bitwiseAND((1 << _SLICE_BITS) - 1)
    nodes = F.transform("nodes", lambda x: F.when(place(x) < F.size("known"), F.get("known", place(x).cast("int"))).otherwise(x))
    return numbered.join(F.broadcast(table), "slice", "left").select("word", "carried", "id", F.when(F.col("known").isNull(), F.col("nodes")).otherwise(nodes).alias("nodes"))


def neighbours(words: DataFrame) -> DataFrame:
    """(id, word, n, n_near, near) of (word, n), all words different: how many are one edit away, and the one of them of largest n.

    An edit inserts, deletes or replaces one code point. `near` is a struct (n, back: the id negated), so that the
    largest n wins and among ties the smallest in code-point order: ids rise with the words.
    """
    forward = staged(_trie(words.select("word", F.col("n").alias("carried"))).select("word", F.col("carried").alias("n"), "id", F.col("nodes").alias("heads")))
    back = _trie(forward.select(F.reverse("word").alias("word"), F.col("id").alias("carried"))).select(F.col("carried").alias("id"), F.col("nodes").alias("tails"))
    size = F.char_length("word")
    both = forward.join(back, "id").select("id", "n", F.split("word", "").alias("letters"), "heads", "tails", size.alias("len"))
    # Place i can be left out, or a cut made before it, where both nodes are among the shared ones.
    low, high = F.greatest(F.lit(0), F.col("len") - F.size("tails")), F.least(F.size("heads") - 1, F.col("len") - 1)
    skips = F.transform(F.sequence(low, high), lambda i: F.struct(
        F.get("heads", i).alias("head"), F.get("tails", F.col("len") - 1 - i).alias("tail"),
        # Deleting any letter of "ss" gives one word: the first stands for all.
        F.when((i > 0) & (F.get("letters", i) == F.get("letters", i - 1)), F.lit(1)).otherwise(F.lit(2)).alias("kind")))
    low_cut, high_cut = F.greatest(F.lit(0), F.col("len") + 1 - F.size("tails")), F.least(F.size("heads") - 1, F.col("len"))
    cuts = F.transform(F.sequence(low_cut, high_cut), lambda i: F.struct(
        F.get("heads", i).alias("head"), F.get("tails", F.col("len") - i).alias("tail"), F.lit(0).alias("kind")))
    none = F.array().cast("array<struct<head:bigint,tail:bigint,kind:int>>")
    pairs = F.concat(F.when(low <= high, skips).otherwise(none), F.when(low_cut <= high_cut, cuts).otherwise(none))
    rows = both.select("id", "n", F.inline(pairs))
    member = F.struct("n", (-F.col("id")).alias("back"), "kind")
    groups = rows.groupBy("head", "tail").agg(F.collect_list(member).alias("all")).filter("size(all) > 1")
    near = F.transform("all", lambda m: F.struct(m["back"].alias("back"), F.filter("all", lambda o: (o["back"] != m["back"]) & (
        ((m["kind"] > 0) & (o["kind"] > 0)) | ((m["kind"] == 0) & (o["kind"] == 2)) | ((m["kind"] == 2) & (o["kind"] == 0)))).alias("others")))
    met = groups.select(F.explode(near).alias("m")).filter("size(m.others) > 0").select(
        (-F.col("m.back")).alias("id"), F.size("m.others").alias("met"),
        F.array_max(F.transform("m.others", lambda o: F.struct(o["n"].alias("n"), o["back"].alias("back")))).alias("near"))
    summed = met.groupBy("id").agg(F.sum("met").alias("n_near"), F.max("near").alias("near"))
    return forward.select("id", "word", "n").join(summed, "id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def group_variants(words: DataFrame, commoner: int = COMMONER) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of (word, n), all words different.

    A word's form is its neighbour of largest n (ties: smallest in code-point order), if that is at least `commoner`
    times its own; root is where following forms ends, the word itself without a form. Without words, no rows.
    """
    found = staged(neighbours(words))
    formed = staged(found.filter(F.col("near.n") >= commoner * F.col("n")).select("id", (-F.col("near.back")).alias("form_id"), F.col("near.n").alias("form_n")))
    # Counts grow `commoner`-fold with each step, so chains are short; each round doubles the steps taken.
    roots = formed.select("id", F.col("form_id").alias("root_id"))
    while True:
        onward = roots.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        moved = staged(roots.join(onward, "root_id", "left").select("id", F.coalesce("next_id", "root_id").alias("root_id"), F.col("next_id").isNotNull().alias("moved")))
        roots = moved.select("id", "root_id")
        if moved.filter("moved").isEmpty():
            break
    name = lambda which: found.select(F.col("id").alias(f"{which}_id"), F.col("word").alias(which))
    named = formed.join(roots, "id").join(name("form"), "form_id").join(name("root"), "root_id").select("id", "form", "root", "form_n")
    return found.join(named, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, change=None) -> DataFrame:
    """`group_variants` of the words of whole texts; `change` as in `count_words`.

    Null ids, repeated rows and ids are counted row by row; columns besides doc_id and text aren't read.
    """
    return group_variants(staged(count_words(docs, change)))
