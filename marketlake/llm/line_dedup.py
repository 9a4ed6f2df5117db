"""Line dedup: winnowed line hashes find repeated runs, later ones are deleted.

A document is the sequence of its non-blank lines. A window counts when it has ``run``
lines, or fewer that hold ``words`` words together; a document of less than ``run``
lines is a window of its own as well. Winnowing selects the smallest line hash of each
such window (of equal ones the rightmost), so two documents that share a window are
guaranteed to select the same line in it. Then

1. selected lines, once each however many windows chose them, are stored as
   fingerprints with the lines next to them, and those selected at one place only,
   which cannot be part of a repeated run, are dropped;
2. the places of the others are extended both ways, line by line, to the windows that
   selected them, and each extended place is joined with the first place, in the order
   of (doc_id, line), whose lines read the same;
3. extended lines are compared with the first place's one by one; a window that
   agrees in all of them is deleted. A longer run selects a line in each of its
   windows, so its pieces meet and together cover all of it.

Places are never paired with each other: the first place of a window is a minimum with
a map-side partial aggregate, so a line that a third of all documents hold costs one
row per task, and joins have exchanges right under both sides, which AQE splits on a
hot key. Lines are identified by 128 bits of hash. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored, without_spaces

#: Lines of the longest window: runs of so many lines are deleted whatever they hold.
RUN = 3
#: Words of a shorter run that is deleted.
WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _filled(lines: Column) -> Column:
    """Two hashes, words and place of the non-blank lines."""
    marked = F.transform(lines, lambda x, p: F.when(without_spaces(x) != "", F.struct(
        F.xxhash64(x).alias("hash"), F.xxhash64(F.lit(1), x).alias("other"),
        F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"), p.alias("place"))))
    return F.filter(marked, lambda s: s.isNotNull())


def _windows(lines: Column, run: int, words: int) -> Column:
    """Begin (from 1), size and selected line (from 1) of every window of ``lines``."""
    n = F.size(lines)
    # Each line next to the ones that follow it; null beyond the last.
    columns = [F.slice(lines[c], k + 1, n).alias(f"{c}{k}") for c in ("hash", "words") for k in range(run)]
    beside = F.arrays_zip(*columns)

    def window(x: Column, i: Column, size: int) -> Column:
        chosen, least = i + 1, x["hash0"]
        for k in range(1, size):  # of equal lines the rightmost is taken
            chosen = F.when(x[f"hash{k}"] <= least, i + 1 + k).otherwise(chosen)
            least = F.least(least, x[f"hash{k}"])
        there = x[f"hash{size - 1}"].isNotNull()
        if size < run:
            held = x["words0"]
            for k in range(1, size):
                held = held + x[f"words{k}"]
            there = there & ((held >= words) | ((n == size) & (i == 0)))
        return F.when(there, F.struct((i + 1).alias("begin"), F.lit(size).alias("size"), chosen.alias("chosen")))

    every = F.flatten(F.transform(beside, lambda x, i: F.array(*[window(x, i, size) for size in range(1, run + 1)])))
    return F.filter(every, lambda w: w.isNotNull())


def delete_repeated_runs(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """``docs`` (doc_id, text) without later repeats of runs of ``run`` or more lines, or
    of ``words`` or more words.

    Returns one row per input row: doc_id, n_lines, n_removed (long) and text, what
    is left of it. Lines end at a line feed and are compared as they are; blank lines
    are neither compared nor deleted, and do not interrupt a run.

    - A run that occurred before in the order of (doc_id, line) is deleted, also within
      one document. Of two runs that overlap in one document the later one is a repeat.
    - A document of less than ``run`` non-blank lines whose lines are all those of an
      earlier such document is deleted as well, however few words it has.
    - A null text has no lines and stays null; an empty text is one blank line.
    - Rows that repeat both doc_id and text are one document: each gives a row,
      all with the same text. Of rows that share a doc_id the text's hash decides
      the order; a null doc_id comes last.
    - Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("sum"))
    lines = _lines(F.col("text"))
    hashed = rows.where(F.length("text") > 0).select("doc_id", "sum", _filled(lines).alias("filled"))
    chosen = F.array_distinct(_windows(F.col("filled"), run, words)["chosen"])
    begin = F.greatest(F.col("p") - run + 1, F.lit(1))
    fingerprints = stored(spark, (
        hashed.select("doc_id", "sum", "filled", F.explode(chosen).alias("p"))
        .select("doc_id", "sum", F.get("filled", F.col("p") - 1)["hash"].alias("hash"),
                F.get("filled", F.col("p") - 1)["place"].alias("place"),
                F.slice("filled", begin, F.col("p") - begin + run).alias("near"), (F.col("p") - begin + 1).alias("here"),
                (F.size("filled") < run).alias("short"))
    ), "line-fingerprints")
    at = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "sum", "place")
    shared = stored(spark, (
        fingerprints.groupBy("hash").agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .where("first <> last").select("hash")
    ), "line-shared")
    # The windows that selected the place, from the lines around it. Short documents
    # match each other only, unless they have the words of a run.
    around = F.filter(_windows(F.col("near"), run, words), lambda w: w["chosen"] == F.col("here"))
    extended = fingerprints.join(shared, "hash").select(
        "doc_id", "sum", "near", "short", F.explode(around).alias("w")).withColumn(
        "lines", F.slice("near", F.col("w.begin"), F.col("w.size"))
    ).select(
        F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "sum", F.get("lines", F.lit(0))["place"].alias("place")).alias("at"),
        F.struct(F.col("lines.hash").alias("hash"), F.col("lines.other").alias("other")).alias("reads"),
        F.col("lines.place").alias("covers"),
        (F.col("short") & (F.aggregate("lines.words", F.lit(0), lambda a, x: a + x) < words)).alias("alone"),
    ).select("*", F.xxhash64("alone", "reads").alias("one"), F.xxhash64(F.lit(1), "alone", "reads").alias("two"))
    extended = stored(spark, extended, "line-extended")
    firsts = stored(spark, (
        extended.groupBy("one", "two").agg(F.min(F.struct("at", "reads")).alias("first"), F.max("at").alias("last"))
        .where("first.at <> last").select("one", "two", F.col("first.at").alias("first"), F.col("first.reads").alias("reads_first"))
    ), "line-firsts")
    agree = F.forall(F.zip_with("reads.hash", "reads_first.hash", lambda a, b: a.eqNullSafe(b)), lambda x: x) & F.forall(
        F.zip_with("reads.other", "reads_first.other", lambda a, b: a.eqNullSafe(b)), lambda x: x)
    later = extended.join(firsts.hint("merge"), ["one", "two"]).where((F.col("at") != F.col("first")) & agree)
    removed = stored(spark, (
        later.select(F.col("at.doc_id").alias("of"), F.col("at.sum").alias("of_sum"), F.explode("covers").alias("line"))
        .groupBy("of", "of_sum").agg(F.collect_set("line").alias("gone"))
    ), "line-removed")
    # A sort-merge join by hint: the table of removed lines grows with the documents.
    removed = removed.hint("merge")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return (
        rows.join(removed, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("sum") == F.col("of_sum")), "left")
        .withColumn("lines", lines)
        .select(
            "doc_id",
            F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
            F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
            F.when(F.col("gone").isNull(), F.col("text")).otherwise(
                F.array_join(F.transform(kept, lambda p: F.get("lines", p)), "\n")).alias("text"),
        )
    )
