"""Repeated runs of lines, found by a suffix array over line numbers; later copies are deleted.

The corpus is one sequence of lines per document.  Prefix doubling ranks all suffixes by their
first line, then by their first 2, 4, 8 ... lines: the rank of a suffix for 2h lines
is the place of its pair (rank for h lines, rank for h lines of the suffix h lines on) among all such
pairs.  Suffixes with equal ranks are an interval of the suffix array whose longest common prefix is at least that
many lines; a suffix alone in its interval has no copy and leaves the rounds.

A run counts as repeated from ``min_words`` words on, and goes whole.  It is the union of its windows that hold that many words
and would not without their last line, or not without their first: a line of the run with ``min_words`` words up to it ends a window
of the second kind, any other is in the window of the first kind that begins the run.  Every line has a word, so
a window has at most ``min_words`` lines, the rounds end there, and there are at most two windows for each line.
Depths between powers of two are met by two overlapping prefixes.  The first window of those alike
stays, the others' lines go; overlapping deletions join into maximal runs.

Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.operators.ordered import with_row_index
from clickloom.session import pin

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50


def numbered(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """Written table (doc, doc_id, lines, [text]): documents numbered by id, then text; null ids first, null texts empty.

    ``lines`` holds the md5 and the words of each line, split at line feeds.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), body.alias("text"), F.md5(body).alias("_key"))
    lines = F.transform(F.split("text", "\n", -1), lambda line: F.struct(
        F.unhex(F.md5(line)).alias("id"), F.regexp_count(line, F.lit(WORD)).alias("words")))
    rows = rows.select("doc_id", "_key", lines.alias("lines"), *(["text"] if keep_text else []))
    return with_row_index(rows, ["doc_id", "_key"], "doc").drop("_key")


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, pos, line, id, need, upto): lines with a word, numbered by ``pos`` in their document.

    ``need``: lines from here on that hold ``min_words`` words, null where the document ends before; ``upto``: the most lines from here
    on that would not hold them without the first, ``need`` at least.  A document is one row of the input, so no
    window is larger than that.
    """
    rows = docs.select("doc", F.posexplode("lines").alias("line", "_l")).select(
        "doc", "line", F.col("_l.id").alias("id"), F.col("_l.words").alias("words")).filter(F.col("words") > 0)
    of_doc = Window.partitionBy("doc").orderBy("line")
    rows = rows.withColumn("pos", F.row_number().over(of_doc) - 1)
    rows = rows.withColumn("_from", F.sum("words").over(of_doc) - F.col("words"))
    reach = Window.partitionBy("doc").orderBy("_from").rangeBetween(0, min_words - 1)
    rows = rows.withColumn("_lines", F.count("*").over(reach)).withColumn("_to", F.max(F.col("_from") + F.col("words")).over(reach))
    need = F.when(F.col("_to") - F.col("_from") >= min_words, F.col("_lines")).cast("int")
    rows = rows.withColumn("need", need).withColumn("_left", F.count("*").over(Window.partitionBy("doc")) - F.col("pos"))
    after = F.coalesce(F.lead("need").over(Window.partitionBy("doc").orderBy("_from")), F.col("_left"))
    upto = F.when(F.col("need").isNotNull(), F.greatest("need", after)).cast("int")
    return rows.select("doc", "pos", "line", "id", "need", upto.alias("upto"))


def _ranked(pairs: DataFrame, by: list[str]) -> DataFrame:
    """(by..., rank) of the values that occur twice or more, in order.  Only distinct values are sorted."""
    repeated = pairs.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(*by)
    return pin(with_row_index(repeated, by, "rank"), "line-ranks")


def intervals(lines: DataFrame, min_words: int) -> list[DataFrame]:
    """Per round the written table (doc, pos, need, upto, rank) of the suffixes that share their first 1, 2, 4, ... lines with another."""
    first = _ranked(lines.select("id"), ["id"])
    suffixes = pin(lines.join(first, "id").select("doc", "pos", "need", "upto", "rank"), "line-suffixes")
    levels, depth = [suffixes], 1
    while 2 * depth <= min_words:
        ahead = Window.partitionBy("doc").orderBy("pos").rangeBetween(depth, depth)
        pairs = suffixes.withColumn("then", F.max("rank").over(ahead)).filter(F.col("then").isNotNull())
        pairs = pin(pairs.withColumnRenamed("rank", "start"), "line-pairs")
        ranks = _ranked(pairs, ["start", "then"])
        suffixes = pin(pairs.join(ranks, ["start", "then"]).select("doc", "pos", "need", "upto", "rank"), "line-suffixes")
        if suffixes.isEmpty():
            break
        levels.append(suffixes)
        depth *= 2
    return levels


def later_copies(levels: list[DataFrame]) -> DataFrame:
    """(doc, pos, size): windows of ``size`` lines, ``need`` to ``upto``, that stand earlier in the corpus too."""
    out = None
    for level, suffixes in enumerate(levels):
        depth = 1 << level
        due = suffixes.filter((F.col("upto") >= depth) & (F.col("need") < 2 * depth)).withColumn("size", F.explode(F.sequence(
            F.greatest("need", F.lit(depth)), F.least("upto", F.lit(2 * depth - 1)))))
        if level:
            end = suffixes.select("doc", (F.col("pos") + depth).alias("_end"), F.col("rank").alias("then"))
            due = due.withColumn("_end", F.col("pos") + F.col("size")).join(end, ["doc", "_end"])
        else:
            due = due.withColumn("then", F.col("rank"))
        due = pin(due.select("doc", "pos", "size", "rank", "then"), "line-due")
        kept = pin(due.groupBy("size", "rank", "then").agg(
            F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n")).filter(F.col("n") > 1), "line-first")
        found = (due.join(kept, ["size", "rank", "then"]).filter(F.struct("doc", "pos") > F.col("first"))
                 .select("doc", "pos", "size"))
        out = found if out is None else out.union(found)
    return out


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Written table (doc, deleted): the line numbers, ascending, that go from each document of ``numbered`` that loses any."""
    lines = pin(line_table(docs, min_words), "line-table")
    runs = later_copies(intervals(lines, min_words))
    covered = runs.select("doc", F.explode(F.sequence("pos", F.col("pos") + F.col("size") - 1)).alias("pos")).distinct()
    gone = covered.join(lines.select("doc", "pos", "line"), ["doc", "pos"])
    return pin(gone.groupBy("doc").agg(F.array_sort(F.collect_list("line")).alias("deleted")), "line-deleted")


def _kept_lines(size, deleted):
    every = F.sequence(F.lit(0), size - 1)
    return F.when(deleted.isNull(), every).otherwise(F.array_except(every, deleted))


def delete_repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, deleted) of every document, its later copies of repeated runs deleted.

    Lines without a word are never part of a run and stay.  Of repeated rows the first keeps its lines.  A document
    that loses all lines keeps an empty text; null texts become empty; other columns are ignored.
    """
    rows = numbered(docs, key, text, keep_text=True)
    gone = deleted_lines(rows, min_words)
    lines = F.split("text", "\n", -1)
    kept = F.transform(_kept_lines(F.size(lines), F.col("deleted")), lambda i: F.element_at(lines, i + 1))
    return (rows.join(gone, "doc", "left").select(
        "doc_id", F.when(F.col("deleted").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce("deleted", F.array().cast("array<int>")).alias("deleted")))


def run_report(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_deleted, deleted_words, kept_digest.

    ``kept_digest``: md5 of the md5s of the lines that stay.  The texts themselves
    are not moved: lines stand for themselves by their md5.  Null and empty texts have one line, without a word, that stays; of repeated
    rows the first keeps its lines; null ids come first; an empty table stays empty.
    """
    rows = numbered(docs, key, text)
    gone = deleted_lines(rows, min_words)
    joined = rows.join(gone, "doc", "left")
    empty = F.array().cast("array<int>")
    deleted = F.coalesce("deleted", empty)
    words = F.aggregate(F.transform(deleted, lambda i: F.element_at("lines", i + 1)["words"]), F.lit(0), lambda a, w: a + w)
    kept = F.transform(_kept_lines(F.size("lines"), F.col("deleted")), lambda i: F.lower(F.hex(F.element_at("lines", i + 1)["id"])))
    return joined.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size(deleted).cast("long").alias("n_deleted"),
                         words.cast("long").alias("deleted_words"), F.md5(F.array_join(kept, "")).alias("kept_digest"))
