"""Mixing sources to target weights by hash thresholds found from histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.columns import shield
from clickloom.operators.ordered import with_row_index
from clickloom.session import pin

HASH_BITS = 60
SIZE = "loom_mix_size"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(value: Column) -> Column:
    """60 bits of the md5 of the value as text; null hashes like the empty text."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Add ``target`` to a written table (source, source_size): weights go round in the order of the sources
    (code points, null last) and share the total; a target stops at ``most`` times its source, and the excess is
    shared again by weight until none is above.

    Each round is one aggregate: the share per weight only rises, so sources once capped stay capped.
    """
    placed = with_row_index(sizes, [F.asc_nulls_last("source")], "_at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    placed = pin(placed.withColumn("_weight", weight), "mix-sources")
    limit = F.col("source_size") * F.lit(most)
    total, per_weight, capped = None, 0.0, -1
    while True:
        above = F.col("_weight") * F.lit(per_weight) > limit
        got = placed.agg(F.sum("source_size"), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("_weight"))),
                         F.count_if(above)).first()
        total = got[0] or 0
        if not got[2] or got[3] == capped:
            break
        capped, per_weight = got[3], (total - (got[1] or 0.0)) / got[2]
    return placed.select("source", "source_size", F.least(limit, F.col("_weight") * F.lit(per_weight)).alias("target"))


def thresholds(rows: DataFrame, plan: DataFrame, bits: int = 12) -> DataFrame:
    """Per source the number of whole copies and the last hash that is taken once more.

    ``rows`` is a written table (source, size, hash); ``plan`` a written table (source, source_size, target).  The
    budget beyond whole copies is met by a prefix of the hashes.  Round by round sizes are summed by source and the next
    ``bits`` bits of the hash; the running sum names the bucket in which the budget ends, and only the rows of that
    bucket are summed more finely, until it holds one hash value.  That value is taken if the sum comes
    nearer to the budget with it.  Rows are never sorted.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("copies", whole.cast("long"))
    left = F.col("target") - F.col("copies") * F.col("source_size")
    state = pin(plan.select("source", "copies", left.alias("_left"), F.lit(0).cast("long").alias("_prefix"),
                            (left <= 0).alias("_done"), F.lit(-1).cast("long").alias("last")),
                "mix-state")
    shift = HASH_BITS
    while shift > 0:
        wide, shift = shift, max(0, shift - bits)
        size = 1 << (wide - shift)
        s = state.filter(~F.col("_done")).select(F.col("source").alias("_s"), "_left", "_prefix")
        inside = F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("hash", wide) == F.col("_prefix"))
        sums = (rows.join(s, inside).groupBy("source", F.shiftright("hash", shift).alias("_bucket"))
                .agg(F.sum("size").alias("_n"), F.first("_left").alias("_left"), F.min("hash").alias("_low"),
                     F.max("hash").alias("_high")))
        run = Window.partitionBy("source").orderBy("_bucket")   # at most 2 ** bits rows per source
        run_sum = F.sum("_n").over(run)
        ends = (sums.withColumn("_sum", run_sum).filter(F.col("_sum") > F.col("_left"))
                .groupBy("source").agg(F.min_by(F.struct("_bucket", "_n", "_sum", "_low", "_high"), "_bucket").alias("_e")))
        joined = state.join(ends.select(F.col("source").alias("_s"), "_e"), F.col("source").eqNullSafe(F.col("_s")), "left")
        before = F.col("_left") - (F.col("_e._sum") - F.col("_e._n"))
        # nothing exceeds the budget: all hashes below the end of the present bucket are taken
        beyond = ~F.col("_done") & F.col("_e").isNull()
        single = ~F.col("_done") & (F.col("_e._low") == F.col("_e._high"))
        nearer = F.abs(before - F.col("_e._n")) < F.abs(before)
        state = pin(joined.select(
            "source", "copies",
            F.when(F.col("_done") | beyond, F.col("_left")).otherwise(before).alias("_left"),
            F.when(F.col("_done") | beyond, F.col("_prefix")).otherwise(F.col("_e._bucket")).alias("_prefix"),
            (F.col("_done") | beyond | F.coalesce(single, F.lit(False))).alias("_done"),
            F.when(F.col("_done"), F.col("last"))
            .when(beyond, F.shiftleft(F.col("_prefix") + 1, wide) - 1)
            .when(single & nearer, F.col("_e._low"))
            .when(single, F.col("_e._low") - 1)
            .otherwise(F.lit(size).cast("long")).alias("last")), "mix-state")
        if state.filter(~F.col("_done")).isEmpty():
            break
    return state.select("source", "copies", "last")


def mix(df: DataFrame, source: str = "source", key: str = "doc_id", size: Column | None = None,
        weights: Sequence[float] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``most``) to every row of ``df``.

    Rows with the same key (and source) are taken together; a null key counts as the empty text, a null source is a source of its own
    and comes last; a row without words takes no words, and a source without words has target 0 and no copies.
    Nothing random: the hash of the key decides, and a smaller target takes a subset.
    Columns of ``df`` with the added names are replaced.
    """
    added = ["size", "source_size", "target", "copies"]
    size = word_count(F.col("text")) if size is None else size
    sized, back = shield(df.withColumn(SIZE, size), [source, key, SIZE])
    sized = sized.withColumnRenamed(SIZE, "size")
    own = [c for c in sized.columns if c != "size"]
    slim = pin(sized.select(F.col(source).alias("source"), "size", hash60(F.col(key)).alias("hash")), "mix-sizes")
    sizes = pin(slim.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-source-sizes")
    plan = pin(targets(sizes, weights, most), "mix-plan")
    cuts = thresholds(slim, plan)
    plan = plan.join(cuts.select(F.col("source").alias("_s"), "copies", "last"), F.col("source").eqNullSafe(F.col("_s")))
    plan = pin(plan.select(F.col("source").alias("_source"), "source_size", "target", F.col("copies").alias("_whole"),
                           F.col("last").alias("_last")), "mix-cuts")
    once_more = F.when(hash60(F.col(key)) <= F.col("_last"), 1).otherwise(0)
    out = (sized.join(plan, F.col(source).eqNullSafe(F.col("_source")))
           .select(*own, "size", "source_size", "target", (F.col("_whole") + once_more).cast("long").alias("copies")))
    return back(out, added)


def take(df: DataFrame, copies: str = "copies") -> DataFrame:
    """The mix itself: each row as many times as it is taken; rows with a null or zero number go, equal rows are taken each, and an
    empty table stays empty."""
    rows, back = shield(df, [copies])
    return back(rows.filter(F.col(copies) > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(copies)))).drop("_copy"))
