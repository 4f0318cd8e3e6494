"""Distributed radix sort, least significant digit first, of tables too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.session import pin

#: Rows of one counting block, and most bits of a digit: there is at most one count for 8 rows.
BLOCK, DIGIT_BITS = 1 << 14, 11
_AT, _DIGIT, _BLOCK, _N = "loom_radix_at", "loom_radix_digit", "loom_radix_block", "loom_radix_n"
_START, _BEFORE, _NTH = "loom_radix_start", "loom_radix_before", "loom_radix_nth"


def composite_digits(rows: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The digits of the composite key of integer columns (the first is the most significant), least significant first.

    Leading bits that all values of a column share do not order anything and get no digit; a column with nulls
    has one more bit on top, so nulls come last.  One aggregate finds the bits.
    """
    found = rows.agg(*[f(k).alias(f"_{i}{f.__name__}") for i, k in enumerate(keys) for f in (F.min, F.max)],
                     *[F.count_if(F.col(k).isNull()).alias(f"_{i}null") for i, k in enumerate(keys)]).first()
    pieces: list[tuple[Column, int]] = []                            # (value, bits), least significant column first
    for i, key in reversed(list(enumerate(keys))):
        low, high = found[f"_{i}min"], found[f"_{i}max"]
        if low is not None:
            bits = ((low ^ high) & ((1 << 64) - 1)).bit_length()
            value = F.coalesce(F.col(key).cast("long"), F.lit(low).cast("long"))
            pieces.append((value.bitwiseXOR(F.lit(-1 << 63)) if bits == 64 else value, bits))
        if found[f"_{i}null"]:
            pieces.append((F.col(key).isNull().cast("long"), 1))
    total = sum(bits for _, bits in pieces)
    if not total:
        return []
    passes = -(-total // DIGIT_BITS)
    digits, want = [], [total // passes + (i < total % passes) for i in range(passes)]
    value, have, taken = None, 0, 0
    for width in want:
        digit, filled = F.lit(0).cast("long"), 0
        while filled < width:
            if taken == have:
                (value, have), taken = pieces.pop(0), 0
            n = min(width - filled, have - taken)
            part = F.shiftrightunsigned(value, taken).bitwiseAND(F.lit((1 << n) - 1).cast("long"))
            digit = digit.bitwiseOR(F.shiftleft(part, filled))
            filled, taken = filled + n, taken + n
        digits.append(digit.cast("int"))
    return digits


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One stable counting-sort pass: ``rows`` with their new places.

    Rows are counted by digit and block of places.  The start of a digit is the sum of all smaller ones (at most
    2 ** 11 totals), that of a block within its digit the sum of the blocks before; a row's destination is both plus
    its place among the equal digits of its block.  A block has a bounded number of rows, so a digit that most rows
    share is spread over as many groups as there are blocks.
    """
    cut = rows.withColumn(_DIGIT, digit).withColumn(_BLOCK, F.floor(F.col(_AT) / BLOCK).cast("long"))
    counts = cut.groupBy(_DIGIT, _BLOCK).agg(F.count(F.lit(1)).alias(_N))
    before = F.sum(_N).over(Window.partitionBy(_DIGIT).orderBy(_BLOCK)) - F.col(_N)
    totals = counts.groupBy(F.col(_DIGIT).alias("_of")).agg(F.sum(_N).alias("_total"))
    start = F.sum("_total").over(Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_total")
    starts = totals.select("_of", start.alias(_START))
    offsets = (counts.select(_DIGIT, _BLOCK, before.alias(_BEFORE)).join(starts, F.col(_DIGIT) == F.col("_of"))
               .select(_DIGIT, _BLOCK, (F.col(_START) + F.col(_BEFORE)).alias(_START)))
    nth = F.row_number().over(Window.partitionBy(_DIGIT, _BLOCK).orderBy(_AT))
    return (cut.withColumn(_NTH, nth).join(offsets, [_DIGIT, _BLOCK])
            .withColumn(_AT, (F.col(_START) + F.col(_NTH) - 1).cast("long")).drop(_DIGIT, _BLOCK, _START, _NTH))


def radix_ranks(rows: DataFrame, keys: Sequence[str], name: str = "rank") -> DataFrame:
    """Written table of ``rows`` with ``name``: 1, 2, 3... in ascending order of the integer columns ``keys``, nulls last.

    Each pass is written, so a lost executor repeats one pass.  Rows equal in all keys follow each other in any order;
    name every column that tells rows apart among the keys where that matters.  An empty table stays empty.
    """
    placed = pin(rows.withColumn(_AT, F.monotonically_increasing_id()), "radix")
    digits = composite_digits(placed, keys)
    if not digits:            # all keys equal: any order will do, but places are to be without gaps
        digits = [F.lit(0)]
    for digit in digits:
        placed = pin(counting_pass(placed, digit), "radix")
    return placed.withColumn(name, F.col(_AT) + 1).drop(_AT)
