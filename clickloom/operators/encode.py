"""Feature encoding: one-hot dictionaries and vectors, crosses, scaling, selection."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Interaction, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from clickloom.operators.ordered import with_row_index
from clickloom.session import pin, scratch_path


HELD_BYTES = 16 << 20        # values of a feature up to this size are broadcast
HELD_TOGETHER = 64 << 20     # and those of all such features of one plan up to this size
VALUE_OVERHEAD = 40          # bytes a value takes besides its characters
MOST_LABELS = 1_000_000      # values a saved one-hot model may hold
TASK_VALUES = 500_000        # values a task unpivots
WIDE = 16                    # values of a row from which on it is worth moving rows, so that tasks are even


def booleans_as_int(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]
    return df.withColumns({c: F.col(c).cast("int") for c in names}) if names else df


def tasks_of(rows: int, width: int) -> int:
    """Tasks that ``rows`` rows of ``width`` values are dealt to: narrow rows lie in few files, however much there is to do for each."""
    return max(1, -(-rows * width // TASK_VALUES))


# --- one-hot dictionary in long form ------------------------------------------

def feature_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Observed (feature, value) pairs with their row counts.

    The rows are unpivoted in the map task and collapse there: only distinct
    pairs are shuffled.
    """
    values = F.array(*[F.col(f).cast("string") for f in features]).cast("array<string>")
    names = F.array(*[F.lit(f) for f in features]).cast("array<string>")
    found = (booleans_as_int(df).select(F.posexplode(values).alias("feature_no", "value")).dropna(subset=["value"])
             .groupBy("feature_no", "value").agg(F.count("*").alias("n")))
    return found.select("feature_no", F.get(names, F.col("feature_no")).alias("feature"), "value", "n")


def dictionary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One column index per observed (feature, value): features in the given order,
    values ascending (as numbers where they are numbers).

    A written table: encoding joins it by its measured size.
    """
    numeric = F.expr("try_cast(value AS double)")
    found = feature_values(df, features).withColumn("_number", numeric)
    return pin(with_row_index(found, ["feature_no", "_number", "value"], "index")
               .select("feature", "value", "index", "n"), "dictionary")


def feature_blocks(dictionary_table: DataFrame) -> DataFrame:
    """Number of columns and first column of each feature."""
    return dictionary_table.groupBy("feature").agg(
        F.count("*").alias("size"), F.min("index").alias("offset"))


def small_features(dictionary_table: DataFrame) -> set[str]:
    """Features whose values, measured in bytes, every machine can hold at once: the smallest, up to ``HELD_TOGETHER`` in all
    (one row per feature is read)."""
    measured = dictionary_table.groupBy("feature").agg(F.sum(F.octet_length("value") + F.lit(VALUE_OVERHEAD)).alias("bytes"))
    held, small = 0, set()
    for row in sorted(measured.collect(), key=lambda r: (r.bytes, r.feature)):
        held += row.bytes
        if row.bytes <= HELD_BYTES and held <= HELD_TOGETHER:
            small.add(row.feature)
    return small


def encode_indices(df: DataFrame, dictionary_table: DataFrame, features: Sequence[str],
                   unseen: str = "keep") -> DataFrame:
    """Add ``<feature>_index`` columns; unseen values give null, or fail with ``unseen='error'``.

    The join of each feature goes by the measured size of its own values: small ones are broadcast, so one feature
    with many values does not make the rows move for all others.
    """
    rows, small = booleans_as_int(df), small_features(dictionary_table)
    for f in features:
        known = dictionary_table.filter(F.col("feature") == f).select(
            F.col("value").alias("_value"), F.col("index").alias(f"{f}_index"))
        known = F.broadcast(known) if f in small else known.hint("merge")
        rows = rows.join(known, F.col(f).cast("string") == F.col("_value"), "left").drop("_value")
        if unseen == "error":
            seen = F.col(f).isNull() | F.col(f"{f}_index").isNotNull()
            rows = rows.filter(F.assert_true(seen, F.lit(f"unseen value of {f}")).isNull())
    return rows


def encode_rows(df: DataFrame, dictionary_table: DataFrame, features: Sequence[str], numeric: Sequence[str] = (),
                keep: Sequence[str] = (), unseen: str = "keep", output: str = "features") -> DataFrame:
    """Written table of the ``keep`` columns and the sparse vector of each row.

    The rows are written once with a number, dealt evenly to tasks if they are wide, unpivoted to (row, feature, value), and meet the
    whole dictionary in one join, planned from its size; one aggregate by row number puts them together again.  So the values are shuffled
    twice at most, and the plan is the same for any number of features.  The values never pass the driver.  Columns follow the dictionary, in whatever order
    ``features`` come; after them stand the ``numeric`` columns, then for each of these a column that is 1 where the number is
    missing (the number itself is 0 there).
    """
    stored = vector_parts(df, dictionary_table, features, numeric, keep, unseen, output)
    path = scratch_path(df.sparkSession, "encoded")
    stored.write.parquet(path)
    schema = StructType([*stored.select(*keep).schema.fields, StructField(output, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def vector_parts(df: DataFrame, dictionary_table: DataFrame, features: Sequence[str], numeric: Sequence[str], keep: Sequence[str],
                 unseen: str, output: str) -> DataFrame:
    """The rows of ``encode_rows`` with the parts a sparse vector is stored in."""
    total, known = dictionary_table.count(), len(numeric)
    df = booleans_as_int(df)
    held = F.struct(F.lit(True).alias("_there"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    base = pin(df.select(
        F.monotonically_increasing_id().alias("row"), held.alias("held"),
        F.array(*[F.col(c).cast("double") for c in numeric]).cast("array<double>").alias("numbers"),
        F.array(*[F.col(f).cast("string") for f in features]).cast("array<string>").alias("values")), "encode")
    names = F.array(*[F.lit(f) for f in features]).cast("array<string>")
    words = dictionary_table.select(F.array_position(names, F.col("feature")).cast("int").alias("of"),
                                    F.col("value").alias("known"), F.col("index").cast("int").alias("index")).filter(F.col("of") > 0)
    dealt = base
    if len(features) >= WIDE and (tasks := tasks_of(base.count(), len(features))) > 1:
        dealt = base.repartition(tasks)
    first = F.coalesce(F.col("no"), F.lit(0)) == 0                # this one of a row's values carries what is kept
    each = (dealt.select("*", F.posexplode_outer("values").alias("no", "value")).filter(first | F.col("value").isNotNull())
            .select("row", "no", "value", F.when(first, F.col("held")).alias("held"), F.when(first, F.col("numbers")).alias("numbers")))
    parts = each.join(words, (F.col("no") + 1 == F.col("of")) & (F.col("value") == F.col("known")), "left")
    if unseen == "error":
        told = F.concat(F.lit("unseen value of "), F.get(names, F.col("no")))
        parts = parts.filter(F.assert_true(F.col("value").isNull() | F.col("index").isNotNull(), told).isNull())
    rows = parts.groupBy("row").agg(F.array_sort(F.collect_list("index")).alias("indices"), F.first("held", True).alias("held"),
                                    F.first("numbers", True).alias("numbers"))
    places, values = F.col("indices"), F.array_repeat(F.lit(1.0), F.size("indices"))
    if numeric:
        numbers = F.col("numbers")
        absent = F.filter(F.transform(numbers, lambda v, i: F.when(v.isNull(), F.lit(total + known) + i)), lambda i: i.isNotNull())
        places = F.concat(places, F.transform(numbers, lambda _, i: F.lit(total) + i), absent)
        values = F.concat(values, F.transform(numbers, lambda v: F.coalesce(v, F.lit(0.0))), F.array_repeat(F.lit(1.0), F.size(absent)))
    # the stored form of a sparse vector: type 0, size, positions, values
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(total + 2 * known).alias("size"),
                      places.alias("indices"), values.alias("values"))
    return rows.select(*[F.col("held")[f"c{i}"].alias(c) for i, c in enumerate(keep)], vector.alias(output))


# --- one-hot vectors ---------------------------------------------------------------

def one_hot(train: DataFrame, features: Sequence[str], unseen: str = "keep", output: str = "features") -> PipelineModel:
    """One-hot encoding as a fitted Spark ML model, for where one is to be saved.

    Its columns are those of ``dictionary``, in that order.  With ``unseen='keep'`` a value not seen in ``train`` (or
    null) gives an all-zero block: the indexer puts it in a last category, which the encoder drops.

    Such a model holds all its labels, like the model coefficients that refer to them, so they pass the driver here, and there
    may be at most ``MOST_LABELS``; ``encode_rows`` gives the same columns for any number and keeps the values distributed.
    """
    keep = unseen == "keep"
    # distinct scratch names, so that several groups can encode one table
    index = [f"_{output}_{f}_index" for f in features]
    blocks = [f"_{output}_{f}_block" for f in features]
    labels: dict[str, list[str]] = {f: [] for f in features}
    words = dictionary(train, features)
    if words.count() > MOST_LABELS:
        raise ValueError(f"over {MOST_LABELS} values: a saved model cannot hold them, use encode_rows")
    for row in words.orderBy("index").collect():
        labels[row.feature].append(row.value)
    indexers = [StringIndexerModel.from_labels(labels[f], inputCol=f, outputCol=i, handleInvalid="keep" if keep else "error")
                for f, i in zip(features, index, strict=True)]
    encoder = OneHotEncoder(inputCols=index, outputCols=blocks, dropLast=keep)
    assembler = VectorAssembler(inputCols=blocks, outputCol=output)
    return Pipeline(stages=[*indexers, encoder, assembler]).fit(booleans_as_int(train))


def apply_encoding(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Encode and drop the scratch columns."""
    encoded = model.transform(booleans_as_int(df))
    return encoded.drop(*[c for c in encoded.columns if c.startswith("_") and c.endswith(("_index", "_block"))])


def one_hot_groups(train: DataFrame, groups: dict[str, Sequence[str]], unseen: str = "keep") -> dict[str, PipelineModel]:
    """One encoding per feature group, each into its own vector column."""
    return {name: one_hot(train, features, unseen, output=name) for name, features in groups.items()}


def concatenate(df: DataFrame, columns: Sequence[str], output: str = "features",
                missing: str = "error") -> DataFrame:
    """Side-by-side concatenation of vector and number columns, row by row.

    ``missing='keep'`` turns nulls into NaN (vector columns then need a declared size).
    """
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=missing).transform(df)


def truncated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Real columns as whole numbers, the way integer-only encoders read them."""
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


# --- crosses ---------------------------------------------------------------------------

def cross_name(left: str, right: str) -> str:
    return f"{left}×{right}"


def cross_counts(df: DataFrame, left: Sequence[str], right: Sequence[str], min_rows: int = 1) -> DataFrame:
    """Observed value pairs for every left x right feature pair, with row counts.

    A cross column of one-hot blocks is non-zero exactly for an observed pair, so
    no empty column is ever made.  The number of pairs per row is the fixed number
    of feature pairs; they collapse in the map task.
    """
    pairs = F.array(*[
        F.struct(F.lit(a).alias("left"), F.col(a).cast("string").alias("left_value"),
                 F.lit(b).alias("right"), F.col(b).cast("string").alias("right_value"))
        for a in left for b in right])
    counted = (booleans_as_int(df).select(F.inline(pairs)).dropna(subset=["left_value", "right_value"])
               .groupBy("left", "left_value", "right", "right_value").agg(F.count("*").alias("n")))
    return counted.filter(F.col("n") >= min_rows) if min_rows > 1 else counted


def cross_counts_pairwise(df: DataFrame, *groups: Sequence[str], min_rows: int = 1) -> DataFrame:
    """Crosses of every two groups (no triples), in one scan."""
    parts = []
    for a, b in combinations(groups, 2):
        parts += [(x, y) for x in a for y in b]
    pairs = F.array(*[
        F.struct(F.lit(a).alias("left"), F.col(a).cast("string").alias("left_value"),
                 F.lit(b).alias("right"), F.col(b).cast("string").alias("right_value"))
        for a, b in parts])
    counted = (booleans_as_int(df).select(F.inline(pairs)).dropna(subset=["left_value", "right_value"])
               .groupBy("left", "left_value", "right", "right_value").agg(F.count("*").alias("n")))
    return counted.filter(F.col("n") >= min_rows) if min_rows > 1 else counted


def add_crosses(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """One categorical column per feature pair, ready to be encoded: both values with ``×`` between, which is escaped in the left one,
    so that different pairs of values stay different."""
    rows = booleans_as_int(df)

    def whole(c: str) -> Column:
        return F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("×"), F.lit("\\×"))

    made = {cross_name(a, b): F.concat(whole(a), F.lit("×"), F.col(b).cast("string")) for a in left for b in right}
    return rows.withColumns(made), list(made)


def cross_vectors(df: DataFrame, left: str, right: str, output: str) -> DataFrame:
    """All products of two vectors, left index major."""
    return Interaction(inputCols=[left, right], outputCol=output).transform(df)


# --- scaling and expansion ----------------------------------------------------------------

def standardise(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    base = df if fitted_on is None else fitted_on
    stats = base.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                                for c in columns]).alias("b")).scalar()
    scaled = {}
    for c in columns:
        deviation = F.when(F.col(f"_b.{c}.s") == 0, F.lit(1.0)).otherwise(F.col(f"_b.{c}.s"))
        scaled[c] = (F.col(c) - F.col(f"_b.{c}.m")) / deviation
    return df.withColumn("_b", stats).withColumns(scaled).drop("_b")


def polynomial(df: DataFrame, columns: Sequence[str], degree: int = 2, interaction_only: bool = False,
               constant: bool = True) -> tuple[DataFrame, list[str]]:
    """Products of up to ``degree`` columns as plain column expressions, e.g. ``a``, ``a*b``, ``a*a``."""
    choose = combinations if interaction_only else combinations_with_replacement
    terms = {"1": F.lit(1.0)} if constant else {}
    for d in range(1, degree + 1):
        for picked in choose(columns, d):
            value = F.col(picked[0]).cast("double")
            for c in picked[1:]:
                value = value * F.col(c)
            terms["*".join(picked)] = value
    return df.withColumns(terms), list(terms)


def f_scores(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Univariate regression score of each feature: r^2 (n - 2) / (1 - r^2), in one scan."""
    stats = []
    for f in features:
        both = F.col(f).isNotNull() & F.col(target).isNotNull()
        r = F.corr(f, target)
        stats.append(F.struct(F.lit(f).alias("feature"), r.alias("r"), F.count_if(both).alias("n")))
    rows = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    square = F.col("r") * F.col("r")
    return rows.withColumn("f_score", F.try_divide(square * (F.col("n") - 2), 1 - square))


def k_best(df: DataFrame, features: Sequence[str], target: str, k: int) -> list[str]:
    """Names of the ``k`` highest-scoring features (one row per feature reaches the driver)."""
    scored = f_scores(df, features, target).orderBy(F.desc_nulls_last("f_score"), "feature").limit(k)
    best = {row.feature for row in scored.collect()}
    return [f for f in features if f in best]
