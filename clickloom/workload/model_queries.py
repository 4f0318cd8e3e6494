"""J, and the modelling and forecasting groups of K."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import encode, passes
from clickloom.operators import modelling as m
from clickloom.operators.aggregates import scale_min_max
from clickloom.operators.boosting import GradientBoosting
from clickloom.operators.joins import flag_members
from clickloom.operators.ordered import shift_cycle
from clickloom.operators.series import twelve_slots
from clickloom.plans import run, training
from clickloom.plans import travel_time as plan
from clickloom.session import pin, scratch_path
from clickloom.sources.sinks import write_model
from clickloom.sources.store import FeatureStore
from clickloom.workload.group_queries import assembled, click_parts, features, user_and_ad_groups
from clickloom.workload.registry import encoded_rows, encoded_sql, query, rounded, with_time_text
from clickloom.workload.roles import Roles
from clickloom.workload.series_queries import PERIOD, last_week, regular, split_day

CODES = ["positionID", "connectionType", "telecomsOperator"]
ITERATIONS = 14  # optimiser passes of the tuned model
ORDER = ["clickTime", "event_id"]


def _values_sql(base: str, features: list[str], order: str = "value::DOUBLE") -> str:
    parts = " UNION ALL ".join(
        f"SELECT {i} AS no, '{c}' AS feature, {c}::VARCHAR AS value, count(*) AS n FROM {base} WHERE {c} IS NOT NULL "
        f"GROUP BY {c}" for i, c in enumerate(features))
    return f'SELECT feature, value, row_number() OVER (ORDER BY no, {order}) - 1 AS "index", n FROM ({parts})'


@query("j01_one_hot_dictionary", _values_sql("wide", CODES))
def one_hot_dictionary(r: Roles) -> DataFrame:
    return encode.dictionary(r.wide, CODES)


@query("j01b_feature_blocks", f"""
    SELECT feature, count(*) AS size, min("index") AS "offset" FROM ({_values_sql("wide", CODES)}) GROUP BY 1""")
def feature_blocks(r: Roles) -> DataFrame:
    return encode.feature_blocks(encode.dictionary(r.wide, CODES))


@query("j01c_one_hot_vectors", f"""
    SELECT "index"::INTEGER AS "index", n::DOUBLE AS total FROM ({_values_sql("wide", CODES)})""")
def one_hot_vectors(r: Roles) -> DataFrame:
    """Column sums of the encoded matrix."""
    rows = encode.encode_rows(r.wide, encode.dictionary(r.wide, CODES), CODES)
    each = rows.select(F.explode(F.arrays_zip(*[F.unwrap_udt(F.col("features"))[c] for c in ("indices", "values")])).alias("e"))
    return each.groupBy(F.col("e.indices").alias("index")).agg(F.sum("e.values").alias("total"))


@query("j02_unseen_values", f"""
    WITH d AS ({_values_sql("(SELECT * FROM clicks_with_id WHERE clickTime < 20000)", ["userID", "creativeID"])})
    SELECT event_id, userID, creativeID, u."index" AS "userID_index", c."index" AS "creativeID_index"
    FROM clicks_with_id LEFT JOIN (SELECT * FROM d WHERE feature = 'userID') u ON u.value = userID::VARCHAR
                        LEFT JOIN (SELECT * FROM d WHERE feature = 'creativeID') c ON c.value = creativeID::VARCHAR""")
def unseen_values(r: Roles) -> DataFrame:
    """All clicks encoded with the values of the first day: others are left without an index."""
    clicks = r.clicks_with_id.select("event_id", "userID", "creativeID", "clickTime")
    first = encode.dictionary(clicks.filter(F.col("clickTime") < 20000), ["userID", "creativeID"])
    return encode.encode_indices(clicks, first, ["userID", "creativeID"]).drop("clickTime")


FLAGS = ["is_installed", "is_pref_cat"]
GROUPS = {"context": schemas.CONTEXT_FEATURES, "user": schemas.USER_FEATURES, "ad": schemas.AD_FEATURES}


@query("j03_grouped_one_hot", "\nUNION ALL\n".join(
    f"SELECT '{g}' AS feature_group, * FROM ({encoded_sql('dataset', c, ['label'], FLAGS)})" for g, c in GROUPS.items()))
def grouped_one_hot(r: Roles) -> DataFrame:
    """The rows of each group's matrix."""
    data = pin(assembled(r, r.train), "dataset")
    return reduce(DataFrame.unionByName, [
        encoded_rows(encode.encode_rows(data, encode.dictionary(data, columns), columns, keep=["label"], output=name), name, "label")
        .withColumn("feature_group", F.lit(name)) for name, columns in GROUPS.items()])


_LINEAR = [c for g in (schemas.AD_FEATURES, schemas.CONTEXT_FEATURES, schemas.USER_FEATURES) for c in g]


@query("j04_linear_terms", encoded_sql("dataset", _LINEAR, ["label"], FLAGS))
def linear_terms(r: Roles) -> DataFrame:
    data = pin(assembled(r, r.train), "dataset")
    return encoded_rows(training.linear_terms(data, keep=["label"])[1], "features", "label")


def _cross_sql(base: str, pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f'SELECT \'{a}\' AS "left", {a}::VARCHAR AS left_value, \'{b}\' AS "right", {b}::VARCHAR AS right_value, '
        f"count(*) AS n FROM {base} GROUP BY {a}, {b}" for a, b in pairs)


_PARTS = "(SELECT * FROM sales JOIN part ON p_partkey = l_partkey)"


@query("j05_crosses", _cross_sql(_PARTS, [("l_returnflag", "p_type"), ("o_orderpriority", "p_type")]))
def crosses(r: Roles) -> DataFrame:
    sales = r.sales.join(r.table("part"), F.col("p_partkey") == F.col("l_partkey"))
    return encode.cross_counts(sales, ["l_returnflag", "o_orderpriority"], ["p_type"])


@query("j05b_crosses_min_rows", f"""
    SELECT * FROM ({_cross_sql("wide", [("positionID", "connectionType"), ("positionID", "telecomsOperator")])})
    WHERE n >= 20""")
def crosses_min_rows(r: Roles) -> DataFrame:
    return encode.cross_counts(r.wide, ["positionID"], ["connectionType", "telecomsOperator"], min_rows=20)


@query("j06_crosses_three_groups", _cross_sql(_PARTS, [
    ("l_returnflag", "o_orderpriority"), ("l_returnflag", "p_type"), ("o_orderpriority", "p_type")]))
def crosses_three_groups(r: Roles) -> DataFrame:
    sales = r.sales.join(r.table("part"), F.col("p_partkey") == F.col("l_partkey"))
    return encode.cross_counts_pairwise(sales, ["l_returnflag"], ["o_orderpriority"], ["p_type"])


_CROSSED = [f"positionID || '×' || {c}" for c in ("connectionType", "telecomsOperator")]


@query("j07_linear_and_crosses", encoded_sql("wide", [*CODES, *_CROSSED], ["label"]))
def linear_and_crosses(r: Roles) -> DataFrame:
    rows, made = encode.add_crosses(r.wide, ["positionID"], ["connectionType", "telecomsOperator"])
    columns = [*CODES, *made]
    return encoded_rows(encode.encode_rows(rows, encode.dictionary(rows, columns), columns, keep=["label"]), "features", "label")


@query("j07b_all_crosses", f"""
    SELECT label, sum(n)::BIGINT AS rows, sum(n * len(string_split(entries, ' ')))::BIGINT AS non_zero
    FROM ({encoded_sql("dataset", [*schemas.AD_FEATURES, *schemas.CONTEXT_FEATURES, *schemas.USER_FEATURES, *[
        f"({a})::INTEGER || '×' || ({b})::INTEGER" for x, y in (("ad", "context"), ("ad", "user"), ("context", "user"))
        for a in GROUPS[x] for b in GROUPS[y]]], ["label"], FLAGS)}) GROUP BY label""")
def all_crosses(r: Roles) -> DataFrame:
    """Linear terms and the crosses of all three groups: as many joins and shuffles as for one feature."""
    data = pin(assembled(r, r.train), "dataset")
    rows = training.linear_terms(data, crosses=True, keep=["label"])[1]
    return rows.groupBy("label").agg(F.count("*").alias("rows"), F.sum(F.size(F.unwrap_udt(F.col("features"))["indices"])).alias("non_zero"))


@query("j08_min_max_scale", """
    SELECT l_orderkey, l_linenumber,
           round((l_extendedprice - (SELECT min(l_extendedprice) FROM lineitem))
                 / (SELECT max(l_extendedprice) - min(l_extendedprice) FROM lineitem), 6) AS l_extendedprice
    FROM lineitem""")
def min_max_scale(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(scale_min_max(lines, "l_extendedprice"), "l_extendedprice")


@query("j09_standard_scale", """
    SELECT l_orderkey, l_linenumber,
           round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) + 0.0 AS l_quantity,
           round((l_discount - avg(l_discount) OVER ()) / stddev_pop(l_discount) OVER (), 6) + 0.0 AS l_discount
    FROM lineitem""")
def standard_scale(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return rounded(encode.standardise(lines, ["l_quantity", "l_discount"]), "l_quantity", "l_discount")


@query("j10_polynomial", """
    SELECT l_orderkey, l_linenumber, 1.0::DOUBLE AS "1", l_quantity, l_discount,
           round(l_quantity * l_quantity, 6) AS "l_quantity*l_quantity",
           round(l_quantity * l_discount, 6) AS "l_quantity*l_discount",
           round(l_discount * l_discount, 6) AS "l_discount*l_discount"
    FROM lineitem""")
def polynomial(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    rows, terms = encode.polynomial(lines, ["l_quantity", "l_discount"], 2)
    return rounded(rows, *[t for t in terms if "*" in t])


@query("j11_f_scores", "\nUNION ALL\n".join(f"""
    SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 6) AS r, count({c}) AS n,
           round(pow(corr({c}, l_extendedprice), 2) * (count(*) - 2) / (1 - pow(corr({c}, l_extendedprice), 2)), 4) AS f_score
    FROM lineitem""" for c in ("l_quantity", "l_discount", "l_tax")))
def f_scores(r: Roles) -> DataFrame:
    scored = encode.f_scores(r.table("lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return rounded(rounded(scored, "r"), "f_score", digits=4)


@query("j12_ordered_split", """
    SELECT event_id, row_number() OVER (ORDER BY clickTime, event_id) <= floor(0.8 * count(*) OVER ()) AS is_train
    FROM clicks_with_id""")
def ordered_split(r: Roles) -> DataFrame:
    clicks = r.clicks_with_id.select("event_id", "clickTime")
    return m.ordered_split(clicks, ORDER, 0.8).drop("clickTime")


_BLOCKS = """
    SELECT event_id, (CASE WHEN p < n - 5 * (n // 6) THEN 0 ELSE (p - (n - 5 * (n // 6))) // (n // 6) + 1 END)::INTEGER
               AS block
    FROM (SELECT event_id, row_number() OVER (ORDER BY clickTime, event_id) - 1 AS p, count(*) OVER () AS n
          FROM clicks_with_id)"""


@query("j13_expanding_folds", _BLOCKS)
def expanding_folds(r: Roles) -> DataFrame:
    clicks = r.clicks_with_id.select("event_id", "clickTime")
    return m.expanding_folds(clicks, ORDER, 5).drop("clickTime")


@query("j13b_fold_sizes", f"""
    WITH b AS ({_BLOCKS})
    SELECT f.block AS fold, count(*) FILTER (b.block < f.block) AS train_rows,
           count(*) FILTER (b.block = f.block) AS valid_rows
    FROM (SELECT DISTINCT block FROM b WHERE block > 0) f, b GROUP BY 1""")
def fold_sizes(r: Roles) -> DataFrame:
    """Rows to train and validate on, per fold."""
    clicks = r.clicks_with_id.select("event_id", "clickTime")
    # one row per block from here on
    sizes = m.expanding_folds(clicks, ORDER, 5).groupBy("block").agg(F.count("*").alias("valid_rows"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(F.col("block").alias("fold"), F.sum("valid_rows").over(before).alias("train_rows"),
                        "valid_rows").filter(F.col("fold") > 0)


# --- models -----------------------------------------------------------------------------------

def _encoded(r: Roles) -> DataFrame:
    """Encoded clicks with the columns that order them."""
    clicks = r.clicks_with_id
    return encode.encode_rows(clicks, encode.dictionary(clicks, CODES), CODES, keep=[*ORDER, "label"])


def _vectors(r: Roles) -> DataFrame:
    return r.table("embeddings").select("vec_id", (F.col("label") == 0).cast("int").alias("label"),
                                        array_to_vector("embedding").alias("features"))


@query("j14_logistic")
def logistic(r: Roles) -> DataFrame:
    """Fitted probabilities on the embedding vectors, one class against the rest."""
    data = _vectors(r)
    model = m.logistic(1e-4, ITERATIONS).fit(data)
    return m.score(model, data).select("vec_id", "label", "prob")


@query("j14c_passes")
def passes_of_descent(r: Roles) -> DataFrame:
    """Log-loss after each of the passes of stochastic gradient descent over the clicks in order."""
    samples = m.positioned(_encoded(r), ORDER).withColumn(m.BLOCK, F.lit(0))
    weights = passes.passes(samples, 1e-4, ITERATIONS)
    loss = passes.losses(samples, weights, [np.ones((ITERATIONS, 1), dtype=bool)])[0]
    return r.spark.createDataFrame([(i, float(x)) for i, x in enumerate(loss, 1)], "passes int, log_loss double")


@query("j15d_shared_search")
def shared_search(r: Roles) -> DataFrame:
    """Ranking of the penalties with all fits in the same scans."""
    return m.rank_params(passes.shared_curve(m.in_blocks(_encoded(r), ORDER, 5), training.ALPHAS, 5))


@query("j16e_pass_curve")
def pass_curve(r: Roles) -> DataFrame:
    return training.iteration_curve(_encoded(r), ORDER, [2, 4, 6, 8, 10], 5)


@query("j15_grid_search")
def grid_search(r: Roles) -> DataFrame:
    _, _, ranking = m.grid_search(m.in_blocks(_encoded(r), ORDER, 5), lambda a: m.logistic(a, ITERATIONS), training.ALPHAS, 5)
    return ranking


@query("j16_validation_curve")
def validation_curve(r: Roles) -> DataFrame:
    return training.fold_summary(
        m.validation_curve(m.in_blocks(_encoded(r), ORDER, 5), lambda i: m.logistic(1e-4, int(i)), [2, 6, 10], 5),
        "param", "train_loss", "valid_loss")


@query("j16b_validation_curve_six_targets")
def validation_curve_six_targets(r: Roles) -> DataFrame:
    """Penalties of the six-target linear model over contiguous folds, by MAPE."""
    rows = twelve_slots(regular(r), plan.KEYS).dropna()
    order = ["ts", *plan.KEYS]
    samples = m.in_blocks(encode.concatenate(rows, plan.PREVIOUS).select(*order, *plan.TARGETS, "features"),
                          order, 3, "blocked")
    curve = m.validation_curve(samples, lambda a: m.PerTarget(lambda: m.linear(a), plan.TARGETS), [0.1, 10.0], 3,
                               lambda: m.mape_of_targets_measure(plan.TARGETS), scheme="blocked")
    return m.rank_params(curve)


@query("j17_learning_curve")
def learning_curve(r: Roles) -> DataFrame:
    samples = m.positioned(_encoded(r), ORDER)
    n = samples.count()
    return m.learning_curve(samples, lambda: m.logistic(1e-4, ITERATIONS), [n // 4, n // 2, n], 5)


@query("j17b_learning_curve_blocked")
def learning_curve_blocked(r: Roles) -> DataFrame:
    """Growing training parts outside each of three contiguous folds."""
    samples = m.positioned(_encoded(r), ORDER)
    n = samples.count()
    curve = m.learning_curve(samples, lambda: m.logistic(1e-4, ITERATIONS), [n // 10, n // 2], 3, scheme="blocked")
    return training.fold_summary(curve, "param", "train_loss", "valid_loss")


def rate_model() -> m.LogisticRegression:
    """Without a penalty and on one categorical feature, the fitted probability is the conversion rate."""
    return m.logistic(0.0, 200, 1e-12)


@query("j16c_validation_curve_unpenalised", """
    WITH b AS (
        SELECT label, connectionType, CASE WHEN p < n - 3 * (n // 4) THEN 0
                                           ELSE (p - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block
        FROM (SELECT *, row_number() OVER (ORDER BY clickTime, event_id) - 1 AS p, count(*) OVER () AS n
              FROM clicks_with_id)),
    rates AS (SELECT f.fold, connectionType, avg(label) AS p FROM b, range(1, 4) f(fold)
              WHERE block < f.fold GROUP BY ALL)
    SELECT fold::INTEGER AS fold,
           round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))) FILTER (block < fold), 5) AS train_loss,
           round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))) FILTER (block = fold), 5) AS valid_loss
    FROM b JOIN rates USING (connectionType) WHERE block <= fold GROUP BY 1""")
def validation_curve_unpenalised(r: Roles) -> DataFrame:
    """Losses of expanding folds, known in closed form for the unpenalised model of one feature."""
    clicks = r.clicks_with_id
    encoded = encode.encode_rows(clicks, encode.dictionary(clicks, ["connectionType"]), ["connectionType"], keep=[*ORDER, "label"])
    samples = m.in_blocks(encoded.select(*ORDER, "label", "features"), ORDER, 3)
    curve = m.validation_curve(samples, lambda _: rate_model(), [0.0], 3).drop("param")
    return rounded(curve, "train_loss", "valid_loss", digits=5)


def _encoded_pair(r: Roles, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """Training and scoring rows, encoded with the values of the training rows."""
    words = encode.dictionary(r.train, features)
    return (encode.encode_rows(r.train, words, features, keep=["label"]),
            encode.encode_rows(r.test_ol, words, features, keep=["instanceID"]))


@query("j18_probabilities", """
    SELECT instanceID, round(p, 5) AS prob
    FROM test_ol JOIN (SELECT connectionType, avg(label) AS p FROM train GROUP BY 1) USING (connectionType)""")
def probabilities(r: Roles) -> DataFrame:
    train, given = _encoded_pair(r, ["connectionType"])
    scored = m.score(rate_model().fit(train), given).select("instanceID", "prob")
    return rounded(scored, "prob", digits=5)


@query("j18b_probabilities_penalised")
def probabilities_penalised(r: Roles) -> DataFrame:
    train, given = _encoded_pair(r, CODES)
    return m.score(m.logistic(0.01, ITERATIONS).fit(train), given).select("instanceID", "prob")


@query("j19_zero_installed", """
    SELECT instanceID, CASE WHEN EXISTS (SELECT 1 FROM user_app u WHERE u.userID = t.userID AND u.appID = t.appID)
                            THEN 0 ELSE round((creativeID + 1) / 101.0, 6) END AS prob
    FROM (SELECT * FROM test_ol JOIN ad USING (creativeID)) t""")
def zero_installed(r: Roles) -> DataFrame:
    scored = r.test_ol.join(r.ad.select("creativeID", "appID"), "creativeID").withColumn(
        "prob", F.round((F.col("creativeID") + 1) / F.lit(101.0), 6))
    return m.zero_installed(scored, r.user_app).select("instanceID", "prob")


@query("j20_mean_log_loss", """
    SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 6) AS log_loss
    FROM (SELECT label, (creativeID % 50 + 1) / 60.0 AS p FROM wide)""")
def mean_log_loss(r: Roles) -> DataFrame:
    scored = r.wide.withColumn("prob", (F.col("creativeID") % 50 + 1) / F.lit(60.0))
    return rounded(m.mean_log_loss(scored), "log_loss")


@query("j21_mape", f"""
    SELECT round(avg(abs((value - seasonal_level) / nullif(value, 0))), 6) AS mape FROM decomposed""")
def mape(r: Roles) -> DataFrame:
    """Error of the seasonal curve as a forecast."""
    series = regular(r)
    curve = plan.seasonal_curve(series, PERIOD).withColumnRenamed("value", "predicted")
    return rounded(m.mape(series.join(curve, [*plan.KEYS, "ts"]), "value", "predicted"), "mape")


@query("j21b_mape_of_targets", """
    SELECT round(avg(e), 6) AS mape
    FROM (SELECT unnest([abs((f.v0 - p.v0) / nullif(f.v0, 0)), abs((f.v1 - p.v1) / nullif(f.v1, 0)),
                         abs((f.v2 - p.v2) / nullif(f.v2, 0)), abs((f.v3 - p.v3) / nullif(f.v3, 0)),
                         abs((f.v4 - p.v4) / nullif(f.v4, 0)), abs((f.v5 - p.v5) / nullif(f.v5, 0))]) AS e
          FROM blocks p JOIN blocks f ON p.intersection_id = f.intersection_id AND p.tollgate_id = f.tollgate_id
                                     AND f.block = p.block + 1)""")
def mape_of_targets(r: Roles) -> DataFrame:
    """Error of the previous block as a forecast of all six targets."""
    return rounded(m.mape_of_targets(twelve_slots(regular(r), plan.KEYS), plan.TARGETS, plan.PREVIOUS), "mape")


def _line_vectors(r: Roles) -> DataFrame:
    return encode.concatenate(
        r.table("lineitem").withColumn("label", F.col("l_extendedprice")), ["l_quantity", "l_discount", "l_tax"]
    ).select("l_orderkey", "l_linenumber", "label", "features")


@query("j22_boosted_trees")
def boosted_trees(r: Roles) -> DataFrame:
    data = _line_vectors(r)
    model = m.boosted_trees(depth=2, trees=10).fit(data)
    return m.mape(model.transform(data), "label", "prediction")


BOOSTED = ["l_quantity", "l_discount", "l_tax"]
L1 = 0.815          # penalty on leaf values of the tuned ensemble


def _stumps_sql(trees: int, train: str, rate: float = 0.1, l1: float = L1) -> str:
    """CTEs p0, s1, p1, ...: trees of one cut on the rows ``p0`` (fold, x, y, pred and what ``train`` reads), fitted by fold."""
    def strength(g: str, h: str) -> str:
        return f"pow(greatest(abs({g}) - {l1}, 0), 2) / ({h} + 1.0)"

    def leaf(g: str, h: str) -> str:
        return f"-sign({g}) * greatest(abs({g}) - {l1}, 0) / ({h} + 1.0) * {rate}"

    parts = []
    for t in range(1, trees + 1):
        parts.append(f"""
    h{t} AS (SELECT fold, feature, v, sum(pred - y) AS dg, count(*) AS dh
             FROM (SELECT *, unnest([0, 1, 2]) AS feature, unnest(x) AS v FROM p{t - 1} WHERE {train}) GROUP BY ALL),
    c{t} AS (SELECT fold, feature, v, sum(dg) OVER w - dg AS gl, sum(dh) OVER w - dh AS hl,
                    sum(dg) OVER (PARTITION BY fold, feature) AS g, sum(dh) OVER (PARTITION BY fold, feature) AS h
             FROM h{t} WINDOW w AS (PARTITION BY fold, feature ORDER BY v)),
    s{t} AS (SELECT {t} AS tree, *, {strength("gl", "hl")} + {strength("(g - gl)", "(h - hl)")} - {strength("g", "h")} AS gain,
                    {leaf("gl", "hl")} AS below, {leaf("(g - gl)", "(h - hl)")} AS above
             FROM c{t} WHERE hl > 0 QUALIFY row_number() OVER (PARTITION BY fold ORDER BY gain DESC, feature, v) = 1),
    p{t} AS (SELECT p.* REPLACE (pred + CASE WHEN x[feature + 1] < v THEN below ELSE above END AS pred)
             FROM p{t - 1} p JOIN s{t} USING (fold))""")
    return ",".join(parts)


@query("j22c_boosted_stumps_l1", f"""
    WITH p0 AS (SELECT 1 AS fold, [{", ".join(BOOSTED)}] AS x, l_extendedprice AS y, 0.5::DOUBLE AS pred FROM lineitem),
    {_stumps_sql(3, "true")}
    SELECT tree::INTEGER AS tree, feature::INTEGER AS feature, round(v, 6) AS threshold, round(gain / 1000000, 2) AS gain, round(below, 4) AS below, round(above, 4) AS above
    FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)""")
def boosted_stumps_l1(r: Roles) -> DataFrame:
    """Three trees of one cut each, with an L1 penalty on the leaf values."""
    lines = r.table("lineitem").withColumn("label", F.col("l_extendedprice"))
    nodes = GradientBoosting(trees=3, depth=1, rate=0.1, l1=L1, features=BOOSTED).fit(lines).describe(lines)
    leaf = {n: F.max(F.when(F.col("node") == n, F.col("value"))) for n in (2, 3)}
    cuts = nodes.groupBy("tree").agg(F.max("feature").alias("feature"), F.max("threshold").alias("threshold"),
                                     (F.max("gain") / 1_000_000).alias("gain"), leaf[2].alias("below"), leaf[3].alias("above"))
    return rounded(rounded(rounded(cuts, "threshold"), "gain", digits=2), "below", "above", digits=4)


@query("j22d_boosted_six_targets")
def boosted_six_targets(r: Roles) -> DataFrame:
    """Errors of six boosted ensembles with the tuned settings: depth 2, 20 trees, 60% of the rows, L1 on the leaves."""
    rows = twelve_slots(regular(r), plan.KEYS).dropna()
    data = pin(encode.concatenate(rows, plan.PREVIOUS).select(*plan.TARGETS, "features"), "six-targets")

    def make() -> GradientBoosting:
        return GradientBoosting(trees=20, depth=2, rate=0.1, subsample=0.6, l1=L1)

    scored = m.predict_targets(m.fit_targets(data, make, plan.TARGETS), data)
    return m.mape_of_targets(scored, plan.TARGETS, [f"pred_{t}" for t in plan.TARGETS])


STAGES = [1, 2, 4]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("j16d_staged_curve", f"""
    WITH b AS (
        SELECT [{", ".join(BOOSTED)}] AS x, l_extendedprice AS y,
               CASE WHEN p < n - 3 * (n // 4) THEN 0 ELSE (p - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block
        FROM (SELECT *, row_number() OVER (ORDER BY {", ".join(LINE_KEY)}) - 1 AS p, count(*) OVER () AS n FROM lineitem)),
    p0 AS (SELECT fold, block, x, y, 0.5::DOUBLE AS pred FROM b, range(1, 4) f(fold) WHERE block <= fold),
    {_stumps_sql(4, "block < fold", 0.5)}
    SELECT trees::DOUBLE AS param, fold::INTEGER AS fold, round(avg(abs((y - pred) / nullif(y, 0))) FILTER (block < fold), 5) AS train_loss,
           round(avg(abs((y - pred) / nullif(y, 0))) FILTER (block = fold), 5) AS valid_loss
    FROM ({" UNION ALL ".join(f"SELECT {n} AS trees, * FROM p{n}" for n in STAGES)}) GROUP BY ALL""")
def staged_curve(r: Roles) -> DataFrame:
    """Losses for growing numbers of trees over expanding folds, from one fit a fold."""
    lines = encode.concatenate(r.table("lineitem").withColumn("label", F.col("l_extendedprice")), BOOSTED)
    samples = m.in_blocks(lines.select(*LINE_KEY, "label", "features"), LINE_KEY, 3)
    curve = m.staged_curve(samples, lambda n: GradientBoosting(trees=n, depth=1, rate=0.5, l1=L1), STAGES, 3)
    return rounded(curve, "train_loss", "valid_loss", digits=5)


def _flag_vectors(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_returnflag", F.col("l_extendedprice").alias("label"),
                                       (F.col("l_returnflag") == "R").cast("double").alias("returned"))
    return encode.concatenate(lines, ["returned"])


_GROUP_MEANS = """
    SELECT l_returnflag, count(*) AS n, round(avg(avg_price), 2) AS prediction
    FROM lineitem JOIN (SELECT l_returnflag = 'R' AS returned, avg(l_extendedprice) AS avg_price FROM lineitem GROUP BY 1)
         ON returned = (l_returnflag = 'R')
    GROUP BY 1"""


def _by_flag(scored: DataFrame) -> DataFrame:
    return scored.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("prediction"), 2).alias("prediction"))


@query("j22b_boosted_group_means", _GROUP_MEANS)
def boosted_group_means(r: Roles) -> DataFrame:
    """One full-rate tree on one yes/no feature predicts the two group means."""
    data = _flag_vectors(r)
    model = m.boosted_trees(depth=1, trees=1, rate=1.0, subsample=1.0).fit(data)
    return _by_flag(model.transform(data))


@query("j25b_forest_group_means", _GROUP_MEANS)
def forest_group_means(r: Roles) -> DataFrame:
    """A single tree grown on all rows predicts the two group means."""
    data = _flag_vectors(r)
    forest = m.random_forest(trees=1, depth=1).setBootstrap(False)
    return _by_flag(forest.fit(data).transform(data))


@query("j23_multi_output", f"""
    WITH w AS (
        SELECT p.intersection_id, p.tollgate_id,
               strftime(TIMESTAMP '1970-01-01' + to_seconds(p.block * 7200), '%Y-%m-%d %H:%M:%S') AS ts, p.v5 AS x,
               {", ".join(f"f.v{i} AS y{i}" for i in range(6))}
        FROM blocks p JOIN blocks f ON p.intersection_id = f.intersection_id AND p.tollgate_id = f.tollgate_id
                                   AND f.block = p.block + 1
        WHERE {" AND ".join(f"p.v{i} IS NOT NULL AND f.v{i} IS NOT NULL" for i in range(6))})
    SELECT intersection_id, tollgate_id, ts,
           {", ".join(f"round(regr_intercept(y{i}, x) OVER () + regr_slope(y{i}, x) OVER () * x, 4) AS pred_tt_{i}"
                      for i in range(6))}
    FROM w""")
def multi_output(r: Roles) -> DataFrame:
    """One least-squares model per target slot from the last value before, on complete blocks."""
    wide = twelve_slots(regular(r), plan.KEYS).dropna()
    rows = pin(encode.concatenate(wide, ["prev_tt_5"]), "six-targets")
    models = m.fit_targets(rows, m.linear, plan.TARGETS)
    predicted = [f"pred_{t}" for t in plan.TARGETS]
    shown = m.predict_targets(models, rows).select(*plan.KEYS, "ts", *predicted)
    return rounded(with_time_text(shown, "ts"), *predicted, digits=4)


@query("j24_least_squares", """
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
    FROM lineitem GROUP BY 1""")
def least_squares(r: Roles) -> DataFrame:
    fitted = m.least_squares(r.table("lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")
    return rounded(fitted, "slope", "intercept", digits=4)


@query("j24b_penalised_regression", """
    WITH s AS (SELECT covar_pop(l_extendedprice, l_quantity) AS c, var_pop(l_quantity) AS v,
                      stddev_samp(l_extendedprice) AS sd, avg(l_extendedprice) AS my, avg(l_quantity) AS mx FROM lineitem),
    k AS (SELECT 'ridge' AS model, c / (v + 1000.0 / sd) AS slope, * FROM s
          UNION ALL SELECT 'lasso', sign(c) * greatest(abs(c) - 1000.0, 0) / v, * FROM s
          UNION ALL SELECT 'elastic_net', sign(c) * greatest(abs(c) - 500.0, 0) / (v + 500.0 / sd), * FROM s)
    SELECT model, round(slope, 2) AS slope, round(my - slope * mx, 1) AS intercept FROM k""")
def penalised_regression(r: Roles) -> DataFrame:
    """Ridge, lasso and elastic net of one feature, known in closed form (soft threshold of the covariance).

    The squared penalty counts on the label in units of its deviation.
    """
    data = encode.concatenate(r.table("lineitem").select(F.col("l_extendedprice").alias("label"), "l_quantity"), ["l_quantity"])
    fitted = []
    for name, share in (("ridge", 0.0), ("lasso", 1.0), ("elastic_net", 0.5)):
        model = m.linear(1000.0, share).fit(data)
        fitted.append((name, round(float(model.coefficients[0]), 2), round(float(model.intercept), 1)))
    return r.spark.createDataFrame(fitted, "model string, slope double, intercept double")


@query("j25_random_forest")
def random_forest(r: Roles) -> DataFrame:
    data = _line_vectors(r)
    model = m.random_forest(trees=10, depth=4).fit(data)
    return m.mape(model.transform(data), "label", "prediction")


# --- composed modelling ---------------------------------------------------------------------------

def _timed(r: Roles) -> DataFrame:
    """Training set that keeps click time and event id, which the split follows."""
    raw = r.clicks_with_id.withColumnRenamed("clickTime", "_clickTime").withColumn("clickTime", F.col("_clickTime"))
    raw = raw.withColumnRenamed("event_id", "_event_id")
    return pin(assembled(r, raw), "dataset")


_TIMED = ["_clickTime", "_event_id"]


# in the order of the data set's columns
_ENCODED = ["connectionType", "telecomsOperator", "hour", "is_installed", "hour_weight", "sitesetID", "positionType", "conversion_count",
            "click_count_group", *schemas.USER_FEATURES, *schemas.AD_FEATURES, "is_pref_cat"]


@query("k19_encode", encoded_sql("dataset", _ENCODED, ["label"], FLAGS, training.RATIOS))
def encode_dataset(r: Roles) -> DataFrame:
    """Rows of the encoded training set: a column per observed value, the four ratios, and a mark for each missing one."""
    encoded = training.encode(pin(assembled(r, r.train), "dataset"))
    return encoded_rows(encoded.train, "features", "label")


@query("k20_split", """
    SELECT is_train, count(*) AS n, sum(label)::BIGINT AS positives
    FROM (SELECT label, row_number() OVER (ORDER BY clickTime, event_id) <= floor(0.8 * count(*) OVER ()) AS is_train
          FROM clicks_with_id JOIN ad USING (creativeID) JOIN users USING (userID)
          WHERE clickTime < 260000 OR label <> 0) GROUP BY 1""")
def split(r: Roles) -> DataFrame:
    data = m.ordered_split(_timed(r).select(*_TIMED, "label"), _TIMED, 0.8)
    return data.groupBy("is_train").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))


@query("k21_tune")
def tune(r: Roles) -> DataFrame:
    """Ranking of the penalties with the held-out loss of the best."""
    encoded = training.encode(_timed(r), keep=_TIMED)
    _, best, ranking, held_out = training.tune(encoded.train, _TIMED, iterations=ITERATIONS)
    return ranking.withColumns({"best": F.lit(best), "held_out_loss": F.lit(held_out)})


@query("k22_quick_fit")
def quick_fit(r: Roles) -> DataFrame:
    """Fit on all rows: its log-loss next to that of the base rate."""
    encoded = training.encode(pin(assembled(r, r.train), "dataset")).train
    _, loss = training.quick_fit(encoded, iterations=ITERATIONS)
    rate = encoded.agg(F.avg("label").alias("p"))
    base = -(F.col("p") * F.log("p") + (1 - F.col("p")) * F.log(1 - F.col("p")))
    return rate.select(F.lit(loss).alias("log_loss"), base.alias("base_rate_loss"))


@query("k23_score")
def score(r: Roles) -> DataFrame:
    """Submission: probabilities of the clicks to score."""
    parts = click_parts(r, r.train)
    train_set = features.context_group(parts.clicks, parts.statistics, r.ad, parts.pairs, r.pos, "train")
    score_set = features.context_group(r.test_ol, parts.statistics, r.ad, parts.pairs, r.pos, "score")
    users, ads = user_and_ad_groups(r)
    data = pin(features.dataset(train_set, users, ads), "dataset")
    encoded = training.encode(data, features.dataset(score_set, users, ads, ("instanceID",)))
    model, _ = training.quick_fit(encoded.train, iterations=ITERATIONS)
    return training.predict(model, encoded.score)


@query("k23b_stored_score", """
    SELECT instanceID, CASE WHEN EXISTS (SELECT 1 FROM user_app u WHERE u.userID = t.userID AND u.appID = t.appID)
                            THEN 0 ELSE round(p, 5) END AS prob
    FROM (SELECT * FROM test_ol JOIN ad USING (creativeID)) t
         JOIN (SELECT connectionType, avg(label) AS p FROM train GROUP BY 1) USING (connectionType)""")
def stored_score(r: Roles) -> DataFrame:
    """Fit, store, read back, score with the rule for installed pairs."""
    store = FeatureStore(r.spark, scratch_path(r.spark, "stored"))
    encoded = training.encode(r.train.select("label", "connectionType"))
    run.store_encoding(encoded, store)
    write_model(rate_model().fit(encoded.train), store.path("model"))
    rows = r.test_ol.join(r.ad.select("creativeID", "appID"), "creativeID")
    rows = flag_members(rows, r.user_app, ["userID", "appID"], "is_installed")
    return rounded(run.score_stored(store, rows.select("instanceID", "connectionType", "is_installed")), "prob", digits=5)


@query("k27_single_target_forecast")
def single_target_forecast(r: Roles) -> DataFrame:
    """Boosted trees on the single-target matrix; forecasts for the two hours after each observed window."""
    series = regular(r)
    matrix = plan.single_target_matrix(series, r.weather, PERIOD)
    fitted = plan.fit_single_target(matrix, split_day(r), lambda: m.boosted_trees(trees=10))[0]
    cycle = shift_cycle(plan.seasonal_curve(series, PERIOD), "ts", *last_week(r), 7)
    rows = plan.scoring_matrix(r.trips, r.weather, cycle)
    return with_time_text(plan.forecast_single(fitted.models[0], rows), "time_window_start").withColumns(
        {"train_mape": F.lit(fitted.train_mape), "test_mape": F.lit(fitted.test_mape)})


@query("k28_six_target_forecast")
def six_target_forecast(r: Roles) -> DataFrame:
    """One model per slot on the six-target matrix; forecasts for the two hours after each observed window."""
    series = regular(r)
    fitted = plan.fit_six_targets(plan.six_target_matrix(series, r.weather), split_day(r),
                                  lambda: m.boosted_trees(trees=5))
    rows = plan.six_target_scoring_matrix(r.trips, r.weather)
    return with_time_text(plan.forecast_six(fitted.models, rows), "time_window_start").withColumns(
        {"train_mape": F.lit(fitted.train_mape), "test_mape": F.lit(fitted.test_mape)})
