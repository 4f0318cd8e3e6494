"""Ad, user and context feature groups and the assembled data sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.codes import cut
from clickloom.functions.packed_time import delay_minutes, delay_minutes_compat, hour_of
from clickloom.operators.aggregates import (
    click_profile,
    conversion_ratio,
    count_per_key,
    normalised_ratio,
    scale_min_max,
    top_category,
    weight_by_hour,
)
from clickloom.operators.joins import flag_members, lookup, matching, star
from clickloom.operators.rows import fill_with_truncated_mean, settled_clicks
from clickloom.session import pin, together
from clickloom.sources.store import FeatureStore

AD_COLUMNS = ["creativeID", "advertiserID", "appPlatform", "appCategory", "app_popularity"]


# --- ad ------------------------------------------------------------------------

def app_popularity(user_app: DataFrame) -> DataFrame:
    return count_per_key(user_app, "appID", "userID", "app_popularity")


def ad_group(ad: DataFrame, app_cat: DataFrame, popularity: DataFrame, keep_uncategorised: bool = False) -> DataFrame:
    """Ads with category and binned popularity; apps nobody has installed get the sentinel bin."""
    join = lookup if keep_uncategorised else matching
    wide = lookup(join(ad, app_cat, "appID"), popularity, "appID")
    binned = cut(F.col("app_popularity"), schemas.APP_POPULARITY_EDGES)
    return wide.withColumn("app_popularity", F.coalesce(binned, F.lit(schemas.POPULARITY_WHEN_MISSING))
                           ).select(*AD_COLUMNS)


def ad_group_scaled(ad: DataFrame, app_cat: DataFrame, popularity: DataFrame) -> DataFrame:
    """Variant: missing popularity is the truncated mean, and the column is scaled to [0, 1]."""
    wide = lookup(lookup(ad, app_cat, "appID"), popularity, "appID")
    filled = fill_with_truncated_mean(wide, "app_popularity")
    return scale_min_max(filled, "app_popularity").select(*AD_COLUMNS)


# --- user ------------------------------------------------------------------------

def user_activity(user_app: DataFrame) -> DataFrame:
    counted = count_per_key(user_app, "userID", "appID", "user_activity")
    return counted.withColumn("user_activity", cut(F.col("user_activity"), schemas.USER_ACTIVITY_EDGES))


def preferred_category(user_app_cat: DataFrame) -> DataFrame:
    return top_category(user_app_cat)


def user_group(user: DataFrame, activity: DataFrame, preferred: DataFrame) -> DataFrame:
    """Users with binned age, activity bin and preferred category."""
    aged = user.withColumn("age", cut(F.col("age"), schemas.AGE_EDGES, right=False))
    wide = lookup(lookup(aged, activity, "userID"), preferred, "userID")
    return wide.fillna({"user_activity": schemas.ACTIVITY_WHEN_MISSING,
                        "cat_pref": schemas.CATEGORY_WHEN_MISSING})


# --- context ------------------------------------------------------------------------

def install_hour_weight(action: DataFrame) -> DataFrame:
    return weight_by_hour(action, "installTime")


def hour_features(train: DataFrame) -> DataFrame:
    """Conversions per hour of day and the rescaled conversion ratio, for hours with conversions."""
    by_hour = conversion_ratio(train.select(hour_of(F.col("clickTime")).alias("hour"), "label"), "hour")
    converted = by_hour.filter(F.col("conversions").isNotNull()).select(
        "hour", F.col("conversions").alias("hour_weight"), F.col("ratio").alias("hour_conversion_ratio"))
    return scale_min_max(converted, "hour_conversion_ratio")


def user_click_features(train: DataFrame) -> DataFrame:
    return click_profile(train).drop("click_count")


def connection_ratio(train: DataFrame) -> DataFrame:
    return normalised_ratio(train, "connectionType", "conversion_ratio_connectionType")


def operator_ratio(train: DataFrame) -> DataFrame:
    return normalised_ratio(train, "telecomsOperator", "conversion_ratio_telecomsOperator")


def code_statistics(train: DataFrame) -> DataFrame:
    """Clicks, conversions, ratio and rescaled ratio per connection, operator and hour, in one scan.

    One row per (kind, key); a handful of codes and hours.  Rows are unpivoted and
    collapse in the map task.
    """
    kinds = {"connection": F.col("connectionType"), "operator": F.col("telecomsOperator"),
             "hour": hour_of(F.col("clickTime"))}
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), key.cast("int").alias("key"))
                      for kind, key in kinds.items()])
    counted = train.select("label", F.inline(pairs)).groupBy("kind", "key").agg(
        F.count("*").alias("clicks"), F.nullif(F.count_if(F.col("label") == 1), F.lit(0)).alias("conversions"))
    ratio = counted.withColumn("ratio", F.col("conversions") / F.col("clicks"))
    bounds = ratio.groupBy("kind").agg(F.min("ratio").alias("_lo"), F.max("ratio").alias("_hi"))
    scaled = F.try_divide(F.col("ratio") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return ratio.join(bounds, "kind").withColumn("scaled", scaled).drop("_lo", "_hi")


def context_statistics(train: DataFrame, before: int | None = None,
                       keep: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """The label statistics that are joined to the clicks: per connection, operator, hour and user.

    By default they use every labelled click, including the ones they are joined
    to later; ``before`` limits them to clicks earlier than that packed time.

    Both tables are written (``keep``, default a scratch table), so that the join
    with the clicks is planned from their measured size: the codes are broadcast
    without shuffling the clicks by a key of a few values, the users as their
    size demands.
    """
    keep = keep or (lambda name, df: pin(df, name))
    clicks = train if before is None else train.filter(F.col("clickTime") < before)
    codes = keep("f_context_codes", code_statistics(clicks))
    scaled = F.col("scaled")

    def of(kind: str, *columns: Column) -> DataFrame:
        return codes.filter(F.col("kind") == kind).select(*columns)

    return {
        "connection": of("connection", F.col("key").alias("connectionType"),
                         scaled.alias("conversion_ratio_connectionType")),
        "operator": of("operator", F.col("key").alias("telecomsOperator"),
                       scaled.alias("conversion_ratio_telecomsOperator")),
        "hour": of("hour", F.col("key").alias("hour"), F.col("conversions").alias("hour_weight"),
                   scaled.alias("hour_conversion_ratio")),
        "user": keep("f_context_users", user_click_features(clicks)),
    }


def context_group(clicks: DataFrame, statistics: Mapping[str, DataFrame], ad: DataFrame, pairs: DataFrame,
                  pos: DataFrame, mode: str) -> DataFrame:
    """Clicks with label statistics, hour, installed flag and position.

    ``mode='train'`` drops late negatives and the time columns; ``mode='score'``
    fills user statistics of users without clicks and drops the key and label.

    Give it written tables, ``pairs`` with one row per pair: small ones are broadcast by
    their measured size, and with large ones a hot user or pair is split.
    The installed flag is joined before the user statistics, so that the clicks are
    shuffled at most once by (user, app) and once by user; the user group joined later
    by ``dataset`` finds them already placed.
    """
    if mode not in ("train", "score"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = settled_clicks(clicks) if mode == "train" else clicks
    rows = rows.withColumn("hour", hour_of(F.col("clickTime")))
    rows = lookup(rows, ad.select("creativeID", "appID"), "creativeID")
    rows = flag_members(rows, pairs, ["userID", "appID"], "is_installed", unique=True).drop("appID")
    rows = lookup(rows, statistics["connection"], "connectionType")
    rows = lookup(rows, statistics["operator"], "telecomsOperator")
    rows = lookup(rows, statistics["hour"], "hour")
    rows = lookup(rows, pos, "positionID")
    rows = lookup(rows, statistics["user"], "userID")
    if mode == "train":
        return rows.drop("clickTime", "conversionTime", "positionID")
    zero = {"conversion_count": 0, "click_count_group": 0, "conversion_ratio_click": 0.0}
    return rows.fillna(zero).drop("label", "clickTime", "positionID")


def dataset(context: DataFrame, user: DataFrame, ad: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Context joined with its user and ad groups; ids are dropped unless kept."""
    return star(context, user, ad).drop(*[c for c in ("creativeID", "userID") if c not in keep])


def conversion_delay_group(train: DataFrame, ad: DataFrame, pos: DataFrame, compat: bool = True) -> DataFrame:
    """Clicks with position, hour and binned conversion delay (5 = not converted or beyond the bins)."""
    delay: Column = (delay_minutes_compat if compat else delay_minutes)(F.col("clickTime"), F.col("conversionTime"))
    rows = matching(matching(train, ad.select("creativeID"), "creativeID"), pos, "positionID")
    category = F.coalesce(cut(delay, schemas.CONVERSION_DELAY_EDGES), F.lit(schemas.DELAY_WHEN_MISSING))
    return rows.select("label", "creativeID", "userID", "sitesetID", "positionType", "connectionType",
                       "telecomsOperator", category.alias("deltaTime_cat"),
                       hour_of(F.col("clickTime")).alias("hour"))


def click_time_weight(train: DataFrame, action: DataFrame) -> DataFrame:
    """Clicks with the install weight of their hour (a written table of 24 rows)."""
    weight = pin(install_hour_weight(action), "hour-weight")
    return lookup(train.withColumn("hour", hour_of(F.col("clickTime"))), weight, "hour")


def construct_all(ready: Mapping[str, DataFrame], store: FeatureStore, before: int | None = None) -> dict[str, DataFrame]:
    """Materialise every feature table and the two assembled data sets.

    Statistics that both the training and the scoring set read are written once.  A table is found again only if it was
    made from the same tables with the same ``before``.
    """
    made: dict[str, DataFrame] = {}

    def keep(name, build, *inputs, **settings):
        made[name] = store.get(name, build, inputs, **settings)
        return made[name]

    def ads():
        popularity = keep("f_app_popularity", lambda: app_popularity(ready["user_app"]), ready["user_app"])
        sources = (ready["ad"], ready["app_cat"], popularity)
        return keep("fg_ad", lambda: ad_group(*sources), *sources)

    def users():
        activity = keep("f_user_activity", lambda: user_activity(ready["user_app"]), ready["user_app"])
        preferred = keep("f_user_pref_cat", lambda: preferred_category(ready["user_app_cat"]), ready["user_app_cat"])
        sources = (ready["user"], activity, preferred)
        return keep("fg_user", lambda: user_group(*sources), *sources)

    def statistics():
        return context_statistics(ready["train"], before, lambda name, df: keep(name, lambda: df, ready["train"], before=before))

    def assembled(name, clicks, mode, key):
        sources = (ready[clicks], ready["ad"], ready["installed_pairs"], ready["pos"])
        context = keep(f"fg_context_{name}", lambda: context_group(
            ready[clicks], found, ready["ad"], ready["installed_pairs"], ready["pos"], mode), *sources, ready["train"], before=before)
        return keep(name, lambda: dataset(context, user, ad, key), context, user, ad)

    ad, user, found = together(store.spark, ads, users, statistics)
    together(store.spark, lambda: assembled("dataset", "train", "train", ()),
             lambda: assembled("testset_ol", "test_ol", "score", ("instanceID",)))
    return made
