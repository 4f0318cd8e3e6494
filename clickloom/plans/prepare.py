"""Cleaning of the source tables and the installed (user, app) pairs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.codes import pair_number, province
from clickloom.functions.packed_time import whole
from clickloom.operators.joins import key_set, lookup, members, members_of_both
from clickloom.operators.ordered import impute_operator
from clickloom.session import together
from clickloom.sources.store import FeatureStore

SOURCES = ["ad", "app_cat", "pos", "test_ol", "train", "action", "user", "user_app"]


def clean_clicks(train: DataFrame) -> DataFrame:
    return impute_operator(train)


def clean_users(user: DataFrame, compat: bool = False) -> DataFrame:
    """Home town and residence at province level.

    ``compat`` repeats a historical slip: residence is taken from the already
    reduced home town.
    """
    residence = whole(F.col("hometown"), 10000).cast("int") if compat else province(F.col("residence"))
    return user.withColumns({"residence": residence, "hometown": province(F.col("hometown"))})


def installs_with_category(user_app: DataFrame, app_cat: DataFrame) -> DataFrame:
    return lookup(user_app, app_cat, "appID")


def installed_pairs(train: DataFrame, test: DataFrame, ad: DataFrame, user_app: DataFrame,
                    action: DataFrame) -> DataFrame:
    """Distinct installed (userID, appID) among users and apps that occur in the clicks.

    The large install tables are cut down by two semi joins first, on users and
    on apps separately.  Both key sets are written, so that their measured size
    decides whether the installs have to be shuffled for that.
    """
    clicks = train.select("userID", "creativeID").unionByName(test.select("userID", "creativeID"))
    users, apps = together(ad.sparkSession, lambda: key_set(members(clicks, ad, "creativeID"), "userID"),
                           lambda: key_set(members(ad, clicks, "creativeID"), "appID"))
    installs = user_app.select("userID", "appID").unionByName(action.select("userID", "appID"))
    return members_of_both(installs, users, apps, "userID", "appID", unique=True).distinct()


def with_pair_number(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("pair", pair_number(F.col("userID"), F.col("appID")))


def prepare_all(tables: Mapping[str, DataFrame], store: FeatureStore, compat: bool = False) -> dict[str, DataFrame]:
    """Materialise cleaned sources, installs with category and installed pairs.

    On one store every form (``compat`` or not, other source files) has tables of its own.
    """
    copied = ("ad", "app_cat", "pos", "test_ol", "action", "user_app")
    builds = {name: (lambda name=name: tables[name]) for name in copied}
    builds["train"] = lambda: clean_clicks(tables["train"])
    builds["user"] = lambda: clean_users(tables["user"], compat)
    made = together(store.spark, *[lambda name=name, build=build: store.get(
        name, build, [tables[name]], compat=compat and name == "user") for name, build in builds.items()])
    ready = dict(zip(builds, made, strict=True))
    pair_sources = [ready[name] for name in ("train", "test_ol", "ad", "user_app", "action")]
    ready["user_app_cat"], ready["installed_pairs"] = together(
        store.spark,
        lambda: store.get("user_app_cat", lambda: installs_with_category(ready["user_app"], ready["app_cat"]),
                          [ready["user_app"], ready["app_cat"]]),
        lambda: store.get("installed_pairs", lambda: installed_pairs(*pair_sources), pair_sources))
    return ready
