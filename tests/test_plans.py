"""Composed plans end to end on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import modelling as m
from clickloom.plans import features, prepare, run, training, travel_time
from clickloom.sources.store import FeatureStore
from clickloom.workload.roles import Roles


@pytest.fixture(scope="module")
def roles(spark, sf):
    return Roles(spark, sf)


@pytest.fixture(scope="module")
def tables(roles):
    return {"ad": roles.ad, "app_cat": roles.app_cat, "pos": roles.pos, "test_ol": roles.test_ol,
            "train": roles.train, "action": roles.action, "user": roles.user, "user_app": roles.user_app}


def test_roles_have_the_declared_columns(tables):
    declared = {"ad": schemas.AD, "app_cat": schemas.APP_CATEGORY, "pos": schemas.POSITION, "test_ol": schemas.TEST,
                "train": schemas.TRAIN, "action": schemas.ACTION, "user": schemas.USER, "user_app": schemas.USER_APP}
    for name, schema in declared.items():
        got = [(f.name, f.dataType) for f in tables[name].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name


def test_quick_run(spark, tables, tmp_path):
    submission, loss = run.run_quick(tables, FeatureStore(spark, str(tmp_path)), iterations=10)
    rate = tables["train"].agg(F.avg("label")).first()[0]
    assert 0 < loss < 0.7 and 0 < rate < 1
    rows = submission.collect()
    assert [r.instanceID for r in rows] == sorted(r.instanceID for r in rows)
    assert len(rows) == tables["test_ol"].count()
    assert all(0 <= r.prob <= 1 for r in rows)
    assert (tmp_path / "submission" / "_SUCCESS").exists() and (tmp_path / "model").exists()


def test_full_run(spark, tables, tmp_path):
    submission, ranking, held_out = run.run_full(tables, FeatureStore(spark, str(tmp_path)), iterations=5)
    assert sorted(r.rank_val_loss for r in ranking.collect()) == [1, 2, 3, 4]
    assert 0 < held_out < 2 and submission.count() == tables["test_ol"].count()


def test_one_store_keeps_forms_apart(spark, tables, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    run.run_quick(tables, store, iterations=2)
    submission, _, _ = run.run_full(tables, store, iterations=2)
    assert submission.count() == tables["test_ol"].count()
    ready = prepare.prepare_all(tables, store)
    other = prepare.prepare_all(tables, store, compat=True)
    assert ready["user"].exceptAll(other["user"]).count() > 0
    made = features.construct_all(ready, store)
    rows = run.score_stored(store, made["testset_ol"], installed=False).collect()
    assert [r.instanceID for r in rows] == sorted(r.instanceID for r in rows) and len(rows) == tables["test_ol"].count()
    zero = {r.instanceID for r in run.score_stored(store, made["testset_ol"]).filter("prob = 0").collect()}
    assert zero == {r.instanceID for r in made["testset_ol"].filter("cast(is_installed AS int) = 1").collect()}
    late, early = (features.construct_all(ready, store, before) for before in (None, 100000))
    counts = [made["dataset"].agg(F.sum("conversion_count")).first()[0] for made in (late, early)]
    assert counts[0] > counts[1]
    again = features.construct_all(ready, store)
    assert again["dataset"].inputFiles() == late["dataset"].inputFiles()


def test_columns_to_keep_must_exist(tables):
    with pytest.raises(ValueError, match="_row"):
        training.encode(tables["train"], keep=["_row"])


def test_training_and_scoring_contexts(roles, tables):
    clicks = prepare.clean_clicks(tables["train"])
    statistics = features.context_statistics(clicks)
    pairs = prepare.installed_pairs(clicks, tables["test_ol"], tables["ad"], tables["user_app"], tables["action"])
    train = features.context_group(clicks, statistics, tables["ad"], pairs, tables["pos"], "train")
    score = features.context_group(tables["test_ol"], statistics, tables["ad"], pairs, tables["pos"], "score")
    assert set(train.columns) - set(score.columns) == {"label"}
    assert set(score.columns) - set(train.columns) == {"instanceID"}
    late = clicks.filter((F.col("clickTime") >= 260000) & (F.col("label") == 0)).count()
    assert train.count() == clicks.count() - late
    assert score.count() == tables["test_ol"].count()
    assert score.filter("conversion_count IS NULL OR click_count_group IS NULL").count() == 0
    with pytest.raises(ValueError):
        features.context_group(clicks, statistics, tables["ad"], pairs, tables["pos"], "test")


def test_statistics_agree_with_the_single_builders(tables):
    clicks = prepare.clean_clicks(tables["train"])
    got = features.context_statistics(clicks)
    for name, build in (("connection", features.connection_ratio), ("operator", features.operator_ratio)):
        assert dict(map(tuple, got[name].collect())) == pytest.approx(dict(map(tuple, build(clicks).collect())))
    hours = {r.hour: (r.hour_weight, r.hour_conversion_ratio) for r in features.hour_features(clicks).collect()}
    assert {r.hour: (r.hour_weight, r.hour_conversion_ratio) for r in got["hour"].collect() if r.hour_weight} == hours


def test_statistics_can_stop_before_a_time(tables):
    clicks = tables["train"]
    early = features.context_statistics(clicks, before=100000)["user"]
    want = clicks.filter("clickTime < 100000 AND label = 1").count()
    assert early.agg(F.sum("conversion_count")).first()[0] == want


def test_residence_as_published_and_corrected(spark):
    user = spark.createDataFrame([(1, 1305, 2207)], "userID int, hometown int, residence int")
    assert tuple(prepare.clean_users(user).first()) == (1, 13, 22)
    assert tuple(prepare.clean_users(user, compat=True).first()) == (1, 13, 0)


def test_popularity_and_activity_sentinels(spark):
    ad = spark.createDataFrame([(1, 1, 1, 1, 1, 1), (2, 2, 2, 2, 2, 1), (3, 3, 3, 3, 3, 2)], schemas.AD)
    cat = spark.createDataFrame([(1, 101), (2, 0)], schemas.APP_CATEGORY)
    installs = spark.createDataFrame([(u, 1) for u in range(11)], schemas.USER_APP)
    popularity = features.app_popularity(installs)
    got = {r.creativeID: r.app_popularity for r in features.ad_group(ad, cat, popularity).collect()}
    assert got == {1: 1, 2: 6}
    kept = features.ad_group(ad, cat, popularity, keep_uncategorised=True)
    assert {r.creativeID: r.appCategory for r in kept.collect()} == {1: 101, 2: 0, 3: None}
    user = spark.createDataFrame([(0, 0, 1, 1, 1, 1, 1, 1), (99, 90, 1, 1, 1, 1, 1, 1)], schemas.USER)
    group = features.user_group(user, features.user_activity(installs),
                                features.preferred_category(prepare.installs_with_category(installs, cat)))
    assert {r.userID: (r.age, r.user_activity, r.cat_pref) for r in group.collect()} == {0: (0, 0, 101), 99: (None, 5, 0)}


def test_curves_of_the_tuning_plans(roles):
    clicks = roles.clicks_with_id
    encoded = training.encode(clicks.select("label", "connectionType", "clickTime", "event_id"),
                              keep=["clickTime", "event_id"]).train
    order = ["clickTime", "event_id"]
    curve = training.penalty_curve(encoded, order, [0.01, 1.0], 2, iterations=5).collect()
    assert sorted(r.param for r in curve) == [0.01, 1.0] and all(r.std_valid_loss >= 0 for r in curve)
    passes = training.iteration_curve(encoded, order, [1, 5], 2).collect()
    assert sorted(r.param for r in passes) == [1.0, 5.0]


def test_split_models_and_forecast(roles):
    series = travel_time.regular_series(roles.trips, "2024-01-01 00:00:00", "2024-01-30 23:40:00")
    matrix = travel_time.single_target_matrix(series, roles.weather, 72)
    assert matrix.columns[-1] == "travel_time"
    assert matrix.count() == 10 * 2160
    fitted = travel_time.fit_single_target(matrix, "2024-01-25 00:00:00", lambda: m.linear(0.1), samples="split")
    assert len(fitted) == 2 and all(f.train_mape > 0 and f.test_mape == f.rush_mape > 0 for f in fitted)
    six = travel_time.six_target_matrix(series, roles.weather)
    model = travel_time.fit_six_targets(six, "2024-01-25 00:00:00", lambda: m.linear(0.1))
    rows = travel_time.six_target_scoring_matrix(roles.trips, roles.weather).dropna()
    forecast = travel_time.forecast_six(model.models, rows)
    assert forecast.count() == 6 * rows.count()
    assert forecast.filter("hour(time_window_start) NOT IN (8, 9, 17, 18)").count() == 0
