import pytest

from clickloom.catalog import fixtures as fx
from clickloom.operators import profile
from clickloom.plans.compare import kmeans_only
from clickloom.plans.prepare import prepare_imputed
from clickloom.plans.report import explore_feature, look_up, overview, profile_clusters
from clickloom.plans.score import score_clicks
from clickloom.schema import CLICKS, MissingColumns, require_columns
from clickloom.sources.artifacts import load_artifacts, load_mixture
from clickloom.sources.runlog import RunLog, read_run_log
from clickloom.sources.tables import MissingInput, export_rows, read_table, write_table


def labelled(spark):
    rows = [
        (1, 0, 0.125, 1.0, 1.0, 0.5, 10.0, "a"), (2, 0, 0.125, 1.0, 2.0, 0.4, 20.0, "a"),
        (3, 1, 4.0, 3.0, 9.0, 0.0, 30.005, "b"), (4, 1, 6.0, 3.0, 9.0, 0.0, 30.0, "a"), (5, 1, 6.0, 3.0, 9.0, 0.0, 30.0, "b"),
    ]
    return spark.createDataFrame(
        rows,
        "session_id bigint, cluster int, clicks double, pages_nunique double, avg_price_per_click double, "
        "bounce double, sum_price double, page1_mode string",
    )


def test_rounding_is_half_even(spark):
    rows = {r["cluster"]: r for r in profile.rounded_profile(labelled(spark), ["clicks"]).collect()}
    assert (rows[0]["clicks"], rows[0]["size"]) == (0.12, 2)


def test_top_values_keep_their_order(spark):
    top = profile.top_per_cluster(labelled(spark), "page1_mode", 1)
    cells = {r["cluster"]: [tuple(c) for c in r["cells"]] for r in profile.ranked_cells(top, "cells").collect()}
    assert cells == {0: [("a", 2)], 1: [("b", 2)]}


def test_full_profile_and_crosstab(spark):
    df = labelled(spark).selectExpr("*", "0.0 as mean_price", "0.0 as max_price", "0 as distinct_models", "7 as country_mode")
    row = profile.full_profile(df).where("cluster = 1").first()
    assert [tuple(c) for c in row["top_categories"]] == [("b", 2), ("a", 1)]
    wide = {r["cluster"]: (r["a"], r["b"]) for r in profile.crosstab(df, "page1_mode", ["a", "b"]).collect()}
    assert wide == {0: (2, 0), 1: (1, 2)}


def test_insight_rules(spark, folder):
    texts = {r["cluster"]: r["text"] for r in profile_clusters(labelled(spark), folder).collect()}
    assert "quick visitors" in texts[0] and "higher bounce" in texts[0] and "Average session value: 15.00" in texts[0]
    assert "many interactions" in texts[1] and "lower bounce" in texts[1] and "window shoppers" not in texts[1]
    lines = [r[0] for r in read_table(spark, f"{folder}/cluster_summary_text", fmt="text").collect()]
    assert "Automated Cluster Insight Summary" in lines[0] and "Total clusters detected: 2" in lines
    fewer = profile.insights(profile.cluster_means(labelled(spark), ["clicks"])).first()["text"]
    assert "bounce" not in fewer and "value: 0.00" in fewer


def test_look_up(spark):
    df = labelled(spark)
    assert look_up(df, "abc") == ("invalid", {})
    assert look_up(df, "12.5")[0] == "invalid"
    assert look_up(df, "77") == ("not found", {})
    status, views = look_up(df, " 3 ")
    assert status == "found"
    compared = {r["feature"]: (r["value"], r["cluster_mean"]) for r in views["compared"].collect()}
    assert compared["clicks"] == (4.0, pytest.approx(16 / 3))
    assert {r["field"]: r["value"] for r in views["fields"].collect()}["page1_mode"] == "b"


def test_views(spark):
    df = labelled(spark)
    assert [tuple(r) for r in overview(df, [1], 2)["sizes"].collect()] == [(1, 3)]
    assert set(explore_feature(df, [0, 1], "clicks")) == {"boxes", "density"}
    counts = {(r["cluster"], r["page1_mode"]): r["count"] for r in explore_feature(df, [0, 1], "page1_mode")["counts"].collect()}
    assert counts == {(0, "a"): 2, (1, "a"): 1, (1, "b"): 2}


def test_required_columns(spark):
    with pytest.raises(MissingColumns, match="cluster"):
        require_columns(spark.range(1), ["cluster"])


def test_csv_with_nan_and_empty_fields(spark, folder):
    rows = [(1, 1, None, "a", None, float("nan"), 1, 2), (2, 1, 3, None, "M", 1.5, 1, None)]
    write_table(spark.createDataFrame(rows, CLICKS), f"{folder}/c", "csv")
    got = sorted(tuple(r) for r in read_table(spark, f"{folder}/c", CLICKS, "csv").collect())
    assert got == [(1, 1, None, "a", None, None, 1, 2), (2, 1, 3, None, "M", 1.5, 1, None)]
    # types that come from the values give the same rows
    assert sorted(tuple(r) for r in read_table(spark, f"{folder}/c", fmt="csv").collect()) == got


def test_missing_inputs(spark, folder):
    with pytest.raises(MissingInput):
        read_table(spark, f"{folder}/nothing")
    with pytest.raises(MissingInput):
        load_artifacts(spark, folder, folder)
    with pytest.raises(MissingInput):
        load_mixture(spark, folder)


def test_export_and_run_log(spark, folder):
    path = export_rows(labelled(spark), f"{folder}/one", session_id=3)
    assert spark.read.option("header", True).csv(path).count() == 1
    for run in ("a", "b"):
        RunLog(spark, f"{folder}/log", "x", run).add("param", {"k": 3}).add("metric", {"s": None}).flush()
    log = read_run_log(spark, f"{folder}/log")
    assert {(r["run"], r["kind"], r["key"], r["value"]) for r in log.collect()} == {
        (run, kind, key, value) for run in "ab" for kind, key, value in (("param", "k", "3"), ("metric", "s", None))
    }


def test_a_restarted_run_logs_nothing_twice(spark, folder):
    for _ in range(2):
        log = RunLog(spark, f"{folder}/log", "x", "a", run_id="night")
        log.add("param", {"k": 3}).flush()
        log.add("metric", {"s": 0.5}).flush()
        log.flush()
    RunLog(spark, f"{folder}/log", "x", "a").add("param", {"k": 4}).flush()
    found = sorted((r["key"], r["value"]) for r in read_run_log(spark, f"{folder}/log").collect())
    assert found == [("k", "3"), ("k", "4"), ("s", "0.5")]
    with pytest.raises(MissingInput):
        read_run_log(spark, f"{folder}/none")


def test_csv_types_come_from_all_files(spark, folder):
    rows = [("1", "7", "1", "1d", "x", None, "nan"), ("2", "3000000000", "2.5", "2", None, None, "1e3"), (None, "1", " 3 ", "3", "4", None, "2")]
    text = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string").repartition(3)
    read = read_table(spark, write_table(text, f"{folder}/t", "csv"), fmt="csv")
    assert [t for _, t in read.dtypes] == ["int", "bigint", "double", "string", "string", "string", "double"]
    assert sorted((r["b"], r["g"]) for r in read.collect()) == [(1, 2.0), (7, None), (3000000000, 1000.0)]
    write_table(text.withColumnRenamed("b", "other"), f"{folder}/u/second", "csv")
    write_table(text, f"{folder}/u/first", "csv")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_table(spark, f"{folder}/u/*", fmt="csv").collect()


def test_train_then_score_new_clicks(spark, small, folder):
    train, test = fx.click_split(spark, small, "train"), fx.click_split(spark, small, "test")
    prepared = prepare_imputed(train, test, f"{folder}/p")
    log = RunLog(spark, f"{folder}/log", "kmeans", "imputed")
    _, known = kmeans_only(prepared.train_scaled, prepared.test_scaled, f"{folder}/m", ks=[2, 3], restarts=2, log=log)
    logged = {r["key"]: r["value"] for r in read_run_log(spark, f"{folder}/log").collect()}
    assert {"silhouette_k2", "davies_bouldin_k3", "best_silhouette", "model"} <= set(logged)
    assert logged["best_silhouette"] == logged[f"silhouette_k{logged['best_k']}"]
    assert read_table(spark, f"{folder}/m/clustering_results").count() == 2
    assert "profile" in logged and {"top_categories", "top_countries"} <= set(read_table(spark, logged["profile"]).columns)
    scored = score_clicks(test, load_artifacts(spark, f"{folder}/m", f"{folder}/p"))
    want = {r["session_id"]: r["cluster"] for r in known.collect()}
    assert {r["session_id"]: r["cluster"] for r in scored.sessions.collect()} == want
    assert sum(r["size"] for r in scored.profile.collect()) == len(want)
