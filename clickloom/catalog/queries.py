"""Registered queries: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.catalog import fixtures as fx
from clickloom.operators import cleaning, explore, features, kmeans, metrics, models, profile
from clickloom.operators.dbscan import dbscan
from clickloom.operators.rollup import rollup_sessions
from clickloom.operators.ward import ward
from clickloom.functions.ranking import top_values, value_counts
from clickloom.plans.compare import cluster_sessions, compare_models, kmeans_only
from clickloom.plans.prepare import engineer_features, prepare_filtered, prepare_imputed
from clickloom.plans.report import profile_clusters
from clickloom.plans.score import score_clicks
from clickloom.schema import (
    CLICKS,
    CORRELATED,
    ENGINEERED_FEATURES,
    KEY,
    SESSION_CATEGORIES,
    SESSION_FEATURES,
    numeric_columns,
)
from clickloom.sources.artifacts import load_artifacts
from clickloom.sources.runlog import RunLog, read_run_log
from clickloom.sources.staging import fresh_path
from clickloom.sources.tables import read_table, write_report, write_table

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}

IMPUTED_NUMBERS = ["order", "country", "price", "price_2", "page"]
IMPUTED_TEXTS = ["page1_main_category", "page2_clothing_model"]
GIVEN_STEPS = 3
EVENT_KINDS = ["click", "error", "purchase", "signup", "view"]
SWEEP = range(models.MIN_K, models.MAX_K + 1)


def query(fn: Query) -> Query:
    _registered[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_registered)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, so that results do not hang on the order of float sums."""
    return df.select(
        *[
            F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


# -- rollup and filters


@query
def session_rollup(spark, sf):
    return tidy(rollup_sessions(cleaning.keep_plausible(fx.clicks(spark, sf))))


@query
def session_rollup_missing(spark, sf):
    return tidy(rollup_sessions(fx.clicks_missing(spark, sf)))


@query
def outlier_filter(spark, sf):
    return cleaning.keep_plausible(fx.clicks(spark, sf))


@query
def outlier_removed_count(spark, sf):
    default = cleaning.count_removed(fx.clicks_missing(spark, sf))
    capped = cleaning.count_removed(fx.clicks_missing(spark, sf), max_order=5)
    return default.withColumn("max_order", F.lit(100)).unionByName(capped.withColumn("max_order", F.lit(5)))


# -- cleaning


@query
def missing_report(spark, sf):
    return cleaning.missing_report(fx.clicks_missing(spark, sf))


@query
def impute_fit_numeric(spark, sf):
    fitted = cleaning.fit_imputer(fx.click_split(spark, sf, "train"), IMPUTED_NUMBERS, [])
    return fitted.select("column", "num_value")


@query
def impute_fit_categorical(spark, sf):
    fitted = cleaning.fit_imputer(fx.click_split(spark, sf, "train"), [], IMPUTED_TEXTS)
    return fitted.select("column", "str_value")


@query
def impute_apply(spark, sf):
    params = cleaning.fit_imputer(fx.click_split(spark, sf, "train"), IMPUTED_NUMBERS, IMPUTED_TEXTS)
    return cleaning.apply_imputer(fx.click_split(spark, sf, "test"), params).select(
        *[F.col(c).cast("double").alias(c) if c in ("country", "page") else F.col(c) for c in CLICKS.names]
    )


@query
def session_imputer_fit(spark, sf):
    numbers = [c for c in numeric_columns(fx.train(spark, sf))]
    return tidy(cleaning.fit_imputer(fx.train(spark, sf), numbers, SESSION_CATEGORIES))


# -- features


@query
def scaler_fit(spark, sf):
    return tidy(features.fit_scaler(fx.train(spark, sf)), 8)


@query
def scale_train(spark, sf):
    train = fx.train(spark, sf)
    return tidy(features.apply_scaler(train, features.fit_scaler(train)))


@query
def scale_constant_column(spark, sf):
    """A column that is 5 in all of train is only moved: its scale counts as 1."""
    train = fx.train(spark, sf).select(KEY, "clicks", F.lit(5.0).alias("flat"))
    test = fx.test(spark, sf).select(KEY, "clicks", F.col("clicks").cast("double").alias("flat"))
    return tidy(features.apply_scaler(test, features.fit_scaler(train, ["clicks", "flat"])))


@query
def scale_test(spark, sf):
    fitted = features.fit_scaler(fx.train(spark, sf))
    kept = fx.test(spark, sf).select(KEY, *SESSION_FEATURES, *SESSION_CATEGORIES)
    return tidy(features.apply_scaler(kept, fitted, in_place=True))


@query
def drift_compare(spark, sf):
    out = features.compare_distributions(fx.train(spark, sf), fx.test(spark, sf))
    return tidy(out.withColumnRenamed("%diff", "pct_diff"), 8)


@query
def mean_clicks_by_split(spark, sf):
    return tidy(features.mean_clicks(fx.sessions(spark, sf)))


@query
def suffix_join(spark, sf):
    train = fx.train(spark, sf)
    scaled = features.apply_scaler(train, features.fit_scaler(train))
    sessions = train.select(KEY, *SESSION_FEATURES, *SESSION_CATEGORIES)
    return tidy(features.suffix_join(scaled, sessions))


@query
def derived_features(spark, sf):
    out = features.add_derived(fx.sessions(spark, sf))
    return tidy(out.select(KEY, "exploration_ratio", "value_per_model", "price_variability", "page_depth"))


@query
def freq_encode_train(spark, sf):
    train, _ = features.frequency_encode(fx.train(spark, sf), fx.test(spark, sf), "country_mode")
    return tidy(train.select(KEY, "country_mode", "country_mode_freq_enc"))


@query
def freq_encode_test(spark, sf):
    _, test = features.frequency_encode(fx.train(spark, sf), fx.test(spark, sf), "country_mode")
    return tidy(test.select(KEY, "country_mode", "country_mode_freq_enc"))


@query
def engineered_features(spark, sf):
    train, test = fx.train(spark, sf), fx.test(spark, sf)
    fitted = features.fit_scaler(train)
    both = features.engineer(
        train, test, features.apply_scaler(train, fitted), features.apply_scaler(test, fitted)
    )
    one, other = (t.withColumn("split", F.lit(n)) for t, n in zip(both, ("train", "test")))
    return tidy(one.unionByName(other))


# -- exploration


@query
def dataset_shape(spark, sf):
    return explore.shape(fx.clicks(spark, sf))


@query
def head_rows(spark, sf):
    return explore.first_rows(fx.clicks(spark, sf), [KEY, "order"], 10)


@query
def page_counts(spark, sf):
    return value_counts(fx.clicks_missing(spark, sf), "page")


@query
def last_page_counts(spark, sf):
    return explore.last_page_counts(fx.clicks_missing(spark, sf))


@query
def price_by_page(spark, sf):
    return tidy(explore.price_by_page(fx.clicks_missing(spark, sf)))


@query
def session_length_describe(spark, sf):
    return tidy(explore.describe(explore.session_lengths(fx.clicks(spark, sf)), "clicks"))


@query
def session_length_hist(spark, sf):
    return tidy(explore.histogram(explore.session_lengths(fx.clicks(spark, sf)), "clicks"))


@query
def session_length_kde(spark, sf):
    return tidy(explore.density(explore.session_lengths(fx.clicks(spark, sf)), "clicks", cut=0))


@query
def top_countries(spark, sf):
    return top_values(fx.clicks_missing(spark, sf), "country")


@query
def correlation_matrix(spark, sf):
    return tidy(explore.correlation_matrix(fx.clicks_missing(spark, sf), CORRELATED))


# -- profiles


@query
def cluster_sizes(spark, sf):
    return profile.cluster_sizes(fx.sessions(spark, sf))


@query
def cluster_profile_rounded(spark, sf):
    return profile.rounded_profile(fx.sessions(spark, sf))


@query
def cluster_top_categories(spark, sf):
    return profile.top_per_cluster(fx.sessions(spark, sf), "page1_mode")


@query
def cluster_top_countries(spark, sf):
    top = profile.top_per_cluster(fx.sessions(spark, sf), "country_mode")
    return profile.ranked_cells(top, "cells").select(
        "cluster", F.to_json("cells").alias("top_countries")
    )


@query
def cluster_mean_median(spark, sf):
    return tidy(profile.mean_median(fx.sessions(spark, sf)))


@query
def cluster_means(spark, sf):
    return tidy(profile.cluster_means(fx.sessions(spark, sf), SESSION_FEATURES))


@query
def cluster_melt(spark, sf):
    sessions = fx.sessions(spark, sf)
    return profile.melt(sessions, numeric_columns(sessions))


@query
def cluster_box_stats(spark, sf):
    sessions = fx.sessions(spark, sf)
    return tidy(explore.box_stats(sessions, "cluster", numeric_columns(sessions)))


@query
def cluster_kde(spark, sf):
    return tidy(explore.density(fx.sessions(spark, sf), "sum_price", ["cluster"]), 9)


@query
def category_crosstab(spark, sf):
    return profile.crosstab(fx.sessions(spark, sf), "page1_mode", EVENT_KINDS)


@query
def category_counts(spark, sf):
    return profile.category_counts(fx.sessions(spark, sf), "country_mode")


@query
def insight_text(spark, sf):
    return profile.insights(profile.cluster_means(fx.sessions(spark, sf), SESSION_FEATURES))


@query
def insight_report(spark, sf):
    """The report as written to a text file and read back."""
    texts = profile.insights(profile.cluster_means(fx.sessions(spark, sf), SESSION_FEATURES))
    path = write_report(profile.report_lines(texts), fresh_path(spark, "report"))
    lines = read_table(spark, path, fmt="text")
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("times"))


# -- look-ups


@query
def cluster_filter(spark, sf):
    return tidy(profile.in_clusters(fx.sessions(spark, sf), [0, 2]).select(KEY, "clicks", "sum_price", "cluster"))


@query
def distinct_clusters(spark, sf):
    return profile.known_clusters(fx.sessions(spark, sf))


def _longest(spark, sf) -> str:
    first = fx.sessions(spark, sf).orderBy(F.desc("clicks"), KEY).select(KEY).first()
    return f" {first[0]} "


@query
def session_lookup(spark, sf):
    _, rows = profile.find_session(fx.sessions(spark, sf), _longest(spark, sf))
    # a double has no one way to be written as text
    return profile.as_fields(rows.select(*[F.col(c).cast("decimal(18,6)").alias(c) if t == "double" else c for c, t in rows.dtypes]))


@query
def session_vs_cluster(spark, sf):
    table = fx.sessions(spark, sf)
    _, rows = profile.find_session(table, _longest(spark, sf))
    return tidy(profile.against_cluster(table, rows, SESSION_FEATURES))


# -- metrics of given labels


@query
def silhouette_euclidean(spark, sf):
    return tidy(metrics.silhouettes(fx.sessions(spark, sf), SESSION_FEATURES))


@query
def silhouette_squared(spark, sf):
    value = metrics.silhouette_squared(fx.sessions(spark, sf), SESSION_FEATURES)
    return tidy(spark.createDataFrame([(value,)], "silhouette_sq double"))


@query
def davies_bouldin(spark, sf):
    return tidy(metrics.centroid_metrics(fx.sessions(spark, sf), SESSION_FEATURES).select("davies_bouldin"))


@query
def calinski_harabasz(spark, sf):
    return tidy(metrics.centroid_metrics(fx.sessions(spark, sf), SESSION_FEATURES).select("calinski_harabasz"), 4)


@query
def evaluate_single_label(spark, sf):
    one = fx.sessions(spark, sf).withColumn("cluster", F.lit(0))
    return tidy(metrics.evaluate(one, SESSION_FEATURES))


def _rule_results(spark, sf) -> DataFrame:
    """Scores of rule labelings under model names, with a tie and a single label."""
    table = fx.sessions(spark, sf).withColumns(
        {"halves": F.col("bounce"), "thirds": F.col("cluster"), "single": F.lit(-1)}
    )
    scores = metrics.evaluate(table, SESSION_FEATURES, ["halves", "thirds", "single"])
    named = spark.createDataFrame(
        [
            ("GMM", 2, "halves"), ("KMeans", 3, "thirds"), ("KMeans", 2, "halves"),
            ("DBSCAN", None, "single"), ("Agglomerative", 3, "thirds"),
        ],
        "Model string, k int, labeling string",
    )
    return named.join(scores, "labeling").select(
        "Model", "k",
        F.col("silhouette").alias("Silhouette"),
        F.col("davies_bouldin").alias("DaviesBouldin"),
        F.col("calinski_harabasz").alias("CalinskiHarabasz"),
    )


@query
def select_best_model(spark, sf):
    best = models.best_row(_rule_results(spark, sf))
    return tidy(best.select("Model", "k", "Silhouette", "DaviesBouldin", F.round("CalinskiHarabasz", 4).alias("CalinskiHarabasz")))


@query
def nearest_center_assign(spark, sf):
    centres = tidy(profile.cluster_means(fx.train(spark, sf), SESSION_FEATURES))
    rows = fx.test(spark, sf).select(KEY, *SESSION_FEATURES)
    return models.nearest_centre(rows, centres, SESSION_FEATURES).select(KEY, "cluster")


# -- models


@query
def kmeans_sweep(spark, sf):
    rows = models.training_rows(fx.engineered(spark, sf), ENGINEERED_FEATURES)
    fits = models.sweep(rows, ENGINEERED_FEATURES, ["KMeans"], SWEEP)
    return tidy(spark.createDataFrame([(f.k, float(f.score)) for f in fits], "k int, inertia double"))


@query
def kmeans_labels(spark, sf):
    rows = models.training_rows(fx.engineered(spark, sf), ENGINEERED_FEATURES)
    fitted = models.sweep(rows, ENGINEERED_FEATURES, ["KMeans"], [3])[0]
    return models.renumber(fitted.label(rows), "cluster", ENGINEERED_FEATURES).select(KEY, "cluster")


@query
def kmeans_given_start(spark, sf):
    """Three steps of k-means from the means of the rule clusters: centres and inertia."""
    rows = fx.train(spark, sf).select(KEY, "cluster", *[F.col(f).cast("double").alias(f) for f in SESSION_FEATURES])
    start = tidy(profile.cluster_means(rows, SESSION_FEATURES)).orderBy("cluster").toPandas()
    ((centres, inertia, _),) = kmeans.refine(rows, SESSION_FEATURES, [start[SESSION_FEATURES].to_numpy()], GIVEN_STEPS)
    found = [(i, *[float(v) for v in c], float(inertia)) for i, c in enumerate(centres)]
    schema = ", ".join(["cluster int", *[f"{f} double" for f in SESSION_FEATURES], "inertia double"])
    return tidy(spark.createDataFrame(found, schema), 4)


@query
def gmm_sweep(spark, sf):
    rows = models.training_rows(fx.engineered(spark, sf), ENGINEERED_FEATURES)
    fits = models.sweep(rows, ENGINEERED_FEATURES, ["GMM"], SWEEP)
    return tidy(spark.createDataFrame([(f.k, float(f.score)) for f in fits], "k int, log_likelihood double"))


@query
def pca_project(spark, sf):
    return tidy(models.project(fx.engineered(spark, sf), ENGINEERED_FEATURES))


@query
def dbscan_labels(spark, sf):
    return dbscan(fx.engineered(spark, sf), ENGINEERED_FEATURES)


@query
def dbscan_labels_scaled(spark, sf):
    train = fx.train(spark, sf)
    scaled = features.apply_scaler(train, features.fit_scaler(train))
    return dbscan(scaled, SESSION_FEATURES)


@query
def ward_labels(spark, sf):
    return ward(fx.engineered(spark, sf), ENGINEERED_FEATURES, [2, 3])


@query
def ward_sweep(spark, sf):
    table = fx.engineered(spark, sf)
    names = [f"ward_{k}" for k in SWEEP]
    scores = metrics.evaluate(table.join(ward(table, ENGINEERED_FEATURES, SWEEP), KEY), ENGINEERED_FEATURES, names)
    return tidy(scores)


@query
def model_comparison(spark, sf):
    return tidy(compare_models(fx.engineered(spark, sf)).results)


# -- whole runs over saved files


def _raw_split(spark, sf, gaps=True):
    return fx.click_split(spark, sf, "train", gaps), fx.click_split(spark, sf, "test", gaps)


@query
def run_log(spark, sf):
    folder = fresh_path(spark, "logged")
    log = RunLog(spark, f"{folder}/run_log", "preparation", "filtered")
    prepare_filtered(*_raw_split(spark, sf), folder, log)
    entries = read_run_log(spark, f"{folder}/run_log")
    # an artifact is logged with its path, of which only the name stays the same
    name = F.when(F.col("kind") == "artifact", F.element_at(F.split("value", "/"), -1)).otherwise(F.col("value"))
    return entries.select("experiment", "run", "kind", "key", name.alias("value"))


@query
def score_new_clicks(spark, sf):
    """Train on one split, save, load, and label the clicks of the other."""
    folder = fresh_path(spark, "scored")
    train, test = _raw_split(spark, sf)
    prepared = prepare_imputed(train, test, f"{folder}/prepared")
    kmeans_only(prepared.train_scaled, prepared.test_scaled, f"{folder}/model")
    artifacts = load_artifacts(spark, f"{folder}/model", f"{folder}/prepared")
    return tidy(score_clicks(test, artifacts).profile)


@query
def train_and_profile(spark, sf):
    """Clicks to the text report, by way of every saved table in between."""
    folder = fresh_path(spark, "run")
    log = RunLog(spark, f"{folder}/run_log", "clusters", "all")
    prepared = prepare_filtered(*_raw_split(spark, sf, gaps=False), folder, log)
    train, _ = engineer_features(prepared, folder, log)
    clustered = cluster_sessions(train, folder, log)
    return profile_clusters(clustered, folder, log)


@query
def csv_inferred(spark, sf):
    """Clicks written as CSV and read back without a declared schema."""
    path = write_table(fx.clicks_missing(spark, sf).select(*CLICKS.names), fresh_path(spark, "csv"), "csv")
    return read_table(spark, path, fmt="csv")


@query
def csv_round_trip(spark, sf):
    path = write_table(fx.clicks_missing(spark, sf).select(*CLICKS.names), fresh_path(spark, "csv"), "csv")
    return read_table(spark, path, CLICKS, "csv")
