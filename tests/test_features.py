import numpy as np
import pytest

from clickloom.operators import cleaning, explore, features
from clickloom.functions.quantiles import exact_quantiles
from clickloom.functions.ranking import ranked


def test_missing_report_lists_only_columns_with_gaps(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b int, c string")
    assert [tuple(r) for r in cleaning.missing_report(df).collect()] == [("b", 2), ("c", 1)]


def test_imputer_uses_train_statistics(spark):
    train = spark.createDataFrame([(1, 1.0, "b"), (2, 4.0, "a"), (4, None, None)], "n int, x double, c string")
    test = spark.createDataFrame([(None, None, None), (9, 9.0, "z")], "n int, x double, c string")
    params = cleaning.fit_imputer(train)
    got = {r["column"]: r["num_value"] if r["kind"] == "num" else r["str_value"] for r in params.collect()}
    assert got == {"n": 2.0, "x": 2.5, "c": "a"}
    assert [tuple(r) for r in cleaning.apply_imputer(test, params).collect()] == [(2, 2.5, "a"), (9, 9.0, "z")]
    only = test.select("x")
    assert cleaning.apply_imputer(only, params).first()[0] == 2.5


def test_column_without_values(spark):
    df = spark.createDataFrame([(None, None)], "x double, c string")
    got = {r["column"]: (r["num_value"], r["str_value"]) for r in cleaning.fit_imputer(df).collect()}
    assert got == {"x": (None, None), "c": (None, "unknown")}


def test_numeric_mode_compares_numbers(spark):
    df = spark.createDataFrame([(10,), (9,), (10,), (9,)], "c int")
    assert cleaning.fit_imputer(df, [], ["c"]).first()["str_value"] == "9"


def test_scaler_moves_a_constant_column(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "session_id bigint, a double, b double")
    out = features.apply_scaler(df, features.fit_scaler(df, ["a", "b"]))
    assert [tuple(r) for r in out.orderBy("session_id").collect()] == [(1, -1.0, 0.0), (2, 1.0, 0.0)]
    other = spark.createDataFrame([(3, 2.0, 9.0)], df.schema)
    assert features.apply_scaler(other, features.fit_scaler(df, ["a", "b"])).first()["b"] == 4.0


def test_suffix_join_keeps_plain_names_for_the_right(spark):
    left = spark.createDataFrame([(1, 0.5)], "session_id bigint, clicks double")
    right = spark.createDataFrame([(1, 7)], "session_id bigint, clicks int")
    assert features.suffix_join(left, right).first().asDict() == {"session_id": 1, "clicks_scaled": 0.5, "clicks": 7}


def test_frequencies(spark):
    train = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "session_id bigint, c string")
    test = spark.createDataFrame([(5, "b"), (6, "z"), (7, None)], "session_id bigint, c string")
    a, b = features.frequency_encode(train, test, "c")
    assert {r["session_id"]: r["c_freq_enc"] for r in a.collect()} == {1: 2 / 3, 2: 2 / 3, 3: 1 / 3, 4: None}
    assert {r["session_id"]: r["c_freq_enc"] for r in b.collect()} == {5: 1 / 3, 6: 0.0, 7: 0.0}


def test_derived_features_guard_division(spark):
    df = spark.createDataFrame(
        [(0, 0, 5.0, 3.0, 2.0, 4), (2, 1, 6.0, None, 2.0, 4)],
        "clicks int, distinct_models int, sum_price double, max_price double, mean_price double, last_page int",
    )
    rows = features.add_derived(df).collect()
    assert (rows[0]["exploration_ratio"], rows[0]["value_per_model"], rows[0]["price_variability"]) == (0.0, 0.0, 1.0)
    assert (rows[1]["exploration_ratio"], rows[1]["value_per_model"], rows[1]["price_variability"]) == (0.5, 6.0, None)


@pytest.mark.parametrize("parts", [1, 7])
def test_quantiles_are_exact_on_skewed_data(spark, parts):
    rng = np.random.default_rng(3)
    group = (rng.random(20_000) < 0.2).astype(int)
    value = np.where(rng.random(20_000) < 0.3, 1.5, rng.normal(0, 50, 20_000))
    df = spark.createDataFrame(list(zip(group.tolist(), value.tolist())), "g int, v double").repartition(parts)
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, ["g"], ["v"], probs, accuracy=100).collect()}
    for g in (0, 1):
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(value[group == g], p), abs=1e-12)


def test_ranked_numbers_every_row_once(spark):
    df = spark.range(1000).repartition(5)
    got = {r["id"]: r["n"] for r in ranked(df, ["id"], "n").collect()}
    assert got == {i: i for i in range(1000)}


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.5, 7.0), (3.0, None, 7.0), (4.0, 1.0, 7.0)], "a double, b double, c double")
    got = {(r["x"], r["y"]): r["r"] for r in explore.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] is None and got[("c", "c")] is None
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.5, 1])[0, 1])
    assert got[("a", "b")] == got[("b", "a")]


def test_histogram_matches_numpy(spark):
    values = [0.0, 1.0, 1.0, 2.5, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = explore.histogram(df, "v", 4).orderBy("bin").collect()
    counts, edges = np.histogram(values, 4)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["lower"] for r in rows] == pytest.approx(edges[:-1].tolist())
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    counts, edges = np.histogram([3.0, 3.0], 4)
    rows = explore.histogram(flat, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == counts.tolist() and rows[0]["lower"] == edges[0]


def test_density_matches_the_formula(spark):
    values = np.array([1.0, 2.0, 2.0, 5.0])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = explore.density(df, "v").orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(1 - 3 * h, 5 + 3 * h, 200)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert [r["density"] for r in rows] == pytest.approx(want.tolist())


def test_describe(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double")
    assert tuple(explore.describe(df, "v").first())[1:] == pytest.approx(
        (4, 4.0, float(np.std([1, 2, 3, 10], ddof=1)), 1.0, 1.75, 2.5, 4.75, 10.0)
    )
