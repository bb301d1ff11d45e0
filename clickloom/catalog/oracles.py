"""SQL twins of the registered queries, over the same whole tables."""

from __future__ import annotations

from clickloom.operators import profile as p
from clickloom.schema import (
    CLICKS,
    CORRELATED,
    ENGINEERED_FEATURES,
    PROFILE_FEATURES,
    SESSION_FEATURES,
)

#: Every number of the session table but the key and the cluster.
NUMBERS = [*PROFILE_FEATURES, "last_page", "country_mode"]

CLICK_CTES = """
e AS (SELECT event_id, ts, user_id, event_type, value,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events),
clicks AS (SELECT CAST(user_id*1000 + dayofyear(ts) AS BIGINT) AS session_id,
    CAST(row_number() OVER (PARTITION BY user_id*1000 + dayofyear(ts) ORDER BY ts, event_id) AS INT) AS "order",
    CAST((user_id*7 + k) % 25 AS INT) AS country,
    event_type AS page1_main_category,
    concat('M', CAST(k % 40 AS VARCHAR)) AS page2_clothing_model,
    value*2 AS price, CAST(CASE WHEN value > 35 THEN 1 ELSE 2 END AS INT) AS price_2,
    CAST(k % 5 + 1 AS INT) AS page, event_id FROM e),
gaps AS (SELECT session_id, "order",
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE country END AS country,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE page1_main_category END AS page1_main_category,
    page2_clothing_model,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE price END AS price, price_2,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE page END AS page, event_id FROM clicks)"""


def _rollup(source: str, name: str) -> str:
    """Session rollup of a click CTE, as the CTE ``name``."""

    def mode(column: str, out: str) -> str:
        return f"""SELECT session_id, {column} AS {out} FROM (
        SELECT session_id, {column}, row_number() OVER (PARTITION BY session_id ORDER BY count(*) DESC, {column}) AS rn
        FROM {source} WHERE {column} IS NOT NULL GROUP BY session_id, {column}) WHERE rn = 1"""

    return f"""
{name} AS (SELECT g.*, country_mode, page1_mode,
    round(sum_price / nullif(clicks, 0), 6) AS avg_price_per_click, CAST(clicks = 1 AS INT) AS bounce
  FROM (SELECT session_id, count("order") AS clicks,
      CAST(coalesce(sum(CAST(price AS DECIMAL(18,2))), 0) AS DOUBLE) AS sum_price,
      round(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(price), 0), 6) AS mean_price,
      max(price) AS max_price, count(DISTINCT page) AS pages_nunique,
      max_by(page, CASE WHEN page IS NOT NULL THEN "order" END) AS last_page,
      count(DISTINCT page2_clothing_model) AS distinct_models
    FROM {source} WHERE session_id IS NOT NULL GROUP BY session_id) g
  LEFT JOIN ({mode("country", "country_mode")}) mc ON g.session_id = mc.session_id
  LEFT JOIN ({mode("page1_main_category", "page1_mode")}) mp ON g.session_id = mp.session_id)"""


KEPT = 'price > 0 AND price < 500 AND "order" <= 100'
SESSION_CTES = f"""{CLICK_CTES},
kept AS (SELECT * FROM clicks WHERE {KEPT}),{_rollup("kept", "rolled")},
s AS (SELECT *, CAST(CASE WHEN bounce = 1 THEN 0 WHEN sum_price >= 300 THEN 2 ELSE 1 END AS INT) AS cluster,
    CASE WHEN session_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM rolled),
train AS (SELECT * FROM s WHERE split = 'train'),
test AS (SELECT * FROM s WHERE split = 'test')"""

SESSION_COLUMNS = (
    "session_id, clicks, sum_price, mean_price, max_price, pages_nunique, last_page, "
    "distinct_models, country_mode, page1_mode, avg_price_per_click, bounce"
)


def over_clicks(body: str, more: str = "") -> str:
    return f"WITH {CLICK_CTES}{more}\n{body}"


def over_sessions(body: str, more: str = "") -> str:
    return f"WITH {SESSION_CTES}{more}\n{body}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) AS {name}"


def _scaled(column: str, table: str = "t") -> str:
    return (
        f"({table}.{column} - f.m_{column}) / CASE WHEN f.sd_{column} = 0 THEN 1 ELSE f.sd_{column} END"
    )


FIT = ",\nfit AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS sd_{c}" for c in SESSION_FEATURES
) + " FROM train)"

SCALED_TRAIN = FIT + ",\nscaled AS (SELECT t.session_id, " + ", ".join(
    f"{_scaled(c)} AS {c}" for c in SESSION_FEATURES
) + " FROM train t CROSS JOIN fit f)"


def _derived(table: str) -> dict[str, str]:
    return {
        "exploration_ratio": f"CASE WHEN {table}.clicks > 0 THEN {table}.distinct_models / {table}.clicks ELSE 0 END",
        "value_per_model": f"CASE WHEN {table}.distinct_models > 0 THEN {table}.sum_price / {table}.distinct_models ELSE 0 END",
        "price_variability": f"{table}.max_price - {table}.mean_price",
        "page_depth": f"{table}.last_page",
    }


def _shares(column: str, source: str, name: str) -> str:
    return f""",
{name} AS (SELECT {column}, count(*) / (SELECT count({column}) FROM {source}) AS share
  FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"""


FREQUENCIES = _shares("country_mode", "train", "fc") + _shares("page1_mode", "train", "fp")


def _engineered(source: str, unseen: str | None) -> list[str]:
    derived = _derived("t")
    coded = {"country_mode_freq_enc": "fc.share", "page1_mode_freq_enc": "fp.share"}
    if unseen is not None:
        coded = {c: f"coalesce({e}, {unseen})" for c, e in coded.items()}
    return [f"{derived.get(c) or coded.get(c) or 't.' + c} AS {c}" for c in ENGINEERED_FEATURES]


ENGINEERED_TRAIN = FREQUENCIES + ",\neng AS (SELECT t.session_id, " + ", ".join(_engineered("train", None)) + """
  FROM train t LEFT JOIN fc ON t.country_mode = fc.country_mode LEFT JOIN fp ON t.page1_mode = fp.page1_mode)"""


def _missing(columns: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS n_missing FROM gaps" for c in columns]
    return f"SELECT * FROM ({_union(parts)}) WHERE n_missing > 0"


def _mode(column: str, table: str) -> str:
    return (
        f"coalesce((SELECT CAST({column} AS VARCHAR) FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1), 'unknown')"
    )


def _moments(a: str, b: str) -> str:
    if a == b:
        return f"CASE WHEN var_pop(\"{a}\") = 0 THEN NULL ELSE 1.0 END"
    return f'corr("{a}", "{b}")'


GAPS_TRAIN = ",\ng AS (SELECT * FROM gaps WHERE session_id % 5 <> 0),\nh AS (SELECT * FROM gaps WHERE session_id % 5 = 0)"
LENGTHS = ",\nlen AS (SELECT session_id, count(\"order\") AS clicks FROM clicks GROUP BY session_id)"


def _kde(values: str, by: str, cut: int, digits: int) -> str:
    pick, part = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    on = f"USING ({by})" if by else "ON true"
    return f""",
v AS ({values}),
b AS (SELECT {pick}count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h
      FROM v {part}),
w AS (SELECT {pick}v, count(*) AS c FROM v GROUP BY {pick}v)
SELECT {pick}CAST(point AS INT) AS point, round(x, {digits}) AS x,
  round(sum(c * exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (n * h * sqrt(2 * pi())), {digits}) AS density
FROM (SELECT b.*, point, lo - h * {cut} + (point - 1) * ((hi + h * {cut} - (lo - h * {cut})) / 199) AS x
      FROM b CROSS JOIN generate_series(1, 200) t(point)) q JOIN w {on}
GROUP BY {pick}point, x, n, h"""


def _distance2(columns: list[str], a: str = "a", b: str = "b") -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in columns)


def _silhouette(label: str, squared: bool = False) -> str:
    """CTEs ending in sil_<label>(silhouette) over the sessions with the label."""
    distance = _distance2(SESSION_FEATURES)
    distance = distance if squared else f"sqrt({distance})"
    t = f"{label}_sq" if squared else label
    return f""",
n_{t} AS (SELECT {label} AS l, count(*) AS n FROM s GROUP BY {label}),
d_{t} AS (SELECT a.session_id, a.{label} AS own, b.{label} AS l, sum({distance}) AS d
  FROM s a CROSS JOIN s b GROUP BY a.session_id, a.{label}, b.{label}),
i_{t} AS (SELECT session_id, own, max(CASE WHEN own = d_{t}.l THEN d END) AS inner_sum,
    min(CASE WHEN own <> d_{t}.l THEN d / n END) AS outer_mean
  FROM d_{t} JOIN n_{t} ON d_{t}.l = n_{t}.l GROUP BY session_id, own),
sil_{t} AS (SELECT avg(CASE WHEN n = 1 THEN 0 ELSE
    (outer_mean - inner_sum / (n - 1)) / greatest(outer_mean, inner_sum / (n - 1)) END) AS silhouette
  FROM i_{t} JOIN n_{t} ON own = l)"""


def _centroid(label: str) -> str:
    """CTEs ending in db_<label> and ch_<label> over the sessions with the label."""
    means = ", ".join(f"avg({c}) AS {c}" for c in SESSION_FEATURES)
    overall = ", ".join(f"avg({c}) AS {c}" for c in SESSION_FEATURES)
    return f""",
c_{label} AS (SELECT {label} AS l, count(*) AS n, {means} FROM s GROUP BY {label}),
m_{label} AS (SELECT count(*) AS n, {overall} FROM s),
r_{label} AS (SELECT l, avg(sqrt(q)) AS spread, sum(q) AS within FROM (
    SELECT b.l, {_distance2(SESSION_FEATURES)} AS q FROM s a JOIN c_{label} b ON a.{label} = b.l) GROUP BY l),
db_{label} AS (SELECT avg(worst) AS davies_bouldin FROM (
    SELECT a.l, max((ra.spread + rb.spread) / sqrt({_distance2(SESSION_FEATURES)})) AS worst
    FROM c_{label} a JOIN c_{label} b ON a.l <> b.l JOIN r_{label} ra ON ra.l = a.l JOIN r_{label} rb ON rb.l = b.l
    GROUP BY a.l)),
ch_{label} AS (SELECT (bet.q * (m.n - k.k)) / (wit.q * (k.k - 1)) AS calinski_harabasz
  FROM (SELECT sum(a.n * ({_distance2(SESSION_FEATURES)})) AS q FROM c_{label} a CROSS JOIN m_{label} b) bet,
    (SELECT sum(within) AS q FROM r_{label}) wit, m_{label} m, (SELECT count(*) AS k FROM c_{label}) k)"""


def _dbscan(source: str, columns: list[str], eps: float = 0.5, least: int = 5) -> str:
    return f""",
near AS (SELECT a.session_id AS a, b.session_id AS b FROM {source} a JOIN {source} b
  ON {_distance2(columns)} <= {eps * eps}),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {least}),
link AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core) AND a <> b),
reach(id, root) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  SELECT link.a, min(r.root) FROM reach r JOIN link ON link.b = r.id
    JOIN recurring.reach o ON o.id = link.a WHERE r.root < o.root GROUP BY link.a),
number AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS c FROM (SELECT DISTINCT root FROM reach)),
member AS (SELECT id, c FROM reach JOIN number USING (root)
  UNION ALL SELECT a, min(c) FROM near JOIN reach ON b = id JOIN number USING (root)
    WHERE a NOT IN (SELECT id FROM core) GROUP BY a)
SELECT session_id, CAST(coalesce(c, -1) AS INT) AS cluster FROM {source} LEFT JOIN member ON session_id = id"""


def _lloyd(source: str, start: str, columns: list[str], steps: int) -> str:
    """Steps of k-means from the centres in ``start``, as CTEs m0.. (centres) and a0.. (rows at their nearest centre)."""
    out = [f"m0 AS (SELECT * FROM {start})"]
    for i in range(steps + 1):
        out.append(f"""a{i} AS (SELECT * FROM (SELECT a.*, b.cluster AS near, {_distance2(columns)} AS d2, row_number() OVER (
  PARTITION BY a.session_id ORDER BY {_distance2(columns)}, b.cluster) AS place FROM {source} a CROSS JOIN m{i} b) WHERE place = 1)""")
        if i < steps:
            means = ", ".join(f"avg({c}) AS {c}" for c in columns)
            out.append(f"m{i + 1} AS (SELECT near AS cluster, {means} FROM a{i} GROUP BY near)")
    return ",\n" + ",\n".join(out)


def _insight(rows: str) -> dict[str, str]:
    limits = {c: f"(SELECT avg({c}) FROM m)" for c in p.SENTENCES}
    limits["bounce"] = str(p.BOUNCE_LIMIT)
    rules = [f"CASE WHEN {c} > {limits[c]} THEN '{hi}' ELSE '{lo}' END" for c, (hi, lo) in p.SENTENCES.items()]
    head = p.CLUSTER_HEAD.replace("\n", "' || chr(10) || '").replace("%s", "' || cluster || '")
    text = " || chr(10) || ".join(
        [f"('{head}')", *rules, "printf('" + p.SESSION_VALUE + "', sum_price)"]
    )
    cte = ",\nm AS (SELECT cluster, " + ", ".join(f"avg({c}) AS {c}" for c in SESSION_FEATURES) + f" FROM {rows} GROUP BY cluster)"
    return {"cte": cte, "text": text}


def sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["session_rollup"] = over_sessions(f"SELECT {SESSION_COLUMNS} FROM rolled")
    out["session_rollup_missing"] = over_clicks(f"SELECT {SESSION_COLUMNS} FROM rg", "," + _rollup("gaps", "rg"))
    out["outlier_filter"] = over_clicks(f"SELECT * FROM clicks WHERE {KEPT}")
    out["outlier_removed_count"] = over_clicks(
        _union(
            [
                f"SELECT count(*) AS before, count(*) FILTER ({kept}) AS after, "
                f"count(*) - count(*) FILTER ({kept}) AS removed, {cap} AS max_order FROM gaps"
                for cap, kept in ((100, KEPT), (5, KEPT.replace("100", "5")))
            ]
        )
    )
    out["missing_report"] = over_clicks(_missing([*CLICKS.names, "event_id"]))
    numbers = ["order", "country", "price", "price_2", "page"]
    texts = ["page1_main_category", "page2_clothing_model"]
    out["impute_fit_numeric"] = over_clicks(
        _union([f"SELECT '{c}' AS \"column\", CAST(median(\"{c}\") AS DOUBLE) AS num_value FROM g" for c in numbers]),
        GAPS_TRAIN,
    )
    out["impute_fit_categorical"] = over_clicks(
        _union([f"SELECT '{c}' AS \"column\", {_mode(c, 'g')} AS str_value" for c in texts]), GAPS_TRAIN
    )
    filled = [
        f"coalesce({c}, (SELECT median({c}) FROM g)) AS {c}" if c in ("country", "price", "page")
        else f"coalesce({c}, {_mode(c, 'g')}) AS {c}" if c in texts
        else f'"{c}"'
        for c in CLICKS.names
    ]
    filled = [f.replace("coalesce(country", "coalesce(CAST(country AS DOUBLE)").replace("coalesce(page,", "coalesce(CAST(page AS DOUBLE),") for f in filled]
    out["impute_apply"] = over_clicks(f"SELECT {', '.join(filled)} FROM h", GAPS_TRAIN)
    session_numbers = [c for c in SESSION_COLUMNS.split(", ") if c not in ("session_id", "page1_mode")]
    out["session_imputer_fit"] = over_sessions(
        _union(
            [
                f"SELECT '{c}' AS \"column\", 'num' AS kind, round(CAST(median({c}) AS DOUBLE), 6) AS num_value, "
                f"CAST(NULL AS VARCHAR) AS str_value FROM train"
                for c in session_numbers
            ]
            + [
                f"SELECT '{c}' AS \"column\", 'cat' AS kind, CAST(NULL AS DOUBLE) AS num_value, {_mode(c, 'train')} AS str_value"
                for c in ("country_mode", "page1_mode")
            ]
        )
    )
    out["scaler_fit"] = over_sessions(
        _union([f"SELECT '{c}' AS \"column\", {_r(f'avg({c})', 'mean', 8)}, {_r(f'stddev_pop({c})', 'std', 8)} FROM train" for c in SESSION_FEATURES])
    )
    scaled = ", ".join(_r(_scaled(c), c) for c in SESSION_FEATURES)
    out["scale_constant_column"] = over_sessions(
        f"SELECT t.session_id, {_r(_scaled('clicks'), 'clicks')}, CAST(t.clicks AS DOUBLE) - 5.0 AS flat FROM test t CROSS JOIN fit f", FIT
    )
    out["scale_train"] = over_sessions(f"SELECT t.session_id, {scaled} FROM train t CROSS JOIN fit f", FIT)
    out["scale_test"] = over_sessions(
        f"SELECT t.session_id, {scaled}, country_mode, page1_mode FROM test t CROSS JOIN fit f", FIT
    )
    out["drift_compare"] = over_sessions(
        _union(
            [
                f"SELECT '{c}' AS feature, {_r('a.m', 'train_mean', 8)}, {_r('b.m', 'test_mean', 8)}, "
                f"{_r('a.d', 'train_std', 8)}, {_r('b.d', 'test_std', 8)}, "
                f"{_r('abs(a.m - b.m) / (abs(a.m) + 1e-9) * 100', 'pct_diff', 8)} "
                f"FROM (SELECT avg({c}) AS m, stddev_samp({c}) AS d FROM train) a, "
                f"(SELECT avg({c}) AS m, stddev_samp({c}) AS d FROM test) b"
                for c in SESSION_FEATURES
            ]
        )
    )
    out["mean_clicks_by_split"] = over_sessions(
        f"SELECT split, count(*) AS sessions, {_r('avg(clicks)', 'mean_clicks')} FROM s GROUP BY split"
    )
    out["suffix_join"] = over_sessions(
        "SELECT t.session_id, "
        + ", ".join(_r(f"x.{c}", f"{c}_scaled") for c in SESSION_FEATURES)
        + ", " + ", ".join(f"t.{c}" for c in SESSION_FEATURES)
        + ", country_mode, page1_mode FROM scaled x JOIN train t ON x.session_id = t.session_id",
        SCALED_TRAIN,
    )
    derived = _derived("s")
    out["derived_features"] = over_sessions(
        "SELECT session_id, "
        + ", ".join(_r(e, c) if c != "page_depth" else f"{e} AS {c}" for c, e in derived.items())
        + " FROM s"
    )
    out["freq_encode_train"] = over_sessions(
        f"SELECT session_id, t.country_mode, {_r('share', 'country_mode_freq_enc')} "
        "FROM train t LEFT JOIN fc ON t.country_mode = fc.country_mode",
        FREQUENCIES,
    )
    out["freq_encode_test"] = over_sessions(
        f"SELECT session_id, t.country_mode, {_r('coalesce(share, 0)', 'country_mode_freq_enc')} "
        "FROM test t LEFT JOIN fl ON t.country_mode = fl.country_mode",
        _shares("country_mode", "train", "fl"),
    )
    whole = {"clicks", "pages_nunique", "distinct_models", "bounce", "page_depth"}

    def engineered(split: str, unseen: str | None) -> str:
        cells = [
            c if name in whole else _r(c.rsplit(" AS ", 1)[0], name)
            for c, name in zip(_engineered(split, unseen), ENGINEERED_FEATURES)
        ]
        return (
            f"SELECT {', '.join(cells)}, t.session_id, '{split}' AS split FROM {split} t "
            "LEFT JOIN fc ON t.country_mode = fc.country_mode LEFT JOIN fp ON t.page1_mode = fp.page1_mode"
        )

    out["engineered_features"] = over_sessions(_union([engineered("train", None), engineered("test", "0")]), FREQUENCIES)
    ordered = [*CLICKS.names, "event_id"]
    out["dataset_shape"] = over_clicks(
        f"SELECT count(*) AS n_rows, CAST({len(ordered)} AS INT) AS n_columns, '{', '.join(ordered)}' AS columns FROM clicks"
    )
    out["head_rows"] = over_clicks('SELECT * FROM clicks ORDER BY session_id, "order" LIMIT 10')
    out["page_counts"] = over_clicks("SELECT page, count(*) AS count FROM gaps WHERE page IS NOT NULL GROUP BY page")
    out["last_page_counts"] = over_clicks(
        "SELECT last_page, count(*) AS sessions FROM (SELECT session_id, "
        'max_by(page, CASE WHEN page IS NOT NULL THEN "order" END) AS last_page FROM gaps GROUP BY session_id) '
        "WHERE last_page IS NOT NULL GROUP BY last_page"
    )
    out["price_by_page"] = over_clicks(
        f"SELECT page, {_r('avg(price)', 'mean_price')} FROM gaps WHERE page IS NOT NULL GROUP BY page"
    )
    out["session_length_describe"] = over_clicks(
        "SELECT 'clicks' AS feature, count(*) AS n, "
        + ", ".join(
            [_r("avg(clicks)", "mean"), _r("stddev_samp(clicks)", "std"), 'CAST(min(clicks) AS DOUBLE) AS "min"',
             'CAST(max(clicks) AS DOUBLE) AS "max"']
            + [_r(f"quantile_cont(clicks, {q / 100})", f"q{q}") for q in (25, 50, 75)]
        )
        + " FROM len",
        LENGTHS,
    )
    out["session_length_hist"] = over_clicks(
        """SELECT CAST(t.bin AS INT) AS bin, round(lo + (t.bin - 1) * ((hi - lo) / 50), 6) AS lower,
  round(lo + t.bin * ((hi - lo) / 50), 6) AS upper, coalesce(n, 0) AS count
FROM generate_series(1, 50) t(bin) CROSS JOIN edge LEFT JOIN (
  SELECT least(floor((CAST(clicks AS DOUBLE) - lo) / (hi - lo) * 50), 49) + 1 AS bin, count(*) AS n
  FROM len CROSS JOIN edge GROUP BY 1) c ON c.bin = t.bin""",
        LENGTHS + ",\nedge AS (SELECT CASE WHEN min(clicks) = max(clicks) THEN min(clicks) - 0.5 ELSE CAST(min(clicks) AS DOUBLE) END AS lo, "
        "CASE WHEN min(clicks) = max(clicks) THEN max(clicks) + 0.5 ELSE CAST(max(clicks) AS DOUBLE) END AS hi FROM len)",
    )
    out["session_length_kde"] = f"WITH {CLICK_CTES}{LENGTHS}" + _kde("SELECT CAST(clicks AS DOUBLE) AS v FROM len", "", 0, 6)
    out["top_countries"] = over_clicks(
        "SELECT country, count(*) AS count FROM gaps WHERE country IS NOT NULL GROUP BY country "
        "ORDER BY count(*) DESC, country LIMIT 10"
    )
    out["correlation_matrix"] = over_clicks(
        _union([f"SELECT '{a}' AS x, '{b}' AS y, {_r(_moments(a, b), 'r')} FROM gaps" for a in CORRELATED for b in CORRELATED])
    )
    out["cluster_sizes"] = over_sessions("SELECT cluster, count(*) AS size FROM s GROUP BY cluster")
    out["cluster_profile_rounded"] = over_sessions(
        "SELECT cluster, " + ", ".join(f"round_even(avg({c}), 2) AS {c}" for c in PROFILE_FEATURES)
        + ", count(*) AS size FROM s GROUP BY cluster"
    )

    def top(column: str) -> str:
        return f"""SELECT cluster, CAST(rn AS INT) AS rank, v AS value, n AS count FROM (
  SELECT cluster, {column} AS v, count(*) AS n, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, {column}) AS rn
  FROM s WHERE {column} IS NOT NULL GROUP BY cluster, {column}) WHERE rn <= 3"""

    out["cluster_top_categories"] = over_sessions(top("page1_mode"))
    out["cluster_top_countries"] = over_sessions(
        "SELECT cluster, '[' || string_agg('{\"value\":' || value || ',\"count\":' || count || '}', ',' ORDER BY rank) || ']' "
        f"AS top_countries FROM ({top('country_mode')}) GROUP BY cluster"
    )
    out["cluster_mean_median"] = over_sessions(
        "SELECT cluster, "
        + ", ".join(f"{_r(f'avg({c})', f'{c}_mean')}, {_r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', f'{c}_median')}" for c in NUMBERS)
        + " FROM s GROUP BY cluster"
    )
    out["cluster_means"] = over_sessions(
        "SELECT cluster, " + ", ".join(_r(f"avg({c})", c) for c in SESSION_FEATURES) + " FROM s GROUP BY cluster"
    )
    melted = _union([f"SELECT cluster, '{c}' AS \"Feature\", CAST({c} AS DOUBLE) AS \"Value\" FROM s" for c in NUMBERS])
    out["cluster_melt"] = over_sessions(melted)
    out["cluster_box_stats"] = over_sessions(
        """SELECT x.cluster, x.feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (NOT (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
FROM long x JOIN box ON x.cluster = box.cluster AND x.feature = box.feature GROUP BY x.cluster, x.feature, q1, median, q3""",
        f""",
long AS (SELECT cluster, "Feature" AS feature, "Value" AS v FROM ({melted}) WHERE "Value" IS NOT NULL),
box AS (SELECT cluster, feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM long GROUP BY cluster, feature)""",
    )
    out["cluster_kde"] = f"WITH {SESSION_CTES}" + _kde("SELECT cluster, sum_price AS v FROM s", "cluster", 3, 9)
    kinds = ["click", "error", "purchase", "signup", "view"]
    out["category_crosstab"] = over_sessions(
        "SELECT cluster, " + ", ".join(f"count(*) FILTER (page1_mode = '{k}') AS \"{k}\"" for k in kinds)
        + " FROM s WHERE page1_mode IS NOT NULL GROUP BY cluster"
    )
    out["category_counts"] = over_sessions(
        "SELECT cluster, country_mode, count(*) AS count FROM s WHERE country_mode IS NOT NULL GROUP BY cluster, country_mode"
    )
    insight = _insight("s")
    out["insight_text"] = over_sessions(
        f"SELECT cluster, (SELECT count(*) FROM m) AS clusters, {insight['text']} AS text FROM m", insight["cte"]
    )
    head = (p.HEADLINE + "\n" + p.TOTAL).replace("\n", "' || chr(10) || '").replace("%d", "' || (SELECT count(*) FROM m) || '")
    out["insight_report"] = over_sessions(
        "SELECT line, count(*) AS times FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM "
        f"(SELECT '{head}' AS text UNION ALL SELECT {insight['text']} FROM m)) GROUP BY line",
        insight["cte"],
    )
    out["cluster_filter"] = over_sessions("SELECT session_id, clicks, sum_price, cluster FROM s WHERE cluster IN (0, 2)")
    out["distinct_clusters"] = over_sessions("SELECT DISTINCT cluster FROM s")
    longest = ",\none AS (SELECT * FROM s ORDER BY clicks DESC, session_id LIMIT 1)"
    out["session_lookup"] = over_sessions(
        _union(
            [
                f"SELECT session_id, '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM one"
                for c in ("clicks", "pages_nunique", "last_page", "distinct_models", "country_mode", "page1_mode", "bounce", "cluster", "split")
            ]
            + [
                f"SELECT session_id, '{c}', CAST(CAST({c} AS DECIMAL(18,6)) AS VARCHAR) FROM one"
                for c in ("sum_price", "mean_price", "max_price", "avg_price_per_click")
            ]
        ),
        longest,
    )
    out["session_vs_cluster"] = over_sessions(
        _union(
            [
                f"SELECT session_id, cluster, '{c}' AS feature, round(CAST({c} AS DOUBLE), 6) AS value, "
                f"(SELECT round(avg({c}), 6) FROM s WHERE s.cluster = one.cluster) AS cluster_mean FROM one"
                for c in SESSION_FEATURES
            ]
        ),
        longest,
    )
    out["silhouette_euclidean"] = over_sessions(
        "SELECT 'cluster' AS labeling, round(silhouette, 6) AS silhouette FROM sil_cluster", _silhouette("cluster")
    )
    out["silhouette_squared"] = over_sessions(
        "SELECT round(silhouette, 6) AS silhouette_sq FROM sil_cluster_sq", _silhouette("cluster", squared=True)
    )
    out["davies_bouldin"] = over_sessions(
        "SELECT round(davies_bouldin, 6) AS davies_bouldin FROM db_cluster", _centroid("cluster")
    )
    out["calinski_harabasz"] = over_sessions(
        "SELECT round(calinski_harabasz, 4) AS calinski_harabasz FROM ch_cluster", _centroid("cluster")
    )
    out["evaluate_single_label"] = over_sessions(
        "SELECT 'cluster' AS labeling, CAST(NULL AS DOUBLE) AS silhouette, CAST(NULL AS DOUBLE) AS davies_bouldin, "
        "CAST(NULL AS DOUBLE) AS calinski_harabasz FROM s GROUP BY 1"
    )
    out["select_best_model"] = over_sessions(
        """SELECT Model, k, round(silhouette, 6) AS Silhouette, round(davies_bouldin, 6) AS DaviesBouldin,
  round(calinski_harabasz, 4) AS CalinskiHarabasz FROM (
  SELECT 2 AS place, 'GMM' AS Model, 2 AS k, silhouette, davies_bouldin, calinski_harabasz FROM sil_bounce, db_bounce, ch_bounce
  UNION ALL SELECT 1, 'KMeans', 3, silhouette, davies_bouldin, calinski_harabasz FROM sil_cluster, db_cluster, ch_cluster
  UNION ALL SELECT 1, 'KMeans', 2, silhouette, davies_bouldin, calinski_harabasz FROM sil_bounce, db_bounce, ch_bounce
  UNION ALL SELECT 4, 'Agglomerative', 3, silhouette, davies_bouldin, calinski_harabasz FROM sil_cluster, db_cluster, ch_cluster)
ORDER BY silhouette DESC, place, k LIMIT 1""",
        _silhouette("cluster") + _silhouette("bounce") + _centroid("cluster") + _centroid("bounce"),
    )
    centres = ",\nc AS (SELECT cluster, " + ", ".join(_r(f"avg({c})", c) for c in SESSION_FEATURES) + " FROM train GROUP BY cluster)"
    out["nearest_center_assign"] = over_sessions(
        f"""SELECT session_id, cluster FROM (SELECT a.session_id, b.cluster, row_number() OVER (
  PARTITION BY a.session_id ORDER BY {_distance2(SESSION_FEATURES)}, b.cluster) AS rn FROM test a CROSS JOIN c b) WHERE rn = 1""",
        centres,
    )
    out["kmeans_given_start"] = over_sessions(
        "SELECT cluster, " + ", ".join(_r(c, c, 4) for c in SESSION_FEATURES)
        + ", " + _r("(SELECT sum(d2) FROM a3)", "inertia", 4) + " FROM m3",
        centres + _lloyd("train", "c", SESSION_FEATURES, 3),
    )
    out["dbscan_labels"] = f"WITH RECURSIVE {SESSION_CTES}{ENGINEERED_TRAIN}" + _dbscan("eng", ENGINEERED_FEATURES)
    out["dbscan_labels_scaled"] = f"WITH RECURSIVE {SESSION_CTES}{SCALED_TRAIN}" + _dbscan("scaled", SESSION_FEATURES)
    out["run_log"] = over_clicks(
        _union(
            [
                f"SELECT 'preparation' AS experiment, 'filtered' AS run, 'param' AS kind, '{n}_shape' AS key, "
                f"'(' || count(*) || ', 8)' AS value FROM {t}"
                for n, t in (("train", "g"), ("test", "h"))
            ]
            + [
                f"SELECT 'preparation', 'filtered', 'metric', 'removed_outliers_{n}', "
                f"CAST(count(*) - count(*) FILTER ({KEPT}) AS VARCHAR) FROM {t}"
                for n, t in (("train", "g"), ("test", "h"))
            ]
            + [
                f"SELECT 'preparation', 'filtered', 'artifact', '{n}', '{n}'"
                for n in ("imputer", "scaler", "train_sessions", "test_sessions", "train_features", "test_features")
            ]
        ),
        GAPS_TRAIN,
    )
    columns = ", ".join(f'"{c}"' for c in CLICKS.names)
    out["csv_round_trip"] = out["csv_inferred"] = over_clicks(f"SELECT {columns} FROM gaps")
    return out
