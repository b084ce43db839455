"""DuckDB twins of the registered queries."""

from __future__ import annotations

# Fixed values, written out so that the twins share nothing with the operators.
RAMADAN = {
    2020: ("2020-04-23", "2020-05-23"), 2021: ("2021-04-12", "2021-05-12"),
    2022: ("2022-04-01", "2022-05-01"), 2023: ("2023-03-22", "2023-04-21"),
    2024: ("2024-03-10", "2024-04-09"), 2025: ("2025-02-28", "2025-03-30"),
    2026: ("2026-02-17", "2026-03-19"), 2027: ("2027-02-06", "2027-03-08"),
    2028: ("2028-01-26", "2028-02-24"), 2029: ("2029-01-14", "2029-02-13"),
    2030: ("2030-01-03", "2030-02-02"),
}
BOARD_RAMADAN = {
    2015: ("2015-06-17", "2015-07-16"), 2016: ("2016-06-05", "2016-07-04"),
    2017: ("2017-05-26", "2017-06-24"), 2018: ("2018-05-15", "2018-06-13"),
    2019: ("2019-05-05", "2019-06-03"), 2020: ("2020-04-23", "2020-05-22"),
    2021: ("2021-04-12", "2021-05-11"), 2022: ("2022-04-01", "2022-04-30"),
    2023: ("2023-03-22", "2023-04-20"), 2024: ("2024-03-10", "2024-04-08"),
}
HOLIDAYS = [(1, 1), (5, 1), (7, 5), (7, 19), (11, 1)]
SEASONS = ("Winter", "Spring", "Summer", "Autumn")
SEASONS_FR = ("Hiver", "Printemps", "Été", "Automne")
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
SEVERITIES_FR = ("🔴 CRITIQUE", "🟠 ÉLEVÉE", "🟡 MOYENNE", "🟢 FAIBLE")

OBS = """obs AS (
  SELECT l_orderkey AS order_key, l_shipdate AS date, p_brand AS product, r_name AS region,
         n_name AS market, p_type AS category,
         n_nationkey + 20.0::DOUBLE AS latitude, n_nationkey * 0.5::DOUBLE - 5.0::DOUBLE AS longitude,
         l_extendedprice / l_quantity AS price,
         l_extendedprice * (1 - l_discount) / l_quantity AS price_usd
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def s(x: str, digits: int = 4) -> str:
    """The value snapped to fixed point."""
    return f"floor(({x}) * 1e{digits} + 0.5001) / 1e{digits}"


def snap(*names: str, digits: int = 4) -> str:
    return ", ".join(f"{s(n, digits)} AS {n}" for n in names)


def months(name: str, source: str, unit: str = "month") -> str:
    return f"""{name}_seen AS (
  SELECT product, region, date_trunc('{unit}', date)::DATE AS date, avg(price) AS price,
         stddev_samp(price) AS price_std, count(price) AS record_count
  FROM {source} GROUP BY 1, 2, 3),
{name}_spine AS (
  SELECT product, region, unnest(generate_series(min(date), max(date), INTERVAL 1 {unit}))::DATE AS date
  FROM {name}_seen GROUP BY product, region),
{name} AS MATERIALIZED (
  SELECT product, region, date, price, price_std, coalesce(record_count, 0) AS record_count
  FROM {name}_spine LEFT JOIN {name}_seen USING (product, region, date))"""


PANEL = OBS + ",\n" + months("panel", "obs")
KNOWN = PANEL + """,
known AS MATERIALIZED (SELECT product, region, date, price FROM panel WHERE price IS NOT NULL)"""
GAP_PANEL = PANEL + """,
gaps AS (
  SELECT product, region, date,
         CASE WHEN (year(date) * 12 + month(date) + length(product)) % 7 = 0
                OR (length(product) = 7 AND date < DATE '1995-04-01')
                OR (length(product) = 8 AND date >= DATE '2001-09-01') THEN NULL ELSE price END AS price
  FROM panel)"""
GAP_ROWS = OBS + """,
gaps AS (
  SELECT date, product, region, market, CASE WHEN order_key % 7 <> 0 THEN price END AS price FROM obs)"""

O = "PARTITION BY product, region ORDER BY date"
G = "PARTITION BY product, region"
KEYS = "product, region, date"


def last(n: int) -> str:
    return f"({O} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def calendar(day: str, table: dict[int, tuple[str, str]]) -> str:
    spans = " OR ".join(f"{day} BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in table.values())
    return f"CASE WHEN {spans} THEN 1 ELSE 0 END"


def holiday(day: str) -> str:
    codes = ", ".join(str(m * 100 + d) for m, d in HOLIDAYS)
    return f"CASE WHEN month({day}) * 100 + day({day}) IN ({codes}) THEN 1 ELSE 0 END"


def season(day: str, labels: tuple[str, ...]) -> str:
    return (
        f"CASE WHEN month({day}) IN (12, 1, 2) THEN '{labels[0]}' WHEN month({day}) <= 5 THEN '{labels[1]}'"
        f" WHEN month({day}) <= 8 THEN '{labels[2]}' ELSE '{labels[3]}' END"
    )


CALENDAR = [
    ("year", "year(date)::INTEGER"), ("month", "month(date)::INTEGER"), ("week", "week(date)::INTEGER"),
    ("day_of_week", "(isodow(date) - 1)::INTEGER"), ("day_of_year", "dayofyear(date)::INTEGER"),
    ("quarter", "quarter(date)::INTEGER"),
    ("is_weekend", "CASE WHEN isodow(date) IN (5, 6) THEN 1 ELSE 0 END"),
    ("season", season("date", SEASONS)), ("is_ramadan", calendar("date", RAMADAN)),
    ("is_holiday", holiday("date")),
    ("month_sin", "sin(month(date) * (2 * pi() / 12))"), ("month_cos", "cos(month(date) * (2 * pi() / 12))"),
    ("dow_sin", "sin((isodow(date) - 1) * (2 * pi() / 7))"),
    ("dow_cos", "cos((isodow(date) - 1) * (2 * pi() / 7))"),
]
TRIG = ("month_sin", "month_cos", "dow_sin", "dow_cos")


def calendar_columns(snapped: bool = True) -> str:
    return ", ".join(f"{s(x) if snapped and n in TRIG else x} AS {n}" for n, x in CALENDAR)


def shifted(n: int) -> str:
    return OBS + f""",
moved AS (
  SELECT product, (date + INTERVAL {n} MONTH)::DATE AS date, avg(price) AS price FROM obs GROUP BY 1, 2)"""


def lag_sql(k: int) -> str:
    return f"lag(price, {k}) OVER ({O})"


def rolling_sql(n: int) -> list[tuple[str, str]]:
    w = last(n)
    return [
        (f"rolling_{n}m_mean", f"avg(price) OVER {w}"),
        (f"rolling_{n}m_std", f"coalesce(stddev_samp(price) OVER {w}, 0)"),
        (f"rolling_{n}m_min", f"min(price) OVER {w}"),
        (f"rolling_{n}m_max", f"max(price) OVER {w}"),
    ]


LAGS = [(f"lag_price_{k}m", lag_sql(k)) for k in (1, 2, 3, 6, 12)]
ROLLING = rolling_sql(3) + rolling_sql(6)
HELD = f"last_value(price IGNORE NULLS) OVER ({O} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def change_sql(k: int) -> tuple[str, str]:
    return f"pct_change_{k}m", f"(held / nullif(lag(held, {k}) OVER ({O}), 0) - 1) * 100"


CHANGES = [change_sql(k) for k in (1, 3, 12)]
NATIONAL = ("price_vs_national", "price / nullif(avg(price) OVER (PARTITION BY product, date), 0)")


def norm_sql(method: str) -> str:
    over = f"OVER ({G})"
    q = lambda p: f"quantile_cont(price, {p}) {over}"
    centre, spread = {
        "minmax": (f"min(price) {over}", f"(max(price) {over} - min(price) {over})"),
        "standard": (f"avg(price) {over}", f"stddev_pop(price) {over}"),
        "robust": (q(0.5), f"({q(0.75)} - {q(0.25)})"),
    }[method]
    return f"(price - {centre}) / (CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END)"


def columns(items: list[tuple[str, str]], snapped: bool = True) -> str:
    return ", ".join(f"{s(x) if snapped else x} AS {n}" for n, x in items)


def on_panel(items: list[tuple[str, str]]) -> str:
    return f"""WITH {PANEL}, h AS (SELECT *, {HELD} AS held FROM panel)
SELECT {KEYS}, {snap("price")}, {columns(items)} FROM h"""


FEATURES = f"""{PANEL}, h AS (SELECT *, {HELD} AS held FROM panel),
features AS MATERIALIZED (
  SELECT {KEYS}, price, {columns(LAGS + ROLLING + CHANGES + [NATIONAL, ("price_norm", norm_sql("minmax"))], False)},
         {calendar_columns(False)} FROM h)"""
FEATURE_NAMES = [n for n, _ in LAGS + ROLLING + CHANGES + [NATIONAL]] + ["price_norm"]

DETECT = ["price", "diff", "diff_pct", "roll_mean", "roll_std", "z_score"]


def detect_sql(source: str, name: str = "featured", extra: str = "", part: str = G, order: str = "date") -> str:
    w = f"({part} ORDER BY {order} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
    return f"""{name}_w AS (
  SELECT {extra}{KEYS}, price, lag(price) OVER ({part} ORDER BY {order}) AS back,
         avg(price) OVER {w} AS roll_mean, coalesce(stddev_samp(price) OVER {w}, 0) AS roll_std FROM {source}),
{name} AS MATERIALIZED (
  SELECT {extra}{KEYS}, price, coalesce(price - back, 0) AS diff,
         coalesce(coalesce(price - back, 0) / nullif(back, 0) * 100, 0) AS diff_pct, roll_mean, roll_std,
         CASE WHEN roll_std > 0 THEN (price - roll_mean) / roll_std ELSE 0 END AS z_score
  FROM {name}_w)"""


SCALERS = f"""scalers AS MATERIALIZED (
  SELECT product, region, {", ".join(f"avg({f}) AS m{i}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS d{i}" for i, f in enumerate(DETECT))}
  FROM featured GROUP BY product, region HAVING count(*) >= 10)"""


def scaled_sql(source: str, name: str, extra: str = "") -> str:
    x = ", ".join(f"({f} - m{i}) / d{i} AS x{i}" for i, f in enumerate(DETECT))
    return f"{name} AS MATERIALIZED (SELECT {extra}{KEYS}, price, {x} FROM {source} JOIN scalers USING (product, region))"


TRAINING = f"""{KNOWN}, {detect_sql("known")}, {SCALERS}, {scaled_sql("featured", "scaled")}"""


def bonus(n: str) -> str:
    return (
        f"CASE WHEN {n} > 2 THEN 2.0::DOUBLE * (ln({n} - 1) + 0.5772156649) - 2.0::DOUBLE * ({n} - 1) / {n}"
        f" WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    )


def forest_sql(source: str, row: str, d: int, trees: int, fit: str = "true", name: str = "iso",
               part: str = "product, region", levels: int = 8) -> str:
    """All rows of ``source`` (columns x0..) descend; rows with ``fit`` shape the trees.

    ``row`` lists the columns that identify a row; every series has at most 256 rows to fit.
    """
    xs = ", ".join(f"x{i}" for i in range(d))
    steps = [
        f"""{name}0 AS MATERIALIZED (
  SELECT {row}, {xs}, ({fit}) AS fit, tree, 1 AS node, true AS open, NULL::DOUBLE AS path, NULL::BIGINT AS depth_limit, NULL::DOUBLE AS psi
  FROM {source}, (SELECT unnest(range({trees})) AS tree))"""
    ]
    for level in range(levels + 1):
        w = f"PARTITION BY {part}, tree, node"
        ends = ", ".join(
            f"min(x{i}) FILTER (fit) OVER w AS lo{i}, max(x{i}) FILTER (fit) OVER w AS hi{i}" for i in range(d)
        )
        wide = ", ".join(f"{{'i': {i}, 'lo': lo{i}, 'hi': hi{i}, 'x': x{i}}}" for i in range(d))
        limit = "length(bin(greatest(size, 2) - 1))" if level == 0 else "depth_limit"
        psi = "size::DOUBLE" if level == 0 else "psi"
        key = "md5(concat_ws('|', '42', tree::VARCHAR, product, region, node::VARCHAR))"
        unit = lambda at: f"(('0x' || substr({key}, {at}, 8))::UBIGINT / 4294967296.0::DOUBLE)"
        steps.append(
            f"""{name}{level}s AS (
  SELECT *, count(*) FILTER (fit) OVER w AS size, {ends} FROM {name}{level} WINDOW w AS ({w})),
{name}{level}w AS (
  SELECT {row}, {xs}, fit, tree, node, open, path, size, {limit} AS depth_limit, {psi} AS psi,
         list_filter([{wide}], lambda e: e.hi > e.lo) AS wide, {unit(1)} AS u, {unit(9)} AS v FROM {name}{level}s),
{name}{level}c AS (
  SELECT *, open AND {level} < depth_limit AND len(wide) > 0 AS inside, wide[floor(v * len(wide))::INTEGER + 1] AS e FROM {name}{level}w),
{name}{level}p AS (
  SELECT *, CASE WHEN e.lo + u * (e.hi - e.lo) > e.lo THEN e.lo + u * (e.hi - e.lo) ELSE e.hi END AS cut FROM {name}{level}c),
{name}{level + 1} AS MATERIALIZED (
  SELECT {row}, {xs}, fit, tree, CASE WHEN inside THEN 2 * node + CASE WHEN e.x >= cut THEN 1 ELSE 0 END ELSE node END AS node,
         inside AS open, CASE WHEN open AND NOT inside THEN {level} + {bonus("size")} ELSE path END AS path, depth_limit, psi
  FROM {name}{level}p)"""
        )
    steps.append(
        f"""{name}_score AS MATERIALIZED (
  SELECT {row}, pow(2.0::DOUBLE, -avg(path) / ({bonus("max(psi)")})) AS iso_score FROM {name}{levels + 1} GROUP BY {row})"""
    )
    return ",\n".join(steps)


def price_forest_sql(trees: int = 100, sample: int = 256) -> str:
    """``price_score``: the score of every distinct price of a series, by trees on prices.

    Trees of a series with more than ``sample`` prices see the share of them whose hash lies
    in the tree's stretch of [0, 1). Nodes are aggregates; prices go down by joins on them.
    """
    depth = (sample - 1).bit_length()
    unit = lambda key: f"(('0x' || substr(md5({key}), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"
    label = unit("concat_ws('|', '42', product, region, floor(price * 10000)::BIGINT::VARCHAR)")
    spot = unit("concat_ws('|', '42', tree::VARCHAR, product, region, node::VARCHAR)")
    steps = [
        f"""pf_prices AS MATERIALIZED (
  SELECT product, region, price, w, {label} AS u, {sample}::DOUBLE / count(*) OVER ({G}) AS share, dense_rank() OVER (ORDER BY product, region) AS g
  FROM (SELECT product, region, price, count(*) AS w FROM obs GROUP BY ALL)),
pf_groups AS (SELECT DISTINCT g, product, region FROM pf_prices),
pf0 AS MATERIALIZED (
  SELECT g, price, w, tree, 1 AS node, share >= 1 OR (u + tree / {float(trees)}::DOUBLE) % 1.0::DOUBLE < share AS fit
  FROM pf_prices, (SELECT unnest(range({trees})) AS tree)),
pf_trees AS MATERIALIZED (
  SELECT g, tree, sum(w) AS size, least(length(bin(greatest(count(*), 2) - 1)), {depth}) AS depth_limit FROM pf0 WHERE fit GROUP BY ALL)"""
    ]
    for level in range(depth + 1):
        steps.append(
            f"""pf{level}a AS (SELECT g, tree, node, min(price) AS lo, max(price) AS hi, sum(w) AS size FROM pf{level} WHERE fit GROUP BY ALL),
pf{level}b AS (
  SELECT a.*, {level} < depth_limit AND hi > lo AS inside, lo + {spot} * (hi - lo) AS point
  FROM pf{level}a a JOIN pf_trees t USING (g, tree) JOIN pf_groups USING (g)),
pf{level}c AS MATERIALIZED (SELECT *, CASE WHEN point > lo THEN point ELSE hi END AS cut FROM pf{level}b),
pf{level}f AS (
  SELECT g, price, sum({level} + {bonus("size")}) AS path, count(*) AS n
  FROM pf{level} JOIN (SELECT g, tree, node, size FROM pf{level}c WHERE NOT inside) USING (g, tree, node) GROUP BY ALL),
pf{level + 1} AS MATERIALIZED (
  SELECT g, price, w, tree, 2 * node + (price >= cut)::INTEGER AS node, fit
  FROM pf{level} JOIN (SELECT g, tree, node, cut FROM pf{level}c WHERE inside) USING (g, tree, node))"""
        )
    ends = " UNION ALL ".join(f"SELECT * FROM pf{level}f" for level in range(depth + 1))
    steps.append(
        f"""pf_psi AS (SELECT g, avg(size)::DOUBLE AS psi FROM pf_trees GROUP BY g),
pf_paths AS (SELECT g, price, sum(path) / sum(n) AS path FROM ({ends}) GROUP BY ALL),
price_score AS MATERIALIZED (
  SELECT product, region, price, pow(2.0::DOUBLE, -path / ({bonus("psi")})) AS score FROM pf_paths JOIN pf_psi USING (g) JOIN pf_groups USING (g))"""
    )
    return ",\n".join(steps)


def boundary_sql(source: str, row: str) -> str:
    """Mean kernel of each row with all rows of its series, pair by pair."""
    apart = " + ".join(f"(x{i} - y{i}) * (x{i} - y{i})" for i in range(6))
    xs, ys = ", ".join(f"x{i}" for i in range(6)), ", ".join(f"x{i} AS y{i}" for i in range(6))
    return f"""svm_score AS MATERIALIZED (
  SELECT {row}, avg(exp(-({apart}) / 6)) AS similarity
  FROM (SELECT {row}, {xs} FROM {source}) a JOIN (SELECT product, region, {ys} FROM scaled) b USING (product, region)
  GROUP BY {row})"""


def minmax(x: str, part: str = G) -> str:
    low, high = f"min({x}) OVER ({part})", f"max({x}) OVER ({part})"
    return f"CASE WHEN {high} = {low} THEN 0 ELSE ({high} - {x}) / ({high} - {low}) END"


def composite_sql(source: str, rows: str, row: str, threshold: float, part: str = G, name: str = "scored") -> str:
    return f"""{name}_n AS (
  SELECT {rows}.*, {minmax(s("-iso_score", 9), part)} AS if_raw, {minmax(s("similarity", 9), part)} AS svm_raw
  FROM {rows} LEFT JOIN iso_score USING ({row}) LEFT JOIN svm_score USING ({row})),
{name} AS MATERIALIZED (
  SELECT * EXCLUDE (if_raw, svm_raw), coalesce(if_raw, 0) AS if_score, coalesce(svm_raw, 0) AS svm_score,
         0.5 * coalesce(if_raw, 0) + 0.5 * coalesce(svm_raw, 0) AS anomaly_score,
         {s("0.5 * coalesce(if_raw, 0) + 0.5 * coalesce(svm_raw, 0)", 6)} >= {threshold} AS is_anomaly
  FROM {name}_n)"""


def scored_sql(threshold: float = 0.7, rows: str = "known") -> str:
    return ",\n".join(
        [TRAINING]
        + ([f"changes AS (SELECT *, ({'price'} / nullif(lag(price) OVER ({O}), 0) - 1) * 100 AS pct_change_1m FROM known)"] if rows == "changes" else [])
        + [forest_sql("scaled", KEYS, 6, 100), boundary_sql("scaled", KEYS)]
        + [composite_sql("scaled", rows, KEYS, threshold)]
    )


SCORED = scored_sql(rows="changes")


def grade(x: str, labels: tuple[str, ...] = SEVERITIES) -> str:
    return (
        f"CASE WHEN {x} >= 0.95 THEN '{labels[0]}' WHEN {x} >= 0.85 THEN '{labels[1]}'"
        f" WHEN {x} >= 0.75 THEN '{labels[2]}' ELSE '{labels[3]}' END"
    )


ALERTS = f"""{SCORED},
alerts AS (
  SELECT date, product, region, price, round(anomaly_score, 4) AS anomaly_score, 'ensemble' AS algorithm,
         {grade("anomaly_score")} AS severity FROM scored WHERE is_anomaly)"""
ALERT_COLUMNS = f"date, product, region, {snap('price', 'anomaly_score')}, algorithm, severity"

# ---- forecasts ----

MONTH = "(year(date) * 12 + month(date))"


def trend_sql(source: str, events: bool = False, name: str = "trend") -> str:
    base = f"""{name}_b AS (
  SELECT {KEYS}, price, {MONTH} - min({MONTH}) OVER ({G}) AS t, min({MONTH}) OVER ({G}) AS t0 FROM {source}),
{name}_l AS (
  SELECT product, region, coalesce(regr_slope(price, t), 0) AS b, coalesce(regr_intercept(price, t), avg(price)) AS a
  FROM {name}_b GROUP BY 1, 2),
{name}_r AS (SELECT *, a + b * t AS line FROM {name}_b JOIN {name}_l USING (product, region)),
{name}_s AS (
  SELECT product, region, month(date) AS m, coalesce(avg(price / nullif(line, 0)), 1) AS factor FROM {name}_r GROUP BY 1, 2, 3),
{name}_f AS (
  SELECT r.*, line * factor AS fit FROM {name}_r r JOIN {name}_s s
  ON r.product = s.product AND r.region = s.region AND month(r.date) = s.m),
{name} AS (
  SELECT product, region, max(t0) AS t0, max(a) AS a, max(b) AS b, stddev_samp(price - fit) AS sigma, max(date) AS last_date,
         coalesce(avg(price / nullif(fit, 0)) FILTER ({calendar("date", RAMADAN)} = 1), 1) AS ramadan_effect,
         coalesce(avg(price / nullif(fit, 0)) FILTER ({holiday("date")} = 1), 1) AS holiday_effect
  FROM {name}_f GROUP BY 1, 2)"""
    return base


def bends_sql(source: str, changes: int = 8, harmonics: int = 3, events: bool = False, logs: bool = True, name: str = "bent") -> str:
    """Ridge regression of hinges and waves; the normal equations are solved by elimination."""
    terms = ["1.0", "u"] + [f"greatest(u - {0.8 * (k + 1) / changes!r}, 0)" for k in range(changes)]
    for h in range(1, harmonics + 1):
        terms += [f"{f}((month(date) - 1) * 2 * pi() * {h} / 12)" for f in ("sin", "cos")]
    if events:
        terms += [f"({calendar('date', RAMADAN)})::DOUBLE", f"({holiday('date')})::DOUBLE"]
    p = len(terms)
    penalty = "CASE WHEN i <> j OR i = 1 THEN 0 WHEN i = 2 THEN 1e-8 ELSE 0.1 END"
    value, scale = ("ln(price)", "1.0") if logs else ("price", "max(abs(y))")
    return f"""{name}_o AS (
  SELECT {KEYS}, {MONTH} AS m, {value} AS y FROM {source} WHERE price IS NOT NULL {"AND price > 0" if logs else ""}),
{name}_s AS (
  SELECT product, region, min(m) AS t0, max(m) - min(m) AS span, {scale} AS scale, max(date) AS last_date
  FROM {name}_o GROUP BY 1, 2 HAVING count(*) >= 24),
{name}_x AS MATERIALIZED (
  SELECT product, region, date, m, y, t0, span, scale, last_date, [{", ".join(terms)}] AS x
  FROM (SELECT *, coalesce((m - t0)::DOUBLE / nullif(span, 0), 0) AS u FROM {name}_o JOIN {name}_s USING (product, region))),
{name}_e AS MATERIALIZED (
  SELECT product, region, i, j, sum(x[i] * CASE WHEN j <= {p} THEN x[j] ELSE y / scale END) + {penalty} AS v
  FROM {name}_x, range(1, {p + 1}) AS a(i), range(1, {p + 2}) AS b(j) GROUP BY 1, 2, 3, 4),
{name}_g AS (
  SELECT 0 AS k, product, region, i, j, v FROM {name}_e
  UNION ALL
  SELECT k + 1, product, region, i, j, CASE WHEN i = k + 1 THEN kj / kk ELSE v - ik * kj / kk END
  FROM (SELECT *, max(v) FILTER (i = k + 1 AND j = k + 1) OVER (PARTITION BY product, region) AS kk,
               max(v) FILTER (j = k + 1) OVER (PARTITION BY product, region, i) AS ik,
               max(v) FILTER (i = k + 1) OVER (PARTITION BY product, region, j) AS kj
        FROM {name}_g WHERE k < {p})),
{name}_b AS MATERIALIZED (
  SELECT product, region, list(v ORDER BY i) AS beta FROM {name}_g WHERE k = {p} AND j = {p + 1} GROUP BY 1, 2),
{name} AS MATERIALIZED (
  SELECT product, region, any_value(t0) AS t0, any_value(span) AS span, any_value(scale) AS scale,
         any_value(last_date) AS last_date, any_value(beta) AS beta, stddev_samp(y - scale * list_inner_product(x, beta)) AS sigma
  FROM {name}_x JOIN {name}_b USING (product, region) GROUP BY 1, 2)"""


def bent_values(changes: int = 8, harmonics: int = 3, day: str = "ds") -> str:
    """The value of a day under the model ``bent``."""
    u = f"coalesce(({MONTH.replace('date', day)} - t0)::DOUBLE / nullif(span, 0), 0)"
    parts = ["beta[1]", f"beta[2] * {u}"]
    parts += [f"beta[{3 + k}] * greatest({u} - {0.8 * (k + 1) / changes!r}, 0)" for k in range(changes)]
    for h in range(1, harmonics + 1):
        angle = f"(month({day}) - 1) * 2 * pi() * {h} / 12"
        at = 2 + changes + 2 * h
        parts += [f"beta[{at - 1}] * sin({angle})", f"beta[{at}] * cos({angle})"]
    return f"scale * ({' + '.join(parts)})"


def future(source: str, horizon: str) -> str:
    return f"""(SELECT *, (date_trunc('month', last_date) + to_months(step::INTEGER))::DATE AS ds
  FROM (SELECT *, unnest(range(1, ({horizon})::BIGINT + 1))::INTEGER AS step FROM {source}))"""


def trend_ahead(horizon: str = "12", z: float = 1.96, events: bool = False, name: str = "trend", source: str | None = None) -> str:
    effect = ""
    if events:
        effect = (
            f" * CASE WHEN {calendar('ds', RAMADAN)} = 1 THEN ramadan_effect ELSE 1 END"
            f" * CASE WHEN {holiday('ds')} = 1 THEN holiday_effect ELSE 1 END"
        )
    return f"""{name}_y AS (
  SELECT f.product, f.region, f.step, f.ds, f.sigma,
         (a + b * (year(ds) * 12 + month(ds) - t0)) * coalesce(factor, 1){effect} AS yhat
  FROM {future(source or name, horizon)} f LEFT JOIN {name}_s s
  ON f.product = s.product AND f.region = s.region AND month(f.ds) = s.m),
{name}_ahead AS (
  SELECT product, region, step, ds, yhat, yhat - {z} * coalesce(sigma, 0) AS yhat_lower,
         yhat + {z} * coalesce(sigma, 0) AS yhat_upper FROM {name}_y)"""


def ar_sql(source: str, horizon: str = "12", join: str = "") -> str:
    return f"""ar_p AS (SELECT {KEYS}, price, {lag_sql(1)} AS x FROM {source}),
ar_m AS (
  SELECT product, region, greatest(least(regr_slope(price, x), 0.999), -0.999) AS phi, regr_intercept(price, x) AS c,
         max_by(price, date) AS last_price, max(date) AS last_date FROM ar_p GROUP BY 1, 2),
ar AS (SELECT *, c / nullif(1 - phi, 0) AS level FROM ar_m {join}),
ar_ahead AS (
  SELECT product, region, step, ds, coalesce(level + pow(phi, step) * (last_price - level), last_price) AS yhat
  FROM {future("ar", horizon)})"""


def gated(source: str, n: int = 24) -> str:
    return f"gated AS (SELECT {KEYS}, price FROM {source} QUALIFY count(*) OVER ({G}) >= {n})"


ENSEMBLE = f"""{trend_sql("gated")}, {trend_ahead()}, {ar_sql("gated")},
ensemble AS (
  SELECT ds, t.yhat AS trend_yhat, coalesce(a.yhat, t.yhat) AS ar_yhat,
         0.5 * t.yhat + 0.5 * coalesce(a.yhat, t.yhat) AS ensemble_yhat, yhat_lower, yhat_upper, product, region, step
  FROM trend_ahead t LEFT JOIN (SELECT product, region, step, yhat FROM ar_ahead) a USING (product, region, step))"""
Y3 = snap("yhat", "yhat_lower", "yhat_upper")


def quadratic_sql(source: str, horizon: int = 12, z: float = 1.64) -> str:
    return f"""quad_i AS (
  SELECT {KEYS}, price, row_number() OVER ({O}) - 1 AS i FROM {source} QUALIFY count(*) OVER ({G}) >= 12),
quad_x AS (SELECT *, i - avg(i) OVER ({G}) AS x FROM quad_i),
quad_s AS (
  SELECT product, region, count(*)::DOUBLE AS n, sum(x * x) AS s2, sum(x * x * x) AS s3, sum(x * x * x * x) AS s4,
         sum(price) AS t0, sum(x * price) AS t1, sum(x * x * price) AS t2, stddev_pop(price) AS sigma,
         max(date) AS last_date, max(x) AS x_last FROM quad_x GROUP BY 1, 2),
quad_d AS (SELECT *, nullif(n * (s2 * s4 - s3 * s3) - s2 * s2 * s2, 0) AS det FROM quad_s),
quad_c AS (
  SELECT product, region, sigma, last_date, x_last,
         (t0 * (s2 * s4 - s3 * s3) + s2 * (t1 * s3 - s2 * t2)) / det AS b0,
         (n * (t1 * s4 - s3 * t2) + s2 * (t0 * s3 - t1 * s2)) / det AS b1,
         (n * (s2 * t2 - t1 * s3) - t0 * s2 * s2) / det AS b2 FROM quad_d),
quad_y AS (
  SELECT product, region, step, ds, sigma, b0 + b1 * (x_last + step) + b2 * (x_last + step) * (x_last + step) AS y
  FROM {future("quad_c", str(horizon))}),
quad AS (
  SELECT product, region, step, ds, greatest(y, 0) AS yhat, greatest(y - {z} * sigma, 0) AS yhat_lower,
         greatest(y + {z} * sigma, 0) AS yhat_upper FROM quad_y)"""


def split_sql(source: str) -> str:
    return f"""split AS (
  SELECT {KEYS}, price, row_number() OVER ({O}) AS r, floor(count(*) OVER ({G}) * 0.8) AS cut FROM {source}),
train AS (SELECT {KEYS}, price FROM split WHERE r <= cut)"""


def match_sql(name: str, source: str, wanted: str) -> str:
    w = wanted.lower()
    return f"""SELECT '{wanted}' AS requested, {name} AS name FROM (
  SELECT DISTINCT {name}, CASE WHEN lower({name}) = '{w}' THEN 0
    WHEN contains(lower({name}), '{w}') OR contains('{w}', lower({name})) THEN 1 END AS rank FROM {source})
  WHERE rank IS NOT NULL ORDER BY rank, name LIMIT 1"""


def best_series(product: str, region: str) -> str:
    one = lambda c, w: f"(SELECT name FROM ({match_sql(c, 'counts', w)}))"
    return f"""SELECT product, region, n_months, coalesce(product = {one("product", product)}
    AND region = {one("region", region)} AND n_months >= 24, false) AS matched
  FROM counts ORDER BY matched DESC, n_months DESC, product, region LIMIT 1"""


PERCENT = "(CASE WHEN {x} >= 0 THEN '+' ELSE '' END || format('{{:.1f}}%', round({x}, 1)))"


def medians(source: str = "obs") -> str:
    return f"med AS (SELECT product, quantile_cont(price, 0.5) AS median_price FROM {source} GROUP BY 1)"


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    row = "product, region, CAST(date AS DATE) AS date"

    # sources and sinks
    q["scan_csv"] = f"""WITH {OBS} SELECT date::DATE AS date, region, market AS district, market, category, product,
      'kg' AS unit, {snap("price", "price_usd")} FROM obs"""
    q["scan_json"] = f"""WITH {OBS} SELECT market AS area, replace(market, 'NATION_', '') AS area_code, product AS item,
      replace(product, 'Brand#', '') AS item_code, 'Producer Price' AS element, year(date)::INTEGER AS year, 'DZD/kg' AS unit,
      {s("avg(price)")} AS value, 'A' AS flag FROM obs WHERE year(date) BETWEEN 1996 AND 1999
      AND product IN ('Brand#3', 'Brand#7', 'Brand#12', 'Brand#21') GROUP BY market, product, year(date)"""
    q["scan_food_balance"] = """SELECT p_type AS item, 'Supply' AS element, year(l_shipdate)::INTEGER AS year, 't' AS unit,
      sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2, 3, 4"""
    q["normalise_columns"] = f"""WITH {OBS} SELECT product AS item_name, region AS area_code, date::DATE AS ship_date,
      CASE WHEN order_key % 11 <> 0 THEN {s("price")} END AS value FROM obs"""
    q["standardise_source"] = f"""WITH {OBS} SELECT date::DATE AS date, region, market, category, product,
      {snap("price", "price_usd")} FROM obs WHERE order_key % 13 <> 0 AND order_key % 11 <> 0"""
    q["priority_union"] = f"""WITH {OBS} SELECT {row}, {snap("price")}, 'WFP_real' AS source FROM obs
      WHERE region IN ('ASIA', 'EUROPE') UNION ALL
      SELECT {row}, {s("price * 0.5")} AS price, 'synthetic' AS source FROM obs WHERE region NOT IN ('ASIA', 'EUROPE')"""
    q["market_locations"] = f"""WITH {OBS} SELECT market, region, {snap("latitude", "longitude")} FROM obs
      QUALIFY row_number() OVER (PARTITION BY market ORDER BY date, region, latitude, longitude) = 1"""
    q["write_parquet"] = f"WITH {PANEL} SELECT {KEYS}, {snap('price')}, record_count FROM panel"
    q["write_csv"] = f"WITH {KNOWN} SELECT {KEYS}, {snap('price')} FROM known"
    q["materialise_or_reuse"] = q["write_csv"]
    q["validate_table"] = f"""WITH {OBS}, n AS (SELECT (SELECT count(*) FROM obs) AS o, (SELECT count(*) FROM obs WHERE date > TIMESTAMP '2100-01-01') AS late,
        (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM supplier) AS s, (SELECT count(*) FROM region) AS r),
      v(name, seen, least) AS (SELECT 'observations', o, c FROM n UNION ALL SELECT 'late', late, 1 FROM n
      UNION ALL SELECT 'suppliers', s, c + 1 FROM n UNION ALL SELECT 'regions', r, 1000 FROM n)
      SELECT name, CASE WHEN seen = 0 THEN 'DataFrame is None or empty.' WHEN seen >= least THEN 'true'
      ELSE format('DataFrame has {{}} rows, expected at least {{}}.', seen, least) END AS verdict FROM v
      UNION ALL SELECT 'no altitude', 'Missing required columns: [''altitude'', ''slope'']'"""
    regions_dim = """(VALUES ('Alger', 'ALG', 36.7538, 16), ('Oran', 'ORA', 35.6969, 31), ('Constantine', 'CON', 36.3650, 25),
        ('Annaba', 'ANN', 36.9000, 23), ('Tlemcen', 'TLE', 34.8828, 13), ('Sétif', 'SET', 36.1833, 19), ('Blida', 'BLI', 36.4703, 9),
        ('Batna', 'BAT', 35.5560, 5), ('Biskra', 'BIS', 34.8500, 7), ('Béjaïa', 'BEJ', 36.7509, 6)) AS t(region, code, latitude, province)"""
    q["region_dimension"] = f"""WITH {OBS}, dim AS (SELECT *, row_number() OVER () - 1 AS n FROM {regions_dim})
      SELECT dim.region, code, province::INTEGER AS province, {s("dim.latitude::DOUBLE")} AS latitude, count(*) AS n_rows, {s("avg(obs.price)")} AS price
      FROM obs LEFT JOIN dim ON obs.order_key % 11 = dim.n GROUP BY dim.region, code, province, dim.latitude"""
    products_dim = """(VALUES ('vegetables', 'Tomates', 'kg', 30, 150), ('vegetables', 'Pommes de terre', 'kg', 30, 100),
        ('vegetables', 'Oignons', 'kg', 30, 120), ('vegetables', 'Carottes', 'kg', 40, 100), ('proteins', 'Poulet', 'kg', 280, 500),
        ('proteins', 'Viande rouge (mouton)', 'kg', 900, 1800), ('proteins', 'Viande rouge (boeuf)', 'kg', 1000, 2000),
        ('proteins', 'Oeufs', 'dozen', 150, 300), ('cereals', 'Pain', 'kg', 20, 50), ('cereals', 'Semoule', 'kg', 50, 120),
        ('cereals', 'Farine', 'kg', 40, 100), ('cereals', 'Riz', 'kg', 100, 250), ('staples', 'Huile végétale', 'liter', 180, 350),
        ('staples', 'Sucre', 'kg', 70, 150), ('staples', 'Lait', 'liter', 60, 100), ('staples', 'Beurre', 'kg', 600, 1200))
        AS t(category, product, unit, low, high)"""
    q["product_dimension"] = f"""WITH {OBS}, dim AS (SELECT *, row_number() OVER () - 1 AS n FROM {products_dim})
      SELECT dim.product, dim.category, unit, count(*) AS n_rows, count(*) FILTER (price BETWEEN low AND high) AS n_inside
      FROM obs LEFT JOIN dim ON obs.order_key % 17 = dim.n GROUP BY dim.product, dim.category, unit"""
    board = """(VALUES ('Alger', 36.74, 3.06), ('Oran', 35.70, -0.63), ('Constantine', 36.37, 6.61), ('Annaba', 36.90, 7.77),
        ('Tlemcen', 34.88, -1.32), ('Sétif', 36.18, 5.41), ('Batna', 35.56, 6.17), ('Tindouf', 27.67, -8.15), ('Blida', 36.47, 2.83),
        ('Ouargla', 31.95, 5.32), ('Ghardaïa', 32.49, 3.67), ('Tizi Ouzou', 36.72, 4.05), ('Béjaïa', 36.75, 5.06), ('Laghouat', 33.80, 2.86),
        ('Biskra', 34.85, 5.73), ('Tamanrasset', 22.79, 5.52), ('Médéa', 36.27, 2.75), ('Mostaganem', 35.93, 0.09), ('Skikda', 36.87, 6.91),
        ('Jijel', 36.82, 5.77)) AS t(region, lat, lon)"""
    q["board_regions"] = f"""WITH {OBS}, dim AS (SELECT *, row_number() OVER () - 1 AS n FROM {board})
      SELECT dim.region, {s("lat::DOUBLE")} AS latitude, {s("lon::DOUBLE")} AS longitude, {s("avg(price)")} AS price
      FROM obs JOIN dim ON obs.order_key % 21 = dim.n GROUP BY dim.region, lat, lon"""
    q["dimension_ranges"] = f"""WITH {OBS}, dim AS (SELECT p_brand AS product, [min(p_retailprice), max(p_retailprice)] AS span
      FROM part GROUP BY 1) SELECT product, count(*) FILTER (price BETWEEN span[1] AND span[2]) AS n_inside,
      count(*) FILTER (NOT price BETWEEN span[1] AND span[2]) AS n_outside FROM obs LEFT JOIN dim USING (product) GROUP BY 1"""

    # cleaning
    q["standardise_types"] = f"""WITH {OBS} SELECT {row}, {snap("price")},
      CASE WHEN order_key % 19 <> 0 THEN {s("price_usd")} END AS price_usd FROM obs
      WHERE date <= TIMESTAMP '2001-06-30' AND order_key % 17 <> 0 AND price > 0"""
    q["drop_exact_duplicates"] = f"""WITH {OBS} SELECT order_key, date::DATE AS date, product, region, market, category,
      {snap("latitude", "longitude", "price", "price_usd")} FROM (SELECT DISTINCT * FROM obs)"""
    bound = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    ahead = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    q["impute_interpolate"] = f"""WITH {GAP_PANEL}, n AS (SELECT *, row_number() OVER ({O}) AS i FROM gaps),
      k AS (SELECT *, CASE WHEN price IS NOT NULL THEN i END AS ki FROM n),
      e AS (SELECT *, last_value(price IGNORE NULLS) OVER ({O} {bound}) AS pa, last_value(ki IGNORE NULLS) OVER ({O} {bound}) AS ia,
        first_value(price IGNORE NULLS) OVER ({O} {ahead}) AS pb, first_value(ki IGNORE NULLS) OVER ({O} {ahead}) AS ib FROM k),
      f AS (SELECT {KEYS}, coalesce(price, pa + (pb - pa) * ((i - ia) / nullif(ib - ia, 0)::DOUBLE), pa, pb) AS price FROM e)
      SELECT {KEYS}, {snap("price")} FROM f WHERE price IS NOT NULL"""
    fine = "PARTITION BY product, region, market ORDER BY date, order_key % 64, order_key, price NULLS FIRST"
    q["impute_interpolate_rows"] = f"""WITH {OBS},
      gaps AS (SELECT date, product, region, market, order_key, CASE WHEN order_key % 7 <> 0 THEN price END AS price FROM obs),
      n AS (SELECT *, row_number() OVER ({fine}) AS i FROM gaps),
      k AS (SELECT *, CASE WHEN price IS NOT NULL THEN i END AS ki FROM n),
      w AS (SELECT *, last_value(price IGNORE NULLS) OVER a AS pa, last_value(ki IGNORE NULLS) OVER a AS ia,
        first_value(price IGNORE NULLS) OVER b AS pb, first_value(ki IGNORE NULLS) OVER b AS ib FROM k
        WINDOW a AS (PARTITION BY product, region, market ORDER BY i {bound}), b AS (PARTITION BY product, region, market ORDER BY i {ahead})),
      f AS (SELECT *, coalesce(price, pa + (pb - pa) * ((i - ia) / nullif(ib - ia, 0)::DOUBLE), pa, pb) AS filled FROM w)
      SELECT date::DATE AS date, product, region, market, order_key, {s("filled")} AS price FROM f WHERE filled IS NOT NULL"""
    for name, fill in (("mean", "avg(price)"), ("median", "median(price)")):
        q[f"impute_{name}"] = f"""WITH {GAP_ROWS}, f AS (SELECT date::DATE AS date, product, region, market,
          coalesce(price, {fill} OVER (PARTITION BY product, region, market)) AS price FROM gaps)
          SELECT date, product, region, market, {snap("price")} FROM f WHERE price IS NOT NULL"""
    q["impute_drop"] = f"""WITH {GAP_ROWS} SELECT date::DATE AS date, product, region, market, {snap("price")}
      FROM gaps WHERE price IS NOT NULL"""
    q["outlier_iqr"] = f"""WITH {OBS}, b AS (SELECT product, region, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3
      FROM obs GROUP BY 1, 2) SELECT {row}, {snap("price")} FROM obs JOIN b USING (product, region)
      WHERE price BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)"""
    q["outlier_zscore"] = f"""WITH {OBS}, b AS (SELECT product, region, avg(price) AS m, stddev_samp(price) AS sd FROM obs GROUP BY 1, 2)
      SELECT {row}, {snap("price")} FROM obs JOIN b USING (product, region) WHERE sd = 0 OR abs((price - m) / sd) <= 3"""
    q["outlier_isolation"] = f"""WITH {OBS}, {price_forest_sql()},
      r AS (SELECT obs.*, score, count(*) OVER ({G}) AS n FROM obs JOIN price_score USING (product, region, price)),
      cuts AS (SELECT product, region, quantile_cont(score, 0.95) AS cut FROM r GROUP BY 1, 2)
      SELECT {row}, {snap("price")} FROM r JOIN cuts USING (product, region) WHERE n < 10 OR score <= cut + 1e-12"""
    q["outlier_dispatch"] = f"""WITH {OBS}, b AS (SELECT product, region, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3,
        avg(price) AS m, stddev_samp(price) AS sd FROM obs GROUP BY 1, 2), o AS (SELECT * FROM obs JOIN b USING (product, region)),
      k AS (SELECT 'iqr' AS method, * FROM o WHERE price BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1)
      UNION ALL SELECT 'zscore', * FROM o WHERE sd = 0 OR abs((price - m) / sd) <= 1.5 UNION ALL SELECT 'unheard-of', * FROM o)
      SELECT method, product, region, count(*) AS n_rows, {s("avg(price)")} AS price FROM k GROUP BY 1, 2, 3"""
    q["filter_sparse_groups"] = f"""WITH {OBS} SELECT {row}, {snap("price")} FROM obs
      QUALIFY count(*) OVER ({G}) >= (SELECT avg(n) FROM (SELECT count(*) AS n FROM obs GROUP BY product, region))"""
    q["clean_prices"] = f"""WITH {OBS}, d AS (SELECT DISTINCT date, product, region, market, price, price_usd FROM obs
      WHERE date <= TIMESTAMP '2001-06-30' AND price > 0),
      b AS (SELECT product, region, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM d GROUP BY 1, 2),
      k AS (SELECT d.* FROM d JOIN b USING (product, region) WHERE price BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1))
      SELECT date::DATE AS date, product, region, market, {snap("price", "price_usd")} FROM k
      QUALIFY count(*) OVER ({G}) >= 30"""
    for name, unit in (("monthly", "month"), ("daily", "day"), ("quarterly", "quarter"), ("yearly", "year")):
        q[f"aggregate_{name}"] = f"""WITH {OBS}, {months("panel", "obs", unit)}
          SELECT {KEYS}, {snap("price", "price_std")}, record_count FROM panel"""
    q["incremental_panel"] = q["aggregate_monthly"]
    q["aggregate_weekly"] = f"""WITH {OBS}, w AS (SELECT product, region, date_trunc('week', date) + INTERVAL 6 DAY AS date, price FROM obs),
      {months("panel", "w", "week").replace("date_trunc('week', date)", "date")}
      SELECT {KEYS}, {snap("price", "price_std")}, record_count FROM panel"""

    # calendar and features
    q["temporal_features"] = f"WITH {shifted(300)} SELECT product, date, {snap('price')}, {calendar_columns()} FROM moved"
    q["event_flags"] = f"""WITH {shifted(300)} SELECT product, date, {snap("price")},
      {calendar("date", RAMADAN)} AS is_ramadan, {holiday("date")} AS is_holiday FROM moved"""
    q["ramadan_board"] = f"""WITH {shifted(240)} SELECT product, date, {snap("price")},
      {calendar("date", BOARD_RAMADAN)} AS is_ramadan, {season("date", SEASONS_FR)} AS season FROM moved"""
    q["lag_features"] = on_panel(LAGS)
    q["rolling_features"] = on_panel(ROLLING)
    q["pct_change_features"] = on_panel(CHANGES)
    q["price_vs_national"] = on_panel([NATIONAL])
    for method in ("minmax", "standard", "robust"):
        q[f"normalise_{method}"] = on_panel([("price_norm", norm_sql(method))])
    q["normalise_unknown"] = q["normalise_minmax"]
    q["simple_features"] = on_panel([change_sql(1), change_sql(12), ("rolling_3m", f"avg(price) OVER {last(3)}")])
    q["build_features"] = f"""WITH {FEATURES} SELECT {KEYS}, {snap("price", *FEATURE_NAMES, *TRIG)},
      {", ".join(n for n, _ in CALENDAR if n not in TRIG)} FROM features"""
    q["inverse_normalise"] = f"""WITH {KNOWN}, p AS (SELECT product, region, avg(price) AS m,
      CASE WHEN stddev_pop(price) = 0 THEN 1 ELSE stddev_pop(price) END AS d FROM known GROUP BY 1, 2)
      SELECT {KEYS}, {s("(price - m) / d")} AS price_norm, {s("(price - m) / d * d + m")} AS price FROM known JOIN p USING (product, region)"""
    steps = ["price_norm", "month_sin", "month_cos", "is_ramadan", "is_holiday", "pct_change_1m", "pct_change_12m", "price_vs_national"]
    back = f"({O} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)"
    q["build_sequences"] = f"""WITH {FEATURES}, n AS (SELECT {KEYS}, coalesce(price_norm, 0) AS y, row_number() OVER ({O}) AS r,
      coalesce(pct_change_1m, 0) AS c1, {" + ".join(f"coalesce({c}, 0)" for c in steps)} AS row_total FROM features),
      w AS (SELECT {KEYS}, y, r, count(*) OVER {back} AS steps, first_value(y) OVER {back} AS first_target,
        last_value(c1) OVER {back} AS last_change, sum(row_total) OVER {back} AS total FROM n)
      SELECT {KEYS}, steps, {snap("y", "first_target", "last_change", "total")} FROM w WHERE r > 60"""

    # anomalies
    q["detection_features"] = f"WITH {KNOWN}, {detect_sql('known')} SELECT {KEYS}, {snap(*DETECT)} FROM featured"
    q["scale_features"] = f"""WITH {TRAINING} SELECT {KEYS}, {", ".join(f"{s(f'x{i}')} AS s_{f}" for i, f in enumerate(DETECT))} FROM scaled"""
    q["isolation_score"] = f"""WITH {TRAINING}, {forest_sql("scaled", KEYS, 6, 100)} SELECT {KEYS}, {s("iso_score")} AS score FROM iso_score"""
    q["boundary_score"] = f"""WITH {TRAINING}, {boundary_sql("scaled", KEYS)} SELECT {KEYS}, {s("similarity")} AS score FROM svm_score"""
    q["normalise_score"] = f"WITH {KNOWN} SELECT {KEYS}, {s(minmax('price'))} AS score FROM known"
    q["composite_score"] = f"""WITH {KNOWN}, a AS (SELECT *, {minmax("price")} AS if_score, {minmax("(-price)")} AS u FROM known),
      b AS (SELECT *, u * u AS svm_score FROM a)
      SELECT {KEYS}, {snap("price", "if_score", "svm_score")}, {s("0.5 * if_score + 0.5 * svm_score")} AS anomaly_score,
      {s("0.5 * if_score + 0.5 * svm_score", 6)} >= 0.45 AS is_anomaly FROM b"""
    scores = snap("price", "if_score", "svm_score", "anomaly_score")
    q["score_panel"] = f"WITH {scored_sql()} SELECT {KEYS}, {scores}, is_anomaly FROM scored"
    q["detector_params_io"] = f"WITH {scored_sql(0.8)} SELECT {KEYS}, {scores}, is_anomaly FROM scored"
    q["score_repeated_rows"] = f"""WITH {KNOWN},
      twice AS (SELECT * FROM known UNION ALL SELECT * FROM known WHERE month(date) % 5 = 0),
      numbered AS (SELECT *, row_number() OVER ({O}) AS rn FROM twice),
      {detect_sql("numbered", "featured", "rn, ", G, "date, rn")}, {SCALERS}, {scaled_sql("featured", "scaled", "rn, ")},
      {forest_sql("scaled", "rn, " + KEYS, 6, 100)}, {boundary_sql("scaled", "rn, " + KEYS)},
      {composite_sql("scaled", "featured", "rn, " + KEYS, 0.7)}
      SELECT {KEYS}, {scores}, is_anomaly FROM scored"""
    q["severity"] = f"""WITH {SCORED} SELECT {KEYS}, {snap("anomaly_score")}, {grade("anomaly_score")} AS severity,
      {grade("anomaly_score", SEVERITIES_FR)} AS label FROM scored"""
    q["generate_alerts"] = f"WITH {ALERTS} SELECT {ALERT_COLUMNS} FROM alerts"
    q["alert_message"] = f"""WITH {SCORED} SELECT {KEYS}, product || ' price in ' || region || ' on ' || strftime(date, '%Y-%m') || ': '
      || format('{{:.0f}}', round(price, 0)) || ' DZD (' || CASE WHEN coalesce(pct_change_1m, 0) >= 0 THEN '▲' ELSE '▼' END
      || format('{{:.1f}}', round(abs(coalesce(pct_change_1m, 0)), 1)) || '% MoM). Anomaly score: '
      || format('{{:.2f}}', round(anomaly_score, 2)) || '.' AS message FROM scored WHERE is_anomaly"""
    oid = "obs_id, "
    series = "PARTITION BY product, region, obs_id"
    q["score_new_observations"] = f"""WITH {TRAINING},
      ends AS (SELECT product, region, max(date) AS last, max_by(price, date) AS lp, min_by(price, date) AS fp FROM known GROUP BY 1, 2),
      fresh AS (SELECT product || '/' || region || '/a' AS obs_id, product, region, (last + INTERVAL 1 MONTH)::DATE AS date, lp * 2 AS price FROM ends
        UNION ALL SELECT product || '/' || region || '/b', product, region, (last - INTERVAL 10 MONTH)::DATE, fp FROM ends),
      extended AS (SELECT obs_id, product, region, k.date, k.price, false AS is_new FROM fresh f JOIN known k USING (product, region)
        UNION ALL SELECT obs_id, product, region, date, price, true FROM fresh),
      {detect_sql("extended", "longer", "obs_id, is_new, ", series, "date, is_new")},
      {scaled_sql("longer", "longer_x", "obs_id, is_new, ")},
      mixed AS (SELECT obs_id, is_new, {KEYS}, false AS fits, x0, x1, x2, x3, x4, x5 FROM longer_x
        UNION ALL SELECT NULL, NULL, {KEYS}, true, x0, x1, x2, x3, x4, x5 FROM scaled),
      {forest_sql("mixed", "obs_id, is_new, " + KEYS, 6, 100, "fits")},
      {boundary_sql("longer_x", "obs_id, is_new, " + KEYS)},
      {composite_sql("longer_x", "longer", "obs_id, is_new, " + KEYS, 0.7, series, "rescored")},
      unknown AS (SELECT obs_id || '?' AS obs_id, product, 'NOWHERE' AS region, date, price FROM fresh WHERE region = 'ASIA')
      SELECT obs_id, product, region, date, {snap("price")}, {s("round(anomaly_score, 4)")} AS anomaly_score, is_anomaly,
        {grade("anomaly_score")} AS severity, true AS found FROM rescored WHERE is_new
      UNION ALL SELECT obs_id, product, region, date, {snap("price")}, NULL, NULL, NULL, false FROM unknown"""
    simple = f"CASE WHEN max({{0}}) OVER ({G}) = min({{0}}) OVER ({G}) THEN 0 ELSE ({{0}} - min({{0}}) OVER ({G})) / (max({{0}}) OVER ({G}) - min({{0}}) OVER ({G})) END"
    q["isolation_score_simple"] = f"""WITH {KNOWN}, p AS (SELECT *, (price / nullif(lag(price) OVER ({O}), 0) - 1) * 100 AS pct_change_1m,
      avg(price) OVER {last(3)} AS rolling_3m, count(*) OVER ({G}) AS n FROM known),
      z AS (SELECT *, coalesce(pct_change_1m, 0) AS c FROM p),
      scaled AS (SELECT {KEYS}, {simple.format("price")} AS x0, {simple.format("c")} AS x1, {simple.format("rolling_3m")} AS x2 FROM z WHERE n >= 12),
      {forest_sql("scaled", KEYS, 3, 60)},
      d AS (SELECT {KEYS}, price, pct_change_1m, rolling_3m, {s("-iso_score", 9)} AS d FROM p LEFT JOIN iso_score USING ({KEYS})),
      o AS (SELECT *, coalesce(1 - (d - min(d) OVER ({G})) / (max(d) OVER ({G}) - min(d) OVER ({G}) + 1e-9), 0) AS odd FROM d)
      SELECT {KEYS}, {snap("price", "pct_change_1m", "rolling_3m")}, {s(s("odd"))} AS anomaly_score, {s("odd", 6)} >= 0.75 AS is_anomaly FROM o"""
    q["anomaly_summary"] = f"""WITH {SCORED} SELECT count(*) AS n_rows, count(*) FILTER (is_anomaly) AS n_anomalies,
      {s("avg(is_anomaly::INTEGER)")} AS anomaly_rate, count(*) FILTER (is_anomaly) AS n_alerts FROM scored"""
    q["anomalies_by_product"] = f"WITH {SCORED} SELECT product, count(*) FILTER (is_anomaly) AS n_anomalies FROM scored GROUP BY 1"
    q["severity_counts"] = f"WITH {ALERTS} SELECT severity, count(*) AS n_alerts FROM alerts GROUP BY 1"
    q["alert_bands"] = f"""WITH {SCORED} SELECT count(*) AS total, count(*) FILTER (anomaly_score >= 0.95) AS critical,
      count(*) FILTER (anomaly_score >= 0.85 AND anomaly_score < 0.95) AS high,
      count(*) FILTER (anomaly_score >= 0.75 AND anomaly_score < 0.85) AS medium FROM scored WHERE is_anomaly"""
    q["score_histogram"] = f"""WITH {SCORED} SELECT least(floor({s("anomaly_score", 6)} * 50 + 1e-9) + 1, 50)::INTEGER AS bin,
      count(*) AS n_rows FROM scored GROUP BY 1"""

    # forecasts
    gate = f"{KNOWN}, {gated('known')}"
    q["forecast_seasonal_trend"] = f"WITH {gate}, {trend_sql('gated')}, {trend_ahead()} SELECT product, region, step, ds, {Y3} FROM trend_ahead"
    q["forecast_seasonal_events"] = f"""WITH {KNOWN}, later AS (SELECT product, region, (date + INTERVAL 300 MONTH)::DATE AS date, price FROM known),
      {gated("later")}, {trend_sql("gated")}, {trend_ahead("12", 1.64, True)} SELECT product, region, step, ds, {Y3} FROM trend_ahead"""
    bent = f"{KNOWN}, {bends_sql('known')}"
    total = " + ".join(f"abs(beta[{3 + k}])" for k in range(8))
    q["forecast_changepoints"] = f"""WITH RECURSIVE {bent}, v AS (
      SELECT product, region, step, ds, {bent_values()} AS v, 1.96 * sqrt(coalesce(sigma, 0) ** 2
        + 2 * (scale * ({total}) / (8 * greatest(span, 1))) ** 2 * (8 / (0.8 * greatest(span, 1))) * (step * (step + 1) * (2 * step + 1) / 6)) AS r
      FROM {future("bent", "12")})
      SELECT product, region, step, ds, {s("exp(v)", 3)} AS yhat, {s("exp(v - r)", 3)} AS yhat_lower, {s("exp(v + r)", 3)} AS yhat_upper FROM v"""
    q["trend_changes"] = f"""WITH RECURSIVE {KNOWN}, later AS (SELECT product, region, (date + INTERVAL 300 MONTH)::DATE AS date, price FROM known),
      {bends_sql("later", 4, 2, True, False)}
      SELECT product, region, n::INTEGER AS number, make_date(((mm - 1) // 12)::BIGINT, ((mm - 1) % 12 + 1)::BIGINT, 1) AS month,
             {s("per * beta[2 + n]", 3)} AS change, {s("per * list_sum(beta[2:2 + n])", 3)} AS slope
      FROM (SELECT *, scale / greatest(span, 1) AS per, (t0 + floor(span * (0.8 * n / 4)))::BIGINT AS mm FROM bent, range(1, 5) AS r(n))"""
    q["evaluate_changepoints"] = f"""WITH RECURSIVE {KNOWN},
      cut AS (SELECT *, row_number() OVER ({O}) <= floor(count(*) OVER ({G}) * 0.8) AS seen FROM known),
      train AS (SELECT * FROM cut WHERE seen), {bends_sql("train")}, {trend_sql("train")},
      factors AS (SELECT product, region, m, factor FROM trend_s),
      judged AS (
        SELECT c.product, c.region, c.date, c.price, exp({bent_values(day="c.date").replace("t0)", "bent.t0)")}) AS bent,
               (a + b * ({MONTH.replace("date", "c.date")} - l.t0)) * coalesce(factor, 1) AS line
        FROM cut c JOIN bent USING (product, region)
        JOIN (SELECT product, region, t0 AS t0, a, b FROM trend) l ON l.product = c.product AND l.region = c.region
        LEFT JOIN factors f ON f.product = c.product AND f.region = c.region AND f.m = month(c.date) WHERE NOT seen)
      SELECT product, region, {s("avg(abs(bent - price))", 3)} AS mae_bent, {s("avg(abs(line - price))", 3)} AS mae_line,
             count(*) AS n_test FROM judged GROUP BY 1, 2"""
    q["forecast_autoregressive"] = f"WITH {gate}, {ar_sql('gated')} SELECT product, region, step, ds, {snap('yhat')} FROM ar_ahead"
    q["forecast_ensemble"] = f"""WITH {gate}, {ENSEMBLE} SELECT ds, {snap("trend_yhat", "ar_yhat", "ensemble_yhat", "yhat_lower", "yhat_upper")},
      product, region, step FROM ensemble"""
    q["fit_gate"] = f"WITH {KNOWN}, {gated('known', 80)} SELECT {KEYS}, {snap('price')} FROM gated"
    q["skipped_series"] = f"WITH {KNOWN} SELECT product, region, count(*) AS n_rows FROM known GROUP BY 1, 2 HAVING count(*) < 80"
    q["future_calendar"] = f"""WITH {KNOWN}, l AS (SELECT product, region, max(date) AS last_date FROM known GROUP BY 1, 2)
      SELECT product, region, step, ds FROM {future("l", "24")}"""
    q["forecast_quadratic"] = f"WITH {KNOWN}, {quadratic_sql('known')} SELECT product, region, step, ds, {Y3} FROM quad"
    q["holdout_split"] = f"""WITH {KNOWN}, {split_sql("known")} SELECT {KEYS}, {snap("price")},
      CASE WHEN r <= cut THEN 'train' ELSE 'test' END AS part, (r - cut)::INTEGER AS step FROM split"""
    error = "avg(abs({y} - {p})) AS mae, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse, avg(CASE WHEN {y} <> 0 THEN abs({y} - {p}) / abs({y}) END) * 100 AS mape"
    q["metrics"] = f"""WITH {KNOWN}, l AS (SELECT *, {lag_sql(1)} AS p FROM known),
      m AS (SELECT product, region, {error.format(y="price", p="p")} FROM l WHERE p IS NOT NULL GROUP BY 1, 2)
      SELECT product, region, {snap("mae", "rmse", "mape")} FROM m"""
    q["evaluate_forecasts"] = f"""WITH {KNOWN}, {split_sql("known")}, {gated("train")},
      test AS (SELECT product, region, (r - cut)::INTEGER AS step, price AS actual FROM split WHERE r > cut),
      steps AS (SELECT product, region, max(step) AS h FROM test GROUP BY 1, 2),
      {trend_sql("gated")}, long_trend AS (SELECT * FROM trend JOIN steps USING (product, region)),
      {trend_ahead("h", 1.96, False, "trend", "long_trend")}, {ar_sql("gated", "h", "JOIN steps USING (product, region)")},
      both_models AS (SELECT product, region, step, t.yhat AS trend_yhat, coalesce(a.yhat, t.yhat) AS ar_yhat, actual
        FROM trend_ahead t LEFT JOIN (SELECT product, region, step, yhat FROM ar_ahead) a USING (product, region, step)
        JOIN test USING (product, region, step)),
      long_form AS (SELECT 'trend' AS model, product, region, actual, trend_yhat AS p FROM both_models
        UNION ALL SELECT 'autoregressive', product, region, actual, ar_yhat FROM both_models
        UNION ALL SELECT 'ensemble', product, region, actual, 0.5 * trend_yhat + 0.5 * ar_yhat FROM both_models),
      m AS (SELECT model, product, region, {error.format(y="actual", p="p")} FROM long_form GROUP BY 1, 2, 3)
      SELECT model, product, region, {snap("mae", "rmse", "mape")} FROM m"""
    q["best_matches"] = """WITH known AS (
      SELECT p_type AS name FROM part UNION SELECT p_brand FROM part UNION SELECT n_name FROM nation),
    asked AS (SELECT DISTINCT unnest([lower(p_type), substr(p_type, 3, 6),
        'the ' || p_brand || ' of ' || p_partkey::VARCHAR, substr(p_brand, 6, 2), right(p_name, 4)]) AS requested FROM part),
    ranked AS (SELECT requested, name, row_number() OVER (PARTITION BY requested ORDER BY
        CASE WHEN lower(name) = lower(requested) THEN 0 ELSE 1 END, name) AS place
      FROM asked JOIN known ON contains(lower(name), lower(requested)) OR contains(lower(requested), lower(name)))
    SELECT requested, name FROM asked LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (requested)"""
    q["best_match"] = " UNION ALL ".join(
        f"SELECT * FROM ({match_sql('p_brand', 'part', w)})" for w in ("brand#7", "AND#2", "the brand#14 price", "tomates")
    )
    q["pick_best_series"] = f"""WITH {KNOWN}, counts AS (SELECT product, region, count(DISTINCT date) AS n_months FROM known GROUP BY 1, 2)
      SELECT * FROM ({best_series("brand#7", "asi")}) UNION ALL SELECT * FROM ({best_series("Tomates", "Alger")})"""
    q["denormalise_forecast"] = f"""WITH {gate}, {ar_sql("gated")}, f AS (SELECT product, region, avg(price) AS m,
      CASE WHEN stddev_samp(price) = 0 THEN 1 ELSE stddev_samp(price) END AS d FROM known GROUP BY 1, 2)
      SELECT product, region, step, ds, {s("yhat / 1000 * d + m")} AS yhat FROM ar_ahead JOIN f USING (product, region)"""
    q["forecast_params_io"] = f"WITH {gate}, {trend_sql('gated')}, {trend_ahead('6', 1.64)} SELECT product, region, step, ds, {Y3} FROM trend_ahead"
    q["future_only"] = f"""WITH {KNOWN}, {split_sql("known")}, {quadratic_sql("train", 24)},
      l AS (SELECT product, region, max(date) AS last FROM known GROUP BY 1, 2)
      SELECT product, region, step, ds, {Y3} FROM quad JOIN l USING (product, region) WHERE ds > last"""
    q["last_steps"] = f"""WITH {gate}, {ar_sql("gated", "24")} SELECT product, region, step, ds, {snap("yhat")} FROM ar_ahead
      QUALIFY row_number() OVER ({G} ORDER BY ds DESC) <= 8"""

    # reports
    for name, column in (("products", "product"), ("regions", "region"), ("categories", "category")):
        q[f"list_{name}"] = f"WITH {OBS} SELECT DISTINCT {column} FROM obs"
    q["query_prices"] = f"""WITH {KNOWN} SELECT strftime(date, '%Y-%m-%d') AS date, product, region, {snap("price")} FROM known
      WHERE product = 'Brand#7' AND region = 'ASIA' AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
      ORDER BY date DESC, price LIMIT 100"""
    best = "ORDER BY anomaly_score DESC, product, region, date"
    q["query_alerts"] = f"""WITH {ALERTS}, t AS (SELECT * FROM alerts WHERE severity = 'LOW' AND region = 'ASIA' {best} LIMIT 50)
      SELECT {ALERT_COLUMNS} FROM t"""
    q["filter_panel"] = f"""WITH {OBS} SELECT {row}, category, {snap("price")} FROM obs
      WHERE product IN ('Brand#1', 'Brand#2', 'Brand#3') AND region IN ('ASIA', 'EUROPE')
      AND date BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31' AND category IN ('ECONOMY', 'STANDARD', 'PROMO')"""
    q["kpi_summary"] = f"""WITH {SCORED}, l AS (SELECT max(date) AS d FROM scored),
      a AS (SELECT avg(price) FILTER (date = d) AS avg_now,
        coalesce(avg(price) FILTER (date = (d - INTERVAL 1 MONTH)::DATE), avg(price) FILTER (date = d)) AS avg_prev,
        count(DISTINCT product) AS n_products, count(DISTINCT region) AS n_regions, count(*) AS n_rows,
        count(*) FILTER (is_anomaly) AS n_anomalies, count(*) FILTER (anomaly_score >= 0.95) AS n_critical FROM scored, l)
      SELECT {snap("avg_now", "avg_prev")}, {s("coalesce((avg_now - avg_prev) / nullif(avg_prev, 0) * 100, 0)")} AS mom_pct,
        n_products, n_regions, n_rows, n_anomalies, n_critical FROM a"""
    q["map_latest"] = f"""WITH {OBS}, o AS (SELECT * FROM obs WHERE product = 'Brand#7'),
      l AS (SELECT * FROM o WHERE date = (SELECT max(date) FROM o))
      SELECT region, {s("avg(price)")} AS price, {s("min(latitude)")} AS latitude,
        {s("arg_min(longitude, latitude)")} AS longitude FROM l GROUP BY 1"""
    q["map_with_missing_regions"] = f"""WITH {OBS}, o AS (SELECT market AS region, date_trunc('month', date) AS date, price, latitude, longitude
        FROM obs WHERE product = 'Brand#7'),
      pts AS (SELECT region, avg(price) AS price, min(latitude) AS latitude, min(longitude) AS longitude
        FROM o WHERE date = (SELECT max(date) FROM o) GROUP BY 1),
      ends AS (SELECT min(price) AS lo, max(price) AS hi FROM pts),
      everywhere AS (SELECT * FROM pts UNION ALL SELECT n_name, NULL, n_nationkey + 20.0::DOUBLE, n_nationkey * 0.5::DOUBLE - 5.0::DOUBLE FROM nation
        WHERE n_name NOT IN (SELECT region FROM pts))
      SELECT region, {snap("price", "latitude", "longitude")}, price IS NOT NULL AS has_price,
        CASE WHEN price IS NOT NULL THEN {s("12 + 28 * (price - lo) / greatest(hi - lo, 1)")} ELSE 8 END AS marker_size
      FROM everywhere, ends"""
    q["price_trend"] = f"WITH {OBS} SELECT date::DATE AS date, product, {s('avg(price)')} AS price FROM obs GROUP BY 1, 2"
    q["event_trend"] = f"SELECT ts::DATE AS date, event_type AS product, {s('avg(value)')} AS price FROM events GROUP BY 1, 2"
    q["ramadan_months"] = f"""WITH {shifted(300)} SELECT DISTINCT date AS period_start, (date + INTERVAL 1 MONTH)::DATE AS period_end FROM moved
      WHERE {calendar("date", RAMADAN)} = 1 ORDER BY 1 LIMIT 10"""
    q["heatmap_month_region"] = f"""WITH {OBS} SELECT strftime(date, '%Y-%m') AS label, region, {s("avg(price)")} AS price FROM obs
      WHERE product = 'Brand#7' GROUP BY 1, 2"""
    latest = "date = (SELECT max(date) FROM known)"
    q["compare_regions_latest"] = f"WITH {KNOWN} SELECT region, product, {s('avg(price)')} AS price FROM known WHERE {latest} GROUP BY 1, 2"
    five = ", ".join(f"{s(f'quantile_cont(price, {p})')} AS {n}" for n, p in (("min", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0)))
    q["price_boxplot"] = f"WITH {OBS} SELECT product, {five} FROM obs GROUP BY 1"
    stats = (("mean", "avg(price)"), ("median", "median(price)"), ("std", "stddev_samp(price)"), ("min", "min(price)"), ("max", "max(price)"))
    q["descriptive_stats"] = f"WITH {OBS} SELECT product, {', '.join(f'{s(x, 1)} AS {n}' for n, x in stats)} FROM obs GROUP BY 1"
    q["alert_board"] = f"""WITH {SCORED}, t AS (SELECT * FROM scored WHERE is_anomaly {best} LIMIT 100)
      SELECT strftime(date, '%Y-%m') AS month, product, region, format('{{:,.0f}}', round(price, 0)) AS price,
      coalesce({PERCENT.format(x="pct_change_1m")}, '—') AS mom, format('{{:.2f}}', round(anomaly_score, 2)) AS score,
      {grade("anomaly_score", SEVERITIES_FR)} AS severity FROM t"""
    q["forecast_table"] = f"""WITH {KNOWN}, {quadratic_sql("known", 6)} SELECT product, region, strftime(ds, '%Y-%m') AS month,
      {", ".join(f"format('{{:,.0f}}', round({c}, 0)) AS {c}" for c in ("yhat", "yhat_lower", "yhat_upper"))} FROM quad"""
    q["median_by_product"] = f"WITH {OBS}, {medians()} SELECT product, {snap('median_price')} FROM med"
    q["rows_by_region"] = f"WITH {OBS} SELECT region, count(*) AS n_rows FROM obs GROUP BY 1"
    names = ("date", "product", "region", "market", "price")
    q["null_profile"] = f"""WITH {GAP_ROWS} SELECT {", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in names)},
      min(date)::DATE AS min_date, max(date)::DATE AS max_date, min(year(date))::INTEGER AS min_year, max(year(date))::INTEGER AS max_year FROM gaps"""
    top = "(SELECT product, median_price FROM med ORDER BY median_price DESC, product LIMIT 4)"
    q["top_products"] = f"WITH {OBS}, {medians()} SELECT product, {snap('median_price')} FROM {top}"
    q["monthly_seasonality"] = f"""WITH {OBS}, {medians()} SELECT product, month(date)::INTEGER AS month, {s("avg(price)")} AS price FROM obs
      WHERE product IN (SELECT product FROM {top}) GROUP BY 1, 2"""
    q["ramadan_effect"] = f"""WITH {OBS}, d AS (SELECT product, (date + INTERVAL 300 MONTH)::DATE AS date, price FROM obs),
      f AS (SELECT *, {calendar("date", RAMADAN)} AS flag FROM d),
      e AS (SELECT product, avg(price) FILTER (flag = 0) AS outside, avg(price) FILTER (flag = 1) AS inside FROM f GROUP BY 1)
      SELECT product, {snap("outside", "inside")}, {s("(inside / nullif(outside, 0) - 1) * 100")} AS effect_pct FROM e"""
    q["yoy_inflation"] = f"""WITH {OBS}, y AS (SELECT product, year(date)::INTEGER AS year,
        avg(CASE WHEN NOT (year(date) = 1998 AND length(product) = 7) THEN price END) AS price FROM obs GROUP BY 1, 2),
      grid AS (SELECT * FROM (SELECT DISTINCT product FROM y), (SELECT DISTINCT year FROM y)),
      h AS (SELECT g.product, g.year, price, last_value(price IGNORE NULLS) OVER (PARTITION BY g.product ORDER BY g.year
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM grid g LEFT JOIN y ON g.product = y.product AND g.year = y.year)
      SELECT product, year, {snap("price")}, {s("(held / nullif(lag(held) OVER (PARTITION BY product ORDER BY year), 0) - 1) * 100")} AS yoy_pct FROM h"""
    regions = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    cells = ", ".join(f"""{s(f"coalesce(avg(price) FILTER (region = '{r}'), 0)")} AS "{r}" """ for r in regions)
    q["pivot_latest"] = f"WITH {KNOWN} SELECT product, {cells} FROM known WHERE {latest} GROUP BY 1"
    q["product_correlation"] = f"""WITH {KNOWN}, m AS (SELECT date, product, avg(price) AS price FROM known GROUP BY 1, 2)
      SELECT a.product AS product_a, b.product AS product_b, {s("corr(a.price, b.price)")} AS correlation, count(*) AS n_dates
      FROM m a JOIN m b ON a.date = b.date AND a.product > b.product GROUP BY 1, 2"""
    q["product_correlation_blocks"] = q["product_correlation"]
    daily = OBS + ",\n" + months("panel", "obs", "day")
    plain = {
        "long_lags": "lag_features",
        "long_rolling": "rolling_features",
        "long_changes": "pct_change_features",
        "long_national": "price_vs_national",
        "long_normalise_minmax": "normalise_minmax",
        "long_normalise_robust": "normalise_robust",
        "long_features": "build_features",
        "long_detection": "detection_features",
        "long_normalise_score": "normalise_score",
    }
    for name, same in plain.items():
        q[name] = q[same].replace(PANEL, daily)
    q["series_with_anomalies"] = f"""WITH {SCORED} SELECT date, {snap("price")}, is_anomaly,
      CASE WHEN is_anomaly THEN {s("price")} END AS anomaly_price FROM scored WHERE product = 'Brand#7' AND region = 'ASIA'"""
    q["top_alerts"] = f"WITH {ALERTS}, t AS (SELECT * FROM alerts {best} LIMIT 10) SELECT {ALERT_COLUMNS} FROM t"
    q["price_labels"] = f"""WITH {KNOWN}, c AS (SELECT *, (price / nullif(lag(price) OVER ({O}), 0) - 1) * 100 AS pct FROM known)
      SELECT {KEYS}, format('{{:,.2f}}', price) || ' DZD' AS price_label, {PERCENT.format(x="pct")} AS change_label FROM c"""
    q["history_with_forecast"] = f"""WITH {KNOWN}, {quadratic_sql("known", 6)}
      SELECT product, region, date AS ds, {snap("price")}, 'history' AS kind, NULL AS yhat, NULL AS yhat_lower, NULL AS yhat_upper FROM known
      UNION ALL SELECT product, region, ds, NULL, 'forecast', {s("yhat")}, {s("yhat_lower")}, {s("yhat_upper")} FROM quad"""
    q["forecast_reply"] = f"""WITH {gate}, {ENSEMBLE} SELECT strftime(ds, '%Y-%m-%d') AS date,
      {", ".join(f"{s(f'round({c}, 2)')} AS {c}" for c in ("ensemble_yhat", "trend_yhat", "yhat_lower", "yhat_upper"))}
      FROM ensemble WHERE product = 'Brand#7' AND region = 'ASIA' AND step <= 6"""
    return q
