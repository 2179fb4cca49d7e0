"""SQL that states each registered query independently, for a check in another engine."""

from __future__ import annotations

import re

from sensorgrid.plans.manual_counts import COUNTING_POINTS

# Names of the cell features in the order of the tables that have them.
STREET = [f"str_class_{k}" for k in ("0", "I", "II", "III", "IV", "V")]
LAND = [f"land_{k}" for k in ("water", "grey", "green", "infra", "mixed", "forest", "living")]
_STREET_SQL = ", ".join(f"CAST(s_suppkey % {k} AS BIGINT) AS {n}" for k, n in enumerate(STREET, 2))
_LAND_SQL = ", ".join(f"CAST(s_suppkey % {k} AS DOUBLE) / {k} AS {n}" for k, n in enumerate(LAND, 4))
_CELL_SQL = ", ".join(
    f"coalesce({t}.{n}, 0) AS {n}" for t, names in (("s", STREET), ("l", LAND)) for n in names
)

# The input tables as SQL, in order of dependence. See ``views.py``.
VIEWS: dict[str, str] = {
    "obs": """SELECT event_id, concat('det_', CAST(user_id AS VARCHAR)) AS mq_name,
        CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_time,
        CASE WHEN event_type = 'error' THEN CAST(-1 AS DOUBLE) ELSE value END AS q_kfz,
        CASE WHEN event_type = 'signup' THEN CAST(-1 AS DOUBLE)
             ELSE CAST(20 + event_id % 60 AS DOUBLE) END AS v_kfz,
        CAST(user_id % 15 AS BIGINT) AS x, CAST(floor(user_id / 15.0) AS BIGINT) AS y
        FROM events""",
    "cells": """SELECT CAST(s_suppkey % 10 AS BIGINT) AS x,
        CAST(floor(s_suppkey / 10.0) AS BIGINT) AS y, s_suppkey, s_nationkey, s_acctbal
        FROM supplier""",
    "sensor_map": """SELECT DISTINCT x AS det_x, y AS det_y, CAST(x % 10 AS BIGINT) AS stadt_x,
        CAST(y % 10 AS BIGINT) AS stadt_y FROM obs""",
    "stations": """SELECT DISTINCT CAST(p_size % 12 AS BIGINT) AS stadt_x,
        CAST(length(p_name) AS BIGINT) AS stadt_y FROM part""",
    "streets": f"SELECT x + 1 AS x, y, {_STREET_SQL} FROM cells",
    "land": f"SELECT x, y, {_LAND_SQL} FROM cells",
    "houses": """SELECT x, y + 1 AS y, CAST(s_suppkey % 5 AS DOUBLE) / 5 AS building_density,
        CAST(3 + s_suppkey % 20 AS DOUBLE) AS building_height FROM cells""",
    "volume": """SELECT x, y, CASE WHEN s_nationkey < 3 THEN CAST(0 AS DOUBLE)
        WHEN s_nationkey < 6 THEN CAST(20000 AS DOUBLE)
        ELSE abs(s_acctbal) / 5 END AS kfz_per_24h FROM cells""",
    "calendar": """SELECT date_time, CASE WHEN day(date_time) BETWEEN 3 AND 6 THEN 'Winterferien'
        WHEN day(date_time) BETWEEN 20 AND 25 THEN 'Sommerferien' END AS type_school_holiday,
        CAST(CASE WHEN day(date_time) = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_public_holiday,
        CAST(dayofyear(date_time) AS DOUBLE) / 366 AS doy_scaled
        FROM (SELECT DISTINCT date_time FROM obs) h""",
    "preds_year": """SELECT CAST(1 + l_linenumber % 2 AS BIGINT) AS model_id,
        CAST(l_shipdate AS TIMESTAMP) AS date_time, CAST(l_suppkey % 10 AS BIGINT) AS x,
        CAST(floor(l_suppkey / 10.0) AS BIGINT) AS y,
        CASE WHEN l_suppkey % 11 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS value
        FROM lineitem""",
    "points": """SELECT concat_ws(' ', c_name, n_name) AS bez,
        CASE WHEN c_custkey * 37 % 1009 <> 5
             THEN CAST(52.3 AS DOUBLE) + CAST(c_custkey * 37 % 1009 AS DOUBLE) / 2500 END AS lat,
        CAST(13.1 AS DOUBLE) + CAST(c_custkey * 53 % 997 AS DOUBLE) / 2000 AS lon
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "cell_coords": """SELECT x, y, CAST(5230000 + y * 4000 AS BIGINT) AS lat_int,
        CAST(1310000 + x * 5000 AS BIGINT) AS lon_int FROM cells""",
    "cell_streets": """SELECT x + 1 AS stadt_x, y AS stadt_y,
        concat('el_', CAST(s_suppkey % 28 AS VARCHAR)) AS element_nr FROM cells""",
    "street_names": """SELECT concat('el_', CAST(n_nationkey AS VARCHAR)) AS element_nr,
        n_name AS strassenname FROM nation""",
    "factors": """SELECT v.x, v.y, v.kfz_per_24h, p.kfz_per_24h_pred,
        CASE WHEN v.kfz_per_24h > 0 AND (p.kfz_per_24h_pred = 0
                  OR v.kfz_per_24h / nullif(p.kfz_per_24h_pred, 0) > 5) THEN CAST(5 AS DOUBLE)
             WHEN v.kfz_per_24h <= 0.001 THEN CAST(0 AS DOUBLE)
             WHEN v.kfz_per_24h / nullif(p.kfz_per_24h_pred, 0) < 0.1 THEN CAST(0.1 AS DOUBLE)
             ELSE v.kfz_per_24h / nullif(p.kfz_per_24h_pred, 0) END AS scaling
        FROM volume v JOIN (SELECT x, y, avg(value) * 24 AS kfz_per_24h_pred
                            FROM preds_year GROUP BY x, y) p ON v.x = p.x AND v.y = p.y""",
    "cell_table": f"""SELECT c.x, c.y, {_CELL_SQL}, coalesce(v.kfz_per_24h, 0) AS traffic_volume,
        coalesce(b.building_density, 0) AS building_density,
        coalesce(b.building_height, 0) AS building_height
        FROM (SELECT x, y FROM cells UNION SELECT stadt_x, stadt_y FROM sensor_map
              UNION SELECT stadt_x, stadt_y FROM stations) c
        LEFT JOIN streets s ON c.x = s.x AND c.y = s.y
        LEFT JOIN land l ON c.x = l.x AND c.y = l.y
        LEFT JOIN volume v ON c.x = v.x AND c.y = v.y
        LEFT JOIN houses b ON c.x = b.x AND c.y = b.y""",
    "located": """SELECT bez, lat, lon, x, y, dist_m FROM (
        SELECT *, row_number() OVER (PARTITION BY bez, lat, lon ORDER BY dist_m, x, y) AS rn FROM (
        SELECT p.bez, p.lat, p.lon, c.x, c.y, CASE WHEN p.lat IS NOT NULL THEN round(2 * 6371008.8 * asin(sqrt(least(1.0,
            power(sin(radians(c.lat_int / 100000.0 - p.lat) / 2), 2)
            + cos(radians(p.lat)) * cos(radians(c.lat_int / 100000.0))
            * power(sin(radians(c.lon_int / 100000.0 - p.lon) / 2), 2)))), 3) END AS dist_m
        FROM points p LEFT JOIN cell_coords c ON p.lat IS NOT NULL) d) r WHERE rn = 1""",
    "matches": """SELECT l.bez, s.element_nr, n.strassenname,
        contains(l.bez, n.strassenname) AND n.strassenname <> '' AS strname_match
        FROM located l LEFT JOIN cell_streets s ON l.x = s.stadt_x AND l.y = s.stadt_y
        LEFT JOIN street_names n ON s.element_nr = n.element_nr""",
    "scored": """SELECT e.event_id, e.user_id, concat('det_', CAST(e.user_id AS VARCHAR)) AS mq_name,
        e.event_type, CAST(e.ts AS TIMESTAMP) AS ts, e.value AS obs, u.pred
        FROM events e JOIN (SELECT user_id, avg(value) AS pred FROM events GROUP BY user_id) u
        ON e.user_id = u.user_id""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it needs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    body = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    if not body:
        return sql
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {body},\n{sql.lstrip()[5:]}"
    return f"WITH {body}\n{sql}"


def fraction(key: str, seed: int) -> str:
    """Hash of a row as a number in [0, 1)."""
    return f"{number(key, seed)} / 4294967296.0"


def number(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {key}, '{seed}')), 1, 8) AS BIGINT)"


def local(ts: str) -> str:
    return f"timezone('Europe/Berlin', timezone('UTC', {ts}))"


def utc(text: str) -> str:
    return f"timezone('UTC', timezone('Europe/Berlin', TIMESTAMP '{text}'))"


def parts(ts: str) -> str:
    """Local time parts of a UTC time."""
    return f"""CAST(isodow({local(ts)}) AS INTEGER) AS day_of_week,
        CAST(year({local(ts)}) AS INTEGER) AS year, CAST(hour({local(ts)}) AS INTEGER) AS hour,
        {local(ts)} - {ts} = INTERVAL 1 HOUR AS winter_time"""


CALENDAR_PART = """coalesce(k.type_school_holiday = 'Sommerferien', false) AS summer_holidays,
    coalesce(k.type_school_holiday <> 'Sommerferien', false) AS other_school_holidays,
    coalesce(k.is_public_holiday, 0) AS is_public_holiday, coalesce(k.doy_scaled, 0) AS day_of_year"""
CELL_PART = ", ".join(
    f"coalesce(f.{n}, 0) AS {n}"
    for n in [*STREET, *LAND, "traffic_volume", "building_density", "building_height"]
)

METRICS = """count(*) AS n, CAST(0 AS BIGINT) AS n_missing,
    round(sqrt(avg((obs - pred) * (obs - pred))), 6) AS rmse,
    round(1 - sum((obs - pred) * (obs - pred)) / (var_pop(obs) * count(*)), 6) AS r2,
    round(power(corr(obs, pred), 2), 6) AS r2_corr, round(avg(abs(obs - pred)), 6) AS mae"""


def frame(locations: str, where: str = "true") -> str:
    return f"""SELECT k.date_time, {parts("k.date_time")}, p.x, p.y, {CALENDAR_PART}, {CELL_PART}
        FROM ({locations}) p CROSS JOIN calendar k
        LEFT JOIN cell_table f ON p.cx = f.x AND p.cy = f.y WHERE {where}"""


SQL: dict[str, str] = {
    "calibration_factors": """SELECT x, y, round(kfz_per_24h, 6) AS kfz_per_24h,
        round(kfz_per_24h_pred, 6) AS kfz_per_24h_pred, round(scaling, 6) AS scaling FROM factors""",
    "apply_factors": """SELECT p.model_id, p.date_time, p.x, p.y, p.value,
        round(p.value * f.scaling / 2, 6) AS pred
        FROM preds_year p JOIN factors f ON p.x = f.x AND p.y = f.y""",
    "scaled_union": """SELECT p.date_time, p.x, p.y, round(p.value * f.scaling, 9) AS pred
        FROM preds_year p JOIN factors f ON p.x = f.x AND p.y = f.y WHERE p.model_id = 1
        UNION ALL SELECT p.date_time, p.x, p.y, round(p.value * f.kfz_per_24h, 9) AS pred
        FROM preds_year p JOIN factors f ON p.x = f.x AND p.y = f.y WHERE p.model_id = 2""",
    "factors_at_sensors": """SELECT DISTINCT m.det_x AS x, m.det_y AS y, round(f.scaling, 6) AS scaling
        FROM (SELECT x, y FROM obs UNION SELECT stadt_x + 1000, stadt_y FROM stations) o
        LEFT JOIN (SELECT DISTINCT x, y FROM obs) r ON o.x = r.x AND o.y = r.y
        LEFT JOIN sensor_map m ON r.x = m.det_x AND r.y = m.det_y
        LEFT JOIN factors f ON m.stadt_x = f.x AND m.stadt_y = f.y""",
    "time_parts": f"""SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS date_time,
        {parts("o_orderdate")}, CAST({local("o_orderdate")} AS DATE) AS local_date,
        strftime({local("o_orderdate")}, '%Y-%m-%d %H:%M:%S') AS text FROM orders""",
    "time_range": f"""SELECT o_orderkey,
        o_orderdate >= {utc("1998-01-01 00:00:00")} AND o_orderdate < {utc("1999-01-01 00:00:00")}
            AS in_year,
        o_orderdate >= {utc("1996-11-01 00:00:00")} AND o_orderdate <= {utc("1997-10-31 23:59:59")}
            AS in_closed,
        o_orderdate >= {utc("1997-01-01 00:00:00")} AND o_orderdate < {utc("1998-01-01 00:00:00")}
            AS in_half_open,
        o_orderdate >= {utc("1995-06-01 00:00:00")} AND o_orderdate <= {utc("1999-09-05 14:30:00")}
            AS in_since,
        o_orderdate >= {utc("1999-05-15 00:00:00")} AND o_orderdate <= {utc("1999-09-05 00:00:00")}
            AS in_around FROM orders""",
    "cell_features": "SELECT t.* FROM cell_table t JOIN cells c ON t.x = c.x AND t.y = c.y",
    "training_frame": f"""SELECT o.mq_name, o.date_time, {parts("o.date_time")}, o.q_kfz, o.v_kfz,
        o.x, o.y, {CALENDAR_PART}, {CELL_PART}
        FROM obs o LEFT JOIN calendar k ON k.date_time = o.date_time
        LEFT JOIN sensor_map m ON o.x = m.det_x AND o.y = m.det_y
        LEFT JOIN cell_table f ON m.stadt_x = f.x AND m.stadt_y = f.y""",
    "feature_frame": frame("SELECT x, y, x AS cx, y AS cy FROM cells"),
    "feature_frame_sensors": frame(
        "SELECT m.det_x AS x, m.det_y AS y, c.x AS cx, c.y AS cy FROM cells c "
        "JOIN sensor_map m ON c.x = m.stadt_x AND c.y = m.stadt_y",
        f"k.date_time >= {utc('2024-01-09 00:00:00')} AND k.date_time <= {utc('2024-05-01 00:00:00')}",
    ),
    "feature_frame_stations": frame(
        "SELECT stadt_x AS x, stadt_y AS y, stadt_x AS cx, stadt_y AS cy FROM stations",
        f"k.date_time >= {utc('2024-01-08 00:00:00')} AND k.date_time < {utc('2024-02-05 00:00:00')}",
    ),
    "incremental_scan": f"""SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type FROM events
        WHERE ts > (SELECT max(l_shipdate) FROM lineitem)
        AND ts <= {utc("2024-01-25 00:00:00")}""",
    "drop_sentinel": "SELECT event_id, mq_name, date_time, q_kfz FROM obs WHERE q_kfz <> -1",
    "hash_sample": f"""SELECT event_id, mq_name, date_time, q_kfz FROM obs
        WHERE {fraction("CAST(event_id AS VARCHAR)", 11)} < 0.1""",
    "sample_n": f"""SELECT event_id, mq_name, date_time, q_kfz FROM obs
        ORDER BY {number("CAST(event_id AS VARCHAR)", 5)}, event_id LIMIT 700""",
    "sample_fraction": f"""SELECT event_id, mq_name, date_time, q_kfz FROM (
        SELECT *, row_number() OVER (ORDER BY {number("CAST(event_id AS VARCHAR)", 3)}, event_id) AS rn,
        count(*) OVER () AS n FROM obs) s WHERE rn <= round_even(n * 0.02, 0)""",
    "avg_sensors_per_hour": """SELECT round(avg(n), 6) AS avg_sensors FROM
        (SELECT date_time, count(*) AS n FROM (SELECT DISTINCT date_time, x, y FROM obs) d
         GROUP BY date_time) h""",
    "temporal_split": """SELECT o_orderkey, CASE WHEN o_orderdate <=
        (SELECT max(o_orderdate) FROM orders) - INTERVAL 84 DAY THEN 'train' ELSE 'test' END AS split
        FROM orders""",
    "expanding_folds": "SELECT o_orderkey, "
    + ", ".join(
        f"""CASE WHEN o_orderdate <= m - INTERVAL {84 * (5 - i)} DAY THEN 'train'
        WHEN o_orderdate <= m - INTERVAL {84 * (4 - i)} DAY THEN 'test' ELSE 'unused' END AS fold_{i}"""
        for i in (1, 2, 3, 4)
    )
    + " FROM orders, (SELECT max(o_orderdate) AS m FROM orders) q",
    "expanding_folds_rows": """WITH pos AS (SELECT event_id, date_time, x, y, count(*) OVER () AS n,
        row_number() OVER (ORDER BY date_time, x, y, md5(CAST(event_id AS VARCHAR)), event_id) AS p
        FROM obs),
        b AS (SELECT CAST(round_even(avg(c), 0) AS BIGINT) * 168 AS b FROM (SELECT count(*) AS c FROM
            (SELECT DISTINCT date_time, x, y FROM obs) d GROUP BY date_time) h)
        SELECT event_id, date_time, x, y, """
    + ", ".join(
        f"""CASE WHEN n - 4 * b + {i} * (b + 1) < 1 OR {i} * (b + 1) > 3 * b THEN 'unused'
        WHEN p <= n - 4 * b + {i} * (b + 1) THEN 'train'
        WHEN p <= n - 4 * b + {i} * (b + 1) + b THEN 'test' ELSE 'unused' END AS fold_{i + 1}"""
        for i in (0, 1, 2)
    )
    + " FROM pos, b",
    "group_folds": f"""SELECT event_id, mq_name,
        CAST({number("mq_name", 42)} % 5 + 1 AS INTEGER) AS fold FROM obs""",
    "regression_metrics": f"SELECT {METRICS} FROM scored",
    "metrics_by_group": f"SELECT event_type, {METRICS} FROM scored GROUP BY event_type",
    "mean_metrics": f"""SELECT round(avg(rmse), 6) AS rmse, round(avg(r2), 6) AS r2,
        round(avg(mae), 6) AS mae FROM (SELECT sqrt(avg((obs - pred) * (obs - pred))) AS rmse,
        1 - sum((obs - pred) * (obs - pred)) / (var_pop(obs) * count(*)) AS r2,
        avg(abs(obs - pred)) AS mae FROM scored GROUP BY event_type) g""",
    "sensor_summary": """SELECT o.mq_name, round(avg(o.v_kfz), 9) AS pred, round(avg(o.q_kfz), 9) AS obs,
        round(max(f.scaling), 9) AS scaling FROM obs o
        LEFT JOIN sensor_map m ON o.x = m.det_x AND o.y = m.det_y
        LEFT JOIN factors f ON m.stadt_x = f.x AND m.stadt_y = f.y GROUP BY o.mq_name""",
    "sensor_correlation": """WITH s AS (SELECT floor(avg(v_kfz)) AS pred, avg(q_kfz) AS obs
        FROM obs GROUP BY mq_name),
        r AS (SELECT pred, obs,
        rank() OVER (ORDER BY pred) + (count(*) OVER (PARTITION BY pred) - 1) / 2.0 AS ra,
        rank() OVER (ORDER BY obs) + (count(*) OVER (PARTITION BY obs) - 1) / 2.0 AS rb FROM s)
        SELECT round(corr(pred, obs), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM r""",
    "residuals": """SELECT event_id, obs, round(pred, 9) AS pred, round(obs - pred, 9) AS resid
        FROM scored""",
    "distribution_table": """WITH lim AS (SELECT least(min(obs), min(pred)) AS low,
        greatest(max(obs), max(pred)) AS high FROM scored),
        v AS (SELECT event_type, 'obs' AS series, obs AS value FROM scored
              UNION ALL SELECT event_type, 'pred', pred FROM scored)
        SELECT event_type, series,
        CAST(least(floor((value - low) / ((high - low) / 30)), 29) AS INTEGER) AS bin, count(*) AS n,
        round(min(low) + CAST(least(floor((value - low) / ((high - low) / 30)), 29) AS INTEGER)
              * ((min(high) - min(low)) / 30), 6) AS bin_start
        FROM v, lim GROUP BY event_type, series,
        CAST(least(floor((value - low) / ((high - low) / 30)), 29) AS INTEGER),
        least(floor((value - low) / ((high - low) / 30)), 29)""",
    "nearest_cell": "SELECT bez, lat, lon, x, y, dist_m FROM located",
    "match_streets": "SELECT bez, element_nr, strassenname, strname_match FROM matches",
    "cells_of_streets": """SELECT m.element_nr, m.bez, s.stadt_x AS x, s.stadt_y AS y FROM matches m
        LEFT JOIN cell_streets s ON m.element_nr = s.element_nr WHERE m.strname_match""",
    "compare_at_points": """WITH rel AS (SELECT m.element_nr, m.bez, s.stadt_x AS x, s.stadt_y AS y
            FROM matches m LEFT JOIN cell_streets s ON m.element_nr = s.element_nr
            WHERE m.strname_match),
        sp AS (SELECT p.date_time, p.x, p.y, p.value * f.scaling AS pred
            FROM preds_year p JOIN factors f ON p.x = f.x AND p.y = f.y WHERE p.model_id = 1
            UNION ALL SELECT p.date_time, p.x, p.y, p.value * f.scaling
            FROM preds_year p JOIN factors f ON p.x = f.x AND p.y = f.y WHERE p.model_id = 2)
        SELECT sp.date_time, rel.element_nr, rel.bez, round(avg(sp.pred), 6) AS pred
        FROM sp LEFT JOIN rel ON sp.x = rel.x AND sp.y = rel.y
        WHERE (sp.x, sp.y) IN (SELECT (x, y) FROM rel)
        GROUP BY sp.date_time, rel.element_nr, rel.bez""",
}


# --- Models -----------------------------------------------------------------------------------
def fixed_model(first: str, second: str, third: str) -> str:
    """The fixed model's prediction, with its three tests as SQL conditions."""
    raw = f"""10.0 + CASE WHEN {first} THEN CASE WHEN {second} THEN 12.5 ELSE -30.25 END ELSE 4.0 END
        + CASE WHEN {third} THEN -3.5 ELSE 8.0 END"""
    return f"greatest(CAST({raw} AS DOUBLE), 0)"


PRICE_TESTS = ("l_quantity <= 24.5", "l_discount <= 0.045", "l_tax <= 0.035")
GRID_TESTS = ("hour <= 12", "x <= 4", "traffic_volume <= 900")
ROW = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate"
GRID_SCORE = f"""SELECT CAST(7 AS BIGINT) AS model_id, date_time, x, y,
    round_even({fixed_model(*GRID_TESTS)}, 0) AS value FROM ({SQL["feature_frame"]}) g"""

VIEWS["explained"] = f"""SELECT {ROW}, l_quantity, l_discount, l_tax,
    CAST((vq - v0 + vqd - vd) / 2 AS DOUBLE) AS shap_l_quantity,
    CAST((vd - v0 + vqd - vq) / 2 AS DOUBLE) AS shap_l_discount,
    CAST(CASE WHEN l_tax <= 0.035 THEN -3.5 ELSE 8.0 END - 2.25 AS DOUBLE) AS shap_l_tax,
    CAST(10.0 + v0 + 2.25 AS DOUBLE) AS shap_bias
    FROM (SELECT *, (40 * 12.5 + 20 * -30.25 + 40 * 4.0) / 100 AS v0,
      CASE WHEN l_quantity <= 24.5 THEN (40 * 12.5 + 20 * -30.25) / 60 ELSE 4.0 END AS vq,
      (60 * CASE WHEN l_discount <= 0.045 THEN 12.5 ELSE -30.25 END + 40 * 4.0) / 100 AS vd,
      CASE WHEN l_quantity > 24.5 THEN 4.0 WHEN l_discount <= 0.045 THEN 12.5 ELSE -30.25 END AS vqd
      FROM lineitem) g"""
VIEWS["nodes"] = """SELECT CASE l_linenumber WHEN 1 THEN 'land_water' WHEN 2 THEN 'str_class_I'
    WHEN 3 THEN 'building_height' WHEN 4 THEN 'summer_holidays' WHEN 5 THEN 'x' WHEN 6 THEN 'hour'
    END AS feature, l_quantity AS gain FROM lineitem"""
VIEWS["sums"] = """SELECT date_time, x, y, sum(value) AS value FROM preds_year
    GROUP BY date_time, x, y"""
VIEWS["daily"] = """SELECT model_id, date_time, x, y, max(value) AS value FROM preds_year
    GROUP BY model_id, date_time, x, y"""


def stump(n: int, residuals: str) -> str:
    """CTEs of one boosting round with depth 1 over a table (features, r): ``best{n}`` has the
    split and the sums of both sides."""
    names = ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, r FROM {residuals}" for f in names
    )
    return f"""long{n} AS ({long}),
        sums{n} AS (SELECT feature, v, count(*) AS n, sum(r) AS s FROM long{n} GROUP BY feature, v),
        cum{n} AS (SELECT feature, v, lead(v) OVER w AS nxt, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
            sum(n) OVER (PARTITION BY feature) AS nt, sum(s) OVER (PARTITION BY feature) AS st
            FROM sums{n} WINDOW w AS (PARTITION BY feature ORDER BY v)),
        best{n} AS (SELECT feature, (v + nxt) / 2 AS threshold, nl, sl, nt - nl AS nr, st - sl AS sr,
            nt, st FROM cum{n} WHERE nxt IS NOT NULL
            ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)"""


def stump_rows(n: int) -> str:
    """Node rows of round n with penalty 5000 and step 0.5."""
    def leaf(node, count, total):
        return f"""SELECT {n}, {node}, NULL, NULL, round(0.5 * {total} / ({count} + 5000), 6),
            CAST({count} AS DOUBLE), NULL FROM best{n}"""

    return f"""SELECT {n} AS tree, 0 AS node, feature, round(threshold, 6) AS threshold,
        round(0.5 * st / (nt + 5000), 6) AS weight, CAST(nt AS DOUBLE) AS cover,
        round((sl * sl / (nl + 5000) + sr * sr / (nr + 5000) - st * st / (nt + 5000)) / nt, 3) AS gain
        FROM best{n} UNION ALL {leaf(1, "nl", "sl")} UNION ALL {leaf(2, "nr", "sr")}"""


SQL |= {
    "fit_boosted": f"""WITH r1 AS (SELECT *, l_extendedprice - avg(l_extendedprice) OVER () AS r
        FROM lineitem), {stump(1, "r1")},
        r2 AS (SELECT r1.* EXCLUDE (r), r - CASE WHEN CASE b.feature WHEN 'l_quantity' THEN l_quantity
            WHEN 'l_discount' THEN l_discount WHEN 'l_tax' THEN l_tax ELSE l_linenumber END
            <= b.threshold THEN 0.5 * sl / (nl + 5000) ELSE 0.5 * sr / (nr + 5000) END AS r
            FROM r1, best1 b), {stump(2, "r2")}
        {stump_rows(1)} UNION ALL {stump_rows(2)}""",
    "predict": f"SELECT {ROW}, {fixed_model(*PRICE_TESTS)} AS pred FROM lineitem",
    "load_model": f"SELECT {ROW}, {fixed_model(*PRICE_TESTS)} AS pred FROM lineitem",
    "append": "SELECT * FROM sums UNION ALL SELECT date_time, x, y, value + 1 FROM sums",
    "compact": "SELECT date_time, x, y, value + 1 AS value FROM sums",
    "truncate": "SELECT * FROM sums",
    "snapshot": "SELECT * FROM obs",
    "score": GRID_SCORE,
    "score_backfill": GRID_SCORE,
    "score_backfill_repair": GRID_SCORE,
    "refresh_calibration": f"""WITH p AS (SELECT x, y, avg(value) * 24 AS pred FROM ({GRID_SCORE}) s
        WHERE date_time >= {utc("2024-01-08 00:00:00")} AND date_time < {utc("2024-01-22 00:00:00")}
        GROUP BY x, y)
        SELECT x, y, round(kfz_per_24h, 6) AS kfz_per_24h, round(pred, 6) AS kfz_per_24h_pred,
        round(CASE WHEN kfz_per_24h > 0 AND (pred = 0 OR kfz_per_24h / nullif(pred, 0) > 5) THEN 5
            WHEN kfz_per_24h <= 0.001 THEN 0 WHEN kfz_per_24h / nullif(pred, 0) < 0.1 THEN 0.1
            ELSE kfz_per_24h / nullif(pred, 0) END, 6) AS scaling FROM volume JOIN p USING (x, y)""",
    "prepare_predictions": """SELECT CAST(99 AS BIGINT) AS model_id, date_time, x, y,
        round_even(value / 4, 0) AS value FROM preds_year""",
    "chunk_keys": """SELECT CAST(ceil(rn / 4.0) AS INTEGER) AS chunk,
        string_agg(CAST(x AS VARCHAR), ', ' ORDER BY rn) AS keys
        FROM (SELECT x, row_number() OVER (ORDER BY x) AS rn FROM (SELECT DISTINCT x FROM cells) d) n
        GROUP BY 1""",
    "dedupe_latest": """SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
        o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey,
        o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) r WHERE rn = 1""",
    "upsert_latest": """SELECT coalesce(b.date_time, a.date_time) AS date_time,
        coalesce(b.x, a.x) AS x, coalesce(b.y, a.y) AS y, coalesce(b.value, a.value) AS value
        FROM (SELECT * FROM daily WHERE model_id = 1) a
        FULL JOIN (SELECT * FROM daily WHERE model_id = 2) b
        ON a.date_time = b.date_time AND a.x = b.x AND a.y = b.y""",
    "transfer_report": """SELECT 'traffic_model_scaling' AS "table", true AS ok, count(*) AS rows
        FROM factors UNION ALL SELECT 'traffic_models_final', false, NULL
        UNION ALL SELECT 'traffic_model_predictions_stations', true, count(*) FROM daily
        WHERE model_id = 1""",
    "transfer_tables": """SELECT model_id, date_time, x, y, value FROM daily WHERE model_id = 1
        UNION ALL SELECT 1, date_time, x, y, value + 1 FROM daily b WHERE model_id = 2 AND NOT EXISTS
        (SELECT 1 FROM daily a WHERE a.model_id = 1 AND a.date_time = b.date_time AND a.x = b.x
         AND a.y = b.y)""",
    "completeness_check": f"""WITH g AS ({GRID_SCORE}),
        parts AS (SELECT 'all' AS part, 0 AS slack, count(*) AS n FROM g
            UNION ALL SELECT 'a column less', 0, count(*) FROM g WHERE x <> 3
            UNION ALL SELECT 'an hour less', 0, count(*) FROM g
                WHERE date_time <> (SELECT min(date_time) FROM calendar)
            UNION ALL SELECT 'an hour less', 1, count(*) FROM g
                WHERE date_time <> (SELECT min(date_time) FROM calendar))
        SELECT part, CAST(slack AS INTEGER) AS slack, n, cells, hours,
            n = cells * hours OR (slack = 1 AND abs(n - cells * hours) = cells) AS all_preds_arrived
        FROM parts, (SELECT (SELECT count(*) FROM cells) AS cells,
            (SELECT count(*) FROM calendar) AS hours) q""",
    "resolve_model_id": """WITH m AS (SELECT o_orderkey + 1 AS model_id,
        CAST(o_orderdate AS TIMESTAMP) AS date_time, o_orderpriority AS model_name,
        concat_ws('/', o_orderstatus, CAST(o_custkey AS VARCHAR)) AS description FROM orders)
        SELECT min(model_id) OVER (PARTITION BY date_time, model_name, description) AS model_id,
        date_time, model_name, description FROM m
        UNION ALL SELECT max(model_id) + k, max(date_time), min(model_name), 'new ' || k
        FROM m, (VALUES (1), (2), (3)) v(k) GROUP BY k""",
    "describe_model": """SELECT CAST(NULL AS BIGINT) AS model_id, max(date_time) AS date_time,
        'trial' AS model_name, 'q_kfz' AS depvar, concat('{"hyperparams":{"nrounds":303,"max_depth":9,',
        '"eta":0.3048174,"gamma":1.588561,"colsample_bytree":0.8311579,"min_child_weight":1,',
        '"subsample":0.8877896},"model_formula":["~","q_kfz","x + y + hour"],"dates":{"train_start":"',
        strftime(min(date_time), '%Y-%m-%d %H:%M:%S'), '","train_end":"',
        strftime(max(date_time), '%Y-%m-%d %H:%M:%S'), '"}}') AS description FROM obs""",
    "set_final_model": """SELECT o_orderstatus AS depvar, max(o_orderkey) AS model_id FROM orders
        GROUP BY o_orderstatus""",
    "best_trial": """SELECT o_orderkey AS trial, o_orderpriority AS setting, o_totalprice AS rmse
        FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1""",
    "search_results": """SELECT o_orderpriority AS setting, o_orderkey AS trial, o_totalprice AS rmse
        FROM orders WHERE o_orderpriority = (SELECT o_orderpriority FROM orders
        ORDER BY o_totalprice, o_orderkey LIMIT 1)""",
    "feature_importance": """SELECT feature, round(sum(gain) / t, 6) AS importance,
        round(sum(gain) / t * 0.75, 6) AS rel_importance
        FROM nodes, (SELECT sum(gain) AS t FROM nodes WHERE feature IS NOT NULL) q
        WHERE feature IS NOT NULL GROUP BY feature, t""",
    "importance_by_group": """SELECT CASE feature WHEN 'land_water' THEN 'land_use'
        WHEN 'str_class_I' THEN 'street_class' WHEN 'building_height' THEN 'buildings'
        WHEN 'summer_holidays' THEN 'holidays' WHEN 'x' THEN 'coordinates' ELSE feature END
        AS feature_group, round(100 * sum(gain / t), 6) AS imp
        FROM nodes, (SELECT sum(gain) AS t FROM nodes WHERE feature IS NOT NULL) q
        WHERE feature IS NOT NULL GROUP BY 1""",
    "shap_contributions": f"""SELECT {ROW}, l_quantity, l_discount, l_tax,
        round(shap_l_quantity, 6) AS shap_l_quantity, round(shap_l_discount, 6) AS shap_l_discount,
        round(shap_l_tax, 6) AS shap_l_tax, round(shap_bias, 6) AS shap_bias FROM explained""",
    "shap_effects": """WITH long AS (SELECT 'l_quantity' AS feature, l_quantity AS value,
            shap_l_quantity AS c FROM explained UNION ALL SELECT 'l_discount', l_discount,
            shap_l_discount FROM explained UNION ALL SELECT 'l_tax', l_tax, shap_l_tax FROM explained),
        lim AS (SELECT feature, min(value) AS low, max(value) AS high FROM long GROUP BY feature)
        SELECT feature, CAST(least(floor((value - low) / ((high - low) / 5)), 4) AS INTEGER) AS bin,
        count(*) AS n, round(avg(value), 6) AS mean_value, round(avg(c), 6) AS mean_contribution
        FROM long JOIN lim USING (feature) GROUP BY 1, 2""",
}


# --- Search and validation ---------------------------------------------------------------------
SPLIT_VALUE = """CASE b.feature WHEN 'l_quantity' THEN l_quantity WHEN 'l_discount' THEN l_discount
    WHEN 'l_tax' THEN l_tax ELSE l_linenumber END"""


def residuals_of(n: int, where: str) -> str:
    """CTE of the rows that fit n is made on, with what the mean leaves of the price."""
    return f"""r{n} AS (SELECT l.*, avg(l_extendedprice) OVER () AS base,
        l_extendedprice - avg(l_extendedprice) OVER () AS r FROM lineitem l, latest WHERE {where})"""


def predicted(n: int, eta: str, penalty: str) -> str:
    """Prediction of fit n for a row beside ``best{n} b`` and its base."""
    return f"""greatest(base + CASE WHEN {SPLIT_VALUE} <= b.threshold THEN {eta} * sl / (nl + {penalty})
        ELSE {eta} * sr / (nr + {penalty}) END, 0)"""


LATEST = "latest AS (SELECT max(l_shipdate) AS m FROM lineitem)"
UNTIL_2, UNTIL_1 = "l_shipdate <= m - INTERVAL 728 DAY", "l_shipdate <= m - INTERVAL 364 DAY"
BASES = ", ".join(f"base{n} AS (SELECT any_value(base) AS base FROM r{n})" for n in (1, 2))
FOLD_ROWS = " UNION ALL ".join(
    f"""SELECT trial, {n} AS fold, l_extendedprice AS obs, {predicted(n, "eta", "1")} AS pred
        FROM lineitem, latest, grid, base{n}, best{n} b WHERE {test}"""
    for n, test in ((1, f"{UNTIL_1} AND NOT {UNTIL_2}"), (2, f"NOT {UNTIL_1}"))
)
SWEEP_METRICS = ", ".join(
    f"""round(max({expression}) FILTER (WHERE part = '{part}'), 6) AS {name}_{part}"""
    for name, expression in (("rmse", "rmse"), ("r2", "r2"), ("mae", "mae"))
    for part in ("is", "oos")
)
FOLD = number("CAST(l_suppkey AS VARCHAR)", 1) + " % 2 + 1"

SQL |= {
    "search": f"""WITH {LATEST}, {residuals_of(1, UNTIL_2)}, {stump(1, "r1")},
        {residuals_of(2, UNTIL_1)}, {stump(2, "r2")}, {BASES},
        grid AS (SELECT trial, 0.001 + {fraction("CAST(trial AS VARCHAR), 'eta'", 3)} * (0.6 - 0.001) AS eta,
            {fraction("CAST(trial AS VARCHAR), 'gamma'", 3)} * 10 AS gamma FROM range(1, 3) t(trial)),
        tested AS ({FOLD_ROWS}),
        folds AS (SELECT trial, fold, sqrt(avg(power(obs - pred, 2))) AS rmse,
            power(corr(obs, pred), 2) AS r2_corr, avg(abs(obs - pred)) AS mae
            FROM tested GROUP BY trial, fold)
        SELECT trial, CAST(1 AS INTEGER) AS nrounds, CAST(1 AS INTEGER) AS max_depth,
        round(any_value(eta), 6) AS eta, round(any_value(gamma), 6) AS gamma,
        CAST(1 AS DOUBLE) AS colsample_bytree, CAST(1 AS INTEGER) AS min_child_weight,
        CAST(1 AS DOUBLE) AS subsample, round(avg(rmse), 6) AS rmse, round(avg(r2_corr), 6) AS r2_corr,
        round(avg(mae), 6) AS mae FROM folds JOIN grid USING (trial) GROUP BY trial""",
    "lambda_sweep": f"""WITH {LATEST}, {residuals_of(1, UNTIL_1)}, {stump(1, "r1")},
        base1 AS (SELECT any_value(base) AS base FROM r1),
        p AS (SELECT penalty, CASE WHEN {UNTIL_1} THEN 'is' ELSE 'oos' END AS part,
            l_extendedprice AS obs, {predicted(1, "0.5", "penalty")} AS pred
            FROM lineitem, latest, base1, best1 b, (VALUES (5.0::DOUBLE), (5000.0)) q(penalty)),
        g AS (SELECT penalty, part, sqrt(avg(power(obs - pred, 2))) AS rmse, avg(abs(obs - pred)) AS mae,
            1 - sum(power(obs - pred, 2)) / (var_pop(obs) * count(*)) AS r2 FROM p GROUP BY penalty, part)
        SELECT penalty AS "lambda", {SWEEP_METRICS}
        FROM g GROUP BY penalty""",
    "spatial_cv": f"""WITH {LATEST}, {residuals_of(1, f"{FOLD} <> 1")}, {stump(1, "r1")},
        {residuals_of(2, f"{FOLD} <> 2")}, {stump(2, "r2")}, {BASES}
        """
    + " UNION ALL ".join(
        f"""SELECT {ROW}, CAST({n} AS INTEGER) AS fold, l_extendedprice,
        round({predicted(n, "0.5", "5")}, 6) AS pred
        FROM lineitem, base{n}, best{n} b WHERE {FOLD} = {n}"""
        for n in (1, 2)
    ),
}

# --- What the queries above leave out -----------------------------------------------------------
PREDICTOR_PART = ", ".join(
    ["x", "y", "year", "day_of_week", "day_of_year", "hour", "winter_time", "summer_holidays",
     "other_school_holidays", "is_public_holiday", *STREET, *LAND, "building_density", "building_height",
     "traffic_volume"]
)
POINT_ROWS = ", ".join(
    "({}::DOUBLE, {}::DOUBLE, '{}')".format(lat, lon, text.replace("'", "''")) for lat, lon, text in COUNTING_POINTS
)
VIEWS["moved"] = """SELECT date_time - INTERVAL 728 DAY AS date_time, type_school_holiday, is_public_holiday,
    doy_scaled FROM calendar"""
VIEWS["gappy"] = """SELECT date_time, x, y FROM preds_year WHERE x <> 3 UNION ALL
    SELECT date_time, x, y FROM preds_year WHERE x = 4"""
VIEWS["coverage"] = """SELECT c.x, c.y, coalesce(s.n_rows, 0) AS n_rows, coalesce(s.n_hours, 0) AS n_hours,
    q.n - coalesce(s.n_hours, 0) AS n_missing,
    (SELECT min(h.date_time) FROM (SELECT DISTINCT date_time FROM preds_year) h
     WHERE h.date_time NOT IN (SELECT g.date_time FROM gappy g WHERE g.x = c.x AND g.y = c.y)) AS first_missing
    FROM (SELECT DISTINCT x, y FROM cells) c CROSS JOIN (SELECT count(DISTINCT date_time) AS n FROM preds_year) q
    LEFT JOIN (SELECT x, y, count(*) AS n_rows, count(DISTINCT date_time) AS n_hours FROM gappy GROUP BY x, y) s
    ON c.x = s.x AND c.y = s.y"""

SQL |= {
    "predictor_frame": f"SELECT mq_name, date_time, q_kfz, {PREDICTOR_PART} FROM ({SQL['training_frame']}) t",
    "on_local_days": f"""SELECT event_id, date_time FROM obs
        WHERE CAST({local("date_time")} AS DATE) IN (DATE '2024-01-15', DATE '2024-01-16', DATE '1999-05-04')""",
    "counting_points": f"""SELECT lat, lon, bez, x, y, dist_m FROM (
        SELECT *, row_number() OVER (PARTITION BY bez, lat, lon ORDER BY dist_m, x, y) AS rn FROM (
        SELECT p.bez, p.lat, p.lon, c.x, c.y, round(2 * 6371008.8 * asin(sqrt(least(1.0,
            power(sin(radians(c.lat_int / 100000.0 - p.lat) / 2), 2)
            + cos(radians(p.lat)) * cos(radians(c.lat_int / 100000.0))
            * power(sin(radians(c.lon_int / 100000.0 - p.lon) / 2), 2)))), 3) AS dist_m
        FROM (VALUES {POINT_ROWS}) p(lat, lon, bez) CROSS JOIN cell_coords c) d) r WHERE rn = 1""",
    "feature_importance_top": """SELECT feature, round(sum(gain) / t, 6) AS importance,
        round(sum(gain) / t * 0.75, 6) AS rel_importance
        FROM (SELECT concat('f', CAST(l_partkey % 26 AS VARCHAR)) AS feature, l_quantity AS gain FROM lineitem) g,
        (SELECT sum(l_quantity) AS t FROM lineitem) q GROUP BY feature, t ORDER BY sum(gain) DESC, feature LIMIT 10""",
    "shap_effects_top": SQL["shap_effects"].replace(
        "lim AS (", "strong AS (SELECT feature FROM long GROUP BY feature ORDER BY avg(abs(c)) DESC, feature LIMIT 2), lim AS ("
    ).replace("FROM long JOIN lim USING (feature)", "FROM long JOIN lim USING (feature) JOIN strong USING (feature)"),
    "dry_run": "SELECT * FROM sums",
    "stored_results": f"""SELECT *, 'first' AS run_id FROM ({SQL["metrics_by_group"]}) a
        UNION ALL SELECT *, 'second' AS run_id FROM ({SQL["metrics_by_group"]}) b""",
    "score_passive_samplers": f"""SELECT CAST(7 AS BIGINT) AS model_id, date_time, x, y,
        round_even({fixed_model(*GRID_TESTS)}, 0) AS value FROM ({SQL["feature_frame_stations"].split(" WHERE ")[0]
        .replace("calendar k", "moved k")} WHERE k.date_time >= {utc("2022-01-01 00:00:00")}
        AND k.date_time < {utc("2023-01-01 00:00:00")}) g""",
    "prepare_without_id": "SELECT date_time, x, y, round_even(value, 0) AS value FROM preds_year WHERE model_id = 1",
    "hour_coverage": "SELECT * FROM coverage",
    "hours_covered": """SELECT count(*) AS cells, count(*) FILTER (WHERE n_missing > 0) AS cells_with_gaps,
        CAST(sum(n_missing) AS BIGINT) AS n_missing, CAST(sum(n_rows - n_hours) AS BIGINT) AS n_extra,
        sum(n_missing) = 0 AS all_preds_arrived FROM coverage""",
}
