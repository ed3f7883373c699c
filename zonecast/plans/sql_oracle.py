"""DuckDB SQL fragments used as independent oracles for the query catalogue.

Each registered query has a plain-SQL twin that DuckDB runs over the same
parquet views.  The fragments here are shared CTEs (trip view, cleaning,
hourly panel, grid, holiday calendar) written directly in SQL.
"""

from __future__ import annotations

from zonecast.functions.holidays import FEDERAL_RULES, JUNETEENTH_FIRST_YEAR, STATE_EXTRA_RULES

# The zone universe of the events view: any positive 32-bit id, so the whole
# table is kept except the invalid id 0 (and drop-off key 0).
NUM_ZONES = 2_147_483_647

_ISODOW = {"Mon": 1, "Tue": 2, "Wed": 3, "Thu": 4, "Fri": 5, "Sat": 6, "Sun": 7}


def trips_cte() -> str:
    return (
        "trips AS (SELECT ts AS pickup_datetime, user_id AS PULocationID, "
        "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOLocationID FROM events)"
    )


def clean_cte(n: int = NUM_ZONES) -> str:
    return (
        "clean AS (SELECT * FROM trips WHERE pickup_datetime IS NOT NULL "
        "AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL "
        f"AND PULocationID BETWEEN 1 AND {n} AND DOLocationID BETWEEN 1 AND {n})"
    )


def hourly_cte(src: str = "clean") -> str:
    return (
        "hourly AS (SELECT PULocationID AS zone_id, date_trunc('hour', pickup_datetime) AS hour, "
        f"count(*) AS demand FROM {src} GROUP BY 1, 2)"
    )


def grid_cte(src: str = "hourly", out: str = "filled", step: str = "1 HOUR",
             key: str = "zone_id", time: str = "hour", value: str = "demand") -> str:
    return (
        f"{out}_bounds AS (SELECT min({time}) AS lo, max({time}) AS hi FROM {src}), "
        f"{out}_keys AS (SELECT DISTINCT {key} FROM {src}), "
        f"{out}_grid AS (SELECT {key}, unnest(generate_series(lo, hi, INTERVAL {step})) AS {time} "
        f"FROM {out}_keys, {out}_bounds), "
        f"{out} AS MATERIALIZED (SELECT g.{key}, g.{time}, CAST(coalesce(s.{value}, 0) AS BIGINT) AS {value} "
        f"FROM {out}_grid g LEFT JOIN {src} s ON g.{key} = s.{key} AND g.{time} = s.{time})"
    )


def base_ctes(grid: bool = False) -> str:
    parts = [trips_cte(), clean_cte(), hourly_cte()]
    if grid:
        parts.append(grid_cte())
    return "WITH " + ", ".join(parts)


def _nth_sql(month: int, n: int, dow: str) -> str:
    t = _ISODOW[dow]
    if n == -1:
        last = f"last_day(make_date(y, {month}, 1))"
        return f"CAST({last} - CAST((isodow({last}) - {t} + 7) % 7 AS INTEGER) AS DATE)"
    first = f"make_date(y, {month}, 1)"
    return f"CAST({first} + CAST((({t} - isodow({first}) + 7) % 7) + 7 * {n - 1} AS INTEGER) AS DATE)"


def _observed_sql(d: str) -> str:
    return (f"CAST(CASE isodow({d}) WHEN 6 THEN {d} - 1 WHEN 7 THEN {d} + 1 ELSE {d} END AS DATE)")


EVENT_YEARS = "SELECT min(year(ts)) AS lo, max(year(ts)) AS hi FROM events"
SHIP_YEARS = "SELECT min(year(l_shipdate)) AS lo, max(year(l_shipdate)) AS hi FROM lineitem"


def holidays_cte(calendar: str = "federal", name: str = "holidays", span_sql: str = EVENT_YEARS) -> str:
    """Observed holidays in the calendar years ``lo..hi`` of ``span_sql``."""
    rules = FEDERAL_RULES + (STATE_EXTRA_RULES if calendar == "state" else [])
    selects = []
    for hname, month, rule, arg in rules:
        if rule == "fixed":
            d = _observed_sql(f"make_date(y, {month}, {arg})")
        elif rule == "fixed_raw":
            d = f"make_date(y, {month}, {arg})"
        elif rule == "nth":
            d = _nth_sql(month, *arg)
        else:  # first Tuesday after the first Monday
            d = f"CAST({_nth_sql(month, 1, 'Mon')} + 1 AS DATE)"
        cond = f" WHERE y >= {JUNETEENTH_FIRST_YEAR}" if hname == "Juneteenth" else ""
        esc = hname.replace("'", "''")
        selects.append(f"SELECT {d} AS holiday_date, '{esc}' AS name FROM {name}_years{cond}")
    return (f"{name}_span AS ({span_sql}), {name}_years AS (SELECT CAST(unnest(generate_series(lo, hi + 1)) AS INTEGER) AS y "
            f"FROM {name}_span), {name} AS (SELECT h.* FROM ({' UNION ALL '.join(selects)}) h, {name}_span "
            "WHERE year(holiday_date) BETWEEN lo AND hi)")
