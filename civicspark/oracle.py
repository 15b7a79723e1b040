"""Independent SQL (DuckDB dialect) for every registered query.

Each statement starts from the driver tables, rebuilds ``requests_raw`` and
the stage it needs with plain SQL, and selects the same columns (same names
and types) as the Spark query of the same name. Reports are computed from the
clean table on its own columns, and the fact is compared by what its keys lead
back to, so a wrong surrogate key shows. Ties at a LIMIT are broken
by name in both, and rounding uses ``ROUND(x, 2)``, whose binary half-away
rounding the Spark side reproduces.
"""

from __future__ import annotations

from civicspark.schema import (
    BOROUGH_MAP,
    NULL_THRESHOLDS,
    RAW_COLUMNS,
    REQUIRED_COLUMNS,
    VALID_BOROUGHS,
)

# Parameters shared with the Spark side (queries.py).
DATE_RANGE = ("1997-01-01", "1998-12-31")
PAGE = (2000, 1000)  # offset, page size
TOTAL_LIMIT = 5000
PAGED_LIMIT = 2500  # pages of PAGE[1] rows: two full pages and a shrunk last one
SOURCE_PAGES = (250, 4, 3, 600)  # page size, number of the empty page, of the short page, total limit
SHORT_PAGE = 40  # records on the short page
RERUN_MONTH = ("1996-02-01", "1996-02-29")
BATCH_RANGE = ("1995-01-01", "2001-12-31")
NAN_THRESHOLDS = {"latitude": 0.01, "longitude": 0.01}

_TS_RE = r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?)?"
_NUM_RE = r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*"
_RAW = ", ".join(RAW_COLUMNS)


def _ts(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{_TS_RE}') THEN TRY_CAST({c} AS TIMESTAMP) END"


def _num(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{_NUM_RE}') THEN TRY_CAST({c} AS DOUBLE) END"


_BOROUGH_CASE = (
    "CASE upper(borough) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BOROUGH_MAP.items())
    + " ELSE 'UNKNOWN' END"
)


def _median(col: str, table: str) -> str:
    """Mean of the middle one or two non-null values."""
    return (
        f"(SELECT (min(v) + max(v)) / 2 FROM (SELECT {col} AS v, "
        f"row_number() OVER (ORDER BY {col}) - 1 AS r, count(*) OVER () AS n "
        f"FROM {table} WHERE {col} IS NOT NULL) WHERE r IN ((n - 1) // 2, n // 2))"
    )


def _mode(col: str, table: str) -> str:
    return f"(SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"


# name -> (dependencies, body)
_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], body: str) -> None:
    _CTES[name] = (deps, body)


_cte("first_line", [], "SELECT l_orderkey, min(l_shipdate) AS ship, min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey")
_cte("raw_once", ["first_line"], """
    SELECT o.o_orderkey AS k,
      CASE WHEN o.o_orderkey % 997 = 0 THEN NULL ELSE CAST(o.o_orderkey AS VARCHAR) END AS unique_key,
      CASE WHEN o.o_orderkey % 41 <> 0
        THEN concat_ws(' ', p.p_type, CAST(CAST(floor(sqrt(p.p_size)) AS INTEGER) AS VARCHAR)) END AS complaint_type,
      CASE r.r_name WHEN 'AFRICA' THEN 'bx' WHEN 'AMERICA' THEN 'Kings' WHEN 'ASIA' THEN 'MN'
        WHEN 'EUROPE' THEN 'QUEENS' ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'Richmond' ELSE 'Unspecified' END
      END AS borough,
      CASE WHEN o.o_orderkey % 101 = 0 THEN 'invalid' ELSE strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS created_date,
      strftime(fl.ship, '%Y-%m-%dT%H:%M:%S') AS closed_date,
      CASE WHEN o.o_orderkey % 53 = 0 THEN '' WHEN o.o_orderkey % 59 = 0 THEN NULL
        WHEN o.o_orderkey % 3 = 0 THEN 'DESK ' || lpad(CAST((o.o_orderkey // 3) % 20 AS VARCHAR), 2, '0')
        ELSE c.c_mktsegment END AS agency,
      CASE WHEN o.o_orderkey % 61 = 0 THEN NULL ELSE p.p_brand END AS descriptor,
      CASE WHEN o.o_orderkey % 37 = 0 THEN NULL ELSE CAST(10000 + n.n_nationkey AS VARCHAR) END AS incident_zip,
      CASE WHEN o.o_orderkey % 71 = 0 THEN '39.9' WHEN o.o_orderkey % 73 = 0 THEN 'n/a'
        ELSE '40.' || lpad(CAST(o.o_custkey % 1000 AS VARCHAR), 3, '0') END AS latitude,
      CASE WHEN o.o_orderkey % 79 = 0 THEN '-72.5'
        ELSE '-73.' || lpad(CAST(o.o_custkey % 1000 AS VARCHAR), 3, '0') END AS longitude
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN first_line fl ON fl.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON p.p_partkey = fl.pk""")
# Every order once, plus a second exact copy of every 11th order (the fixture's
# duplicates); the modulo rules above and here inject dirt, they drop nothing.
_cte("requests_raw", ["raw_once"], f"SELECT {_RAW} FROM raw_once UNION ALL SELECT {_RAW} FROM raw_once WHERE k % 11 = 0")


def _register_chain(p: str, source: str) -> None:
    """Cleaning, star and fact CTEs over ``source``, every name prefixed by ``p``."""
    _cte(f"{p}s_selected", [source], f"SELECT {_RAW} FROM {source}")
    _cte(f"{p}s_dates", [f"{p}s_selected"],
         f"SELECT * REPLACE ({_ts('created_date')} AS created_date, {_ts('closed_date')} AS closed_date) "
         f"FROM {p}s_selected")
    _cte(f"{p}s_coords", [f"{p}s_dates"], f"""
        SELECT * EXCLUDE (lat, lon) REPLACE (
          CASE WHEN lat BETWEEN 40.0 AND 41.0 THEN lat END AS latitude,
          CASE WHEN lon BETWEEN -75.0 AND -73.0 THEN lon END AS longitude)
        FROM (SELECT *, {_num('latitude')} AS lat, {_num('longitude')} AS lon FROM {p}s_dates)""")
    _cte(f"{p}s_borough", [f"{p}s_coords"], f"SELECT * REPLACE ({_BOROUGH_CASE} AS borough) FROM {p}s_coords")
    _cte(f"{p}s_repaired", [f"{p}s_borough"], f"""
        SELECT * REPLACE (CASE WHEN created_date IS NOT NULL AND closed_date IS NOT NULL
          AND closed_date < created_date THEN NULL ELSE closed_date END AS closed_date) FROM {p}s_borough""")
    _cte(f"{p}s_hours", [f"{p}s_repaired"], f"""
        SELECT *, date_diff('microsecond', created_date, closed_date) / 1e6 / 3600.0 AS response_time_hours
        FROM {p}s_repaired""")
    st = f"{p}stage"
    _cte(st, [f"{p}s_hours"], f"SELECT * FROM {p}s_hours WHERE unique_key IS NOT NULL")
    medians = (
        f"coalesce(latitude, {_median('latitude', st)}) AS latitude, "
        f"coalesce(longitude, {_median('longitude', st)}) AS longitude, "
        f"coalesce(response_time_hours, {_median('response_time_hours', st)}) AS response_time_hours"
    )
    unknowns = ", ".join(f"coalesce({c}, 'UNKNOWN') AS {c}" for c in ["complaint_type", "borough", "agency", "descriptor"])
    mode = f"coalesce(incident_zip, {_mode('incident_zip', st)}) AS incident_zip"
    _cte(f"{p}s_median", [st], f"SELECT * REPLACE ({medians}) FROM {st}")
    _cte(f"{p}s_unknown", [st], f"SELECT * REPLACE ({unknowns}) FROM {st}")
    _cte(f"{p}s_mode", [st], f"SELECT * REPLACE ({mode}) FROM {st}")
    _cte(f"{p}clean", [st], f"SELECT DISTINCT * FROM (SELECT * REPLACE ({medians}, {unknowns}, {mode}) FROM {st})")
    _register_star(p, f"{p}clean")


# What a fact row finds in each dimension, on the row's own columns: an agency
# or type that is not empty, a descriptor that is known, a known borough and zip.
_HAS_AGENCY = "coalesce(agency, '') <> ''"
_HAS_COMPLAINT = "coalesce(complaint_type, '') <> '' AND descriptor IS NOT NULL"
_HAS_LOCATION = "borough IS NOT NULL AND incident_zip IS NOT NULL"


def _ids(name: str, columns: list[str], table: str, where: str = "true") -> str:
    """Distinct values numbered in their order, nulls last."""
    order = ", ".join(f"{c} NULLS LAST" for c in columns)
    return f"SELECT DISTINCT dense_rank() OVER (ORDER BY {order}) AS {name}, {', '.join(columns)} FROM {table} WHERE {where}"


def _register_star(p: str, c: str) -> None:
    """Dimension CTEs over the table ``c``, and its rows as the fact's keys must lead back to them."""
    _cte(f"{p}dim_agency", [c], _ids("agency_id", ["agency"], c, _HAS_AGENCY))
    _cte(f"{p}dim_complaint", [c], _ids("complaint_id", ["complaint_type", "descriptor"], c, "coalesce(complaint_type, '') <> ''"))
    _cte(f"{p}dim_location", [c], _ids("location_id", ["borough", "incident_zip", "latitude", "longitude"], c))
    _cte(f"{p}dim_date", [c], f"""
        SELECT DISTINCT CAST(created_date AS DATE) AS date, year(created_date) AS year, month(created_date) AS month,
          day(created_date) AS day, dayofweek(created_date) AS day_of_week
        FROM {c} WHERE created_date IS NOT NULL""")
    _cte(f"{p}fact", [c], f"""
        SELECT unique_key, created_date, closed_date, response_time_hours,
          CASE WHEN {_HAS_AGENCY} THEN agency END AS agency,
          CASE WHEN {_HAS_COMPLAINT} THEN complaint_type END AS complaint_type,
          CASE WHEN {_HAS_COMPLAINT} THEN descriptor END AS descriptor,
          CASE WHEN {_HAS_LOCATION} THEN borough END AS borough,
          CASE WHEN {_HAS_LOCATION} THEN incident_zip END AS incident_zip,
          CASE WHEN {_HAS_LOCATION} THEN latitude END AS latitude,
          CASE WHEN {_HAS_LOCATION} THEN longitude END AS longitude
        FROM {c}""")


def _reports(p: str) -> dict[str, str]:
    """The six reports from the clean table itself: no keys, no fact, no dimension."""
    c = f"{p}clean"

    def top(what: str, has: str, k: int) -> str:
        return f"""
            SELECT {what}, count(*) AS n_requests FROM {c} WHERE {has}
            GROUP BY {what} ORDER BY n_requests DESC, {what} LIMIT {k}"""

    def share(condition: str, name: str) -> str:
        return f"round(100.0 * avg(CASE WHEN {condition} THEN 0.0 ELSE 1.0 END), 2) AS {name}"

    return {
        "avg_response_time_by_borough": f"""
            SELECT borough, round(avg(response_time_hours), 2) AS avg_hours, count(*) AS n_requests
            FROM {c} WHERE response_time_hours >= 0 AND {_HAS_LOCATION} GROUP BY borough""",
        "top_20_complaint_types": top("complaint_type", _HAS_COMPLAINT, 20),
        "top_agencies_by_volume": top("agency", _HAS_AGENCY, 15),
        "monthly_volume_trend": f"""
            SELECT year(created_date) AS year, month(created_date) AS month, count(*) AS n_requests
            FROM {c} WHERE created_date IS NOT NULL GROUP BY 1, 2""",
        "slowest_complaints_by_avg_time": f"""
            SELECT complaint_type, round(avg(response_time_hours), 2) AS avg_hours, count(*) AS n_requests
            FROM {c} WHERE response_time_hours >= 0 AND {_HAS_COMPLAINT}
            GROUP BY complaint_type HAVING count(*) >= 100
            ORDER BY avg_hours DESC, complaint_type LIMIT 20""",
        "data_quality_null_rates": f"""
            SELECT {share("created_date IS NOT NULL", "pct_created_null")},
              {share(_HAS_COMPLAINT, "pct_complaint_fk_null")},
              {share(_HAS_AGENCY, "pct_agency_fk_null")},
              {share(_HAS_LOCATION, "pct_location_fk_null")}
            FROM {c}""",
    }


def _report_lines(p: str) -> str:
    """All six reports in one table: what a line is about, its number of requests and its figure."""
    r = _reports(p)

    def line(name: str, label: str, n: str, value: str) -> str:
        return f"SELECT '{name}' AS report, {label} AS label, CAST({n} AS BIGINT) AS n_requests, CAST({value} AS DOUBLE) AS value FROM ({r[name]})"

    parts = [
        line("avg_response_time_by_borough", "borough", "n_requests", "avg_hours"),
        line("top_20_complaint_types", "complaint_type", "n_requests", "NULL"),
        line("top_agencies_by_volume", "agency", "n_requests", "NULL"),
        line("monthly_volume_trend", "year || '-' || month", "n_requests", "NULL"),
        line("slowest_complaints_by_avg_time", "complaint_type", "n_requests", "avg_hours"),
    ]
    pcts = ["pct_created_null", "pct_complaint_fk_null", "pct_agency_fk_null", "pct_location_fk_null"]
    parts += [line("data_quality_null_rates", f"'{c}'", "NULL", c) for c in pcts]
    return " UNION ALL ".join(parts)


_register_chain("", "requests_raw")
_register_star("u_", "stage")
_cte("b_raw", ["requests_raw"], f"""
    SELECT * FROM requests_raw WHERE {_ts('created_date')} >= TIMESTAMP '{BATCH_RANGE[0]} 00:00:00'
      AND {_ts('created_date')} <= TIMESTAMP '{BATCH_RANGE[1]} 23:59:59'""")
_register_chain("b_", "b_raw")


def _with(names: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order)


def _q(needs: list[str], body: str) -> str:
    return f"{_with(needs)}\n{body}"


def _check_row(seq: int, name: str, subject: str | None, observed: str, threshold: float | None, passed: str) -> str:
    subj = "NULL::VARCHAR" if subject is None else f"'{subject}'"
    thr = "NULL::DOUBLE" if threshold is None else f"{float(threshold)!r}::DOUBLE"
    return (
        f"SELECT {seq}::BIGINT AS seq, '{name}' AS check_name, {subj} AS subject, "
        f"CAST({observed} AS DOUBLE) AS observed, {thr} AS threshold, {passed} AS passed"
    )


def _null_rates(table: str, thresholds: dict[str, float], missing: str = "{} IS NULL") -> str:
    parts = []
    for col, limit in thresholds.items():
        rate = f"(count(*) FILTER (WHERE {missing.format(col)}))::DOUBLE / nullif(count(*), 0)"
        passed = f"coalesce(NOT ({rate} > {float(limit)!r}), true)"
        parts.append(_check_row(4, "null_rate", col, rate, limit, passed) + f" FROM {table}")
    return " UNION ALL ".join(parts)


def _checks(table: str) -> dict[str, str]:
    rows_count = _check_row(1, "row_count", None, "count(*)", 1, "count(*) >= 1") + f" FROM {table}"
    req_values = ", ".join(f"({i}, '{c}')" for i, c in enumerate(REQUIRED_COLUMNS))
    required = (
        "SELECT 2::BIGINT AS seq, 'required_column' AS check_name, req.col AS subject, "
        "CASE WHEN p.column_name IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS observed, 1.0::DOUBLE AS threshold, "
        "p.column_name IS NOT NULL AS passed "
        f"FROM (VALUES {req_values}) req(ord, col) "
        f"LEFT JOIN (SELECT column_name FROM (DESCRIBE SELECT * FROM {table})) p ON p.column_name = req.col"
    )
    dup = (
        _check_row(3, "unique_key", "unique_key", "d", 0.0, "d = 0")
        + " FROM (SELECT coalesce(sum(cnt - 1), 0) AS d FROM "
        f"(SELECT unique_key, count(*) AS cnt FROM {table} GROUP BY unique_key))"
    )
    nulls = _null_rates(table, NULL_THRESHOLDS)
    dates = (
        _check_row(5, "date_logic", "closed_date", "bad", 0.0, "bad = 0")
        + f" FROM (SELECT count(*) FILTER (WHERE closed_date < created_date) AS bad FROM {table})"
    )
    allowed = ", ".join(f"'{b}'" for b in sorted(VALID_BOROUGHS))
    boroughs = (
        _check_row(6, "borough_values", "borough", "bad", 0.0, "bad = 0")
        + f" FROM (SELECT count(*) AS bad FROM {table} "
        f"WHERE borough IS NOT NULL AND borough NOT IN ({allowed}))"
    )
    return {
        "check_row_count": rows_count,
        "check_required_columns": required,
        "check_unique_key": dup,
        "check_null_rates": nulls,
        "check_date_logic": dates,
        "check_borough_values": boroughs,
        "quality_report": " UNION ALL ".join([rows_count, required, dup, nulls, dates, boroughs]),
    }


def _newest_first_order() -> str:
    rest = [c for c in RAW_COLUMNS if c != "unique_key"]
    return ", ".join(
        [f"{_ts('created_date')} DESC NULLS LAST", "unique_key ASC NULLS LAST"] + [f"{c} ASC NULLS LAST" for c in rest]
    )


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["requests_raw"] = _q(["requests_raw"], "SELECT * FROM requests_raw")
    stage_cte = {
        "select_required": "s_selected",
        "drop_empty_columns": "s_selected",
        "rename_columns": "s_selected",
        "parse_dates": "s_dates",
        "parse_coordinates": "s_coords",
        "standardize_borough": "s_borough",
        "repair_dates": "s_repaired",
        "response_time": "s_hours",
        "drop_null_keys": "stage",
        "impute_median": "s_median",
        "impute_unknown": "s_unknown",
        "impute_mode": "s_mode",
        "dedup_rows": "clean",
        "clean_requests": "clean",
    }
    for name, cte in stage_cte.items():
        q[name] = _q([cte], f"SELECT * FROM {cte}")
    q["column_medians"] = _q(
        ["stage"],
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {_median(c, 'stage')} AS median"
            for c in ["latitude", "longitude", "response_time_hours"]
        ),
    )
    q["column_modes"] = _q(["stage"], f"SELECT 'incident_zip' AS column_name, {_mode('incident_zip', 'stage')} AS mode")
    q["raw_key_duplicates"] = _q(
        ["requests_raw"],
        "SELECT coalesce(sum(cnt - 1), 0)::BIGINT AS n_duplicates FROM "
        "(SELECT unique_key, count(*) AS cnt FROM requests_raw GROUP BY unique_key)",
    )
    q["median_two_peaks"] = (
        "WITH peaks AS (SELECT CASE WHEN o_orderkey % 20 < 10 THEN 0.0::DOUBLE WHEN o_orderkey % 20 < 19 THEN 10.0::DOUBLE "
        "ELSE (o_orderkey % 997)::DOUBLE / 100 END AS x FROM orders) "
        f"SELECT 'x' AS column_name, {_median('x', 'peaks')} AS median"
    )
    dims = ["dim_agency", "dim_complaint", "dim_location", "dim_date"]
    for dim in dims:
        q[dim] = _q([dim], f"SELECT * FROM {dim}")
    q["fact_requests"] = _q(["fact"], "SELECT * FROM fact")
    q["fact_unimputed"] = _q(["u_fact"], "SELECT * FROM u_fact")
    star = [*((d, d) for d in dims), ("fact_311_requests", "fact")]
    q["star_row_counts"] = _q(
        [*dims, "fact"], " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {src}" for t, src in star)
    )
    for name, body in _reports("").items():
        q[name] = _q(["clean"], body)
    q["reports_csv"] = _q(["clean"], _report_lines(""))
    for name, body in _checks("clean").items():
        q[name] = _q(["clean"], body)
    q["quality_report_untreated"] = _q(["s_dates"], _checks("s_dates")["quality_report"])
    q["null_rates_nan"] = _q(["requests_raw"], _null_rates("requests_raw", NAN_THRESHOLDS, "TRY_CAST({} AS DOUBLE) IS NULL"))
    allowed = ", ".join(f"'{b}'" for b in sorted(VALID_BOROUGHS))
    q["unexpected_boroughs"] = _q(
        ["requests_raw"], f"SELECT borough, count(*) AS n_rows FROM requests_raw WHERE borough NOT IN ({allowed}) GROUP BY borough"
    )
    q["parse_dates_layouts"] = q["parse_dates"]
    q["fact_colocated"] = q["fact_requests"]
    # Even days of creation are in another layout: the one with more rows is read, ties go to the ISO layout.
    q["parse_dates_inferred"] = _q(
        ["s_dates", "s_selected"],
        "SELECT * REPLACE (CASE WHEN (day(created_date) % 2 = 0) = (SELECT count(*) FILTER (WHERE day(created_date) % 2 = 0) > "
        "count(*) FILTER (WHERE day(created_date) % 2 = 1) FROM s_dates) THEN created_date END AS created_date) FROM s_dates",
    )
    q["clean_nan_source"] = q["clean_requests"]

    lo, hi = DATE_RANGE
    q["date_range_filter"] = _q(
        ["requests_raw"],
        f"SELECT * FROM requests_raw WHERE {_ts('created_date')} >= TIMESTAMP '{lo} 00:00:00' "
        f"AND {_ts('created_date')} <= TIMESTAMP '{hi} 23:59:59'",
    )
    off, size = PAGE
    order = _newest_first_order()
    q["page_slice"] = _q(["requests_raw"], f"SELECT * FROM requests_raw ORDER BY {order} LIMIT {size} OFFSET {off}")
    q["total_limit"] = _q(["requests_raw"], f"SELECT * FROM requests_raw ORDER BY {order} LIMIT {TOTAL_LIMIT}")
    q["paged_read"] = _q(["requests_raw"], f"SELECT * FROM requests_raw ORDER BY {order} LIMIT {PAGED_LIMIT}")
    size, empty, short, limit = SOURCE_PAGES
    sources = {"empty page": size * empty, "short page": size * short + SHORT_PAGE, "limit": limit}
    q["page_source"] = _q(
        ["requests_raw"],
        " UNION ALL ".join(f"(SELECT '{name}' AS source, * FROM requests_raw ORDER BY {order} LIMIT {n})" for name, n in sources.items()),
    )
    key = "coalesce(TRY_CAST(unique_key AS BIGINT), 0)"
    point = " || ',' || ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in ("latitude", "longitude"))
    q["read_pages_union"] = _q(
        ["requests_raw"],
        f"SELECT *, CASE WHEN {key} % 2 = 0 THEN 'Closed' WHEN {key} % 5 = 0 THEN 'Open' END AS status, "
        "CASE WHEN borough = 'MN' THEN 'NEW YORK' END AS city, "
        f"CASE WHEN {key} % 7 = 0 THEN '{{\"boroughs\":[\"' || borough || '\"],' || {point} || '}}' END AS location, "
        f"CASE WHEN {key} % 11 = 0 THEN 'it''s `odd`' END AS \"Agency's name\" FROM requests_raw",
    )
    q["read_pages"] = _q(["requests_raw"], "SELECT * FROM requests_raw")
    q["round_trip_csv"] = _q(
        ["requests_raw"], "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS) + " FROM requests_raw"
    )
    q["csv_reordered_header"] = q["round_trip_csv"]
    cols = [f"nullif({c}, '') AS {c}" if c != "descriptor" else "descriptor || chr(10) || 'second line' AS descriptor" for c in RAW_COLUMNS]
    q["csv_multiline"] = _q(["requests_raw"], f"SELECT {', '.join(cols)} FROM requests_raw")
    for name in ["hive_scan", "nested_scan", "round_trip_parquet", "round_trip_table"]:
        q[name] = _q(["clean"], "SELECT * FROM clean")

    versions = {"first": "WHERE borough = 'BRONX'", "after an unfinished write": "WHERE borough = 'BRONX'", "catalog": ""}
    q["snapshot_versions"] = _q(["clean"], " UNION ALL ".join(f"SELECT '{v}' AS version, * FROM clean {w}" for v, w in versions.items()))

    def within(lo: str, hi: str) -> str:
        return f"created_date >= TIMESTAMP '{lo} 00:00:00' AND created_date <= TIMESTAMP '{hi} 23:59:59'"

    q["month_range_clean"] = _q(["clean"], f"SELECT * FROM clean WHERE {within(*DATE_RANGE)}")
    q["month_rerun"] = _q(["clean"], f"SELECT * REPLACE (CASE WHEN {within(*RERUN_MONTH)} THEN lower(agency) ELSE agency END AS agency) FROM clean")
    q["monthly_layout_counts"] = q["monthly_volume_trend"]

    # End-to-end batch. Its range leaves out rows without a parseable creation
    # time, which the null-rate check (V4) would stop the job for.
    totals = [
        ("raw", "b_raw", "sum(length(unique_key))"),
        ("clean", "b_clean", "round(sum(latitude + longitude), 3)"),
        ("dim_agency", "b_dim_agency", "sum(agency_id * length(agency))"),
        ("dim_complaint", "b_dim_complaint", "sum(complaint_id * length(complaint_type))"),
        ("dim_location", "b_dim_location", "sum(location_id * length(borough))"),
        ("dim_date", "b_dim_date", "sum(year * 10000 + month * 100 + day + day_of_week)"),
        ("fact_311_requests", "b_fact", "sum(coalesce(length(agency), 0) + coalesce(length(complaint_type), 0) + coalesce(length(borough), 0))"),
    ]
    parts = [f"SELECT '{name}' AS stage, count(*) AS n_rows, CAST({total} AS DOUBLE) AS total FROM {src}" for name, src, total in totals]
    parts += [
        f"SELECT 'report:' || report, count(*), CAST(round(sum(coalesce(n_requests, 0) + coalesce(value, 0)), 2) AS DOUBLE) FROM ({_report_lines('b_')}) GROUP BY report"
    ]
    q["batch_from_pages"] = _q(
        [src for _, src, _ in totals], " UNION ALL ".join(f"SELECT '{name}' AS stage, count(*) AS n_rows FROM {src}" for name, src, _ in totals)
    )
    q["batch_summary"] = _q([src for _, src, _ in totals], " UNION ALL ".join(parts))
    return q
