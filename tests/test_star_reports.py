"""Star tables and reports over small request tables, computed again in plain Python."""

import datetime as dt
import os
from collections import defaultdict

import pytest

from civicspark.operators.reports import REPORT_NAMES
from civicspark.plans.reports import generate_reports
from civicspark.plans.star import build_star_schema
from civicspark.sources.files import read_star

COLUMNS = (
    "unique_key string, created_date timestamp_ntz, closed_date timestamp_ntz, response_time_hours double, agency string, "
    "complaint_type string, descriptor string, borough string, incident_zip string, latitude double, longitude double"
)
T0 = dt.datetime(2022, 11, 5, 6)


def _request(i):
    hours = [None, -2.0, 0.0, 3.25, 1e7][i % 5] if i % 7 else 40.0 + i
    return (
        f"K{i}", T0 + dt.timedelta(days=3 * i % 200, hours=i) if i % 17 else None, None, hours,
        ["", None, "Parks", "Roads"][i % 4] if i % 3 else f"Desk {i % 20:02d}", None if i % 19 == 0 else "" if i % 23 == 0 else f"kind {i % 26:02d}",
        None if i % 9 == 0 else f"detail {i % 2}", None if i % 29 == 0 else ["BRONX", "QUEENS", "UNKNOWN"][i % 3], None if i % 31 == 0 else f"{10000 + i % 4}",
        None if i % 6 == 0 else 40.5, None if i % 8 == 0 else -73.9,
    )


@pytest.fixture(scope="module")
def requests():
    return [_request(i) for i in range(6000)]


@pytest.fixture(scope="module")
def built(spark, requests, tmp_path_factory):
    """``(rows per table, star folder)`` of a build over the requests."""
    root = tmp_path_factory.mktemp("star")
    spark.createDataFrame(requests, COLUMNS).write.parquet(f"{root}/clean")
    return build_star_schema(spark, f"{root}/clean", f"{root}/star"), f"{root}/star"


def _sorted_nulls_last(values):
    return sorted(values, key=lambda v: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in v))


def test_dimensions_number_their_values_in_order(spark, requests, built):
    counts, folder = built
    star = read_star(spark, folder)
    want = {
        "dim_agency": {(r[4],) for r in requests if r[4]},
        "dim_complaint": {(r[5], r[6]) for r in requests if r[5]},
        "dim_location": {r[7:11] for r in requests},
    }
    for name, values in want.items():
        rows = [tuple(r) for r in star[name].collect()]
        assert [r[1:] for r in sorted(rows)] == _sorted_nulls_last(values) and sorted(r[0] for r in rows) == list(range(1, len(values) + 1))
        assert counts[name] == len(values)
    days = {r[1].date() for r in requests if r[1]}
    assert {tuple(r) for r in star["dim_date"].collect()} == {(d, d.year, d.month, d.day, d.isoweekday() % 7) for d in days}


def test_fact_keys_lead_back_to_what_can_be_looked_up(spark, requests, built):
    star = read_star(spark, built[1])
    agency, complaint, location = ({r[0]: tuple(r)[1:] for r in star[t].collect()} for t in ("dim_agency", "dim_complaint", "dim_location"))
    facts = {r["unique_key"]: r for r in star["fact_311_requests"].collect()}
    assert len(facts) == built[0]["fact_311_requests"] == len(requests)
    for r in requests:
        f = facts[r[0]]
        assert (f["created_date"], f["closed_date"], f["response_time_hours"]) == r[1:4]
        assert agency.get(f["agency_id"]) == ((r[4],) if r[4] else None)
        assert complaint.get(f["complaint_id"]) == ((r[5], r[6]) if r[5] and r[6] is not None else None)
        assert location.get(f["location_id"]) == (r[7:11] if r[7] is not None and r[8] is not None else None)


def _reports_in_python(requests):
    def mean(groups):
        return {k: (round(sum(v) / len(v) * 100) / 100, len(v)) for k, v in groups.items()}

    boroughs, kinds, hours, desks, months = (defaultdict(list) for _ in range(5))
    for r in requests:
        has_kind = r[5] and r[6] is not None
        if r[3] is not None and r[3] >= 0:
            if r[7] is not None and r[8] is not None:
                boroughs[r[7]].append(r[3])
            if has_kind:
                hours[r[5]].append(r[3])
        if has_kind:
            kinds[r[5]].append(1)
        if r[4]:
            desks[r[4]].append(1)
        if r[1]:
            months[r[1].year, r[1].month].append(1)

    def top(groups, k):
        return [(x, len(v)) for x, v in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0]))][:k]

    def share(missing):
        return round(100 * sum(map(missing, requests)) / len(requests), 2)

    slow = [(k, *v) for k, v in mean(hours).items() if v[1] >= 100]
    return {
        "avg_response_time_by_borough": [(k, *v) for k, v in sorted(mean(boroughs).items(), key=lambda g: (-g[1][0], g[0]))],
        "top_20_complaint_types": top(kinds, 20),
        "top_agencies_by_volume": top(desks, 15),
        "monthly_volume_trend": [(*k, len(v)) for k, v in sorted(months.items())],
        "slowest_complaints_by_avg_time": sorted(slow, key=lambda s: (-s[1], s[0]))[:20],
        "data_quality_null_rates": [(
            share(lambda r: r[1] is None), share(lambda r: not r[5] or r[6] is None), share(lambda r: not r[4]),
            share(lambda r: r[7] is None or r[8] is None),
        )],
    }


def test_reports_and_their_files(spark, requests, built, tmp_dir):
    reports = generate_reports(spark, built[1], f"{tmp_dir}/reports")
    want = _reports_in_python(requests)
    assert list(reports) == REPORT_NAMES and sorted(want) == sorted(REPORT_NAMES)
    for name, rows in want.items():
        got = [tuple(r) for r in reports[name].collect()]
        assert [tuple(pytest.approx(x) if isinstance(x, float) else x for x in r) for r in rows] == got, name
        with open(f"{tmp_dir}/reports/{name}.csv", encoding="utf-8") as f:
            lines = f.read().splitlines()
        assert lines[0] == ",".join(reports[name].columns)
        assert [line.split(",") for line in lines[1:]] == [[repr(x) if isinstance(x, float) else str(x) for x in r] for r in got], name
    counts = [n for _, n in want["top_agencies_by_volume"]]
    assert len(counts) == 15 and want["slowest_complaints_by_avg_time"][0][1] > 1e5
    assert sorted(os.listdir(f"{tmp_dir}/reports")) == sorted([f"{n}.csv" for n in REPORT_NAMES] + [f for f in os.listdir(f"{tmp_dir}/reports") if f.endswith(".crc")])


#: what is missing, the call, the fixed phrase of its error
MISSING = [
    ("clean table", lambda s, d: build_star_schema(s, f"{d}/not-there", f"{d}/star"), "Clean data directory not found"),
    ("star tables", lambda s, d: generate_reports(s, f"{d}/not-there", f"{d}/reports"), "Missing analytics files"),
]


@pytest.mark.parametrize(("call", "phrase"), [m[1:] for m in MISSING], ids=[m[0] for m in MISSING])
def test_missing_inputs_are_named(spark, tmp_dir, call, phrase):
    with pytest.raises(FileNotFoundError, match=phrase):
        call(spark, tmp_dir)


def test_star_needs_the_response_time(spark, requests, tmp_dir):
    spark.createDataFrame(requests[:3], COLUMNS).drop("response_time_hours").write.parquet(f"{tmp_dir}/clean")
    with pytest.raises(ValueError, match="response_time_hours"):
        build_star_schema(spark, f"{tmp_dir}/clean", f"{tmp_dir}/star")
