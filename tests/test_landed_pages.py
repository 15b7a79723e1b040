"""Paged source over landed files, and slices of a source by rank, against plain Python."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from civicspark.schema import RAW_COLUMNS
from civicspark.sources import landed, paging


def _write(folder, pages, name="page_{:05d}.json"):
    os.makedirs(folder, exist_ok=True)
    for number, page in pages.items():
        with open(os.path.join(folder, name.format(number)), "w", encoding="utf-8") as f:
            f.write(page if isinstance(page, str) else json.dumps(page))


def _one_after_another(pages, batch_size, total_limit):
    """Keys of the records that asking for page after page gives; raises where a page is no list."""
    out = []
    for number in sorted(pages):
        if total_limit is not None and len(out) >= total_limit:
            break
        page = pages[number]
        if isinstance(page, str) or not all(isinstance(r, dict) for r in page):
            raise landed.PageError(number)
        out += [r["unique_key"] for r in page]
        if len(page) < batch_size:
            break
    return out if total_limit is None else out[:total_limit]


@pytest.mark.parametrize("seed", range(4))
def test_reads_what_asking_page_by_page_gives(spark, tmp_dir, seed):
    rnd = random.Random(seed)
    size, n = 5, 0
    pages = {}
    for k in range(12):
        number = 3 * k + rnd.randrange(3)  # numbers may leave gaps, and are not in order of their text beyond 9
        records = [{"unique_key": str(n + i), "agency": None if i % 2 else "A"} for i in range(size if rnd.random() < 0.85 else rnd.randrange(size))]
        pages[number] = records
        n += len(records)
    if seed % 2:
        pages[sorted(pages)[7]] = json.dumps({"error": True, "message": "throttled"})
    _write(tmp_dir, pages, "page{}.json")
    for limit in (None, 0, 12, 1000):
        try:
            want = _one_after_another(pages, size, limit)
        except landed.PageError:
            with pytest.raises(landed.PageError, match="not an array of records"):
                landed.read_page_source(spark, tmp_dir, size, limit).collect()
            continue
        rows = landed.page_records(spark, tmp_dir, size, limit).select("position", F.variant_get("record", "$.unique_key", "string")).collect()
        assert [r[1] for r in sorted(rows)] == want and [r[0] for r in sorted(rows)] == list(range(len(want)))
        table = landed.read_page_source(spark, tmp_dir, size, limit)
        assert table.columns == RAW_COLUMNS and sorted(r["unique_key"] for r in table.collect()) == sorted(want)


@pytest.mark.parametrize("page", [" ", "no json", '{"message": "x"}', "[1, 2]", '[{"unique_key": "1"}, null]', "null"])
def test_a_page_that_is_no_array_of_records_is_an_error(spark, tmp_dir, page):
    full = [[{"unique_key": f"{k}{i}"} for i in range(3)] for k in range(3)]
    _write(tmp_dir, {1: full[0], 2: page, 3: full[1]})
    with pytest.raises(landed.PageError, match="page 2"):
        landed.read_page_source(spark, tmp_dir, 3)
    assert landed.read_page_source(spark, tmp_dir, 3, total_limit=3).count() == 3  # never asked for


def test_page_after_a_short_one_does_not_matter(spark, tmp_dir):
    _write(tmp_dir, {1: [{"unique_key": "1"}], 2: "broken"})
    assert [r["unique_key"] for r in landed.read_page_source(spark, tmp_dir, 3).collect()] == ["1"]


def test_files_without_a_number_come_by_name_and_last(spark, tmp_dir):
    full = [[{"unique_key": f"{k}{i}"} for i in range(2)] for k in range(5)]
    _write(tmp_dir, {2: full[0], 1: full[1], 3: [{"unique_key": "short"}], 4: full[4]}, "{:03d}.json")
    keys = lambda df: sorted(r["unique_key"] for r in df.collect())
    assert keys(landed.read_page_source(spark, tmp_dir, 2)) == ["00", "01", "10", "11", "short"]
    assert keys(landed.read_page_source(spark, tmp_dir, 2, 3)) == ["00", "10", "11"]
    _write(tmp_dir, {9: full[2]}, "page{}.json")
    assert keys(landed.read_page_source(spark, tmp_dir, 2, 3)) == ["10", "20", "21"]


def test_arguments_and_missing_folder(spark, tmp_dir):
    with pytest.raises(ValueError, match="batch_size"):
        landed.read_page_source(spark, tmp_dir, 1001)
    with pytest.raises(ValueError, match="total_limit"):
        landed.read_page_source(spark, tmp_dir, 10, -1)
    with pytest.raises(FileNotFoundError):
        landed.read_page_source(spark, os.path.join(tmp_dir, "nowhere"), 10)


def test_union_of_keys(spark, tmp_dir):
    records = [
        {"unique_key": "1", "borough": "BRONX", "status": "Open", "n": 1.5, "flag": True},
        {"unique_key": "2", "a.b": "dot", "x y": None, "it's": "quote", 'q"`': "both", "location": {"human": ["a", {"b": 1}]}},
        {"unique_key": "3", "n": "text", "status": None, "back\\slash": "c", "ключ": "ü", "a:b, c<d>": "marks"},
    ]
    _write(tmp_dir, {1: records[:2], 2: records[2:]})
    table = landed.read_page_source(spark, tmp_dir, 2, schema=None)
    keys = {k for r in records for k in r}
    assert table.columns == ["unique_key", "borough", *sorted(keys - {"unique_key", "borough"})]
    got = {r["unique_key"]: r.asDict() for r in table.collect()}
    assert got["1"]["n"] == "1.5" and got["1"]["flag"] == "true" and got["3"]["n"] == "text"
    assert json.loads(got["2"]["location"]) == {"human": ["a", {"b": 1}]}
    assert [got["2"][k] for k in ("a.b", "x y", "it's", 'q"`')] == ["dot", None, "quote", "both"]
    assert [got["3"][k] for k in ("status", "back\\slash", "ключ", "a:b, c<d>")] == [None, "c", "ü", "marks"]
    _write(os.path.join(tmp_dir, "empty"), {1: []})
    assert landed.read_page_source(spark, os.path.join(tmp_dir, "empty"), 2, schema=None).columns == []


def test_outermost_names():
    assert landed.top_level_keys("OBJECT<a: STRING, `b:c`: OBJECT<d: ARRAY<BIGINT>, e: STRING>, `f``, g`: DECIMAL(3,1), h: VOID>") == ["a", "b:c", "f`, g", "h"]
    assert [landed.top_level_keys(s) for s in (None, "VOID", "OBJECT<>")] == [[], [], []]


def test_landed_pages_come_back(spark, tmp_dir):
    rows = [(str(k), "t", "BRONX", f"2024-01-{k % 28 + 1:02d}" if k % 9 else None) for k in range(57)]
    df = spark.createDataFrame(rows, "unique_key string, complaint_type string, borough string, created_date string")
    landed.land_pages(landed.page_texts(df, 10), tmp_dir + "/p")
    back = landed.read_page_source(spark, tmp_dir + "/p", 10, schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    first = landed.read_page_source(spark, tmp_dir + "/p", 10, 10, schema=df.schema).collect()
    newest = sorted(rows, key=lambda r: ([-ord(c) for c in r[3]] if r[3] else [0], r[0]))[:10]
    assert sorted(map(tuple, first)) == sorted(newest)


def test_many_small_pages_share_files(spark, tmp_dir):
    """Making, listing and opening files takes no more for small pages than for large ones."""
    rows = [(k, json.dumps([{"unique_key": f"{k}\n\t{i}"} for i in range(2)], indent=1 if k % 2 else None)) for k in range(100)]
    texts = spark.createDataFrame(rows, "page bigint, value string")
    landed.land_pages(texts, tmp_dir + "/p")
    files = [f for _, _, names in os.walk(tmp_dir + "/p") for f in names if f.startswith("part-")]
    assert len(files) == -(-100 // landed.PAGES_PER_FILE)
    want = [f"{k}\n\t{i}" for k in range(100) for i in range(2)]
    key = F.variant_get("record", "$.unique_key", "string")
    got = landed.page_records(spark, tmp_dir + "/p", 2).select("position", key).collect()
    assert sorted(map(tuple, got)) == list(enumerate(want))
    assert sorted(r[0] for r in landed.page_records(spark, tmp_dir + "/p", 2, 77).select(key).collect()) == sorted(want[:77])
    assert sorted((r["number"], r["n"], r["valid"]) for r in landed.page_sizes(spark, tmp_dir + "/p").collect()) == [(k, 2, True) for k in range(100)]

    value = F.when(F.col("page") == 70, F.lit("[1]")).when(F.col("page") == 60, F.lit("[]")).otherwise(F.col("value"))
    landed.land_pages(texts.withColumn("value", value), tmp_dir + "/stop")
    assert landed.page_records(spark, tmp_dir + "/stop", 2).count() == 120
    landed.land_pages(texts.withColumn("value", F.when(F.col("page") == 70, F.lit(None)).otherwise(F.col("value"))), tmp_dir + "/bad")
    with pytest.raises(landed.PageError, match="page 70"):
        landed.page_records(spark, tmp_dir + "/bad", 2)


def test_union_of_keys_over_pages_of_several_lines_and_shared_files(spark, tmp_dir):
    _write(tmp_dir, {1: json.dumps([{"unique_key": "1", "odd key": "x"}], indent=2)})
    value = json.dumps([{"unique_key": "2", "more": {"a": [1]}}], indent=2)
    landed.land_pages(spark.createDataFrame([(2, value), (40, "[]")], "page bigint, value string"), tmp_dir + "/later")
    table = landed.read_page_source(spark, tmp_dir, 1, schema=None)
    assert table.columns == ["unique_key", "more", "odd key"]
    assert sorted(map(tuple, table.collect())) == [("1", None, "x"), ("2", '{"a":[1]}', None)]


def test_pages_of_both_layouts_are_one_source(spark, tmp_dir):
    landed.land_pages(spark.createDataFrame([(k, json.dumps([{"unique_key": str(k)}])) for k in (0, 1, 40)], "page bigint, value string"), tmp_dir)
    _write(tmp_dir, {2: [{"unique_key": "2"}], 50: []})
    got = landed.page_records(spark, tmp_dir, 1).select("position", F.variant_get("record", "$.unique_key", "string")).collect()
    assert sorted(map(tuple, got)) == [(0, "0"), (1, "1"), (2, "2"), (3, "40")]


def test_any_object_is_a_record(spark, tmp_dir):
    pages = {1: '[{}, {"a": null}, {"unique_key": {"b": 1}}]', 2: "[[]]", 3: '[{"a": 1}, "x"]', 4: "[[{}]]", 5: "[]", 6: "[true]", 7: "[null]"}
    _write(tmp_dir, pages)
    got = {r["number"]: (r["n"], r["valid"]) for r in landed.page_sizes(spark, tmp_dir).collect()}
    assert got == {1: (3, True), 2: (1, False), 3: (2, False), 4: (1, False), 5: (0, True), 6: (1, False), 7: (1, False)}


def test_records_of_reached_pages_are_parsed_once(spark, tmp_dir):
    _write(tmp_dir, {1: [{"unique_key": "1"}], 2: [{"unique_key": "2"}], 3: [], 4: [{"unique_key": "4"}]})
    records = landed.page_records(spark, tmp_dir, 1)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    assert plan.index("parseJson") < plan.index("Join")  # above the join, so pages that are not reached are not parsed
    key = F.variant_get("record", "$.unique_key", "string")
    assert sorted(map(tuple, records.select("position", key).collect())) == [(0, "1"), (1, "2")]


def test_rows_are_placed_by_a_time_parsed_once(spark, monkeypatch):
    df = spark.createDataFrame([(str(k), f"2024-01-{k:02d}") for k in range(1, 9)], "unique_key string, created_date string")
    monkeypatch.setattr(paging, "numbered", lambda df, order, name: df.sort(*order).withColumn(name, F.lit(1)))
    placed = paging.newest_positions(df)
    assert placed.columns == ["unique_key", "created_date", paging.POSITION]
    sort = next(line for line in placed._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in line)
    assert "cast" not in sort and "RLIKE" not in sort


def test_pages_compute_their_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(key):
        read.add(1)
        return key

    rows = spark.createDataFrame([(str(k), f"2024-01-{k % 28 + 1:02d}") for k in range(57)], "unique_key string, created_date string")
    df = rows.withColumn("unique_key", F.udf(count, "string")("unique_key"))
    assert landed.page_texts(df, 10).count() == 6
    assert read.value == 57


# -- slices by rank -----------------------------------------------------------------


def _requests(seed, n, days, seconds):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        when = f"2024-03-{rnd.randrange(days) + 1:02d}T10:00:{rnd.randrange(seconds):02d}" if rnd.random() < 0.9 else rnd.choice([None, "invalid"])
        rows.append((str(k), when, rnd.choice("ab")))
    return rows


def _newest(rows):
    def time(r):
        return r[1] if r[1] and r[1] != "invalid" else None

    known = sorted((r for r in rows if time(r)), key=lambda r: r[0])
    known.sort(key=lambda r: r[1], reverse=True)
    return known + sorted((r for r in rows if not time(r)), key=lambda r: r[0])


@pytest.mark.parametrize("crowded", ["0", "100000"])
@pytest.mark.parametrize(("days", "seconds"), [(20, 50), (1, 2), (2, 30)])
def test_slices_and_limits_by_counts(spark, crowded, days, seconds):
    rows = _requests(days, 300, days, seconds)
    order = _newest(rows)
    text = spark.createDataFrame(rows, "unique_key string, created_date string, other string")
    typed = text.withColumn("created_date", F.col("created_date").try_cast("timestamp_ntz"))
    spark.conf.set("civicspark.sliceSortRows", crowded)
    try:
        for df, slices, limits in ((text, ((0, 10), (95, 30), (280, 100), (300, 5)), (0, 7, 275, 300)), (typed, ((260, 20),), (150,))):
            for offset, limit in slices:
                assert [r[0] for r in paging.page_slice(df, offset, limit).collect()] == [r[0] for r in order[offset : offset + limit]], (offset, limit)
            for limit in limits:
                assert sorted(r[0] for r in paging.take_newest(df, limit).collect()) == sorted(r[0] for r in order[:limit]), limit
        assert [[r[0] for r in p.collect()] for p in paging.pages(text, 100, 250)] == [[r[0] for r in order[a:b]] for a, b in ((0, 100), (100, 200), (200, 250))]
    finally:
        spark.conf.unset("civicspark.sliceSortRows")
    with pytest.raises(ValueError, match="offset"):
        paging.page_slice(text, -1, 10)


def test_a_slice_reads_only_rows_near_it(spark, tmp_dir):
    """The creation bound of a slice reaches the scan, and only rows within it are placed."""
    rows = [(str(k), f"20{10 + k % 15}-01-{k % 28 + 1:02d}T00:00:00", "x" * 50) for k in range(4000)]
    spark.createDataFrame(rows, "unique_key string, created_date string, note string").write.parquet(f"{tmp_dir}/r")
    df = spark.read.parquet(f"{tmp_dir}/r")
    near = paging.reach(df, 500, 600)
    scan = df.where(near.condition)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_date,20" in scan and "Not(GreaterThanOrEqual(created_date,20" in scan or "LessThan(created_date,20" in scan
    assert df.where(near.condition).count() < 300 and near.newer <= 500
    assert [r[0] for r in paging.page_slice(df, 500, 100).collect()] == [r[0] for r in _newest(rows)[500:600]]
