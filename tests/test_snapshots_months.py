"""Snapshot tables and the layout by month: what readers see, before, during and after writes."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from civicspark.sinks import months as M
from civicspark.sinks import snapshots as S


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _table(spark, *numbers):
    return spark.createDataFrame([(n, f"r{n}") for n in numbers], "id bigint, name string")


def test_a_failure_between_write_and_commit_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    with pytest.raises(S.NoSnapshotError):
        S.read_snapshot(spark, tmp_dir)
    S.write_snapshot(_table(spark, 1, 2), tmp_dir)
    reader = S.read_snapshot(spark, tmp_dir)

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(S, "commit_snapshot", fails)
    with pytest.raises(RuntimeError, match="lost"):
        S.write_snapshot(_table(spark, 3), tmp_dir)
    monkeypatch.undo()
    assert len(os.listdir(f"{tmp_dir}/data")) == 2
    assert _rows(S.read_snapshot(spark, tmp_dir)) == [(1, "r1"), (2, "r2")]
    assert S.write_snapshot(_table(spark, 4), tmp_dir).version == 2
    assert _rows(reader) == [(1, "r1"), (2, "r2")]  # a reader that has begun is not disturbed
    assert _rows(S.read_snapshot(spark, tmp_dir)) == [(4, "r4")] and _rows(S.read_snapshot(spark, tmp_dir, 1)) == _rows(reader)


def test_a_commit_without_content_is_passed_over(spark, tmp_dir):
    S.write_snapshot(_table(spark, 1), tmp_dir)
    open(f"{tmp_dir}/commits/{2:020d}.json", "w").close()
    open(f"{tmp_dir}/commits/notes.txt", "w").close()
    assert S.current_snapshot(spark, tmp_dir).version == 1
    assert S.write_snapshot(_table(spark, 2), tmp_dir).version == 3
    assert [s.version for s in S.snapshots(spark, tmp_dir)] == [1, 3]


def test_writers_at_the_same_time_get_versions_of_their_own(spark, tmp_dir):
    staged = [S.stage_snapshot(_table(spark, n), tmp_dir) for n in range(6)]
    with ThreadPoolExecutor(6) as pool:
        found = list(pool.map(lambda p: S.commit_snapshot(spark, tmp_dir, p), staged))
    assert sorted(s.version for s in found) == [1, 2, 3, 4, 5, 6]
    for s in found:
        assert S.read_snapshot(spark, tmp_dir, s.version).count() == 1
    with pytest.raises(S.NoSnapshotError):
        S.read_snapshot(spark, tmp_dir, 7)


def test_a_table_may_be_replaced_by_what_it_reads(spark, tmp_dir):
    S.write_snapshot(_table(spark, 1, 2, 3), tmp_dir)
    S.write_snapshot(S.read_snapshot(spark, tmp_dir).where("id <> 2"), tmp_dir, ["name"])
    assert sorted(r["id"] for r in S.read_snapshot(spark, tmp_dir).collect()) == [1, 3]
    assert os.path.isdir(f"{S.current_snapshot(spark, tmp_dir).path}/name=r1")


def test_old_versions_go_when_asked(spark, tmp_dir):
    for n in range(4):
        S.write_snapshot(_table(spark, n), tmp_dir)
    assert S.remove_old_versions(spark, tmp_dir, keep=2) == [1, 2]
    assert [_rows(S.read_snapshot(spark, tmp_dir, v)) for v in (3, 4)] == [[(2, "r2")], [(3, "r3")]]
    with pytest.raises(S.NoSnapshotError, match="gone"):
        S.read_snapshot(spark, tmp_dir, 1)
    with pytest.raises(ValueError, match="keep"):
        S.remove_old_versions(spark, tmp_dir, keep=0)


def test_staged_files_can_be_discarded(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    S.discard_snapshot(spark, root, S.stage_snapshot(_table(spark, 1), root))
    assert not os.path.exists(root)
    first = S.write_snapshot(_table(spark, 1), root)
    with pytest.raises(ValueError, match="committed"):
        S.discard_snapshot(spark, root, first.path)
    S.discard_snapshot(spark, root, S.stage_snapshot(_table(spark, 2), root))
    assert _rows(S.read_snapshot(spark, root)) == [(1, "r1")]
    with pytest.raises(ValueError, match="does not lie below"):
        S.commit_snapshot(spark, root, f"{tmp_dir}/elsewhere")


def test_the_catalog_table_moves_to_the_current_version(spark, tmp_dir):
    name = "snapshot_table_of_test"
    S.write_snapshot(_table(spark, 1), tmp_dir)
    S.register_snapshot(spark, name, tmp_dir)
    assert _rows(spark.table(name)) == [(1, "r1")]
    S.write_snapshot(_table(spark, 2, 3), tmp_dir)
    assert _rows(spark.table(name)) == [(1, "r1")]
    S.register_snapshot(spark, name, tmp_dir)
    assert _rows(spark.table(name)) == [(2, "r2"), (3, "r3")]
    S.write_snapshot(_table(spark, 5).withColumn("more", F.lit(1)), tmp_dir)
    S.register_snapshot(spark, name, tmp_dir)
    assert _rows(spark.table(name)) == [(5, "r5", 1)]
    assert [s.version for s in S.snapshots(spark, tmp_dir)] == [1, 2, 3]
    with pytest.raises(ValueError, match="Invalid table name"):
        S.register_snapshot(spark, "no name", tmp_dir)
    spark.sql(f"DROP TABLE {name}")


# -- months -------------------------------------------------------------------------


def _requests(spark):
    rows = [(n, f"2024-{n % 5 + 1:02d}-{n % 28 + 1:02d} 10:00:00" if n % 7 else None, f"a{n % 3}") for n in range(200)]
    return spark.createDataFrame(rows, "id int, created_date string, agency string").withColumn("created_date", F.col("created_date").try_cast("timestamp_ntz"))


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_range_reads_its_months_only(spark, tmp_dir):
    df, path = _requests(spark), f"{tmp_dir}/m"
    M.save_by_month(df, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [f"created_month=2024-{m:02d}" for m in range(1, 6)] + ["created_month=none"]
    some = M.read_months(spark, path, "2024-02-10", "2024-03-05")
    want = df.where("created_date >= '2024-02-10' AND created_date <= '2024-03-05 23:59:59'")
    assert _rows(some) == _rows(want) and some.columns == df.columns
    scan = some._jdf.queryExecution().sparkPlan().collectLeaves().head()
    filters = scan.partitionFilters().mkString(" ")
    assert "2024-02" in filters and "2024-03" in filters and "created_date" not in filters
    listed = scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters())
    assert sorted(listed.apply(k).values().getUTF8String(0).toString() for k in range(listed.size())) == ["2024-02", "2024-03"]
    assert _rows(M.read_months(spark, path)) == _rows(df)
    assert _rows(M.read_months(spark, path, "2024-05-01")) == _rows(df.where("created_date >= '2024-05-01'"))
    assert _rows(M.read_months(spark, path, None, "2024-01-31")) == _rows(df.where("created_date < '2024-02-01'"))


def test_a_month_run_again_leaves_the_others(spark, tmp_dir):
    df, path = _requests(spark), f"{tmp_dir}/m"
    M.save_by_month(df, path)
    before = _files(path)
    again = df.where("month(created_date) = 3").withColumn("agency", F.lit("new"))
    M.save_by_month(again, path)
    after = _files(path)
    assert {f for f in before if "2024-03" not in f} == {f for f in after if "2024-03" not in f}
    assert all(after[f] == t for f, t in before.items() if f in after)
    assert not {f for f in before if "2024-03" in f} & set(after)
    want = df.where("month(created_date) <> 3 OR created_date IS NULL").unionByName(again)
    assert _rows(M.read_months(spark, path)) == _rows(want)
    counts = {(r["year"], r["month"]): r["n_requests"] for r in M.monthly_counts(spark, path).collect()}
    assert counts == {(2024, r["m"]): r["count"] for r in df.where("created_date IS NOT NULL").groupBy(F.month("created_date").alias("m")).count().collect()}


def test_a_crowded_month_is_several_files(spark, tmp_dir):
    df, path = _requests(spark), f"{tmp_dir}/m"
    M.save_by_month(df, path, rows_per_file=10)
    per_month = {}
    for f in _files(path):
        month = os.path.basename(os.path.dirname(f))
        per_month[month] = per_month.get(month, 0) + 1
    assert all(1 < n <= 5 for n in per_month.values()) and _rows(M.read_months(spark, path)) == _rows(df)


def test_month_errors(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        M.read_months(spark, f"{tmp_dir}/none")
    with pytest.raises(ValueError, match="created_month"):
        M.save_by_month(_requests(spark).withColumn("created_month", F.lit("x")), f"{tmp_dir}/m")
    with pytest.raises(ValueError):
        M.months_between("2024-13-01", None)
