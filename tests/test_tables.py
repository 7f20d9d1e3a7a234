from datetime import date

import pytest
from pyspark.sql import functions as F

from listenlake.operators.scratch import materialise, scratch_root
from listenlake.sources.tables import (
    between_dates,
    commit_version,
    drop_old_versions,
    read_version,
    replace_partitions,
    versions,
    write_version,
)

SCHEMA = "id bigint, day date"


def days(spark, n, day="2024-01-01"):
    return spark.range(n).withColumn("day", F.lit(day).cast("date"))


def test_a_table_never_written_is_empty(spark, tmp_path):
    got = read_version(spark, str(tmp_path / "none"), SCHEMA)
    assert got.count() == 0
    assert got.dtypes == [("id", "bigint"), ("day", "date")]


def test_a_job_may_overwrite_what_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(days(spark, 3), path)
    write_version(read_version(spark, path, SCHEMA).withColumn("id", F.col("id") + 10), path)
    assert versions(spark, path) == [1, 2]
    assert sorted(r["id"] for r in read_version(spark, path, SCHEMA).collect()) == [10, 11, 12]
    assert read_version(spark, path, SCHEMA, 1).agg(F.max("id")).first()[0] == 2


def test_a_crash_before_the_commit_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(days(spark, 3), path)
    days(spark, 99).write.parquet(f"{path}/v=2")  # written, never committed
    assert read_version(spark, path, SCHEMA).count() == 3
    with pytest.raises(ValueError, match="version 2"):
        read_version(spark, path, SCHEMA, 2)
    assert write_version(days(spark, 5), path) == 3  # the torn version is passed over
    assert read_version(spark, path, SCHEMA).count() == 5


def test_two_writers_cannot_commit_the_same_version(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(days(spark, 3), path)
    with pytest.raises(Exception, match="exist"):
        commit_version(spark, path, 1)


def test_a_failing_write_commits_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(days(spark, 3), path)
    broken = days(spark, 3).withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        write_version(broken, path)
    assert versions(spark, path) == [1]
    assert read_version(spark, path, SCHEMA).count() == 3


def test_lost_files_of_a_committed_version_raise(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(days(spark, 3), path)
    commit_version(spark, path, 2)  # committed, but the files are gone
    with pytest.raises(Exception, match="v=2"):
        read_version(spark, path, SCHEMA).count()


def test_old_versions_go_oldest_first(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        write_version(days(spark, n), path)
    assert drop_old_versions(spark, path, keep=2) == [1, 2]
    assert versions(spark, path) == [3, 4]
    assert read_version(spark, path, SCHEMA).count() == 4
    with pytest.raises(ValueError):
        drop_old_versions(spark, path, keep=0)


def test_partitions_are_replaced_not_doubled(spark, tmp_path):
    path = str(tmp_path / "t")
    both = days(spark, 3).unionByName(days(spark, 4, "2024-01-02"))
    replace_partitions(both, path, ["day"])
    replace_partitions(days(spark, 7, "2024-01-02"), path, ["day"])
    replace_partitions(days(spark, 7, "2024-01-02"), path, ["day"])
    table = spark.read.schema(SCHEMA).parquet(path)
    counts = {r["day"]: r["count"] for r in table.groupBy("day").count().collect()}
    assert counts == {date(2024, 1, 1): 3, date(2024, 1, 2): 7}
    ranged = between_dates(table, date(2024, 1, 2), date(2024, 1, 5), "day")
    assert ranged.count() == 7
    assert "PartitionFilters: [isnotnull(day" in ranged._jdf.queryExecution().executedPlan().toString()


def test_a_partitioned_version_reads_back_with_its_types(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = days(spark, 6).withColumns({"is_active": F.col("id") % 2 == 0, "month": F.month("day")})
    write_version(frame, path, ["is_active", "month"])
    got = read_version(spark, path, frame.schema)
    assert dict(got.dtypes) == dict(frame.dtypes)  # the boolean folder is no text
    active = got.filter("is_active AND month = 1")
    assert sorted(r["id"] for r in active.collect()) == [0, 2, 4]
    assert "PartitionFilters: [isnotnull(is_active" in active._jdf.queryExecution().executedPlan().toString()


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    if shared:
        assert root.startswith(shared)
    frame = materialise(spark.range(5), "test")
    assert frame.inputFiles()[0].find(root) >= 0
    assert frame.count() == 5
