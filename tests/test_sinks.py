from __future__ import annotations

import glob
import json
import os
import shutil
import subprocess
import sys
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from reviewlake import filesystem
from reviewlake.operators import output_check_metrics
from reviewlake.plans.run import owner_of, utc_now
from reviewlake.sinks import (
    TABLES,
    append_manifest,
    append_metrics,
    compact,
    create_table,
    drop_partitions,
    drop_table_partitions,
    evolve_table,
    fold_metrics,
    insert_partitions,
    list_files,
    new_run_id,
    own_rows,
    partition_location,
    purge_loaded,
    read_metrics,
    retain_days,
    stamp_month,
    write_full,
    write_partitions,
    zorder_key,
)
from reviewlake.sources import read_partitioned, table_location
from tests.conftest import plan_of, rows

DAYS = "id INT, date_load STRING"


def content(spark, path, partition=("date_load",)):
    return sorted(rows(read_partitioned(spark, path, list(partition))))


def parquet_files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


@pytest.fixture
def database(spark, lake, request):
    name = f"db_{abs(hash(lake)) % 10**10}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_overwrite_replaces_only_its_partitions(spark, lake):
    write_partitions(spark.createDataFrame([(1, "d1"), (2, "d2")], DAYS), lake)
    for _ in range(2):
        write_partitions(spark.createDataFrame([(3, "d1")], DAYS), lake)
    assert content(spark, lake) == [(2, "d2"), (3, "d1")]
    write_partitions(spark.createDataFrame([(4, "d1")], DAYS), lake, mode="append")
    assert content(spark, lake) == [(2, "d2"), (3, "d1"), (4, "d1")]


def test_empty_overwrite_changes_nothing(spark, lake):
    df = spark.createDataFrame([(1, "d1")], DAYS)
    write_partitions(df, lake)
    write_partitions(df.filter("false"), lake)
    write_partitions(df.filter("false").drop("date_load"), lake, static={"date_load": "d1"})
    assert content(spark, lake) == [(1, "d1")]


def test_missing_partition_column(spark, lake):
    df = spark.range(1).select(F.col("id").cast("int").alias("id"))
    write_partitions(df, lake, static={"date_load": "d9"})
    assert content(spark, lake) == [(0, "d9")]
    with pytest.raises(ValueError, match="date_load"):
        write_partitions(df, lake)


def test_apps_of_a_day_do_not_replace_each_other(spark, lake):
    schema, keys = "id INT, date_load STRING, app STRING", ["date_load", "app"]
    for app in ("a", "b", "a"):
        write_partitions(spark.createDataFrame([(1, "d1", app)], schema), lake, keys)
    assert content(spark, lake, keys) == [(1, "d1", "a"), (1, "d1", "b")]


def test_known_partition_is_written_without_a_shuffle(spark, lake):
    df = spark.range(10).withColumn("date_load", F.lit("d1"))
    from reviewlake.sinks.partitions import _arranged
    assert "Exchange" not in plan_of(_arranged(df, ["date_load"], {"date_load": "d1"}, None))
    assert "Exchange" in plan_of(_arranged(df, ["date_load"], {}, None))


def test_hot_partition_is_split_over_tasks(spark, lake):
    """Most rows fall into one partition: it is written by several tasks, all rows arrive."""
    df = spark.range(120_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("p"))
    write_partitions(df, lake, ["p"], file_bytes=500_000)
    assert len(parquet_files(f"{lake}/p=hot")) > 2
    assert spark.read.parquet(lake).count() == 120_000


def test_shuffles_grow_with_the_data(spark):
    from reviewlake.session import shuffle_tasks_for, write_sizing
    small, large = spark.range(10), spark.range(10**12)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_tasks_for(small) == configured
    assert shuffle_tasks_for(large, 2**30) == -(-8 * 10**12 // 2**30)
    assert shuffle_tasks_for(large, 10**8) == 80_000
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with write_sizing(spark, large, 2**30):
        assert spark.conf.get(key) == str(shuffle_tasks_for(large, 2**30))
        planned = large.repartition("id").groupBy("id").count()
        assert f", {shuffle_tasks_for(large, 2**30)})" in plan_of(planned)
    assert spark.conf.get(key, None) is None


def test_insert_matches_names_and_casts(spark, lake, database):
    name = create_table(spark, database, "t", TABLES["review_kpis"], f"{lake}/t")
    row = spark.sql("SELECT '2024' AS review_year, 'A' AS app_reference, '01' AS review_month,"
                    " '1' AS review_version, 'PF' AS segment, 'S' AS service_type,"
                    " '7' AS review_count, 'x' AS average_rating, 1 AS min_rating, 5 AS max_rating,"
                    " 0.5 AS nps_score")
    measured = insert_partitions(row, name, measure={"n": F.count("*")}, on_bad="count")
    assert measured == {"n": 1, "lossy": {"review_count": 0, "average_rating": 1, "min_rating": 0, "max_rating": 0, "nps_score": 0}}
    assert rows(spark.table(name).select("review_year", "review_count", "average_rating",
                                         "app_reference")) == [("2024", 7, None, "A")]
    with pytest.raises(ValueError, match="mode"):
        insert_partitions(row, name, mode="replace")


def test_writes_restore_the_session(spark, lake, database):
    name = create_table(spark, database, "t", TABLES["internal_reviews"], f"{lake}/t")
    keys = ["spark.sql.sources.partitionOverwriteMode",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(key, None) for key in keys]
    insert_partitions(spark.table(name).filter("false"), name)
    assert [spark.conf.get(key, None) for key in keys] == before


def test_overlapping_settings_end_as_they_began(spark):
    from reviewlake.session import session_conf
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    first = session_conf(spark, **{key.replace(".", "__"): "10"})
    second = session_conf(spark, **{key.replace(".", "__"): "20"})
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "20"
    second.__exit__(None, None, None)
    assert spark.conf.get(key, None) is None


def test_tables_are_replaced_by_partition_even_side_by_side(spark, lake, database):
    """Writers of different partitions at the same time leave each other's rows alone."""
    from concurrent.futures import ThreadPoolExecutor
    name = create_table(spark, database, "t", TABLES["internal_reviews"], f"{lake}/t")
    columns = {c: F.lit(None) for c in spark.table(name).columns if c != "date_load"}

    def write(day):
        insert_partitions(spark.range(5).select(F.lit(day).alias("date_load")).withColumns(columns), name)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, [f"d{i % 4}" for i in range(4)]))
    list(map(write, ["d0", "d1"]))
    assert spark.table(name).groupBy("date_load").count().filter("count = 5").count() == 4


def test_month_stamp(spark):
    df = stamp_month(spark.createDataFrame([(1, "2023-05-05")], DAYS), "2024-02-10")
    assert rows(df) == [(1, "202402")]
    with pytest.raises(ValueError):
        stamp_month(df, "10/02/2024")


def test_full_write_replaces_the_schema(spark, lake, database):
    name = create_table(spark, database, "t", TABLES["review_kpis"], f"{lake}/t")
    assert write_full(spark.range(2), name)
    assert sorted(rows(spark.table(name))) == [(0,), (1,)]
    # The table is kept where it was declared, in a version of its folder; the old one is gone.
    assert table_location(spark, name).rsplit("/", 1)[0].endswith(lake) and not os.path.exists(f"{lake}/t")
    assert not write_full(spark.range(0), name)
    assert spark.table(name).count() == 2
    assert write_full(spark.range(0), name, on_empty="write")
    assert spark.table(name).count() == 0


def test_full_write_merges_small_partitions(spark, lake):
    from reviewlake.session import session_conf
    with session_conf(spark, spark__sql__shuffle__partitions="50"):
        counts = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
        write_full(counts, f"{lake}/t", as_table=False)
    assert len(parquet_files(f"{lake}/t")) < 5


def test_tables_are_created_once(spark, lake, database):
    for label, spec in TABLES.items():
        name = create_table(spark, database, label, spec, f"{lake}/{label}")
        create_table(spark, database, label, spec, f"{lake}/{label}")
        assert spark.table(name).columns == [c for c, _, _ in spec.columns]
    name = f"{database}.unified_reviews"
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert comments["review_rating"] == "rating, 1 to 5"


def test_recreate_removes_old_rows(spark, lake, database):
    args = (spark, database, "internal_reviews", TABLES["internal_reviews"], f"{lake}/t")
    name = create_table(*args)
    columns = {c: F.lit(None) for c in spark.table(name).columns if c != "date_load"}
    insert_partitions(spark.range(1).select(F.lit("d1").alias("date_load")).withColumns(columns), name)
    assert spark.table(name).count() == 1
    create_table(*args)
    assert spark.table(name).count() == 1
    create_table(*args, recreate=True)
    assert spark.table(name).count() == 0


@pytest.fixture
def scattered(spark, lake, database):
    """A table of two partitions of eight small files each; a third of the rows holds one value."""
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (v INT, s STRING, id BIGINT, p STRING) USING parquet "
              f"PARTITIONED BY (p) LOCATION '{lake}/t'")
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.hash("id") % 1000).cast("int").alias("v"),
        F.concat(F.lit("n"), F.hash("id") % 100).alias("s"), F.col("id"),
        (F.col("id") % 2).cast("string").alias("p"))
    insert_partitions(df.repartition(8, "id"), f"{database}.t", rebalance=False)
    return f"{database}.t"


def files_of(spark, name, value):
    return sorted(r[0] for r in spark.table(name).filter(F.col("p") == value).select("_metadata.file_path").distinct().collect())


def test_compaction_keeps_rows_and_siblings(spark, lake, scattered):
    before = sorted(rows(spark.table(scattered)))
    sibling = files_of(spark, scattered, "1")
    assert compact(spark, scattered, {"p": "0"}) == 1
    assert len(files_of(spark, scattered, "0")) == 1 and files_of(spark, scattered, "1") == sibling
    assert sorted(rows(spark.table(scattered))) == before
    assert not os.path.exists(f"{lake}/t/p=0")
    once = files_of(spark, scattered, "0")
    assert compact(spark, scattered, {"p": "0"}) == 1
    assert files_of(spark, scattered, "0") == once  # nothing to gain, nothing rewritten
    # Writes find the partition where it is now, and its folder goes with it.
    insert_partitions(spark.table(scattered).filter("p = '0'").limit(5), scattered, mode="append", static={"p": "0"})
    assert spark.table(scattered).count() == len(before) + 5
    insert_partitions(spark.table(scattered).filter("p = '1'").limit(3).withColumn("p", F.lit("0")), scattered)
    assert spark.table(scattered).filter("p = '0'").count() == 3 and files_of(spark, scattered, "1") == sibling
    folder = partition_location(spark, scattered, {"p": "0"})
    assert drop_table_partitions(spark, scattered, "p", lambda v: v == "0") == ["0"]
    assert not filesystem.exists(spark, folder) and spark.table(scattered).count() == 2000


def test_compaction_does_not_shuffle(spark, scattered, monkeypatch):
    plans = []
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (plans.append(plan_of(self._df)), real(self, *a, **k))[1])
    compact(spark, scattered, {"p": "0"})
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Coalesce" in plans[0]


def test_compaction_of_nothing(spark, scattered):
    assert compact(spark, scattered, {"p": "9"}) == 0
    with pytest.raises(ValueError, match="name one partition"):
        compact(spark, scattered)


def ranges(spark, name, column):
    part = spark.table(name).filter("p = '0'")
    return sorted(r[1:] for r in rows(part.groupBy("_metadata.file_path").agg(F.min(column), F.max(column))))


def size_of(spark, name):
    return filesystem.size_in_bytes(spark, partition_location(spark, name, {"p": "0"}))


def test_clustering_makes_ranges(spark, scattered):
    before, size = sorted(rows(spark.table(scattered))), size_of(spark, scattered)
    compact(spark, scattered, {"p": "0"}, cluster_by=["v"], target_bytes=size // 6)
    found = ranges(spark, scattered, "v")
    assert len(found) > 3
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    # The value that fills a third of the rows is not confined to one file.
    assert sum(low <= 7 <= high for low, high in found) > 1
    assert sorted(rows(spark.table(scattered))) == before


def test_clustering_by_two_columns(spark, scattered):
    before, size = sorted(rows(spark.table(scattered))), size_of(spark, scattered)
    compact(spark, scattered, {"p": "0"}, cluster_by=["id", "s"], target_bytes=size // 8)
    assert sorted(rows(spark.table(scattered))) == before
    spread = [b - a for a, b in ranges(spark, scattered, "id")]
    assert sum(spread) / len(spread) < 3500  # files cover parts of the range, not all of it


def test_zorder_key_interleaves(spark):
    df = spark.sql("SELECT * FROM VALUES (0, 0), (0, 3), (3, 0), (3, 3), (NULL, 1) AS t(a, b)")
    keys = [r[0] for r in df.select(zorder_key(df, ["a", "b"], bits=2)).collect()]
    assert keys == [0b0000, 0b1000, 0b0001, 0b1001, 0b0010]
    kinds = spark.sql("SELECT DATE'2024-01-01' d, TIMESTAMP'2024-01-01 00:00:00' t, 'b' s, 1.5 n"
                      " UNION ALL SELECT DATE'2024-01-02', TIMESTAMP'2024-01-02 00:00:00', 'bc', 2.5")
    assert sorted(r[0] for r in kinds.select(
        zorder_key(kinds, ["d", "t", "s", "n"], bits=1)).collect()) == [0, 15]
    with pytest.raises(ValueError, match="62"):
        zorder_key(kinds, ["d", "t", "s", "n"], bits=16)


def test_zorder_key_ranks_whole_values(spark):
    """Texts with a common start, a number with an outlier, more than five columns."""
    df = spark.range(4000).selectExpr(
        "concat('https://example.org/', id % 7) AS s", "if(id = 0, 1e18, id) AS n", "id AS a", "id % 3 AS b", "-id AS c", "'x' AS d")
    for name, least in (("s", 6), ("n", 50)):
        sizes = [r["count"] for r in df.groupBy(zorder_key(df, [name]).alias("k")).count().collect()]
        assert len(sizes) >= least and max(sizes) < 4000 / 4
    assert df.select(zorder_key(df, ["s", "n", "a", "b", "c", "d"]).alias("k")).distinct().count() > 100


def test_zorder_key_of_repeated_values(spark):
    """Each pair of few values has a key of its own, however the values hash."""
    for x, y in ((3, 7), (7, 12)):
        df = spark.range(5000).selectExpr(f"id % {x} AS n", f"concat('text ', id % {y}) AS s", "id")
        assert df.select(zorder_key(df, ["n", "s"]).alias("k")).distinct().count() == x * y


MOMENTS = {"before the write": ("write", 0), "after the write": ("list", 2), "before the pointer": ("point", 0),
           "after the pointer": ("pointed", 0), "in the last look": ("list", 3)}


@pytest.mark.parametrize("moment", MOMENTS)
def test_compaction_loses_no_rows_added_meanwhile(spark, lake, database, monkeypatch, moment):
    """A writer between any two steps: its rows are kept, whether the rewrite ends or gives up."""
    from reviewlake.sinks import maintenance

    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (id BIGINT) USING parquet LOCATION '{lake}/t'")
    spark.range(1000, numPartitions=8).write.mode("append").insertInto(f"{database}.t")
    step, number = MOMENTS[moment]
    listing, pointing, arranging = maintenance._data_files, maintenance.point_to, maintenance.version_folder
    looks = []

    def add():  # by a writer that knows the old folder
        spark.range(1000, 1100, numPartitions=1).write.mode("append").parquet(f"{lake}/t")

    def list_files(session, folder):
        looks.append(folder)
        if step == "list" and len(looks) == number:
            add()
        return listing(session, folder)

    def point(session, table, partition, folder):
        if step == "point":
            add()
        pointing(session, table, partition, folder)
        if step == "pointed":
            add()

    def arrange(*args):
        if step == "write":
            add()
        return arranging(*args)

    monkeypatch.setattr(maintenance, "_data_files", list_files)
    monkeypatch.setattr(maintenance, "point_to", point)
    monkeypatch.setattr(maintenance, "version_folder", arrange)
    if moment in ("before the write", "after the write"):
        with pytest.raises(RuntimeError, match="changed"):
            compact(spark, f"{database}.t")
    else:
        assert compact(spark, f"{database}.t") == 1
    spark.catalog.refreshTable(f"{database}.t")
    assert sorted(r[0] for r in spark.table(f"{database}.t").collect()) == list(range(1100))


def test_a_partition_replaced_during_compaction_stays_replaced(spark, lake, scattered, monkeypatch):
    from reviewlake.sinks import maintenance

    pointing, done = maintenance.point_to, []

    def point(session, table, partition, folder):
        if not done:
            done.append(spark.createDataFrame([(1, "new", 5)], "v INT, s STRING, id BIGINT").write.mode("overwrite").parquet(f"{lake}/t/p=0"))
        pointing(session, table, partition, folder)

    monkeypatch.setattr(maintenance, "point_to", point)
    with pytest.raises(RuntimeError, match="replaced"):
        compact(spark, scattered, {"p": "0"})
    spark.catalog.refreshTable(scattered)
    assert rows(spark.table(scattered).filter("p = '0'")) == [(1, "new", 5, "0")]


def test_a_move_does_not_nest(spark, lake):
    for name in "ab":
        os.makedirs(f"{lake}/{name}")
    with pytest.raises(FileExistsError):
        filesystem.move(spark, f"{lake}/a", f"{lake}/b")
    filesystem.move(spark, f"{lake}/a", f"{lake}/c")
    assert sorted(os.listdir(lake)) == ["b", "c"]


def test_inner_and_escaped_partitions_are_dropped(spark, lake, database):
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (id INT, day STRING, app STRING) USING parquet "
              f"PARTITIONED BY (day, app) LOCATION '{lake}/t'")
    data = spark.createDataFrame([(1, "d:1", "a'b"), (2, "d:1", "c"), (3, "d2", "a'b")], "id INT, day STRING, app STRING")
    insert_partitions(data, f"{database}.t")
    assert compact(spark, f"{database}.t", {"day": "d:1", "app": "c"}) == 1
    assert drop_table_partitions(spark, f"{database}.t", "app", lambda v: v == "a'b") == ["a'b"]
    spark.sql(f"MSCK REPAIR TABLE {database}.t")
    assert [r.id for r in spark.table(f"{database}.t").collect()] == [2]
    assert drop_table_partitions(spark, f"{database}.t", "day", lambda v: v == "d:1") == ["d:1"]
    assert spark.table(f"{database}.t").count() == 0


def test_full_write_keeps_the_declaration(spark, lake, database):
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (id BIGINT COMMENT 'the id', part STRING) USING parquet "
              f"PARTITIONED BY (part) LOCATION '{lake}/t'")
    for n in (3, 2):
        assert write_full(spark.range(n).selectExpr("string(id) AS part", "id"), f"{database}.t")
        assert sorted(map(tuple, spark.table(f"{database}.t").collect())) == [(i, str(i)) for i in range(n)]
    assert [r.comment for r in spark.sql(f"DESCRIBE {database}.t").collect() if r.col_name == "id"] == ["the id"]
    assert len(spark.sql(f"SHOW PARTITIONS {database}.t").collect()) == 2
    assert write_full(spark.range(1).selectExpr("id", "'x' AS other"), f"{database}.t")
    assert spark.table(f"{database}.t").columns == ["id", "other"]


def test_purge_and_retention(spark, lake):
    days = ["2024-01-01", "2024-01-02", "2024-01-30", "2024-01-31"]
    write_partitions(spark.createDataFrame(list(enumerate(days)), DAYS), lake)
    assert drop_partitions(spark, lake, "date_load", lambda d: d == "2024-01-30") == ["2024-01-30"]
    assert retain_days(spark, lake, date(2024, 1, 31), 29) == ["2024-01-01"]
    assert content(spark, lake) == [(1, "2024-01-02"), (3, "2024-01-31")]


def test_table_partitions_are_dropped_with_their_files(spark, lake, database):
    name = create_table(spark, database, "t", TABLES["internal_reviews"], f"{lake}/t")
    columns = {c: F.lit(None) for c in spark.table(name).columns if c != "date_load"}
    for day in ("d1", "d2"):
        insert_partitions(
            spark.range(1).select(F.lit(day).alias("date_load")).withColumns(columns), name)
    drop_table_partitions(spark, name, "date_load", lambda d: d == "d1")
    assert [r.date_load for r in spark.table(name).collect()] == ["d2"]
    assert os.listdir(f"{lake}/t").count("date_load=d1") == 0


def test_purge_takes_what_finished_runs_have_read(spark, lake):
    day, manifest, metrics = f"{lake}/raw/d1", f"{lake}/manifest", f"{lake}/metrics"
    for app in "abc":
        os.makedirs(f"{day}/{app}/deep")
        for name in ("1.json", "deep/2 x.json", "_SUCCESS"):
            with open(f"{day}/{app}/{name}", "w") as file:
                file.write(app)

    def run(app, flow="app", record=True, run_day="d1"):
        run_id = new_run_id()
        append_manifest(list_files(spark, [f"{day}/{app}"]), manifest, run_id)
        if record:
            rows_ = spark.range(0).agg(F.count("*").alias("total_records"))
            append_metrics(output_check_metrics(rows_, owner_of("d", "p", "bronze", "raw"), flow, utc_now(), utc_now())
                           .withColumn("run_day", F.lit(run_day)), metrics, run_id)

    def purge(**chosen):
        return purge_loaded(spark, [day, f"{lake}/nowhere"], manifest=spark.read.parquet(manifest),
                            metrics=spark.read.parquet(metrics), **chosen)

    run("a")
    run("b", record=False)  # failed
    run("nothing")  # a record of no rows
    run("c", flow="other", run_day="d2")
    with open(f"{day}/a/late.json", "w") as file:
        file.write("late")
    os.utime(f"{day}/a/1.json", (1, 1))  # written again since
    assert purge(day="d1", flows=["other"]) == 0
    assert purge(day="d1", flows=["app"]) == 1
    left = {os.path.relpath(f, day) for f in glob.glob(f"{day}/**/*.json", recursive=True)}
    assert left == {"a/1.json", "a/late.json", "b/1.json", "b/deep/2 x.json", "c/1.json", "c/deep/2 x.json"}
    assert not os.path.exists(f"{day}/a/deep")
    run("a")
    assert purge() == 4
    assert sorted(os.listdir(day)) == ["b"]


def test_bad_values_are_refused_or_counted(spark, lake, database):
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (n INT, d DATE, s STRING) USING parquet LOCATION '{lake}/t'")
    rows_ = spark.createDataFrame([("1", "2024-01-01", "a"), ("x", None, "b"), (None, "y", "c"), ("99999999999", "z", "d")], "n STRING, d STRING, s STRING")
    with pytest.raises(PySparkException, match="t.n cannot hold|t.d cannot hold"):
        insert_partitions(rows_, f"{database}.t")
    assert spark.table(f"{database}.t").isEmpty()
    seen = insert_partitions(rows_, f"{database}.t", on_bad="count", measure={"rows": F.count("*")})
    assert seen == {"rows": 4, "lossy": {"n": 2, "d": 2}}
    assert spark.table(f"{database}.t").filter("n is not null").count() == 1
    with pytest.raises(ValueError, match="unknown treatment"):
        insert_partitions(rows_, f"{database}.t", on_bad="drop")


def test_own_rows_of_runs(spark, lake, database):
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (id BIGINT) USING parquet LOCATION '{lake}/t'")
    runs = [new_run_id(), new_run_id()]
    for run, n in zip(runs, (3, 5)):
        insert_partitions(spark.range(n), f"{database}.t", mode="append", run_id=run)
    assert [own_rows(spark.table(f"{database}.t"), run).count() for run in runs] == [3, 5]


def test_full_write_leaves_no_gap(spark, lake, database, monkeypatch):
    """A reader between any two steps sees rows, of the old table or of the new one; comments are kept."""
    from reviewlake.sinks import full

    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (id BIGINT COMMENT 'the id', part STRING) USING parquet "
              f"PARTITIONED BY (part) COMMENT 'a table' LOCATION '{lake}/t'")
    name, seen = f"{database}.t", []

    def look():
        spark.catalog.refreshTable(name)
        seen.append(spark.table(name).count())

    point, written, delete = full.point_to, full._written, filesystem.delete
    monkeypatch.setattr(full, "point_to", lambda *a: (look(), point(*a), look()))
    monkeypatch.setattr(full, "_written", lambda *a: (look(), written(*a), look()))
    monkeypatch.setattr(filesystem, "delete", lambda *a: (look(), delete(*a))[1])
    write_full(spark.range(6).selectExpr("id", "string(id % 2) AS part"), name)
    seen.clear()
    write_full(spark.range(8).selectExpr("id", "string(id % 2 + 1) AS part"), name)
    assert len(seen) > 4 and all(3 <= n <= 14 for n in seen)
    assert sorted(map(tuple, spark.table(name).collect())) == sorted((i, str(i % 2 + 1)) for i in range(8))
    write_full(spark.range(2).selectExpr("id", "id * 2 AS twice", "'a' AS part"), name)
    told = {r.col_name: (r.data_type, r.comment) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert told["id"] == ("bigint", "the id") and told["Comment"][0] == "a table"
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["part=a"]
    assert sorted(map(tuple, spark.table(name).collect())) == [(0, 0, "a"), (1, 2, "a")]


def test_tables_gain_columns(spark, lake, database):
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}/db'")
    spark.sql(f"CREATE TABLE {database}.t (id BIGINT, p STRING) USING parquet PARTITIONED BY (p) LOCATION '{lake}/t'")
    insert_partitions(spark.range(1).selectExpr("id", "'a' AS p"), f"{database}.t")
    wider = spark.range(1).selectExpr("id", "'n' AS note", "struct(id) AS more", "'b' AS p")
    assert evolve_table(spark, f"{database}.t", wider.schema) == ["note", "more"]
    assert evolve_table(spark, f"{database}.t", wider.schema) == []
    insert_partitions(wider, f"{database}.t")
    assert sorted(map(tuple, spark.table(f"{database}.t").select("p", "note").collect())) == [("a", None), ("b", "n")]


def test_folded_days_keep_their_records(spark, lake):
    path = f"{lake}/metrics"
    for run in range(4):
        append_metrics(spark.createDataFrame([(run, f"d{run % 2}"), (run + 10, f"d{run % 2}")], "n INT, run_day STRING"), path, f"run-{run}")
    want = sorted(rows(read_metrics(spark, path).select("n", "run_day", "run_id")))
    shutil.copytree(f"{path}/run_batch=run-0", f"{lake}/kept")
    assert fold_metrics(spark, path, "d0") == 2 and fold_metrics(spark, path, "d9") == 0
    assert sorted(rows(read_metrics(spark, path).select("n", "run_day", "run_id"))) == want
    # A fold that died before it could delete a run's own folder.
    shutil.copytree(f"{lake}/kept", f"{path}/run_batch=run-0")
    assert sorted(rows(read_metrics(spark, path).select("n", "run_day", "run_id"))) == want
    append_metrics(spark.createDataFrame([(7, "d0")], "n INT, run_day STRING"), path, "run-7")
    assert fold_metrics(spark, path, "d0") == 2 and fold_metrics(spark, path, "d1") == 2
    assert sorted(rows(read_metrics(spark, path).select("n", "run_day", "run_id"))) == sorted([*want, (7, "d0", "run-7")])
    assert len([n for n in os.listdir(path) if "=" in n]) == 3


def test_partition_writes_do_not_sort_whole_tasks(spark, lake):
    from reviewlake.session import write_sizing
    spark.sql(f"CREATE TABLE unsorted (v BIGINT, p STRING) USING parquet PARTITIONED BY (p) LOCATION '{lake}/unsorted'")
    try:
        with write_sizing(spark):
            plan = spark.sql("EXPLAIN INSERT OVERWRITE unsorted SELECT id, CAST(id % 3 AS STRING) FROM range(9)").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
    finally:
        spark.sql("DROP TABLE unsorted")


def test_a_task_with_more_partitions_than_open_files_loses_no_row(spark, lake):
    many = spark.range(0, 1000, 1, 1).withColumn("p", (F.col("id") % 37).cast("string"))
    for kind in ("json", "parquet"):
        write_partitions(many, f"{lake}/{kind}", ["p"], file_format=kind, rebalance=False)
        back = spark.read.schema("id BIGINT, p STRING").format(kind).load(f"{lake}/{kind}")
        assert sorted(rows(back)) == sorted(rows(many))


def test_feed_pages_are_gathered_in_one_pass(spark, lake, sf_dir, monkeypatch):
    from reviewlake.checks import flows
    monkeypatch.setattr(flows, "TASK_REVIEWS", 10)
    pages = spark.read.text(flows._pages(spark, sf_dir, lake), recursiveFileLookup=True)
    whole = pages.filter(F.get_json_object("value", "$.feed.entry[0].id.label").isNotNull())
    texts = whole.select(F.size(F.from_json(F.get_json_object("value", "$.feed.entry"), "array<string>")).alias("n"))
    assert texts.agg(F.sum("n")).first()[0] == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert pages.filter("length(value) = 90").count() > 0


@pytest.mark.parametrize("starts", [[5.0], [1.0, 2.5, 7.0], [-3.0, 0.0, float("nan")], [float(n) for n in range(0, 510, 2)]])
def test_ranges_are_found_by_halving(spark, starts):
    from reviewlake.sinks.maintenance import _reached
    array = F.array(*[F.lit(s) for s in starts])
    values = spark.createDataFrame([(float(v),) for v in (*range(-5, 520), 2.5, "inf", "-inf", "nan")], "v DOUBLE")
    found = values.select(_reached(array, F.col("v"), 256).alias("ours"),
                          F.size(F.filter(array, lambda start: start <= F.col("v"))).alias("counted"))
    assert found.filter("ours <> counted or ours is null").count() == 0


def test_zorder_key_does_not_walk_all_ranges(spark, lake):
    spread = spark.range(1000).select("id", (F.col("id") % 97).alias("v"))
    plan = plan_of(spread.select(zorder_key(spread, ["id", "v"])))
    assert "aggregate(" in plan and "filter(" not in plan


def test_two_partition_columns_are_written_without_a_sort_of_rows(spark, lake):
    """As purge_app writes its table."""
    from reviewlake.session import write_sizing
    spark.sql(f"CREATE TABLE pairs (v BIGINT, p STRING, q STRING) USING parquet PARTITIONED BY (p, q) LOCATION '{lake}/pairs'")
    try:
        with write_sizing(spark):
            plan = spark.sql("EXPLAIN INSERT OVERWRITE pairs SELECT id, CAST(id % 3 AS STRING), CAST(id % 2 AS STRING) FROM range(9)").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
    finally:
        spark.sql("DROP TABLE pairs")


def test_one_day_of_several_apps_is_written_without_a_sort_of_rows(spark, lake):
    """As bronze_external loads all apps of a day."""
    from reviewlake.session import write_sizing
    spark.sql(f"CREATE TABLE day_apps (v BIGINT, day STRING, app STRING) USING parquet PARTITIONED BY (day, app) LOCATION '{lake}/day_apps'")
    try:
        with write_sizing(spark):
            plan = spark.sql("EXPLAIN INSERT OVERWRITE day_apps SELECT id, '2024-02-10', CAST(id % 3 AS STRING) FROM range(9)").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
    finally:
        spark.sql("DROP TABLE day_apps")


_SIX_IN_ONE_TASK = """
import sys
from pyspark.sql import SparkSession, functions as F
from reviewlake.sinks import insert_partitions
events, root = sys.argv[1:]
conf = {"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "1", "spark.driver.host": "127.0.0.1",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.sql.warehouse.dir": root}
spark = SparkSession.builder.config(map=conf).getOrCreate()
spark.sql(f"CREATE TABLE six (v BIGINT, p STRING, q STRING) USING parquet PARTITIONED BY (p, q) LOCATION '{root}/six'")
v = spark.range(0, 200_000, 1, 2)
insert_partitions(v.select(F.col("id").alias("v"), (v.id % 3).cast("string").alias("p"), (v.id % 2).cast("string").alias("q")), "six")
assert spark.table("six").count() == 200_000 and spark.table("six").select("p", "q").distinct().count() == 6
"""


def test_six_partitions_in_one_task_take_no_sorter(lake):
    """As many as purge_app's table has. The sorter of a writing task shows in the on-heap peak only."""
    events = f"{lake}/events"
    os.makedirs(events)
    subprocess.run([sys.executable, "-c", _SIX_IN_ONE_TASK, events, lake], check=True, timeout=300, cwd=lake,
                   env=os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))})
    with open(f"{events}/{os.listdir(events)[0]}") as log:
        ends = [e["Task Metrics"] for e in map(json.loads, log) if e["Event"] == "SparkListenerTaskEnd"]
    writing = [m for m in ends if m["Output Metrics"]["Records Written"]]
    assert [m["Output Metrics"]["Records Written"] for m in writing] == [200_000]
    assert writing[0]["Peak On Heap Execution Memory"] == 0
