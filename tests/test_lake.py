"""Table discovery, the SQL-file runner and publishing."""

import zlib
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.plans import sqlfile
from tidemark.session import scratch_path, shared_dir
from tidemark.sources import lake as lakes
from tidemark.sources.topic import FileSource, in_user_order, keyed, publish, topic_partition, with_offsets
from tidemark.schemas import CURATED, TOPIC_SCHEMA
from tidemark.sources import sample

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def warehouse(spark):
    path = scratch_path(spark, "files")
    rows = spark.createDataFrame(
        [(1, "x", date(2026, 5, 1)), (2, None, date(2026, 5, 2))], "id INT, name STRING, d DATE"
    )
    rows.write.partitionBy("d").parquet(f"{path}/b_table/data")
    timed = rows.select("id", F.lit("2026-04-24 17:29:57.405344").cast("timestamp").alias("t"))
    timed.write.parquet(f"{path}/a_table/data/deep/er")
    spark.range(1).write.parquet(f"{path}/no_table/other")
    return path


def sql(spark, text):
    path = f"{scratch_path(spark, 'sql')}/q.sql"
    spark.createDataFrame([(text,)], "line STRING").coalesce(1).write.text(path)
    return path


def test_discovery(spark, warehouse):
    assert lakes.discover_tables(spark, warehouse) == ["a_table", "b_table"]
    with pytest.raises(FileNotFoundError):
        lakes.discover_tables(spark, f"{warehouse}/nowhere")
    with pytest.raises(FileNotFoundError):
        lakes.discover_tables(spark, f"{warehouse}/b_table/data")


def test_load(spark, warehouse):
    table = lakes.load_table(spark, warehouse, "b_table")
    assert dict(table.dtypes) == {"id": "int", "name": "string", "d": "date"}
    assert lakes.load_table(spark, warehouse, "a_table", recursive=True).count() == 2
    with pytest.raises(FileNotFoundError):
        lakes.load_table(spark, warehouse, "c_table")


def test_registering_all_skips_empty_tables(spark, warehouse):
    spark.range(0).write.json(f"{warehouse}/empty/data")
    deep = [n for n in lakes.register_tables(spark, warehouse)]
    assert "b_table" in deep and "empty" not in deep
    with pytest.raises(FileNotFoundError):
        lakes.register_tables(spark, warehouse, ["b_table", "empty"])


def test_evolved_tables_keep_all_columns(spark):
    path = scratch_path(spark, "evolved")
    spark.range(2).selectExpr("id a", "1 d").write.partitionBy("d").parquet(f"{path}/t/data")
    later = spark.range(2).selectExpr("id a", "'x' b", "2 d")
    later.write.mode("append").partitionBy("d").parquet(f"{path}/t/data")
    rows = lakes.load_table(spark, path, "t")
    assert set(rows.columns) == {"a", "b", "d"} and rows.where("b is null").count() == 2


def test_named_tables(spark):
    text = "-- from c\nselect 'd', \"e\" from a /* f */ join `B` on true"
    assert sqlfile.named_tables(spark, text, ["a", "b", "c", "d", "e", "f"]) == ["a", "b"]


RELATIONS = {
    "select orders from late l join `my table` m on l.orders = m.orders": ["late", "my table"],
    "with late as (select * from late), x as (select * from late) select * from x join base on true": ["late", "base"],
    "select (select max(v) from inner_one) from outer_one where k in (select k from third)": ["inner_one", "outer_one", "third"],
    "with x as (with y as (select * from deep) select * from y) select * from x, y": ["deep", "y"],
    "select * from db.t union all select 'from not' from (values (1)) v": ["t"],
    "select 1": [],
}


@pytest.mark.parametrize("text", RELATIONS)
def test_relations(spark, text):
    assert sqlfile.relations(spark, text) == RELATIONS[text]


def test_noted_columns_are_what_folder_readers_get(spark, lake):
    """Columns of the contract and those added later, without a look into every file."""
    curated = lake.name(CURATED)
    rows = spark.sql("select 'a' event_id, date'2026-05-01' event_date")
    tables.append(rows, curated)
    spark.sql(f"ALTER TABLE {curated} ADD COLUMNS (mood STRING)")
    tables.append(rows.selectExpr("'b' event_id", "event_date", "'glad' mood"), curated)
    warehouse = tables.layout(spark, curated).location.rsplit("/", 2)[0]
    seen = lakes.load_table(spark, warehouse, CURATED.name)
    assert seen.columns == [c for c in CURATED.columns if c != "event_date"] + ["mood", "event_date"]
    assert {(r.event_id, r.mood) for r in seen.collect()} == {("a", None), ("b", "glad")}
    found, _ = sqlfile.run_sql_file(spark, None, sql(spark, f"SELECT * FROM {CURATED.name}"), output=f"{warehouse}/out", database=lake.database)
    assert set(found.columns) == set(seen.columns)


def test_catalog_tables(spark, warehouse):
    spark.sql("CREATE DATABASE IF NOT EXISTS reports")
    spark.range(3).write.mode("overwrite").saveAsTable("reports.numbers")
    rows, output = sqlfile.run_sql_file(
        spark, None, sql(spark, "SELECT sum(id) s FROM numbers"), output=f"{warehouse}/out", database="reports"
    )
    assert spark.read.option("header", True).csv(output).collect()[0].s == "3"
    assert spark.catalog.currentDatabase() == "default"


def test_a_user_leaves_in_order(spark):
    events = sample.ad_events(spark, SMALL)
    placed = in_user_order(keyed(events, 3)).select(
        "user_id", "event_timestamp", F.monotonically_increasing_id().alias("n")
    )
    rows = sorted((r.n, r.user_id, r.event_timestamp) for r in placed.collect())
    last, tasks = {}, defaultdict(set)
    for n, user, moment in rows:
        assert last.get(user, moment) <= moment
        last[user] = moment
        tasks[user].add(n >> 33)
    assert all(len(t) == 1 for t in tasks.values())


def test_result_name(spark, warehouse):
    join = "SELECT count(*) n FROM range(3) o JOIN b_table b ON true"
    assert sqlfile.run_sql_file(spark, warehouse, sql(spark, join))[1].endswith("/b_table_output.csv")
    first = sorted(lakes.discover_tables(spark, warehouse))[0]
    assert sqlfile.run_sql_file(spark, warehouse, sql(spark, "SELECT 1 one"))[1].endswith(f"/{first}_output.csv")


def test_run_saves_csv(spark, warehouse):
    file = sql(spark, "SELECT id, name, d FROM b_table ORDER BY id;")
    result, output = sqlfile.run_sql_file(spark, warehouse, file, ["b_table"])
    assert output == file.rpartition("/")[0] + "/b_table_output.csv"
    lines = [r[0] for r in spark.read.text(output).collect()]
    assert lines == ["id,name,d", "1,x,2026-05-01", "2,,2026-05-02"] and result.count() == 2
    assert not spark.catalog.tableExists("b_table")


def test_csv_timestamps_keep_micros_and_zone(spark):
    out = scratch_path(spark, "csv")
    row = spark.range(1).coalesce(1).select(F.lit("2026-04-24 17:29:57.405344").cast("timestamp").alias("t"))
    sqlfile.write_csv(row, out)
    assert [r[0] for r in spark.read.text(out).collect()] == ["t", "2026-04-24 17:29:57.405344+00:00"]


def test_sql_errors(spark, warehouse):
    with pytest.raises(ValueError, match="empty"):
        sqlfile.read_sql(spark, sql(spark, "  ;"))
    with pytest.raises(FileNotFoundError):
        sqlfile.read_sql(spark, f"{warehouse}/none.sql")


def test_partition_is_crc32_of_the_key(spark):
    keys = [f"user-{i}" for i in range(50)]
    rows = spark.createDataFrame([(k,) for k in keys], "k STRING")
    seen = rows.select("k", topic_partition(F.col("k").cast("binary"), 7).alias("p")).collect()
    assert all(r["p"] == zlib.crc32(r["k"].encode()) % 7 for r in seen)


def test_offsets_against_brute_force(spark):
    """One topic partition holds almost everything; it is still numbered by many tasks."""
    rows = spark.range(20_000).repartition(6).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 3).otherwise(1).cast("int").alias("partition"),
        (F.xxhash64("id") % 1000).alias("t"),
        "id",
    )
    found = with_offsets(rows, ("t", "id")).collect()
    groups = defaultdict(list)
    for r in found:
        groups[r["partition"]].append((r["t"], r["id"], r["offset"]))
    assert sum(map(len, groups.values())) == 20_000
    for members in groups.values():
        assert [o for _, _, o in sorted(members)] == list(range(len(members)))


def test_publish_to_files(spark):
    path = scratch_path(spark, "topic")
    publish(sample.ad_events(spark, SMALL), FileSource(path), partitions=4)
    records = spark.read.parquet(path)
    assert records.columns == TOPIC_SCHEMA.fieldNames()
    ends = records.groupBy("topic", "partition").agg(F.max("offset").alias("m"), F.count("*").alias("n")).collect()
    assert all(r["m"] == r["n"] - 1 for r in ends) and sum(r["n"] for r in ends) == 1000


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or shared_dir(spark)).rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
