"""Upsert, replace, delete, evolve and align on plain Parquet tables."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.schemas import CURATED, METRICS, RAW, TableSpec
from tidemark.session import scratch_path

SPEC = TableSpec("t", "k STRING, v INT, d DATE", ("k",), "d")
START = [("a", 1, 1), ("b", 1, 2), ("c", 1, 3)]
CHANGE = [("a", 2, 2), ("n", 2, 4)]
AFTER = [("a", 2, 2), ("b", 1, 2), ("c", 1, 3), ("n", 2, 4)]


def frame(spark, rows):
    data = [(k, v, date(2026, 5, d) if d else None) for k, v, d in rows]
    return spark.createDataFrame(data, "k STRING, v INT, d DATE")


def content(warehouse):
    rows = warehouse.read(SPEC).collect()
    return sorted(((r["k"], r["v"], r["d"].day if r["d"] else None) for r in rows), key=str)


def days(warehouse):
    return sorted(r[0].day for r in warehouse.read(SPEC).select("d").distinct().collect())


@pytest.fixture
def table(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    warehouse = tables.create_tables(spark, name, scratch_path(spark, "lake"), (SPEC,))
    tables.append(frame(spark, START), warehouse.name(SPEC))
    return warehouse


def test_upsert_moves_rows_and_clears_partitions(spark, table):
    result = tables.upsert(frame(spark, CHANGE), table.name(SPEC), SPEC.key)
    assert content(table) == AFTER and days(table) == [2, 3, 4]
    assert result.rows == 2 and result.cleared == ((date(2026, 5, 1),),)
    again = tables.upsert(frame(spark, CHANGE), table.name(SPEC), SPEC.key)
    assert content(table) == AFTER and set(again.rewritten) == {(date(2026, 5, 2),), (date(2026, 5, 4),)}


def test_upsert_rewrites_only_partitions_with_matches(spark, table):
    before = set(table.read(SPEC).where("d = '2026-05-03'").inputFiles())
    fresh = tables.upsert(frame(spark, [("x", 9, 2)]), table.name(SPEC), SPEC.key)
    assert fresh.rewritten == ()
    tables.upsert(frame(spark, [("b", 5, 2)]), table.name(SPEC), SPEC.key, partition_follows_key=True)
    assert set(table.read(SPEC).where("d = '2026-05-03'").inputFiles()) == before
    assert content(table) == [("a", 1, 1), ("b", 5, 2), ("c", 1, 3), ("x", 9, 2)]


def test_match_condition_bounds_the_lookup(spark, table):
    """The caller's word is taken: rows outside the condition are not looked at."""
    recent = F.col("d") >= F.lit(date(2026, 5, 2))
    result = tables.upsert(frame(spark, [("b", 9, 3)]), table.name(SPEC), SPEC.key, match_where=recent)
    assert result.rewritten == ((date(2026, 5, 2),),)
    assert content(table) == [("a", 1, 1), ("b", 9, 3), ("c", 1, 3)] and days(table) == [1, 3]


def test_existing_files_are_found_by_a_new_catalog_entry(spark):
    place, rows = scratch_path(spark, "lake"), frame(spark, START)
    first = tables.create_tables(spark, f"db_{uuid.uuid4().hex[:8]}", place, (SPEC,))
    tables.append(rows, first.name(SPEC))
    second = tables.create_tables(spark, f"db_{uuid.uuid4().hex[:8]}", place, (SPEC,))
    assert content(second) == sorted(START)


def test_null_keys_never_match(spark, table):
    tables.append(frame(spark, [(None, 1, 1)]), table.name(SPEC))
    tables.upsert(frame(spark, [(None, 2, 1), (None, 3, 1), ("a", 2, 1)]), table.name(SPEC), SPEC.key)
    assert content(table) == sorted(
        [("a", 2, 1), ("b", 1, 2), ("c", 1, 3), (None, 1, 1), (None, 2, 1), (None, 3, 1)], key=str
    )


def test_null_partition_is_kept(spark, table):
    tables.append(frame(spark, [("z", 1, None), ("y", 1, None)]), table.name(SPEC))
    tables.upsert(frame(spark, [("z", 2, None)]), table.name(SPEC), SPEC.key)
    assert content(table)[-2:] == [("y", 1, None), ("z", 2, None)]
    tables.upsert(frame(spark, [("z", 3, 9), ("y", 3, 9)]), table.name(SPEC), SPEC.key)
    assert content(table)[-2:] == [("y", 3, 9), ("z", 3, 9)] and len(content(table)) == 5


@pytest.mark.parametrize("listed", [500, 0])
def test_new_rows_without_a_partition_are_kept_beside_replaced_ones(spark, table, monkeypatch, listed):
    monkeypatch.setattr(tables, "LISTED_PARTITIONS", listed)
    change = [("a", 2, 1), ("z", 2, None), ("n", 2, 9), ("b", 2, 8)]
    for _ in range(2):
        tables.upsert(frame(spark, change), table.name(SPEC), SPEC.key)
        assert content(table) == sorted([("a", 2, 1), ("b", 2, 8), ("c", 1, 3), ("n", 2, 9), ("z", 2, None)], key=str)


def test_repeated_keys_and_empty_source(spark, table):
    with pytest.raises(ValueError, match="several rows"):
        tables.upsert(frame(spark, [("a", 2, 1), ("a", 3, 2)]), table.name(SPEC), SPEC.key)
    assert tables.upsert(frame(spark, []), table.name(SPEC), SPEC.key).rows == 0
    assert content(table) == sorted(START)


def test_half_finished_upsert_is_completed_by_running_it_again(spark, table):
    """The append of new partitions went through, the rewrite of old ones did not."""
    tables.append(frame(spark, [("n", 2, 4)]), table.name(SPEC))
    tables.upsert(frame(spark, CHANGE), table.name(SPEC), SPEC.key)
    assert content(table) == AFTER


def test_upsert_against_brute_force(spark, table):
    """Many keys, a third of them on one day, several rounds."""
    import random

    rng = random.Random(5)
    held = {k: (v, d) for k, v, d in START}
    for round_no in range(3):
        keys = rng.sample(range(300), 120)
        change = [(f"k{k}", round_no, 7 if rng.random() < 0.33 else rng.randint(1, 9)) for k in keys]
        tables.upsert(frame(spark, change), table.name(SPEC), SPEC.key)
        held.update({k: (v, d) for k, v, d in change})
    assert content(table) == sorted(((k, v, d) for k, (v, d) in held.items()), key=str)


def test_replace_partition(spark, table):
    day = date(2026, 5, 2)
    assert tables.replace_partition(frame(spark, [("q", 5, 2), ("r", 5, 2)]), table.name(SPEC), day) == 2
    assert content(table) == [("a", 1, 1), ("c", 1, 3), ("q", 5, 2), ("r", 5, 2)]
    assert tables.replace_partition(frame(spark, []), table.name(SPEC), day) == 0
    assert content(table) == [("a", 1, 1), ("c", 1, 3)]
    with pytest.raises(Exception, match="outside partition"):
        tables.replace_partition(frame(spark, [("q", 5, 2), ("r", 5, 3)]), table.name(SPEC), day)
    assert content(table) == [("a", 1, 1), ("c", 1, 3)]


def test_delete_partition(spark, table):
    tables.delete_partition(spark, table.name(SPEC), date(2026, 5, 2))
    assert content(table) == [("a", 1, 1), ("c", 1, 3)]


def test_evolve_adds_columns_once(spark, table):
    wider = SPEC.schema.add("w", "double")
    assert tables.add_missing_columns(spark, table.name(SPEC), wider) == ["w"]
    assert tables.add_missing_columns(spark, table.name(SPEC), wider) == []
    tables.append(frame(spark, [("e", 1, 2)]).withColumn("w", F.lit(0.5)), table.name(SPEC))
    seen = {r["k"]: r["w"] for r in table.read(SPEC).collect()}
    assert seen == {"a": None, "b": None, "c": None, "e": 0.5}


def test_align_types_missing_columns(spark):
    out = tables.align(spark.createDataFrame([("a",)], "k STRING"), SPEC.schema)
    assert out.columns == ["k", "v", "d"] and [f.dataType for f in out.schema] == [
        f.dataType for f in SPEC.schema
    ]


def test_contract_columns(lake):
    for spec in (RAW, CURATED, METRICS):
        assert lake.read(spec).columns == spec.columns
        form = tables.layout(lake.spark, lake.name(spec))
        assert (form.provider, form.partition) == ("parquet", spec.partition)
        assert form.location.endswith(f"{spec.name}/data")


def test_hot_partition_is_spread_over_files(spark, table):
    """Writing one large day must not run as a single task."""
    big = spark.range(400_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(1).alias("v"), F.lit(date(2026, 5, 8)).alias("d")
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        tables.append(big, table.name(SPEC))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(table.read(SPEC).where("d = '2026-05-08'").inputFiles()) > 1


def test_writes_without_adaptive_execution(spark, lake, monkeypatch):
    """As in a stateful stream: rows of a day still meet in few files, and a hot day is split."""
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    rows = spark.range(900).selectExpr(
        "cast(id as string) event_id", "if(id % 3 = 0, date'2026-05-01', date'2026-05-02') event_date"
    ).unionByName(spark.sql("select 'n' event_id, cast(null as date) event_date"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = tables._spread(rows.repartition(16), tables.Layout("parquet", ("event_date",)))
        placed = spread.select("event_date", F.spark_partition_id().alias("task")).distinct()
        tasks = placed.groupBy("event_date").agg(F.count("task").alias("n")).collect()
        upserted = tables.upsert(rows, lake.name(CURATED), ("event_id",))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(r.n <= 4 for r in tasks) and upserted.rows == 901
    assert spread.columns == rows.columns and spread.count() == 901
    assert lake.read(CURATED).count() == 901


def test_null_keys_of_the_target_stay(spark, lake):
    rows = spark.createDataFrame([(None, "2026-05-01"), (None, "2026-05-01"), ("a", "2026-05-01")], "event_id string, d string")
    dated = rows.selectExpr("event_id", "cast(d as date) event_date")
    tables.append(dated, lake.name(CURATED))
    tables.upsert(dated.where("event_id = 'a'"), lake.name(CURATED), ("event_id",))
    assert sorted(r.event_id or "" for r in lake.read(CURATED).collect()) == ["", "", "a"]


def test_two_catalogs_over_one_folder(spark):
    """A key that another job stored under a date this catalog has not seen is still replaced."""
    folder = scratch_path(spark, "shared")
    one, two = (
        tables.create_tables(spark, f"job_{uuid.uuid4().hex[:8]}", folder, specs=(SPEC,)) for _ in range(2)
    )
    first = spark.createDataFrame([("a", 1, date(2026, 5, 1))], SPEC.ddl)
    tables.upsert(first, one.name(SPEC), ("k",))
    tables.upsert(spark.createDataFrame([("b", 1, date(2026, 5, 2))], SPEC.ddl), two.name(SPEC), ("k",))
    tables.upsert(spark.createDataFrame([("b", 2, date(2026, 5, 2))], SPEC.ddl), one.name(SPEC), ("k",))
    files = spark.read.parquet(f"{folder}/{SPEC.name}/data")
    assert sorted((r.k, r.v) for r in files.collect()) == [("a", 1), ("b", 2)]
    again = tables.create_tables(spark, f"job_{uuid.uuid4().hex[:8]}", folder, specs=(SPEC,))  # as after a restart
    assert again.read(SPEC).count() == 2
