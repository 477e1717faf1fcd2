"""Create, evolve, upsert and replace partitioned tables.

Tables are ordinary catalog tables. Where the catalog offers row-level operations (a lakehouse
format) the operators are ``MERGE``, ``DELETE`` and ``overwrite``. Plain Parquet has none of them,
so an upsert there appends new rows and rewrites only the partitions that hold superseded ones.
Rewrites use dynamic partition overwrite: new files are staged, and the old partition is dropped
when the job commits, so the table can be read by the very job that rewrites it.

File tables may have a second partition level (a bucket of the id, an hour), so that a change rewrites a
part of a day, and Bloom filters, so that a lookup of some ids opens few row groups. Writers of one file
table take turns by a lease.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.lease import Lease, overwrite_file, read_file, writer_lease
from tidemark.schemas import ALL_TABLES, CURATED, Level, TableSpec
from tidemark.session import folder_exists, hadoop_path

FILE_FORMATS = ("parquet", "orc")
LISTED_PARTITIONS = 500  # partitions that a condition names one by one
LISTED_KEYS = 10_000  # a source with no more rows is looked up by a list of its keys
BLOOM_FALSE = "0.0001"  # share of absent keys that a filter lets pass
LEVEL_PROPERTY = "tidemark.level."
CLUSTER_PROPERTY = "tidemark.cluster"
BLOOM_PROPERTY = "tidemark.bloom"
HIDDEN_PROPERTY = "tidemark.hidden"
BOUNDED_KEY_TYPES = (T.IntegralType, T.StringType, T.TimestampType, T.DateType)


@dataclass(frozen=True)
class Warehouse:
    """Qualified names of the tables of one database."""

    spark: SparkSession
    database: str

    def name(self, spec: TableSpec) -> str:
        return f"{self.database}.{spec.name}"

    def read(self, spec: TableSpec, hidden: bool = False) -> DataFrame:
        """Table with its columns in contract order, then any added later; ``hidden`` ones on request.

        Refreshed first, as micro-batches write through sessions of their own.
        """
        self.spark.catalog.refreshTable(self.name(spec))
        table = self.spark.table(self.name(spec))
        left_out = {level.name for level in spec.levels} if hidden else spec.unseen
        extra = [c for c in table.columns if c not in spec.columns and c not in left_out]
        return table.select(*spec.columns, *extra)


@dataclass(frozen=True)
class UpsertResult:
    """Source rows, and the partitions rewritten and left empty, each as a tuple of its values."""

    rows: int
    rewritten: tuple = ()
    cleared: tuple = ()


# --- definition ----------------------------------------------------------------------------------


def create_tables(
    spark: SparkSession,
    database: str,
    location: str | None = None,
    specs: tuple[TableSpec, ...] = ALL_TABLES,
    provider: str = "parquet",
) -> Warehouse:
    """Create what is missing and add columns that older tables lack.

    With ``location`` each table keeps its files in ``<location>/<table>/data``, and files that lie
    there already become its content.
    """
    home = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {home}")
    warehouse = Warehouse(spark, database)
    for spec in specs:
        found = spark.catalog.tableExists(warehouse.name(spec))
        spark.sql(_definition(spec, warehouse.name(spec), location, provider))
        place = f"{location}/{spec.name}/data"
        if provider in FILE_FORMATS and not found and location and folder_exists(spark, place):
            spark.catalog.recoverPartitions(warehouse.name(spec))  # files may be there already
        add_missing_columns(spark, warehouse.name(spec), spec.stored)
    return warehouse


def _definition(spec: TableSpec, name: str, location: str | None, provider: str) -> str:
    """File tables hold levels as columns, and how to compute them as properties; others have transforms."""
    place = f"LOCATION '{location}/{spec.name}/data'" if location else ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.stored)
    if provider not in FILE_FORMATS:
        # Fixed value: row-level deletes need the second format version.
        properties = "TBLPROPERTIES ('format-version' = '2')" if provider == "iceberg" else ""
        parts = ", ".join([spec.partition, *(level.transform for level in spec.levels)])
        return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider} PARTITIONED BY ({parts}) {place} {properties}"
    options, properties = {"partitionOverwriteMode": "dynamic"}, {}
    if spec.bloom and provider == "parquet":
        # As large as the ids of a row group need, instead of a megabyte each.
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
        for column in spec.bloom:
            options[f"parquet.bloom.filter.enabled#{column}"] = "true"
            options[f"parquet.bloom.filter.fpp#{column}"] = BLOOM_FALSE
    for level in spec.levels:
        properties[LEVEL_PROPERTY + level.name] = json.dumps([level.of, level.expression])
    if spec.cluster:
        properties[CLUSTER_PROPERTY] = json.dumps(spec.cluster)
    if spec.bloom:
        properties[BLOOM_PROPERTY] = json.dumps(spec.bloom)
    if spec.unseen:
        properties[HIDDEN_PROPERTY] = json.dumps(sorted(spec.unseen))
    levels = "".join(f", `{level.name}` INT" for level in spec.levels)
    parts = ", ".join([spec.partition, *(level.name for level in spec.levels)])
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}{levels}) USING {provider} OPTIONS ({_pairs(options)}) "
        f"PARTITIONED BY ({parts}) {place}" + (f" TBLPROPERTIES ({_pairs(properties)})" if properties else "")
    )


def _pairs(settings: dict[str, str]) -> str:
    return ", ".join(f"{_sql_literal(k)} {_sql_literal(v)}" for k, v in settings.items())


def add_missing_columns(spark: SparkSession, table: str, wanted: T.StructType) -> list[str]:
    """Evolve a table in place; rows written before read null in the added columns."""
    spark.catalog.refreshTable(table)
    existing = {name.lower() for name in spark.table(table).columns}
    missing = [f for f in wanted if f.name.lower() not in existing]
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        spark.catalog.refreshTable(table)
    return [f.name for f in missing]


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def align(source: DataFrame, target: T.StructType) -> DataFrame:
    """Target columns in target order; those the source lacks become typed nulls."""
    have = set(source.columns)
    return source.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


@dataclass(frozen=True)
class Layout:
    """What a write needs to know of a table."""

    provider: str
    partitions: tuple[str, ...]
    location: str = ""
    levels: dict[str, Level] = field(default_factory=dict)  # partition columns that writers compute
    cluster: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    unseen: tuple[str, ...] = ()  # columns that readers do not ask for

    @property
    def plain_files(self) -> bool:
        """True for a file table, which has no row-level operations."""
        return self.provider in FILE_FORMATS

    @property
    def partition(self) -> str:
        """The partition column of the table's contract."""
        return self.partitions[0]

    def shaped(self, source: DataFrame, target: T.StructType) -> DataFrame:
        """Source in the table's columns, with the levels computed from them."""
        own = {name: F.expr(level.expression).cast("int") for name, level in self.levels.items()}
        rows = align(source, target)
        return rows.withColumns(own) if own else rows


def layout(spark: SparkSession, table: str) -> Layout:
    rows = [(r[0], r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    provider = next((kind for name, kind in rows if name == "Provider"), "").lower()
    location = next((place for name, place in rows if name == "Location"), "")
    named = [name for name, _ in rows]
    parts = named[named.index("# col_name") + 1 :] if "# col_name" in named else []
    parts = tuple(parts[: parts.index("")] if "" in parts else parts)
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    levels = {}
    for name in parts:
        if text := known.get(LEVEL_PROPERTY + name):
            of, expression = json.loads(text)
            levels[name] = Level(name, tuple(of), expression, "")
    lists = [tuple(json.loads(known.get(p, "[]"))) for p in (CLUSTER_PROPERTY, BLOOM_PROPERTY, HIDDEN_PROPERTY)]
    return Layout(provider, parts, location, levels, *lists)


#: The last lease that this process had of a table, as this catalog knows it.
_LAST_LEASE: dict[tuple[str, str, str], int] = {}


@contextmanager
def writing(spark: SparkSession, table: str) -> Iterator[tuple[Layout, Lease | None]]:
    """Layout of a table that nobody else writes meanwhile, with all its partitions known to the catalog.

    Another job may have its own catalog over the same files. A partition that it opened would be invisible
    here, and keys in it would be added a second time. Leases are numbered, so the folder is searched only
    where another writer had one since.
    """
    form = layout(spark, table)
    if not form.plain_files:
        yield form, None
        return
    if not form.partitions:
        raise ValueError(f"{table} has no partition column")
    with writer_lease(spark, form.location) as lease:
        _note_columns(spark, table, form)
        known = (spark.sparkContext.applicationId, table, form.location)
        if _LAST_LEASE.get(known) != lease.number - 1 and folder_exists(spark, form.location):
            spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
        yield form, lease
        _LAST_LEASE[known] = lease.number
        spark.catalog.refreshTable(table)


#: Columns of each table as this process noted them last.
_NOTED: dict[str, str] = {}


def _note_path(location: str) -> str:
    parent, _, name = location.rstrip("/").rpartition("/")
    return f"{parent}/_schema-{name}.json"


def _note_columns(spark: SparkSession, table: str, form: Layout) -> None:
    """Keep the table's columns beside its files, so that reading the folder opens no footer to learn them.

    Under the lease, and before each write that could bring a column.
    """
    text = json.dumps({"schema": json.loads(spark.table(table).schema.json()), "unseen": form.unseen})
    if _NOTED.get(form.location) != text:
        overwrite_file(spark, _note_path(form.location), text)
        _NOTED[form.location] = text


def noted_columns(spark: SparkSession, location: str) -> tuple[T.StructType, list[str]] | None:
    """Columns that the writers of a folder noted, and which of them readers do not ask for."""
    path = _note_path(location)
    if not folder_exists(spark, path):
        return None
    noted = json.loads(read_file(spark, path))
    return T.StructType.fromJson(noted["schema"]), noted["unseen"]


# --- writing -------------------------------------------------------------------------------------


ROWS_PER_TASK = 1_000_000


def _is_small(rows: DataFrame) -> bool:
    """Whether all rows together are less than what Spark would give one task, by its own estimate."""
    spark = rows.sparkSession
    share = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(share)
    return rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def _spread(rows: DataFrame, form: Layout) -> DataFrame:
    """Group rows by partition for few, full files; a hot partition is split again at run time.

    A little data in very many partitions is many files, which several tasks write side by side.
    """
    spark, parts = rows.sparkSession, form.partitions
    order = [*parts, *form.cluster]
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        if not _is_small(rows):
            return rows.hint("rebalance", *parts).sortWithinPartitions(*order)
        width = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        return rows.repartition(width, *parts).sortWithinPartitions(*order)
    # Stateful streams write without adaptive execution, where the hint does nothing: rows of a partition
    # then meet in one task, or in several for every million of them. Only partitions with more are listed.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(*[F.col(p).alias(p) for p in parts]).agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.where(F.col("n") > ROWS_PER_TASK).collect()
    salt = F.lit(0)
    for row in hot:
        tasks = -(-row["n"] // ROWS_PER_TASK)
        mine = in_partitions(parts, [tuple(row[p] for p in parts)])
        salt = F.when(mine, F.pmod(F.xxhash64(*rows.columns), F.lit(tasks)).cast("int")).otherwise(salt)
    spread = rows.repartition(width, *parts, salt) if hot else rows.repartition(width, *parts)
    return spread.sortWithinPartitions(*order)


def _insert(rows: DataFrame, table: str, form: Layout, lease: Lease, overwrite: bool = False) -> None:
    lease.check()
    _spread(rows, form).write.insertInto(table, overwrite=overwrite)


def append(source: DataFrame, table: str) -> None:
    spark = source.sparkSession
    with writing(spark, table) as (form, lease):
        rows = form.shaped(source, spark.table(table).schema)
        if lease:
            _insert(rows, table, form, lease)
        else:
            rows.writeTo(table).append()
            spark.catalog.refreshTable(table)


def _is(column: str, values: set) -> Column:
    """Membership that also matches null."""
    known = [v for v in values if v is not None]
    tests = [F.col(column).isin(*known)] if known else []
    if len(known) < len(values):
        tests.append(F.col(column).isNull())
    return reduce(or_, tests) if tests else F.lit(False)


def in_partitions(parts: tuple[str, ...], values: list | tuple | set) -> Column:
    """Rows of any of the partitions, each given by its values; the null partition is one too."""
    *outer, last = parts
    if not outer:
        return _is(last, {v[0] for v in values})
    groups: dict[tuple, set] = {}
    for *head, tail in values:
        groups.setdefault(tuple(head), set()).add(tail)
    # Heads that have the same tails share a test, so a whole day of every level is one value of a list.
    shared: dict[frozenset, set] = {}
    for head, tails in groups.items():
        shared.setdefault(frozenset(tails), set()).add(head)
    tests = [in_partitions(tuple(outer), heads) & _is(last, set(tails)) for tails, heads in shared.items()]
    return reduce(or_, tests) if tests else F.lit(False)


def restricted(frame: DataFrame, parts: tuple[str, ...], values: set[tuple], keep: bool = True) -> DataFrame:
    """Rows in (or outside) the given partitions: by a list of them, or by a join where the list would be long."""
    if len(values) <= LISTED_PARTITIONS:
        test = in_partitions(parts, values)
        # Unknown means outside: the null partition is none of the listed ones.
        return frame.where(test) if keep else frame.where(~F.coalesce(test, F.lit(False)))
    fields = [T.StructField(f"_in_{p}", frame.schema[p].dataType) for p in parts]
    listed = frame.sparkSession.createDataFrame(sorted(values, key=str), T.StructType(fields))
    same = reduce(and_, [F.col(p).eqNullSafe(F.col(f"_in_{p}")) for p in parts])
    return frame.join(listed, same, "left_semi" if keep else "left_anti")


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _folders(spark: SparkSession, table: str, form: Layout, value) -> dict[tuple, str]:
    """Every partition below one value of the first partition column, and its folder, as the catalog lists them."""
    found = spark.sql(f"SHOW PARTITIONS {table} PARTITION (`{form.partition}` = {_sql_literal(value)})").collect()
    out = {}
    for row in found:
        levels = [p.split("=", 1)[1] for p in row[0].split("/")[1:]]
        out[value, *(None if p == "__HIVE_DEFAULT_PARTITION__" else int(p) for p in levels)] = row[0]
    return out


def _clear(spark: SparkSession, table: str, form: Layout, partitions: list[tuple], lease: Lease) -> None:
    """Remove partitions with their files."""
    if not partitions:
        return
    folders: dict[tuple, str] = {}
    for value in {p[0] for p in partitions}:
        folders |= _folders(spark, table, form, value)
    lease.check()
    dropped = []
    for values in partitions:
        if values in folders:
            place, fs = hadoop_path(spark, f"{form.location}/{folders[values]}")
            fs.delete(place, True)
            given = ", ".join(f"`{p}` = {_sql_literal(v)}" for p, v in zip(form.partitions, values, strict=True))
            dropped.append(f"PARTITION ({given})")
    if dropped:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(dropped)}")


def delete_partition(spark: SparkSession, table: str, value) -> None:
    """Remove all rows with one value of the first partition column."""
    with writing(spark, table) as (form, lease):
        if lease:
            _clear(spark, table, form, list(_folders(spark, table, form, value)), lease)
        else:
            part = form.partition
            test = f"`{part}` IS NULL" if value is None else f"`{part}` = {_sql_literal(value)}"
            spark.sql(f"DELETE FROM {table} WHERE {test}")
            spark.catalog.refreshTable(table)


def _written(bitmap: bytes) -> set[int]:
    """Numbers of the bits that are set, lowest bit of the first byte first."""
    return {8 * i + bit for i, byte in enumerate(bitmap) for bit in range(8) if byte >> bit & 1}


def replace_partition(source: DataFrame, table: str, value) -> int:
    """Make ``source`` the whole content of one value of the first partition column; returns its row count.

    An empty source leaves an empty partition. Every source row must belong to the partition. Rows are
    counted as they are written.
    """
    spark = source.sparkSession
    with writing(spark, table) as (form, lease):
        part = form.partition
        mine = _is(part, {value})
        rows = form.shaped(source, spark.table(table).schema)
        stray = F.raise_error(F.lit(f"row outside partition {part} = {value}"))
        guarded = rows.withColumn(part, F.when(mine, F.col(part)).otherwise(stray))
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("rows")]
        if len(form.partitions) > 2:
            raise ValueError(f"{table} has more than one level below {part}")
        for level in form.partitions[1:]:
            # A level is a small whole number, so which of them were written fits a bitmap.
            counts.append(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(level).cast("long") + 1)).alias("levels"))
        if lease is None:
            guarded.observe(seen, *counts).writeTo(table).overwrite(mine)
            spark.catalog.refreshTable(table)
            return seen.get["rows"]
        before = list(_folders(spark, table, form, value))
        # Dynamic overwrite swaps the partitions that rows arrive for at commit, and leaves the others alone.
        lease.check()
        _spread(guarded, form).observe(seen, *counts).write.insertInto(table, overwrite=True)
        written = seen.get
        kept = _written(written["levels"]) if "levels" in written else {None} if written["rows"] else set()
        _clear(spark, table, form, [p for p in before if (p[1] if len(p) > 1 else None) not in kept], lease)
        return written["rows"]


# --- upsert --------------------------------------------------------------------------------------


def _keys_present(keys: tuple[str, ...]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _check_unique(source: DataFrame, keys: tuple[str, ...]) -> None:
    repeated = source.where(_keys_present(keys)).groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"upsert source has several rows for one key {keys}")


def _profile(source: DataFrame, keys: tuple[str, ...], parts: tuple[str, ...]):
    """Row count, partitions and key ranges of the source, in the pass that computes it.

    The set holds one value per partition of the source, not per row.
    """
    ranges = []
    for key in keys:
        kind = source.schema[key].dataType
        if isinstance(kind, BOUNDED_KEY_TYPES):
            plain = F.unix_micros(key) if isinstance(kind, T.TimestampType) else F.col(key)
            ranges += [F.min(plain).alias(f"lo_{key}"), F.max(plain).alias(f"hi_{key}")]
    row = source.agg(
        F.count(F.lit(1)).alias("rows"), F.collect_set(F.struct(*parts)).alias("parts"), *ranges
    ).first()
    return row, {tuple(p) for p in row["parts"]}


def _within_ranges(profile, source: DataFrame, keys: tuple[str, ...]) -> Column:
    """Range test every matching target row passes; it prunes row groups in the key lookup."""
    test = F.lit(True)
    for key in keys:
        kind = source.schema[key].dataType
        if isinstance(kind, BOUNDED_KEY_TYPES) and profile[f"lo_{key}"] is not None:
            lo, hi = F.lit(profile[f"lo_{key}"]), F.lit(profile[f"hi_{key}"])
            if isinstance(kind, T.TimestampType):
                lo, hi = F.timestamp_micros(lo), F.timestamp_micros(hi)
            test = test & F.col(key).between(lo, hi)
    return test


def _listed(profile, source: DataFrame, keys: tuple[str, ...], form: Layout) -> Column | None:
    """For few keys with Bloom filters the list of them, which the filters of each row group are asked."""
    if len(keys) != 1 or keys[0] not in form.bloom or profile["rows"] > LISTED_KEYS:
        return None
    found = {r[0] for r in source.select(*keys).collect()} - {None}
    return F.col(keys[0]).isin(*found)


def lookup(
    target: DataFrame, source: DataFrame, profile, parts: set[tuple], keys: tuple[str, ...], form: Layout,
    partition_follows_key: bool = False, match_where: Column | None = None,
) -> DataFrame:
    """Target rows that may have a key of the source, as few as files and filters can tell."""
    found = target.where(_within_ranges(profile, source, keys))
    if match_where is not None:
        found = found.where(match_where)
    # Partition columns that the key decides: rows with equal keys lie in the same of their values.
    fixed = [
        i for i, p in enumerate(form.partitions)
        if partition_follows_key or p in keys or (p in form.levels and set(form.levels[p].of) <= set(keys))
    ]
    if fixed:
        columns = tuple(form.partitions[i] for i in fixed)
        found = restricted(found, columns, {tuple(v[i] for i in fixed) for v in parts})
    listed = _listed(profile, source, keys, form)
    return found if listed is None else found.where(listed)


#: From the old and the new row's column by name: whether the new row may replace the old one.
ReplaceIf = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _merge(source: DataFrame, table: str, keys: tuple[str, ...], replace_if: ReplaceIf | None) -> None:
    name = table.split(".")[-1]
    match = reduce(and_, [F.col(f"{name}.{k}") == F.col(f"src.{k}") for k in keys])
    writer = source.alias("src").mergeInto(table, match)
    allowed = replace_if(lambda c: F.col(f"{name}.{c}"), lambda c: F.col(f"src.{c}")) if replace_if else None
    writer.whenMatched(allowed).updateAll().whenNotMatched().insertAll().merge()


def _refused(candidates: DataFrame, source: DataFrame, keys: tuple[str, ...], replace_if: ReplaceIf) -> DataFrame:
    """Keys of source rows that may not replace the row that is there; an unknown answer is a no."""
    old = candidates.select(*keys, F.struct(*candidates.columns).alias("_old"))
    new = source.select(*keys, F.struct(*source.columns).alias("_new"))
    allowed = replace_if(lambda c: F.col("_old")[c], lambda c: F.col("_new")[c])
    return old.join(new, [*keys]).where(~F.coalesce(allowed, F.lit(False))).select(*keys).distinct()


def upsert(
    source: DataFrame,
    table: str,
    keys: tuple[str, ...],
    *,
    keys_unique: bool = False,
    match_where: Column | None = None,
    partition_follows_key: bool = False,
    replace_if: ReplaceIf | None = None,
) -> UpsertResult:
    """Insert source rows, replacing target rows with equal keys; null keys never match.

    ``partition_follows_key`` states that rows with equal keys always share their partition values, so
    the lookup reads only the source's partitions. ``match_where`` is any other condition known to
    hold for all matching target rows. ``replace_if`` decides for each match whether the new row takes the
    old one's place or is left out. Running the same upsert again changes nothing; on file tables
    a run that died half way is completed by running it again. The source must not read the target:
    checkpoint it first if it does.

    The rows reported are those of the source, or where the catalog merges, those it was given.
    """
    spark = source.sparkSession
    with writing(spark, table) as (form, lease):
        target = spark.table(table)
        rows = form.shaped(source, target.schema)
        if lease is None:
            seen = Observation()
            _merge(rows.observe(seen, F.count(F.lit(1)).alias("rows")), table, keys, replace_if)
            spark.catalog.refreshTable(table)
            return UpsertResult(seen.get["rows"])
        # Several jobs read the source, so it is computed once.
        held = rows.persist()
        chosen = None
        try:
            profile, parts = _profile(held, keys, form.partitions)
            if not profile["rows"]:
                return UpsertResult(0)
            if not keys_unique:
                _check_unique(held, keys)
            candidates = lookup(target, held, profile, parts, keys, form, partition_follows_key, match_where)
            if replace_if is not None:
                refused = _refused(candidates, held, keys, replace_if)
                unknown = held.where(~_keys_present(keys))
                accepted = held.where(_keys_present(keys)).join(refused, [*keys], "left_anti").select(*held.columns)
                chosen = accepted.unionByName(unknown).persist()
                parts = {tuple(r) for r in chosen.select(*form.partitions).distinct().collect()}
            return _replace(spark, table, form, lease, chosen or held, profile["rows"], parts, candidates, keys)
        finally:
            held.unpersist()
            if chosen is not None:
                chosen.unpersist()


def _replace(
    spark: SparkSession, table: str, form: Layout, lease: Lease, held: DataFrame, count: int, parts: set[tuple],
    candidates: DataFrame, keys: tuple[str, ...],
) -> UpsertResult:
    """Append what is new, and rewrite the partitions that hold superseded rows."""
    target = spark.table(table)
    source_keys = held.select(*keys)
    matches = candidates.select(*dict.fromkeys([*keys, *form.partitions])).join(source_keys, [*keys], "left_semi")
    # One row per partition with a match, however many rows match.
    stale = {tuple(row) for row in matches.select(*form.partitions).distinct().collect()}

    if parts - stale:
        _insert(restricted(held, form.partitions, stale, keep=False) if stale else held, table, form, lease)
    cleared: set = set()
    if stale:
        old = restricted(target, form.partitions, stale)
        kept = old.where(_keys_present(keys)).join(source_keys, [*keys], "left_anti")
        # Null keys match nothing; joined, they would all meet in one task.
        kept = kept.select(*target.columns).unionByName(old.where(~_keys_present(keys)))
        emptied = stale - parts
        if emptied:
            left = restricted(kept, form.partitions, emptied).select(*form.partitions).distinct().collect()
            cleared = emptied - {tuple(row) for row in left}
        content = kept.unionByName(restricted(held, form.partitions, stale))
        _insert(content, table, form, lease, overwrite=True)
        if cleared:
            _clear(spark, table, form, sorted(cleared, key=str), lease)
    return UpsertResult(count, tuple(sorted(stale, key=str)), tuple(sorted(cleared, key=str)))


def upsert_spec(
    source: DataFrame, warehouse: Warehouse, spec: TableSpec, **options
) -> UpsertResult:
    """Upsert on a table's natural key."""
    return upsert(source, warehouse.name(spec), spec.key, **options)


def evolve_curated(warehouse: Warehouse) -> list[str]:
    """Add the columns that event versions after the first brought."""
    return add_missing_columns(warehouse.spark, warehouse.name(CURATED), CURATED.stored)
