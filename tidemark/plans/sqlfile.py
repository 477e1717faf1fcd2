"""Run one SQL file over warehouse tables and save the result as CSV.

    spark-submit -m tidemark.plans.sqlfile --warehouse /lake --sql-file late_events.sql
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import build_session
from tidemark.sources.lake import discover_tables, register_catalog, register_tables

# Fixed value: how timestamps appear in result files.
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"


def read_sql(spark: SparkSession, path: str) -> str:
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as error:
        raise FileNotFoundError(f"no SQL file at {path}") from error
    text = row[0].strip().rstrip(";").strip() if row else ""
    if not text:
        raise ValueError(f"SQL file is empty: {path}")
    return text


def _relations(plan, hidden: frozenset[str]) -> Iterator[tuple[int, str]]:
    """Position and name of each table of an unresolved plan; names of the WITH clauses in force are no tables."""
    kind = plan.getClass().getSimpleName()
    if kind == "UnresolvedRelation":
        parts = plan.multipartIdentifier()
        if parts.size() > 1 or parts.head().lower() not in hidden:
            yield plan.origin().startIndex().get(), parts.last()
        return
    inner = plan.innerChildren()  # sub-queries of expressions; of a WITH, what it defines
    if kind == "UnresolvedWith":
        named = plan.cteRelations()
        for i in range(named.size()):
            yield from _relations(named.apply(i)._2(), hidden)
            hidden |= {named.apply(i)._1().lower()}
    else:
        for i in range(inner.size()):
            yield from _relations(inner.apply(i), hidden)
    for i in range(plan.children().size()):
        yield from _relations(plan.children().apply(i), hidden)


def relations(spark: SparkSession, sql: str) -> list[str]:
    """Names of the tables that a query reads, in the order of its text, as Spark's own parser sees them."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    return list(dict.fromkeys(name for _, name in sorted(_relations(plan, frozenset()))))


def named_tables(spark: SparkSession, sql: str, tables: list[str]) -> list[str]:
    """Those of the tables that the query reads, in the order of its text."""
    known = {t.lower(): t for t in tables}
    return [known[n.lower()] for n in relations(spark, sql) if n.lower() in known]


def write_csv(result: DataFrame, path: str) -> None:
    """Folder of CSV part files with headers, written by all tasks in parallel."""
    out = result.write.mode("overwrite").option("header", True).option("emptyValue", "")
    out.option("timestampFormat", CSV_TIMESTAMP).csv(path)


def run_sql_file(
    spark: SparkSession,
    warehouse: str,
    sql_file: str,
    tables: list[str] | None = None,
    output: str | None = None,
    database: str | None = None,
) -> tuple[DataFrame, str]:
    """Result and where it was saved; by default next to the SQL file, named after its table.

    Only tables that the text names are opened. With ``database`` they are the catalog's, which knows
    the files that a lakehouse table consists of; else they are folders below ``warehouse``.
    """
    sql = read_sql(spark, sql_file)
    home = spark.catalog.currentDatabase()
    if database:
        spark.catalog.setCurrentDatabase(database)
        every = tables or [t.name for t in spark.catalog.listTables(database)]
    else:
        every = tables or discover_tables(spark, warehouse)
    try:
        read = named_tables(spark, sql, every)
        views = register_catalog(spark, database, read) if database else register_tables(spark, warehouse, tables or read or None)
        if output is None:
            folder = sql_file.rpartition("/")[0] or "."
            output = f"{folder}/{(read or every)[0]}_output.csv"
        try:
            result = spark.sql(sql)
            write_csv(result, output)
        finally:
            for name in views:
                spark.catalog.dropTempView(name)
    finally:
        spark.catalog.setCurrentDatabase(home)
    return result, output


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run a SQL file over warehouse tables.")
    parser.add_argument("--warehouse", help="folder holding <table>/data")
    parser.add_argument("--database", help="read catalog tables of this database instead")
    parser.add_argument("--sql-file", required=True)
    parser.add_argument("--table-name", action="append", dest="tables", help="repeatable; default all")
    parser.add_argument("--output-file", help="CSV folder; default beside the SQL file")
    args = parser.parse_args(argv)
    if bool(args.warehouse) == bool(args.database):
        parser.error("give either --warehouse or --database")
    spark = build_session("sqlfile")
    try:
        result, output = run_sql_file(
            spark, args.warehouse, args.sql_file, args.tables, args.output_file, args.database
        )
        # What was saved is shown, so the query runs once.
        spark.read.option("header", True).csv(output).show(20, truncate=False)
        print(f"saved to {output}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
