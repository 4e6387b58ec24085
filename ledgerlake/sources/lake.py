"""Lake locations and catalog tables.

Parquet tables have no row-level MERGE and cannot be overwritten while they are read. So a
new version is written to a fresh folder and published by pointing the catalog at it, with
plain ALTER TABLE. Readers keep the version they started with; a failed write publishes
nothing.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import publication

TABLE_ROOT_SETTING = "spark.ledgerlake.tables.dir"
BASE_URI_SETTING = "spark.ledgerlake.files.base"
VERSION = "ledgerlake.version"
ROW_MERGE_PROVIDERS = {"delta", "iceberg"}


def lake_files_path(workspace: str, lakehouse: str, subpath: str, base: str = "") -> str:
    """Location of a raw file area: base/workspace/lakehouse/Files/subpath.

    `base` is any local folder or Hadoop scheme. It may hold {workspace}, for stores that
    put the container in the authority: abfss://{workspace}@account.example/.
    """
    if "{workspace}" in base:
        root = base.format(workspace=workspace).rstrip("/")
        return f"{root}/{lakehouse}.Lakehouse/Files/{subpath}"
    return "/".join([p for p in (base.rstrip("/"), workspace, f"{lakehouse}.Lakehouse/Files", subpath) if p])


def read_entity(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One raw Parquet entity; a declared schema saves the footer scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists",
                  compression: str = "snappy") -> None:
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def fresh_location(spark: SparkSession, table: str) -> str:
    root = spark.conf.get(TABLE_ROOT_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{table.replace('.', '/')}/{uuid.uuid4().hex}"


def create_table(df: DataFrame, table: str, partition_by: str | None = None) -> int:
    """Write a new table and return its row count, taken while writing."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = _clustered(counted, partition_by).write.option("path", fresh_location(df.sparkSession, table))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return rows_of(seen)


def rows_of(seen: Observation) -> int:
    """Rows counted while writing. Of a frame that is empty by its form, Spark leaves the count out with the rest."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return 0


def drop_table(spark: SparkSession, table: str) -> None:
    """Take a table out of the catalog and delete all its versions."""
    from . import keyed

    table = table.removesuffix(keyed.runs_table(""))
    if spark.catalog.tableExists(keyed.runs_table(table)):
        keyed.drop(spark, table)
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path(fresh_location(spark, table)).getParent()
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def append_rows(df: DataFrame, table: str) -> None:
    """Append rows to a table, matched by column name."""
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def swap_table(df: DataFrame, table: str) -> None:
    """Publish a whole new version of an unpartitioned table.

    Stops if another writer has published a version since this one began to read: its rows
    would be lost.
    """
    spark = df.sparkSession
    path, before = fresh_location(spark, table), version(spark, table)
    df.write.parquet(path)
    _next_version(spark, table, before)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def swap_partitions(df: DataFrame, table: str, part: str, values: list, append_only: list | None = None) -> None:
    """Publish new versions of the given partitions; all others stay as they are.

    A given partition without rows goes, unless it is in `append_only`. New partitions come first,
    then the others by name.

    Each partition switches at once. If the driver dies in between, running the same merge
    again ends in the same table. Stops if another writer has published meanwhile.
    """
    spark = df.sparkSession
    names = {_partition_name(part, v): v for v in values}
    path, before = fresh_location(spark, table), version(spark, table)
    _clustered(df, part).write.partitionBy(part).parquet(path)
    rewritten = spark.read.schema(df.schema).parquet(path).select(part).distinct().collect()
    written = {_partition_name(part, r[0]) for r in rewritten}
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    _next_version(spark, table, before)
    spec = {name: f"PARTITION ({part}='{v}')" for name, v in names.items()}
    added = "".join(f" {spec[name]} LOCATION '{path}/{name}'" for name in sorted(written - known))
    if added:
        spark.sql(f"ALTER TABLE {table} ADD{added}")
    kept = {_partition_name(part, v) for v in append_only or []}
    for name in sorted(names):
        if name in written and name in known:
            spark.sql(f"ALTER TABLE {table} {spec[name]} SET LOCATION '{path}/{name}'")
        elif name in known and name not in kept:
            spark.sql(f"ALTER TABLE {table} DROP {spec[name]}")
    spark.catalog.refreshTable(table)


def version(spark: SparkSession, table: str) -> str:
    """A name of the version that the table is at; it changes with every publication."""
    return spark.sql(f"SHOW TBLPROPERTIES {table} ('{VERSION}')").first()["value"]


def _next_version(spark: SparkSession, table: str, before: str) -> None:
    """Claim the next publication, unless another writer has published since `before` was read.

    The claim is a file that only one writer can put in place after `before`; the property names it.
    """
    folder, name = f"{fresh_location(spark, table).rsplit('/', 1)[0]}/_claims", uuid.uuid4().hex
    first = "none" if not re.fullmatch("[0-9a-f]{32}", before) else before
    if version(spark, table) != before:
        raise publication.Conflict(f"{table} was changed by another writer; run the merge again")
    publication.publish(spark, f"{folder}/{first}", 0, {"next": name})
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{VERSION}' = '{name}')")


def _partition_name(part: str, value) -> str:
    """Folder and catalog name of a partition; values that would need escaping are refused."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", str(value)):
        raise ValueError(f"partition value {value!r} of {part} is not usable as a folder name")
    return f"{part}={value}"


def supports_row_merge(spark: SparkSession, table: str) -> bool:
    """Whether the table's own format can MERGE; then it does, instead of a swap."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").collect()
    return bool(rows) and rows[0]["data_type"].lower() in ROW_MERGE_PROVIDERS


def register_tables(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Temp views for every table present under a folder; absent ones are skipped."""
    found = []
    for name in names:
        path = f"{folder.rstrip('/')}/{name}.parquet"
        if path_exists(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(name)
            found.append(name)
    return found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything, on whatever file system it lives."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return files is not None and len(files) > 0


def _clustered(df: DataFrame, part: str | None) -> DataFrame:
    """Group rows by partition before writing; AQE splits a hot partition over many tasks."""
    return df.hint("rebalance", part) if part else df
