"""Table writes on Parquet: append with new columns, replace, swap, expire."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def land(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back, so later uses do not recompute ``df`` and survive lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append; rows written earlier read as NULL in columns that are new."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows under ``path`` with the union of the columns ever written."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def union_evolving(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """The same meaning without a write: union by name, absent columns NULL."""
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Name the Parquet files under ``path``; doing it twice changes nothing."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def overwrite_new_schema(df: DataFrame, path: str) -> DataFrame:
    """Replace rows and schema in place. ``df`` must not read ``path``, and a failed write leaves nothing
    to go back to: ``swap_table`` writes beside the old version and accepts a new schema too."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def swap_table(df: DataFrame, name: str, new_path: str) -> DataFrame:
    """Replace table ``name`` by ``df``, which may read the same table.

    The new version is written in full beside the old one and the table is pointed at it last: a
    failed write leaves the old version in place.
    """
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(new_path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def ensure_table(
    spark: SparkSession, name: str, schema: StructType, path: str, partition: str | None = None
) -> None:
    """Create the Parquet table unless it is there. ``NOT NULL`` is recorded, not enforced: see
    ``operators.checks.require_not_null``."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    by = f" PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by} LOCATION '{path}'")


def refresh_table(df: DataFrame, name: str) -> DataFrame:
    """Replace the rows of a table by a query that does not read it; the schema stays."""
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    return spark.table(name)


def append_to_table(df: DataFrame, name: str, day: str | None = None) -> DataFrame:
    """Append by column name; columns the table does not have yet are added to it first.

    With ``day``, the partition column, rows are rebalanced on it: a run leaves few files a day.
    """
    spark = df.sparkSession
    have = {c.lower() for c in spark.table(name).columns}
    new = [f"`{c}` {t}" for c, t in df.dtypes if c.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    table = spark.table(name)
    aligned = table.limit(0).unionByName(df, allowMissingColumns=True)
    if day:
        aligned = aligned.hint("rebalance", F.col(day))
    aligned.write.insertInto(name)
    return spark.table(name)


def _plain(path: str) -> str:
    """One spelling of a folder: ``file:/a``, ``file:///a`` and ``/a`` are the same."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def _location(described: DataFrame) -> str:
    """The first location after the columns, which may have one of that name."""
    detailed = False
    for row in described.collect():
        detailed = detailed or row.col_name.startswith("# Detailed")
        if detailed and row.col_name == "Location":
            return _plain(row.data_type)
    raise ValueError("no location is recorded")


def table_location(spark: SparkSession, name: str) -> str:
    return _location(spark.sql(f"DESCRIBE FORMATTED {name}"))


def partition_locations(spark: SparkSession, name: str) -> dict[str, str]:
    """Folder of each partition; one entry per day comes to the driver."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        key, value = row.partition.split("=", 1)
        found[row.partition] = _location(spark.sql(f"DESCRIBE FORMATTED {name} PARTITION ({key} = '{value}')"))
    return found


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def list_folders(spark: SparkSession, path: str) -> list[str]:
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(_plain(s.getPath().toString()) for s in files.listStatus(folder) if s.isDirectory())


def delete_folder(spark: SparkSession, path: str, root: str) -> None:
    """Delete a folder, which must lie under ``root``."""
    if not f"{_plain(path)}/".startswith(f"{_plain(root)}/") or _plain(path) == _plain(root):
        raise ValueError(f"{path} is not under {root}")
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def with_day(df: DataFrame, ts: str, day: str = "extraction_date") -> DataFrame:
    return df.withColumn(day, F.to_date(ts))


def write_by_day(df: DataFrame, name: str, path: str, ts: str, day: str = "extraction_date") -> DataFrame:
    """A table partitioned by day, so that retention prunes files instead of reading them.

    Rows are rebalanced on the day: Spark sizes the write tasks from what it finds and splits a day
    that holds most rows over many of them.
    """
    (
        with_day(df, ts, day).hint("rebalance", F.col(day))
        .write.mode("overwrite").partitionBy(day).option("path", path).format("parquet")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def replace_days(df: DataFrame, name: str, path: str, day: str, days: list[date]) -> DataFrame:
    """Replace the given day partitions by ``df``, which may read the table and holds no other days.

    The new files are written in full under ``path`` before any partition is pointed at them; days
    that have no rows left are dropped. Days are switched one after the other: a run that breaks off in
    between is put right by repeating it.
    """
    spark = df.sparkSession
    df.hint("rebalance", F.col(day)).write.mode("errorifexists").partitionBy(day).parquet(path)
    written = spark.read.schema(df.schema).parquet(path).select(day).distinct()
    filled = {row[0] for row in written.toLocalIterator()}
    for d in days:
        partition = f"PARTITION ({day} = DATE '{d}')"
        if d in filled:
            location = f"LOCATION '{path}/{day}={d}'"
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {partition} {location}")
            spark.sql(f"ALTER TABLE {name} {partition} SET {location}")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {partition}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def expire_days(
    spark: SparkSession, name: str, as_of: datetime, days: int = 30, day: str = "extraction_date",
    root: str | None = None,
) -> list[str]:
    """Drop the day partitions that lie wholly beyond retention; returns them.

    A row goes once 31 full days have passed, so a day goes once its last instant has. The boundary
    day stays and is trimmed on read by ``operators.timerange.retain``. Only the partition list, one
    entry per day, comes to the driver. With ``root`` the files of the dropped days are deleted too, if
    they lie under it; without, an external table keeps them.
    """
    first_kept = (as_of - timedelta(days=days + 1)).date().isoformat()
    listed = [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator()]
    dates = [p.split("=", 1)[1] for p in listed]
    gone = sorted(d for d in dates if d < first_kept)
    if gone:
        places = partition_locations(spark, name) if root else {}
        specs = ", ".join(f"PARTITION ({day} = '{d}')" for d in gone)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
        for d in gone if root else ():
            delete_folder(spark, places[f"{day}={d}"], root)
    return gone
