"""Typed batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Microseconds survive the text formats; Spark's default pattern keeps milliseconds only.
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Header names of the statistics-office feed; one value column follows per month.
REGION, SEX = "region", "kön"
VALUE_PREFIX = "Folkmängden per månad "


# Holds the text of a JSON line that could not be read in full, else NULL.
BROKEN = "_broken"


def read_noted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Landed JSON lines with a stated schema and ``BROKEN``: no inference pass, unknown fields dropped."""
    noted = StructType([*schema, StructField(BROKEN, StringType())])
    options = {"timestampNTZFormat": NTZ_FORMAT, "columnNameOfCorruptRecord": BROKEN}
    return spark.read.schema(noted).options(**options).json(path)


# Holds the fields of a JSON line that the stated schema does not have, as text by name.
RESCUED = "_rescued"

#: A landing with more new fields than this holds no new columns but keys that are data.
MOST_NEW_COLUMNS = 100


def read_rescued(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """As ``read_noted``, with ``RESCUED``: unknown fields are kept beside the typed ones, in the same pass.

    NULL values count as absent. A line that is no JSON object has no rescued fields; blank lines are skipped.
    """
    noted = StructType([*schema, StructField(BROKEN, StringType())])
    options = {"timestampNTZFormat": NTZ_FORMAT, "columnNameOfCorruptRecord": BROKEN}
    lines = spark.read.text(path).filter(F.trim("value") != "")
    known = F.array(*(F.lit(name.lower()) for name in schema.fieldNames()))
    fields = F.from_json("value", "map<string,string>")
    unknown = F.map_filter(fields, lambda k, v: v.isNotNull() & ~F.array_contains(known, F.lower(k)))
    return lines.select(F.from_json("value", noted, options).alias("_line"), unknown.alias(RESCUED)).select("_line.*", RESCUED)


def rescued_keys(noted: DataFrame) -> DataFrame:
    """``(key, n)``: the fields that no column takes, and in how many readable lines each is."""
    keys = noted.filter(F.col(BROKEN).isNull()).select(F.explode(F.map_keys(RESCUED)).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


def with_new_columns(noted: DataFrame) -> DataFrame:
    """``noted`` (landed first, as it is read twice) with its rescued fields as text columns instead of ``RESCUED``.

    Names that differ in case only are one column, named like the first of them in order; of two values in
    a line the first counts. Only names of letters, digits and underscores become columns; ``rescued_keys``
    tells of all. The names alone reach the driver, MOST_NEW_COLUMNS at most: more fail the run.
    """
    plain = rescued_keys(noted).filter(F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$") & ~F.col("key").isin(BROKEN, RESCUED))
    names = plain.groupBy(F.lower("key")).agg(F.sort_array(F.collect_set("key")).alias("names")).limit(MOST_NEW_COLUMNS + 1).collect()
    if len(names) > MOST_NEW_COLUMNS:
        raise ValueError(f"landed lines have more than {MOST_NEW_COLUMNS} unknown fields")
    found = {r.names[0]: F.coalesce(*(F.element_at(RESCUED, F.lit(n)) for n in r.names)) for r in sorted(names, key=lambda r: r.names)}
    return noted.withColumns(found).drop(RESCUED)


def readable(noted: DataFrame) -> DataFrame:
    """Rows that were read in full."""
    return noted.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def rejected(noted: DataFrame) -> DataFrame:
    """``line``: the text of the others. Land ``noted`` first: Spark does not scan JSON for it alone."""
    return noted.filter(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("line"))


def read_landing(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """Landed rows with a stated schema. JSON lines that do not parse, or hold a value of another type,
    are left out: ``read_noted`` and ``rejected`` give them."""
    if fmt != "json":
        return spark.read.schema(schema).format(fmt).load(path)
    return readable(read_noted(spark, path, schema))


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """Zero rows with a schema: the first-run target and the empty batch."""
    columns = (F.lit(None).cast(f.dataType).alias(f.name) for f in schema)
    return spark.range(1).select(*columns).limit(0)  # the optimizer knows that it is empty


def table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The named table, or no rows before its first load."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return empty_table(spark, schema)


def read_population_csv(
    spark: SparkSession, path: str, periods: list[str], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """The population feed as ``region, sex, period, value``, still text.

    The feed has one value column per month; they are turned into rows, blank cells dropped.
    """
    values = [VALUE_PREFIX + p for p in periods]
    schema = StructType([StructField(n, StringType()) for n in (REGION, SEX, *values)])
    wide = spark.read.csv(
        path, schema=schema, sep=",", quote='"', escape="\\", header=True, encoding=encoding,
        enforceSchema=False,
    )
    return (
        wide.withColumnsRenamed({SEX: "sex", **dict(zip(values, periods))})
        .unpivot([REGION, "sex"], periods, "period", "value")
        .filter(F.col("value").isNotNull())
    )
