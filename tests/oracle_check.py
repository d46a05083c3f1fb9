"""Compare a Spark result with DuckDB on the same tables, as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

from jobmart.catalog.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


# Spark type name to the DuckDB type the driver reads for it.
TYPE_NAMES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN", "double": "DOUBLE",
}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns, types and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    positions = [names.index(n) for n in order]
    wanted = Counter(tuple(row[i] for i in positions) for row in result.fetchall())
    got = Counter(tuple(r) for r in df.select(*order).collect())
    unlike = {
        n: (t, types[n]) for n, t in df.dtypes if TYPE_NAMES.get(t) != types[n]
    }
    if got != wanted:
        return (
            f"{sum(got.values())} and {sum(wanted.values())} rows; only here "
            f"{list((got - wanted).items())[:3]}; only in SQL {list((wanted - got).items())[:3]}"
        )
    return f"types {unlike}" if unlike else None
