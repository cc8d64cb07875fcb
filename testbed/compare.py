"""Every registered query against its oracle: ``python -m testbed.compare [sf] [name…]``."""

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from testbed.oracles import ORACLES
from testbed.queries import QUERIES

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in ALL_TABLES:
        db.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return db


# Spark type → the DuckDB type it must meet.
_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def difference(spark: SparkSession, db, sf_dir: str, name: str) -> str | None:
    """What differs between the query and its oracle; None if nothing does."""
    result = QUERIES[name](spark, sf_dir)
    theirs = db.sql(ORACLES[name])
    types = {c: _TYPES[t] for c, t in result.dtypes}
    expected = dict(zip(theirs.columns, map(str, theirs.types)))
    if types != expected:
        return f"columns {sorted(set(types.items()) ^ set(expected.items()))}"
    names = sorted(types)
    ours = Counter(map(repr, map(tuple, result.select(*names).collect())))
    wanted = Counter(map(repr, theirs.select(*names).fetchall()))
    if ours == wanted:
        return None if ours else "no rows"
    extra, lacking = ours - wanted, wanted - ours
    return (
        f"{ours.total()} / {wanted.total()} rows; {extra.total()} extra {list(extra)[:2]};"
        f" {lacking.total()} lacking {list(lacking)[:2]}"
    )


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    db = database(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        if name in ORACLES:
            wrong = difference(spark, db, sf_dir, name)
        else:
            wrong = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        bad += wrong is not None
        print(f"{name:36s} {time.time() - start:6.1f}s  {wrong or 'ok'}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
