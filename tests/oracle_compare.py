"""Run a catalogue query on Spark and its SQL twin on DuckDB, and compare.

Comparison: row count, column names and types, then every value after
sorting columns by name and rows by all columns (exact equality; floats
are compared bit for bit).
"""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlens.sources.testdata import TABLES  # noqa: E402

SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].astype(object).where(df[c].notna(), None)
    key = df.map(lambda v: (v is None, repr(v)))
    order = sorted(range(len(df)), key=lambda i: tuple(key.iloc[i]))
    return df.iloc[order].reset_index(drop=True)


def compare(spark, con, name: str, spark_df, sql: str) -> tuple[bool, str]:
    duck = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in duck.description}
    ddf = duck.fetchdf()
    sdf = spark_df.toPandas()
    stypes = dict(spark_df.dtypes)
    if sorted(sdf.columns) != sorted(ddf.columns):
        return False, f"columns differ: spark={sorted(sdf.columns)} duck={sorted(ddf.columns)}"
    bad_types = {c: (stypes[c], duck_types[c]) for c in stypes
                 if SPARK_TO_DUCK.get(stypes[c], stypes[c]).upper() != duck_types[c].upper()}
    if bad_types:
        return False, f"types differ: {bad_types}"
    if len(sdf) != len(ddf):
        return False, f"rows differ: spark={len(sdf)} duck={len(ddf)}"
    a, b = _canon(sdf), _canon(ddf)
    for c in a.columns:
        for i, (x, y) in enumerate(zip(a[c], b[c])):
            same = (x is None and y is None) if (x is None or y is None) else bool(x == y)
            if not same:
                return False, f"value differs col={c} row={i}: spark={x!r} duck={y!r}"
    return True, f"{len(sdf)} rows"


def main(argv: list[str]) -> int:
    from ledgerlens.plans.catalogue import QUERIES
    from ledgerlens.plans.oracle import oracle_queries
    from ledgerlens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(oracle_queries())
    spark = local_session(8)
    con = duck_connection(sf_dir)
    sqls = oracle_queries()
    failed = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, QUERIES[n](spark, sf_dir), sqls[n])
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e)[:300]}"
        failed += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {msg}", flush=True)
    print(f"{len(names) - failed}/{len(names)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
