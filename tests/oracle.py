"""Compares a query with its SQL in DuckDB over the same tables, as multisets of rows."""

from pathlib import Path

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return db


def rows(frame: pd.DataFrame) -> list[str]:
    def plain(v):  # noqa: ANN001, ANN202
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, (list, tuple)):
            return [plain(x) for x in v]
        if v is None or v != v:
            return None
        return float(f"{v:.10g}") if isinstance(v, float) else v

    return sorted(str([plain(v) for v in r]) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None))


def same(spark, db, folder: str, query, sql: str) -> None:  # noqa: ANN001
    got, want = query(spark, folder).toPandas(), db.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
