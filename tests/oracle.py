"""Side-by-side check of registered queries against their SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pyarrow as pa


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, list):
        return repr([_cell(x) for x in v])
    return repr(v)


def _rows(table: pa.Table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def compare(spark, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    ours = fn(spark, sf_dir).toArrow()
    theirs = duck(sf_dir).sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(set(ours.column_names) ^ set(theirs.column_names))}"
    kinds = {n: (str(ours.schema.field(n).type), str(theirs.schema.field(n).type)) for n in ours.column_names}
    odd = {n: k for n, k in kinds.items() if k[0].replace("large_", "") != k[1].replace("large_", "")}
    (names, a), (_, b) = _rows(ours), _rows(theirs)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; types {odd}"
    if a != b:
        wrong = {}
        for i, n in enumerate(names):
            x, y = sorted(r[i] for r in a), sorted(r[i] for r in b)
            diff = [(p, q) for p, q in zip(x, y) if p != q]
            if diff:
                wrong[n] = (len(diff), diff[0])
        return f"values {wrong or 'combination'}; types {odd}"
    return f"types {odd}" if odd else None
