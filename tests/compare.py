"""Run a registered query and its SQL side by side, as rows that ignore order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _kind(arrow_type) -> str:
    return str(arrow_type).replace("large_", "")


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, [_kind(table.schema.field(n).type) for n in names], Counter(
        tuple(_plain(v) for v in row) for row in zip(*columns))


def differences(spark_df, con, sql: str) -> list[str]:
    mine = _rows(spark_df.toArrow())
    want = _rows(con.execute(sql).to_arrow_table())
    out = []
    if mine[0] != want[0]:
        return [f"columns {mine[0]} != {want[0]}"]
    if mine[1] != want[1]:
        out.append(f"types {list(zip(mine[0], mine[1], want[1]))}")
    extra, lost = mine[2] - want[2], want[2] - mine[2]
    if extra or lost:
        out.append(f"{mine[2].total()} rows, wanted {want[2].total()}; "
                   f"extra {list(extra.items())[:3]}; lost {list(lost.items())[:3]}")
    return out
