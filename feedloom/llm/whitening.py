"""Embeddings whitened along the leading directions of their covariance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.bidiagonal import EPS, leading_directions
from feedloom.llm.chunks import releasing
from feedloom.session import materialise

#: Components that are given, and the whole numbers that entries become.
COMPONENTS, STEPS, OFFSET = 8, 1024, 100_000
#: Entries of greater size count as this; up to it doubles hold whole numbers.
LARGEST = 1 << 53
#: Rows of a block that is reduced at once, and bytes of triangles that a task stacks.
BLOCK, STACK = 1 << 12, 64 << 20
_LOW = 26


@dataclass
class Fit:
    """Rows, sums per dimension, and the directions: values, unit columns, trace of covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float


def whole_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(positions, x)`` by length of the vectors of a batch's second column that count."""
    column = batch.column(1)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False),
                     column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    starts = np.cumsum(sizes) - sizes
    # A null entry reads as not a number.
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    fine = (sizes > 0) & (bad[starts + sizes] == bad[starts])
    for size in np.unique(sizes[fine]):
        at = np.flatnonzero(fine & (sizes == size))
        scaled = np.floor(values[starts[at][:, None] + np.arange(size)] * STEPS)
        yield at, np.clip(scaled, -LARGEST, LARGEST).astype(np.int64) + OFFSET


def vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"))


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Rows of the commonest length (of equals the greatest) and exact sums per dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in whole_rows(batch):
                own = held.setdefault(x.shape[1], [0, 0, 0])
                own[0] += len(x)
                own[1] += (x >> _LOW).sum(axis=0)
                own[2] += (x & ((1 << _LOW) - 1)).sum(axis=0)
        for size, (n, high, low) in held.items():
            yield pa.RecordBatch.from_pydict({
                "size": np.full(size, size), "pos": np.arange(size), "n": np.full(size, n),
                "high": high, "low": low})

    parts = rows.mapInArrow(releasing(add), "size long, pos long, n long, high long, low long")
    total = materialise(parts.groupBy("size", "pos").agg(
        *[F.sum(name).alias(name) for name in ("n", "high", "low")]), "sums")
    common = total.where("pos = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return 0, []
    own = total.where(F.col("size") == common["size"]).orderBy("pos").collect()
    return common["n"], [(row.high << _LOW) + row.low for row in own]


def deviations(x: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """``n x - S``, exact."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, totals)) < 1 << 62:
        return x * n - np.array(totals, dtype=np.int64)
    return x.astype(object) * n - np.array(totals, dtype=object)


def squares(rows: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; null beyond a long."""
    if (rows.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0) < float(1 << 62):
        return (rows.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in rows]
    return [one if one < 1 << 63 else None for one in exact]


def triangle(rows: DataFrame, n: int, totals: list[int]) -> np.ndarray:
    """R of the QR decomposition of all centred rows.

    A task reduces its rows block by block to one triangle; the triangles of some tasks are then
    stacked and reduced again until one is left. Its size is that of the dimensions squared.
    """
    size = len(totals)

    def reduced(parts: list[np.ndarray]) -> np.ndarray:
        found = np.linalg.qr(np.concatenate(parts), mode="r")
        return np.concatenate([found, np.zeros((size - len(found), size))])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, held, count = np.zeros((size, size)), [], 0
        for batch in batches:
            for _, x in whole_rows(batch):
                if x.shape[1] != size:
                    continue
                held.append(deviations(x, n, totals).astype(np.float64) / n)
                count += len(x)
                if count >= max(BLOCK, 2 * size):
                    top, held, count = reduced([top, *held]), [], 0
        if held:
            top = reduced([top, *held])
        if top.any():
            yield pa.RecordBatch.from_pydict({"r": pa.array([top.tobytes()], pa.binary())})

    def stack(frame: pd.DataFrame) -> pd.DataFrame:
        found = reduced([np.frombuffer(one).reshape(size, size) for one in frame["r"]])
        return pd.DataFrame({"r": [found.tobytes()]})

    numbered = F.monotonically_increasing_id()
    parts = materialise(rows.mapInArrow(releasing(reduce), "r binary"), "triangles")
    width = max(2, min(32, STACK // (8 * size * size)))
    while (left := parts.count()) > 1:
        groups = -(-left // width)
        dealt = parts.withColumn("group", F.pmod(F.xxhash64(numbered), F.lit(groups)))
        parts = materialise(dealt.groupBy("group").applyInPandas(stack, "r binary"), "triangles")
    last = parts.first()
    return np.zeros((size, size)) if last is None else np.frombuffer(last.r).reshape(size, size)


def fitted(embeddings: DataFrame, components: int = COMPONENTS) -> Fit:
    """The whitening of all vectors: nothing is sampled."""
    rows = vectors(embeddings)
    n, totals = sums(rows)
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    r = triangle(rows, n, totals)
    values, directions = leading_directions(r, components)
    return Fit(n, totals, values / n, directions, float((r ** 2).sum()) / n)


def projected(embeddings: DataFrame, fit: Fit) -> DataFrame:
    """``(vec_id, deviation, whitened)`` of the vectors that count, ``whitened`` by component.

    A component without variance (to double precision) has null entries.
    """
    deviates = fit.values > (len(fit.sums) * EPS) ** 2 * fit.values.max(initial=0.0)
    scaled = fit.directions / np.sqrt(np.where(deviates, fit.values, np.inf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in whole_rows(batch):
                if x.shape[1] != len(fit.sums):
                    continue
                off = deviations(x, fit.n, fit.sums)
                found = (off.astype(np.float64) / fit.n) @ scaled
                flat = pa.array(found.ravel(), mask=~np.tile(deviates, len(found)))
                edges = np.arange(len(found) + 1, dtype=np.int32) * len(deviates)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(squares(off), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(edges), flat)],
                    names=["vec_id", "deviation", "whitened"])

    return vectors(embeddings).mapInArrow(
        releasing(run), "vec_id long, deviation long, whitened array<double>")


def whitened_rows(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    Vectors that are null, empty, or hold null or non-finite entries are left out, and so are those
    of another length than most have. Entries become whole numbers, the sums and deviations are
    exact (a deviation beyond a long is null); entries above 2^53 in size count as that. There are
    as many components as dimensions if those are fewer. A component without variance has null
    whitened entries and takes no part in the error, which is null where there is no other. Rows
    that repeat count and come back each, null ids stay null, no vectors give no rows, other
    columns are ignored. The error is measured on the rows that are returned.
    """
    fit = fitted(embeddings, components)
    if not fit.n:
        empty = ("vec_id long, component int, n long, deviation long, whitened double, "
                 "explained double, identity_error double")
        return embeddings.sparkSession.createDataFrame([], empty)
    rows = materialise(projected(embeddings, fit), "whitened")
    entry = [F.get("whitened", F.lit(i)) for i in range(len(fit.values))]
    off = [F.abs(F.covar_pop(entry[i], entry[j]) - float(i == j))
           for i in range(len(entry)) for j in range(i + 1)]
    error = rows.agg(F.array_max(F.array(*off)).alias("error")).first()["error"]
    share = [float(v) / fit.trace if fit.trace else None for v in fit.values]
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"),
        "deviation", "whitened",
        F.get(F.array(*[F.lit(s).cast("double") for s in share]), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
