"""Embedding near-duplicates: E8 lattice cells of random projections, verified by cosine."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from feedloom.llm.components import connected_components, forest
from feedloom.session import materialise

#: Cosine from which two vectors link.
COSINE = 0.93
#: Tables, neighbouring cells probed in each, and the stretch of a projection before decoding. A
#: pair at the threshold meets in some table with a probability of about 0.99.
TABLES, PROBES, STRETCH, SEED = 4, 8, 0.8, 20
#: Rows of a cell compared in one block; a larger cell is cut into pairs of blocks.
BLOCK = 4096
#: Rows of a bucket of cells, about.
BUCKET = 1 << 16
HELD = 1 << 18


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a in (1.0, -1.0):
            for b in (1.0, -1.0):
                point = np.zeros(8)
                point[i], point[j] = a, b
                out.append(point)
    signs = 0.5 - (np.arange(256)[:, None] >> np.arange(8) & 1)
    return np.array(out + [row for row in signs if (row < 0).sum() % 2 == 0])


def nearest_even(at: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    point = np.rint(at)
    off = at - point
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(at: np.ndarray) -> np.ndarray:
    whole, half = nearest_even(at), nearest_even(at - 0.5) + 0.5
    closer = ((at - whole) ** 2).sum(axis=1) <= ((at - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def mixed(value: np.ndarray) -> np.ndarray:
    value = value.astype(np.uint64)
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def cell_keys(points: np.ndarray, table: int) -> np.ndarray:
    """One 64-bit key for each lattice point (last axis) of a table."""
    key = np.full(points.shape[:-1], table + 1, dtype=np.uint64)
    doubled = np.rint(2 * points).astype(np.int64).view(np.uint64)
    for axis in range(8):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + doubled[..., axis])
    return key


@lru_cache(maxsize=64)
def projection(table: int, size: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, size]).normal(size=(size, 8)) * STRETCH


def cells(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of unit vectors: the cell in each table, and the cells probed around it."""
    own = np.empty((len(unit), TABLES), dtype=np.uint64)
    near = np.empty((len(unit), TABLES, PROBES), dtype=np.uint64)
    for table in range(TABLES):
        at = unit @ projection(table, unit.shape[1])
        point = nearest_e8(at)
        pull = (at - point) @ neighbours().T
        top = np.argpartition(-pull, PROBES, axis=1)[:, :PROBES]
        own[:, table] = cell_keys(point, table)
        near[:, table] = cell_keys(point[:, None, :] + neighbours()[top], table)
    return own, near


def units(frame: pd.DataFrame, kind: str) -> np.ndarray:
    raw = np.frombuffer(b"".join(frame["raw"]), dtype=kind).reshape(len(frame), -1)
    raw = raw.astype(np.float64)
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def deal(frames: Iterator[pd.DataFrame], kind: str) -> Iterator[pd.DataFrame]:
    """Every vector at its own cell of each table, and as a guest at the cells it probes."""
    for frame in frames:
        for _, same in frame.groupby(frame["raw"].map(len)):
            own, near = cells(units(same, kind))
            every = np.concatenate([own[:, :, None], near], axis=2).reshape(len(same), -1)
            times = every.shape[1]
            slot = np.tile(np.arange(times), len(same))
            tag = mixed(np.repeat(same["label"].to_numpy(np.int64).view(np.uint64), times)
                        + np.uint64(same["raw"].map(len).iloc[0]))
            yield pd.DataFrame({
                "cell": (every.reshape(-1) ^ tag).view(np.int64), "slot": slot // (PROBES + 1),
                "guest": slot % (PROBES + 1) > 0,
                "node": np.repeat(same["node"].to_numpy(), times)})


def met(x, y, table: int, guest: np.ndarray) -> np.ndarray:
    """Whether pairs met in an earlier table, or in this one the other way round.

    ``x`` and ``y`` are cells and probed cells of the two sides; a pair that meets with ``y`` as a
    guest counts there if ``y`` has the larger node, or if only ``y`` probes the cell of ``x``.
    """
    (own_x, near_x), (own_y, near_y) = x, y
    seen = np.zeros(len(own_x), dtype=bool)
    for earlier in range(table):
        seen |= own_x[:, earlier] == own_y[:, earlier]
        seen |= (near_x[:, earlier] == own_y[:, earlier, None]).any(axis=1)
        seen |= (near_y[:, earlier] == own_x[:, earlier, None]).any(axis=1)
    return seen | (guest & (near_x[:, table] == own_y[:, table, None]).any(axis=1))


def compare(frame: pd.DataFrame, kind: str) -> pd.DataFrame:
    """Links of one bucket: per node the vectors it is linked to, and stars that connect it.

    A pair is counted by the table, cell and direction in which it meets first, so no list of
    pairs has to be made distinct. Rows come back as ``(node, linked, a, b)``.
    """
    node, size = frame["node"].to_numpy(), frame["size"].to_numpy()
    linked: dict[int, int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def settle(unit, i, j, guest, table):
        nonlocal held, count
        for start in range(0, len(i), HELD):
            x, y, g = i[start:start + HELD], j[start:start + HELD], guest[start:start + HELD]
            some, back = np.unique(np.concatenate([x, y]), return_inverse=True)
            own, near = cells(unit[some])
            bx, by = back[:len(x)], back[len(x):]
            seen = met((own[bx], near[bx]), (own[by], near[by]), table, g & (node[x] > node[y]))
            x, y = x[~seen], y[~seen]
            for one, other in ((x, y), (y, x)):
                keys, at = np.unique(node[one], return_inverse=True)
                for key, add in zip(keys.tolist(), np.bincount(at, weights=size[other])):
                    linked[key] = linked.get(key, 0) + int(add)
            held.append((node[x], node[y]))
            count += len(x)
            if count > 1 << 20:
                held = [forest(*map(np.concatenate, zip(*held)))]
                count = len(held[0][0])

    keys = frame[["cell", "row_block", "guest_block"]]
    for _, rows in frame.groupby(frame["raw"].map(len)).indices.items():
        near = units(frame.iloc[rows], kind)
        unit = np.zeros((len(frame), near.shape[1]))
        unit[rows] = near
        for _, at in keys.iloc[rows].groupby(["cell", "row_block", "guest_block"]).indices.items():
            at = rows[at]
            if len(at) < 2:
                continue
            mine, theirs = at[frame["mine"].to_numpy()[at]], at[frame["theirs"].to_numpy()[at]]
            if not len(mine) or not len(theirs):
                continue
            table = int(frame["slot"].iloc[at[0]])
            is_guest = frame["guest"].to_numpy()
            for start in range(0, len(mine), 512):
                part = mine[start:start + 512]
                i, j = np.nonzero(unit[part] @ unit[theirs].T >= COSINE)
                i, j = part[i], theirs[j]
                # Two owners of a cell are met from both ends; one end counts.
                fit = np.where(is_guest[j], node[i] != node[j], node[i] < node[j])
                i, j = i[fit], j[fit]
                if len(i):
                    settle(unit, i, j, is_guest[j], table)
    a, b = forest(*map(np.concatenate, zip(*held))) if held else ([], [])
    return pd.concat([
        pd.DataFrame({"node": list(linked), "linked": list(linked.values())}, dtype="Int64"),
        pd.DataFrame({"a": a, "b": b}, dtype="Int64")]).reindex(
            columns=["node", "linked", "a", "b"]).astype("Int64")


def embedding_groups(vectors: DataFrame) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors`` (vec_id, embedding, label).

    Two vectors of equal label and length link at a cosine of ``COSINE`` or more, computed in
    double precision from the given numbers. Equal vectors of a label are one node with a size,
    so copies are never paired. A null label or vector, an empty or zero vector, and one with a
    null or non-finite number link with nothing: no links, the component is the row's own id. A
    null id is never the smallest and is not kept. Repeated rows count as further vectors. Further
    columns are ignored; no rows give no rows.

    Each vector goes to its cell of every table and as a guest to the cells probed, 36 rows in
    all. A cell with more than ``BLOCK`` rows is cut into pairs of blocks that different tasks
    compare, so none gets an unbounded group.
    """
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)
                      & (F.abs(v) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & finite
                        & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.select("vec_id", "label", "embedding", usable.alias("usable"))
    same = rows.where("usable").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("size"))
    classes = materialise(same.withColumn("node", F.monotonically_increasing_id()), "classes")

    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == FloatType() else "<f8"

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(raw=[np.asarray(one, dtype=kind).tobytes()
                                    for one in frame.pop("embedding")])

    flat = classes.select("node", "label", "size", "embedding").mapInPandas(
        packed, "node long, label long, size long, raw binary")
    dealt = materialise(flat.select("node", "label", "raw").mapInPandas(
        lambda frames: deal(frames, kind), "cell long, slot int, guest boolean, node long"),
        "cells")
    per_cell = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("guest").alias("g"))
    useful = materialise(per_cell.where("n > 1 and g < n").select(
        "cell", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "useful")
    rows_left = useful.agg(F.sum("n")).first()[0] or 0
    placed = dealt.join(useful.drop("n"), "cell").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.join(flat.drop("label"), "node")
    every = F.expr("sequence(0, blocks - 1)")
    as_row = placed.where("not guest").select(
        "*", F.lit(True).alias("mine"), F.lit(False).alias("theirs"),
        F.col("block").alias("row_block"), F.explode(every).alias("guest_block"))
    as_other = placed.select(
        "*", F.lit(False).alias("mine"), F.lit(True).alias("theirs"),
        F.explode(every).alias("row_block"), F.col("block").alias("guest_block"))
    bucket = F.pmod(F.xxhash64("cell", "row_block", "guest_block"),
                    F.lit(max(16, 2 * rows_left // BUCKET)))
    found = materialise(
        as_row.unionByName(as_other).withColumn("bucket", bucket)
        .select("bucket", "cell", "row_block", "guest_block", "mine", "theirs", "slot", "guest",
                "node", "size", "raw")
        .groupBy("bucket").applyInPandas(lambda frame: compare(frame, kind),
                                         "node long, linked long, a long, b long"),
        "found")
    linked = found.where("node is not null").groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = connected_components(found.select("a", "b"))
    sized = classes.select("node", "first", "size", "label", "embedding") \
        .join(linked, "node", "left").join(joined, "node", "left")
    named = materialise(sized.select(
        "label", "embedding", "first",
        (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component")), "named")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = materialise(named.join(smallest, "component").drop("component", "first"), "known")
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where("usable").join(known, ["label", "embedding"]).select(
        "vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                             F.lit(False)))
