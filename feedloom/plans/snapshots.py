"""Versioned snapshots: parquet parts, of which a log says which count and in what order.

A table is a base and the batches written since. A batch is appended, so an incremental run writes
what changed and no more; readers take the last batch per key and the base rows no batch replaces.
:func:`fold` makes a new base of them now and then, while readers of the old parts go on.

``path`` is the folder of the log and the table's name. Several tables under one folder change in
one step: what a run writes to all of them is seen whole or not at all. Parts of tables with the
same columns lie next to each other, so that a published name is one query over that folder and
the log, and moves when the log does.
"""

from __future__ import annotations

import copy
import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from feedloom import settings
from feedloom.operators.joins import small_side
from feedloom.operators.snapshot import batch_dedup, shaped_sql
from feedloom.plans import commits
from feedloom.plans.commits import Conflict, Part, State, Table

PARTS = "parts"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def located(path: str) -> tuple[str, str]:
    """Folder of the log, and the name of the table in it."""
    root, name = path.rstrip("/").rsplit("/", 1)
    return root, name


def table_state(spark: SparkSession, path: str) -> Table | None:
    root, name = located(path)
    return commits.read_state(spark, root).tables.get(name)


def known_table(state: State, path: str) -> Table:
    table = state.tables.get(located(path)[1])
    if table is None:
        raise FileNotFoundError(path)
    return table


def columns_of(table: Table) -> T.StructType:
    return T.StructType.fromJson(json.loads(table.schema))


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _nullable(kind.valueType))
    return kind


def parts_folder(path: str, table: Table) -> str:
    """Where parts with these columns lie."""
    digest = hashlib.sha256(table.schema.encode()).hexdigest()[:16]
    return f"{located(path)[0]}/{PARTS}/{digest}"


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 adds: tuple[str, ...] = ()) -> str:
    """An empty table, where there is none yet. Its batches replace rows by key, or, where columns
    are named that it ``adds``, hold differences that are summed by the other columns."""
    root, name = located(path)

    def change(state: State):
        if name in state.tables:
            return False
        state.tables[name] = Table(_nullable(schema).json(), adds=list(adds))

    commits.commit(spark, root, change)
    return path


# --- Writing ---

@dataclass
class Written:
    """A part that lies there and is not seen yet, and what is known of its rows."""

    path: str
    part: str
    rows: int
    live: int
    newest: int
    least: object = None
    most: object = None
    counts: dict | None = None


def write_part(df: DataFrame, path: str, table: Table, key: str = "id", **counts) -> Written:
    """Write rows, one per key, as a part of a table. Counts are taken as they are written."""
    seen = Observation()
    wanted = columns_of(table)
    part = f"p-{uuid.uuid4().hex}"
    time_ = F.col("timestamp") if "timestamp" in df.columns else F.lit(0)
    key_ = F.lit(None) if table.adds else F.col(key)
    measured = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), _live(df.columns).alias("live"),
        F.max(time_).alias("newest"), F.min(key_).alias("least"), F.max(key_).alias("most"),
        *[c.alias(n) for n, c in counts.items()])
    measured.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields]
                    ).write.parquet(f"{parts_folder(path, table)}/part={part}")
    got = seen.get
    return Written(path, part, got["rows"], got["live"], got["newest"] or 0, got["least"],
                   got["most"], {n: got[n] for n in counts})


def _live(columns: list[str]) -> Column:
    """Number of live rows; without a mark of removal all are."""
    return F.count_if(F.col("removed") == F.lit(False)) if "removed" in columns else F.count(
        F.lit(1))


def read_part(spark: SparkSession, written: Written, table: Table) -> DataFrame:
    return _parts(spark, written.path, table, [written.part]).drop("part")


def _replaced(spark: SparkSession, state: State, written: Written, key: str) -> tuple[int, int]:
    """Current rows that a part replaces, and how many of them are live. Only the range of keys
    that the part has is read, and only the key and the mark of removal."""
    table = known_table(state, written.path)
    if not written.rows or not table.parts:
        return 0, 0
    own = read_part(spark, written, table).select(key)
    held = read_current(spark, written.path, key, state).where(
        F.col(key).between(written.least, written.most))
    return tuple(held.join(small_side(own), key, "left_semi").agg(
        F.count(F.lit(1)), _live(held.columns)).first())


def append(spark: SparkSession, written: list[Written], writer: str | None = None,
           number: int = 0, key: str = "id", seen: State | None = None) -> State:
    """Make parts visible as the next batch of their tables, all in one step.

    A number of a named writer that was committed before changes nothing. Tables that were changed
    since ``seen``, where that is given, are a conflict.
    """
    (root,) = {located(one.path)[0] for one in written}

    def change(state: State):
        tables = [known_table(state, one.path) for one in written]
        if writer and all(t.writers.get(writer, -1) >= number for t in tables):
            return False
        before = copy.deepcopy(state)
        for one, table in zip(written, tables):
            if seen is not None and table.parts != known_table(seen, one.path).parts:
                raise Conflict(f"{one.path} was changed meanwhile")
            if one.rows:
                table.parts.append(Part(one.part, "batch"))
            if writer:
                table.writers[writer] = number
            if table.adds:
                continue
            rows, live = _replaced(spark, before, one, key)
            table.documents += one.rows - rows
            table.live += one.live - live
            table.newest = max(table.newest, one.newest)

    return commits.commit(spark, root, change)


def holds(spark: SparkSession, path: str, writer: str, number: int) -> bool:
    """Whether a writer's batch is in a table."""
    table = table_state(spark, path)
    return table is not None and table.writers.get(writer, -1) >= number


def write_batch(df: DataFrame, path: str, writer: str | None = None, number: int = 0) -> None:
    """One batch of one table."""
    spark = df.sparkSession
    table = known_table(commits.read_state(spark, located(path)[0]), path)
    append(spark, [write_part(df, path, table)], writer, number)


def write_base(df: DataFrame, path: str) -> None:
    """The base of a new snapshot. A table that holds rows belongs to another one."""
    spark, (root, name) = df.sparkSession, located(path)
    table = Table(_nullable(df.schema).json())
    written = write_part(df, path, table)

    def change(state: State):
        if name in state.tables and state.tables[name].parts:
            raise FileExistsError(f"{path} holds rows of a snapshot")
        state.tables[name] = Table(table.schema, [Part(written.part, "base")], {},
                                   written.rows, written.live, written.newest)

    commits.commit(spark, root, change)


def fold(spark: SparkSession, path: str, key: str = "id", least: int = 1) -> bool:
    """A new base of the base and the batches, if there are ``least`` batches or more.

    It is sorted by key, so that a probe for some keys skips most of it. Batches that are written
    meanwhile stay batches on top of it. If somebody else folded first, nothing changes. The old
    parts stay for those who read them, until :func:`remove_unused`.
    """
    root, name = located(path)
    state = commits.read_state(spark, root)
    table = known_table(state, path)
    if len(table.names("batch")) < least:
        return False
    order = [f for f in columns_of(table).fieldNames() if f not in table.adds] if table.adds else [key]
    rows = read_current(spark, path, key, state).repartitionByRange(*order).sortWithinPartitions(*order)
    written = write_part(rows, path, table, key)

    def change(newer: State):
        now = known_table(newer, path)
        if now.parts[:len(table.parts)] != table.parts:
            return False
        now.parts = [Part(written.part, "base"), *now.parts[len(table.parts):]]

    return Part(written.part, "base") in known_table(
        commits.commit(spark, root, change), path).parts


def drop_table(spark: SparkSession, path: str) -> None:
    """Forget a snapshot that no name shows."""
    root, name = located(path)

    def change(state: State):
        known_table(state, path)
        if any(name in shown.values() for shown in state.names.values()):
            raise Conflict(f"{path} is shown")
        del state.tables[name]

    commits.commit(spark, root, change)


def remove_unused(spark: SparkSession, root: str, older_than: float = 24 * 3600) -> list[str]:
    """Delete parts that no kept state names, once they are some seconds old: a younger one may
    just be written by somebody."""
    used = {part.name for state in commits.states(spark, root) for table in state.tables.values()
            for part in table.parts}
    gone = []
    for digest in commits.listed(spark, f"{root}/{PARTS}"):
        for folder in commits.listed(spark, f"{root}/{PARTS}/{digest}"):
            fs, path = commits._path(spark, f"{root}/{PARTS}/{digest}/{folder}")
            age = time.time() - fs.getFileStatus(path).getModificationTime() / 1000
            if folder.removeprefix("part=") not in used | {NO_PART} and age >= older_than:
                fs.delete(path, True)
                gone.append(folder.removeprefix("part="))
    return gone


# --- Reading ---

def _parts(spark: SparkSession, path: str, table: Table, names: list[str]) -> DataFrame:
    schema = columns_of(table)
    if not names:
        return spark.createDataFrame([], T.StructType(
            [*schema.fields, T.StructField("part", T.StringType())]))
    folder = parts_folder(path, table)
    return spark.read.schema(schema).option("basePath", folder).parquet(
        *[f"{folder}/part={name}" for name in names])


def read_current(spark: SparkSession, path: str, key: str = "id",
                 state: State | None = None) -> DataFrame:
    """The rows that count, now or in an earlier state."""
    state = state or commits.read_state(spark, located(path)[0])
    table = known_table(state, path)
    if table.adds:
        parts = _parts(spark, path, table, [part.name for part in table.parts]).drop("part")
        sums = parts.groupBy(*[c for c in parts.columns if c not in table.adds]).agg(
            *[F.sum(c).alias(c) for c in table.adds])
        return sums.where(" OR ".join(f"`{c}` <> 0" for c in table.adds)).select(*parts.columns)
    base = _parts(spark, path, table, table.names("base")).drop("part")
    newer = table.names("batch")
    if not newer:
        return base
    batches = _parts(spark, path, table, newer)
    if len(newer) == 1:
        latest = batches.drop("part")
    else:
        order = F.array_position(F.array(*[F.lit(name) for name in newer]), F.col("part"))
        latest = batch_dedup(batches.withColumn("__place", order), key, ["__place"]).select(
            *base.columns)
    if not table.names("base"):
        return latest
    # Only the keys decide which base rows are replaced.
    kept = base.join(small_side(batches.select(key).distinct()), key, "left_anti")
    return kept.unionByName(latest)


# --- Published names ---

PATHS_PROPERTY = "feedloom.paths"
#: Makes the folder of a table that never had a row readable.
NO_PART = "p-none"
LOG_SCHEMA = ("version bigint, tables map<string, struct<parts:array<struct<name:string,"
              "kind:string>>>>, names map<string, struct<main:string,deleted:string>>")


def view_paths(spark: SparkSession, name: str) -> list[str]:
    """What a published name points to; empty if it does not exist."""
    if not spark.catalog.tableExists(name):
        return []
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == PATHS_PROPERTY)
    row = rows.first()
    return [p for p in row["value"].split(",") if p] if row else []


def point_view(spark: SparkSession, name: str, selects: list[str], paths: list[str]) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} "
              f"TBLPROPERTIES ('{PATHS_PROPERTY}' = '{','.join(paths)}') AS "
              + " UNION ALL ".join(selects))


def _log_sql(root: str) -> str:
    """The latest state of a log. It is read whenever the query is."""
    return (f"SELECT max_by(state, state.version) AS state FROM (SELECT from_json(value, "
            f"'{LOG_SCHEMA}') AS state FROM text.`{root}/{commits.FOLDER}`)")


def current_select(root: str, name: str, role: str, folder: str, held: list[str],
                   columns: list[str] | None = None, key: str = "id") -> str:
    """SQL of :func:`read_current` for the table that plays a role (main, deleted) under a name."""
    row = ", ".join(f"`{c}`" for c in held)
    parts = (f"SELECT place, part.name AS name, part.kind AS kind FROM ({_log_sql(root)}) "
             f"LATERAL VIEW posexplode(state.tables[state.names['{name}'].{role}].parts) "
             f"AS place, part")
    of_kind = lambda kind: (
        f"parquet.`{folder}` d JOIN (SELECT * FROM ({parts}) WHERE kind = '{kind}') p "
        "ON d.part = p.name")
    return (
        f"SELECT {', '.join(columns or [f'`{c}`' for c in held])} FROM ("
        f"SELECT {row} FROM (SELECT d.* FROM {of_kind('base')}) b LEFT ANTI JOIN "
        f"(SELECT {key} AS changed FROM {of_kind('batch')}) c ON b.{key} = c.changed "
        f"UNION ALL SELECT r.* FROM (SELECT max_by(struct({row}), place) AS r "
        f"FROM {of_kind('batch')} GROUP BY {key}))")


ADDRESS_DEFAULTS = {"country_code": settings.DEFAULT_COUNTRY_CODE,
                    "country_concept_id": settings.DEFAULT_COUNTRY_CONCEPT}
OPEN_DATES = {"publication_date": settings.REMOVED_FROM_DATE,
              "last_publication_date": settings.REMOVED_TO_DATE}


def _struct_sql(path: str, kind: T.StructType, field_sql) -> str:
    fields = ", ".join(f"'{f.name}', {field_sql(f, f'{path}.`{f.name}`')}" for f in kind.fields)
    return f"IF({path} IS NULL, NULL, named_struct({fields}))"


def _address_field(field: T.StructField, path: str) -> str:
    if field.name in ADDRESS_DEFAULTS:
        return f"coalesce({path}, '{ADDRESS_DEFAULTS[field.name]}')"
    if field.name == "coordinates":
        return f"IF({path}[0] BETWEEN -180 AND 180 AND {path}[1] BETWEEN -90 AND 90, {path}, NULL)"
    return path


def _keyword_field(field: T.StructField, path: str) -> str:
    if isinstance(field.dataType, T.StructType):
        return _struct_sql(path, field.dataType, _keyword_field)
    if field.dataType == T.ArrayType(T.StringType()):
        return f"filter({path}, k -> length(k) <= {settings.KEYWORD_MAX_LENGTH})"
    return path


def shown_sql(schema: T.StructType, removed: bool = False) -> list[str]:
    """Select list of what the sink shows: an address without a country lies in Sweden, points off
    the globe and over-long keywords are left out, and removed ads pass any date filter."""
    out = []
    for f in schema.fields:
        value = f"`{f.name}`"
        if f.name == "workplace_address":
            value = _struct_sql(value, f.dataType, _address_field)
        elif f.name == "keywords" and isinstance(f.dataType, T.StructType):
            value = _struct_sql(value, f.dataType, _keyword_field)
        elif removed and f.name in OPEN_DATES:
            value = f"coalesce({value}, TIMESTAMP_NTZ '{OPEN_DATES[f.name]}')"
        out.append(f"{value} AS `{f.name}`")
    return out


def shown_again(select: str, ad: T.StructType) -> str:
    """Removed rows in the columns of an ad, as the sink shows them."""
    return f"SELECT {', '.join(shown_sql(ad, removed=True))} FROM ({select})"


def published_path(spark: SparkSession, root: str, prefix: str | None = None) -> str | None:
    """The snapshot that is published from a folder, under a name or the last one."""
    state = commits.read_state(spark, root)
    shown = state.names.get(prefix or state.last or "")
    return f"{root}/{shown['main']}" if shown else None


def show(spark: SparkSession, prefix: str, main: str, deleted: str) -> None:
    """Let a prefix show two tables: one step for all its names."""
    root, name = located(main)
    if located(deleted)[0] != root:
        raise ValueError(f"{main} and {deleted} have no common log")

    def change(state: State):
        tables = [known_table(state, path) for path in (main, deleted)]
        behind = {"main": name, "deleted": located(deleted)[1]}
        state.names[prefix] = state.names[f"{prefix}@{_columns_key(*tables)}"] = behind
        state.last = prefix

    commits.commit(spark, root, change)


def _columns_key(*tables: Table) -> str:
    return hashlib.sha256("".join(t.schema for t in tables).encode()).hexdigest()[:16]


def publish_snapshot(spark: SparkSession, prefix: str, main: str, deleted: str) -> None:
    """Let the read, stream, deleted and write names show a snapshot. A missing one is an error.

    The names are queries over the log and stay as they are: one commit moves them all, and
    whoever stops before it has moved none. Names of other columns than before (or of another
    folder) are made anew after the commit, one by one; each shows a whole snapshot at any time,
    the one before until then. They show what the sink declares: defaults for open values, keywords
    up to a length.
    """
    root, _ = located(main)
    state = commits.read_state(spark, root)
    tables = [known_table(state, path) for path in (main, deleted)]
    folders = [parts_folder(path, table) for path, table in zip((main, deleted), tables)]
    ad, slim = map(columns_of, tables)
    for folder, schema in zip(folders, (ad, slim)):
        if not path_exists(spark, folder):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(
                f"{folder}/part={NO_PART}")
    name = f"{prefix}@{_columns_key(*tables)}"
    of = lambda role, held, columns=None: current_select(
        root, name, role, folders[role == "deleted"], held, columns)
    gone_as_ad = shown_again(of("deleted", slim.fieldNames(), shaped_sql(slim, ad)), ad)
    live = of("main", ad.fieldNames(), shown_sql(ad))
    selects = {
        settings.READ_SUFFIX: [live],
        settings.STREAM_SUFFIX: [live, gone_as_ad],
        settings.DELETED_SUFFIX: [of("deleted", slim.fieldNames(), shown_sql(slim, removed=True))],
        settings.WRITE_SUFFIX: [of("main", ad.fieldNames())]}
    show(spark, prefix, main, deleted)
    for suffix, parts in selects.items():
        if view_paths(spark, prefix + suffix) != [root, name]:
            point_view(spark, prefix + suffix, parts, [root, name])
