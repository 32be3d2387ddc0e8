"""Incremental load of source tables into the raw layer: an idempotent upsert on Parquet.

Layout of one table below the raw root::

    orders/_load=<name>/_bucket=0/ ...  what one load wrote, by key range; never changed afterwards
    _files/orders/<step>/               the table after a load: its files, with the keys they span
    _package/orders/<step>/             the batch of a load, landed once and read many times
    _marked/orders/<step>/              keys of the loaded rows that sit exactly on the mark
    _journal/orders/                    one small record per step; the last one is the state

A load writes each row it touches once. It finds the files that hold a key of the batch, writes their
rows anew together with the batch, and lists its files and the untouched ones as the next state of the
table. The journal's record makes that state the current one; a driver that dies before leaves files that no
state lists, and the batch is read again. Readers hold the files of the state they opened, and keep
them while later loads run: the files of the last ``KEPT`` states stay, older ones are removed.

Which files hold a key is found in two steps: by the keys that each file spans, and then, in the files
that this leaves, by the key column itself. Files are sorted by key, so that column is about as small as a
Bloom filter of it would be, and it gives no false answers.

A first load is recorded before it writes; data without a journal are never taken for an unfinished
first load. Lost executors only repeat tasks. One writer per table.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from functools import partial
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmarts.operators.upsert import (
    cursor_literal,
    merge,
    newer,
    newest_per_key,
    row_id,
    since,
    unseen,
    with_lineage,
)
from shopmarts.schemas import LOAD_ID, ROW_ID, TABLES, TableSpec
from shopmarts.session import STORED, together
from shopmarts.sources.folders import children, put, remove, text_of

BUCKET, LOAD, FILE = "_bucket", "_load", "_file"
SLICE, SLICES = "_slice", 4  # of a bucket, in a first load
BEGUN, DONE = "begun", "done"
KEPT = 3  # states whose files stay
_PLACE = [T.StructField(LOAD, T.StringType()), T.StructField(BUCKET, T.LongType())]
NEVER_WRITTEN = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


class LoadError(RuntimeError):
    """A load that cannot go on. Nothing was recorded, so the next run reads the same rows again."""


@dataclass(frozen=True)
class State:
    step: int
    phase: str
    load_id: str
    mark: Any
    schema: T.StructType
    rows: int  # rows the load landed
    marked: int | None = None  # the step whose file holds the keys on the mark


@dataclass(frozen=True)
class Measured:
    rows: int  # distinct keys
    mark: Any
    low: int | None  # first and last bucket
    high: int | None
    repeated: bool  # whether a key occurs more than once


class RawTable:
    """One landed table."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec) -> None:
        self.spark = spark
        self.spec = spec
        self.path = os.path.join(root, spec.name)
        self.files = os.path.join(root, "_files", spec.name)
        self.package = os.path.join(root, "_package", spec.name)
        self.marked = os.path.join(root, "_marked", spec.name)
        self.journal = os.path.join(root, "_journal", spec.name)
        self._key_and_cursor = list(dict.fromkeys([spec.key, spec.cursor]))

    def state(self) -> State | None:
        steps = children(self.spark, self.journal)
        if not steps:
            return None
        # A record that cannot be read is an error: it must not pass for a first load.
        known = json.loads(text_of(self.spark, os.path.join(self.journal, steps[-1])))
        schema = T.StructType.fromJson(known.pop("schema"))
        mark = _value(known.pop("mark"), schema[self.spec.cursor].dataType)
        return State(**known, schema=schema, mark=mark)

    def read(self) -> DataFrame:
        """The landed rows. The journal knows the columns, so no file footers are compared, and
        files older than a column read NULL for it. Later loads do not change what is read here."""
        state = self.state()
        if state is None or state.phase == BEGUN:
            raise LoadError(f"{self.spec.name} has not been loaded into {self.path}")
        return self._stored(self._paths(self._listed(state.step)), state.schema).drop(BUCKET)

    def load(self, source: DataFrame, load_id: str, in_order: bool = True) -> State:
        """Bring the source's new and changed rows in. Running it twice changes nothing.

        A source read ``in_order`` has nothing new below the mark. Without that promise every row is
        considered, and gives way to a stored version that is at least as new.
        """
        state = self.state()
        if state is None or state.phase == BEGUN:
            return self._first(source, load_id, state)
        batch, seen = self._land(source, load_id, state, in_order)
        if seen.rows == 0:
            return state
        columns = _evolve(state.schema, batch.schema)
        touched = self._touched(self._listed(state.step), batch, seen)
        current = self._stored(self._paths(touched), state.schema)
        rows = seen.rows
        if not in_order:
            batch = newer(batch, current, self.spec.key, self.spec.cursor)
            rows = batch.count()
            if rows == 0:  # a batch that is replayed after its load
                return state
        written = self._write(merge(current, batch, self.spec.key))
        mark = seen.mark if state.mark is None else max(seen.mark, state.mark)
        step = state.step + 1
        kept = self._listed(state.step).join(touched, [LOAD, BUCKET, FILE], "left_anti")
        jobs = {
            "files": lambda: self._list(kept.unionByName(self._spans(written)), step),
            "mark": lambda: self._mark(batch, mark, step, state),
        }
        together(self.spark, jobs)
        done = self._record(State(step, DONE, load_id, mark, columns, rows, step))
        self._trim(step)
        return done

    def _first(self, source: DataFrame, load_id: str, begun: State | None) -> State:
        """Replaces what an interrupted first load left, which the journal tells, and nothing else."""
        rows = self._bucketed(with_lineage(source, load_id, self.spec.key))
        columns = _nullable(rows.schema)
        if begun is None:
            if self._holds_data():
                raise LoadError(
                    f"{self.path} holds data but {self.journal} does not say which: restore the "
                    "journal, or move the data away to load anew"
                )
            begun = self._record(State(0, BEGUN, load_id, None, columns, 0))
        # Neighbouring keys stay together: what is summed by them later is combined before it is shuffled.
        written = self._write(rows.withColumn(SLICE, self._bucket(-(-self.spec.bucket_width // SLICES))))
        stored = self._stored([written], columns)
        seen = self._measure(stored)
        if seen.repeated:
            written = self._write(self._newest(stored))
            stored = self._stored([written], columns)
        step = begun.step + 1
        jobs = {
            "files": lambda: self._list(self._spans(written), step),
            "mark": lambda: self._mark(stored, seen.mark, step, None),
        }
        together(self.spark, jobs)
        done = self._record(State(step, DONE, load_id, seen.mark, columns, seen.rows, step))
        self._trim(step)
        return done

    def _holds_data(self) -> bool:
        try:
            return bool(self.spark.read.parquet(self.path).take(1))
        except AnalysisException as error:
            if error.getCondition() in NEVER_WRITTEN:
                return False
            raise

    def _land(
        self, source: DataFrame, load_id: str, state: State, in_order: bool
    ) -> tuple[DataFrame, Measured]:
        """Write the batch once, so that counting, locating and merging it see the same rows. The
        stored table is not read: the keys on the mark stand beside it."""
        key, cursor = self.spec.key, self.spec.cursor
        known = {field.name: field.dataType for field in state.schema}
        typed = source.select(
            *[F.col(c).cast(known[c]).alias(c) if c in known else F.col(c) for c in source.columns]
        )
        if in_order and state.mark is not None:
            on_mark = self._on_mark(state, typed)
            typed = unseen(since(typed, cursor, state.mark), on_mark, key, cursor)
        rows = self._bucketed(with_lineage(typed, load_id, key))
        path = os.path.join(self.package, str(state.step + 1))
        rows.write.options(**STORED).mode("overwrite").parquet(path)
        batch = self._open(path, rows.schema)
        seen = self._measure(batch)
        # Versions of one key are rare, and only then are rows compared.
        return (self._newest(batch) if seen.repeated else batch), seen

    def _on_mark(self, state: State, like: DataFrame) -> DataFrame:
        kinds = like.select(*self._key_and_cursor).schema
        return self._open(os.path.join(self.marked, str(state.marked)), kinds)

    def _mark(self, batch: DataFrame, mark: Any, step: int, state: State | None) -> None:
        """Note which loaded keys sit on the new mark. If it has not moved, the former ones still do."""
        keys = batch.select(*self._key_and_cursor)
        kind = keys.schema[self.spec.cursor].dataType
        at_mark = F.lit(False) if mark is None else F.col(self.spec.cursor) == cursor_literal(mark, kind)
        now = keys.where(at_mark)
        if state is not None and state.mark == mark:
            now = now.unionByName(self._on_mark(state, batch)).distinct()
        now.write.mode("overwrite").parquet(os.path.join(self.marked, str(step)))

    def _listed(self, step: int) -> DataFrame:
        """The files of the table after a step: ``_load, _bucket, _file, low, high, n``."""
        return self.spark.read.parquet(os.path.join(self.files, str(step)))

    def _list(self, files: DataFrame, step: int) -> None:
        files.write.mode("overwrite").parquet(os.path.join(self.files, str(step)))

    def _spans(self, written: str) -> DataFrame:
        """What a load has written, file by file; only the key column is read."""
        key = self.spec.key
        return (
            self._keys([written])
            .groupBy(LOAD, BUCKET, FILE)
            .agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n"))
        )

    def _keys(self, paths: list[str]) -> DataFrame:
        kind = self.state().schema[self.spec.key].dataType
        columns = T.StructType([T.StructField(self.spec.key, kind), *_PLACE])
        table = self.spark.read.option("basePath", self.path).schema(columns).parquet(*paths)
        return table.select(self.spec.key, LOAD, BUCKET, F.col("_metadata.file_name").alias(FILE))

    def _touched(self, listed: DataFrame, batch: DataFrame, seen: Measured) -> DataFrame:
        """The files that hold a key of the batch, and short files of its buckets, which grow that way.

        Files whose keys the batch does not reach are not opened, and of the others only keys.
        """
        keys = batch.select(F.col(BUCKET).alias("_at"), F.col(self.spec.key).alias("_key"))
        short = F.col("n") * 2 < self.spec.file_rows
        within = listed.where(F.col(BUCKET).between(F.lit(seen.low), F.lit(seen.high)))
        near = within.join(
            keys,
            (F.col(BUCKET) == F.col("_at")) & (short | F.col("_key").between(F.col("low"), F.col("high"))),
            "left_semi",
        ).select(LOAD, BUCKET, FILE, short.alias("short"))
        # The plan's names of files, which a driver that reads the table holds in any case.
        found = near.collect()
        sure = [row[:3] for row in found if row["short"]]
        if len(sure) < len(found):
            paths = [self._path(*row[:3]) for row in found if not row["short"]]
            held = self._keys(paths).join(keys, F.col(self.spec.key) == F.col("_key"), "left_semi")
            sure += held.select(LOAD, BUCKET, FILE).distinct().collect()
        return self.spark.createDataFrame([tuple(row) for row in sure], T.StructType([*_PLACE, T.StructField(FILE, T.StringType())]))

    def _path(self, load: str, bucket: int, file: str) -> str:
        return os.path.join(self.path, f"{LOAD}={load}", f"{BUCKET}={bucket}", file)

    def _paths(self, listed: DataFrame) -> list[str]:
        return [self._path(*row) for row in listed.select(LOAD, BUCKET, FILE).collect()]

    def _trim(self, step: int) -> None:
        """Remove the files that none of the last states lists, and what older loads left beside them.
        What a driver that died has not removed goes with the next load."""
        first = step - KEPT + 1
        if first <= 1:
            return
        stay = self._listed(first).select(LOAD, BUCKET, FILE)
        for later in range(first + 1, step + 1):
            stay = stay.union(self._listed(later).select(LOAD, BUCKET, FILE))
        loads = {f"{LOAD}={row[0]}" for row in stay.select(LOAD).distinct().collect()}
        here = set(children(self.spark, self.path))
        remove(self.spark, [os.path.join(self.path, name) for name in here - loads])
        for old in children(self.spark, self.files):
            if int(old) < first:
                gone = self._listed(int(old)).join(stay, [LOAD, BUCKET, FILE], "left_anti")
                remove(self.spark, self._paths(gone))
        for folder in (self.files, self.package, self.marked):
            old = [name for name in children(self.spark, folder) if int(name) < first]
            remove(self.spark, [os.path.join(folder, name) for name in old])

    def _newest(self, rows: DataFrame) -> DataFrame:
        return newest_per_key(rows, self.spec.key, self.spec.cursor)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, self._bucket())

    def _bucket(self, width: int | None = None) -> Column:
        # Integral floor division, exact for wide decimal keys and for negative ones, whose remainders
        # alone are needed: decimal arithmetic is slow.
        key, width = f"`{self.spec.key}`", width or self.spec.bucket_width
        below = f"({key} - pmod({key}, {width})) div {width}"
        return F.expr(f"if({key} < 0, {below}, {key} div {width})")

    def _measure(self, batch: DataFrame) -> Measured:
        """One pass without a shuffle, and one that shuffles 64-bit hashes of the keys. A hash that occurs
        once belongs to a key that does; keys themselves are counted only if a hash is repeated."""
        key, cursor = F.col(self.spec.key), F.col(self.spec.cursor)
        counted = batch.agg(
            F.count("*").alias("rows"),
            F.max(cursor).alias("mark"),
            F.min(BUCKET).alias("low"),
            F.max(BUCKET).alias("high"),
            F.count_if(cursor.isNull() | key.isNull()).alias("unusable"),
        )
        per_hash = batch.groupBy(F.xxhash64(key).alias("hash")).agg(F.count("*").alias("n"))
        found = together(
            self.spark,
            {"rows": counted.first, "most": per_hash.agg(F.max("n").alias("most")).first},
        )
        seen = found["rows"]
        if seen["unusable"]:
            raise LoadError(
                f"{self.spec.name}: {seen['unusable']} rows lack {self.spec.key} or {self.spec.cursor}"
            )
        rows = seen["rows"]
        if (found["most"]["most"] or 0) > 1:
            rows = batch.select(key).distinct().count()
        return Measured(rows, seen["mark"], seen["low"], seen["high"], rows < seen["rows"])

    def _open(self, path: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def _stored(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", self.path).schema(schema).parquet(*paths).drop(LOAD)

    def _write(self, rows: DataFrame) -> str:
        """Into a new folder, and its path. The rebalance joins small buckets and splits large ones;
        files are sorted by key and cut after so many rows, so that each spans few keys. Row ids follow from
        key and load, so they are made where the rows have arrived instead of being shuffled."""
        path = os.path.join(self.path, f"{LOAD}=l{uuid.uuid4().hex}")
        place = [F.col(name) for name in (BUCKET, SLICE) if name in rows.columns]
        (
            rows.drop(ROW_ID)
            .hint("rebalance", *place)
            .sortWithinPartitions(BUCKET, self.spec.key)
            .withColumn(ROW_ID, row_id(self.spec.key, F.col(LOAD_ID)))
            .select([name for name in rows.columns if name != SLICE])
            .write.options(maxRecordsPerFile=self.spec.file_rows, **STORED)
            .partitionBy(BUCKET)
            .parquet(path)
        )
        return path

    def _record(self, state: State) -> State:
        mark = None if state.mark is None else str(state.mark)
        known = {**vars(state), "schema": state.schema.jsonValue(), "mark": mark}
        put(self.spark, os.path.join(self.journal, f"{state.step:012d}.json"), json.dumps(known))
        return state


def _value(text: str | None, kind: T.DataType) -> Any:
    """A mark as Spark would collect it, from its text."""
    if text is None or isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return datetime.fromisoformat(text)
    if isinstance(kind, T.DateType):
        return date.fromisoformat(text)
    if isinstance(kind, T.DecimalType):
        return Decimal(text)
    return float(text) if isinstance(kind, T.FractionalType) else int(text)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _evolve(known: T.StructType, batch: T.StructType) -> T.StructType:
    """The known columns, then the batch's new ones."""
    added = [field for field in batch if field.name not in known.names]
    return _nullable(T.StructType(list(known) + added))


def load_tables(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    raw_root: str,
    load_id: str,
    specs: dict[str, TableSpec] = TABLES,
) -> dict[str, State]:
    """Load every given source table under one load id.

    Tables do not wait for each other. A failure is raised once the others are done; they keep
    their new state, and the failed one reads the same rows again next time.
    """
    tables = {name: RawTable(spark, raw_root, specs[name]) for name in sources}
    return together(spark, {name: partial(tables[name].load, sources[name], load_id) for name in sources})


def read_raw(
    spark: SparkSession, raw_root: str, specs: dict[str, TableSpec] = TABLES
) -> dict[str, DataFrame]:
    return {name: RawTable(spark, raw_root, spec).read() for name, spec in specs.items()}


def loads_by_id(table: DataFrame) -> DataFrame:
    """Which load brought how many rows."""
    return table.groupBy(LOAD_ID).agg(F.count("*").alias("row_count"))
