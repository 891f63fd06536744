"""Versioned tables: a folder of data folders and a manifest switched last.

``<base>/<name>/data/<part>`` holds Parquet, ``<base>/<name>/manifest/<n>``
the n-th state of the table: its schema and its parts (batch, folder, rows,
first id). A write fills a new data folder, checks what it observed on the
way, and only then publishes manifest n + 1 by a rename that fails if n + 1
is there. Whoever dies before that leaves the former state, and a reader
never sees half a table; of two writers at once, one fails.

A replacement has one part. An appended batch is a part named after it:
loading the batch again puts its new part in place of the old one and no
row twice. Data folders of former states stay until ``vacuum``.

File names and states go through Hadoop's file system interface, so any
shared folder Spark can write will do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Refused(ValueError):
    """The rows do not fit the table; its state is unchanged."""


class Conflict(RuntimeError):
    """Another writer published the next state first."""


@dataclass
class Part:
    batch: str
    folder: str
    rows: int
    first_id: int | None = None


@dataclass
class Manifest:
    version: int
    schema: dict
    parts: list[Part] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    @property
    def last_id(self) -> int:
        return max([p.first_id + p.rows - 1 for p in self.parts if p.first_id is not None], default=0)


def _root(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, base: str, name: str) -> list[int]:
    """Published states of a table, oldest first."""
    fs, p = _path(spark, f"{_root(base, name)}/manifest")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def manifest(spark: SparkSession, base: str, name: str, version: int | None = None) -> Manifest | None:
    """A state of a table, the last one by default; None if there is none."""
    known = versions(spark, base, name)
    if not known or (version is not None and version not in known):
        return None
    fs, p = _path(spark, f"{_root(base, name)}/manifest/{known[-1] if version is None else version:010d}")
    stream = fs.open(p)
    try:
        raw = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(raw["version"], raw["schema"], [Part(**x) for x in raw["parts"]])


def _publish(spark: SparkSession, base: str, name: str, state: Manifest) -> None:
    root = f"{_root(base, name)}/manifest"
    fs, new = _path(spark, f"{root}/.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(json.dumps(asdict(state)).encode())
    out.close()
    jvm, final = spark._jvm, _path(spark, f"{root}/{state.version:010d}")[1]
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(fs.makeQualified(new), fs.makeQualified(final), plain)
    except Py4JJavaError as e:
        fs.delete(new, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise Conflict(f"{name}: state {state.version} was published by another writer") from e
        raise


def conforming(df: DataFrame, schema: StructType, name: str = "table") -> DataFrame:
    """``df`` in the columns and order of ``schema``; a missing, extra or
    otherwise typed column is refused before anything runs."""
    have = dict(df.dtypes)
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    wrong = [f"{c} is {have.get(c, 'missing')}, not {t}" for c, t in want.items() if have.get(c) != t]
    wrong += [f"{c} is no column of it" for c in have if c not in want]
    if wrong:
        raise Refused(f"{name}: {'; '.join(wrong)}")
    return df.select(*[F.col(f"`{c}`") for c in want])


def _write_part(df: DataFrame, base: str, name: str, schema: StructType | None, metrics: dict | None,
                partition_by: tuple = ()) -> tuple[str, StructType, dict]:
    """Fill a new data folder; rows, NULLs of columns that may not have any,
    and ``metrics`` are observed by the write itself."""
    if schema is not None:
        df = conforming(df, schema, name)
    must = [f.name for f in schema.fields if not f.nullable] if schema is not None else []
    seen = Observation(f"part_{uuid.uuid4().hex}")
    watched = {"__rows": F.count(F.lit(1))}
    watched |= {f"__null_{i}": F.count_if(F.col(f"`{c}`").isNull()) for i, c in enumerate(must)}
    watched |= metrics or {}
    folder = f"data/{uuid.uuid4().hex}"
    (df.observe(seen, *[c.alias(n) for n, c in watched.items()]).write.mode("errorifexists")
       .partitionBy(*partition_by).parquet(f"{_root(base, name)}/{folder}"))
    got = dict(seen.get)
    empty = [c for i, c in enumerate(must) if got[f"__null_{i}"]]
    if empty:
        raise Refused(f"{name}: NULL in {', '.join(empty)}")
    return folder, schema if schema is not None else df.schema, got


def replace_table(df: DataFrame, base: str, name: str, schema: StructType | None = None, metrics: dict | None = None,
                  partition_by: tuple = ()) -> dict:
    """All rows of the table become those of ``df``, or nothing changes.
    Returns what was observed, rows among it as ``rows``. The last columns
    may be ``partition_by``, folders of their own."""
    spark = df.sparkSession
    last = (versions(spark, base, name) or [0])[-1]
    folder, kept, got = _write_part(df, base, name, schema, metrics, partition_by)
    _publish(spark, base, name, Manifest(last + 1, kept.jsonValue(), [Part("", folder, got["__rows"])]))
    return {"rows": got["__rows"], **{m: got[m] for m in metrics or {}}}


def append_batch(df: DataFrame, base: str, name: str, batch: str, schema: StructType | None = None,
                 id_col: str | None = None, number=None, metrics: dict | None = None) -> dict:
    """Add the rows of ``df`` as batch ``batch``, in place of those of an
    earlier load of that batch; the table is made if it is not there.

    With ``id_col``, ``number(df, start)`` gives every row its id, dense from
    ``start``: after the largest stored id, or, when a batch is loaded again,
    the batch's own former first id. Should it have grown meanwhile and
    another batch follow, its ids go on after the largest one instead, so
    that no id is ever given to two rows.
    """
    spark = df.sparkSession
    state = manifest(spark, base, name)
    parts = state.parts if state else []
    mine = next((p for p in parts if p.batch == batch), None)
    others = Manifest(0, {}, [p for p in parts if p.batch != batch])
    if schema is None and state is not None:
        schema = StructType.fromJson(state.schema)
    again = mine is not None and mine.first_id is not None
    start = None if id_col is None else mine.first_id if again else others.last_id + 1
    folder, kept, got = _write_part(df if id_col is None else number(df, start), base, name, schema, metrics)
    if id_col is not None and again and others.last_id >= start and got["__rows"] > mine.rows:
        start = others.last_id + 1  # it has grown, and the ids after it are taken
        folder, kept, got = _write_part(number(df, start), base, name, schema, metrics)
    new = Part(batch, folder, got["__rows"], start)
    parts = [new if p is mine else p for p in parts] if mine else [*parts, new]
    _publish(spark, base, name, Manifest(state.version + 1 if state else 1, kept.jsonValue(), parts))
    return {"rows": got["__rows"], "first_id": start, **{m: got[m] for m in metrics or {}}}


def read_version(spark: SparkSession, base: str, name: str, version: int | None = None, batches: list[str] | None = None) -> DataFrame:
    """The table in its last or a given state, whole or only some batches."""
    state = manifest(spark, base, name, version)
    if state is None:
        raise ValueError(f"no table {name} in {base}")
    schema = StructType.fromJson(state.schema)
    parts = [p for p in state.parts if batches is None or p.batch in batches]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{_root(base, name)}/{p.folder}" for p in parts])


def vacuum(spark: SparkSession, base: str, name: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` states and the data folders that none
    of these names, remains of writers that died included. Not while another
    writer is at work. Returns the number of folders deleted."""
    known = versions(spark, base, name)
    kept = known[-max(1, keep):]
    used = {p.folder for v in kept for p in manifest(spark, base, name, v).parts}
    fs, data = _path(spark, f"{_root(base, name)}/data")
    gone = 0
    for v in known[:-len(kept)] if kept else []:
        fs.delete(_path(spark, f"{_root(base, name)}/manifest/{v:010d}")[1], False)
    for s in fs.listStatus(data) if fs.exists(data) else []:
        if f"data/{s.getPath().getName()}" not in used:
            fs.delete(s.getPath(), True)
            gone += 1
    return gone
