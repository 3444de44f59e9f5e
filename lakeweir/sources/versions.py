"""Whole writes to plain Parquet tables: a folder per write, and one small file, written last, that makes it count.

A write puts its files below ``_versions`` of the table, out of every reader's sight, and then
creates ``_commits/<number>.json``, which names what it moves into the table and what it replaces.
From then on the write counts: ``read_table`` finds moved and unmoved parts alike, and whoever
writes next finishes the moves of a writer that stopped. At rest the table is plain Parquet again,
for readers of any kind. Two writers that read the same version want the same number, which only
one of them gets.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMITS, VERSIONS = "_commits", "_versions"


class ConcurrentWriteError(RuntimeError):
    """Another writer committed since this one read the table."""


@dataclass(frozen=True)
class Version:
    """``items`` move from ``folder`` into the table; ``drops`` leave it. ``ledger``: newest batch of each stream."""

    number: int
    folder: str
    schema: StructType
    items: tuple[str, ...]
    drops: tuple[str, ...] = ()
    ledger: Mapping[str, int] = field(default_factory=dict)
    done: bool = False

    def text(self) -> str:
        return json.dumps({
            "number": self.number, "folder": self.folder, "schema": self.schema.jsonValue(),
            "items": list(self.items), "drops": list(self.drops), "ledger": dict(self.ledger),
        })

    @staticmethod
    def parse(text: str, done: bool) -> Version | None:
        """None for the file of a writer that stopped while writing it."""
        try:
            found = json.loads(text)
            return Version(
                found["number"], found["folder"], StructType.fromJson(found["schema"]), tuple(found["items"]),
                tuple(found["drops"]), found["ledger"], done,
            )
        except (ValueError, KeyError, TypeError):
            return None


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _target(spark, path)
    return bool(fs.exists(target))


def children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _target(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def data_children(spark: SparkSession, path: str) -> list[str]:
    return [name for name in children(spark, path) if name[0] not in "_."]


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _target(spark, path)
    fs.delete(target, True)


def _move(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _target(spark, old)
    target = _target(spark, new)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target) and fs.exists(source):
        raise OSError(f"cannot rename {old} to {new}")


def _read(spark: SparkSession, path: str) -> str:
    fs, target = _target(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str = "") -> None:
    """Write a file that must not be there yet."""
    fs, target = _target(spark, path)
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            raise ConcurrentWriteError(f"{path} is another writer's") from error
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def state(spark: SparkSession, path: str) -> tuple[Version | None, int]:
    """The newest committed write of the table at ``path``, None if it has none, and the next write's number."""
    path = path.rstrip("/")
    names = children(spark, f"{path}/{COMMITS}")
    numbers = sorted(int(name[:-5]) for name in names if re.fullmatch(r"\d+\.json", name))
    for number in reversed(numbers):
        text = _read(spark, f"{path}/{COMMITS}/{number:010d}.json")
        if version := Version.parse(text, f"{number:010d}.done" in names):
            return version, numbers[-1] + 1
    return None, (numbers[-1] if numbers else 0) + 1


def _literal(path: str) -> str:
    """A path that the reader's patterns take as it stands."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, **options: str) -> DataFrame:
    """The rows of the table at ``path`` as of its newest commit; one without commits is read as it stands."""
    path = path.rstrip("/")
    version, _ = state(spark, path)

    def read(base: str, names: Sequence[str]) -> DataFrame:
        rows = spark.read.options(**options).option("basePath", base).schema(schema or version.schema)
        return rows.parquet(*[_literal(f"{base}/{name}") for name in names])

    if version is None:
        reader = spark.read.options(**options)
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    if version.done:
        if not data_children(spark, path):
            return spark.createDataFrame([], schema or version.schema)
        rows = spark.read.options(**options).schema(schema or version.schema).parquet(path)
        return rows.select(*(schema or version.schema).fieldNames())
    # A writer is at work, or stopped: what it has not moved yet is read where it is.
    folder = f"{path}/{version.folder}"
    unmoved = [name for name in version.items if exists(spark, f"{folder}/{name}")]
    gone = {*version.drops, *unmoved}
    depth = max((name.count("/") for name in version.items), default=0)
    kept = [name for name in _leaves(spark, path, depth) if name not in gone]
    fields = (schema or version.schema).fieldNames()
    parts = [read(base, names).select(*fields) for base, names in ((path, kept), (folder, unmoved)) if names]
    if not parts:
        return spark.createDataFrame([], schema or version.schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Data files of a plain folder (depth 0), or partition folders ``depth`` levels further down."""
    names = data_children(spark, path)
    for _ in range(depth):
        names = [f"{name}/{child}" for name in names for child in data_children(spark, f"{path}/{name}")]
    return names


def write_files(df: DataFrame, folder: str, by: Sequence[str] = (), gather: bool = True) -> tuple[str, ...]:
    """Write ``df`` to ``folder`` and name its files, or its partition folders. Nothing reads them yet.

    The rebalance hint gathers each partition's rows into few files, and lets adaptive execution
    split a partition that holds most of the rows over several tasks. It shuffles all rows; without
    ``gather`` each task writes a file to every partition it has rows of.
    """
    if by:
        (df.hint("rebalance", *by) if gather else df).write.partitionBy(*by).parquet(folder)
    else:
        df.write.parquet(folder)
    return tuple(_leaves(df.sparkSession, folder, max(0, len(by) - 1)))


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Make a written version count."""
    _create(spark, f"{path}/{COMMITS}/{version.number:010d}.json", version.text())


def finish(spark: SparkSession, path: str, version: Version) -> None:
    """Move a committed version into the table and drop what it replaces. May run again, whole or in part."""
    folder = f"{path}/{version.folder}"
    for name in version.drops:
        remove(spark, f"{path}/{name}")
    for name in version.items:
        if exists(spark, f"{folder}/{name}"):
            remove(spark, f"{path}/{name}")
            _move(spark, f"{folder}/{name}", f"{path}/{name}")
    done = f"{path}/{COMMITS}/{version.number:010d}.done"
    if not exists(spark, done):
        _create(spark, done)


def clean(spark: SparkSession, path: str, version: Version) -> None:
    """Delete older commit files, and folders of this and older numbers, leftovers of stopped writers among them.

    Folders with higher numbers belong to writers at work.
    """
    for part, limit in ((COMMITS, version.number - 1), (VERSIONS, version.number)):
        for name in children(spark, f"{path}/{part}"):
            number = re.match(r"\d+", name)
            if number and int(number[0]) <= limit:
                remove(spark, f"{path}/{part}/{name}")


def begin(spark: SparkSession, path: str) -> tuple[Version | None, int]:
    """Finish what a stopped writer left and return the table's ``state``, to read from and commit upon."""
    path = path.rstrip("/")
    version, number = state(spark, path)
    if version is not None and not version.done:
        finish(spark, path, version)
        clean(spark, path, version)
        version, number = state(spark, path)
    return version, number


def commit(
    df: DataFrame, path: str, by: Sequence[str] = (), *, base: tuple[Version | None, int] | None = None,
    ledger: Mapping[str, int] | None = None, also: Sequence[str] = (), gather: bool = True,
) -> Version:
    """Write ``df`` to the table at ``path``, whole or not at all; ``df`` may read the table.

    Without ``by`` it replaces all rows; with it, the partitions that ``df`` has rows of, and those
    that ``also`` names as folders (``a=1/b=2``), which go if ``df`` has no rows of them. ``base`` is
    what ``begin`` returned before ``df`` was derived: if another writer has committed since, this
    raises and the table keeps that writer's rows. ``ledger`` entries stay with the table. ``gather``
    is for ``write_files``.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before, number = base or begin(spark, path)
    folder = f"{VERSIONS}/{number:010d}-{uuid.uuid4().hex[:12]}"
    items = write_files(df, f"{path}/{folder}", by, gather)
    if by:
        drops = tuple(name for name in also if name not in items and exists(spark, f"{path}/{name}"))
    else:
        drops = tuple(data_children(spark, path))
    version = Version(number, folder, df.schema, items, drops, {**(before.ledger if before else {}), **(ledger or {})})
    publish(spark, path, version)
    finish(spark, path, version)
    clean(spark, path, version)
    return version
