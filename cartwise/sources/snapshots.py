"""Tables that change by keys without being rewritten.

A snapshot table is a folder of immutable Parquet folders, one for each partition and write, and of manifests. Rows are
parted by a hash of their keys. A manifest lists, for one version, the folders that make up each partition; a change reads and
writes only the partitions that hold its keys, and then adds the next manifest. Readers keep the version that they began with,
a table can be overwritten from itself, and a write that fails leaves the old version in place.

    data/<write>/_part=<n>/*.parquet
    manifests/<version>.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.operators import rows

PART = "_part"


class Conflict(RuntimeError):
    """Another writer has added the version that was to be added."""


@dataclass(frozen=True)
class Manifest:
    """One version: its keys, number of partitions, schema, the folders of each partition that has rows, and a writer's note."""

    version: int
    keys: list[str]
    partitions: int
    schema: str
    folders: dict[str, list[str]] = field(default_factory=dict)
    note: str = ""


def _files(spark: SparkSession, path: str):
    """Hadoop's view of ``path``: its file system and the maker of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that can be read, oldest first; none where there is no table."""
    system, make = _files(spark, path)
    folder = make(f"{path}/manifests")
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The manifest of a version, by default of the last one."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no version {version or ''} at {path}")
    name = f"{path}/manifests/{known[-1] if version is None else version:010d}.json"
    # One object, read by the driver: its size goes with the number of partitions.
    return Manifest(**json.loads(spark.read.text(name, wholetext=True).first().value))


def _publish(spark: SparkSession, path: str, new: Manifest) -> Manifest:
    """Add a manifest; renaming a finished file shows it whole, and fails where the version exists."""
    system, make = _files(spark, path)
    draft, final = make(f"{path}/manifests/_{uuid.uuid4().hex}"), make(f"{path}/manifests/{new.version:010d}.json")
    out = system.create(draft, False)
    try:
        out.write(bytearray(json.dumps(asdict(new)), "utf-8"))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(final), options)
    except Exception as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise Conflict(f"version {new.version} at {path} was added by another writer") from error
        raise
    return new


def part_of(keys: list[str], partitions: int) -> Column:
    """The partition of a row; a null key part has one as well."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(partitions)).cast("int")


def _written(df: DataFrame, path: str, keys: list[str], partitions: int) -> dict[str, list[str]]:
    """Write rows by partition into a folder of their own; the folders made, by partition."""
    spark = df.sparkSession
    folder = f"{path}/data/{uuid.uuid4().hex}"
    # Rebalancing parts the rows as the folders do, and lets a partition that is too large be written by several tasks.
    df.withColumn(PART, part_of(keys, partitions)).hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(folder)
    system, make = _files(spark, folder)
    names = [s.getPath().getName() for s in system.listStatus(make(folder)) if s.isDirectory()]
    return {n.removeprefix(f"{PART}="): [f"{folder.removeprefix(path + '/')}/{n}"] for n in names if n.startswith(f"{PART}=")}


def _frame(spark: SparkSession, path: str, known: Manifest, parts: set[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(known.schema))
    folders = [f"{path}/{f}" for p, listed in known.folders.items() if parts is None or p in parts for f in listed]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default of the last; later changes do not show in it."""
    return _frame(spark, path, manifest(spark, path, version))


def read_keys(spark: SparkSession, path: str, key_rows: DataFrame) -> DataFrame:
    """The rows whose key occurs in ``key_rows``, read from the partitions of those keys alone."""
    known = manifest(spark, path)
    return _frame(spark, path, known, _touched(key_rows, known)).join(key_rows.select(*known.keys).distinct(), known.keys, "left_semi")


def overwrite(df: DataFrame, path: str, keys: list[str], partitions: int = 64, note: str = "") -> Manifest:
    """Make ``df`` the next version; it may be derived from the table's present rows."""
    spark = df.sparkSession
    known = versions(spark, path)
    folders = _written(df, path, keys, partitions)
    return _publish(spark, path, Manifest((known or [0])[-1] + 1, keys, partitions, df.schema.json(), folders, note))


def _touched(changes: DataFrame, known: Manifest) -> set[str]:
    """Partitions that hold the keys of ``changes``: at most as many values as the table has partitions."""
    found = changes.select(part_of(known.keys, known.partitions).alias(PART)).distinct().collect()
    return {str(r[PART]) for r in found}


def _same_types(changes: DataFrame, known: Manifest) -> None:
    """Keys are hashed by type: a long and an int that are equal would fall into different partitions."""
    held = T.StructType.fromJson(json.loads(known.schema))
    for key in known.keys:
        if changes.schema[key].dataType != held[key].dataType:
            raise TypeError(f"key {key} is {changes.schema[key].dataType.simpleString()}, not {held[key].dataType.simpleString()}")


def change(
    path: str, changes: DataFrame, function: Callable[[DataFrame, DataFrame], DataFrame], note: str | None = None
) -> Manifest:
    """Put ``function(rows, changes)`` in place of the rows of the partitions that hold keys of ``changes``.

    ``function`` gets every row of those partitions and returns what they are to hold, with the same columns. ``changes`` is read
    twice; a change without rows rewrites nothing. ``note`` is stored with the version, else the last one's is kept. A version added meanwhile by another writer raises ``Conflict``.
    """
    spark = changes.sparkSession
    known = manifest(spark, path)
    _same_types(changes, known)
    touched = _touched(changes, known)
    note = known.note if note is None else note
    if not touched:
        return known if note == known.note else _publish(spark, path, replace(known, version=known.version + 1, note=note))
    before = _frame(spark, path, known, touched)
    after = function(before, changes).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in before.schema.fields])
    made = _written(after, path, known.keys, known.partitions)
    if strays := set(made) - touched:
        raise ValueError(f"the change made rows of {len(strays)} other partitions")
    kept = {p: f for p, f in known.folders.items() if p not in touched}
    return _publish(spark, path, replace(known, version=known.version + 1, folders=kept | made, note=note))


def upsert(path: str, source: DataFrame) -> Manifest:
    """Rows of ``source`` replace those of the same key; others are added. ``source`` holds each key once."""
    return change(path, source, lambda held, new: rows.upsert(held, new.select(*held.columns), _keys(path, new)))


def delete(path: str, key_rows: DataFrame) -> Manifest:
    """Remove the rows whose key occurs in ``key_rows``."""
    return change(path, key_rows, lambda held, gone: held.join(gone.select(*_keys(path, gone)).distinct(), _keys(path, gone), "left_anti"))


def update_column(path: str, changes: DataFrame, column: str) -> Manifest:
    """Set ``column`` from ``changes(key, column)``, which lists each key once."""
    return change(path, changes, lambda held, new: rows.update_column(held, new, _single_key(path, new), column))


def append_missing(path: str, keys: DataFrame, **fill) -> Manifest:
    """Add one row for every non-null key that the table lacks; other columns are null or as in ``fill``."""
    known = manifest(keys.sparkSession, path)
    key = _single_key(path, keys)
    held = _frame(keys.sparkSession, path, known, set()).schema[key].dataType
    named = keys.toDF(key).select(F.col(key).cast(held).alias(key)).where(F.col(key).isNotNull()).distinct()
    return change(path, named, lambda held, new: rows.append_missing(held, key, new, **fill))


def append(path: str, added: DataFrame) -> Manifest:
    """Add rows as folders of their own; nothing that is there is read or rewritten."""
    spark = added.sparkSession
    known = manifest(spark, path)
    _same_types(added, known)
    schema = T.StructType.fromJson(json.loads(known.schema))
    made = _written(added.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]), path, known.keys, known.partitions)
    if not made:
        return known
    folders = dict(known.folders)
    for part, listed in made.items():
        folders[part] = folders.get(part, []) + listed
    return _publish(spark, path, replace(known, version=known.version + 1, folders=folders))


def _keys(path: str, df: DataFrame) -> list[str]:
    return manifest(df.sparkSession, path).keys


def _single_key(path: str, df: DataFrame) -> str:
    keys = _keys(path, df)
    if len(keys) != 1:
        raise ValueError(f"the table has the keys {', '.join(keys)}, not one")
    return keys[0]


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Delete all versions but the last ``keep``, and the folders that only they use; the versions deleted.

    Not to be run while a change is being written: its folders are not yet in a manifest.
    """
    if keep < 1:
        raise ValueError("the last version stays")
    system, make = _files(spark, path)
    known = versions(spark, path)
    gone, kept = known[:-keep], known[-keep:]
    if not gone:
        return []
    used = {f for v in kept for listed in manifest(spark, path, v).folders.values() for f in listed}
    unused = {f for v in gone for listed in manifest(spark, path, v).folders.values() for f in listed} - used
    for version in gone:
        system.delete(make(f"{path}/manifests/{version:010d}.json"), False)
    for folder in unused:
        system.delete(make(f"{path}/{folder}"), True)
    return gone
