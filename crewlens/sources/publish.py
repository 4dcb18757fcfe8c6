"""Publication of a whole set of results at once.

Every run writes into a folder of its own under ``versions``. When all of its tables are there, a
manifest is put beside it, with each table's format, schema and number of rows. Readers take the
newest manifest, so a run that stops between two tables, or is still going on, is never seen, and
the version before stays readable as a whole.
"""

import json
from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crewlens.sources.readers import read_csv
from crewlens.sources.writers import CSV

MANIFESTS, VERSIONS = "manifests", "versions"


@dataclass(frozen=True)
class Published:
    """A complete version: its number, its folder and what each table is."""

    version: int
    folder: str
    tables: Mapping[str, Mapping[str, object]]


def _files(spark: SparkSession, path: str) -> tuple[object, object]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers in the names of what lies in a folder."""
    fs, where = _files(spark, folder)
    names = [status.getPath().getName().split(".")[0] for status in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n) for n in names if n.isdigit())


def begin(spark: SparkSession, out: str) -> tuple[int, str]:
    """A new version's number and folder; the folder is made here, so that no other run takes it."""
    version = max([0, *_numbers(spark, f"{out}/{VERSIONS}"), *_numbers(spark, f"{out}/{MANIFESTS}")]) + 1
    while True:
        folder = f"{out}/{VERSIONS}/{version:08d}"
        fs, mark = _files(spark, f"{folder}/_begun")
        try:
            fs.create(mark, False).close()
            return version, folder
        except Exception:  # noqa: BLE001 - the class is Java's
            if not fs.exists(mark):
                raise
            version += 1


def commit(
    spark: SparkSession, out: str, version: int, tables: Mapping[str, tuple[str, T.StructType]], keep: int = 2
) -> Published:
    """Make a version the current one; ``tables`` are its format and schema by path in its folder.

    The rows of every table are counted as a reader would see them. ``keep`` complete versions are
    left; older ones are deleted after this one is current, and with them what runs that never
    ended have left.
    """
    folder = f"{out}/{VERSIONS}/{version:08d}"
    entries = {}
    for name, (fmt, schema) in tables.items():
        rows = _read(spark, f"{folder}/{name}", fmt, schema).count()
        entries[name] = {"format": fmt, "rows": rows, "schema": schema.jsonValue()}
    _put(spark, f"{out}/{MANIFESTS}/{version:08d}.json", json.dumps({"version": version, "tables": entries}))
    _discard(spark, out, keep)
    return Published(version, folder, entries)


def publish(
    spark: SparkSession, out: str, tables: Mapping[str, DataFrame], fmt: str = "parquet", single: Collection[str] = (), keep: int = 2
) -> Published:
    """Write all tables as one new version and make it the current one."""
    version, folder = begin(spark, out)
    for name, table in tables.items():
        written = table.coalesce(1) if name in single else table
        (written.write.options(**CSV) if fmt == "csv" else written.write).format(fmt).save(f"{folder}/{name}")
    return commit(spark, out, version, {n: (fmt, t.schema) for n, t in tables.items()}, keep)


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all."""
    fs, last = _files(spark, path)
    _, draft = _files(spark, path.replace(".json", ".draft"))
    stream = fs.create(draft, True)
    stream.write(text.encode())
    stream.close()
    if not fs.rename(draft, last):
        raise OSError(f"cannot publish {path}")


def _complete(spark: SparkSession, out: str) -> list[int]:
    """Versions with a manifest; drafts of one do not count."""
    found = []
    for number in _numbers(spark, f"{out}/{MANIFESTS}"):
        fs, manifest = _files(spark, f"{out}/{MANIFESTS}/{number:08d}.json")
        found += [number] if fs.exists(manifest) else []
    return sorted(set(found))


def _discard(spark: SparkSession, out: str, keep: int) -> None:
    complete = _complete(spark, out)
    oldest = complete[-keep:][0]
    for number in complete:
        if number < oldest:
            fs, manifest = _files(spark, f"{out}/{MANIFESTS}/{number:08d}.json")
            fs.delete(manifest, False)
    for number in _numbers(spark, f"{out}/{VERSIONS}"):
        if number < oldest:
            fs, where = _files(spark, f"{out}/{VERSIONS}/{number:08d}")
            fs.delete(where, True)


def current(spark: SparkSession, out: str) -> Published:
    """The newest complete version."""
    complete = _complete(spark, out)
    if not complete:
        raise FileNotFoundError(f"nothing is published under {out}")
    text = spark.read.text(f"{out}/{MANIFESTS}/{complete[-1]:08d}.json", wholetext=True).first()
    found = json.loads(text.value)
    return Published(found["version"], f"{out}/{VERSIONS}/{found['version']:08d}", found["tables"])


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    return read_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(path)


def read_published(spark: SparkSession, out: str, check: bool = False) -> dict[str, DataFrame]:
    """The tables of the newest complete version, lazy.

    ``check`` counts them first and fails if one does not have the rows that its manifest states.
    """
    found = current(spark, out)
    tables = {
        n: _read(spark, f"{found.folder}/{n}", str(t["format"]), T.StructType.fromJson(t["schema"])) for n, t in found.tables.items()
    }
    for name, table in tables.items() if check else ():
        rows, stated = table.count(), found.tables[name]["rows"]
        if rows != stated:
            raise ValueError(f"{name} of version {found.version} has {rows} rows, {stated} were written")
    return tables
