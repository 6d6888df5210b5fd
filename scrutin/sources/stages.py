"""Stage tables with a manifest.

A stage is a written table and, beside its files, a manifest: schema, rows,
the data files with their sizes, and what it was made from.  The manifest goes
before the write starts and comes back after it has ended, so a table whose
writer was lost in between has none.  ``read_stage`` refuses such a table, one
whose files are not those of its manifest, and one made from another input
than the stored one.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scrutin.sources import files

MANIFEST = "_manifest.json"
GIVEN = "given rows"  #: the input of a stage made from a DataFrame that is no stage


class StageError(RuntimeError):
    """A stored stage that must not be used."""


@dataclass(frozen=True)
class Manifest:
    schema: str       # JSON
    rows: int
    n_files: int
    n_bytes: int
    content: str      # digest of the data files' names and sizes
    made_from: str    # the input's identity

    @property
    def identity(self) -> str:
        """Changes with every write: part file names are never used twice."""
        return hashlib.sha256(f"{self.schema}\n{self.rows}\n{self.content}\n{self.made_from}".encode()).hexdigest()


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def _data_files(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """(path below the table, size) of every file that readers see."""
    fs, hpath, _ = _filesystem(spark, path)
    base = fs.makeQualified(hpath).toUri().getPath()
    listing = fs.listFiles(hpath, True)
    while listing.hasNext():
        status = listing.next()
        name = posixpath.relpath(status.getPath().toUri().getPath(), base)
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            yield name, status.getLen()


def _manifest_path(path: str) -> str:
    return posixpath.join(path, MANIFEST)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written under another name first, so a reader never sees half of it."""
    fs, hpath, jvm = _filesystem(spark, path)
    half = hpath.suffix(".tmp")
    out = fs.create(half, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(hpath, False)
    fs.rename(half, hpath)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hpath, jvm = _filesystem(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _found(spark: SparkSession, path: str) -> tuple[int, int, str]:
    listed = sorted(_data_files(spark, path))
    lines = "\n".join(f"{n} {s}" for n, s in listed)
    return len(listed), sum(s for _, s in listed), hashlib.sha256(lines.encode()).hexdigest()


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The stored manifest of a stage, or None."""
    if not files.exists(spark, _manifest_path(path)):
        return None
    return Manifest(**json.loads(_read_text(spark, _manifest_path(path))))


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, made_from: str = GIVEN,
                update: bool = False, emptied: Sequence = ()) -> Manifest:
    """Write a stage table and its manifest.  ``update`` rewrites only the
    partitions that ``df`` has rows of (``partition_by`` is needed), in a table
    that is whole and has the same columns; partitions of the ``emptied``
    values of the first partition column go first, also if ``df`` has no rows
    of them."""
    spark = df.sparkSession
    before = None
    if update:
        if not partition_by:
            raise ValueError("update needs partition_by")
        if files.exists(spark, path):
            before = checked(spark, path)
            if {f["name"]: f["type"] for f in json.loads(before.schema)["fields"]} != {f.name: f.dataType.jsonValue() for f in df.schema.fields}:
                raise StageError(f"{path} has other columns than the rows to update it with")
    if files.exists(spark, _manifest_path(path)):
        fs, hpath, _ = _filesystem(spark, _manifest_path(path))
        fs.delete(hpath, False)
    for value in emptied if update else ():
        fs, hpath, _ = _filesystem(spark, posixpath.join(path, f"{partition_by[0]}={value}"))
        fs.delete(hpath, True)
    files.write_table(df, path, partition_by=partition_by, whole=not update)
    n_files, n_bytes, content = _found(spark, path)
    stored = spark.read.schema(df.schema).parquet(path)
    out = Manifest(df.schema.json(), stored.count(), n_files, n_bytes, content, made_from)
    _write_text(spark, _manifest_path(path), json.dumps(asdict(out), indent=1))
    return out


def checked(spark: SparkSession, path: str, made_from: str | None = None) -> Manifest:
    """The manifest, if the stage is whole (and made from that input); else an error."""
    m = manifest(spark, path)
    if m is None:
        raise StageError(f"{path} has no manifest: it is missing or was not written to its end")
    if _found(spark, path) != (m.n_files, m.n_bytes, m.content):
        raise StageError(f"the files of {path} are not those of its manifest")
    if made_from is not None and m.made_from != made_from:
        raise StageError(f"{path} was made from another input; run its stage again")
    return m


def read_stage(spark: SparkSession, path: str, made_from: str | None = None) -> DataFrame:
    """The rows of a whole stage, with the schema of its manifest."""
    m = checked(spark, path, made_from)
    return spark.read.schema(T.StructType.fromJson(json.loads(m.schema))).parquet(path)
