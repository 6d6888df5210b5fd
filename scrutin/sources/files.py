"""File sources and sinks.

Readers take an explicit schema where one is known (no inference pass over
the data); writers partition by year so that readers prune files.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scrutin import schema as S
from scrutin.functions import exprs as X
from scrutin.operators import joins as J

OPEN_DATA_SEP = ";"
STAGE_SEP = ","


def read_csv(spark: SparkSession, path: str, sep: str = STAGE_SEP,
             schema: T.StructType | str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header; all columns as text when no schema is given
    (typing is the job of the cleaning step)."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, path: str, fmt: str | None = None, sep: str = STAGE_SEP,
               schema: T.StructType | str | None = None) -> DataFrame:
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, sep, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                mode: str = "overwrite", whole: bool = False) -> str:
    """Write a stage table (header for CSV, no index), optionally
    partitioned (``annee`` gives readers partition pruning).

    Overwriting a partitioned table replaces only the partitions that ``df``
    has rows of, so one year can be written again without the others;
    ``whole`` replaces the table.
    """
    w = df.write.mode(mode)
    by = [c for c in partition_by or () if c in df.columns]
    if by:
        w = w.partitionBy(*by)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic" if by and not whole else "static")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def heading(name: str) -> str:
    """A heading without accents, case, byte-order mark or punctuation: ``Code du
    département`` is ``code_du_departement``."""
    plain = "".join(ch for ch in unicodedata.normalize("NFKD", name) if not unicodedata.combining(ch))
    return re.sub(r"[^a-z0-9]+", "_", plain.lower()).strip("_")


def canonical_headings(columns: Sequence[str]) -> list[str]:
    """The canonical name of each heading; those without one, and all but the
    first of several for one name, keep their own."""
    out: list[str] = []
    for c in columns:
        name = S.OPEN_DATA_HEADINGS.get(heading(c), c)
        out.append(c if name in out or name != c and name in columns else name)
    return out


def read_open_data(spark: SparkSession, path: str, regions: Sequence[int] | None = S.REGION_DEPARTMENTS,
                   sep: str = OPEN_DATA_SEP, encoding: str = "UTF-8") -> DataFrame:
    """S5, open data: a ``;`` file whose headings come in any spelling, under
    canonical names, as text; only the rows of the region's departments.  A code
    counts as a number, so ``09`` and ``9`` are one; a file without a department
    column keeps all rows."""
    raw = read_csv(spark, path, sep, encoding=encoding)
    df = raw.toDF(*canonical_headings(raw.columns))
    if regions is None or S.DEPT not in df.columns:
        return df
    return df.where(X.to_int(S.DEPT).isin(list(regions)))


#: File names of a type's tables, first found first.
DATASET_FILES = {"socio_economic": ("socio_economic", "insee_data", "socio")}


def collect_datasets(spark: SparkSession, root: str, years: Sequence[int] = (2017, 2022),
                     types: Sequence[str] = ("presidentielle", "legislative", "socio_economic"),
                     fmt: str = "parquet", sep: str = OPEN_DATA_SEP,
                     regions: Sequence[int] | None = S.REGION_DEPARTMENTS) -> dict[str, DataFrame]:
    """Tables keyed ``type_year`` from ``root/type_year.<fmt>`` on any file
    system that Spark reads (``insee_data_year`` or ``socio_year`` serve as
    ``socio_economic_year`` too); CSV files are read as open data, for the
    region.  Missing files are skipped, but none at all is an error."""
    out: dict[str, DataFrame] = {}
    for y in years:
        for t in types:
            found = [p for p in (os.path.join(root, f"{n}_{y}.{fmt}") for n in DATASET_FILES.get(t, (t,))) if exists(spark, p)]
            if found:
                out[f"{t}_{y}"] = read_open_data(spark, found[0], regions, sep) if fmt == "csv" else read_table(spark, found[0], fmt)
    if not out:
        raise FileNotFoundError(f"no {fmt} dataset of {list(types)} x {list(years)} in {root}")
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of its own file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def stacked_datasets(datasets: dict[str, DataFrame]) -> DataFrame:
    """S7 single-table form: ``unionByName`` with type and year columns."""
    return J.stack_datasets(datasets)
