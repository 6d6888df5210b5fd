"""Helpers shared by the operators: inputs, written stages, row keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a local session
    without that setting (tests) gets a scratch folder of its own; on a
    cluster an unset folder is an error, since executors do not share disks."""
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if base:
        return base
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="scrutin-llm-")
    spark.conf.set(CHECKPOINT_CONF, base)
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below the shared folder and
    read it again, so later steps survive lost executors and do not repeat
    the work."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key() -> Column:
    """16 bytes that stand for a text; null and the empty text are one."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def only(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns; those that are missing come as null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])
