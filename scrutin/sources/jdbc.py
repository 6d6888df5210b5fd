"""Database source.

Filters and the projection are expressed on the DataFrame; Spark pushes the
IN filters and the column list into the database query.  Large tables are
read in parallel slices of a numeric column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.sources import columns as cols


def list_tables(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None,
                schema_pattern: str | None = None) -> list[str]:
    """Names of the user tables (no views, no system tables), of schemas like
    ``schema_pattern`` (``%`` and ``_`` as in SQL), from the driver's metadata."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    if properties and "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        kinds = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 1)
        kinds[0] = "TABLE"
        rows = connection.getMetaData().getTables(None, schema_pattern, "%", kinds)
        names = []
        while rows.next():  # a handful of names
            names.append(rows.getString("TABLE_NAME"))
        return sorted(names)
    finally:
        connection.close()


def code_spellings(codes: Sequence[int]) -> list[str]:
    """Plain and zero-padded text of department codes."""
    return sorted({t for c in codes for t in (str(c), f"{c:02d}", f"{c:03d}")})


def _bounds(spark: SparkSession, url: str, table: str, column: str, props: Mapping[str, str]) -> tuple[int, int] | None:
    """Least and greatest value of a column, found by the database; None for an empty table."""
    row = spark.read.jdbc(url, f"(SELECT MIN({column}) AS LO, MAX({column}) AS HI FROM {table}) b", properties=dict(props)).first()
    return None if row[0] is None else (int(row[0]), int(row[1]))


def read_jdbc(spark: SparkSession, url: str, table: str | None = None,
              properties: Mapping[str, str] | None = None,
              regions: Sequence[int] | None = S.REGION_DEPARTMENTS,
              years: Sequence[int] | None = None, rounds: Sequence[int] | None = None,
              min_year: int | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              predicates: Sequence[str] | None = None,
              table_names: Sequence[str] | None = None) -> DataFrame:
    """Resolved columns of the ballots table, filtered to the region,
    years (a list, or every year from ``min_year``) and rounds.  Filters are
    applied after resolution (decision Q26) and are pushed to the database;
    text codes are pushed in their plain and zero-padded spellings.

    The table is read in ``num_partitions`` slices of ``partition_column``,
    between the bounds, which the database is asked for if they are not given,
    or in one slice for each of the ``predicates``.
    """
    props = dict(properties or {})
    if table is None:
        table = cols.pick_table(table_names if table_names is not None else list_tables(spark, url, props))
    if (num_partitions is None) != (partition_column is None):
        raise ValueError("slices need both partition_column and num_partitions")
    if predicates and num_partitions:
        raise ValueError("give either predicates or a partition column")
    if predicates:
        loaded = spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    else:
        reader = spark.read.format("jdbc").options(**props).option("url", url).option("dbtable", table)
        if num_partitions:
            if lower_bound is None or upper_bound is None:
                found = _bounds(spark, url, table, partition_column, props) or (0, 1)
                lower_bound = found[0] if lower_bound is None else lower_bound
                upper_bound = found[1] + 1 if upper_bound is None else upper_bound
            reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                            .option("upperBound", upper_bound).option("numPartitions", num_partitions))
        loaded = reader.load()
    df = cols.resolve_columns(loaded)
    if regions is not None:
        if df.schema[S.DEPT].dataType.simpleString() == "string":
            df = df.where(F.col(S.DEPT).isin(code_spellings(regions)))
        else:
            df = df.where(F.col(S.DEPT).isin(list(regions)))
    if years:
        df = df.where(F.col(S.YEAR).isin(list(years)))
    if min_year is not None:  # the history scan: every year from min_year on
        df = df.where(F.col(S.YEAR) >= min_year)
    if rounds:
        df = df.where(F.col(S.ROUND).isin(list(rounds)))
    return df
