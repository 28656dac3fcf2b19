"""Scans (S1-S6, S8, S9, S11).

Every reader takes an explicit schema: inference costs a full extra pass over the input and
is unstable across files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.sources import schemas


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """One driver table (Parquet). Column pruning and filter pushdown happen in the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",") -> DataFrame:
    """Delimited text with a given schema; empty strings read as NULL."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """Space separated ``node1 node2`` pairs, no header."""
    return read_csv(spark, path, schemas.EDGES, header=False, sep=" ")


def tolerant_double(c: Column | str) -> Column:
    """A field that does not parse as a number becomes 0.0 (quotes already removed by the reader)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(col).try_cast("double"), F.lit(0.0))


def read_labelled_csv(
    spark: SparkSession,
    path: str,
    feature_cols: list[str] | None = None,
    label_col: str = "Class",
    drop_cols: Iterable[str] = ("Time",),
) -> DataFrame:
    """Header CSV → ``(features ARRAY<DOUBLE>, label INT)``.

    Quotes are stripped by the CSV reader; a non-numeric feature becomes 0.0; lines with one
    field (blank or broken) are dropped; a path that doesn't exist yields an empty DataFrame of
    the same schema, any other failure is raised.
    """
    feature_cols = feature_cols or [c for c in schemas.TXN_FEATURES if c not in set(drop_cols)]
    out_schema = "features array<double>, label int"
    try:
        # header names, every column a string: no inference pass, columns matched by name
        raw = spark.read.option("header", True).option("mode", "PERMISSIVE").option("nullValue", "\u0000").option("emptyValue", "").csv(path)
        raw.schema  # noqa: B018 - resolves the path
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], out_schema)
    # a line without a separator fills the first column only
    present = F.size(F.filter(F.array(*[F.col(c) for c in raw.columns]), lambda x: x.isNotNull()))
    return (
        raw.filter(present > 1)
        .select(
            F.array(*[tolerant_double(c) for c in feature_cols]).alias("features"),
            F.coalesce(F.col(label_col).try_cast("double"), F.lit(0.0)).cast("int").alias("label"),
        )
    )


def read_warehouse(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Any DataFrame source by format name (the connector jar is supplied by the user)."""
    return spark.read.format(fmt).options(**options).load()


def sql_source(spark: SparkSession, query: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL text over temp views."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def small_table(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A small driver-side table (parameters, grids, dimension rows) — never data."""
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int = 5) -> dict:
    """Schema, columns, first rows and emptiness without a full count."""
    return {"schema": df.schema, "columns": df.columns, "head": df.take(n), "is_empty": df.isEmpty()}
