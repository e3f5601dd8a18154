"""Reading source tables: parquet folders, or a database read in parallel slices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    slice_column: str,
    lower: int | date,
    upper: int | date,
    slices: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table or a parenthesised query in `slices` ranges of one column.

    The bounds only set the stride: rows outside them still land in the first or last slice.
    Credentials come in through `properties`, never from this package.
    """
    return spark.read.jdbc(
        url=url,
        table=query,
        column=slice_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=slices,
        properties={"fetchsize": "10000", **(properties or {})},
    )


# Mark, in a column's metadata, of codes that are clean already. It stays with a table that is written and read back.
CLEAN = "clean_code"


def clean_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Code columns without trailing blanks and in capitals.

    The source databases compare codes without regard to case or trailing blanks. Columns that this function
    cleaned before are left as they are: clean a table once, where it is stored, and tests on its codes reach the scan.
    """
    rough = [c for c in columns if not df.schema[c].metadata.get(CLEAN)]
    own = {c: F.upper(F.rtrim(F.col(c))).alias(c, metadata={**df.schema[c].metadata, CLEAN: True}) for c in rough}
    return df.select(*[own.get(c, F.col(f"`{c}`")) for c in df.columns]) if own else df
