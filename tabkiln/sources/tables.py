"""Table sources and sinks.

Reads are lazy; Catalyst pushes column pruning and filters into the parquet
scan.  CSV reads take an explicit schema when one is known, since schema
inference is an extra full pass over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing: pandas skips NaN where Spark only skips NULL."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """Header CSV (S1).  Empty fields load as NULL, NaN is normalised to NULL."""
    reader = spark.read.option("header", header).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` at ``path`` in ``buckets`` files sorted by ``key``, as catalog table ``table``, and read it.

    Joins and aggregations by ``key`` over tables with the same number of
    buckets need no shuffle.  An existing table of that name raises.  Rows move
    once, here; a bucket should fit a task (about 256 MB of files).
    """
    placed = df.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_reports(report: DataFrame, path: str, keys: Sequence[str] = ("level", "kind")) -> None:
    """One report table split into folders by ``keys``.

    The reference writes one CSV per level and kind; here a single long table is
    written once, partitioned by those columns.
    """
    write_parquet(report, path, partition_by=keys)


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files as documents ``(path, text)``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
