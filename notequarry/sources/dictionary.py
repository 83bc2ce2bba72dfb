"""Term dictionary and concept tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table, read in parallel by ranges of a numeric column."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def dictionary_table(raw: DataFrame) -> DataFrame:
    """Rows CUI, RINDEX, TCOUNT, TEXT, RWORD, typed and named."""
    return raw.select(
        F.col("CUI").cast("bigint").alias("cui"),
        F.col("RINDEX").cast("int").alias("rindex"),
        F.col("TCOUNT").cast("int").alias("tcount"),
        F.col("TEXT").cast("string").alias("term"),
        F.col("RWORD").cast("string").alias("rword"),
    )


def concept_tables(
    tui: DataFrame, pref_term: DataFrame, codes: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """One concept table from a tui, a preferred-term and any code tables.

    ``codes`` maps a scheme to its table (cui, code) and the type of its codes,
    ``long`` or ``text``. A concept in several schemes has several rows; one in
    none has a single row without code.
    """
    base = tui.select("cui", "tui").join(pref_term.select("cui", "pref_term"), "cui", "full_outer")
    listed = None
    for scheme, (frame, kind) in codes.items():
        typed = F.col("code").cast("bigint").cast("string") if kind == "long" else F.col("code").cast("string")
        one = frame.select("cui", F.lit(scheme).alias("scheme"), typed.alias("code"))
        listed = one if listed is None else listed.unionByName(one)
    if listed is None:
        return base.withColumn("scheme", F.lit(None).cast("string")).withColumn(
            "code", F.lit(None).cast("string")
        )
    return base.join(listed, "cui", "left")
