"""What the operators share: tables, whole rows under one name, normal forms of text columns, ranks without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.session import materialise, new_path

#: The white space of the contracts, `[\x20\x09-\x0D]`.
WHITE_SPACE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_rows(df: DataFrame) -> DataFrame:
    """Every column packed into ``row``, so that columns an operator adds never clash with those of its input."""
    return df.select(F.struct("*").alias("row"))


def text_of(column: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def without_white_space(text: Column) -> Column:
    for character in WHITE_SPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def held_out(doc_id: Column) -> Column:
    """Rows that no learner may see: crc32 of the id as text is divisible by five. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def packed(df: DataFrame, label: str) -> DataFrame:
    """``materialise`` with a stronger compression, for tables of long digests."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, *order: Column, rank: str = "rank") -> DataFrame:
    """Adds the place (from 0) in a total order of all rows without sorting them in one task.

    Rows are range-partitioned, sorted and written with a running number; the only window over everything has one row
    per partition.
    """
    numbered = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()),
        "ranked",
    )
    # the identifier is the partition in the upper 31 bits and the row in the lower 33
    numbered = numbered.withColumn("__part", F.shiftright("__place", 33))
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    place = F.col("__start") + F.col("__place").bitwiseAND((1 << 33) - 1)
    return numbered.join(starts, "__part").withColumn(rank, place).drop("__part", "__place", "__start")
