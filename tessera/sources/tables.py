"""Driver tables (Parquet) and the listing views built from them.

Reading goes through ``spark.read.parquet`` so column pruning and filter
pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# A session setting for small inputs on one machine (a file of one row group
# is one task); a cluster leaves it unset and no text is ever shuffled here.
MIN_TEXT_PARTITIONS = "tessera.minTextPartitions"
TEXT_TABLES = ("documents", "pages", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(MIN_TEXT_PARTITIONS, None) if name in TEXT_TABLES else None
    return df.repartition(int(n)) if n else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views named like the tables, for SQL users."""
    for t in TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)
