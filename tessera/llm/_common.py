"""Helpers shared by the operators of this subpackage: scratch tables in the
cluster's shared folder, files on any store, global row numbers, prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    with files that survive any executor, and gives Spark exact sizes."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as the struct ``_in``, so that no name of theirs
    meets an operator's own; ``select("_in.*")`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda
    variable, so the optimizer can't inline a costly expression)."""
    return F.transform(F.array(value), body)[0]


def global_index(df: DataFrame, keys: list[str], name: str, index_col: str = "_idx") -> DataFrame:
    """Rows with their position (from 0) in ascending order of ``keys``.

    Range partitioned and sorted, so no key lands whole in one task; the
    position is the row's number in its partition plus the rows of earlier
    partitions.  Only a table of one row per partition is broadcast.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("_mid", F.monotonically_increasing_id()), name)
    # the upper bits are the partition, the lower 33 the row's number in it
    part = (part.withColumn("_part", F.shiftright("_mid", 33))
            .withColumn("_row", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("_mid"))
    sizes = sorted((r["_part"], r["n"]) for r in
                   part.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per partition
    before, base = [], 0
    for p, size in sizes:
        before.append((p, base))
        base += size
    offsets = spark.createDataFrame(before, "_part long, _before long")
    return (part.join(F.broadcast(offsets), "_part")
            .withColumn(index_col, F.col("_row") + F.col("_before")).drop("_part", "_row", "_before"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is.  ``lower`` does that, and fast,
    for texts without other capitals (letters, title case, enclosed letters
    and numerals)."""
    other = text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(other, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def prefix_sums(values: Column, block: int = 512) -> Column:
    """Exclusive prefix sums of an array of long, in two levels so that the
    cost stays near linear for very long arrays."""
    def scan(arr, start):
        acc = F.aggregate(
            arr, F.struct(F.array().cast("array<bigint>").alias("a"), start.alias("s")),
            lambda acc, x: F.struct(F.concat(acc["a"], F.array(acc["s"])).alias("a"), (acc["s"] + x).alias("s")))
        return acc["a"]

    def blocks(arr):
        n = F.ceil(F.size(arr) / F.lit(block)).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(arr, i * block + 1, block))

    def total(arr):
        return F.aggregate(arr, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def two_level(arr):
        return let(blocks(arr), lambda bs: let(
            scan(F.transform(bs, total), F.lit(0).cast("bigint")),
            lambda starts: F.flatten(F.zip_with(bs, starts, scan))))

    return F.when(F.size(values) > 0, two_level(values)).otherwise(F.array().cast("array<bigint>"))


def open_store(path: str):
    """(filesystem, path in it) for a path of any store Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def arrow_schema(columns: str):
    """The Arrow schema of a flat ``name type, ...`` list (works on executors)."""
    import pyarrow as pa

    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, types[t]) for n, t in (c.split() for c in columns.split(","))])


def batch_of(rows: list[tuple], columns: str):
    """A record batch of row tuples."""
    import pyarrow as pa

    schema = arrow_schema(columns)
    values = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
