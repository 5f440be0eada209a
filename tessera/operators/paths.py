"""Ordered group computations: monotone path (K1) and route length (K2).

Points are ``(case_id, x, y)``.  A case may hold a huge share of all points,
so nothing is done per case in one task:

1. :func:`with_previous` sorts all points globally by (case, x, y) (range
   partitioned, distributed), checkpoints the sorted table, and takes each
   point's predecessor with ``lag`` over (partition, case): a hot case is as
   many groups as it has partitions.  The first row of a partition takes its
   predecessor from the last row of the previous one, looked up in a table of
   one row per partition.
2. Feasibility is ``min(least(dx, dy)) >= 0`` per case: a plain
   aggregation with a map-side partial step.
3. :func:`path_moves` is the path in long form (case, position, move, count)
   and :func:`path_chunks` its text in pieces of bounded length; only
   :func:`monotone_path` joins the moves of a case into its string, which is as
   long as the case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

ORIGIN = (0, 0)


def with_previous(points: DataFrame, key: str | list[str] = "case_id", order_cols=("x", "y"),
                  value_cols=("x", "y")) -> DataFrame:
    """Each row with ``prev_<col>`` of its predecessor in (key, order) order,
    in the column's own type; NULL for the first row of a key."""
    keys, order_cols, value_cols = [key] if isinstance(key, str) else list(key), list(order_cols), list(value_cols)
    checkpoint_dir(points.sparkSession)
    cols = list(dict.fromkeys([*keys, *order_cols, *value_cols]))
    ordered = (points.select(*cols).orderBy(*keys, *order_cols)
               .withColumn("_pid", F.spark_partition_id())
               .checkpoint(eager=True))
    # last row of every non-empty partition, and the one before it
    last = ordered.groupBy("_pid").agg(F.max_by(F.struct(*dict.fromkeys([*keys, *value_cols])),
                                                F.struct(*keys, *order_cols)).alias("_last"))
    boundary = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_before"))
    w = Window.partitionBy("_pid", *keys).orderBy(*order_cols)
    out = ordered.withColumn("_first", F.row_number().over(w) == 1)
    for c in value_cols:
        out = out.withColumn(f"prev_{c}", F.lag(c).over(w))
    # one row per partition
    out = out.join(F.broadcast(boundary), "_pid", "left")
    fix = F.col("_first")
    for k in keys:
        fix = fix & F.col("_before")[k].eqNullSafe(F.col(k))
    for c in value_cols:
        out = out.withColumn(f"prev_{c}", F.when(fix, F.col("_before")[c]).otherwise(F.col(f"prev_{c}")))
    return out.drop("_pid", "_first", "_before")


def steps(points: DataFrame, key: str = "case_id") -> DataFrame:
    """dx, dy from the predecessor (the origin for the first point)."""
    p = with_previous(points, key)
    return (p.withColumn("dx", F.col("x") - F.coalesce("prev_x", F.lit(ORIGIN[0]).cast("long")))
            .withColumn("dy", F.col("y") - F.coalesce("prev_y", F.lit(ORIGIN[1]).cast("long"))))


def _feasible(points: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    st = steps(points.select(key, "x", "y").distinct(), key)
    return st, st.groupBy(key).agg((F.min(F.least("dx", "dy")) >= 0).alias("ok"))


def path_moves(points: DataFrame, key: str = "case_id") -> DataFrame:
    """K1 in long form: (case, x, y, rights, ups) of each point of a feasible
    case, in the order of (x, y); no case is gathered anywhere."""
    st, feasible = _feasible(points, key)
    return st.join(feasible.where("ok").select(key), key, "left_semi").select(
        key, "x", "y", F.col("dx").alias("rights"), F.col("dy").alias("ups"))


def path_chunks(points: DataFrame, key: str = "case_id", size: int = 65_536) -> DataFrame:
    """K1 as text in pieces: (case, chunk, path) with ``size`` characters in
    each chunk of a feasible case but its last one.

    A walk that never goes back has made x + y moves when it is at (x, y), so
    each point's moves know their place in the text without sums over the
    case; moves that reach over the end of a chunk are cut there.  Groups are
    (case, chunk): at most ``size`` moves each, whatever the case.  A case
    whose path is empty has no chunks."""
    m = path_moves(points, key)
    start, last = F.col("x") - F.col("rights") + F.col("y") - F.col("ups"), F.col("x") + F.col("y")
    cut = (m.where(F.col("rights") + F.col("ups") > 0)
           .select(key, start.alias("_from"), (start + F.col("rights")).alias("_turn"), last.alias("_to"),
                   F.explode(F.sequence(F.floor(start / size), F.floor((last - 1) / size))).alias("chunk")))
    low, high = F.greatest("_from", F.col("chunk") * size), F.least("_to", (F.col("chunk") + 1) * size)
    text = F.concat(F.repeat(F.lit("R"), (F.least(high, "_turn") - low).cast("int")),
                    F.repeat(F.lit("U"), (high - F.greatest(low, "_turn")).cast("int")))
    return (cut.groupBy(key, "chunk").agg(F.array_sort(F.collect_list(F.struct(low.alias("at"), text.alias("s")))).alias("_pieces"))
            .select(key, "chunk", F.concat_ws("", F.transform("_pieces", lambda z: z["s"])).alias("path")))


def monotone_path(points: DataFrame, key: str = "case_id", cases: DataFrame | None = None) -> DataFrame:
    """K1: per case ``possible`` (YES/NO) and the lexicographically smallest
    right/up path through all points (NULL when impossible).  With a table of
    ``cases`` a case without points gives YES and an empty path."""
    st, feasible = _feasible(points, key)
    good = st.join(feasible.where("ok").select(key), key, "left_semi")
    seg = F.concat(F.repeat(F.lit("R"), F.col("dx").cast("int")), F.repeat(F.lit("U"), F.col("dy").cast("int")))
    paths = (good.groupBy(key)
             .agg(F.array_sort(F.collect_list(F.struct("x", "y", seg.alias("s")))).alias("segs"))
             .select(key, F.concat_ws("", F.transform("segs", lambda z: z["s"])).alias("path")))
    out = feasible.join(paths, key, "left")
    if cases is not None:
        out = cases.select(key).distinct().join(out, key, "left").withColumn("ok", F.coalesce("ok", F.lit(True))).withColumn(
            "path", F.coalesce("path", F.lit("")))
    return out.select(key, F.when(F.col("ok"), F.lit("YES")).otherwise(F.lit("NO")).alias("possible"),
                      F.when(F.col("ok"), F.col("path")).alias("path"))


def tour_length(points: DataFrame, key: str = "case_id") -> DataFrame:
    """K2: Manhattan length of the walk from the origin through the points
    in (x, y) order."""
    st = steps(points.select(key, "x", "y"), key)
    return st.groupBy(key).agg(F.sum(F.abs("dx") + F.abs("dy")).cast("long").alias("steps"))
