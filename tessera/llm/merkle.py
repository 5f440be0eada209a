"""Merkle manifest of a table: one digest for all rows, a proof for each.

A row is a leaf (:func:`leaf_digest`); per group (``source``) the leaves in
order of their ids form a tree of fanout 3, and the groups' roots in order of
the group form another one on top.

Slot pivot: a level's nodes are numbered in their group, so a node's parent is
``pos div 3`` and its slot ``pos mod 3``.  Conditional aggregates by (group,
parent) spread the children into the columns c0, c1, c2; the columns together
are hashed to the parent's digest, and without a child's own column they are
its siblings.  The way up grows from the root down: a parent's row with its
way is spread into its children's rows, so the lower a level, the longer the
rows, but each is made once and only those of the last but one are shuffled.
The first level's pivot carries the leaves' ids and other columns along, so
that the last step needs no join with them.

Scale: texts are read once and hashed where they are read; all else moves
digests.  Positions come from one distributed sort of narrow rows, and a
parent's key (group, parent) has three rows, so a hot group is as many keys
as it has runs.  The number of jobs is that of the levels, the logarithm of
the largest group; each level is written, a third of the one before.

Defined results: nulls are hashed as ``-``; a null id comes first in its
group and is never tampered with; rows that share an id are ordered by their
digests, so repeated rows are equal leaves; the null group comes first; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import global_index, stored

FANOUT = 3
SLOTS = range(FANOUT)
STEP = "array<struct<l:string,r:string>>"  # a way up: the siblings left and right of the node, level by level


def leaf_digest(*values: Column) -> Column:
    """H of columns: ``-`` for null, else the value's bytes counted in front of it."""
    def field(value):
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(field, values)), 256)


def _pivot(nodes: DataFrame, also: list[str] = []) -> DataFrame:
    """Runs of a level: (g, p, n, digest, c0..c2, and the columns ``also`` by
    slot), n being the number of nodes of the level above.  A group's only
    node goes up as it is."""
    def slot(name, i):
        return F.max(F.when(F.col("pos") % FANOUT == i, F.col(name)))

    runs = nodes.groupBy("g", "n", F.expr(f"pos div {FANOUT}").alias("p")).agg(
        *[slot("digest", i).alias(f"c{i}") for i in SLOTS], *[slot(name, i).alias(f"{name}{i}") for name in also for i in SLOTS])
    digest = F.when(F.col("n") == 1, F.col("c0")).otherwise(F.sha2(F.concat_ws("", *[f"c{i}" for i in SLOTS]), 256))
    return runs.withColumn("digest", digest).withColumn("alone", F.col("n") == 1).withColumn("n", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}"))


def _levels(nodes: DataFrame, largest: int, name: str, also: list[str] = []) -> list[DataFrame]:
    """The pivots of all levels, the leaves' first; a group is in those up to its root's."""
    out = [stored(_pivot(nodes, also), f"{name}-1")]
    while largest > FANOUT ** len(out):
        below = out[-1].where("n > 1").select("g", "n", F.col("p").alias("pos"), "digest")
        out.append(stored(_pivot(below), f"{name}-{len(out) + 1}"))
    return out


def _children(pivot: DataFrame, ways: DataFrame, also: list[str] = []) -> DataFrame:
    """The rows of a pivot's children with their way up, from those of the
    runs: (g, pos, digest, ``also``, top, way)."""
    def siblings(own, slots):
        return F.concat_ws("", *[f"c{i}" for i in slots]) if slots else F.lit("")

    def child(i):
        step = F.struct(siblings(i, range(i)).alias("l"), siblings(i, range(i + 1, FANOUT)).alias("r"))
        return F.struct((F.col("p") * FANOUT + i).alias("pos"), F.col(f"c{i}").alias("digest"), *[F.col(f"{a}{i}").alias(a) for a in also],
                        F.when(F.col("alone"), F.array().cast(STEP)).otherwise(F.array(step)).alias("step"))

    joined = pivot.join(ways.select("g", F.col("pos").alias("p"), "top", "way"), ["g", "p"])
    rows = joined.select("g", "top", "way", F.explode(F.filter(F.array(*map(child, SLOTS)), lambda c: c["digest"].isNotNull())).alias("c"))
    return rows.select("g", "c.pos", "c.digest", *[f"c.{a}" for a in also], "top", F.concat("c.step", "way").alias("way"))


def _ways(levels: list[DataFrame], tops: DataFrame, also: list[str] = []) -> DataFrame:
    """The leaves with their way up; ``tops`` (g, top, way) holds each group's root's."""
    def roots(pivot):
        return pivot.where("n = 1").select("g", F.col("p").alias("pos")).join(tops, "g")

    ways = roots(levels[-1])
    for upper, lower in zip(levels[:0:-1], levels[-2::-1]):
        ways = _children(upper, ways).select("g", "pos", "top", "way").unionByName(roots(lower).select("g", "pos", "top", "way"))
    return _children(levels[0], ways, also)


def manifest(docs: DataFrame, leaf: Column, *, group: Column, order: Column, tampered: Column | None = None) -> DataFrame:
    """One row per leaf: id (``order``), leaf, subroot, root, way (siblings
    left and right, level by level), and ``tampered``, the digest of the row
    as it may have been changed (null: as it was).  An id may be null."""
    narrow = stored(docs.select(order.cast("long").alias("id"), group.cast("string").alias("grp"), leaf.alias("digest"),
                                (F.lit(None).cast("string") if tampered is None else tampered).alias("tampered")), "leaves")
    rows = global_index(narrow, ["grp", "id", "digest"], "ordered")
    # the first position of a group is its key from here on
    groups = stored(rows.groupBy("grp").agg(F.min("_idx").alias("g"), F.count(F.lit(1)).alias("n")), "groups")
    count, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    leaves = (rows.join(groups.withColumnRenamed("grp", "own"), F.col("grp").eqNullSafe(F.col("own")))
              .select("g", "n", (F.col("_idx") - F.col("g")).alias("pos"), "digest", "id", "tampered"))
    levels = _levels(leaves, largest or 1, "level", ["id", "tampered"])
    subroots = levels[0].where("n = 1").select("g", "digest")
    for pivot in levels[1:]:
        subroots = subroots.unionByName(pivot.where("n = 1").select("g", "digest"))
    # the groups' roots, in order of the groups, are the leaves of the upper tree
    upper = global_index(subroots, ["g"], "subroots").select(
        F.lit(0).cast("long").alias("g"), F.lit(count).cast("long").alias("n"), F.col("_idx").alias("pos"), "digest", F.col("g").alias("id"))
    upper_levels = _levels(upper, count, "upper", ["id"])
    root = upper_levels[-1].select("digest").first()
    top = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("g"), F.lit(None).cast("string").alias("top"), F.array().cast(STEP).alias("way"))
    tops = stored(_ways(upper_levels, top, ["id"]).select(F.col("id").alias("g"), F.col("digest").alias("top"), "way"), "tops")
    return _ways(levels, tops, ["id", "tampered"]).select(
        "id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(root[0] if root else None).alias("root"), "way", "tampered")


def folded(leaf: Column, way: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(way, leaf, lambda node, x: F.sha2(F.concat(x["l"], node, x["r"]), 256))


def proof_digest(way: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(way, lambda x: F.concat(x["l"], x["r"])), ""), 256)


def verified_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` by source, checked against rows of which
    some have lost their line breaks (columns of the query)."""
    names = ("doc_id", "source", "lang", "n_chars")
    leaf = leaf_digest(*map(F.col, names), F.col("text"))
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & (F.instr("text", "\n") > 0)
    tampered = F.when(hit, leaf_digest(*map(F.col, names), F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    rows = manifest(docs, leaf, group=F.col("source"), order=F.col("doc_id"), tampered=tampered)
    return (rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("way")).alias("proof_sha256"),
                        folded(F.coalesce("tampered", "leaf"), F.col("way")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
