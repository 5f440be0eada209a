"""URL filter: rules first, then a path-template tree per host.

The paths of a host form a tree of segments, generalised level by level:

* segments with digits are grouped by their shape (digits as ``#``), the
  others together; in a group of more than ``max_words`` (``max_shapes``)
  values, those that hold at most one part in so many of its pages are
  variable and become one wildcard branch (``*``, or the shape with ``*`` for
  digits), but for branches whose share of bad labels differs from theirs;
* of the literal branches that stay, those whose share of bad labels doesn't
  differ from that of all of them together (two-proportion z) are merged into
  one branch ``~``; a branch that differs stays under its own name.  Among
  variable values z grows with their number, and few labels prove nothing
  (Bernstein's bound, the z test for many labels);
* below ``max_depth`` segments the rest of the paths of a prefix is the
  wildcard ``**`` if its branches can't differ: it is one path, or the labels
  are all good, all bad or missing.  Else the prefix branches on by the same
  rules; what all of its paths have in common is passed at once, so long urls
  cost no levels.

The leaves are templates.  The purity of a template is its share of good
labels, smoothed towards that of its host, which is smoothed towards that of
all hosts; templates below ``min_purity`` are rejected.

Scale: urls are first counted by (host, path), and each level works on counts
of (host, prefix, segment), so a host with a third of all pages shrinks to its
distinct segments before anything is joined; Spark may split those joins.
Nothing is collected.

Defined results: a url that is null or has no ``://`` has an empty host and
path, no rule and the template of the empty host; labels may be missing (a
template without any has its host's purity); repeated rows and labels count
each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import stored

URL = r"://([^/?#]*)([^?#]*)"  # the first one; host, path
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    def part(i):
        return F.coalesce(F.regexp_extract(url, URL, i), F.lit(""))
    return F.translate(part(1), UPPER, UPPER.lower()), part(2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; rules are (verdict,
    host/path).  A rule fits its host and all subdomains, and paths that start
    with its own."""
    rule = verdict = F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def _counts() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]


def _level(state: DataFrame, depth: int, max_words: int, max_shapes: int, z: float) -> DataFrame:
    """``state`` with ``prefix`` one segment longer for the paths that go on."""
    more = F.size("segments") > depth
    going = state.where(more).withColumn("segment", F.get("segments", F.lit(depth)))
    shape = F.regexp_replace("segment", "[0-9]+", "#")
    # both are stored, so that nothing but the join needs the rows of a key together and Spark may split a large group
    child = stored(going.groupBy("host", "prefix", "segment").agg(*_counts())
                   .withColumn("shape", F.when(F.col("segment").rlike("[0-9]"), shape).otherwise("")), "segments")
    group = stored(child.groupBy("host", "prefix", "shape").agg(
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("g_n"), F.sum("labelled").alias("g_labelled"), F.sum("bad").alias("g_bad")), "groups")
    limit = F.when(F.col("shape") == "", max_words).otherwise(max_shapes)
    variable = F.col("variable")
    keys = ["host", "prefix", "shape"]
    child = stored(child.join(group, keys).withColumn("variable", (F.col("values") > limit) & (F.col("n") * limit <= F.col("g_n"))), "marked")
    many = stored(child.where(variable).groupBy(keys).agg(F.sum("labelled").alias("v_labelled"), F.sum("bad").alias("v_bad")), "variable")
    wildcard = F.when(F.col("shape") == "", "*").otherwise(F.translate("shape", "#", "*"))
    share = F.col("g_bad") / F.col("g_labelled")
    spread = F.sqrt(share * (1 - share) / F.col("labelled"))
    similar = (F.col("labelled") == 0) | (F.abs(F.col("bad") / F.col("labelled") - share) <= z * spread)
    usual = F.try_divide("v_bad", "v_labelled")
    off = F.abs(F.col("bad") - F.col("labelled") * usual)
    differs = F.coalesce(off * off > (z * z + 2 * F.log(F.col("values"))) * (F.col("labelled") * usual * (1 - usual) + off / 3), F.lit(False))
    merged = (F.col("values") > 1) & F.coalesce(similar, F.lit(True))
    name = F.when(variable & ~differs, wildcard).when(variable, F.col("segment")).when(merged, "~").otherwise(F.col("segment"))
    names = child.join(many, keys, "left").select("host", "prefix", "segment", name.alias("name"))
    longer = (going.join(names, ["host", "prefix", "segment"])
              .withColumn("prefix", F.concat("prefix", F.lit("/"), "name")).select(*state.columns))
    return stored(longer.unionByName(state.where(~more)), "templates")


def _passed(state: DataFrame) -> DataFrame:
    """``state``, whose ``segments`` are those left, with ``**`` for the rest
    under prefixes that needn't branch; of the others without the segments that
    all paths of a prefix begin with."""
    more = F.size("segments") > 0
    going = state.where(more)
    rests = stored(going.groupBy("host", "prefix").agg(
        F.count(F.lit(1)).alias("paths"), F.sum("labelled").alias("g_labelled"), F.sum("bad").alias("g_bad"),
        F.min("segments").alias("first"), F.max("segments").alias("last")), "rests")
    ends = (F.col("paths") == 1) | (F.col("g_bad") == 0) | (F.col("g_bad") == F.col("g_labelled"))
    # what the least and the greatest have in common, all between them have
    other = F.array_position(F.zip_with("first", "last", lambda a, b: a.eqNullSafe(b)), False).cast("int")
    rests = rests.select("host", "prefix", ends.alias("ends"), F.when(other == 0, F.size("first")).otherwise(other - 1).alias("common"))
    start = F.array_join(F.slice("segments", F.lit(1), F.col("common")), "/")
    prefix = F.when(F.col("ends"), F.concat("prefix", F.lit("/**"))).when(F.col("common") > 0, F.concat("prefix", F.lit("/"), start)).otherwise(F.col("prefix"))
    left = F.when(F.col("ends"), F.slice("segments", 1, 0)).otherwise(F.slice("segments", F.col("common") + 1, F.size("segments")))
    passed = going.join(rests, ["host", "prefix"]).withColumns({"prefix": prefix, "segments": left}).select(*state.columns)
    return stored(passed.unionByName(state.where(~more)), "passed")


def path_templates(pages: DataFrame, labels: DataFrame, *, max_depth: int = 6, max_words: int = 30, max_shapes: int = 3,
                   z: float = 1.96, strength: float = 10.0, min_purity: float = 0.5) -> DataFrame:
    """Per (host, path): template, purity, rejected.  pages: page_id, host,
    path; labels: page_id, bad (0 or 1)."""
    labelled = labels.where(F.col("bad").isNotNull()).groupBy("page_id").agg(F.count(F.lit(1)).alias("labelled"), F.sum("bad").alias("bad"))
    urls = (pages.join(labelled, "page_id", "left").groupBy("host", "path")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("labelled", F.lit(0))).alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad")))
    state = stored(urls.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("prefix", F.lit("")), "urls")
    deepest = state.agg(F.max(F.size("segments"))).first()[0] or 0
    for depth in range(min(deepest, max_depth)):
        state = _level(state, depth, max_words, max_shapes, z)
    left = F.slice("segments", max_depth + 1, F.size("segments"))
    while deepest > max_depth:
        state = _passed(state.withColumn("segments", left))
        if state.where(F.size("segments") > 0).isEmpty():
            break
        state = _level(state, 0, max_words, max_shapes, z)
        left = F.slice("segments", 2, F.size("segments"))

    leaves = state.groupBy("host", "prefix").agg(*_counts())
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("h_labelled"), F.sum("bad").alias("h_bad"))
    n, bad = hosts.agg(F.sum("h_labelled"), F.sum("h_bad")).first()  # two numbers
    all_good = 1 - bad / n if n else 1.0
    host_good = (F.col("h_labelled") - F.col("h_bad") + strength * all_good) / (F.col("h_labelled") + strength)
    rated = hosts.select("host", host_good.alias("host_good"))
    good = (F.col("labelled") - F.col("bad") + strength * F.col("host_good")) / (F.col("labelled") + strength)
    leaves = leaves.join(rated, "host").select("host", "prefix", F.round(good, 6).alias("purity"), (good < min_purity).alias("rejected"))
    return (state.select("host", "path", "prefix").join(leaves, ["host", "prefix"])
            .select("host", "path", F.col("prefix").alias("template"), "purity", "rejected"))


def url_verdicts(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", **kw) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, template, purity."""
    host, path = host_and_path(F.col(url_col))
    pages = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("rejected"), "block").otherwise("allow")
    return (pages.join(path_templates(pages, labels, **kw), ["host", "path"]).withColumn("rule", rule)
            .select("page_id", "host", "path", "rule", F.coalesce(verdict, own).alias("verdict"), "template", "purity"))
