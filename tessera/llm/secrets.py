"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Candidates are found in every whole text: assignments to secret names, access
key ids, hex runs, and generic mixed tokens.  The value of each is hashed, and
the hashes are counted corpus-wide by distinct repositories and owners.  A
value that many owners hold is a widely copied example; one that stays with
few owners and looks random is owner-specific and taken for live.  The base
spans are always reported; generic tokens are added where they are live.

Positions: the texts between matches and the matches themselves alternate, so
a match starts at the summed lengths before it (``prefix_sums``, near linear
in the number of matches).

Scale: one pass over the texts gives narrow rows; only candidates are shuffled.
Counts are of distinct (hash, owner, repository) rows, aggregated before the
shuffle, so a value in a third of all documents costs a row a task; Spark may
split the join with it.  Spans are regrouped by a row number written with them.

Defined results: null text is empty; a null owner or repository counts as one
of its own; repeated rows and null ids get results of their own; an empty
table gives no rows; no text is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import let, prefix_sums, stored, whole_row

# The patterns of the base kinds, in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # AKIA and a run, 18 characters or more in all
HEX = r"[0-9a-f]{16,}"
MIN_ASSIGNED = 12
# The method's own kind: runs of 20 and more with a digit and both cases.
TOKEN = r"[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "token")
# Words that mark a value as made up.
PLACEHOLDERS = r"(?i)(example|sample|dummy|changeme|placeholder|your|test|xxxx|1234567890|abcdef)"


def _matches(text: Column, pattern: str, kind: int, value) -> Column:
    """Leftmost matches that do not overlap: array of (start, kind, end, value)."""
    def place(found):
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
        sizes = F.transform(found, lambda m: F.length(m).cast("long"))

        def spans(g, n):
            before = prefix_sums(F.zip_with(F.slice(g, 1, F.size(n)), n, lambda a, b: a + b))
            starts = F.zip_with(before, F.slice(g, 1, F.size(n)), lambda a, b: a + b)
            return F.transform(found, lambda m, i: let(starts, lambda s: F.struct(
                s[i].alias("start"), F.lit(kind).alias("kind"), (s[i] + F.length(m)).alias("end"), value(m).alias("value"))))

        return let(gaps, lambda g: let(sizes, lambda n: spans(g, n)))

    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, place(found)).otherwise(empty))


def candidate_spans(text: Column) -> Column:
    """All candidates of a text, by start and kind."""
    whole = lambda m: m
    assign = F.filter(_matches(text, ASSIGN, 0, lambda m: F.regexp_extract(m, ASSIGN, 2)), lambda s: F.length(s["value"]) >= MIN_ASSIGNED)
    token = F.filter(_matches(text, TOKEN, 3, whole), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"))
    return F.array_sort(F.concat(assign, _matches(text, ACCESS, 1, whole), _matches(text, HEX, 2, whole), token))


def entropy(value: Column) -> Column:
    """Bits a character."""
    def bits(chars):
        return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a - let(
            F.size(F.filter(chars, lambda x: x == c)) / F.size(chars), lambda p: p * F.log2(p)))
    return let(F.filter(F.split(value, ""), lambda c: c != ""), bits)


def looks_random(value: Column, min_entropy: float) -> Column:
    return ~value.rlike(PLACEHOLDERS) & (entropy(value) >= min_entropy)


def named(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def with_spans(docs: DataFrame, carry: Column, text_col: str, repository: Column, owner: Column) -> DataFrame:
    """``carry``, ``_spans``, ``_repository``, ``_owner`` and a row number ``_row`` (store it before use)."""
    return docs.select(carry, candidate_spans(F.coalesce(F.col(text_col), F.lit(""))).alias("_spans"),
                       F.coalesce(repository, F.lit("")).alias("_repository"), F.coalesce(owner, F.lit("")).alias("_owner"),
                       F.monotonically_increasing_id().alias("_row"))


def ownership(spans: DataFrame) -> DataFrame:
    """Per candidate hash: distinct owners and repositories."""
    holders = spans.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = holders.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def judged(found: DataFrame, *, max_owners: int = 2, max_repositories: int = 4, min_entropy: float = 2.5) -> DataFrame:
    """Per row number with candidates: ``_judged``, its spans with ``live``."""
    spans = found.select("_row", F.col("_owner").alias("owner"), F.col("_repository").alias("repository"), F.explode("_spans").alias("s"))
    spans = spans.withColumn("hash", F.sha2("s.value", 256))
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    live = (spans.join(ownership(spans), "hash")
            .select("_row", F.struct("s.start", "s.kind", "s.end", (few & looks_random(F.col("s.value"), min_entropy)).alias("live")).alias("s")))
    return live.groupBy("_row").agg(F.array_sort(F.collect_list("s")).alias("_judged"))


def secret_report(docs: DataFrame, *, repository: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans,
    n_live, n_example."""
    found = stored(with_spans(docs, F.col(id_col).alias("doc_id"), text_col, repository, owner), "spans")
    out = found.join(judged(found.where(F.size("_spans") > 0), **limits), "_row", "left")
    base = F.filter("_spans", lambda s: s["kind"] < 3)
    final = F.filter(F.coalesce("_judged", F.array()), lambda s: (s["kind"] < 3) | s["live"])

    def n(test):
        return F.size(F.filter(F.coalesce("_judged", F.array()), test)).cast("long")

    def of_kind(k):
        return F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return out.select("doc_id", *map(of_kind, range(3)),
                      F.sha2(named(base), 256).alias("base_sha256"), named(final).alias("spans"),
                      n(lambda s: s["live"]).alias("n_live"), n(lambda s: (s["kind"] < 3) & ~s["live"]).alias("n_example"))


def redact(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each of the spans (sorted by start, may overlap) replaced."""
    def merge(acc, s):
        end = F.when(F.size(acc) > 0, F.element_at(acc, -1)["end"]).otherwise(F.lit(-1).cast("long"))
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(end, s["end"]).alias("end"))))
        return F.when(s["start"] < end, grown).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    merged = F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"), merge)

    def pieces(m):
        begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(m, lambda s: s["end"]))
        ends = F.concat(F.transform(m, lambda s: s["start"]), F.array(F.length(text).cast("long")))
        return F.array_join(F.zip_with(begins, ends, lambda b, e: F.substring(text, (b + 1).cast("int"), (e - b).cast("int"))), mark)

    return let(merged, pieces)


def remove_live_secrets(docs: DataFrame, *, repository: Column, owner: Column, text_col: str = "text", mark: str = "<secret>",
                        size_col: str | None = "n_chars", **limits) -> DataFrame:
    """``docs`` with the live credentials in their texts replaced by ``mark``
    (and ``size_col`` brought up to date where a text has changed); all other
    columns as they are, whatever their names."""
    found = stored(with_spans(docs, whole_row(docs), text_col, repository, owner), "spans")
    clean = found.where(F.size("_spans") == 0).select("_in.*")
    marked = found.where(F.size("_spans") > 0)
    joined = marked.join(judged(marked, **limits), "_row").withColumn("_live", F.filter("_judged", lambda s: s["live"]))
    changed = F.size("_live") > 0
    text = F.col("_in")[text_col]
    joined = joined.withColumn("_text", F.when(changed, redact(text, F.col("_live"), mark)).otherwise(text))

    def column(name):
        if name == text_col:
            return F.col("_text").alias(name)
        own = F.col("_in")[name]
        if name == size_col:
            own = F.when(changed, F.length("_text").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return clean.unionByName(joined.select(*map(column, docs.columns)))
