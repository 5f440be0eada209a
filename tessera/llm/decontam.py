"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Every benchmark item is cut into windows of ``window`` consecutive words (an
item of fewer is one window).  A window is the set of its shingles of
``SHINGLE`` words; a document that holds the window holds all of them, so it
is enough to look for one, its prefix:

1. The windows' shingles are counted over all documents, and each window's
   shingles are ordered by rarity; the rarest is its prefix.
2. The documents' shingles are joined with the prefixes.  Only shingles that
   are prefixes leave the pass, with their position and the words around it.
3. Length and positional bounds: a window whose prefix lies ``o`` words after
   its start can only begin ``o`` words before the hit, and must fit into the
   document.
4. What is left is compared word by word, over spans as long as the item's
   window.

Scale: the documents are read twice (counts, hits) and never shuffled.  The
hashes that they are joined with are broadcast, ``BLOCK`` (4 MB) at most at a
time: a larger benchmark takes a pass over the documents for each block, whose
rows are written before the next one begins.  A passage
that a third of all documents hold makes one row a hit; those rows are joined
by hash, which Spark may split, and regrouped by document.

Defined results: null and empty texts have no words and no hits; null item
texts have no windows; repeated rows get results of their own; an empty
benchmark hits nothing; an empty table gives no rows; a null item id is
listed as an empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import ascii_lower, let, stored, whole_row

# What separates words, and the words of a window.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 4
BLOCK = 500_000
_DOCUMENT = -1  # the position of the row that each document has besides its hits


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def shingles(words: Column, widths: list[int]) -> Column:
    """array of (pos, hash) of the shingles of each width."""
    def of(k):
        return F.when(F.size(words) >= k, F.transform(
            F.sequence(F.lit(0), F.size(words) - k),
            lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(k), *[words[i + j] for j in range(k)]).alias("hash")))
        ).otherwise(F.array().cast("array<struct<pos:int,hash:bigint>>"))
    return F.concat(*[of(k) for k in widths])


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words, n), and (window_id, item_id)."""
    cut = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), words_of(F.col(text_col)).alias("w"))
    each = cut.where(F.size("w") > 0).select("item_id", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))), lambda i: F.slice("w", i + 1, window))).alias("words"))
    pairs = stored(each.distinct(), "windows")
    windows = stored(pairs.select("words").distinct().withColumn("window_id", F.monotonically_increasing_id())
                     .withColumn("n", F.size("words")), "windows")
    return windows, pairs.join(windows, "words").select("window_id", "item_id")


def _blocks(hashes: DataFrame) -> int:
    return -(-max(1, hashes.count()) // BLOCK)


def _among(rows: DataFrame, hashes: DataFrame, blocks: int, then) -> DataFrame:
    """``then`` of the rows whose hash is listed.  One block of the list is
    broadcast at a time, so ``then`` may aggregate by hash only."""
    if blocks == 1:
        return then(rows.join(F.broadcast(hashes), "hash", "left_semi"))
    out = None
    for b in range(blocks):
        part = hashes.where(F.pmod("hash", F.lit(blocks)) == b)
        found = stored(then(rows.join(F.broadcast(part), "hash", "left_semi")), "among")
        out = found if out is None else out.unionByName(found)
    return out


def contamination_hits(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, item_id: str = "item_id", item_text: str = "text",
                       text_col: str = "text", carry: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: _row, carried columns, n_words; occurrences: _row, start,
    end, window_id; window items)."""
    windows, window_items = benchmark_windows(items, item_id, item_text, window)
    width = F.least(F.col("n"), F.lit(SHINGLE))
    widths = sorted(r["k"] for r in windows.select(width.alias("k")).distinct().collect()) or [SHINGLE]  # SHINGLE rows at most
    parts = stored(windows.select("window_id", F.explode(F.filter(
        shingles(F.col("words"), widths), lambda s: s["pos"] <= F.col("n") - width)).alias("s")).select("window_id", "s.pos", "s.hash"), "shingles")

    words = docs.select(*carry, words_of(F.col(text_col)).alias("_w"))
    sought = parts.select("hash").distinct()
    rarity = _among(words.select(F.explode(shingles(F.col("_w"), widths)).alias("s")).select("s.hash"), sought, _blocks(sought),
                    lambda rows: rows.groupBy("hash").agg(F.count(F.lit(1)).alias("freq")))
    prefix = stored(parts.join(rarity, "hash", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "hash", F.col("pos").alias("offset"))).alias("p"))
        .where("p.freq > 0").select("window_id", "p.hash", "p.offset"), "prefix")

    own = F.xxhash64(F.lit("document"))
    document = F.array(F.struct(F.lit(_DOCUMENT).alias("pos"), own.alias("hash")))
    listed = prefix.select("hash").unionByName(docs.sparkSession.range(1).select(own.alias("hash"))).distinct()
    blocks, number = _blocks(listed), F.monotonically_increasing_id().alias("_row")
    numbered = words.select("*", number)
    if blocks > 1:  # all passes must see the same numbers
        numbered = stored(docs.select(*carry, F.col(text_col).alias("_t"), number), "numbered").select("_row", *carry, words_of(F.col("_t")).alias("_w"))
    each = numbered.withColumn("_s", F.concat(document, shingles(F.col("_w"), widths)))
    exploded = each.select("_row", *carry, "_w", F.explode("_s").alias("s")).select("_row", *carry, "_w", "s.pos", "s.hash")
    is_document = F.col("pos") == _DOCUMENT
    start = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    hits = stored(_among(exploded, listed, blocks, lambda rows: rows.select(
        "_row", *[F.when(is_document, F.col(c)).alias(c) for c in carry], F.size("_w").alias("n_words"), "pos", "hash", start.alias("from"),
        F.when(~is_document, F.slice("_w", start + 1, 2 * window)).alias("around"))), "hits")

    documents = hits.where(is_document).select("_row", *carry, F.col("n_words").cast("long").alias("n_words"))
    begin = F.col("pos") - F.col("offset")
    occurrences = (hits.where(~is_document).select("_row", "n_words", "pos", "hash", "from", "around")
                   .join(prefix.join(windows, "window_id"), "hash")
                   .where((begin >= 0) & (begin + F.col("n") <= F.col("n_words")))
                   .where(F.slice("around", begin - F.col("from") + 1, F.col("n")) == F.col("words"))
                   .select("_row", begin.alias("start"), (begin + F.col("n")).alias("end"), "window_id").distinct())
    return documents, occurrences, window_items


def covered(spans: Column) -> Column:
    """Words under an array of (start, end), sorted."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
        F.greatest(s["end"], a["end"]).alias("end")))["n"]


def _digests(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(n), text) for n in (1, 2)]


def contamination_report(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                         digests: bool = False, **kw) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated; with ``digests`` two 64-bit hashes of its text, d1 and d2."""
    carry = ["doc_id", "d1", "d2"] if digests else ["doc_id"]
    d1, d2 = _digests(F.col(text_col))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), d1.alias("d1"), d2.alias("d2"))
    documents, occurrences, window_items = contamination_hits(narrow, items, carry=carry, **kw)
    found = stored(occurrences, "occurrences")
    hit = found.groupBy("_row").agg(covered(F.array_sort(F.collect_set(F.struct("start", "end")))).alias("n_hit"))
    item_ids = (found.select("_row", "window_id").distinct().join(window_items, "window_id").select("_row", "item_id").distinct()
                .groupBy("_row").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    n_hit, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return documents.join(hit.join(item_ids, "_row"), "_row", "left").select(
        *carry, "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents that aren't contaminated, with the columns of ``docs``.

    What goes is told by id (null equals null) and text, as it is the text
    that is contaminated: rows without an id go too, and a clean row that
    shares its id with a contaminated one stays.
    """
    bad = (contamination_report(docs, items, id_col=id_col, text_col=text_col, digests=True, **kw).where("contaminated")
           .select("doc_id", "d1", "d2").distinct())
    d1, d2 = _digests(F.col("_in")[text_col])
    rows = docs.select(whole_row(docs)).withColumn("_d1", d1).withColumn("_d2", d2)
    same = F.col("_in")[id_col].eqNullSafe(F.col("doc_id")) & (F.col("_d1") == F.col("d1")) & (F.col("_d2") == F.col("d2"))
    return rows.join(bad.hint("shuffle_hash"), same, "left_anti").select("_in.*")
