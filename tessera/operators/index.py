"""Vocabulary, inverted index, TF-IDF weights and document norms.

All index tables are long form, keyed by ``term`` (joins never go through a
dense id):

* ``tf``        (doc_id, term, tf)          raw count of the term in the doc
* ``doc_freq``  (term, df)                  documents holding the term
* ``idf``       (term, idf)                 log10(N / df), N = all documents
                                            (empty ones included)
* ``postings``  (term, doc_id, tf, w, wn)   w = tf * idf, wn = w / |d|
* ``norms``     (doc_id, norm)              sqrt(sum w^2)

Shuffles, in order: none for the term frequencies (counted in the document's
task, :func:`tessera.functions.text.count_terms`); the document-frequency count
on term (partial first); of the tf x idf join only the rows of rare terms
(:func:`join_terms`: the table of the frequent ones, of bounded length, is
broadcast, so most rows stay where their document is); the norms, a sum by
document of which partial sums are shuffled, joined back where ``wn`` is asked
for.  Written are tf, idf and, when first used, the norms (one row per document).

A posting list is never collected into one row: a frequent term may hold a
large share of all documents.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx


def doc_freq(tf: DataFrame, keys: list[str]) -> DataFrame:
    """I3 (first half): number of documents holding each term."""
    return tf.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("df"))


def n_docs(docs: DataFrame) -> Column:
    """N as a scalar subquery (one value, computed once, never a cross join)."""
    return docs.select(F.count(F.lit(1)).cast("double")).scalar()


def inverse_doc_freq(dfreq: DataFrame, n: Column, keys: list[str]) -> DataFrame:
    """``log10(N / df)`` (not Spark ML's smoothed ``ln((N+1)/(df+1))``)."""
    return dfreq.select(*keys, "df", F.log10(n / F.col("df")).alias("idf"))


def dense_ids(df: DataFrame, order_col: str, id_name: str, spark=None) -> DataFrame:
    """Dense 0-based ids in ``order_col`` order, without a global window.

    Range-sorts (distributed), numbers rows inside each sorted partition,
    then adds the count of all earlier partitions.  The sorted table is
    checkpointed first so both passes see the same partitions (a re-run
    would re-sample the range bounds).  The offsets table has one row per
    partition, so broadcasting it is bounded by the partition count.
    """
    from tessera.session import checkpoint_dir, freed_shuffles
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    with freed_shuffles(spark):
        ordered = (df.orderBy(order_col)
                   .withColumn("_pid", F.spark_partition_id())
                   .checkpoint(eager=True))
    w = Window.partitionBy("_pid").orderBy(order_col)
    numbered = ordered.withColumn("_rn", F.row_number().over(w))
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (numbered.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(id_name, (F.col("_off") + F.col("_rn") - 1).cast("long"))
            .drop("_pid", "_rn", "_off"))


def l2_norm() -> Column:
    return F.sqrt(F.sum(F.col("w") * F.col("w")))


def normed() -> Column:
    """``wn``: NULL for a norm of 0."""
    return F.try_divide(F.col("w"), F.col("norm"))


FREQUENT = 100_000  # terms whose rows are joined by a broadcast


def join_terms(tf: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """``tf`` with the other columns of ``terms`` (keys, df, ...), a table of
    one row per term that holds its ``df``.  At most FREQUENT terms have a share
    of 1/FREQUENT of all rows and more; they make up most rows, and as their
    table is broadcast, those are neither shuffled nor skewed.  The rows of the
    others, none of them hot, are joined by key."""
    least = terms.select(F.sum("df") / F.lit(float(FREQUENT))).scalar()
    often = terms.where(F.col("df") >= least)
    rare = tf.join(F.broadcast(often.select(*keys)), keys, "left_anti").join(terms.where(F.col("df") < least), keys)
    return tf.join(F.broadcast(often), keys).unionByName(rare)


@dataclass
class Index:
    """Handles to the index tables of one text column, or of several fields
    (then ``by`` names the key columns that stand before id and term, and N
    counts the rows per key), built or loaded."""

    tf: DataFrame
    idf: DataFrame
    n: Column
    stop: bool
    stem: bool
    fold: bool
    id_col: str
    by: tuple[str, ...] = ()
    docs: DataFrame | None = None  # None for a loaded index
    saved: DataFrame | None = None  # of a loaded index: the rows of its postings, see save_index
    blocks: DataFrame | None = None  # of a loaded index: (block, docs), the (id, norm) of a block's documents
    saved_norms: DataFrame | None = None  # (by, id, norm, top)
    whole: Index | None = None  # of an index narrowed to some terms: what it was

    @property
    def tokens(self) -> DataFrame:
        return self.tf.withColumnRenamed("tf", "n")

    @property
    def doc_freq(self) -> DataFrame:
        return self.idf.select(*self.by, "term", "df")

    @property
    def weighted(self) -> DataFrame:
        """(by, id, term, tf, w): tf x idf."""
        return (join_terms(self.tf, self.idf, [*self.by, "term"])
                .withColumn("w", F.col("tf") * F.col("idf")).drop("df", "idf"))

    @property
    def weights(self) -> DataFrame:
        """(by, term, id, tf, w): the postings but for ``wn``, so that no norm
        is computed or joined; like them, without rows that have no id."""
        rows = self.weighted if self.saved is None else self.saved
        return rows.where(F.col(self.id_col).isNotNull()).select(*self.by, "term", self.id_col, "tf", "w")

    @property
    def document_weights(self) -> DataFrame:
        """(by, id, norm, top), top the largest weight; written when first asked for."""
        if self.whole is not None:
            return self.whole.document_weights
        if self.saved_norms is None:
            from tessera.sources.files import materialize
            self.saved_norms = materialize(self.weighted.groupBy(*self.by, self.id_col).agg(l2_norm().alias("norm"), F.max("w").alias("top")), "norms")
        return self.saved_norms

    @property
    def norms(self) -> DataFrame:
        """(by, id, norm)."""
        return self.document_weights.select(*self.by, self.id_col, "norm")

    @property
    def postings(self) -> DataFrame:
        """(by, term, id, tf, w, wn), wn = w / norm (NULL for a norm of 0); of
        a loaded index with the document's ``block``."""
        if self.saved is not None:
            return with_norms(self.saved, self.blocks).select("term", self.id_col, "tf", "w", normed().alias("wn"), "block")
        return (self.weighted.join(self.norms, [*self.by, self.id_col])
                .select(*self.by, "term", self.id_col, "tf", "w", normed().alias("wn")))

    @property
    def bounds(self) -> DataFrame | None:
        """Of a loaded index: (term, block, n, w, wn), the largest weights."""
        if self.saved is None:
            return None
        return with_norms(self.saved.where("n IS NOT NULL"), self.blocks).select("term", "block", "n", F.col("top_w").alias("w"), normed().alias("wn"))

    def analyze(self, df: DataFrame, id_col: str | list[str], text_col: str) -> DataFrame:
        """Analyse other text (queries) exactly like the indexed column."""
        return tx.analyze_tokens(df, id_col, text_col, stop=self.stop,
                                 stem=self.stem, do_fold=self.fold)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stop: bool = True, stem: bool = True, fold: bool = True,
                materialize: bool = True) -> Index:
    """I1-I8 for one text column (Q7).

    With ``materialize`` (the default) the term-frequency table and the
    (small) IDF table are written once to the shared folder and read back:
    the corpus is analysed once however many consumers follow.
    """
    docs = docs.select(id_col, text_col)
    return _index(docs, docs, [], id_col, text_col, n_docs(docs), stop, stem, fold, materialize)


def build_fields_index(listing: DataFrame, id_col: str, fields: list[str],
                       stop: bool = True, stem: bool = True, fold: bool = True) -> Index:
    """I1-I8 for several columns of one table, in one pass: a row's fields
    become rows (field, id, text), and every index table is keyed by field.
    N is the number of rows of the table, the same for all fields."""
    rows = listing.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields])).alias("_f")).select("_f.field", id_col, "_f.text")
    return _index(listing, rows, ["field"], id_col, "text", n_docs(listing), stop, stem, fold, True)


def _index(docs, rows, by, id_col, text_col, n, stop, stem, fold, materialize) -> Index:
    tokens = tx.analyze_tokens(rows, [*by, id_col], text_col, stop=stop, stem=stem, do_fold=fold, materialize=materialize)
    tf = tokens.withColumnRenamed("n", "tf")
    idf = inverse_doc_freq(doc_freq(tf, [*by, "term"]), n, [*by, "term"])
    if materialize:
        from tessera.sources.files import materialize as _mat
        idf = _mat(idf, "idf")
    return Index(docs=docs, tf=tf, idf=idf, n=n, stop=stop, stem=stem, fold=fold, id_col=id_col, by=tuple(by))


def doc_norms(postings: DataFrame, id_col: str | list[str] = "doc_id") -> DataFrame:
    """I8: L2 norm of each document's TF-IDF vector."""
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    return postings.groupBy(*keys).agg(l2_norm().alias("norm"))


def doc_vectors(postings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sparse document vectors, zero weights removed (long form)."""
    return postings.where(F.col("w") != 0).select(id_col, "term", "w")


# Documents of a block: small, so that a block's largest weight of a term says
# much; the bounds are then about three quarters as many rows as the postings.
BLOCK_DOCS = 8


def document_blocks(tops: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, block, slot) of (id, top), a document's largest ``wn``: documents of
    similar largest weights together, in blocks of BLOCK_DOCS, ``slot`` their
    place in it; numbered without a global window."""
    ordered = tops.withColumn("_o", F.struct("top", id_col))
    return dense_ids(ordered, "_o", "_r").select(id_col, F.expr(f"_r div {BLOCK_DOCS}").alias("block"),
                                                 F.expr(f"_r % {BLOCK_DOCS}").cast("byte").alias("slot"))


def with_norms(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Saved rows with their document's ``norm``, by its place in the block."""
    return rows.join(blocks, "block").withColumn("norm", F.col("docs")[F.col("slot")]["norm"]).drop("docs")


SLICES = 8  # in which postings are placed at most, one after the other
SLICE_ROWS = 2_000_000  # fewer aren't cut
SLICE_RANGES = 64  # ranges of terms that slices are made of


def term_slices(idf: DataFrame) -> list[Column]:
    """Conditions on ``term`` that cut the index into at most SLICES ranges of
    about as many postings.  Their shuffle files are on disk one slice at a
    time, so placing needs a bounded part of the index, however large that is."""
    n = min(SLICES, -(-(idf.agg(F.sum("df")).first()[0] or 0) // SLICE_ROWS))
    if n <= 1:
        return [F.lit(True)]
    ranges = (idf.select("term", "df").repartitionByRange(SLICE_RANGES, "term").groupBy(F.spark_partition_id())
              .agg(F.min("term").alias("least"), F.sum("df").alias("df")).orderBy("least").collect())
    total, before, cuts = sum(r["df"] for r in ranges), 0, []
    for r in ranges:
        if before * n >= total * (len(cuts) + 1):
            cuts.append(r["least"])
        before += r["df"]
    lows, highs = [None, *cuts], [*cuts, None]
    term = F.col("term")
    return [(F.lit(True) if a is None else term >= a) & (F.lit(True) if b is None else term < b) for a, b in zip(lows, highs)]


def save_index(index: Index, path: str) -> None:
    """Everything that a search needs, as Parquet under ``path``:
    postings (term, block, slot, id, tf, w) ranged by (term, block) and sorted, so
    a term is found by row-group statistics and a frequent one spans many files;
    with them the bounds, the largest weights by (term, block of documents): the
    first row of each block is that of its largest ``wn`` and holds the largest
    ``w`` and the number of rows; blocks (block, the id and norm of each
    document), by which ``wn`` is w / norm, so that it isn't written; idf,
    vocabulary (dense ids), norms, and one row of N and the options.  Norms and
    blocks are found document by document, so postings are shuffled twice, to
    their document's norm and block, and to their place, a slice of the terms
    at a time."""
    from tessera.session import freed_shuffles
    from tessera.sources.files import COMPRESSION, materialize
    i, spark = index.id_col, index.tf.sparkSession

    def write(df: DataFrame, table: str, mode: str = "overwrite") -> None:
        df.write.mode(mode).option("compression", COMPRESSION).parquet(f"{path}/{table}")

    docs = index.document_weights.where(F.col(i).isNotNull())
    tops = docs.select(i, F.try_divide(F.col("top"), F.col("norm")).alias("top"))
    of_doc = materialize(document_blocks(tops, i).join(docs.select(i, "norm"), i), "blocks")
    order = ["term", "block", F.desc("_wn"), i]
    in_block = Window.partitionBy(*order[:2]).orderBy(*order[2:])
    all_rows = in_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one order, so one pass for all
    bounds = {"n": F.count(F.lit(1)), "top_w": F.max("w")}
    with freed_shuffles(spark):
        for k, held in enumerate(term_slices(index.idf)):
            part = replace(index, tf=index.tf.where(held), idf=index.idf.where(held), saved=None if index.saved is None else index.saved.where(held))
            rows = part.weights.join(of_doc, i).select("term", "block", "slot", i, "tf", "w", "norm")
            placed = (rows.repartitionByRange("term", "block").withColumn("_wn", normed())
                      .select("*", F.row_number().over(in_block).alias("_nth"), *[value.over(all_rows).alias(name) for name, value in bounds.items()]))
            write(placed.withColumns({name: F.when(F.col("_nth") == 1, F.col(name)) for name in bounds})
                  .sortWithinPartitions(*order).drop("_wn", "_nth", "norm"), "postings", "append" if k else "overwrite")
        in_slots = F.array_sort(F.collect_list(F.struct("slot", F.col(i).alias("id"), "norm")))
        write(of_doc.groupBy("block").agg(F.transform(in_slots, lambda d: F.struct(d["id"], d["norm"])).alias("docs")), "blocks")
        write(index.idf.repartitionByRange("term").sortWithinPartitions("term"), "idf")
        write(dense_ids(index.doc_freq.select("term"), "term", "term_id"), "vocabulary")
        write(index.document_weights, "norms")
        write(spark.range(1).select(index.n.cast("double").alias("n"), *[F.lit(getattr(index, o)).alias(o) for o in ("stop", "stem", "fold", "id_col")]), "options")


def load_index(spark, path: str) -> Index:
    """A saved index; nothing of the corpus is read or analysed again."""
    options = spark.read.parquet(f"{path}/options").first()
    rows, blocks, idf, norms = (spark.read.parquet(f"{path}/{t}") for t in ("postings", "blocks", "idf", "norms"))
    return Index(tf=rows.select(options["id_col"], "term", "tf"), idf=idf, n=F.lit(options["n"]), stop=options["stop"], stem=options["stem"],
                 fold=options["fold"], id_col=options["id_col"], saved=rows, blocks=blocks, saved_norms=norms)


def save_vocabulary(spark, path: str, target: str) -> None:
    """The saved vocabulary as CSV (term, term_id) with a header."""
    spark.read.parquet(f"{path}/vocabulary").write.mode("overwrite").option("header", True).option("escape", '"').csv(target)
