"""Search operators over an :class:`~tessera.operators.index.Index` (Q1-Q7).

Queries come as a table ``(qid, text)`` so one plan answers one query or
thousands.  The query side is analysed with the index's own options.

Plan shape of ranked search: query terms, written with their idf, join the
term frequencies on ``term`` (Spark broadcasts them below its byte threshold,
else AQE splits frequent terms); candidates aggregate on (qid, doc_id), partly
where their document lies, and meet the document norms; the per-query top-k is
``row_number() <= k`` which Spark plans as a partial ``WindowGroupLimit`` before
the shuffle, so no task ever sorts all candidates of one query.
"""

from __future__ import annotations

import math
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.index import FREQUENT, Index, normed, with_norms

# Scores are compared to this many digits: sums of the same products in another
# order differ in the 16th, and such scores are ties (broken by id).
TIE_DIGITS = 12


def query_table(spark, texts: list[str] | str, qid: str = "qid", col: str = "text") -> DataFrame:
    """Literal query text(s) as a ``(qid, text)`` table."""
    if isinstance(texts, str):
        texts = [texts]
    return spark.createDataFrame(list(enumerate(texts)), f"{qid} long, {col} string")


def narrowed(index: Index, terms: list[str]) -> Index:
    """The index restricted to some terms: an ``IN`` filter that reaches the
    scan of its tables.  A search for these terms is the same as over the whole
    index; norms are the whole documents'."""
    only = F.col("term").isin(terms) if terms else F.lit(False)
    return replace(index, tf=index.tf.where(only), idf=index.idf.where(only), whole=index.whole or index,
                   saved=None if index.saved is None else index.saved.where(only))


def literal(index: Index, texts: list[str] | str) -> tuple[Index, DataFrame]:
    """Literal query texts analysed (the caller's own words: a local table
    ``(qid, term, n)``), and the index narrowed to their terms."""
    spark = index.tf.sparkSession
    rows = index.analyze(query_table(spark, texts), "qid", "text").collect()
    return narrowed(index, sorted({r["term"] for r in rows})), spark.createDataFrame(rows, "qid long, term string, n long")


def query_keys(index: Index, qid: str) -> list[str]:
    """A query's key: its id and the index's own key columns."""
    return list(dict.fromkeys([qid, *index.by]))


def analyzed_queries(index: Index, queries: DataFrame, qid: str = "qid",
                     text_col: str = "text") -> DataFrame:
    """The query table analysed once, like the index: (qid, term, n).

    Written to the shared folder and read back, so the query vector and
    candidate generation reuse one analysis.
    """
    if "term" in queries.columns and "n" in queries.columns:
        return queries
    from tessera.sources.files import materialize
    return materialize(index.analyze(queries, query_keys(index, qid), text_col), "query-terms")


def query_terms_all(index: Index, queries: DataFrame, qid: str = "qid",
                    text_col: str = "text") -> DataFrame:
    """Distinct analysed query terms, in vocabulary or not: (qid, term)."""
    return analyzed_queries(index, queries, qid, text_col).select(*query_keys(index, qid), "term")


def weighted_queries(index: Index, queries: DataFrame, qid: str = "qid", text_col: str = "text") -> DataFrame:
    """:func:`query_vector` with the terms' ``idf``, written to the shared
    folder: Spark then knows its size before it plans the join with the index
    (it would take a join and a window for as large as their inputs, and shuffle
    the postings)."""
    from tessera.sources.files import materialize
    toks, keys, term = analyzed_queries(index, queries, qid, text_col), query_keys(index, qid), [*index.by, "term"]
    qtf = toks.select(*keys, "term", F.col("n").alias("qtf"))
    qv = (qtf.join(index.idf.select(*term, "idf"), term)
          .withColumn("qw", F.col("qtf") * F.col("idf")))
    per_q = Window.partitionBy(*keys)  # a query's own terms
    return materialize(qv.withColumn("qnorm", F.sqrt(F.sum(F.col("qw") * F.col("qw")).over(per_q)))
                       .withColumn("qwn", F.try_divide(F.col("qw"), F.col("qnorm")))
                       .select(*keys, "term", "idf", "qtf", "qw", "qnorm", "qwn"), "query-vectors")


def query_vector(index: Index, queries: DataFrame, qid: str = "qid",
                 text_col: str = "text") -> DataFrame:
    """Q4 + I9: in-vocabulary query terms with raw-TF x IDF weights.

    ``queries`` is the raw ``(qid, text)`` table or its analysed form.
    Output (qid, term, qtf, qw, qnorm, qwn); qwn = qw / |q| (NULL if |q| = 0).
    """
    return weighted_queries(index, queries, qid, text_col).drop("idf")


def products(index: Index, qv: DataFrame, value: str, qid: str) -> DataFrame:
    """(qid, id, sum): sums of ``value`` x w over the terms that a query and a
    row share.  w is tf times the idf that the queries' terms carry, so only
    these terms' rows are joined, with one small table, and lie document by
    document when they are summed."""
    keys, term = query_keys(index, qid), [*index.by, "term"]
    return (index.tf.join(qv.select(*keys, "term", "idf", F.col(value).alias("_q")), term)
            .groupBy(*keys, index.id_col)
            .agg(F.sum(F.col("_q") * (F.col("tf") * F.col("idf"))).alias("sum")))


def any_term_search(index: Index, queries: DataFrame, qid: str = "qid",
                    text_col: str = "text") -> DataFrame:
    """Documents holding any query term: (qid, doc_id)."""
    qt = query_terms_all(index, queries, qid, text_col)
    return (index.tf.select("term", index.id_col).join(qt, "term")
            .select(qid, index.id_col).distinct())


def rarest_first(index: Index, queries: DataFrame, qid: str = "qid", text_col: str = "text") -> DataFrame:
    """A query's distinct terms in order of their document frequency (``nth``,
    1 the rarest) with their number: (qid, term, nth, n_terms).  A query with a
    term out of the vocabulary, which nothing can match, has none."""
    terms = query_terms_all(index, queries, qid, text_col).join(index.doc_freq, "term", "left")
    of_q = Window.partitionBy(qid)  # a query's own terms
    return (terms.withColumn("n_terms", F.count(F.lit(1)).over(of_q)).withColumn("known", F.count("df").over(of_q))
            .withColumn("nth", F.row_number().over(of_q.orderBy("df", "term")))
            .where(F.col("known") == F.col("n_terms")).select(qid, "term", "nth", "n_terms"))


def conjunctive_search(index: Index, queries: DataFrame, qid: str = "qid",
                       text_col: str = "text") -> DataFrame:
    """Documents holding every analysed query term: (qid, doc_id).

    Rarest first: the candidates are the posting list of a query's rarest
    term; its other terms only say which candidates they hold, by a join on
    (term, document), a key without hot values.  Spark broadcasts whichever
    side is small, so frequent posting lists are read, never multiplied by
    the queries that hold their term, and no posting of a term that no query
    holds is shuffled.  An out-of-vocabulary term can never be
    matched, so its query returns no rows; neither does one with no terms.
    """
    from tessera.sources.files import materialize
    i = index.id_col
    order = materialize(rarest_first(index, queries, qid, text_col), "query-order")  # its size is known to the joins
    tf = index.tf.select("term", i).join(order.select("term").distinct(), "term", "left_semi")
    candidates = tf.join(order.where("nth = 1").select(qid, "term", "n_terms"), "term").select(qid, i, "n_terms")
    wanted = candidates.join(order.where("nth > 1").select(qid, "term"), qid)
    held = wanted.join(tf, ["term", i]).groupBy(qid, i, "n_terms").agg(F.count(F.lit(1)).alias("n_held"))
    return (candidates.where("n_terms = 1").select(qid, i)
            .unionByName(held.where(F.col("n_held") == F.col("n_terms") - 1).select(qid, i)))


SEEDS = 8  # blocks of a query that are scored to begin with
SLACK = 1e-9  # bounds and scores are sums in different orders


def query_postings(index: Index, qv: DataFrame, value: str) -> DataFrame:
    """(block, id, term, v, top) of a saved index, of the terms that a query
    holds, a block's rows together; ``top`` is the term's largest v in the
    block, on one of its rows.  The others' postings aren't shuffled."""
    terms = qv.select("term").distinct()
    held = index.saved.join(F.broadcast(terms), "term", "left_semi").repartition("block")
    v, top = (F.col("w"), F.col("top_w")) if value == "w" else (normed(), normed())
    return with_norms(held, index.blocks).select("block", index.id_col, "term", v.alias("v"), F.when(F.col("n").isNotNull(), top).alias("top"))


def block_queries(chosen: DataFrame, qid: str) -> DataFrame:
    """(block, queries) of (qid, block, least): a block's queries with their threshold, as a map."""
    return (chosen.where(F.col(qid).isNotNull()).groupBy("block")
            .agg(F.map_from_entries(F.collect_list(F.struct(qid, "least"))).alias("queries")))


def products_by_block(postings: DataFrame, qv: DataFrame, of_block: DataFrame, qid: str) -> DataFrame:
    """``postings`` with the queries (qid, q) that hold their term and are among
    their block's (:func:`block_queries`), with ``least``: only postings are
    shuffled, never their products."""
    return (postings.join(of_block, "block").join(F.broadcast(qv), "term")
            .withColumn("least", F.col("queries")[F.col(qid)]).where(F.col("least").isNotNull()).drop("queries"))


def candidates(index: Index, qv: DataFrame, value: str, k: int, qid: str, write: bool = False) -> tuple[DataFrame, DataFrame]:
    """The (qid, block, id) that can be among a query's k best with their whole
    score ``sum``, and the bounds of every query's blocks, (qid, block, reach).

    ``qv`` (qid, term, q), weights not negative, at most FREQUENT rows (it is
    broadcast).  reach = sum of q x the largest ``value`` of the term in the
    block.  The SEEDS blocks of a query of the largest reach are scored; the
    k-th best score there is at most the k-th best of all, the threshold (0
    where there are fewer than k).  A block whose reach is below it is out.  The
    documents of the others are scored where their block lies; those below the
    threshold are out.  ``write``: the queries' postings are written once for
    these steps, otherwise each reads them from the index.
    """
    from tessera.sources.files import materialize
    i, postings = index.id_col, query_postings(index, qv, value)
    if write:
        postings = materialize(postings, "query-postings")
    product = F.sum(F.col("q") * F.col("v"))
    blocks = materialize(postings.where("top IS NOT NULL").join(F.broadcast(qv), "term")
                         .groupBy(qid, "block").agg(F.sum(F.col("q") * F.col("top")).alias("reach")), "block-bounds")
    best_first = Window.partitionBy(qid).orderBy(F.desc("reach"), "block")
    seeds = blocks.withColumn("_r", F.row_number().over(best_first)).where(F.col("_r") <= SEEDS).select(qid, "block", F.lit(0.0).alias("least"))
    seeded = products_by_block(postings, qv, F.broadcast(block_queries(seeds, qid)), qid).groupBy(qid, i).agg(product.alias("s"))
    by_score_ = Window.partitionBy(qid).orderBy(F.desc("s"))
    kth = seeded.withColumn("_r", F.row_number().over(by_score_)).where(F.col("_r") == k).select(qid, F.col("s").alias("least"))
    least = F.coalesce("least", F.lit(0.0)) - SLACK
    alive = blocks.join(F.broadcast(kth), qid, "left").where(F.col("reach") >= least).select(qid, "block", least.alias("least"))
    found = (products_by_block(postings, qv, block_queries(alive, qid), qid).groupBy(qid, "block", i).agg(product.alias("sum"), F.first("least").alias("least"))
             .where(F.col("sum") >= F.col("least")).select(qid, "block", i, "sum"))
    return found, blocks


BATCH_SHARE = 0.5  # of the index: the postings that the queries of a batch meet
FEW = 1_000_000  # postings that aren't written for a search


def bounded_scores(index: Index, qv: DataFrame, value: str, k: int, qid: str) -> DataFrame:
    """(qid, id, sum of q x ``value``) of at least each query's k best, whole
    scores: the same as over all postings.  Joins are on a block, a key of at
    most BLOCK_DOCS documents.  Searches that meet many postings are done and
    written in batches of queries, each of FREQUENT terms and BATCH_SHARE of
    the index on average: what is on disk for a batch is a bounded part of the
    index, however many queries there are."""
    from tessera.session import scratch_scope
    from tessera.sources.files import materialize, scratch_path
    spark, size = index.idf.sparkSession, F.coalesce(F.sum("df"), F.lit(0))
    whole = (index.whole or index).idf.select(size).scalar()
    n, met, total = qv.join(index.idf.select("term", "df"), "term").agg(F.count(F.lit(1)), size).select("*", whole).first()
    if met < FEW and n <= FREQUENT:
        return candidates(index, qv, value, k, qid)[0].select(qid, index.id_col, "sum")
    batches, found = max(-(-n // FREQUENT), math.ceil(met / (BATCH_SHARE * total))), []
    for b in range(batches):
        path = scratch_path(spark, "found")
        with scratch_scope(spark):  # a batch's tables go with it
            rows = candidates(index, qv.where(F.pmod(F.hash(qid), F.lit(batches)) == b), value, k, qid, write=True)[0]
            found.append(materialize(rows.select(qid, index.id_col, "sum"), "found", path))
    return reduce(DataFrame.unionByName, found)


def sparse_dot(index: Index, queries: DataFrame, qid: str = "qid",
               text_col: str = "text", k: int | None = None) -> DataFrame:
    """Un-normalised dot product of query and document vectors, of all
    pairs that share a term or, with ``k``, of each query's k best (with
    ``rank``; by the bounds of a saved index where there are any)."""
    toks = analyzed_queries(index, queries, qid, text_col)
    if k is not None:
        if index.bounds is None:
            return top_k(sparse_dot(index, toks, qid), k, qid, index.id_col, "dot")
        qv = query_vector(index, toks, qid, text_col).select(qid, "term", F.col("qw").alias("q"))
        return top_k(bounded_scores(index, qv, "w", k, qid).withColumnRenamed("sum", "dot"), k, qid, index.id_col, "dot")
    return (products(index, weighted_queries(index, toks, qid, text_col), "qw", qid)
            .where(F.col(index.id_col).isNotNull()).withColumnRenamed("sum", "dot"))


def cosine_scores(index: Index, queries: DataFrame, qid: str = "qid",
                  text_col: str = "text") -> DataFrame:
    """Q7: cosine(query, doc) for every candidate (doc sharing a term).

    Candidates whose cosine is undefined (zero document or query norm) are
    dropped instead of carrying NaN.  Scores are not rounded.
    """
    keys = query_keys(index, qid)
    sums = products(index, weighted_queries(index, queries, qid, text_col), "qwn", qid)
    return (sums.join(index.norms, [*index.by, index.id_col])
            .select(*keys, index.id_col, F.try_divide(F.col("sum"), F.col("norm")).alias("score"))
            .where(F.col("score").isNotNull()))


def by_score(score_col: str = "score"):
    """Sort key: highest score first, equal to TIE_DIGITS digits."""
    return F.desc(F.round(score_col, TIE_DIGITS))


def ranked(scores: DataFrame, id_col: str, score_col: str = "score") -> DataFrame:
    """All rows, best first, with their ``rank`` (1-based) in that order;
    the numbering is distributed (no global window)."""
    from tessera.operators.index import dense_ids
    keyed = scores.withColumn("_ord", F.struct((-F.round(score_col, TIE_DIGITS)).alias("s"), F.col(id_col).alias("i")))
    return (dense_ids(keyed, "_ord", "rank").withColumn("rank", F.col("rank") + 1)
            .drop("_ord").orderBy("rank"))


def top_k(scores: DataFrame, k: int, qid: str = "qid", id_col: str = "doc_id",
          score_col: str = "score") -> DataFrame:
    """Per-query top-k, ties by ascending id; adds ``rank`` (1-based)."""
    w = Window.partitionBy(qid).orderBy(by_score(score_col), F.asc(id_col))
    return (scores.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("long")))


def ranked_search(index: Index, queries: DataFrame, k: int = 10, qid: str = "qid",
                  text_col: str = "text") -> DataFrame:
    """Cosine top-k per query: (qid, doc_id, score, rank).  With the
    bounds of a saved index only what can be among the k is scored."""
    if index.bounds is not None:
        qv = query_vector(index, queries, qid, text_col).select(qid, "term", F.col("qwn").alias("q"))
        scores = bounded_scores(index, qv.where(F.col("q").isNotNull()), "wn", k, qid)
        return top_k(scores.withColumnRenamed("sum", "score"), k, qid, index.id_col)
    return top_k(cosine_scores(index, queries, qid, text_col), k, qid, index.id_col)
