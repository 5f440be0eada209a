import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import index as ix
from tessera.operators import search as srch


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_idf_and_norms(corpus):
    idx = ix.build_index(corpus)
    idf = {r.term: round(r.idf, 6) for r in idx.idf.collect()}
    assert idf == {"modern": 0.30103, "season": 0.30103, "cuisin": 0.30103, "bar": 0.60206, "garden": 0.60206}
    norms = {r.doc_id: round(r.norm, 6) for r in ix.doc_norms(idx.postings).collect()}
    assert norms == {0: 0.521399, 1: 0.90309, 2: 0.673124}


def test_search_modes(spark, corpus):
    idx = ix.build_index(corpus)
    q = srch.query_table(spark, "modern seasonal")
    assert _rows(srch.any_term_search(idx, q), "doc_id") == [(0,), (1,), (2,)]
    assert _rows(srch.conjunctive_search(idx, q), "doc_id") == [(0,)]
    ranked = srch.ranked_search(idx, q, k=5).orderBy("rank").collect()
    assert [(r.doc_id, round(r.score, 6)) for r in ranked] == [(0, 0.816497), (1, 0.471405), (2, 0.316228)]


def test_oov_and_stop_only_queries(spark, corpus):
    idx = ix.build_index(corpus)
    q = srch.query_table(spark, ["modern zzz", "the of"])
    assert srch.conjunctive_search(idx, q).count() == 0
    ranked = srch.ranked_search(idx, q, k=5)
    assert _rows(ranked.where("qid = 1"), "doc_id") == []
    assert _rows(ranked.where("qid = 0"), "doc_id") == [(0,), (1,)]


def _py_cosine(docs, query):
    """Plain-Python mirror of the ranked search (raw tf x log10(N/df))."""
    n = len(docs)
    df = {}
    for toks in docs.values():
        for t in set(toks):
            df[t] = df.get(t, 0) + 1
    idf = {t: math.log10(n / c) for t, c in df.items()}
    vec = {d: {t: toks.count(t) * idf[t] for t in set(toks)} for d, toks in docs.items()}
    q = {t: query.count(t) * idf[t] for t in set(query) if t in idf}
    qn = math.sqrt(sum(v * v for v in q.values()))
    out = {}
    for d, v in vec.items():
        if not set(v) & set(q):
            continue
        dn = math.sqrt(sum(x * x for x in v.values()))
        if dn == 0 or qn == 0:
            continue
        out[d] = round(sum(v.get(t, 0) * w for t, w in q.items()) / (dn * qn), 6)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_python_mirror(spark, seed):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]
    docs = {i: [rnd.choice(words) for _ in range(rnd.randint(0, 8))] for i in range(40)}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    idx = ix.build_index(df, stem=False)
    query = [rnd.choice(words) for _ in range(3)]
    want = _py_cosine(docs, query)
    got = {r.doc_id: round(r.score, 6) for r in srch.cosine_scores(idx, srch.query_table(spark, " ".join(query))).collect()}
    assert got == want
    # conjunctive results are a subset of any-term results
    q = srch.query_table(spark, " ".join(query))
    conj = set(_rows(srch.conjunctive_search(idx, q), "doc_id"))
    anyt = set(_rows(srch.any_term_search(idx, q), "doc_id"))
    assert conj <= anyt
    # top-k is a prefix of the full ranking
    full = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))
    top = srch.ranked_search(idx, q, k=5).orderBy("rank").collect()
    assert [(r.doc_id, round(r.score, 6)) for r in top] == full[:5]


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.createDataFrame([(f"t{i:04d}",) for i in range(500)], "term string").repartition(7)
    ids = ix.dense_ids(df, "term", "term_id").orderBy("term").collect()
    assert [r.term_id for r in ids] == list(range(500))


def _loaded(spark, docs, tmp_path, **kw):
    built = ix.build_index(docs, **kw)
    ix.save_index(built, f"{tmp_path}/ix")
    return built, ix.load_index(spark, f"{tmp_path}/ix")


def test_top_k_by_bounds_is_the_whole_ranking(spark, tmp_path):
    """The k best by score bounds against all pairs: same documents, ranks and scores."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    queries = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select(F.col("item_id").alias("qid"), "text")
    queries = queries.unionByName(spark.createDataFrame([(-1, "the of"), (-2, ""), (-3, "zzzz ertion"), (-4, "ertion thnd onan")], "qid long, text string"))
    built, loaded = _loaded(spark, docs, tmp_path)
    key = lambda df, c: sorted((r["qid"], r["rank"], r["doc_id"], round(r[c], 9)) for r in df.collect())
    for k in (1, 10, 1000):
        assert key(srch.ranked_search(loaded, queries, k=k), "score") == key(srch.ranked_search(built, queries, k=k), "score")
    assert key(srch.sparse_dot(loaded, queries, k=5), "dot") == key(srch.sparse_dot(built, queries, k=5), "dot")


def test_bounds_leave_few_pairs(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    queries = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select(F.col("item_id").alias("qid"), "text")
    _, loaded = _loaded(spark, docs, tmp_path)
    qv = srch.query_vector(loaded, queries).select("qid", "term", F.col("qwn").alias("q"))
    found, _ = srch.candidates(loaded, qv, "wn", 10, "qid")
    assert 400 <= found.count() < 0.25 * srch.cosine_scores(loaded, queries).count()


def test_rarest_first(spark):
    """Candidates are the rarest term's documents; the frequent term's are only looked up."""
    docs = spark.createDataFrame([(i, "common " + ("rare " if i % 100 == 7 else "") + f"w{i % 5}") for i in range(400)], "doc_id long, text string")
    idx = ix.build_index(docs)
    q = srch.query_table(spark, ["common rare", "common", "rare w2 common", "common missing", "", "w1 w2"])
    order = [tuple(r) for r in srch.rarest_first(idx, q).orderBy("qid", "nth").collect()]
    assert order == [(0, "rare", 1, 2), (0, "common", 2, 2), (1, "common", 1, 1), (2, "rare", 1, 3), (2, "w2", 2, 3), (2, "common", 3, 3),
                     (5, "w1", 1, 2), (5, "w2", 2, 2)]
    got = srch.conjunctive_search(idx, q)
    hits = {i: {r.doc_id for r in got.where(f"qid = {i}").collect()} for i in range(6)}
    assert hits == {0: {7, 107, 207, 307}, 1: set(range(400)), 2: {7, 107, 207, 307}, 3: set(), 4: set(), 5: set()}
    # the other terms meet postings by (term, document) alone
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert any("term" in line and "doc_id" in line for line in joins)


def test_one_index_of_many_fields(spark):
    listing = spark.createDataFrame([(1, "red fish", "Rome"), (2, "red", None), (3, None, "red Rome"), (4, "", "")], "i long, name string, city string")
    idx = ix.build_fields_index(listing, "i", ["name", "city"])
    for f in ("name", "city"):
        alone = ix.build_index(listing, "i", f)
        assert (sorted((r.term, round(r.idf, 9)) for r in idx.idf.where(F.col("field") == f).collect())
                == sorted((r.term, round(r.idf, 9)) for r in alone.idf.collect()))
        assert (sorted((r.i, r.term, r.tf, round(r.wn, 9)) for r in idx.postings.where(F.col("field") == f).collect())
                == sorted((r.i, r.term, r.tf, round(r.wn, 9)) for r in alone.postings.collect()))


def test_index_plan_has_no_window(spark, corpus):
    idx = ix.build_index(corpus, materialize=False)
    plan = idx.postings._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Python" not in plan


def test_frequent_terms_meet_their_idf_by_broadcast(spark, monkeypatch):
    """Rows of frequent terms and of rare ones, joined apart, are those of one join."""
    monkeypatch.setattr(ix, "FREQUENT", 4)
    docs = spark.createDataFrame([(i if i else None, "common often " * (1 + i % 2) + f"w{i % 7} v{i}") for i in range(60)], "doc_id long, text string")
    idx = ix.build_index(docs)
    least = sum(r.df for r in idx.idf.collect()) / 4
    assert {r.term for r in idx.idf.collect() if r.df >= least} == {"common", "often"}
    want = idx.tf.join(idx.idf, "term").select("doc_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("w"))
    key = lambda df: sorted((str(r.doc_id), r.term, r.tf, round(r.w, 9)) for r in df.collect())
    assert key(idx.weighted) == key(want) and len(key(want)) == 240
    assert key(idx.weights) == key(idx.postings) == [r for r in key(want) if r[0] != "None"]


def test_searches_join_postings_of_their_terms_only(spark, corpus):
    """One small table meets the term frequencies; weights and norms of all postings aren't joined for a score."""
    idx = ix.build_index(corpus)
    scores = srch.cosine_scores(idx, srch.query_table(spark, ["modern seasonal", "bar"]))
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and "Window" not in plan
    plan = idx.weights._jdf.queryExecution().optimizedPlan().toString()
    assert "norm" not in plan


def test_saved_bounds_are_the_largest_weights_of_a_block(spark, tmp_path):
    """Bounds lie in the first posting of each (term, block): no second shuffle and table of the postings."""
    rows = [(i % 50 if i % 9 else None, " ".join(f"w{j}" for j in range(i % 13)) + " x" * (i % 4)) for i in range(60)]
    _, loaded = _loaded(spark, spark.createDataFrame(rows, "doc_id long, text string"), tmp_path)
    want = loaded.postings.groupBy("term", "block").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w"), F.max("wn").alias("wn"))
    key = lambda df: sorted((r.term, r.block, r.n, r.w, r.wn) for r in df.collect())
    assert key(loaded.bounds) == key(want) and len(key(want)) > 20
    assert not (tmp_path / "ix" / "bounds").exists()
