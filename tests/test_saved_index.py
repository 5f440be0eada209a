"""A saved index needs a bounded part of its size on disk besides itself."""

import os
import random

from pyspark.sql import functions as F

from tessera import session
from tessera.operators import index as ix
from tessera.operators import search as srch
from tessera.sources import files


def _docs(spark, n=300, ids=250):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choices(words, range(60, 0, -1), k=rnd.randint(0, 20))) for _ in range(n)]
    return spark.createDataFrame([(i % ids if i % 11 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")


def _key(df, *cols):
    return sorted(tuple(str(round(r[c], 9) if isinstance(r[c], float) else r[c]) for c in cols) for r in df.collect())


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {x for x in names if x.startswith("shuffle_")}


def test_shuffle_files_go_with_each_step(spark, tmp_path):
    before, setting = _shuffle_files(spark), spark.conf.get(session.SHUFFLE_CLEANUP)
    ix.save_index(ix.build_index(_docs(spark)), f"{tmp_path}/ix")
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == setting


def test_slices_make_the_same_index(spark, tmp_path, monkeypatch):
    built = ix.build_index(_docs(spark))
    ix.save_index(built, f"{tmp_path}/whole")
    monkeypatch.setattr(ix, "SLICE_ROWS", 100)
    conditions = ix.term_slices(built.idf)
    held = [{r.term for r in built.idf.where(c).collect()} for c in conditions]
    assert len(held) == ix.SLICES and all(held) and sum(map(len, held)) == len(set().union(*held)) == built.idf.count()
    ix.save_index(built, f"{tmp_path}/sliced")
    whole, sliced = (ix.load_index(spark, f"{tmp_path}/{x}") for x in ("whole", "sliced"))
    cols = ["term", "doc_id", "tf", "w", "wn", "block"]
    assert _key(whole.postings, *cols) == _key(sliced.postings, *cols) and whole.postings.count() > 1000
    assert _key(built.postings, "term", "doc_id", "tf", "w", "wn") == _key(sliced.postings, "term", "doc_id", "tf", "w", "wn")
    assert _key(whole.bounds, "term", "block", "n", "w", "wn") == _key(sliced.bounds, "term", "block", "n", "w", "wn")
    assert ix.term_slices(built.idf.where("false"))[0] is not None


def test_saved_postings_hold_no_weight_by_norm(spark, tmp_path):
    """The two columns of doubles that don't compress come from the blocks' norms."""
    ix.save_index(ix.build_index(_docs(spark)), f"{tmp_path}/ix")
    saved = spark.read.parquet(f"{tmp_path}/ix/postings")
    assert not {"wn", "top_wn", "norm"} & set(saved.columns)
    assert saved.where("slot < 0 OR slot >= 8").count() == 0
    again = ix.load_index(spark, f"{tmp_path}/ix")
    ix.save_index(again, f"{tmp_path}/again")
    cols = ["term", "doc_id", "tf", "w", "wn", "block"]
    assert _key(again.postings, *cols) == _key(ix.load_index(spark, f"{tmp_path}/again").postings, *cols)


def test_batches_of_queries_are_the_whole_search(spark, tmp_path, monkeypatch):
    built = ix.build_index(_docs(spark, ids=300))
    ix.save_index(built, f"{tmp_path}/ix")
    loaded = ix.load_index(spark, f"{tmp_path}/ix")
    queries = srch.query_table(spark, [f"w{i} w{i * 2 % 60} w{i * 7 % 60} absent" for i in range(25)])
    queries = queries.unionByName(queries.where("qid < 3"))  # some come twice
    monkeypatch.setattr(srch, "FEW", 0)
    monkeypatch.setattr(srch, "BATCH_SHARE", 0.2)
    made, scratch_path = [], files.scratch_path
    monkeypatch.setattr(files, "scratch_path", lambda *a: made.append(scratch_path(*a)) or made[-1])
    got = srch.ranked_search(loaded, queries, k=7)
    cols = ("qid", "doc_id", "rank", "score")
    assert _key(got, *cols) == _key(srch.ranked_search(built, queries, k=7), *cols)
    left = [x.rsplit("/", 1)[1].rsplit("-", 1)[0] for x in made if os.path.exists(x.removeprefix("file:"))]
    assert left.count("found") > 2 and not {"query-postings", "block-bounds"} & set(left)
    assert any("query-postings" in x for x in made)
    assert _key(srch.sparse_dot(loaded, queries, k=3), "qid", "doc_id", "dot") == _key(srch.sparse_dot(built, queries, k=3), "qid", "doc_id", "dot")


def test_pairs_below_the_threshold_are_out(spark, tmp_path):
    ix.save_index(ix.build_index(_docs(spark, ids=300)), f"{tmp_path}/ix")
    loaded = ix.load_index(spark, f"{tmp_path}/ix")
    qv = srch.query_vector(loaded, srch.query_table(spark, ["w3 w50", "w59"])).select("qid", "term", F.col("qwn").alias("q"))
    found, reach = srch.candidates(loaded, qv, "wn", 5, "qid")
    whole = _key(srch.cosine_scores(loaded, srch.query_table(spark, ["w3 w50", "w59"])), "qid", "doc_id", "score")
    some = _key(found, "qid", "doc_id", "sum")
    assert set(some) <= set(whole) and 7 <= len(some) < len(whole)
    assert reach.groupBy("qid", "block").count().where("count > 1").count() == 0
