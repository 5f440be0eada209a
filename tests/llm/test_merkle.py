"""The manifest against trees built in plain Python."""

import hashlib
import zlib

from pyspark.sql import functions as F

from tessera.llm import catalog, merkle
from tessera.llm._common import read_table
from tests.llm.conftest import DOCS

SF = "/root/testdata/sf0.001"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(digests):
    """(root, [way of each leaf as (left, right) lists])"""
    ways, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(at):
            first = p // 3 * 3
            ways[i].append((digests[first:p], digests[p + 1:first + 3]))
            at[i] = p // 3
        digests = [H(*digests[i:i + 3]) for i in range(0, len(digests), 3)]
    return digests[0], ways


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = tree([leaf(*r) for r in groups[s]])
    root, tops = tree([trees[s][0] for s in order]) if order else (None, [])
    for s, top in zip(order, tops):
        for r, way in zip(groups[s], trees[s][1]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            node = leaf(r[0], r[1].replace("\n", ""), *r[2:]) if hit else leaf(*r)
            for left, right in way + top:
                node = H(*left, node, *right)
            proof = H(*(x for left, right in way + top for x in left + right))
            out.append((r[0], leaf(*r), trees[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


def check(df):
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = merkle.verified_documents(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_table(spark):
    got = catalog.op13_slot_pivot(spark, SF)
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert {w[6] for w in want} == {True, False}


def test_odd_rows(spark, odd_docs, no_docs):
    check(odd_docs.withColumn("g", F.lit(1)).withColumn("tampered", F.lit("x")).withColumn("way", F.lit(2)))
    assert merkle.verified_documents(no_docs).count() == 0


def test_groups_of_all_sizes(spark):
    rows = [(i * 10 + n, f"line {i}\nof {n}" if i % 3 else None, "en", None if n == 7 else f"s{n}é" if n % 2 else f"S{n}", i)
            for n in (1, 2, 3, 4, 7, 9, 10, 27, 28, 82) for i in range(n)]
    check(spark.createDataFrame(rows, DOCS).repartition(6))
    check(spark.createDataFrame([(3, "a\nb", "x", "only", 3)], DOCS))
    check(spark.createDataFrame([(i, "a\nb", "x", f"s{i}", 3) for i in range(11)], DOCS))


def test_any_change_is_seen(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 4}", i) for i in range(40)]
    df = spark.createDataFrame(rows, DOCS)
    leaf_of = merkle.leaf_digest(F.col("doc_id"), F.col("text"))
    changed = merkle.leaf_digest(F.col("doc_id"), F.concat("text", F.lit(".")))
    got = merkle.manifest(df, leaf_of, group=F.col("source"), order=F.col("doc_id"), tampered=F.when(F.col("doc_id") == 17, changed))
    bad = got.where(merkle.folded(F.coalesce("tampered", "leaf"), F.col("way")) != F.col("root"))
    assert [r["id"] for r in bad.collect()] == [17]
