"""Fingerprints against sets of whole shingles in plain Python."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import catalog, sketches as sk
from tessera.llm._common import read_table

SF = "/root/testdata/sf0.001"


def shingles(text, width=sk.WIDTH):
    padded = "\0" * (width - 1) + text
    return {padded[i:i + width] for i in range(len(text))}


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """[(doc_id, n_chars, edited text, next text)] in order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for j, (i, t) in enumerate(rows):
        later = rows[(j + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((i, t, t[:len(t) - half] + later[:half], later))
    return out


def check(rows, result):
    want = sorted(brute(rows), key=str)
    got = sorted(map(tuple, result.collect()), key=str)
    key = lambda r: (str(r[0]), r[1], r[2])
    want = sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, n) for i, t, e, n in want), key=key)
    got = sorted(got, key=key)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    by_text = {}
    for g, w in zip(got, want):
        t, e, n = w[3:]
        assert g[3] == sk.to_string(sk.sketch(t)) == by_text.setdefault(t, g[3]) and g[4] == sk.to_string(sk.sketch(e))
        for estimate, true in ((g[5], likeness(t, e)), (g[6], likeness(t, n))):
            union = len(shingles(t) | shingles(e if true == likeness(t, e) else n))
            assert estimate == pytest.approx(true, abs=1e-9 if union <= sk.K else 0.25)


def test_table(spark):
    docs = read_table(spark, SF, "documents")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], catalog.op12_bottom_k_sketch(spark, SF))


def test_estimates_are_unbiased(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    errors = []
    for (_, t, e, n) in brute(rows):
        errors.append(sk.resemblance(sk.sketch(t), sk.sketch(e)) - likeness(t, e))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_odd_rows(spark, odd_docs, no_docs):
    check([(r["doc_id"], r["text"]) for r in odd_docs.collect()], sk.edited_fingerprints(odd_docs))
    assert sk.edited_fingerprints(no_docs).count() == 0
    one = [(7, "ab😀d")]
    check(one, sk.edited_fingerprints(spark.createDataFrame(one, "doc_id long, text string")))
    nulls = [(None, "x"), (None, None), (None, "x"), (3, ""), (2, None)]
    check(nulls, sk.edited_fingerprints(spark.createDataFrame(nulls, "doc_id long, text string")))


def test_order_over_many_ranges(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([i, i, i, 5, None]) if i % 9 == 0 else i * 10**15 - 2**62, f"text {rnd.randint(0, 40)} " * rnd.randint(0, 30)) for i in range(700)]
    check(rows, sk.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))


def test_parts_of_a_long_text_merge(monkeypatch):
    text = "".join(random.Random(1).choice("abcde fgh") for _ in range(5000))
    whole = sk.sketch(text)
    monkeypatch.setattr(sk, "PART", 700)
    assert (sk.sketch(text) == whole).all()
    assert (sk.from_string(sk.to_string(whole)) == whole).all()
    assert len(sk.sketch("abc" * 10_000)) == len(shingles("abc" * 10_000))  # many repetitions, few shingles


def test_counts_and_containment():
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefghijklmnop ") for _ in range(20_000))
    s, half = sk.sketch(text), sk.sketch(text[:10_000])
    assert abs(sk.distinct_shingles(s) / len(shingles(text)) - 1) < 0.3
    assert sk.distinct_shingles(sk.sketch("twelve chars")) == 12
    assert sk.containment(half, s) == 1.0 and abs(sk.containment(s, half) - 0.5) < 0.15
    assert sk.containment(sk.sketch(""), s) == 1.0 and sk.containment(s, sk.sketch("")) == 0.0


def test_merged_groups(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text", "source")
    prints = sk.fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    got = {r["source"]: r["fingerprint"] for r in sk.merged_sketches(prints, ["source"]).collect()}
    want = {}
    for r in docs.collect():
        want[r["source"]] = sk.merge(want.get(r["source"], np.empty(0, np.uint64)), sk.sketch(r["text"]))
    assert got == {s: sk.to_string(v) for s, v in want.items()}
    odd = spark.createDataFrame([(None, None), ("a", ""), (None, sk.to_string(sk.sketch("some words")))], "g string, fingerprint string")
    assert {(r["g"], r["n_shingles"]) for r in sk.merged_sketches(odd, ["g"]).collect()} == {(None, 10), ("a", 0)}


def test_compared(spark):
    a, b = "one text of some words", "one text of other words"
    df = spark.createDataFrame([(sk.to_string(sk.sketch(a)), sk.to_string(sk.sketch(b))), ("", None)], "x string, y string")
    rows = sorted(map(tuple, sk.compared(df.withColumn("resemblance", df.x), "x", "y").collect()))
    assert rows[0][2:] == (1.0, 1.0, 1.0)
    both = shingles(a) & shingles(b)
    assert rows[1][2:] == (len(both) / len(shingles(a) | shingles(b)), len(both) / len(shingles(a)), len(both) / len(shingles(b)))
