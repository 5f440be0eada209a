"""Decontamination against a plain search for every window."""

import hashlib
import re

import pytest

from tessera.llm import decontam
from tessera.llm._common import read_table

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, size=13):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(item_id))
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()), key=str)


def test_tables(spark):
    docs, items = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert rows(decontam.contamination_report(docs, items)) == want
    assert any(r[5] for r in want)
    kept = {r["doc_id"] for r in decontam.remove_contaminated(docs, items).collect()}
    assert kept == {r[0] for r in want if not r[5]}


PASSAGE = " ".join(f"p{i % 9}" for i in range(40))
ITEMS = [(1, "Short Item"), (2, "one"), (3, None), (4, " .,- "), (5, PASSAGE), (6, "a b c d e"), (7, PASSAGE + " tail"), (10, "Énd É é x y"), (2, "one")]
DOCS = [(1, None), (2, ""), (3, "SHORT, item! short  ITEM"), (4, "one two"), (5, "x " * 500 + PASSAGE.replace(" ", "\n") + " y" * 30), (6, "a b c d e" * 2),
        (7, "p0 p1 p2"), (8, "énd É é x y; Énd É é x y"), (9, "a b c d" + " z" * 200 + " a B c-d e"), (9, "a b c d" + " z" * 200 + " a B c-d e"),
        (None, "one"), (11, "ⅣK a b c d e")]


@pytest.mark.parametrize("block", [decontam.BLOCK, 9])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK", block)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "doc_id AS _row", "text AS pos", "doc_id AS n_words")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(decontam.contamination_report(docs, items)) == brute(DOCS, ITEMS)


def test_empty(spark, no_docs, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.contamination_report(no_docs, items).count() == 0
    out = decontam.contamination_report(odd_docs, items.limit(0)).collect()
    assert len(out) == odd_docs.count() and not any(r["contaminated"] for r in out)
