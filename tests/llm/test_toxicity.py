"""Toxicity: held-out accuracy, what a score may depend on, odd rows."""

import random
import zlib

import pytest

from tessera.llm import toxicity
from tessera.llm._common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    return {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, labels).collect()}


def test_held_out(spark, scored):
    labels = {r["doc_id"]: r["toxic"] for r in read_table(spark, SF, "labels").collect()}
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").collect()}
    assert scored.keys() == texts.keys()
    for d, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    out = [(labels[d], r["score"], r["predicted"]) for d, r in scored.items() if r["held_out"] and d in labels]
    good, bad = [s for y, s, _ in out if not y], [s for y, s, _ in out if y]
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / len(bad) / len(good)
    assert auc > 0.75  # a third of the toxic labels have no sign in the text
    assert sum(p for y, _, p in out if not y) <= 0.03 * len(good)
    assert sum(p for y, _, p in out if y) >= 0.6 * len(bad)


def test_score_is_of_the_text_alone(spark, scored):
    docs = read_table(spark, SF, "documents")
    moved = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source").where("doc_id % 5 = 2")
    rows, scale = toxicity.training_rows(docs, read_table(spark, SF, "labels"), 1000, 2000, 20_000)
    model = toxicity.fit(rows, scale)
    for r in moved.collect():
        assert model.score(r["text"]) == pytest.approx(scored[r["doc_id"]]["score"])


def test_training_leaves_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None), (3, 1)], "doc_id long, toxic int")
    rows, _ = toxicity.training_rows(docs, labels, 30, 500, 6)
    assert sum(y for _, y in rows) == 30 and all(t.startswith("text") and len(t) <= 6 for t, _ in rows)
    rows, _ = toxicity.training_rows(docs, labels, 500, 500, 100)
    assert {int(t.split()[1]) for t, _ in rows} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 0), (6, 1), (77, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity_scores(odd_docs, labels).collect()
    assert len(out) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 6}) == 1
    assert toxicity.toxicity_scores(odd_docs, labels.limit(0)).count() == len(out)
    assert toxicity.toxicity_scores(no_docs, labels).count() == 0


def test_rare_marks_beside_frequent_ones():
    """Words of 2.4 % of the toxic texts count beside one of half of them, and beginnings with many endings."""
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 9))) for _ in range(3000)]

    def text(*marks):
        out = [rng.choice(words) for _ in range(60)]
        for mark in marks:
            out.insert(rng.randrange(len(out)), mark)
        return " ".join(out)

    def ending():
        return "".join(rng.choice("aeioulmnrst") for _ in range(4))

    rows = [(text(), 0) for _ in range(2000)]
    for i in range(1000):
        rare = "quaffwyg" if i % 42 == 0 else "vequyx" + ending() if i % 5 == 1 else None
        rows.append((text(*["kkidiotkk"] * (i % 2), *[rare] * (rare is not None)), 1))
    model = toxicity.fit(rows)
    common, many, plain = model.score(text("kkidiotkk")), model.score(text("quaffwyg")), max(model.score(text()) for _ in range(20))
    assert common > plain and many > plain
    assert sum(model.score(text("vequyx" + ending(), "vequyx" + ending())) > plain for _ in range(20)) >= 15


def test_whole_texts_train(spark):
    docs = spark.createDataFrame([(i, "x" * 30_000 + " end") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    rows, _ = toxicity.training_rows(docs, labels, 30, 500, None)
    assert rows and all(t.endswith(" end") for t, _ in rows)
