"""Quality rules: base counts against plain Python, distances against the formula."""

import math
import random
import re

from tessera.llm import quality
from tessera.llm._common import read_table


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i:i + 5]), []).append(i)
    again = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
            len(words) < 10 or 100 * len(again) > 20 * len(words))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(out, docs):
    rows = sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in out.collect()), key=str)
    assert rows == sorted(((d["doc_id"], *base(d["text"])) for d in docs.collect()), key=str)


def test_tables(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    out = quality.quality_verdicts(docs)
    check(out, docs)
    assert not out.where("base_failed AND kept").count()


def test_odd_rows(spark, odd_docs, no_docs):
    check(quality.quality_verdicts(odd_docs), odd_docs)
    assert quality.quality_verdicts(no_docs).count() == 0 == quality.keep_good(no_docs).count()
    texts = ["a b c d e " * 3, "x a b c d e y a b c d e z", "😀#*$ é ü\x0b\x0c\rw", "l\n\n l\nl\nl \n", "a b c d", "a a a a a a", "a b c d e", "é " * 40_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "CAST(null AS string) AS lang")
    check(quality.quality_verdicts(docs), docs)


def test_js_distance(spark):
    p, q = [3.0, 0.0, 1.0, 4.0], [10.0, 5.0, 0.0, 1.0]
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda x, y: sum(u * math.log2(u / v) for u, v in zip(x, y) if u)
    m = [(x + y) / 2 for x, y in zip(a, b)]
    got = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(quality.js_distance(*map(quality.F.col, "pq"))).first()[0]
    assert abs(got - math.sqrt((kl(a, m) + kl(b, m)) / 2)) < 1e-12


def test_a_language_is_judged_by_its_own_reference(spark):
    """Many clean texts of one language that has no word list, few of another,
    some that name none, and junk under the name of the first."""
    rnd = random.Random(3)

    def text(letters):
        return " ".join("".join(rnd.choices(letters, k=rnd.randint(2, 9))) for _ in range(80))

    rows = [(i, text("αβγδεζηθικλμνξο"), "el") for i in range(150)] + [(200 + i, text("aąbcćdeęłnoóśźż"), "pl") for i in range(40)]
    rows += [(300 + i, text("abcdefghij"), None) for i in range(30)] + [(400 + i, text("ABCDEFG0123456789"), "el") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in quality.quality_verdicts(docs).collect()}
    assert {i for i, r in out.items() if not r["kept"]} == set(range(400, 405))
    assert all((r["char_distance"] is None) == (300 <= i < 400) for i, r in out.items())


def test_junk_goes_and_clean_text_stays(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    out = quality.quality_verdicts(docs).where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(
        quality.F.avg((quality.F.col("kept")).cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in out}
    assert kept[1] > 0.99 and kept[0] < 0.2
