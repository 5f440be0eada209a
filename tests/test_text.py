import random

import duckdb
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions import porter
from tessera.functions import text as tx

STEMS = {
    "caresses": "caress", "ponies": "poni", "agreed": "agre", "plastered": "plaster",
    "motoring": "motor", "conflated": "conflat", "hopping": "hop", "falling": "fall",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "digitizer": "digit", "triplicate": "triplic", "electrical": "electr", "adoption": "adopt",
    "cease": "ceas", "controll": "control", "roll": "roll", "seasonal": "season",
    "cuisine": "cuisin", "restaurants": "restaur", "feed": "feed", "is": "is",
    # the default mode's own forms and rules, from its published examples
    "dying": "die", "skies": "sky", "news": "news", "dies": "die", "flies": "fli", "died": "die", "denied": "deni",
    "mules": "mule", "owned": "own", "humbled": "humbl", "sized": "size", "meeting": "meet", "stating": "state",
    "siezing": "siez", "itemization": "item", "sensational": "sensat", "traditional": "tradit", "reference": "refer",
    "colonizer": "colon", "plotted": "plot", "day": "day", "enjoy": "enjoy", "holiday": "holiday", "tied": "tie",
    "wonderfully": "wonder", "aging": "age", "conditionally": "condit", "geology": "geolog", "by": "by", "spied": "spi",
}


def _analyze(spark, text, **kw):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(tx.analyze(F.col("t"), **kw).alias("a")).first().a


def test_basic_keeps_digit_pieces(spark):
    # T9 before T10: "12-14" survives as two pieces, a lone number does not
    assert _analyze(spark, "pages 12-14 2024", stop=False) == ["pages", "12", "14"]


def test_stop_words_and_fold(spark):
    assert _analyze(spark, "The Café of the Über-cool") == ["cafe", "uber", "cool"]


def test_null_and_empty(spark):
    assert _analyze(spark, None) == []
    assert _analyze(spark, "  ...  ") == []


def test_porter_stems_spark(spark):
    df = spark.createDataFrame(list(STEMS.items()), "w string, want string")
    for r in df.select("w", porter.stem(F.col("w")).alias("s"), "want").collect():
        assert r.s == r.want, r.w


def test_porter_forms_agree(spark):
    """The column expression and the step-by-step SQL, written apart, give
    the same stems of words made of all suffixes, and of the corpus."""
    rnd = random.Random(1)
    suffixes = [s for s, _ in porter.STEP2 + porter.STEP3] + porter.STEP4 + "s es ies ied ed eed ing y e ll ss sses at bl iz tt zz yy".split()
    parts = "b y ay qu tr on al e a i o st ng ll ss per hop tan fil ie sky 1 é".split()
    words = {"".join(rnd.choices(parts, k=rnd.randint(0, 4))) + "".join(rnd.choices(suffixes, k=rnd.randint(0, 3))) for _ in range(20_000)}
    words |= {w + s for w in porter.IRREGULAR for s in ("", "s", "ing", "ed")} - {""}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words |= {r.w for r in docs.select(F.explode(tx.tokenize(F.col("text"))).alias("w")).distinct().collect()}
    table = pd.DataFrame({"w": sorted(words)})
    got = {r.w: r.s for r in spark.createDataFrame(table).select("w", porter.stem(F.col("w")).alias("s")).collect()}
    ctes, last = ["o AS (SELECT w, w AS orig, false AS cut FROM words)"], "o"
    for i, (name, expr) in enumerate(porter.steps()):
        ctes.append(f"s{i} AS (SELECT * REPLACE ({expr} AS {name}) FROM {last})")
        last = f"s{i}"
    con = duckdb.connect()
    con.register("words", table)
    want = dict(con.sql("WITH " + ", ".join(ctes) + f" SELECT orig, {porter.final('orig', 'w')} FROM {last}").fetchall())
    assert got == want


def test_porter_stems_duckdb():
    con = duckdb.connect()
    vals = ", ".join(f"({i}, '{w}')" for i, w in enumerate(STEMS))
    con.execute(f"CREATE TABLE x AS SELECT * FROM (VALUES {vals}) t(id, txt)")
    ctes, last = tx.sql_tokens_ctes("tk", "SELECT id, txt FROM x", "id", "txt", stop=False)
    rows = con.sql("WITH " + ", ".join(ctes) + f" SELECT id, term FROM {last} ORDER BY id").fetchall()
    words = list(STEMS)
    assert {words[i]: t for i, t in rows} == STEMS


def test_possessive_then_stem(spark):
    df = spark.createDataFrame([(1, "The chef's restaurants")], "doc_id long, text string")
    terms = [r.term for r in tx.analyze_tokens(df, "doc_id", "text").collect()]
    assert terms == ["chef", "restaur"]


def test_whitespace_tokens_and_strip(spark):
    df = spark.createDataFrame([(" Bar  chef's\ttable ",)], "t string")
    r = df.select(tx.whitespace_tokens(F.col("t")).alias("a"), tx.strip_lower(F.col("t")).alias("s")).first()
    assert r.a == ["Bar", "chef's", "table"]
    assert r.s == "bar  chef's\ttable"


def test_counts_against_plain_python(spark):
    """Counts inside the row, words of one stem together; the plan shuffles nothing."""
    docs = spark.createDataFrame([(1, "Runs running run, runner! the RUN's own-run 12-run"), (2, None), (3, ""), (4, "the of"), (1, "run")],
                                 "doc_id long, text string")
    out = tx.analyze_tokens(docs, "doc_id", "text")
    assert sorted(map(tuple, out.collect())) == [(1, "12", 1), (1, "own", 1), (1, "run", 1), (1, "run", 6), (1, "runner", 1)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_words_are_analysed_once_by_word(spark, monkeypatch):
    """The string form of the stemmer gives the column's stems, and the counts
    by row are those of the array form, however the rows are cut into slices."""
    rnd = random.Random(7)
    suffixes = [s for s, _ in porter.STEP2 + porter.STEP3] + porter.STEP4 + "s es ies ied ed eed ing y e ll ss at bl iz tt ’s".split()
    parts = "b y ay qu tr on al e a i o st ng ll ss per hop tan fil ie sky 1 é ß".split()
    words = {"".join(rnd.choices(parts, k=rnd.randint(1, 4))) + "".join(rnd.choices(suffixes, k=rnd.randint(0, 3))) for _ in range(3000)} | set(porter.IRREGULAR)
    got = {r.w: r.s for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", porter.stem(F.col("w")).alias("s")).collect()}
    assert {w: porter.stem_word(w) for w in words} == got
    texts = ["Chef's chef’s THE over-easy 12-14 1234 ßtraße", None, "", "x x y", "the of", "- ' x", "Łódź-Łódź Łódź"]
    df = spark.createDataFrame([(i % 5 if i < 6 else None, t) for i, t in enumerate(texts)], "i long, t string").coalesce(1)
    for stop in (True, False):
        want = sorted((str(r.i), t, r.a.count(t)) for r in df.select("i", tx.analyze(F.regexp_replace(F.lower("t"), "['’]s\\b", ""), stop=stop).alias("a")).collect() for t in set(r.a))
        assert sorted((str(r.i), r.term, r.n) for r in tx.analyze_tokens(df, "i", "t", stop=stop, stem=False).collect()) == want
    words = pa.array([["a", "b"], [], ["c"] * 9, ["a"], ["b", "a", "a"]])
    monkeypatch.setattr(tx, "TASK_WORDS", 4)
    assert list(tx._document_slices(words)) == [(0, 2), (2, 1), (3, 2)]
    counted = lambda w: [(r, t, n) for r, t, n in zip(*(x.tolist() for x in tx._counted(w, lambda t: [t] if t != "b" else ["x", "x"])))]
    assert sorted(counted(words)) == [(0, "a", 1), (0, "x", 2), (2, "c", 9), (3, "a", 1), (4, "a", 2), (4, "x", 2)]
    assert counted(pa.array([[], []], pa.list_(pa.string()))) == []


def test_analysis_stems_no_arrays(spark):
    """No stemming inside array functions, which Spark interprets word by word."""
    plan = tx.analyze_tokens(spark.createDataFrame([(1, "a")], "i long, t string"), "i", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "MapInArrow" in plan


def test_plain_words_are_not_folded_or_cut():
    class Word(str):
        calls = 0

        def translate(self, table):
            Word.calls += 1
            return str.translate(self, table)

    assert tx.word_terms(Word("table"), stem=False) == ["table"] and tx.word_terms(Word("2024"), stem=False) == [] and Word.calls == 0
    assert tx.word_terms(Word("über-cool"), stem=False) == ["uber", "cool"] and Word.calls > 0
    words = ["", "12-14", "chef’s", "chef's", "o'neil", "straße", "١٢", "x²", "½", "-", "'", "y", "yyy", "sky", "employed", "happy", "ing", "ied", "eed"]
    for w in words:
        for fold in (True, False):
            v = w[:-2] if w.endswith(("'s", "’s")) else w
            v = (v.translate(tx._FOLD) if fold else v).translate(tx._BLANKED)
            assert tx.word_terms(w, stop=False, stem=False, do_fold=fold) == ([] if v.isdecimal() else [t for t in v.split(" ") if t]), w
