"""Quality rules by distribution divergence (DataFrame functions only).

Each document's histograms of character classes and of its language's common
words are compared with the language's reference by the Jensen-Shannon
distance (base 2, from 0 to 1).  The references are the mean histograms of all
documents of the language that pass the base rules and the length guards,
estimated a second time over those of them that are near the first estimate,
so that junk doesn't shift them.  They are one row a language of
``len(CLASSES) + 2`` and at most 70 numbers, written as a table, so that Spark
knows their size when it chooses whether to broadcast them.  Histograms are
summed as whole millionths, which makes the references the same whatever the
order of rows.

Guards: the classes are compared from ``min_chars`` characters on, the words
from ``min_tokens`` tokens on, and only with a reference of ``min_docs``
documents; below, the method has no verdict and keeps the document.  A sample
of n differs from its own distribution by about 1/sqrt(n), so the limits are
wider for short texts: limit + allowance / sqrt(n).

Scale: one pass over the texts gives narrow rows; the references need one
partial aggregation; no text is shuffled, no word leaves its row.

Defined results: null text has no words and fails the base rule of ten words;
each language that the table names has a reference of its own, with the common
words of all lists where ``COMMON`` has none for it; a null language has no
reference, so only the base rules judge it; repeated rows get equal results; an empty table gives no rows; a text may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import let, stored, whole_row

# White space, symbols, classes of characters that are no white
# space (the rest, lower-case consonants mostly, is one more class).
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
CLASSES = {"symbol": SYMBOLS, "digit": "[0-9]", "upper": "[A-Z]", "vowel": "[aeiou]",
           "mark": r"[.,;:!?\x22'()-]", "beyond_ascii": r"[^\x00-\x7F]"}
# Common words.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on are from or this".split(),
    "de": "der die und in den von zu das mit des im für ist nicht ein eine auf dem als auch".split(),
    "fr": "de la le et les des en un une du que est pour dans qui sur au avec par plus".split(),
    "es": "de la que el en y a los se del las un por con una su para es al lo".split(),
}
ANY = list(dict.fromkeys(w for words in COMMON.values() for w in words))
TOKEN_BREAK = r"[\x20\x09-\x0D.,;:!?\x22()]+"
SCALE = 1_000_000


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def repeated_window_words(words: Column, width: int = 5) -> Column:
    """How many words lie in windows of ``width`` words that occur twice or
    more.  Hashes tell whether any window can recur; if so, the windows
    themselves are sorted and compared."""
    starts = F.sequence(F.lit(0), F.size(words) - width)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[words[i + k] for k in range(width)]))

    def exact(_):
        windows = F.sort_array(F.transform(starts, lambda i: F.struct(
            F.array_join(F.slice(words, i + 1, width), " ").alias("t"), i.alias("p"))))

        def count(s):
            again = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["t"] == x["t"])) |
                             F.coalesce(F.get(s, j + 1)["t"] == x["t"], F.lit(False)))
            places = F.sort_array(F.transform(again, lambda x: x["p"]))
            return F.aggregate(
                places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
                lambda acc, p: F.struct((acc["n"] + p + width - F.greatest(p, acc["end"])).alias("n"), (p + width).alias("end")))["n"]

        return let(windows, count)

    any_twice = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) <= width, F.lit(0).cast("long")).when(any_twice, exact(None)).otherwise(F.lit(0).cast("long"))


def with_features(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with a struct ``_q`` of counts and histograms."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lang = F.col(lang_col).cast("string")
    words = F.array_remove(F.split(text, SPACE + "+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    tokens = F.array_remove(F.split(F.lower(text), TOKEN_BREAK), "")
    listed = _strings(ANY)
    for name, own in COMMON.items():
        listed = F.when(F.col(lang_col) == name, _strings(own)).otherwise(listed)

    def by_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_window_words(w).alias("n_repeat_words"))

    def by_chars(compact):
        n = F.length(compact)
        counts = [n - F.length(F.regexp_replace(compact, c + "+", "")) for c in CLASSES.values()]
        return F.struct(n.cast("long").alias("word_chars"), counts[0].cast("long").alias("n_symbols"),
                        F.array(*[c.cast("long") for c in counts]).alias("classes"))

    def by_tokens(t):
        found = F.filter(t, lambda x: x.isin(*ANY))
        return F.struct(F.size(t).cast("long").alias("n_tokens"), let(found, lambda m: F.transform(
            listed, lambda c: (F.size(m) - F.size(F.array_remove(m, c))).cast("long"))).alias("common"))

    dup_lines = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return docs.withColumn("_q", F.struct(
        lang.alias("lang"), let(words, by_words).alias("w"), let(F.regexp_replace(text, SPACE + "+", ""), by_chars).alias("c"),
        let(tokens, by_tokens).alias("t"), dup_lines.alias("n_dup_lines"), F.length(text).cast("long").alias("n_chars")))


def base_failed(q: str = "_q") -> Column:
    n, again = F.col(f"{q}.w.n_words"), F.col(f"{q}.w.n_repeat_words")
    return (n < 10) | (100 * again > 20 * n)


def _shares(counts: Column, total: Column) -> Column:
    """Whole millionths of each count, the rest last."""
    def share(x):
        return F.floor(x * SCALE / total)
    rest = total - F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total > 0, F.concat(F.transform(counts, share), F.array(share(rest))))


def char_shares(q: str = "_q") -> Column:
    """White space, the classes, and the rest, as shares of all characters."""
    c = F.concat(F.array(F.col(f"{q}.n_chars") - F.col(f"{q}.c.word_chars")), F.col(f"{q}.c.classes"))
    return _shares(c, F.col(f"{q}.n_chars"))


def word_shares(q: str = "_q") -> Column:
    return _shares(F.col(f"{q}.t.common"), F.col(f"{q}.t.n_tokens"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms (any scale), base 2."""
    def total(x):
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    def term(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def unit(x):
        return let(total(x), lambda n: F.transform(x, lambda v: v / n))

    parts = F.zip_with(unit(p), unit(q), lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(total(parts), F.lit(0.0)))


def references(features: DataFrame, min_chars: int, min_tokens: int) -> DataFrame:
    """Per language: the documents and summed shares of each histogram."""
    ok = features.where(~base_failed() & F.col("_q.lang").isNotNull()).select(
        F.col("_q.lang").alias("_lang"), F.explode(F.array(
            F.struct(F.lit("c").alias("kind"), F.when(F.col("_q.n_chars") >= min_chars, char_shares()).alias("h")),
            F.struct(F.lit("w").alias("kind"), F.when(F.col("_q.t.n_tokens") >= min_tokens, word_shares()).alias("h")))).alias("x"))
    bins = (ok.select("_lang", "x.kind", F.posexplode("x.h").alias("bin", "share")).groupBy("_lang", "kind", "bin")
            .agg(F.sum("share").alias("share"), F.count(F.lit(1)).alias("n")))
    return bins.groupBy("_lang").agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("bin", "share", "n")))),
                    lambda s: F.struct(s["share"].cast("double").alias("share"), s["n"].alias("n"))).alias(f"_ref_{k}") for k in "cw"])


def _judged_by(features: DataFrame, refs: DataFrame, min_chars, min_tokens, min_docs, char_limit, word_limit, char_allowance, word_allowance):
    out = features.join(refs, F.col("_q.lang") == F.col("_lang"), "left")

    def distance(long_enough, own, ref):
        usable = F.coalesce(F.get(F.col(ref), F.lit(0))["n"] >= min_docs, F.lit(False))
        return F.when(long_enough & usable, js_distance(F.transform(own, lambda x: x.cast("double")), F.col(f"{ref}.share")))

    chars, tokens = F.col("_q.n_chars"), F.col("_q.t.n_tokens")
    out = (out.withColumn("base_failed", base_failed())
           .withColumn("char_distance", distance(chars >= min_chars, char_shares(), "_ref_c"))
           .withColumn("word_distance", distance(tokens >= min_tokens, word_shares(), "_ref_w")))
    far = (F.coalesce(F.col("char_distance") > char_limit + char_allowance / F.sqrt(chars), F.lit(False)) |
           F.coalesce(F.col("word_distance") > word_limit + word_allowance / F.sqrt(tokens), F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~far).drop("_lang", "_ref_c", "_ref_w")


def judged(features: DataFrame, *, min_chars: int = 200, min_tokens: int = 50, min_docs: int = 20,
           char_limit: float = 0.16, word_limit: float = 0.15, char_allowance: float = 1.6, word_allowance: float = 1.6) -> DataFrame:
    """``features`` (stored) with base_failed, char_distance, word_distance, kept."""
    limits = (min_chars, min_tokens, min_docs, char_limit, word_limit, char_allowance, word_allowance)
    first = stored(references(features, min_chars, min_tokens), "references")
    near = _judged_by(features, first, *limits).where("kept").select("_q")
    return _judged_by(features, stored(references(near, min_chars, min_tokens), "references"), *limits)


def quality_verdicts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """Per document: doc_id, n_words, the base counts, base_failed, kept and the two distances."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    out = judged(stored(with_features(narrow).select("doc_id", "_q"), "features"), **limits)
    return out.select("doc_id", "_q.w.n_words", "_q.c.word_chars", "_q.c.n_symbols", "_q.n_dup_lines", "_q.w.n_repeat_words",
                      "base_failed", "kept", F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with the columns of ``docs``, whatever their names."""
    rows = with_features(docs.select(whole_row(docs)), "_in.text", "_in.lang")
    return judged(stored(rows, "features"), **limits).where("kept").select("_in.*")
