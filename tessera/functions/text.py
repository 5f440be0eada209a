"""Text analysis (tokenise, stop words, possessives, Porter, ASCII fold).

Order of the steps matters and follows the reference pipeline:

1. lower-case, then tokenise into runs of letters/digits that may be joined
   by an apostrophe or hyphen (``chef's``, ``12-14``, ``über-cool``);
2. drop English stop words (tested on the lower-cased, unstemmed token);
3. strip a trailing possessive ``'s`` and Porter-stem the rest;
4. fold accented Latin letters to ASCII;
5. turn ``'`` and ``-`` into blanks, drop empty and all-digit tokens;
6. split on blanks (the pieces are not filtered or stemmed again).

Two forms:

* :func:`analyze` - an ``array<string>`` column, a native expression for per-row use (no stem);
* :func:`analyze_tokens` - the weighted long table ``(id, term, n)``: words by
  native expressions, counted by row on Arrow batches inside the task (no
  shuffle), each distinct word analysed once.

Known deviations from an NLTK tokenizer (accepted, see README): ``...`` and
quote tokens are never produced; ``don't`` stays whole (and is a stop word);
``1,000`` and ``3.5`` become digit runs and are dropped.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import porter

TOKEN_RE = "[\\p{L}\\p{N}]+(?:['’-][\\p{L}\\p{N}]+)*"
# What Python's str.split() and str.strip() take as blank
# (a regex class for Java and RE2).
BLANK = ("[\\t\\n\\x{000B}\\f\\r \\x{001C}-\\x{001F}\\x{0085}\\x{00A0}\\x{1680}"
         "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
STRIP_RE = f"^{BLANK}+|{BLANK}+$"
DIGITS_RE = "^\\p{Nd}+$"
POSSESSIVE_RE = "['’]s$"

# The English stop-word list of the NLTK corpus, in its order.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself "
    "it it's its itself they them their theirs themselves what which who whom "
    "this that that'll these those am is are was were be been being have has "
    "had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before "
    "after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will "
    "just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan "
    "shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()

# ASCII folding of lower-case Latin letters (target, sources),
# and letters that fold to two characters.
FOLD_SINGLE = [
    ("a", "àáâãäåāăą"), ("c", "çćĉċč"), ("d", "ďđð"), ("e", "èéêëēĕėęě"),
    ("g", "ĝğġģ"), ("h", "ĥħ"), ("i", "ìíîïĩīĭįı"), ("j", "ĵ"), ("k", "ķ"),
    ("l", "ĺļľŀł"), ("n", "ñńņň"), ("o", "òóôõöøōŏő"), ("r", "ŕŗř"),
    ("s", "śŝşš"), ("t", "ţťŧ"), ("u", "ùúûüũūŭůűų"), ("w", "ŵ"), ("y", "ýÿŷ"),
    ("z", "źżž"), ("'", "’"),
]
FOLD_MULTI = [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"), ("ĳ", "ij")]

FOLD_FROM = "".join(src for _, src in FOLD_SINGLE)
FOLD_TO = "".join(dst * len(src) for dst, src in FOLD_SINGLE)


# ---------------------------------------------------------------- columns

def tokenize(text: Column) -> Column:
    """T1+T2: lower-case word tokens; NULL text gives an empty array."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RE), F.lit(0)),
        F.array().cast("array<string>"))


def remove_stop_words(tokens: Column) -> Column:
    """Drop English stop words (membership on the lower-case token)."""
    return F.filter(tokens, lambda t: ~t.isin(STOP_WORDS))


def fold(term: Column) -> Column:
    """ASCII-fold accented Latin letters (after stemming)."""
    out = F.translate(term, FOLD_FROM, FOLD_TO)
    for src, dst in FOLD_MULTI:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def split_pieces(tokens: Column) -> Column:
    """``'``/``-`` to blanks, drop empty/all-digit, split on blanks."""
    blanked = F.transform(tokens, lambda t: F.translate(t, "'-", "  "))
    kept = F.filter(blanked, lambda t: (t != "") & ~t.rlike(DIGITS_RE))
    pieces = F.flatten(F.transform(kept, lambda t: F.split(F.trim(t), " +")))
    return F.filter(pieces, lambda t: t != "")


def analyze(text: Column, stop: bool = True, do_fold: bool = True) -> Column:
    """Array form of the analysis without stemming."""
    toks = tokenize(text)
    if stop:
        toks = remove_stop_words(toks)
    if do_fold:
        toks = F.transform(toks, fold)
    return split_pieces(toks)


_FOLD = str.maketrans({src: dst for dst, sources in FOLD_SINGLE for src in sources} | dict(FOLD_MULTI))
_BLANKED = str.maketrans("'-", "  ")
_STOP = frozenset(STOP_WORDS)
KNOWN_WORDS = 1 << 19  # words whose terms a worker remembers
TASK_WORDS = 1 << 20  # words that a task counts at a time


def word_terms(word: str, stop: bool = True, stem: bool = True, do_fold: bool = True) -> list[str]:
    """T3-T10 of one lower-case word: its terms, none for a stop word or a number."""
    if stop and word in _STOP:
        return []
    w = word[:-2] if word.endswith(("'s", "’s")) else word
    if stem:
        w = porter.stem_word(w)
    if do_fold and not w.isascii():  # only letters beyond ASCII are folded
        w = w.translate(_FOLD)
    if w.isalnum():  # most words
        return [] if w.isdecimal() else [w]
    w = w.translate(_BLANKED)
    return [] if w.isdecimal() else [t for t in w.split(" ") if t]


@functools.cache
def _remembered(stop: bool, stem: bool, do_fold: bool):
    """:func:`word_terms` with a memory that a worker's next tasks find again."""
    return functools.lru_cache(maxsize=KNOWN_WORDS)(functools.partial(word_terms, stop=stop, stem=stem, do_fold=do_fold))


def _document_slices(words):
    """(first, number) of rows of at most TASK_WORDS words together (or one row)."""
    import numpy as np
    ends = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + TASK_WORDS, side="right")))
        yield first, last - first
        first = last


def _counted(words, terms_of):
    """(row, term, n) of an Arrow list column of words, as numpy rows, Arrow
    terms and numpy counts: each distinct word is analysed once, the words of
    all rows become numbers, and equal (row, term) pairs are counted."""
    import numpy as np
    import pyarrow as pa
    coded = words.flatten().dictionary_encode()
    codes, numbers, pieces, n_pieces = coded.indices.to_numpy(), {}, [], []
    for word in coded.dictionary.to_pylist():
        terms = terms_of(word)
        n_pieces.append(len(terms))
        pieces.extend([numbers.setdefault(t, len(numbers)) for t in terms])
    pieces, n_pieces = np.array(pieces, dtype=np.int64), np.array(n_pieces, dtype=np.int64)
    row = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy(zero_copy_only=False))
    many = n_pieces[codes]  # terms of each word of each row
    at = np.repeat((np.cumsum(n_pieces) - n_pieces)[codes] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    pairs, n = np.unique(np.repeat(row, many) * max(1, len(numbers)) + pieces[at], return_counts=True)
    row, term = np.divmod(pairs, max(1, len(numbers)))
    return row, pa.array(list(numbers), pa.string()).take(pa.array(term)), n


def count_terms(df: DataFrame, keys: list[str], text_col: str, stop: bool = True,
                stem: bool = True, do_fold: bool = True, term_col: str = "term") -> DataFrame:
    """T1-T11 and T13 inside the text's own task: ``keys``, ``term_col`` and
    ``n``, the number of occurrences of the term in the row's text.

    Spark lower-cases and tokenises; a task turns the words of its Arrow batches
    into numbers, analyses every distinct word once (its worker remembers KNOWN_WORDS
    of them) and counts by row.  Nothing is shuffled and no dictionary is kept
    beyond a task's, so the work grows with the texts alone.
    """
    def run(batches):
        import pyarrow as pa
        terms_of = _remembered(stop, stem, do_fold)
        for batch in batches:
            for first, size in _document_slices(batch.column(len(keys))):
                part = batch.slice(first, size)
                row, term, n = _counted(part.column(len(keys)), terms_of)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(row) for i in range(len(keys))), term, pa.array(n, pa.int64())],
                                                 names=[*keys, term_col, "n"])

    rows = df.select(*keys, tokenize(F.col(text_col)).alias("_words"))
    out = T.StructType([T.StructField(k, rows.schema[k].dataType) for k in keys]
                       + [T.StructField(term_col, T.StringType()), T.StructField("n", T.LongType())])
    return rows.mapInArrow(run, out)


def analyze_tokens(df: DataFrame, id_col: str | list[str], text_col: str, stop: bool = True,
                   stem: bool = True, do_fold: bool = True, term_col: str = "term",
                   materialize: bool = False) -> DataFrame:
    """The weighted token table ``(id_col, term, n)`` of a text column, one
    row per document (a row of ``df``) and term; ``id_col`` may be several
    columns.  See :func:`count_terms`: no shuffle.  ``materialize`` writes it to
    the shared folder, so the corpus is analysed once for all consumers.
    Documents with no token produce no row; callers count documents from ``df``.
    """
    from tessera.sources.files import materialize as _mat
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    out = count_terms(df, keys, text_col, stop=stop, stem=stem, do_fold=do_fold, term_col=term_col)
    return _mat(out, "tokens") if materialize else out


def whitespace_tokens(text: Column) -> Column:
    """``str.split()``: separated by any Unicode blank, case kept, no analysis."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+"), lambda t: t != "")


def strip_lower(text: Column) -> Column:
    """Python-style ``strip().lower()`` (all Unicode blanks)."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), STRIP_RE, ""))


# ----------------------------------------------------- DuckDB (oracle) SQL

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_stop_list() -> str:
    return "[" + ", ".join(_sql_str(w) for w in STOP_WORDS) + "]"


def sql_tokenize(text_sql: str) -> str:
    return f"coalesce(regexp_extract_all(lower({text_sql}), {_sql_str(TOKEN_RE)}, 0), [])"


def sql_fold(term_sql: str) -> str:
    out = f"translate({term_sql}, {_sql_str(FOLD_FROM)}, {_sql_str(FOLD_TO)})"
    for src, dst in FOLD_MULTI:
        out = f"replace({out}, {_sql_str(src)}, {_sql_str(dst)})"
    return out


def sql_analyze(text_sql: str, stop: bool = True, do_fold: bool = True) -> str:
    """DuckDB twin of :func:`analyze` (list expression)."""
    toks = sql_tokenize(text_sql)
    if stop:
        toks = f"list_filter({toks}, lambda t: NOT list_contains({sql_stop_list()}, t))"
    if do_fold:
        toks = f"list_transform({toks}, lambda t: {sql_fold('t')})"
    toks = f"list_transform({toks}, lambda t: translate(t, '''-', '  '))"
    toks = (f"list_filter({toks}, lambda t: t <> '' AND NOT "
            f"regexp_matches(t, {_sql_str(DIGITS_RE)}))")
    toks = f"flatten(list_transform({toks}, lambda t: string_split_regex(trim(t), ' +')))"
    return f"list_filter({toks}, lambda t: t <> '')"


def sql_tokens_ctes(prefix: str, source_sql: str, id_col: str, text_col: str,
                    stop: bool = True, stem: bool = True, do_fold: bool = True,
                    term_col: str = "term") -> tuple[list[str], str]:
    """DuckDB twin of :func:`analyze_tokens` as a list of CTEs.

    Returns (ctes, name of the last CTE) producing ``(id_col, term_col)``.
    """
    toks = sql_tokenize(text_col)
    if stop:
        toks = f"list_filter({toks}, lambda t: NOT list_contains({sql_stop_list()}, t))"
    ctes = [f"{prefix}_0 AS (SELECT {id_col}, unnest({toks}) AS w FROM ({source_sql}) AS src)"]
    last = f"{prefix}_0"
    if stem:
        ctes.append(f"{prefix}_p AS (SELECT {id_col}, regexp_replace(w, "
                    f"{_sql_str(POSSESSIVE_RE)}, '') AS w FROM {last})")
        ctes.append(f"{prefix}_o AS (SELECT {id_col}, w, w AS orig, false AS cut FROM {prefix}_p)")
        last = f"{prefix}_o"
        for i, (name, expr) in enumerate(porter.steps()):
            ctes.append(f"{prefix}_s{i} AS (SELECT * REPLACE ({expr} AS {name}) FROM {last})")
            last = f"{prefix}_s{i}"
        ctes.append(f"{prefix}_f AS (SELECT {id_col}, {porter.final('orig', 'w')} AS w FROM {last})")
        last = f"{prefix}_f"
    w = sql_fold("w") if do_fold else "w"
    ctes.append(f"{prefix}_b AS (SELECT {id_col}, translate({w}, '''-', '  ') AS w FROM {last})")
    ctes.append(f"{prefix}_t AS (SELECT {id_col}, unnest(string_split_regex(trim(w), ' +')) AS {term_col} "
                f"FROM {prefix}_b WHERE w <> '' AND NOT regexp_matches(w, {_sql_str(DIGITS_RE)}))")
    ctes.append(f"{prefix} AS (SELECT {id_col}, {term_col} FROM {prefix}_t WHERE {term_col} <> '')")
    return ctes, prefix
