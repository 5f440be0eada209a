"""Porter stemmer as a chain of SQL expressions over one string column.

The published algorithm (Porter, 1980, "An algorithm for suffix stripping"),
with its author's later revisions ``bli -> ble`` and ``logi -> log``, words of
one or two letters left unchanged, and the extensions that are the default of
the common Python implementation: irregular forms; ``ies`` and ``ied`` of
four-letter words give ``ie``; a final y changes only after a consonant that
isn't the first letter; ``alli`` is taken off before the rest of step 2;
``fulli -> ful``; ``logi`` counts its l with the stem; and a two-letter
vowel-consonant stem counts as short.

Three forms that share only the suffix tables: :func:`stem`, a Spark column
expression, looks at a word's last letters first, so that most steps cost a
few comparisons, and can be used inside array functions; :func:`stem_word`, the
same for one Python string, for tasks that stem each distinct word once;
:func:`steps` renders the algorithm step by step as DuckDB SQL, the test oracle.

Vowels/consonants: ``a e i o u`` are vowels; ``y`` is a vowel unless it
starts the word or follows a vowel.  Step 0 marks every consonant ``y`` as
upper-case ``Y``, so afterwards the class ``[aeiouy]`` is exactly "vowel"
and everything else (including ``Y``, digits, accented letters) is a
consonant.  The final step lower-cases the word again.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

V = "[aeiouy]"
C = "[^aeiouy]"

# Suffix tables of the published algorithm (with revisions).
# Step 2 (condition m > 0): suffix -> replacement.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
]
# Step 3 (condition m > 0): suffix -> replacement.
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
# Step 4 (condition m > 1; "ion" also needs the stem to end in s or t).
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


# Irregular forms.
IRREGULAR = {"skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning",
             "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning",
             "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}


def _stem(w: str, k: int) -> str:
    return f"substr({w}, 1, length({w}) - {k})"


def _match(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, '{pattern}')"


def _m_gt0(s: str) -> str:
    return _match(s, f"^{C}*{V}+{C}")


def _m_gt1(s: str) -> str:
    return _match(s, f"^{C}*{V}+{C}+{V}+{C}")


def _m_eq1(s: str) -> str:
    return f"({_m_gt0(s)} AND NOT {_m_gt1(s)})"


def _cvc(s: str) -> str:
    # consonant-vowel-consonant at the end, the last one not w, x or y; or a
    # vowel and a consonant alone
    return f"({_match(s, f'{C}{V}[^aeiouywxY]$')} OR {_match(s, f'^{V}{C}$')})"


def _double(s: str) -> str:
    # two equal consonants at the end (a vowel y and a consonant Y count
    # as the same letter, as in the original character test)
    return (f"(length({s}) >= 2 AND lower(substr({s}, length({s}), 1)) = "
            f"lower(substr({s}, length({s}) - 1, 1)) AND "
            f"{_match(f'substr({s}, length({s}), 1)', f'^{C}$')})")


def _suffix_case(w: str, table, cond) -> str:
    """CASE over suffixes, longest first; a matched suffix whose condition
    fails ends the step (the word is kept)."""
    whens = []
    for suf, rep in sorted(table, key=lambda p: -len(p[0])):
        stem = _stem(w, len(suf))
        new = f"{stem} || '{rep}'" if rep else stem
        whens.append(f"WHEN {w} LIKE '%{suf}' THEN "
                     f"(CASE WHEN {cond(stem, suf)} THEN {new} ELSE {w} END)")
    return "CASE " + " ".join(whens) + f" ELSE {w} END"


def steps(w: str = "w", cut: str = "cut") -> list[tuple[str, str]]:
    """The oracle's form: ordered (column, DuckDB expression) assignments.

    Input columns: ``w`` (the lower-case word).  Output: ``w`` stemmed.  A
    helper column ``cut`` carries "step 1b removed ed/ing" between the two
    halves of step 1b.  The caller keeps the original word for the
    length <= 2 rule (see :func:`final`).
    """
    out: list[tuple[str, str]] = []
    # step 0: mark consonant y
    out.append(("w", f"regexp_replace(regexp_replace({w}, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g')"))
    # step 1a
    out.append(("w", f"CASE WHEN length({w}) = 4 AND {w} LIKE '%ies' THEN {_stem(w, 1)} "
                   f"WHEN {w} LIKE '%sses' OR {w} LIKE '%ies' THEN {_stem(w, 2)} "
                   f"WHEN {w} LIKE '%ss' THEN {w} "
                   f"WHEN {w} LIKE '%s' THEN {_stem(w, 1)} ELSE {w} END"))
    # step 1b, first half: eed / ed / ing
    ed_ok = f"({w} LIKE '%ed' AND NOT {w} LIKE '%eed' AND NOT {w} LIKE '%ied' AND {_match(_stem(w, 2), V)})"
    ing_ok = f"({w} LIKE '%ing' AND NOT {w} LIKE '%eed' AND {_match(_stem(w, 3), V)})"
    out.append(("cut", f"({ed_ok} OR {ing_ok})"))
    out.append(("w", f"CASE WHEN {w} LIKE '%ied' THEN (CASE WHEN length({w}) = 4 THEN {_stem(w, 1)} ELSE {_stem(w, 2)} END) "
                   f"WHEN {w} LIKE '%eed' THEN "
                   f"(CASE WHEN {_m_gt0(_stem(w, 3))} THEN {_stem(w, 1)} ELSE {w} END) "
                   f"WHEN {ed_ok} THEN {_stem(w, 2)} "
                   f"WHEN {ing_ok} THEN {_stem(w, 3)} ELSE {w} END"))
    # step 1b, second half: repair the cut stem
    out.append(("w", f"CASE WHEN NOT {cut} THEN {w} "
                   f"WHEN {w} LIKE '%at' OR {w} LIKE '%bl' OR {w} LIKE '%iz' THEN {w} || 'e' "
                   f"WHEN {_double(w)} AND NOT {_match(w, '[lsz]$')} THEN {_stem(w, 1)} "
                   f"WHEN {_m_eq1(w)} AND {_cvc(w)} THEN {w} || 'e' "
                   f"ELSE {w} END"))
    # step 1c: y -> i after a consonant that isn't the first letter
    out.append(("w", f"CASE WHEN {_match(w, '[yY]$')} AND {_match(_stem(w, 1), f'.{C}$')} "
                   f"THEN {_stem(w, 1)} || 'i' ELSE {w} END"))
    # step 2 (m > 0), alli first; the l of logi is the stem's
    out.append(("w", f"CASE WHEN {w} LIKE '%alli' AND {_m_gt0(_stem(w, 4))} THEN {_stem(w, 2)} ELSE {w} END"))
    out.append(("w", _suffix_case(w, STEP2, lambda s, suf: _m_gt0(_stem(w, 3) if suf == "logi" else s))))
    # step 3 (m > 0)
    out.append(("w", _suffix_case(w, STEP3, lambda s, _: _m_gt0(s))))

    # step 4: m > 1
    def cond4(s, suf):
        if suf == "ion":
            return f"({_match(s, '[st]$')} AND {_m_gt1(s)})"
        return _m_gt1(s)

    out.append(("w", _suffix_case(w, [(s, "") for s in STEP4], cond4)))
    # step 5a: final e
    s1 = _stem(w, 1)
    out.append(("w", f"CASE WHEN {w} LIKE '%e' AND ({_m_gt1(s1)} OR "
                   f"({_m_eq1(s1)} AND NOT {_cvc(s1)})) THEN {s1} ELSE {w} END"))
    # step 5b: ll -> l when m > 1
    out.append(("w", f"CASE WHEN {w} LIKE '%ll' AND {_m_gt1(w)} THEN {s1} ELSE {w} END"))
    return out


def final(orig: str = "orig", w: str = "w") -> str:
    """Irregular forms; words of one or two letters stay as they are; un-mark ``Y``."""
    forms = " ".join(f"WHEN {orig} = '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    return f"CASE {forms} WHEN length({orig}) <= 2 THEN {orig} ELSE lower({w}) END"


# ------------------------------------------------------------- Spark column

def _let(value: Column, body) -> Column:
    """``body(value)``, the value being evaluated once."""
    return F.transform(F.array(value), body)[0]


def _less(w: Column, k: int) -> Column:
    """``w`` without its last k letters (none left if it is shorter)."""
    return F.substr(w, F.lit(1), F.length(w) - k)


def _measure(w: Column, more_than: int) -> Column:
    """Has more vowel-consonant sequences than 0 or 1."""
    return w.rlike(f"^{C}*" + f"{V}+{C}+" * more_than + f"{V}+{C}")


def _is_cvc(w: Column) -> Column:
    return w.rlike(f"{C}{V}[^aeiouywxY]$|^{V}{C}$")


def _replace_suffix(w: Column, table, allowed) -> Column:
    """The longest suffix of ``table`` gives way to its replacement if what is
    left is ``allowed``.  Branches by last letter, so a word meets few suffixes."""
    out = None
    for letter in sorted({suffix[-1] for suffix, _ in table}):
        case = None
        for suffix, new in sorted((r for r in table if r[0][-1] == letter), key=lambda r: -len(r[0])):
            left = _less(w, len(suffix))
            then = F.when(allowed(w, left, suffix), F.concat(left, F.lit(new)) if new else left).otherwise(w)
            case = F.when(w.endswith(suffix), then) if case is None else case.when(w.endswith(suffix), then)
        out = F.when(w.endswith(letter), case.otherwise(w)) if out is None else out.when(w.endswith(letter), case.otherwise(w))
    return out.otherwise(w)


def _mark_y(w: Column) -> Column:
    return F.when(F.contains(w, F.lit("y")), F.regexp_replace(F.regexp_replace(w, "^y", "Y"), "([aeiouy])y", "$1Y")).otherwise(w)


def _plural(w: Column) -> Column:
    # ies of four letters keeps ie; sses, ies lose es; ss stays
    two = w.endswith("sses") | (w.endswith("ies") & (F.length(w) != 4))
    return F.when(~w.endswith("s") | (w.endswith("ss") & ~w.endswith("sses")), w).when(two, _less(w, 2)).otherwise(_less(w, 1))


def _mend(w: Column) -> Column:
    """After ed or ing: at, bl, iz get an e; a double consonant but l, s, z
    loses one; a short word gets an e."""
    double = w.rlike(f"({C})\\1$|yY$") & ~w.rlike("[lsz]$")
    return (F.when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e"))).when(double, _less(w, 1))
            .when(_measure(w, 0) & ~_measure(w, 1) & _is_cvc(w), F.concat(w, F.lit("e"))).otherwise(w))


def _past(w: Column) -> Column:
    def cut(k):
        return _let(_less(w, k), lambda left: F.when(left.rlike(V), _mend(left)).otherwise(w))
    return (F.when(w.endswith("ied"), F.when(F.length(w) == 4, _less(w, 1)).otherwise(_less(w, 2)))
            .when(w.endswith("eed"), F.when(_measure(_less(w, 3), 0), _less(w, 1)).otherwise(w))
            .when(w.endswith("ed"), cut(2)).when(w.endswith("ing"), cut(3)).otherwise(w))


def _final_y(w: Column) -> Column:
    return F.when((w.endswith("y") | w.endswith("Y")) & _less(w, 1).rlike(f".{C}$"), F.concat(_less(w, 1), F.lit("i"))).otherwise(w)


def _alli(w: Column) -> Column:
    return F.when(w.endswith("alli") & _measure(_less(w, 4), 0), _less(w, 2)).otherwise(w)


def _final_e(w: Column) -> Column:
    left = _less(w, 1)
    return F.when(w.endswith("e"), F.when(_measure(left, 1) | (_measure(left, 0) & ~_is_cvc(left)), left).otherwise(w)).otherwise(w)


def _final_ll(w: Column) -> Column:
    return F.when(w.endswith("ll"), F.when(_measure(w, 1), _less(w, 1)).otherwise(w)).otherwise(w)


@functools.cache
def _stems(words: str) -> Column:
    return stems(F.col(words))


def stems(words: Column | str) -> Column:
    """T5: the Porter stems of an array of lower-case words; irregular forms
    first, words of one or two letters as they are.  Each stage runs over the
    whole array, so no lambda stands inside another but where a word is cut.
    The expression for a column's name is built once."""
    if isinstance(words, str):
        return _stems(words)
    stages = [
        _mark_y, _plural, _past, _final_y, _alli,
        lambda w: _replace_suffix(w, STEP2, lambda w, left, s: _measure(_less(w, 3) if s == "logi" else left, 0)),
        lambda w: _replace_suffix(w, STEP3, lambda w, left, s: _measure(left, 0)),
        lambda w: _replace_suffix(w, [(s, "") for s in STEP4],
                                  lambda w, left, s: _measure(left, 1) & left.rlike("[st]$") if s == "ion" else _measure(left, 1)),
        _final_e, _final_ll,
    ]
    out = words
    for stage in stages:
        out = F.transform(out, stage)
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    return F.zip_with(words, out, lambda w, s: F.when(F.length(w) <= 2, w).otherwise(F.coalesce(F.try_element_at(irregular, w), F.lower(s))))


def stem(word: Column) -> Column:
    """T5 of one word."""
    return stems(F.array(word))[0]


# ------------------------------------------------------------ Python string

_HAS_VOWEL = re.compile(V).search
_MEASURE = tuple(re.compile(f"{C}*" + f"{V}+{C}+" * more_than + f"{V}+{C}").match for more_than in (0, 1))
_CVC = re.compile(f"{C}{V}[^aeiouywxY]$|^{V}{C}$").search
_DOUBLE = re.compile(f"({C})\\1$|yY$").search
_Y_AFTER_VOWEL = re.compile("([aeiouy])y")
_Y_AFTER_CONSONANT = re.compile(f".{C}[yY]$").search


def _by_last_letter(table) -> dict[str, list[tuple[str, str]]]:
    rows = sorted(table, key=lambda r: -len(r[0]))
    return {letter: [r for r in rows if r[0][-1] == letter] for letter in {suffix[-1] for suffix, _ in table}}


_SUFFIXES_2, _SUFFIXES_3, _SUFFIXES_4 = _by_last_letter(STEP2), _by_last_letter(STEP3), _by_last_letter([(s, "") for s in STEP4])


def _python_suffix(w: str, table, allowed) -> str:
    for suffix, new in table.get(w[-1:], ()):
        if w.endswith(suffix):
            left = w[:-len(suffix)]
            return left + new if allowed(w, left, suffix) else w
    return w


def _allowed_2(w: str, left: str, suffix: str) -> bool:
    return bool(_MEASURE[0](w[:-3] if suffix == "logi" else left))


def _allowed_3(w: str, left: str, suffix: str) -> bool:
    return bool(_MEASURE[0](left))


def _allowed_4(w: str, left: str, suffix: str) -> bool:
    return bool(_MEASURE[1](left)) and (suffix != "ion" or left[-1:] in ("s", "t"))


def _python_mend(w: str) -> str:
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _DOUBLE(w) and w[-1] not in "lsz":
        return w[:-1]
    return w + "e" if _MEASURE[0](w) and not _MEASURE[1](w) and _CVC(w) else w


def _python_past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _MEASURE[0](w[:-3]) else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix):
            left = w[:-len(suffix)]
            return _python_mend(left) if _HAS_VOWEL(left) else w
    return w


def stem_word(word: str) -> str:
    """T5 of one lower-case word as a Python string; see :func:`stems`."""
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    w = word
    if "y" in w:
        w = _Y_AFTER_VOWEL.sub(r"\1Y", "Y" + w[1:] if w[0] == "y" else w)
    if w.endswith("sses") or w.endswith("ies") and len(w) != 4:
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    w = _python_past(w)
    if w.endswith(("y", "Y")) and _Y_AFTER_CONSONANT(w):
        w = w[:-1] + "i"
    if w.endswith("alli") and _MEASURE[0](w[:-4]):
        w = w[:-2]
    w = _python_suffix(w, _SUFFIXES_2, _allowed_2)
    w = _python_suffix(w, _SUFFIXES_3, _allowed_3)
    w = _python_suffix(w, _SUFFIXES_4, _allowed_4)
    if w.endswith("e"):
        left = w[:-1]
        if _MEASURE[1](left) or _MEASURE[0](left) and not _CVC(left):
            w = left
    if w.endswith("ll") and _MEASURE[1](w):
        w = w[:-1]
    return w.replace("Y", "y")
