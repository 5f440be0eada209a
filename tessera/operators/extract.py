"""Page-level extraction as column expressions.

A page is one row ``(page_id, url, html)``; every field is a native regex
expression over the row, so extraction is a narrow projection (no shuffle,
no DOM, no Python).  Selectors anchor on tag/class names of the page
template and read leaf text or one attribute; arbitrarily nested markup is
out of scope.  A missing node yields NULL (plus a name in ``_errors``)
instead of failing the job.

The regexes use only constructs shared by Java and RE2 (no look-around, no
back-references), so the DuckDB oracle runs the very same patterns.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import STRIP_RE

TAG_RE = "<[^>]+>"
# HTML's named entities of Latin-1, U+00A0 to U+00FF in order,
# and the others that text is written with.
LATIN_1 = ("nbsp iexcl cent pound curren yen brvbar sect uml copy ordf laquo not shy reg macr deg plusmn sup2 sup3 acute micro "
           "para middot cedil sup1 ordm raquo frac14 frac12 frac34 iquest Agrave Aacute Acirc Atilde Auml Aring AElig Ccedil "
           "Egrave Eacute Ecirc Euml Igrave Iacute Icirc Iuml ETH Ntilde Ograve Oacute Ocirc Otilde Ouml times Oslash Ugrave "
           "Uacute Ucirc Uuml Yacute THORN szlig agrave aacute acirc atilde auml aring aelig ccedil egrave eacute ecirc euml "
           "igrave iacute icirc iuml eth ntilde ograve oacute ocirc otilde ouml divide oslash ugrave uacute ucirc uuml yacute "
           "thorn yuml").split()
NAMED = {name: chr(0xA0 + i) for i, name in enumerate(LATIN_1)} | {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "euro": "€", "ndash": "–", "mdash": "—", "lsquo": "‘",
    "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•", "hellip": "…", "oelig": "œ", "OElig": "Œ", "trade": "™"}
# What the DuckDB twins decode (the driver's pages hold no others in the fields they read).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&nbsp;", "\u00a0"), ("&amp;", "&")]


def decode_entities(x: Column) -> Column:
    """Named and numeric character references as their characters, each once;
    unknown ones stay.  One transform a step, so that nothing is computed twice
    (Spark shares no expressions inside lambdas)."""
    names = F.create_map(*[F.lit(v) for pair in NAMED.items() for v in pair])

    def named(p, i):
        name = F.when(i > 0, F.regexp_extract(p, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1))
        return F.struct(p.alias("p"), name.alias("name"))

    def numbered(x):
        name = x["name"]
        digits = F.when(name.startswith("#x") | name.startswith("#X"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(
            name.startswith("#"), F.substr(name, F.lit(2)))
        return F.struct(x["p"].alias("p"), name.alias("name"), digits.cast("long").alias("code"))

    def piece(x):
        p, name, code = x["p"], x["name"], x["code"]
        known = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        char = F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).when(code.isNotNull(), "\ufffd").otherwise(
            F.try_element_at(names, name))
        return F.when(name.isNull(), p).otherwise(F.coalesce(F.concat(char, F.substr(p, F.length(name) + 2)), F.concat(F.lit("&"), p)))

    return F.array_join(F.transform(F.transform(F.transform(F.split(x, "&"), named), numbered), piece), "")


def node_text(x: Column, strip: bool = True) -> Column:
    """Text of a markup fragment: tags removed, entities decoded, and
    (where the reference strips) all leading/trailing whitespace removed."""
    out = decode_entities(F.regexp_replace(x, TAG_RE, ""))
    if strip:
        out = F.regexp_replace(out, STRIP_RE, "")
    return out


def first(html: Column, pattern: str) -> Column:
    """Group 1 of the first match, NULL when absent."""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def all_of(html: Column, pattern: str) -> Column:
    """Group 1 of every match, in document order."""
    return F.coalesce(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)),
                      F.array().cast("array<string>"))


@dataclass(frozen=True)
class Field:
    """One extracted field: a regex whose group 1 is the node or attribute,
    text clean-up, list or single value."""

    name: str
    pattern: str
    text: bool = True
    strip: bool = True
    many: bool = False
    required: bool = True


# Selectors of the driver's page template.
PAGE_FIELDS = [
    Field("lang", '<html[^>]*[ ]lang="([^"]*)"', text=False),
    Field("title", "(?s)<title>(.*?)</title>", strip=False),
    Field("h1", "(?s)<article>.*?<h1>(.*?)</h1>"),
    Field("nav_links", '<li><a href="([^"]*)"', text=False, many=True, required=False),
]


def extract(df: DataFrame, fields: list[Field], html_col: str = "html",
            keep: tuple = ("page_id",)) -> DataFrame:
    """Apply a declarative field list; adds ``_errors``."""
    h = F.col(html_col)
    cols = []
    missing = []
    for f in fields:
        if f.many:
            v = all_of(h, f.pattern)
            if f.text:
                v = F.transform(v, lambda x, s=f.strip: node_text(x, s))
        else:
            v = first(h, f.pattern)
            if f.text:
                v = node_text(v, f.strip)
        cols.append(v.alias(f.name))
        if f.required and not f.many:
            missing.append(F.when(v.isNull(), F.lit(f.name)))
    errors = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    return df.select(*keep, *cols, errors.alias("_errors"))


def paragraphs(html: Column) -> Column:
    """X6f-style list: text of every ``<p>`` inside ``<article>``, a
    paragraph running to the next ``<p>`` or ``</p>``; document order,
    duplicates kept, each stripped."""
    article = F.regexp_extract(html, "(?s)<article>(.*?)</article>", 1)
    pieces = F.split(article, "<p>")
    pieces = F.slice(pieces, 2, F.size(pieces))
    return F.transform(pieces, lambda p: node_text(F.regexp_replace(p, "(?s)</p>.*$", "")))


def host(url: Column) -> Column:
    return F.regexp_extract(url, "^([a-z]+://[^/?#]+)", 1)


def links(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every nav link ``href`` (non-empty) prefixed with the page host;
    duplicates kept.  Output (page_id, pos, link)."""
    hrefs = F.filter(all_of(F.col(html_col), '<li><a href="([^"]*)"'), lambda x: x != "")
    return (df.select("page_id", host(F.col(url_col)).alias("_host"), F.posexplode(hrefs).alias("pos", "href"))
            .select("page_id", F.col("pos").cast("long").alias("pos"),
                    F.concat("_host", "href").alias("link")))


def url_key(url: Column) -> Column:
    """Last path segment of the URL, ``unknown`` if empty."""
    return F.coalesce(F.nullif(F.regexp_extract(url, "[^/]+$", 0), F.lit("")), F.lit("unknown"))


def split_address(addr: Column) -> dict[str, Column]:
    """Comma parts; city/postal/country are the last three (leading
    blanks kept), the rest joined by a blank, stripped, newlines removed.
    Fewer than three parts -> NULLs (the reference raises)."""
    a = F.split(F.regexp_replace(addr, STRIP_RE, ""), ",")
    ok = F.size(a) >= 3
    rest = F.slice(a, 1, F.greatest(F.size(a) - 3, F.lit(0)))
    return {
        "city": F.when(ok, F.try_element_at(a, F.lit(-3))),
        "postalCode": F.when(ok, F.try_element_at(a, F.lit(-2))),
        "country": F.when(ok, F.try_element_at(a, F.lit(-1))),
        "address": F.when(ok, F.replace(F.regexp_replace(F.concat_ws(" ", rest), STRIP_RE, ""),
                                        F.lit("\n"), F.lit(""))),
    }


def split_price_category(s: Column) -> dict[str, Column]:
    """X6d: ``price · category``, exactly two parts, both stripped; NULLs
    otherwise (the reference raises)."""
    a = F.split(F.regexp_replace(s, STRIP_RE, ""), "·")
    ok = F.size(a) == 2
    return {
        "priceRange": F.when(ok, F.regexp_replace(F.try_element_at(a, F.lit(1)), STRIP_RE, "")),
        "cuisineType": F.when(ok, F.regexp_replace(F.try_element_at(a, F.lit(2)), STRIP_RE, "")),
    }


def card_codes(html: Column) -> Column:
    """X6g: card codes from ``data-src`` image paths: the lower-case run
    after a ``/`` and before a ``-``."""
    srcs = all_of(html, f"<img{GAP}[^>]*data-src{VALUE}")
    return F.transform(srcs, lambda p: F.regexp_extract(p, "/([a-z]*)-", 1))


# Inside a tag: what parts attributes, and an attribute's value in either quotes.
GAP = "[ \\t\\r\\n]"
VALUE = "\\s*=\\s*[\"']([^\"']*)[\"']"


def og_url(html: Column) -> Column:
    """X6i: content of the first ``<meta property="og:url">``, attributes in
    any order and with either quotes, entities decoded."""
    metas = F.filter(F.regexp_extract_all(html, F.lit(f"(?i)<meta{GAP}[^>]*>"), F.lit(0)),
                     lambda m: m.rlike(f"(?i){GAP}property\\s*=\\s*[\"']og:url[\"']"))
    content = F.transform(F.slice(metas, 1, 1), lambda m: F.regexp_extract(m, f"(?i){GAP}content{VALUE}", 1))
    return decode_entities(F.get(F.filter(content, lambda c: c != ""), F.lit(0)))


# ------------------------------------------------------- the listing record

def opened(tag: str, *tokens: str) -> str:
    """Regex of an opening tag whose class holds the tokens, in any order."""
    inside = "|".join(f"(?:[^\"']*{GAP})".join(order) for order in itertools.permutations(tokens))
    return f"<{tag}{GAP}(?:[^>]*{GAP})?class\\s*=\\s*[\"'](?:[^\"']*{GAP})?(?:{inside})(?:{GAP}[^\"']*)?[\"'][^>]*>"


def _at_tags(markup: Column, tag: str) -> Column:
    """The markup cut at the ``<`` of every opening and closing ``tag`` (joined by
    ``<`` it is whole again); a blank is put before it, so that the first piece
    is no tag and every other one is, without its ``<``."""
    return F.split(F.concat(F.lit(" "), markup), f"(?i)<(?=/?{tag}[\\s/>])")


def _turn(piece: Column, i: Column) -> Column:
    """What a piece does to the depth: 1 (it opens), -1 (it closes), 0 (the first)."""
    return F.when(i == 0, 0).when(piece.startswith("/"), -1).otherwise(1)


def balanced(markup: Column, tag: str) -> Column:
    """``markup`` starts after an opening ``tag``: what it holds up to the end
    tag of its own, elements of the same name inside included (one pass over
    the tags with a running depth; to the end if it is never closed)."""
    def step(acc, turn):
        depth = acc["depth"] + turn
        return F.when(acc["depth"] == 0, acc).otherwise(
            F.struct(depth.alias("depth"), (acc["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n")))

    def kept(pieces):
        n = F.aggregate(F.transform(pieces, _turn), F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), step)["n"]
        return F.substr(F.array_join(F.slice(pieces, F.lit(1), n), "<"), F.lit(2))

    return F.transform(F.array(_at_tags(markup, tag)), kept)[0]


def element(html: Column, start: str, tag: str) -> Column:
    """The content of the first element whose opening tag is like ``start``; NULL if absent."""
    return balanced(F.get(F.split(html, f"(?s){start}", 2), F.lit(1)), tag)


def children(markup: Column, start: str, tag: str) -> Column:
    """The content of the elements like ``start`` that lie directly in
    ``markup``, in no other element named ``tag``."""
    empty = F.array().cast("array<int>")

    def step(acc, x):
        depth = F.greatest(acc["depth"] + x["turn"], F.lit(0))
        begins = (x["turn"] == 1) & (acc["depth"] == 0) & F.concat(F.lit("<"), x["piece"]).rlike(f"(?s)^{start}")
        ends = (x["turn"] == -1) & (depth == 0) & (F.size(acc["a"]) > F.size(acc["z"]))
        return F.struct(depth.alias("depth"), (acc["i"] + 1).alias("i"),
                        F.when(begins, F.array_append(acc["a"], acc["i"])).otherwise(acc["a"]).alias("a"),
                        F.when(ends, F.array_append(acc["z"], acc["i"])).otherwise(acc["z"]).alias("z"))

    def found(pieces):
        turns = F.transform(pieces, lambda p, i: F.struct(_turn(p, i).alias("turn"), p.alias("piece")))
        spans = F.aggregate(turns, F.struct(F.lit(0).alias("depth"), F.lit(1).alias("i"), empty.alias("a"), empty.alias("z")), step,
                            lambda acc: F.zip_with(acc["a"], acc["z"], lambda a, z: F.struct(a.alias("a"), F.coalesce(z, acc["i"]).alias("z"))))
        return F.transform(spans, lambda x: F.regexp_replace(F.array_join(F.slice(pieces, x["a"], x["z"] - x["a"]), "<"), "^[^>]*>", ""))

    return F.transform(F.array(_at_tags(markup, tag)), found)[0]


def listing_record(df: DataFrame, html_col: str = "html", keep: tuple = ("page_id",)) -> DataFrame:
    """The twelve-field record of a listing page, with ``_errors``.

    Scopes are balanced: an element ends at its own end tag, whatever elements
    of its name it holds, and rows and blocks are children, not descendants.
    Fixed values: the class names."""
    h = F.col(html_col)
    # Scopes are columns of their own, so that no expression holds another one twice.
    outer = df.select(*keep, h.alias("_h"), element(h, opened("div", "restaurant-details__components"), "div").alias("_details"))
    parts = outer.select(*keep, "_h", element(F.col("_details"), opened("div", "data-sheet"), "div").alias("_sheet"), element(
        F.col("_details"), opened("section", "section__text-componets", "section__text-separator"), "section").alias("_section"))
    h = F.col("_h")
    scopes = parts.select(*keep, children(F.col("_sheet"), opened("div", "row"), "div").alias("_rows"),  # X6a
                          element(element(F.col("_section"), opened("div", "collapse__block-title"), "div"), opened("div", "d-flex"), "div").alias("_phone"),
                          og_url(h).alias("website"), element(h, opened("div", "data-sheet__description"), "div").alias("_about"),
                          element(h, opened("div", "restaurant-details__services"), "div").alias("_services"),
                          element(h, opened("div", "list--card"), "div").alias("_cards"))
    nodes = scopes.withColumn("_title", first(F.get("_rows", F.lit(0)), f"(?s){opened('h1', 'data-sheet__title')}(.*?)</h1>")).withColumn(
        "_info", F.split(F.get("_rows", F.lit(1)), opened("div", "data-sheet__block"))).withColumn(
        "_blocks", F.flatten(F.transform(F.slice("_info", F.lit(2), F.size("_info")), lambda b: F.transform(
            children(balanced(b, "div"), opened("div", "data-sheet__block--text"), "div"), lambda x: node_text(x)))))
    text = {"restaurantName": node_text(F.col("_title"), strip=False)}
    text |= {**split_address(F.get("_blocks", F.lit(0))), **split_price_category(F.get("_blocks", F.lit(1)))}
    text |= {
        "description": F.replace(node_text(F.col("_about")), F.lit("\n"), F.lit("")),
        "facilitiesServices": F.transform(all_of(F.col("_services"), f"(?s)<li(?:{GAP}[^>]*)?>(.*?)</li>"), lambda x: node_text(x)),
        "creditCards": card_codes(F.col("_cards")),
        "phoneNumber": node_text(first(F.col("_phone"), f"(?s)<span(?:{GAP}[^>]*)?>(.*?)</span>")),
        "website": F.col("website")}
    out = nodes.select(*keep, *[c.alias(n) for n, c in text.items()])
    missing = [F.when(F.col(n).isNull(), F.lit(n)) for n in text]
    return out.withColumn("_errors", F.array_compact(F.array(*missing)))


def card_links(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The title link of every card of an index page that has one,
    host-prefixed, duplicates kept: (page_id, pos, link)."""
    cards = F.split(F.col(html_col), opened("div", "card__menu-content"))
    heading = f"(?s){opened('h3', 'card__menu-content--title')}(.*?)</h3>"
    # a card ends with its own end tag, a title with its heading's
    hrefs = F.filter(F.transform(F.slice(cards, 2, F.size(cards)), lambda c: decode_entities(F.regexp_extract(
        F.regexp_extract(balanced(c, "div"), heading, 1), f"<a{GAP}(?:[^>]*{GAP})?href{VALUE}", 1))), lambda x: x != "")
    # outer: an inner one computes the links twice, for a filter on their number
    return (df.select("page_id", host(F.col(url_col)).alias("_host"), F.posexplode_outer(hrefs).alias("pos", "href"))
            .where(F.col("href").isNotNull()).select("page_id", F.col("pos").cast("long").alias("pos"), F.concat("_host", "href").alias("link")))


JSONLD_SCHEMA = ("struct<name:string,address:struct<addressRegion:string>,"
                 "latitude:double,longitude:double>")


def jsonld(html: Column) -> Column:
    """First JSON-LD block parsed with an explicit schema (NULL if absent)."""
    raw = first(html, '(?s)<script[^>]*ld\\+json[^>]*>(.*?)</script>')
    return F.from_json(raw, JSONLD_SCHEMA)


def next_page(items: Column) -> Column:
    """``items`` is the list of pagination ``<li>`` bodies; true when
    the item after the first one holding ``a.active`` has an ``a[href]``."""
    flags = F.transform(items, lambda x: x.rlike(opened("a", "active")))
    idx = F.array_position(flags, F.lit(True))
    nxt = F.try_element_at(items, (idx + 1).cast("int"))
    return F.when(idx > 0, F.coalesce(nxt.rlike(f"<a{GAP}[^>]*href\\s*=\\s*[\"'][^\"']"), F.lit(False))).otherwise(F.lit(False))
