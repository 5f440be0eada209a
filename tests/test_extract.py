from pyspark.sql import functions as F

from tessera.operators import extract as ex
from tessera.operators import relational as rel

PAGE = """<html lang="it"><head><title>Al Mare &amp; Co</title>
<meta property="og:url" content="https://h/x/al-mare">
<script type="application/ld+json">{"name": "Al Mare", "address": {"addressRegion": "Tuscany"},
"latitude": 43.5, "longitude": 10.3}</script></head><body>
<article><h1> Al Mare </h1><p> First &lt;one&gt; </p><p>Second<br><p>Third</p></article>
<div class="list--card"><img data-src="/img/visa-1a2b.svg"><img data-src="/img/amex-9.svg"></div>
<nav><ul><li><a href="/a">a</a></li><li><a class="active" href="/b">b</a></li><li><a href="/c">c</a></li></ul></nav>
</body></html>"""


def test_page_fields(spark):
    df = spark.createDataFrame([(1, "https://h/x/al-mare", PAGE)], "page_id long, url string, html string")
    r = ex.extract(df, ex.PAGE_FIELDS).first()
    assert (r.lang, r.title, r.h1, r._errors) == ("it", "Al Mare & Co", "Al Mare", [])
    assert r.nav_links == ["/a", "/c"]  # the active anchor has its class first
    p = df.select(ex.paragraphs(F.col("html")).alias("p")).first().p
    assert p == ["First <one>", "Second", "Third"]
    r2 = df.select(ex.og_url(F.col("html")).alias("u"), ex.jsonld(F.col("html")).alias("j"),
                   ex.card_codes(F.col("html")).alias("c"), ex.url_key(F.col("url")).alias("k")).first()
    assert r2.u == "https://h/x/al-mare"
    assert (r2.j.name, r2.j.address.addressRegion, r2.j.latitude) == ("Al Mare", "Tuscany", 43.5)
    assert r2.c == ["visa", "amex"]
    assert r2.k == "al-mare"


def test_missing_nodes_are_null_not_errors(spark):
    df = spark.createDataFrame([(2, "https://h/x/", "<html><body></body></html>")],
                               "page_id long, url string, html string")
    r = ex.extract(df, ex.PAGE_FIELDS).first()
    assert r.title is None and set(r._errors) == {"lang", "title", "h1"}
    r2 = df.select(ex.jsonld(F.col("html")).alias("j"), ex.url_key(F.col("url")).alias("k")).first()
    assert r2.j is None and r2.k == "unknown"


def test_address_and_price_split(spark):
    df = spark.createDataFrame([("via X, 1, Gargnano, 25084, Italy", "€€€ · Creative"),
                                ("a, b", "€€")], "a string, p string")
    parts = ex.split_address(F.col("a"))
    price = ex.split_price_category(F.col("p"))
    rows = df.select(*[v.alias(k) for k, v in {**parts, **price}.items()]).collect()
    assert (rows[0].address, rows[0].city, rows[0].postalCode, rows[0].country) == \
        ("via X  1", " Gargnano", " 25084", " Italy")
    assert (rows[0].priceRange, rows[0].cuisineType) == ("€€€", "Creative")
    assert rows[1].city is None and rows[1].priceRange is None


def test_links_and_next_page(spark):
    df = spark.createDataFrame([(1, "https://h.example/list/1", PAGE)], "page_id long, url string, html string")
    links = [r.link for r in ex.links(df).orderBy("pos").collect()]
    assert links == ["https://h.example/a", "https://h.example/c"]
    items = ex.all_of(F.col("html"), "<li>(.*?)</li>")
    assert df.select(ex.next_page(items).alias("n")).first().n is True


def test_relational_helpers(spark):
    df = spark.createDataFrame([("Tuscany", "€€", "['Bar', \"Chef's table\"]")], "r string, p string, l string")
    r = df.select(rel.translate_region(F.col("r")).alias("t"),
                  F.col("p").between("€", "€€€").alias("b"),
                  rel.parse_list_literal(F.col("l")).alias("l")).first()
    assert (r.t, r.b, r.l) == ("Toscana", True, ["Bar", "Chef's table"])


def test_entities_attributes_and_class_tokens(spark):
    page = ("<head><META content='https://h/x?a=1&amp;b=2&#x3D;' data-x=\"1\" property='og:url'></head>"
            "<li><a class=\"inactive\" href=\"/1\">1</a></li><li><a class='x active'>2</a></li><li><a href='/3'>3</a></li>")
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(ex.og_url(F.col("html")).alias("u")).first().u == "https://h/x?a=1&b=2="
    t = spark.createDataFrame([("&eacute;&#8217;&#x1F600; &amp;lt; &nope; & &#0; &lt;b&gt; AT&T; &nbsp;",)], "t string")
    assert t.select(ex.node_text(F.col("t"), strip=False).alias("t")).first().t == "é’😀 &lt; &nope; & \ufffd <b> AT&T; \u00a0"
    items = ex.all_of(F.col("html"), "<li>(.*?)</li>")
    assert df.select(ex.next_page(items).alias("n")).first().n is True


def test_listing_record_of_a_bare_page(spark):
    df = spark.createDataFrame([(1, "<html></html>"), (2, None)], "page_id long, html string")
    for r in ex.listing_record(df).collect():
        assert r.restaurantName is None and r.website is None and "phoneNumber" in r._errors


NESTED = """<html><head><meta property="og:url" content="https://h.org/r/1"></head><body>
<div class="restaurant-details__components wide"><div class="x data-sheet"><div class="intro"><div class="row">not a row of the sheet</div></div>
<div class="row first"><div class="row"><div>inner</div></div><h1 class="data-sheet__title">Da <b>Rosa</b></h1></div>
<div class='row'><div class="data-sheet__block"><div class="data-sheet__block--text">Via <div>Roma</div> 1, Bari, 70100, Italy</div>
<div class="other"><div class="data-sheet__block--text">not a child</div></div>
<div class="data-sheet__block--text">€€ · Apulian</div></div></div></div>
<div class="data-sheet__description">One <div>two <div>2b</div></div> three</div>
<section class="section__text-separator section section__text-componets"><section>inner</section><div class="collapse__block-title"><div></div><div class="d-flex">
<div>call</div><span>+39 1</span></div></div></section></div>
<div class="restaurant-details__services"><div>more</div><ul><li>Bar</li></ul><ul><li>Garden</li></ul></div>
<div class="list--card"><div><img data-src="/i/visa-1.png"></div><img data-src="/i/amex-2.png"></div><img data-src="/i/none-3.png"></body></html>"""


def test_listing_record_of_nested_markup(spark):
    df = spark.createDataFrame([(1, NESTED)], "page_id long, html string")
    r = ex.listing_record(df).first()
    assert (r.restaurantName, r.address, r.city, r.postalCode, r.country) == ("Da Rosa", "Via Roma 1", " Bari", " 70100", " Italy")
    assert (r.priceRange, r.cuisineType, r.phoneNumber, r.website) == ("€€", "Apulian", "+39 1", "https://h.org/r/1")
    assert (r.description, r.facilitiesServices, r.creditCards) == ("One two 2b three", ["Bar", "Garden"], ["visa", "amex"])
    assert r._errors == []


def test_card_links_stay_in_their_title(spark):
    page = ("<div class='card__menu-content'><div>a</div><h3 class=\"card__menu-content--title\">None</h3><a href='/not/title'>x</a></div>"
            "<div class='b card__menu-content'><div><h3 class='card__menu-content--title'><a class='k' href='/r/2?a=1&amp;b=2'>Two</a></h3></div></div>"
            "<div class='card__menu-content'><p>no heading</p></div><h3 class='card__menu-content--title'><a href='/outside'>o</a></h3>"
            "<ul><li><a href='/page/2'>2</a></li></ul>")
    df = spark.createDataFrame([(1, "https://h.org/list", page), (2, None, None), (3, "https://h.org", "")], "page_id long, url string, html string")
    assert [tuple(r) for r in ex.card_links(df).collect()] == [(1, 0, "https://h.org/r/2?a=1&b=2")]


def test_balanced_elements(spark):
    df = spark.createDataFrame([("<div id=1><div class='k'>a<DIV>b</DIV>c<divider>d</div>e</div>",), ("<p>x",), ("<div class='k'>open<div>in</div>",), (None,)], "h string")
    got = [r.e for r in df.select(ex.element(F.col("h"), ex.opened("div", "k"), "div").alias("e")).collect()]
    assert got == ["a<DIV>b</DIV>c<divider>d", None, "open<div>in</div>", None]
    kids = df.select(ex.children(F.col("h"), "<div[^>]*>", "div").alias("c")).collect()
    assert kids[0].c == ["<div class='k'>a<DIV>b</DIV>c<divider>d</div>e"] and kids[1].c == [] and kids[2].c == ["open<div>in</div>"]


def test_listing_pages_are_dealt_over_all_tasks(spark, monkeypatch):
    from tessera.plans import catalog_extract
    listing = spark.range(0, 50, 1, 1).distinct().selectExpr(  # distinct: shuffled rows, which Spark would put into one task
        "id AS restaurantId", "'n' AS restaurantName", "'c' AS city", "'a' AS address", "'r' AS region", "'€' AS priceRange", "'t' AS cuisineType",
        "array('f') AS facilitiesServices", "array('Visa') AS creditCards", "'https://h/' AS website")
    monkeypatch.setattr(rel, "listing_parts", lambda spark, d: listing)
    out = catalog_extract.extract_listing(spark, "")
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = {r.restaurantId: r for r in out.collect()}
    assert len(rows) == 50 and rows[1].restaurantName == "n & café ’x'" and rows[1].creditCards == "visa" and rows[35].n_errors == 2


def test_references_and_depths_are_computed_once(spark):
    def holds(c, what):
        return spark.range(1).select(F.lit(None).cast("string").alias("x")).select(c.alias("y"))._jdf.queryExecution().analyzed().toString().count(what)

    assert holds(ex.decode_entities(F.col("x")), "regexp_extract(") == 1
    assert holds(ex.children(F.col("x"), ex.opened("div", "row"), "div"), "RLIKE") + holds(ex.children(F.col("x"), ex.opened("div", "row"), "div"), "rlike") <= 1


def test_scopes_at_the_edges_of_the_markup(spark):
    start = ex.opened("div", "row")
    rows = spark.createDataFrame([
        ("<div class='row'>a<DIV >b</div >c</div>d", "a<DIV >b</div >c", ["a<DIV >b</div >c"]),  # a tag comes first
        ("<div class='row'></div>", "", [""]), ("x<div class='row'>never </b>", "never </b>", ["never </b>"]),
        ("</div><div class='row'>y</div><div class='row'>z", "y", ["y", "z"]), ("<divx class='row'>n</divx>", None, []), ("", None, []), (None, None, None)],
        "m string, e string, c array<string>")
    for r in rows.select("*", ex.element(F.col("m"), start, "div").alias("element"), ex.children(F.col("m"), start, "div").alias("children")).collect():
        assert (r.element, r.children) == (r.e, r.c), r.m
    texts = spark.createDataFrame([("&amp;lt; &#x1F600;&#65 &nope; & a&euro;", "&lt; \U0001f600&#65 &nope; & a€"), ("&#0;&#xD800;&", "\ufffd\ufffd&"), ("plain", "plain"), ("", ""), (None, None)], "x string, y string")
    assert all(r.d == r.y for r in texts.select("y", ex.decode_entities(F.col("x")).alias("d")).collect())
