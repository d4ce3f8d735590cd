import random
import time
from itertools import accumulate

from pyspark.sql import functions as F

from listwright.functions import text, urls
from listwright.operators import document as d
from listwright.operators import links, reader
from listwright.plans import classifieds, portal, refline
from listwright.settings import PORTAL


def parsed(spark, html, **columns):
    df = spark.createDataFrame([(html,)], "html string")
    for name, value in columns.items():
        df = df.withColumn(name, F.lit(value))
    return d.with_document(df)


def test_unclosed_elements_end_with_their_parent(spark):
    html = "<div id=a><p>one<p>two</div><span>three</span></p><b>four"
    rows = d.nodes(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert {(r.tag, r.text) for r in rows} == {
        ("div", "onetwo"), ("p", "onetwo"), ("p", "two"), ("span", "three"), ("b", "four"),
    }


def test_silent_text_entities_and_attributes(spark):
    html = """<title>T &amp; U</title><script>var x="</p>";</script><style>p{}</style><template><i>no</i></template>
    <!-- c --><p data-x='a > b'>caf&eacute;&#33;<br/>next&nbsp;</p>"""
    row = parsed(spark, html).select(
        d.text_lines(F.col("pieces")).alias("lines"), d.find(F.col("elements"), "p").alias("p")
    ).first()
    assert row.lines == ["T & U", "café!", "next"]


def test_missing_page_gives_null_document(spark):
    row = spark.createDataFrame([(None,)], "html string").select(d.parse_html(F.col("html")).alias("doc")).first()
    assert row.doc is None


def test_documented_price_example(spark):
    for strict in (False, True):
        row = parsed(spark, '<span class="price">25,000 TND</span>').select(
            classifieds.price(F.col("pieces"), F.col("elements"), strict).alias("p")
        ).first().p
        assert (row.price_raw, row.price_numeric, row.currency) == ("25,000 TND", 25000.0, "TND")


def test_price_rules_differ_between_element_and_text(spark):
    html = '<div class="price">250.50 TND</div>'
    loose, strict = (
        parsed(spark, html).select(classifieds.price(F.col("pieces"), F.col("elements"), s).alias("p")).first().p
        for s in (False, True)
    )
    assert (loose.price_numeric, strict.price_numeric) == (25050.0, 250.5)


def test_portal_surface_keeps_its_quirk(spark):
    row = parsed(spark, "<p>120.5 m²</p>").select(d.text_lines(F.col("pieces")).alias("lines"))
    got = row.withColumn("labels", F.transform("lines", portal.portal_label)).select(
        portal.criteria(F.col("lines"), F.col("labels")).alias("c")
    ).first().c
    assert got["surface"] == "1205.0"


def test_section_stops_at_the_end_label(spark):
    df = spark.createDataFrame([(["x", "start", "a", "b", "end", "c"],), (["a"],), (["start", "z"],)], "l array<string>")
    got = [r.s for r in df.select(d.section(F.col("l"), F.col("l"), ("start",), ("end",)).alias("s")).collect()]
    assert got == [["a", "b"], [], ["z"]]


def test_paging_labels_must_be_the_only_content(spark):
    for html, expected in {
        "<a href='#'><b> Suivant </b></a>": True, "<a href='#'><i></i>next</a>": False, "<a href='/l:p:3'>x</a>": True,
        "<a href='/l:p:33'>x</a>": False,
    }.items():
        row = parsed(spark, html, page_no=2).select(
            links.portal_has_next(F.col("pieces"), F.col("elements"), F.col("page_no")).alias("n")
        ).first()
        assert row.n is expected, html


def test_one_bad_value_rejects_the_embedded_record(spark):
    good = '{"props":{"pageProps":{"adDetails":{"id":"1","price":5,"images":[],"location":{},"adParams":[]}}}}'
    bad = [good.replace("5", '"x"'), good.replace("[]", "null", 1), good.replace("{}", "null"), "{", good.replace('"id":"1","price":5,"images":[],"location":{},"adParams":[]', "")]
    df = spark.createDataFrame([(s,) for s in [good, *bad]], "s string")
    got = [r.r for r in df.select(classifieds.embedded_record(F.col("s")).alias("r")).collect()]
    assert got[0].price_raw == "5 DT" and got[0].location_raw == "None, None"
    assert got[1:] == [None] * len(bad)


def test_portal_location_without_parts(spark):
    df = spark.createDataFrame([("N/A",), ("Tunis",), ("Nord à Sfax",), ("A, B, C",)], "raw string")
    got = [tuple(r.p) for r in df.select(portal.split_place(F.col("raw")).alias("p")).collect()]
    assert got == [(None, None, None), ("Tunis", None, None), ("Sfax", "Sfax", "Nord"), ("C", "C", "A")]
    assert PORTAL.base_url


def test_ordinary_markup_is_read_without_the_parser_and_the_same():
    ordinary = [
        "", "text only &amp; more", "<p>", "</p>a<br/>b", "<p> </p><pre> </pre><div><b>x</b></div>",
        '<!DOCTYPE html><!-- c --><div CLASS=" a  b " id=\'q\' hidden>caf&eacute;&#1;<img src="/a?b=1&amp;c"></DIV>',
        '<script>var t="</p> 9";</script><style>p{}</style><template>no<i>t</i></template><title>T &amp; U</title>tail &',
        "<ul><li>a<li>b</ul></li><td><a-b x:y=\"1>2\">z</a-b>",
    ]
    odd = ["<a href=x>y</a>", "a < b", "<![CDATA[x]]>", "<script>a<!--b--></script>", "<textarea><b></textarea>", "<", "<p x=\"", "</ p>", "<?x?>"]

    def by_parser(html, kept):
        page = reader.PageReader(html, kept)
        return page.pieces, [tuple([row[0], list(row[1].items()), *row[2:]]) for row in page.rows]

    def by_columns(columns):
        pieces, tags, keys, values, sizes, *spans = columns
        pairs, at = list(zip(keys, values)), [0, *accumulate(sizes)]
        return pieces, [(tag, pairs[at[i]:at[i + 1]], *(span[i] for span in spans)) for i, tag in enumerate(tags)]

    for kept in (None, d.RULE_ATTRIBUTES):
        for html in ordinary:
            assert by_columns(reader.read_plain(html, kept)) == by_parser(html, kept), html
        for html in odd:
            assert reader.read_plain(html, kept) is None, html
            assert by_columns(reader.read_page(html, kept)) == by_parser(html, kept), html


def test_long_text_before_odd_markup_is_passed_once():
    start = time.perf_counter()
    assert reader.read_plain("x " * 500_000 + "< y" + " z" * 500_000, None) is None
    assert time.perf_counter() - start < 5


def test_lines_and_labels_of_the_reader_are_those_of_the_expressions(spark):
    pages = [
        "", "<p> Prix : 5 \x1f DT </p><p>a\r\nb c</p>", "<h1>Cité «Sud»</h1>\n<p>½ m² ™</p><p>!!</p><p>-  >\t x</p>",
        "<p>ﬁn</p><a href=x>odd</a><p>İstanbul ß</p>", "<p>¨ x ¨</p><p>🏠 Nord</p>",
    ]
    df = spark.createDataFrame([(i, html) for i, html in enumerate(pages)], "i int, html string")
    for keep in (text.PORTAL_KEEP, text.REFLINE_KEEP):
        rows = d.with_document(df, keep=keep).select(
            "lines", "labels", d.text_lines(F.col("pieces")).alias("want_lines"),
            text.normalise_lines(d.text_lines(F.col("pieces")), keep).alias("want_labels"),
        ).collect()
        for row in rows:
            assert row.lines == row.want_lines and row.labels == row.want_labels


def test_only_elements_that_rules_look_at_are_carried(spark):
    for html in ("<div class=\"c\"><ul><li><a href=\"/x\">a</a></li></ul></div><p id=\"q\">t</p>", "<div class=c><ul><li><a href=/x>a</a></li></ul></div><p id=q>t</p>"):
        df = spark.createDataFrame([(html,)], "html string")
        for tags, want in ((frozenset(("a",)), [("a", 0, 1)]), (frozenset(("a", "*")), [("div", 0, 2), ("a", 1, 2), ("p", 2, 3)])):
            row = d.with_document(df, attributes=frozenset(("class", "id")), tags=tags).first()
            assert [(e.tag, e.pos, e.end) for e in row.elements] == want
            assert [e.sole for e in row.elements if e.tag in "ap"] == list(range(len(want) // 2 + 1))[:sum(w[0] in "ap" for w in want)]


def test_heads_alone_are_the_elements_without_their_texts(spark):
    pages = [
        "", "a &amp; b", '<p><a href="/x">t</a><A HREF=\'/y?a&amp;b\' class=" c  d "/><br></p>', "<a href=/odd>z</a><b>", "<a href='>'>q</a> > <a id=1",
        '<script>"<a href=1>"</script><style><a></style><template><a href="/in"></template><a>', "<textarea><a></textarea>", None,
    ]
    kept, tags = frozenset(("href", "class")), frozenset(("a",))
    for html in pages[:-1]:
        plain = reader.read_plain(html, kept, tags)
        assert reader.read_heads(html, kept, tags) == (plain and plain[1:5]), html
    df = spark.createDataFrame([(i, html) for i, html in enumerate(pages)], "i int, html string")
    read = [d.with_document(df, attributes=kept, tags=tags, texts=texts).orderBy("i").collect() for texts in (True, False)]
    for whole, alone in zip(*read):
        assert alone.pieces == (None if alone.i == len(pages) - 1 else [])
        assert [e[:3] for e in alone.elements or ()] == [e[:3] for e in whole.elements or ()]
        assert all(e[3:] == (None,) * 4 for e in alone.elements or ())


ODD_LINES = [
    "Favori", "5 DT", "5$", "５ ＄ 5", "12 . , eur", "5 euro", "a partir de 1.200,5 usd", "TND 5", "5\tdt", "Prix à consulter !", "prix a consulter",
    "Nord à Sud", "Nord\u1680À\u2003Sud", "à Sud", "Cité Sud à", "Tunis", "Tunis, Nord", "Sfax , 12 m²", "Nord a\u0300 Sud", "x\u00a0a\u3000y",
    "12 m2", "3 pièces", "12.5 m", "7 ch", "2 salles de bains", "a", "Garage", "Vue sur mer", "Partager", "Voir la carte", "Contacter l'annonceur",
    "Caractéristiques générales", "État", "Neuf", "Étage du bien", "4", "Description", "Options", "Premium, x", "Il y a 3 jours", "il y a", "2 semaines",
    "Publiée le 05/01/24", "Déposée le : 5/1/2024", "İ", "!!", "- - -", "Titre", "5 DT, Nord", "Localisation", "* * *",
]


def odd_pages(spark, n=300):
    rng = random.Random(4)
    texts = [["Titre"] * rng.randrange(2) + [rng.choice(ODD_LINES) for _ in range(rng.randrange(30))] for _ in range(n)]
    rows = [(i, "<h1>Titre</h1>" * (i % 3 > 0) + "".join(f"<p>{line}</p>" for line in lines)) for i, lines in enumerate(texts)]
    return spark.createDataFrame([*rows, (-1, None)], "i long, html string").withColumn("day", F.lit("2024-06-01").cast("date"))


def test_portal_rules_look_at_picked_lines_only_and_find_the_same(spark):
    kept = d.with_document(odd_pages(spark), keep=text.PORTAL_KEEP, picks=portal.PICKS, joined=("label_text",))
    lines, labels, at = F.col("lines"), F.col("labels"), F.col("at")
    title, said = F.lit("Titre"), F.col("label_text")
    all_text = F.array_join(F.filter(labels, lambda t: t != ""), " ")
    pairs = {
        "price": (portal.price(lines, labels, at["priced"]), portal.price(lines, labels)),
        "place": (portal.place_line(lines, labels, title, None, at["placed"], at["stops"]), portal.place_line(lines, labels, title)),
        "text": (
            portal.description(lines, labels, title, 0, at["skipped"], at["options"], at["stops"]), portal.description(lines, labels, title)),
        "criteria": (portal.criteria(lines, labels, said, at["options"], at["details_end"]), portal.criteria(lines, labels)),
        "date": (portal.date_posted(said, F.col("day")), portal.date_posted(all_text, F.col("day"))),
        "label_text": (said, all_text),
    }
    rows = kept.select("i", F.size(at["priced"]).alias("n"), F.size("lines").alias("all"), *(
        c.alias(f"{name}_{way}") for name, ways in pairs.items() for way, c in zip(("picked", "whole"), ways))).collect()
    for row in rows:
        for name in pairs:
            assert row[f"{name}_picked"] == row[f"{name}_whole"], (name, row)
    assert 0 < sum(row.n for row in rows if row.i >= 0) < sum(row["all"] for row in rows if row.i >= 0) / 2


def test_refline_rules_look_at_picked_lines_only_and_find_the_same(spark):
    kept = d.with_document(odd_pages(spark), keep=text.REFLINE_KEEP, picks=refline.PICKS, joined=("page_text",))
    lines, labels, at, title = F.col("lines"), F.col("labels"), F.col("at"), F.lit("Titre")
    rows = kept.select(
        refline.location(lines, labels, title, at["placed"], at["sections"]).alias("picked"), refline.location(lines, labels, title).alias("whole"),
        "page_text", d.joined_text(F.col("pieces"), " ").alias("joined")).collect()
    assert all(row.picked == row.whole and row.page_text == row.joined for row in rows)
    assert len({row.picked.location_raw for row in rows}) > 3


def test_elements_that_are_not_carried_are_passed_over_and_the_others_the_same():
    pages = [
        "", "a &amp; <b>b</b>", "<div><a href='/x'>t</a></div>", "<div><a>t</div>u", "<a>t<b>u</b></a>", "<a><b>u</b></a><p>v", "<a><a>x</a></b>y</a>",
        "<li><a>x</li>y", "<a>x</b>y</a>", "<a> </a><a><!-- c -->t</a><a><img src='/i'></a>", "<a/>x<a>", "<pre> <a> </a></pre>", "<a><template>t</template></a>",
        "<script>'<a>'</script><a><style>x</style>y</a>", "<p class='x>y'>t</p><a>u</a>", "<A HREF=\"/x?a&amp;b\" class=\" c  d \">&lt;a&gt;</A>", "x < y", "<a",
    ]
    for tags in (frozenset(("a",)), frozenset(("a", "img", "*"))):
        for html in pages:
            sparse, plain = (read(html, d.RULE_ATTRIBUTES, tags) for read in (reader.read_sparse, reader.read_plain))
            assert sparse in (None, plain), html
        assert sum(reader.read_sparse(html, d.RULE_ATTRIBUTES, tags) is None for html in pages) <= 9


def test_wanted_fields_are_those_of_the_whole_record(spark):
    pages = odd_pages(spark, 40).selectExpr("i AS page_id", "concat('https://x.example/a/', i) AS url", "html", "CAST(day AS TIMESTAMP) AS fetched_at")
    groups = {
        refline: (["transaction_type"], ["image_urls", "image_count"], ["criteria", "surface"], ["location_raw", "city", "description"]),
        portal: (["price_raw", "currency"], ["title"], ["criteria", "floor", "date_posted"], ["location_raw", "description"]),
    }
    for plan, wanted in groups.items():
        whole = {row.seq: row for row in plan.extract(pages, validate=False).collect()}
        for fields in wanted:
            rows = plan.extract(pages, validate=False, fields=["seq", *fields])
            assert set(rows.columns) == {"seq", *fields}
            got = rows.collect()
            assert len(got) == len(whole) and all(row[f] == whole[row.seq][f] for row in got for f in fields), (plan.__name__, fields)
    # what makes no wanted field is not read
    kept = plan.extract(pages, validate=False, fields=["title"])._jdf.queryExecution().analyzed().toString()
    assert "labels:array" not in kept and "label_text:string" not in kept


def test_links_without_paging_are_the_same_and_need_no_texts(spark):
    pages = [
        '<a href="/annonce/bien-1#photos">lien</a><a href="/annonce/./x">y</a><a href="/fr/a/7/bien">z</a><a href="#">&gt;</a>',
        '<a href="/annonce/a?b=1#c&#10;d">x</a><a href="annonce/b">x</a><a href="//h/annonce/c">x</a><a href=\'>/annonce/d\'>x</a>',
        "<a href=/annonce/odd>x</a><template><a href='/annonce/e'>x</a></template>", "", None,
    ]
    df = spark.createDataFrame([(i, 1, html) for i, html in enumerate(pages)], "i int, page_no int, html string")
    for profile in ("refline", "portal", "classifieds"):
        whole, alone = (links.read_result_pages(df, profile, paging=paging).orderBy("i") for paging in (True, False))
        assert "has_next" not in alone.columns
        assert [row.links for row in whole.collect()] == [row.links for row in alone.collect()]
    assert "has_next" in whole.columns


def test_root_paths_are_resolved_at_once_as_other_links_are(one):
    # the slow way of the same link: its dot segment goes away
    for tail in ("", "?q=a/b", "#top", "?q=1#top", "/"):
        assert one(lambda c: urls.resolve_url(c, "https://h.example"), f"/x/y{tail}") == f"https://h.example/x/y{tail}"
        assert one(lambda c: urls.resolve_url(c, "https://h.example"), f"/x/./y{tail}") == f"https://h.example/x/y{tail}"


def test_pages_with_most_elements_carried_are_read_once(monkeypatch):
    calls = []
    monkeypatch.setattr(reader, "read_sparse", lambda *args: calls.append(args))
    for tags, times in ((frozenset(("a", "*")), 0), (None, 0), (frozenset(("a",)), 1)):
        calls.clear()
        assert reader.read_page("<p class='x'>t</p>", d.RULE_ATTRIBUTES, tags)[0] == ["t"]
        assert len(calls) == times
