"""Pages: broken and odd ones, long nesting, and the shapes of tables."""

import datetime as dt
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import pages
from tidemark.plans import registry


@pytest.mark.parametrize(
    ("html", "title", "content"),
    [
        ("<h1>a</h1><![foo[ bar ]]><p>b", "a", ""),
        ('<script type="application/ld+json">{"@type":"Article","headline":{"name":"T"},"datePublished":20240102}</script>', "T", ""),
        ('<script type="application/ld+json">{"@type":"Article","headline":["T", "U"]}</script>', "T", ""),
        ('<script type="application/ld+json">' + "[" * 100_000 + "</script><h1>x", "x", ""),
        ('<meta property="og:title" content="T">', None, ""),
        ('<meta property="og:title" content="T"><h1></h1>', "T", ""),
        (None, None, ""),
        ("<h1>a<div class='x'>" + "long text " * 30, "along text " + ("long text " * 29).strip(), ("long text " * 30).strip()),
    ],
)
def test_odd_pages(html, title, content):
    got = pages.article(html)
    assert got[0] == title and got[4] == content
    assert got[1] in (None, "20240102")


def test_deep_nesting_is_linear():
    html = "<h1>t</h1>" + "<div>word " * 20_000 + "</section>" * 20_000
    began = time.time()
    assert len(pages.article(html)[4]) == 20_000 * 5 - 1 and pages.pairs(html) == {} and pages.year_matrix(html) == {}
    assert time.time() - began < 10


def test_parts_cut_from_an_article_stay_out():
    long = "word " * 50
    html = f"<h1>t</h1><div><article>ab<aside>{long}</aside></article><div>{long}</div></div>"
    assert pages.article(html)[4] == "ab\n" + long.strip()


def test_labels_by_rank():
    html = "<p><b>A :</b> one <p><b>A</b> two<table><tr><td>A:<td>three<tr><td>B<td>x<tr><td>B<td>y</table><dl><dt>B<dt>C<dd>z</dl><p>no <i>bold</i><p><b>D</b><tr><td>alone"
    assert pages.pairs(html) == {"A": "three", "B": "z", "C": "z", "D": "alone"}


def test_spans():
    (grid,) = pages.grids(pages.Page("<table><tr><td rowspan=2>a<td colspan=2>b<tr><td>c<td>d<tr><td rowspan=0>e</table>"))
    assert [[c.text for c in r] for r in grid] == [["a", "b", "b"], ["a", "c", "d"], ["e"]]
    outer, inner = pages.grids(pages.Page("<table><tr><td>x<table><tr><td>y</table><td>z</table>"))
    assert [c.text for c in outer[0]] == ["x y", "z"] and inner[0][0].text == "y"


DIVIDENDS = {
    1: "<table id=a><tr><th>Date détachement<th>Nom<th>Montant<th>Rendement<tr><td>22/4/2026<td><a href='/marches/cotation_ABC.ci'>Abc&nbsp;SA</a><td>1 250,5<td>7,25%<tr><td>à préciser<td>Plain<td>-<td></table>",
    2: "<table><tr><th>Nom<th>Div. 2023<th>Rend. 2023<th>Div. 2022<tr><td><a href='cotation_DEF.sn'>Def</a><td>100<td>5,5 %<td>90<tr><td>Short<td>7</table>",
    3: "<table><tr><td>menu</table><table><tr><th>Emetteur<th>Obligation<th>Action<th>Exercice<th>Date paiement<th>Date ex-dividende<th>Montant net<th>Avis<tr><td rowspan=2>Ghi<td>non<td>oui<td>2024<td>15 juin 2025<td>12 juin 2025<td>1 000<td><a href='/x.pdf'>Télécharger</a><tr><td>non<td>oui<td>2023<td>1 août 2024<td><td>900<td></table>",
    4: "<table><tr><th>Nom<th>Prix<tr><td>x<td>1</table>",
    5: None,
}


def test_dividend_tables(spark):
    own = pages.dividends(spark.createDataFrame(list(DIVIDENDS.items()), "id long, html string"))
    rows = sorted((tuple(r) for r in own.collect()), key=str)
    d = dt.date
    assert rows == sorted(
        [
            (1, "upcoming", "ABC.ci", "Abc SA", None, d(2026, 4, 22), None, 1250.5, 7.25, None, None, None),
            (1, "upcoming", None, "Plain", None, None, None, None, None, None, None, None),
            (2, "history", "DEF.sn", "Def", "2022", None, None, 90.0, None, None, None, None),
            (2, "history", "DEF.sn", "Def", "2023", None, None, 100.0, 5.5, None, None, None),
            (2, "history", None, "Short", "2022", None, None, None, None, None, None, None),
            (2, "history", None, "Short", "2023", None, None, 7.0, None, None, None, None),
            (3, "official", None, "Ghi", "2024", d(2025, 6, 12), d(2025, 6, 15), 1000.0, None, "non", "oui", "/x.pdf"),
            (3, "official", None, "Ghi", "2023", None, d(2024, 8, 1), 900.0, None, "non", "oui", None),
        ],
        key=str,
    )
    said = own.where("kind = 'upcoming'").select(pages.status(F.col("ex_date"), F.to_date(F.lit("2026-04-23")))).collect()
    assert sorted(r[0] for r in said) == ["A préciser", "Passé"]


def test_profiles(spark):
    rows = [
        (1, "<title>Abc dans le secteur Services publics à la Bourse</title><div class=quotebarE><h1>ABC SA : analyses et conseils</h1></div><table><tr><td><b>Le conseil du jour</b><tr><td><img src='/i.png' alt='Conseil'>Acheter <i>vite</i><p class='f11'>Sans garantie</p></table>"),
        (2, "<title>Indice, données historiques</title><meta name=description content='Cette valeur appartient au secteur Finance, depuis'><p>ABCD00000001 - IDX"),
        (3, ""),
    ]
    got = {r.id: tuple(r)[1:] for r in pages.profiles(spark.createDataFrame(rows, "id long, html string")).collect()}
    assert got[1] == ("Services publics", "ABC SA", None, "Acheter vite Sans garantie", "/i.png", "Sans garantie")
    assert got[2] == ("Finance", "Indice", "ABCD00000001", None, None, None) and got[3] == (None,) * 6


def test_labelled(spark):
    html = "<dl><dt>Nombre de titres<dd>1 200 000</dl><p>ISIN : CI0000000012 Flottant: 28,97 %<p>Nombre d'actions : 5"
    rows = spark.createDataFrame([(1, html), (2, None), (None, "<dl><dt>x<dd>y")], "id long, html string")
    got = {r.id: r for r in pages.named(pages.labelled(rows), {"titres": ["none", "Nombre de titres"]}).collect()}
    assert (got[1].isin, got[1].shares, got[1].free_float, got[1].titres) == ("CI0000000012", "1 200 000", "28,97 %", "1 200 000")
    assert got[2].fields == {} and got[2].isin is None and got[None].fields == {"x": "y"}


HEADS = [
    "<h1>cut &amp;&amp</h1>", "<h1>token = &quot;ab&quot; &lt;b&gt; &#65;&nbsp;</h1>", "<h1>&amp;amp; &AMP;</h1>", "<H1\nclass='a'\n>\n\tA\n b\n</H1>", "<h1>a <i>b</i></h1>", "<h1><i>b</i></h1>", "<h1></h1><h1>second</h1>",
    "<h1", "<h1 <h1>x", "a>b<h1", "<h10>x", "<!-- <h1>c --><h1>d", "<script>'<h1>s'</script><h1>t", "<title>only</title>", "< h1>x", "", None, "<h1>open", "<h1>\u00a0\u2003 a\u00a0b \u3000</h1>", "<h1>\x0b a\x0b</h1>", "<h1>a\u2028b\u0085</h1>",
    "\U0001f600İ<h1>\U0001f600é</h1>", '<script type="application/ld+json">{"@type":"Article","headline":"T"}</script><h1>h</h1>', '<meta property="og:title" content="T"><h1></h1>',
]


def test_titles_of_odd_pages_as_sql_has_them(spark, tmp_path):
    rows = [*enumerate(HEADS), (None, "<h1>no id</h1>"), (0, HEADS[0])]
    spark.createDataFrame([(k, "http://a.b/", h) for k, h in rows], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = duckdb.connect().execute(registry.ORACLE["page_titles"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).fetchall()
    got = [tuple(r) for r in registry.QUERIES["page_titles"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    titles = dict(got)
    assert (titles[0], titles[1][:20], titles[7], titles[18]) == ("cut &&amp", "token = &quot;ab&quo", "", "a\u00a0b") and 13 not in titles and 16 not in titles


def test_titles_of_long_pages(spark):
    rows = [(1, "<h1" * 500_000), (2, "x" * 3_000_000 + "<h1" + " a" * 500_000 + ">" + " " * 500_000 + "y" + " " * 500_000 + "z"), (3, "<h1>" + "é" * 1_000_000)]
    own = pages.headings(spark.createDataFrame(rows, "id long, html string"))
    began = time.time()
    assert dict(map(tuple, own.collect())) == {1: "", 2: "y" + " " * 500_000 + "z", 3: "é" * 1_000_000}
    assert time.time() - began < 30
