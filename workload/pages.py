"""Detail and result pages written from the facts, one per order and profile.

Which elements a page has depends on remainders of the order key, so that every
step of every rule cascade is reached; the oracles compute the expected fields
from the same facts without reading HTML.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.base import dealt, facts, table

SITE_1 = "https://www.classifieds.example"
SITE_2 = "https://www.refline.example"
SITE_3 = "https://www.portal.example"

# portable URL expressions, shared with the oracles
URL_1 = f"""CASE x4
 WHEN 0 THEN concat('{SITE_1}/ad/', CAST(k AS STRING), '/x')
 WHEN 1 THEN concat('{SITE_1}/item/commercial/', lpad(CAST(k AS STRING), 24, '0'), '/')
 WHEN 2 THEN concat('{SITE_1}/item/commercial/', CAST(k AS STRING))
 ELSE concat('{SITE_1}/listing/', CAST(k AS STRING), '-x') END"""
URL_2 = f"""CASE WHEN x4 = 3 THEN concat('{SITE_2}/annonce/bien/', CAST(k AS STRING), '/fiche')
 ELSE concat('{SITE_2}/annonce/', CASE WHEN x5 = 2 THEN 'terrain' ELSE 'bien' END, '-', CAST(k AS STRING)) END"""
URL_3 = f"""CASE WHEN x7 = 1 THEN concat('{SITE_3}/fr/x/', CAST(k AS STRING))
 WHEN x4 = 3 THEN concat('{SITE_3}/fr/pa/', CAST(k AS STRING), '/bien')
 ELSE concat('{SITE_3}/fr/a/', CAST(k AS STRING), '/bien') END"""

EMBEDDED_JSON = """concat('{"props":{"pageProps":{"adDetails":{"id":"E', k, '","title":"', t,
 '","description":"Fiche ', k, '",',
 CASE x35 WHEN 0 THEN '"price":"sur demande",' WHEN 10 THEN '' WHEN 20 THEN '"price":null,'
          ELSE concat('"price":', amount, ',') END,
 '"category":"Appartements","publishedOn":"', d, 'T00:00:00Z","images":["/e/', k, '.jpg","https://cdn.example/e', k,
 '.jpg"],"location":{', CASE WHEN x35 = 15 THEN '' ELSE concat('"delegation":"', n, '",') END, '"governorate":"', r,
 '"},"adParams":[{"label":"Superficie","value":', CASE WHEN x35 = 5 THEN CAST(m2 AS STRING) ELSE concat('"', m2, ' m2"') END,
 '},{"label":"Chambres","value":"', beds_n, '"},{"label":"Vue","value":"mer"}]}}}}')"""

# on every 64th page 600 lines stand before what a rule looks for, and pictures are many
LONG = "k % 64 = 7"
FILLER = f"CASE WHEN {LONG} THEN repeat('<p>Annonce du jour</p>', 600) ELSE '' END"


def _many(path: str, rest: str = "") -> str:
    """Fourteen more pictures of a long page."""
    return f"""CASE WHEN {LONG} THEN array_join(transform(sequence(1, 14), i -> concat('<img src="/{path}/', k, '/g', i, '.jpg"{rest}>')), '') ELSE '' END"""


PAGE_1 = f"""concat('<!DOCTYPE html><html><head><meta charset="utf-8">',
 CASE WHEN x7 = 1 AND x21 <> 8 THEN concat('<meta property="og:title" content=" ', th, ' ">') ELSE '' END,
 CASE WHEN x7 = 4 THEN concat('<meta property="og:description" content="Courte ', k, '">') ELSE '' END,
 '<title>', th, ' - Classifieds du jour</title><style>p{{margin:0}}</style>',
 CASE WHEN x5 = 0 THEN concat('<script id="__NEXT_DATA__" type="application/json">', {EMBEDDED_JSON}, '</script>') ELSE '' END,
 '</head><body><!-- haut --><img src="/logo.png">',
 CASE WHEN x7 <> 3 THEN concat('<nav class="top breadcrumb"><a href="/">Accueil</a><a href="/x"> ',
   CASE x5 WHEN 0 THEN 'Appartement' WHEN 1 THEN 'Villa' WHEN 2 THEN 'Terrain' WHEN 3 THEN 'Bureau' ELSE 'Ferme' END,
   '</a></nav>') WHEN x4 = 0 THEN '<div data-category="Maison"></div>' ELSE '' END,
 CASE WHEN k % 8 = 3 THEN concat('<div data-ad-id="ad-', k, '"></div>') ELSE '' END,
 CASE WHEN x7 <> 1 THEN concat('<h1> ', th, '</h1>') ELSE '' END,
 CASE WHEN x49 = 2 THEN '<div>gratuit</div>' WHEN x7 = 2 THEN concat('<div>Loyer ', amount, '.50 dt</div>')
   WHEN x4 = 0 THEN concat('<span itemprop="price">', spaced, ' TND</span>')
   WHEN x4 = 1 THEN concat('<strong class="item-prix">', amount, ',000 EUR</strong>')
   WHEN x4 = 2 THEN concat('<p data-testid="ad-price">', amount, '.50 &euro;</p>')
   ELSE concat('<div class="price">', amount, '</div>') END,
 CASE WHEN x7 = 5 THEN ''
   WHEN x4 = 0 THEN concat('<span class="ad-location">', r, ', ', n, ', Quartier ', k, '</span>')
   WHEN x4 = 1 THEN concat('<address itemprop="address">', r, ',', n, '</address>')
   WHEN x4 = 2 THEN concat('<p data-testid="location-line">', n, '</p>')
   ELSE concat('<div class="localisation"><b>', r, '</b>, ', n, '</div>') END,
 CASE WHEN x7 IN (4, 6) THEN ''
   WHEN x3 = 0 THEN concat('<div class="ad-description"><p>Premier ', k, '</p><p> </p><p>Second &amp; dernier</p></div>')
   WHEN x3 = 1 THEN concat('<section itemprop="description"> Texte simple ', k, ' </section>')
   ELSE concat('<article class="content"><p>Seul <b>gras</b> ', k, '</p><img src="/i/', k, '/in.jpg"></article>') END,
 CASE x4 WHEN 0 THEN concat('<time datetime="', d, 'T10:00:00Z">hier</time>')
   WHEN 1 THEN concat('<time>', substring(d,9,2), '/', substring(d,6,2), '/', substring(d,1,4), '</time>')
   WHEN 2 THEN concat('<span class="posted-on">', substring(d,9,2), '-', substring(d,6,2), '-', substring(d,1,4), '</span>')
   ELSE '<span class="date">il y a 3 jours</span>' END,
 '<dl><dt>Superficie</dt><dd>', m2, ' m&sup2;</dd><dt>Chambres</dt><dd>', beds_n, '</dd><dt>Meubl&eacute;</dt><dd>Oui</dd></dl>',
 '<table class="table details"><tr><th>Pieces</th><td>', rooms_n, '.5 p</td></tr><tr><td>seul</td></tr>',
 '<tr><td>Etage</td><td>RDC</td></tr></table>',
 '<div class="features"><span class="label">Garage</span><span class="value">Non disponible</span>',
 '<span class="label">Chambres</span><span class="value">', beds_n + 1, ' ch</span><span class="label">vide</span></div>',
 CASE WHEN x7 = 6 THEN concat('<p><img src="/i/', k, '/solo.jpg">') WHEN x7 = 0 AND x3 = 2 THEN ''
   ELSE concat('<div class="photo-gallery"><img data-src="/i/', k, '/1.jpg" src="/s.gif"><img src="/i/', k,
     '/2.jpg" width="50"><img src="https://cdn.example/', k, '.jpg" width="640"><img src="/i/', k,
     '/1.jpg"><img width="auto" src="i/3.jpg">', {_many('i')}, '</div>') END,
 '</body></html>')"""

PAGE_2 = f"""concat('<!DOCTYPE html><html><head><title>', th, CASE WHEN x7 = 3 THEN '' ELSE ' - Refline' END,
 '</title><script>var t="</p> 9 DT";</script></head><body><ul><li><a href="/">Accueil</a></li>',
 CASE x5 WHEN 0 THEN '<li><a href="/c">Appartement</a></li>' WHEN 1 THEN '<li><a href="/c">Villa</a></li><li><a href="/l"> Location </a></li>'
   WHEN 4 THEN '<li><a href="/c">bureau</a></li>' ELSE '' END,
 {FILLER}, CASE x3 WHEN 0 THEN '<li>A louer</li>' WHEN 1 THEN '<li>Vente</li>' ELSE '<li>Divers</li>' END,
 '</ul><img src="/img/logo.png"><h1>', th, '</h1><p>Premium, annonce 500 EUR</p>', {FILLER},
 CASE x4 WHEN 0 THEN concat('<p>Quartier ', k, ', ', n, ', ', r, '</p>') WHEN 1 THEN concat('<p>', n, ', ', r, '</p>')
   WHEN 2 THEN concat('<p>Ville ', n, ' centre,</p>') ELSE '' END,
 CASE WHEN x7 = 2 THEN '<div>Prix sur demande</div>' WHEN x2 = 0 THEN concat('<div>', spaced, ' DT / Mois</div>')
   ELSE concat('<div>', spaced, ' Tnd</div>') END,
 '<div>Description</div><p>Premier paragraphe ', k, '<p>Second <b>paragraphe</b></p><div>D&eacute;tails de bien</div>',
 '<ul><li>Chambres : ', beds_n, '</li><li>Salles de bain : 10+</li><li>Pi&egrave;ces (Totale) : ', rooms_n,
 '</li><li>Surf habitable : ', m2, ',5 m2</li><li>Surf terrain : ', CASE WHEN x3 = 1 THEN '300' ELSE '1.200.5' END, ' m&sup2;</li></ul>',
 CASE x3 WHEN 0 THEN '<h3>Options</h3><span>Garage</span><span>Piscine</span><span>Meubl&eacute;</span>'
   WHEN 1 THEN '<h3>Options</h3><span>Vue d&eacute;gag&eacute;e</span>' ELSE '' END,
 '<h3>Localisation</h3><p>Carte</p><footer>', CASE WHEN x7 = 1 THEN '' ELSE concat('R&eacute;f Rèf : AB-', k, ' ') END,
 'D&eacute;pos&eacute;e le : ', substring(d,9,2), '/', substring(d,6,2), '/',
 CASE WHEN x2 = 0 THEN substring(d,3,2) ELSE substring(d,1,4) END, '</footer>',
 '<img data-original="/p/', k, '.jpg" src="/blank.gif" alt="', th, ' photo 1"><img src="/other.jpg" alt="Autre bien">',
 '<img src="/q/', k, '.jpg" width="90"><img src="//cdn.example/', k, '.jpg" width="90%">', {_many('q')}, '</body></html>')"""

PAGE_3 = f"""concat('<!DOCTYPE html><html><head>',
 CASE WHEN x7 = 3 THEN concat('<meta property="og:title" content="', th, '">') ELSE '' END,
 '<title>', th, ' | Portal</title></head><body><div>Favori</div><div>Partager</div>', {FILLER},
 CASE WHEN x7 = 3 THEN '<h1> </h1>' ELSE concat('<h1>', th, '</h1>') END, {FILLER},
 CASE x4 WHEN 0 THEN concat('<h3>Quartier Nord &agrave; ', n, '</h3>') WHEN 1 THEN concat('<h3>Cité Sud &agrave;</h3><h3>', n, '</h3>')
   WHEN 2 THEN concat('<h3>Cité Est, ', n, '</h3>') ELSE '' END,
 CASE WHEN x7 = 2 THEN '<p>Prix &agrave; consulter</p>' WHEN x3 = 0 THEN concat('<p>A partir de ', spaced, ' TND</p>')
   WHEN x3 = 1 THEN concat('<p>', spaced, ' dt</p>') ELSE concat('<p>', spaced, ' euro</p>') END,
 '<ul><li>', m2, ' m&sup2;</li><li>', rooms_n, ' pi&egrave;ces</li><li>', beds_n, ' chambres</li><li>2 salles de bains</li></ul>',
 '<p>Bel appartement lumineux avec une vue d&eacute;gag&eacute;e, proche des commerces et des &eacute;coles du quartier ', k, '</p>',
 '<p>Texte court</p><div>Caract&eacute;ristiques g&eacute;n&eacute;rales</div>',
 '<p>Type de bien</p><p>Appartement</p><p>&Eacute;tat</p><p>Neuf</p><p>&Eacute;tage du bien</p><p>', k % 12, '</p><p>&Eacute;tat</p><p>Ancien</p>',
 '<div>Voir la carte</div>', {FILLER},
 CASE x3 WHEN 0 THEN '<span>Garage</span><span>Vue sur mer</span>' WHEN 1 THEN '<span>Meubl&eacute;</span>' ELSE '' END,
 '<p>', CASE x5 WHEN 0 THEN concat('Publi&eacute;e le ', substring(d,9,2), '/', substring(d,6,2), '/', substring(d,3,2))
   WHEN 1 THEN concat('Il y a ', k % 20 + 1, ' jours') WHEN 2 THEN 'Il y a 2 semaines' WHEN 3 THEN 'Il y a 1 mois'
   ELSE 'Il y a 5 heures' END, '</p>',
 '<img data-lazy="/p/', k, '.jpg" alt="', th, '"><img src="/z.jpg" alt="Autre"><img src="/sprite/a.png">', {_many('p')}, '</body></html>')"""

_PAGES = {"classifieds": (URL_1, PAGE_1), "refline": (URL_2, PAGE_2), "portal": (URL_3, PAGE_3)}


def detail_pages(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    """Page table (seq, url, html, fetched_at) of one profile."""
    url, html = _PAGES[profile]
    return facts(spark, sf_dir).select(
        F.col("k").alias("page_id"), F.col("k").alias("seq"), F.expr(url).alias("url"), F.expr(html).alias("html"),
        F.col("fetched_at").cast("timestamp").alias("fetched_at"),
    )


# result pages: crawls of eight pages, 0-12 listing links on each
LINK_COUNT = "CAST(k % 13 AS INT)"
RESULT_LINKS = {
    "classifieds": "concat('/item/x/', CAST(k * 10 + i AS STRING), '/')",
    "refline": "concat('/annonce/bien-', CAST(k * 10 + i AS STRING), '#photos')",
    "portal": "concat('/fr/a/', CAST(k * 10 + i AS STRING), '/bien')",
}
_NEXT = {
    "classifieds": "CASE WHEN k % 3 = 0 THEN '<button>Suivant</button>' ELSE '' END",
    "refline": """CASE k % 3 WHEN 0 THEN concat('<a href="?l=0&amp;page=', page_no + 1, '&amp;tri=1">x</a>')
                  WHEN 1 THEN '<a href="#"> &gt;&gt; </a>' ELSE '<a href="?page=99">&gt; fin</a>' END""",
    "portal": """CASE k % 3 WHEN 0 THEN concat('<a href="/liste:p:', page_no + 1, '">x</a>')
                 WHEN 1 THEN '<a href="#"><b>Suivant</b></a>' ELSE '<a href="/liste:p:99">fin</a>' END""",
}


def result_pages(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    """Result pages (crawl_id, page_no, k, html); every link occurs twice."""
    orders = dealt(table(spark, sf_dir, "orders").select("o_orderkey")).selectExpr(
        "o_orderkey AS k", "o_orderkey div 8 AS crawl_id", "CAST(o_orderkey % 8 + 1 AS INT) AS page_no"
    )
    link = RESULT_LINKS[profile]
    anchors = f"transform(slice(sequence(0, 12), 1, {LINK_COUNT}), i -> concat('<a href=\"', {link}, '\">lien ', i, '</a>'))"
    html = f"""concat('<html><body><a href="/item/x/c/1">c</a><a href="/ad/1?page=3">p</a><a href="/ad/Search">s</a>',
      array_join({anchors}, ''), CASE WHEN k % 11 = 0 THEN concat('<a data-testid="ad-card" href="/vide/', k, '">v</a>') ELSE '' END,
      array_join({anchors}, ' '), {_NEXT[profile]}, '</body></html>')"""
    return orders.selectExpr("crawl_id", "page_no", "k", f"{html} AS html")
