"""DuckDB SQL for the registered queries, over the plain tables."""

from __future__ import annotations

from workload.base import LISTINGS_SQL, on_duckdb
from workload.expected import FACTS, expected
from workload.pages import SITE_1, SITE_2, SITE_3, URL_1, URL_3
from workload.registry import AS_OF, EXTRACTIONS

L = on_duckdb(LISTINGS_SQL).replace("STRING", "VARCHAR")
ORACLE: dict[str, str] = {}

_CATEGORY = """CASE trim(lower(category_raw)) WHEN 'appartement' THEN 'apartment' WHEN 'villa' THEN 'villa'
 WHEN 'terrain' THEN 'land' WHEN 'bureau' THEN 'office' ELSE category_raw END"""
LC = f"SELECT *, {_CATEGORY} AS category FROM ({L})"
_POSTED = """CAST(CASE WHEN regexp_matches(date_posted, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_strptime(substr(date_posted,1,10), '%Y-%m-%d')
 ELSE coalesce(try_strptime(date_posted, '%d/%m/%Y'), try_strptime(date_posted, '%d-%m-%Y')) END AS DATE)"""


def _has(field: str) -> str:
    if field == "price":
        return "(price_numeric IS NOT NULL OR coalesce(price_raw NOT IN ('', 'N/A'), false))"
    return f"coalesce({field} NOT IN ('', 'N/A'), false)"


_DEDUPED = f"SELECT * FROM ({LC}) QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY seq) = 1"

ORACLE["dedupe_first"] = f"SELECT seq, listing_id, title, price_numeric FROM ({_DEDUPED})"
ORACLE["dedupe_id_url"] = f"SELECT seq, listing_id, listing_url FROM ({_DEDUPED})"  # the id is a function of the URL here
# along a chain kept and dropped lines alternate, from the end that comes first
_CHAIN = """WITH l AS (SELECT l_orderkey AS g, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n,
  count(*) OVER (PARTITION BY l_orderkey) AS c FROM lineitem),
 r AS (SELECT 'chain' AS kind, g, n, CASE WHEN g % 2 = 0 THEN g * 100 + n ELSE g * 100 + 50 - n END AS seq,
   concat(g, '-', n // 2) AS listing_id, concat(g, '-u', (n + 1) // 2) AS listing_url FROM l
   WHERE CASE WHEN g % 2 = 0 THEN n % 2 = 1 ELSE (c - n) % 2 = 0 END
  UNION ALL SELECT * FROM (SELECT 'id', g, n, g, 'hot', concat('i', g) FROM l WHERE n = 1 ORDER BY g LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'url', g, n, g, CASE WHEN g % 3 = 0 THEN '' ELSE concat('h', g) END, 'hot' FROM l WHERE n = 1 ORDER BY g LIMIT 1)
  UNION ALL SELECT 'blank', g, n, g, NULL, '' FROM l WHERE n = 2)"""
ORACLE["dedupe_id_url_chain"] = f"""{_CHAIN} SELECT * FROM r UNION ALL SELECT concat('b-', kind), g, n, seq,
 CASE WHEN listing_id = '' THEN '' ELSE 'b' || listing_id END, CASE WHEN listing_url = '' THEN '' ELSE 'b' || listing_url END FROM r"""
ORACLE["normalise_listings"] = f"""SELECT seq, listing_id, price_numeric,
 concat('pool=', CASE WHEN rooms > 3 THEN 'true' ELSE 'false' END, '|vue=') AS criteria,
 CAST(CASE WHEN image_count > 0 THEN 1 ELSE 0 END AS INTEGER) AS images FROM ({_DEDUPED})"""
ORACLE["normalise_category"] = f"SELECT seq, category_raw, category FROM ({LC})"
ORACLE["required_filter"] = f"""SELECT seq, title, listing_url, price_raw FROM ({L})
 WHERE {_has('title')} AND {_has('listing_url')} AND {_has('price')}"""
ORACLE["min_date"] = f"SELECT seq, date_posted FROM ({L}) WHERE {_POSTED} >= DATE '1997-01-01'"
ORACLE["date_parse"] = f"SELECT seq, date_posted, {_POSTED} AS posted FROM ({L})"

_FIELDS = {
    f: (f"count(*) FILTER (WHERE {'coalesce(price_numeric <> 0, false)' if f == 'price_numeric' else _has(f)})")
    for f in ("title", "price_numeric", "category", "location_raw", "description", "date_posted")
}
ORACLE["completeness"] = " UNION ALL ".join(
    f"SELECT '{f}' AS field, {c} AS filled, round({c} / count(*) * 100, 2) AS percentage FROM ({LC})" for f, c in _FIELDS.items()
)
_PRICES = f"SELECT price_numeric AS p FROM ({L}) WHERE price_numeric <> 0"
ORACLE["price_stats"] = f"""SELECT min(p) AS min_price, max(p) AS max_price,
 round(CAST(sum(CAST(p AS DECIMAL(15,2))) AS DOUBLE) / count(*), 2) AS avg_price,
 list_sort(list(p))[count(*) // 2 + 1] AS median_price FROM ({_PRICES})"""
ORACLE["category_dist"] = f"SELECT category, count(*) AS listings FROM ({LC}) GROUP BY category"
ORACLE["top_cities"] = f"""SELECT city, count(*) AS listings, min(seq) AS first_seen FROM ({L}) WHERE city <> ''
 GROUP BY city ORDER BY listings DESC, first_seen LIMIT 10"""
ORACLE["image_stats"] = f"""SELECT CAST(sum(image_count) AS BIGINT) AS total_images,
 count(*) FILTER (WHERE image_count > 0) AS listings_with_images,
 round(CAST(sum(image_count) AS DOUBLE) / count(*), 2) AS avg_images_per_listing FROM ({L})"""

_BAD_PRICE = "coalesce(price_numeric <= 0, false)"
_NO_IMAGE = "coalesce(image_count, 0) = 0"
_NO_PLACE = "(city IS NULL OR city = '' OR governorate IS NULL OR governorate = '')"
_ISSUES = " UNION ALL ".join(
    [
        *(f"SELECT listing_id, 'missing_required_fields' AS issue, '{f}' AS field, CAST(NULL AS DOUBLE) AS price FROM l WHERE NOT {_has(f)}"
          for f in ("title", "listing_url", "price")),
        f"SELECT listing_id, 'invalid_prices', NULL, price_numeric FROM l WHERE {_BAD_PRICE}",
        f"SELECT listing_id, 'missing_images', NULL, NULL FROM l WHERE {_NO_IMAGE}",
        f"SELECT listing_id, 'incomplete_location', NULL, NULL FROM l WHERE {_NO_PLACE}",
    ]
)
ORACLE["quality_issues"] = f"WITH l AS ({L}) {_ISSUES}"
ORACLE["issue_counts"] = f"WITH l AS ({L}) SELECT issue, field, count(*) AS issues FROM ({_ISSUES}) GROUP BY issue, field"


def _summary(rows: str, extra: str = "") -> str:
    """``extra``: condition of one additional rule worth half a point."""
    missing = " + ".join(f"count(*) FILTER (WHERE NOT {_has(f)})" for f in ("title", "listing_url", "price"))
    more = f"count(*) FILTER (WHERE {extra})" if extra else "0"
    shown = ", e AS tiny_surface" if extra else ""
    return f"""SELECT n AS total_listings, m AS missing_required_fields, p AS invalid_prices, i AS missing_images,
 l AS incomplete_location{shown}, m + p + i + l + e AS total_issues,
 round(greatest(0, 100 - CAST(4 * m + 2 * p + i + 2 * l + e AS DOUBLE) / (20 * n) * 100), 2) AS quality_score
 FROM (SELECT count(*) AS n, {missing} AS m, count(*) FILTER (WHERE {_BAD_PRICE}) AS p,
  count(*) FILTER (WHERE {_NO_IMAGE}) AS i, count(*) FILTER (WHERE {_NO_PLACE}) AS l, {more} AS e FROM ({rows}))"""


ORACLE["quality_score"] = _summary(_DEDUPED)
ORACLE["quality_custom_rule"] = _summary(L, "surface < 9")
ORACLE["quality_gate"] = f"SELECT total_listings, quality_score, quality_score AS passed_with FROM ({_summary(L)})"


def _long(section: str, item: str, sql: str, *metrics: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({sql})" for m in metrics
    )


_NO_ITEM = "CAST(NULL AS VARCHAR)"
ORACLE["report_full"] = " UNION ALL ".join(
    [
        _long("total", _NO_ITEM, _summary(LC), "total_listings"),
        _long("validation", _NO_ITEM, _summary(LC), "missing_required_fields", "invalid_prices", "missing_images",
              "incomplete_location", "total_issues", "quality_score"),
        _long("field_completeness", "field", ORACLE["completeness"], "filled", "percentage"),
        _long("price_stats", _NO_ITEM, ORACLE["price_stats"], "min_price", "max_price", "avg_price", "median_price"),
        _long("category_distribution", "category", ORACLE["category_dist"], "listings"),
        _long("top_cities", "city", ORACLE["top_cities"], "listings"),
        _long("image_stats", _NO_ITEM, ORACLE["image_stats"], "total_images", "listings_with_images", "avg_images_per_listing"),
    ]
)
ORACLE["report_doc"] = f"""SELECT (SELECT count(*) FROM ({L})) AS total_listings,
 (SELECT filled FROM ({ORACLE['completeness']}) WHERE field = 'title') AS titles,
 (SELECT median_price FROM ({ORACLE['price_stats']})) AS median_price,
 (SELECT CAST(count(*) AS BIGINT) FROM ({LC}) WHERE category = 'Ferme') AS farms,
 CAST(NULL AS BIGINT) AS no_such_category,
 CAST((SELECT count(*) FROM ({ORACLE['top_cities']})) AS INTEGER) AS cities,
 (SELECT quality_score FROM ({_summary(LC)})) AS quality_score, '1997-01-01' AS min_date_posted"""
ORACLE["price_per_sqm"] = f"""SELECT seq, CASE WHEN surface <> 0 AND price_numeric <> 0 THEN price_numeric / surface END
 AS price_per_sqm FROM ({L})"""
_FLAT_EXTRA = """to_json([listing_url]) AS image_urls, CASE WHEN seq % 3 = 0 THEN CAST(seq % 12 AS VARCHAR) END AS criteria_floor,
 CASE WHEN seq % 4 = 0 THEN '["Garage"]' END AS criteria_options"""
ORACLE["flatten"] = f"""SELECT listing_id, title, price_numeric, price_raw, city, governorate, location_raw, surface, rooms, description,
 date_posted, image_count, listing_url, category_raw, seq AS n, CAST(NULL AS VARCHAR) AS criteria_surface,
 CAST(to_json([listing_url]) AS VARCHAR) AS image_urls, CASE WHEN seq % 3 = 0 THEN CAST(seq % 12 AS VARCHAR) END AS criteria_floor,
 CASE WHEN seq % 4 = 0 THEN '["Garage"]' END AS criteria_options FROM ({L})"""
ORACLE["union_sources"] = f"""SELECT seq, title, CASE WHEN seq % 2 = 0 THEN 'a' ELSE 'b' END AS source,
 CASE WHEN seq % 2 = 0 THEN price_numeric END AS price_numeric, CASE WHEN seq % 2 = 1 THEN city END AS city FROM ({L})"""

# --- store -------------------------------------------------------------------------
_ISO_POSTED = """CAST(CASE WHEN regexp_matches(date_posted, '^[0-9]{4}-[0-9]{2}-[0-9]{2}')
 THEN try_strptime(substr(date_posted,1,10), '%Y-%m-%d') END AS DATE)"""
ORACLE["store_prepare"] = f"""SELECT seq, listing_id, price_numeric, CASE WHEN surface <> 0 THEN surface ELSE 77.5 END AS surface,
 CAST(CASE WHEN rooms <> 0 THEN rooms ELSE 4 END AS INTEGER) AS rooms, CAST(NULL AS INTEGER) AS bedrooms,
 CAST(CASE WHEN seq % 3 = 0 THEN seq % 12 END AS INTEGER) AS floor, CASE WHEN seq % 4 = 0 THEN true END AS furnished,
 image_count, {_ISO_POSTED} AS date_posted FROM ({L})"""
ORACLE["store_rejects"] = f"SELECT seq, listing_id, 'listing_url' AS violations FROM ({L}) WHERE listing_url IS NULL"

_STAMP = "'%Y-%m-%d %H:%M:%S'"
_TARGET = f"""SELECT listing_id, title, description, category, price_numeric, 'TND' AS currency, listing_url,
 strftime(scraped_at, {_STAMP}) AS scraped_at, '2020-01-01 00:00:00' AS created_at, '2020-01-01 00:00:00' AS updated_at,
 CAST(NULL AS VARCHAR) AS criteria_k, city FROM ({LC}) WHERE listing_url IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY seq) = 1"""
_EVENTS = f"""SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN concat('N', user_id) ELSE CAST(user_id * 90 AS VARCHAR) END AS listing_id,
 concat('Seen ', event_type) AS title, concat(event_type, ' ', props) AS description, event_type AS category,
 CAST(CAST(value AS DECIMAL(15,2)) AS DOUBLE) AS price_numeric, concat('https://listings.example/e/', event_id) AS listing_url, 'EUR' AS currency,
 strftime(ts, {_STAMP}) AS scraped_at, json_extract_string(props, '$.k') AS criteria_k FROM events"""
_COLUMNS = ("title", "description", "category", "price_numeric", "currency", "listing_url", "scraped_at", "criteria_k")


def _merged(update: tuple[str, ...], inserted: tuple[str, ...] = _COLUMNS, touch: bool = True, target: str = _TARGET, events: str = _EVENTS) -> str:
    """``update`` from the last event in existing rows, the rest from the first in new ones."""
    parts = []
    for c in _COLUMNS:
        if c not in inserted:
            parts.append(f"t.{c} AS {c}")
        elif c in update:
            parts.append(f"CASE WHEN z.listing_id IS NOT NULL THEN z.{c} ELSE t.{c} END AS {c}")
        else:
            parts.append(f"CASE WHEN t.listing_id IS NOT NULL THEN t.{c} ELSE a.{c} END AS {c}")
    new = f"'{AS_OF}'"
    updated = (
        f"CASE WHEN z.listing_id IS NOT NULL THEN {new} ELSE t.updated_at END" if touch else f"coalesce(t.updated_at, {new})"
    )
    return f"""WITH t AS ({target}), e AS ({events}),
 a AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY seq) = 1),
 z AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY seq DESC) = 1)
 SELECT coalesce(t.listing_id, z.listing_id) AS listing_id, {', '.join(parts)},
 coalesce(t.created_at, {new}) AS created_at, {updated} AS updated_at
 FROM t FULL OUTER JOIN z ON t.listing_id = z.listing_id LEFT JOIN a ON a.listing_id = z.listing_id"""


ORACLE["merge_narrow"] = _merged(("price_numeric", "description", "criteria_k", "scraped_at"))
ORACLE["stream_merge"] = ORACLE["merge_narrow"]
ORACLE["merge_full"] = _merged(_COLUMNS)
ORACLE["merge_scheduled"] = _merged(
    ("price_numeric", "description", "scraped_at"), tuple(c for c in _COLUMNS if c != "criteria_k"), touch=False
)
ORACLE["store_upsert_read"] = ORACLE["merge_narrow"]
ORACLE["store_lookup_stored"] = f"SELECT * FROM ({ORACLE['merge_full']}) WHERE listing_id = '900'"
_LOADED = f"""SELECT seq, listing_id, title, concat(description, ' v2') AS description, category, price_numeric, 'TND' AS currency, listing_url,
 strftime(scraped_at, {_STAMP}) AS scraped_at, CAST(NULL AS VARCHAR) AS criteria_k FROM (SELECT * FROM ({LC})
 WHERE {_has('title')} AND {_has('listing_url')} AND {_has('price')} QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY seq) = 1)"""
ORACLE["scheduled_run"] = _merged(
    ("price_numeric", "description", "scraped_at"), tuple(c for c in _COLUMNS if c != "criteria_k"), touch=False,
    target=_TARGET.replace("WHERE listing_url IS NOT NULL", "WHERE listing_url IS NOT NULL AND seq % 2 = 0"), events=_LOADED)
_NEEDED = f"{_has('title')} AND {_has('listing_url')} AND {_has('price')}"
ORACLE["step_counts"] = f"""WITH l AS ({L}), q AS (SELECT * FROM l WHERE {_NEEDED}),
 d AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY seq) = 1),
 c AS (SELECT (SELECT count(*) FROM l) AS a, (SELECT count(*) FROM q) AS b, (SELECT count(*) FROM d) AS c, (SELECT count(*) FROM d WHERE {_POSTED} >= DATE '1997-01-01') AS e)
 SELECT 'read' AS step, a AS rows, 0::BIGINT AS removed FROM c UNION ALL SELECT 'required', b, a - b FROM c
 UNION ALL SELECT 'distinct', c, b - c FROM c UNION ALL SELECT 'recent', e, c - e FROM c"""
ORACLE["union_scoped"] = f"""WITH r AS (SELECT 'one' AS source, * FROM ({LC}) WHERE seq % 3 <> 0 UNION ALL SELECT 'two', * FROM ({LC}) WHERE seq % 2 = 0),
 d AS (SELECT * FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY source, listing_id ORDER BY seq) = 1) WHERE listing_url IS NOT NULL)
 SELECT source, listing_id, title, CASE WHEN source = 'two' THEN concat(description, ' again') ELSE description END AS description, price_numeric FROM d"""
ORACLE["flatten_open"] = f"""SELECT listing_id, surface, CAST(seq % 12 AS VARCHAR) AS criteria_floor, CAST(NULL AS VARCHAR) AS criteria_surface,
 concat('{{"k', seq, '":"x","vue":"mer"}}') AS criteria_rest FROM ({L})"""
_T_COLUMNS = "listing_id, title, description, category, price_numeric, currency, listing_url, scraped_at, created_at, updated_at, criteria_k"
ORACLE["insert_new"] = f"""WITH t AS ({_TARGET}), e AS ({_EVENTS}) SELECT {_T_COLUMNS} FROM t UNION ALL
 SELECT listing_id, title, description, category, price_numeric, currency, listing_url, scraped_at, '{AS_OF}', '{AS_OF}', criteria_k
 FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY seq) = 1)
 WHERE listing_id NOT IN (SELECT listing_id FROM t)"""
ORACLE["store_by_id"] = f"SELECT {_T_COLUMNS} FROM ({_TARGET}) WHERE listing_id = '123'"
ORACLE["store_by_city"] = f"SELECT {_T_COLUMNS} FROM ({_TARGET}) WHERE city = 'NATION_17'"
ORACLE["store_recent"] = f"SELECT {_T_COLUMNS} FROM ({_TARGET}) ORDER BY scraped_at DESC, listing_id LIMIT 100"
ORACLE["store_stats"] = f"""SELECT count(*) AS total_listings,
 round(CAST(sum(CAST(price_numeric AS DECIMAL(15,2))) AS DOUBLE) / count(price_numeric), 2) AS avg_price,
 max(scraped_at) AS latest_scrape FROM ({_TARGET})"""
ORACLE["store_by_category"] = f"SELECT category, count(*) AS listings FROM ({_TARGET}) GROUP BY category"
ORACLE["store_top_cities"] = f"""SELECT city, count(*) AS listings FROM ({_TARGET}) GROUP BY city
 ORDER BY listings DESC, city NULLS FIRST LIMIT 10"""

# --- documents ------------------------------------------------------------------------
_FOLD = r"regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')"


def _label(keep: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({_FOLD}), '[^\w\s{keep}]', '', 'g'), '\s+', ' ', 'g'))"


ORACLE["ascii_fold"] = f"SELECT doc_id, {_FOLD} AS folded FROM documents"
ORACLE["normalise_label"] = rf"SELECT doc_id, {_label('/*+>-')} AS refline, {_label('/:+>-')} AS portal FROM documents"
ORACLE["slugify"] = r"""SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, '/'), lambda s: trim(s, ' ' || chr(9) || chr(10)) <> ''),
 lambda s: lower(trim(regexp_replace(regexp_replace(strip_accents(s), '[^\x00-\x7F]', '', 'g'), '[^a-zA-Z0-9]+', '-', 'g'), '-'))), '/') AS slug
 FROM documents"""
ORACLE["parse_boolean"] = "SELECT doc_id, regexp_matches(lower(text), 'oui|yes|true|1|disponible|available') AS affirmed FROM documents"
ORACLE["criteria_key"] = r"""SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s\p{Z}]', '', 'g'), '[\s\p{Z}]+', '_', 'g') AS key
 FROM documents"""

# --- given pages ------------------------------------------------------------------------
_ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&"))


def _unescape(c: str) -> str:
    for entity, char in _ENTITIES:
        c = f"replace({c}, '{entity}', '{char}')"
    return c


_H1 = f"""trim({_unescape("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")})"""
ORACLE["pages_scan"] = "SELECT page_id, url, length(html) AS chars FROM pages"
ORACLE["title"] = f"SELECT page_id, {_H1} AS title FROM pages"
_NO_MARKUP = r"""regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'), '(?s)<[^>]*>', chr(10), 'g')"""
ORACLE["text_lines"] = f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS line FROM (
 SELECT page_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT page_id,
 list_filter(list_transform(string_split({_unescape(_NO_MARKUP)}, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM pages))"""
ORACLE["nodes_first"] = f"""SELECT page_id,
 trim({_unescape("regexp_extract(html, '<div class=.ad.[^>]*>([^<]*)</div>', 1)")}) AS box_text,
 CAST(len(regexp_extract_all(html, '<(?:a|li)[ >]')) AS INTEGER) AS nav_elements FROM pages"""
ORACLE["nodes_rows"] = f"""SELECT page_id, 'h1' AS tag, {_H1} AS text FROM pages UNION ALL
 SELECT page_id, 'title', trim({_unescape("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")}) FROM pages"""
ORACLE["resolve_url"] = f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS link_no, concat('{SITE_1}', hrefs[i]) AS url FROM (
 SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM (
 SELECT page_id, regexp_extract_all(html, '(?i)<a\\s[^>]*href="([^"]*)"', 1) AS hrefs FROM pages))"""
ORACLE["listing_id"] = """SELECT page_id, concat('hash_', md5(url)) AS classifieds_id,
 concat('refline_hash_', md5(url)) AS refline_id, concat('portal_hash_', md5(url)) AS portal_id FROM pages"""
ORACLE["site_lookup"] = """SELECT 'classifieds.example' AS source, count(*) AS pages FROM orders UNION ALL
 SELECT 'portal.example', count(*) FROM orders UNION ALL SELECT NULL, count(*) FROM pages"""

# --- generated detail pages -----------------------------------------------------------------
for _name, (_profile, *_columns) in EXTRACTIONS.items():
    ORACLE[_name] = expected(_profile, list(_columns) or None, validate=not _columns)
ORACLE["next_data"] = f"""SELECT seq, listing_id, title, price_raw, price_numeric, location_raw, date_posted
 FROM ({expected('classifieds', validate=False)}) WHERE seq % 5 = 0 AND seq % 35 NOT IN (0, 5)"""

_SHOWN = "x49 <> 2 AND x7 <> 2"  # the price stands in an element
ORACLE["price_readings"] = f"""SELECT k AS seq, CAST(CASE WHEN {_SHOWN} THEN CASE x4 WHEN 1 THEN amount * 1000 WHEN 2 THEN amount * 100 + 50 ELSE amount END END AS DOUBLE) AS digits,
 CAST(CASE WHEN {_SHOWN} THEN CASE x4 WHEN 0 THEN amount WHEN 1 THEN amount * 1000 WHEN 2 THEN amount + 0.5 END END AS DOUBLE) AS plain,
 {_SHOWN} AND x4 = 2 AS differ FROM ({FACTS})"""
ORACLE["section_slice"] = """SELECT o_orderkey AS seq,
 concat('Type de bien|Appartement|État|Neuf|Étage du bien|', o_orderkey % 12, '|État|Ancien') AS section FROM orders"""
ORACLE["options"] = """SELECT o_orderkey AS seq, CASE o_orderkey % 3 WHEN 0 THEN 'Piscine|Meuble|Garage' WHEN 1 THEN 'Vue dégagée' ELSE '' END
 AS options FROM orders"""
ORACLE["date_parse_fr"] = """SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS posted,
 CASE WHEN try_strptime(concat(CASE WHEN o_orderkey % 100 >= 69 THEN '19' ELSE '20' END, lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0'),
   strftime(o_orderdate, '-%m-%d')), '%Y-%m-%d') IS NOT NULL
 THEN CAST(CASE WHEN o_orderkey % 100 >= 69 THEN 1900 ELSE 2000 END + o_orderkey % 100 AS INTEGER) END AS year FROM orders"""
ORACLE["parse_number"] = """SELECT seq,
 CAST(CASE n WHEN 0 THEN w + 0.5 WHEN 1 THEN NULL WHEN 2 THEN w * 1000 ELSE w + 0.25 END AS DOUBLE) AS dotted,
 CAST(CASE n WHEN 0 THEN w + 0.5 WHEN 1 THEN NULL WHEN 2 THEN w * 1000 ELSE w + 0.25 END AS DOUBLE) AS spoken,
 CAST(CASE n WHEN 0 THEN w * 10 + 5 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE w + 0.25 END AS DOUBLE) AS plain,
 CAST(CASE n WHEN 0 THEN w * 10 + 5 WHEN 1 THEN CAST(concat('1250', w) AS BIGINT) WHEN 2 THEN w * 1000 ELSE w * 100 + 25 END AS DOUBLE) AS digits,
 CAST(CASE n WHEN 1 THEN 1 ELSE w END AS DOUBLE) AS first_count
 FROM (SELECT o_orderkey AS seq, o_orderkey % 4 AS n, CAST(floor(o_totalprice) AS BIGINT) AS w FROM orders)"""
ORACLE["currency"] = """SELECT seq, symbol,
 CASE symbol WHEN 'DT' THEN 'TND' WHEN 'dt' THEN 'TND' WHEN '€' THEN 'EUR' WHEN '$' THEN 'USD' ELSE upper(symbol) END AS exact,
 CASE WHEN upper(symbol) IN ('DT', 'TND') THEN 'TND' WHEN upper(symbol) = 'EURO' OR symbol = '€' THEN 'EUR' WHEN symbol = '$' THEN 'USD'
  ELSE upper(symbol) END AS any_case,
 CASE WHEN upper(symbol) IN ('DT', 'TND') THEN 'TND' WHEN symbol IN ('EUR', '€', 'euro') THEN 'EUR' WHEN symbol IN ('USD', '$') THEN 'USD' END AS mentioned
 FROM (SELECT o_orderkey AS seq, ['TND','DT','dt','Dt','EUR','€','USD','$','euro','gbp'][o_orderkey % 10 + 1] AS symbol FROM orders)"""

# --- result pages ------------------------------------------------------------------------------
_PAGES = "SELECT o_orderkey AS k, o_orderkey // 8 AS crawl_id, CAST(o_orderkey % 8 + 1 AS INTEGER) AS page_no, o_orderkey % 13 AS n FROM orders"
_CARD = f"SELECT crawl_id, page_no, CAST(0 AS INTEGER) AS link_no, concat('{SITE_1}/vide/', k) AS url FROM p WHERE n = 0 AND k % 11 = 0"


def _links(url: str, card: bool = False) -> str:
    return f"""WITH p AS ({_PAGES}) SELECT crawl_id, page_no, CAST(i AS INTEGER) AS link_no, {url} AS url
 FROM (SELECT *, unnest(range(n)) AS i FROM p)""" + (f" UNION ALL {_CARD}" if card else "")


_LINKS_1 = _links(f"concat('{SITE_1}/item/x/', k * 10 + i, '/')", card=True)
ORACLE["links_p1"] = _LINKS_1
ORACLE["links_p2"] = _links(f"concat('{SITE_2}/annonce/bien-', k * 10 + i)")
ORACLE["links_p3"] = _links(f"concat('{SITE_3}/fr/a/', k * 10 + i, '/bien')")
ORACLE["has_next"] = f"""WITH p AS ({_PAGES}) SELECT 'classifieds' AS profile, k, n >= 5 AS has_next FROM p UNION ALL
 SELECT 'refline', k, (k % 3 IN (0, 1) OR page_no = 2) AND n >= 3 FROM p UNION ALL
 SELECT 'portal', k, k % 3 IN (0, 1) FROM p"""
_COUNTED = f"SELECT *, CASE WHEN n = 0 AND k % 11 = 0 THEN 1 ELSE n END AS links FROM ({_PAGES})"


def _extent(pages: str) -> str:
    """(crawl_id, last_page): pages have links and final."""
    return f"""SELECT crawl_id, min(CASE WHEN links = 0 THEN page_no - 1 WHEN final THEN page_no ELSE top END) AS last_page
 FROM (SELECT *, max(page_no) OVER (PARTITION BY crawl_id) AS top FROM ({pages})) GROUP BY crawl_id"""


ORACLE["crawl_extent"] = f"""WITH c AS (SELECT *, n < 5 AS final FROM ({_COUNTED})), e AS ({_extent('SELECT * FROM c')})
 SELECT c.crawl_id, c.page_no, CAST(c.links AS INTEGER) AS links FROM c JOIN e ON c.crawl_id = e.crawl_id
 WHERE c.page_no <= e.last_page AND c.page_no <= 6"""
ORACLE["crawl_listings"] = f"""WITH c AS ({_COUNTED}), l AS ({_LINKS_1}),
 kept AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY crawl_id, url ORDER BY page_no, link_no) = 1),
 news AS (SELECT crawl_id, page_no, count(*) AS fresh FROM kept GROUP BY crawl_id, page_no),
 f AS (SELECT c.crawl_id, c.page_no, c.links, c.n < 5 OR coalesce(news.fresh, 0) = 0 AS final FROM c
       LEFT JOIN news ON c.crawl_id = news.crawl_id AND c.page_no = news.page_no),
 e AS ({_extent('SELECT * FROM f')})
 SELECT kept.crawl_id, kept.page_no, link_no, url AS listing_url FROM kept JOIN e ON kept.crawl_id = e.crawl_id
 WHERE kept.page_no <= last_page
 QUALIFY row_number() OVER (PARTITION BY kept.crawl_id ORDER BY kept.page_no, link_no) <= 20"""
ORACLE["links_join_pages"] = f"""WITH l AS ({_LINKS_1}), o AS (SELECT concat('{SITE_1}/item/x/', o_orderkey, '/') AS url, o_orderkey AS page_id FROM orders),
 g AS (SELECT url, count(*) AS times_linked FROM l GROUP BY url),
 a AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY url ORDER BY crawl_id, page_no, link_no) = 1)
 SELECT a.url, times_linked, page_id, crawl_id, page_no, link_no FROM a JOIN g ON a.url = g.url JOIN o ON a.url = o.url"""

ORACLE["crawl_sample"] = """WITH p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_orderkey // 24 END AS crawl_id,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey // 3 ELSE (o_orderkey % 24) // 3 * 2 + o_orderkey % 3 - 1 END + 1 AS INTEGER) AS page_no FROM orders),
 e AS (SELECT crawl_id, coalesce(min(CASE WHEN crawl_id >= 0 AND k % 89 = 0 THEN page_no END), max(page_no)) AS last_page FROM p GROUP BY crawl_id),
 l AS (SELECT crawl_id, page_no, CAST(i AS INTEGER) AS link_no, CASE WHEN i = 0 THEN concat('u', k // 6) ELSE concat('u', k, '-', i) END AS listing_url
       FROM (SELECT *, unnest(range(k % 7 + 1)) AS i FROM p)),
 d AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY crawl_id, listing_url ORDER BY page_no, link_no) = 1)
 SELECT crawl_id, page_no, link_no, listing_url FROM d JOIN e USING (crawl_id) WHERE page_no <= last_page
 QUALIFY row_number() OVER (PARTITION BY crawl_id ORDER BY page_no, link_no) <= 5000"""

_SEARCHES = """SELECT c_custkey AS search_id,
 concat(array_to_string(list_transform(string_split(lower(r_name), ' '), lambda s: s), '-'), '/cite-',
        replace(replace(lower(n_name), '_', '-'), ' ', '-')) AS place,
 CASE c_custkey % 4 WHEN 0 THEN 'ct' WHEN 1 THEN 'sc' WHEN 2 THEN 'st' ELSE 'cd' END AS level, c_custkey % 10 = 0 AS explicit
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_START = f"""CASE WHEN explicit THEN '{SITE_3}/fr/ct/special:p:3' WHEN level = 'sc' THEN concat('{SITE_3}/fr/sc/', slug)
 ELSE concat('{SITE_3}/fr/', level, '/', place, '/', slug) END"""
ORACLE["seed_urls"] = f"""SELECT search_id, transaction_type, category, {_START} AS start_url FROM ({_SEARCHES}),
 (VALUES ('sale', 'apartment', 'appartements-a-vendre'), ('rent', 'apartment', 'appartements-a-louer'),
  ('sale', 'land', 'terrains-a-vendre'), ('rent', 'land', 'terrains-a-louer'),
  ('sale', 'villa', 'villas-et-maisons-de-luxe-a-vendre'), ('rent', 'villa', 'villas-et-maisons-de-luxe-a-louer')
 ) AS g(transaction_type, category, slug)"""
_GRID = f"""SELECT search_id, transaction_type, category, {_START} AS start_url FROM ({_SEARCHES}),
 (VALUES ('sale', 'apartment', 'appartements-a-vendre'), ('rent', 'apartment', 'appartements-a-louer'),
  ('sale', 'land', 'terrains-a-vendre'), ('rent', 'land', 'terrains-a-louer')) AS g(transaction_type, category, slug)"""
ORACLE["portal_searched"] = f"""WITH g AS ({_GRID}), s AS (SELECT regexp_replace(start_url, ':p:[0-9]+$', '') AS p, min(search_id) AS search_id,
  arg_min(category, (search_id, category, transaction_type)) AS c, arg_min(transaction_type, (search_id, category, transaction_type)) AS t FROM g GROUP BY 1),
 o AS (SELECT o_orderkey AS seq, start_url FROM orders LEFT JOIN g ON g.search_id = o_orderkey % (SELECT count(*) FROM customer) + 1 AND g.category = 'land'
  AND g.transaction_type = CASE WHEN o_orderkey % 2 = 0 THEN 'sale' ELSE 'rent' END),
 f AS (SELECT seq, CASE seq % 5 WHEN 0 THEN regexp_replace(start_url, ':p:[0-9]+$', '') WHEN 1 THEN concat(start_url, '/quartier') WHEN 2 THEN '-' WHEN 3 THEN '-'
  ELSE regexp_replace(start_url, ':p:[0-9]+$', '') END AS u FROM o),
 m AS (SELECT seq, s.search_id, c, t FROM f LEFT JOIN s ON u = p OR regexp_replace(u, '/[^/]*$', '') = p)
 SELECT m.seq, listing_id, search_id, c AS category, t AS transaction_type FROM m JOIN ({expected('portal', ['seq', 'listing_id'], validate=False)}) x ON x.seq = m.seq"""
ORACLE["page_urls"] = f"""WITH s AS (SELECT search_id, {_START} AS start_url, unnest(range(1, search_id % 5 + 2)) AS i
  FROM (SELECT *, 'bureaux-a-vendre' AS slug FROM ({_SEARCHES})))
 SELECT profile, search_id, CAST(i AS INTEGER) AS page_no, CASE WHEN i = 1 THEN start_url
  WHEN profile = 'classifieds' THEN concat(start_url, '?page=', i)
  WHEN profile = 'refline' THEN concat(start_url, '?l=0&page=', i, '&tri=1')
  ELSE concat(replace(start_url, ':p:3', ''), ':p:', i) END AS page_url
 FROM s, (VALUES ('classifieds'), ('refline'), ('portal')) AS p(profile)"""

# --- files and streams ---------------------------------------------------------------------------
ORACLE["csv_roundtrip"] = f"""SELECT listing_id, title, price_numeric, city, governorate, description, date_posted, seq AS n,
 {_FLAT_EXTRA.replace('to_json([listing_url])', 'CAST(to_json([listing_url]) AS VARCHAR)')}, CAST(surface AS VARCHAR) AS criteria_surface FROM ({L})"""
ORACLE["json_roundtrip"] = f"""SELECT listing_id, title, price_numeric, city, governorate, image_count, listing_id AS image_urls FROM ({L})"""
ORACLE["json_envelope"] = f"SELECT seq, listing_id, title, price_numeric, image_count, listing_id AS image_urls FROM ({L})"
ORACLE["report_file"] = f"""SELECT total_listings, (SELECT median_price FROM ({ORACLE['price_stats']})) AS median_price, tiny_surface, total_issues, quality_score,
 (SELECT total_images FROM ({ORACLE['image_stats']})) AS total_images FROM ({_summary(LC, "surface < 9")})"""
ORACLE["custom_profile"] = f"""SELECT page_id AS seq, md5(url) AS listing_id, {_H1} AS title FROM pages
 QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1"""
ORACLE["stream_extract"] = f"""SELECT page_id AS seq, url AS listing_url, concat('hash_', md5(url)) AS listing_id, {_H1} AS title FROM pages"""
ORACLE["stream_dedupe"] = f"""SELECT CAST(user_id AS VARCHAR) AS listing_id, event_id, event_type, value, props, strftime(ts, {_STAMP}) AS ts FROM events
 WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1"""
