"""Expected fields of the generated pages, in DuckDB SQL over the facts."""

from __future__ import annotations

from workload.base import FACTS_SQL, on_duckdb
from workload.pages import LONG, SITE_1, SITE_2, SITE_3, URL_1, URL_2, URL_3

FACTS = on_duckdb(FACTS_SQL).replace("STRING", "VARCHAR")


def _sql(text: str) -> str:
    return text.replace("STRING", "VARCHAR")


# embedded record is usable
_E = "(x5 = 0 AND x35 NOT IN (0, 5))"
_URL1, _URL2, _URL3 = (f"({_sql(u)})" for u in (URL_1, URL_2, URL_3))


def _hash(prefix: str, url: str) -> str:
    return f"concat('{prefix}', md5({url}))"


def _many(site: str, path: str) -> str:
    """The further pictures of a long page, as the end of a list."""
    return f"CASE WHEN {LONG} THEN array_to_string(list_transform(range(1, 15), lambda i: concat('|{site}/{path}/', k, '/g', i, '.jpg')), '') ELSE '' END"


def _pairs(*options: str) -> str:
    """Sorted key=value text; NULL entries are left out."""
    return f"array_to_string(list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL)), '|')"


CLASSIFIEDS = {
    "seq": "k",
    "source": "'classifieds.example'",
    "listing_url": _URL1,
    "listing_id": f"""CASE WHEN {_E} THEN concat('E', k) WHEN x4 IN (0, 2) THEN CAST(k AS VARCHAR)
        WHEN x4 = 1 THEN lpad(CAST(k AS VARCHAR), 24, '0') WHEN k % 8 = 3 THEN CAST(k AS VARCHAR)
        ELSE {_hash('hash_', _URL1)} END""",
    "title": "t",
    "description": f"""CASE WHEN {_E} THEN concat('Fiche ', k) WHEN x7 = 4 THEN concat('Courte ', k) WHEN x7 = 6 THEN 'N/A'
        WHEN x3 = 0 THEN concat('Premier ', k, chr(10), chr(10), 'Second & dernier')
        WHEN x3 = 1 THEN concat('Texte simple ', k) ELSE concat('Seulgras', k) END""",
    "category": f"""CASE WHEN {_E} THEN 'Appartements'
        WHEN x7 <> 3 THEN CASE x5 WHEN 0 THEN 'apartment' WHEN 1 THEN 'villa' WHEN 2 THEN 'land' WHEN 3 THEN 'office' ELSE 'ferme' END
        WHEN x4 = 0 THEN 'house' WHEN x4 IN (1, 2) THEN 'commercial' ELSE 'N/A' END""",
    "transaction_type": "CAST(NULL AS VARCHAR)",
    "price_raw": f"""CASE WHEN {_E} THEN CASE WHEN x35 IN (10, 20) THEN 'N/A' ELSE concat(amount, ' DT') END
        WHEN x49 = 2 THEN 'N/A' WHEN x7 = 2 THEN concat(amount, '.50 dt')
        WHEN x4 = 0 THEN concat(spaced, ' TND') WHEN x4 = 1 THEN concat(amount, ',000 EUR')
        WHEN x4 = 2 THEN concat(amount, '.50 €') ELSE CAST(amount AS VARCHAR) END""",
    "price_numeric": f"""CAST(CASE WHEN {_E} THEN CASE x35 WHEN 10 THEN 0 WHEN 20 THEN NULL ELSE amount END
        WHEN x49 = 2 THEN NULL WHEN x7 = 2 THEN amount + 0.5 WHEN x4 = 1 THEN amount * 1000
        WHEN x4 = 2 THEN amount * 100 + 50 ELSE amount END AS DOUBLE)""",
    "currency": f"CASE WHEN NOT {_E} AND x7 <> 2 AND x4 IN (1, 2) THEN 'EUR' ELSE 'TND' END",
    "location_raw": f"""CASE WHEN {_E} THEN concat(CASE WHEN x35 = 15 THEN 'None' ELSE n END, ', ', r) WHEN x7 = 5 THEN 'N/A'
        WHEN x4 = 0 THEN concat(r, ', ', n, ', Quartier ', k) WHEN x4 = 1 THEN concat(r, ',', n)
        WHEN x4 = 2 THEN n ELSE concat(r, ', ', n) END""",
    "city": f"CASE WHEN {_E} THEN CASE WHEN x35 = 15 THEN NULL ELSE n END WHEN x7 = 5 THEN NULL ELSE n END",
    "governorate": f"CASE WHEN {_E} THEN r WHEN x7 = 5 OR x4 = 2 THEN NULL ELSE r END",
    "neighborhood": f"CASE WHEN NOT {_E} AND x7 <> 5 AND x4 = 0 THEN concat('Quartier ', k) END",
    "surface": "CAST(m2 AS DOUBLE)",
    "rooms": f"CASE WHEN NOT {_E} THEN rooms_n + CAST(0.5 AS DOUBLE) END",
    "bedrooms": f"CAST(CASE WHEN {_E} THEN beds_n ELSE beds_n + 1 END AS DOUBLE)",
    "bathrooms": "CAST(NULL AS DOUBLE)",
    "floor": "CAST(NULL AS DOUBLE)",
    "furnished": "CAST(NULL AS BOOLEAN)",
    "criteria": f"""CASE WHEN {_E} THEN concat('bedrooms=', beds_n, '.0|surface=', m2, '.0|vue=mer')
        ELSE concat('bedrooms=', beds_n + 1, '.0|floor=RDC|garage=true|meublé=Oui|rooms=', rooms_n, '.5|surface=', m2, '.0') END""",
    "image_urls": f"""CASE WHEN {_E} THEN concat('{SITE_1}/e/', k, '.jpg|https://cdn.example/e', k, '.jpg')
        WHEN x7 = 6 THEN concat('{SITE_1}/logo.png|{SITE_1}/i/', k, '/solo.jpg')
        WHEN x7 = 0 AND x3 = 2 THEN concat('{SITE_1}/i/', k, '/in.jpg')
        ELSE concat('{SITE_1}/i/', k, '/1.jpg|https://cdn.example/', k, '.jpg|{SITE_1}/i/3.jpg', {_many(SITE_1, 'i')}) END""",
    "image_count": f"CAST(CASE WHEN {_E} OR x7 = 6 THEN 2 WHEN x7 = 0 AND x3 = 2 THEN 1 WHEN {LONG} THEN 17 ELSE 3 END AS INTEGER)",
    "date_posted": f"CASE WHEN {_E} THEN concat(d, 'T00:00:00Z') WHEN x4 = 3 THEN NULL ELSE d END",
}
CLASSIFIEDS_VALID = f"({_E} OR x49 <> 2)"

_FLAGS2 = ("garage", "garden", "pool", "furnished", "terrace", "elevator", "balcony", "parking", "air_conditioning", "internet")
REFLINE = {
    "seq": "k",
    "source": "'refline.example'",
    "listing_url": _URL2,
    "listing_id": f"""CASE WHEN x4 <> 3 THEN CAST(k AS VARCHAR) WHEN x7 = 1 THEN {_hash('refline_hash_', _URL2)}
        ELSE concat('AB-', k) END""",
    "title": "t",
    "description": "concat('Premier paragraphe ', k, chr(10), 'Second', chr(10), 'paragraphe')",
    "category": """CASE x5 WHEN 0 THEN 'apartment' WHEN 1 THEN 'rent' WHEN 4 THEN 'office'
        WHEN 2 THEN CASE WHEN x4 = 3 THEN 'N/A' ELSE 'land' END ELSE 'N/A' END""",
    "transaction_type": "CASE WHEN x3 = 0 OR x5 = 1 THEN 'rent' WHEN x3 = 1 THEN 'sale' END",
    "price_raw": "CASE WHEN x7 = 2 THEN 'N/A' WHEN x2 = 0 THEN concat(spaced, ' DT / Mois') ELSE concat(spaced, ' Tnd') END",
    "price_numeric": "CAST(CASE WHEN x7 <> 2 THEN amount END AS DOUBLE)",
    "currency": "'TND'",
    # '.._23, EUROPE' reads as an amount in EUR, so such a line is no place
    "location_raw": """CASE WHEN x4 IN (0, 1) AND r = 'EUROPE' THEN 'N/A'
        WHEN x4 = 0 THEN concat('Quartier ', k, ', ', n, ', ', r) WHEN x4 = 1 THEN concat(n, ', ', r)
        WHEN x4 = 2 THEN concat('Ville ', n, ' centre,') ELSE 'N/A' END""",
    "city": "CASE WHEN x4 IN (0, 1) AND r <> 'EUROPE' THEN n WHEN x4 = 2 THEN concat('Ville ', n, ' centre') END",
    "governorate": "CASE WHEN x4 IN (0, 1) AND r <> 'EUROPE' THEN r END",
    "neighborhood": "CASE WHEN x4 = 0 AND r <> 'EUROPE' THEN concat('Quartier ', k) END",
    "surface": "m2 + CAST(0.5 AS DOUBLE)",
    "rooms": "CAST(rooms_n AS DOUBLE)",
    "bedrooms": "CAST(beds_n AS DOUBLE)",
    "bathrooms": "CAST(10 AS DOUBLE)",
    "floor": "CAST(NULL AS DOUBLE)",
    "furnished": "CASE x3 WHEN 0 THEN true WHEN 1 THEN false END",
    "criteria": _pairs(
        "concat('bedrooms=', beds_n, '.0')", "'bathrooms=10.0'", "concat('rooms=', rooms_n, '.0')",
        "concat('surface=', m2, '.5')", "CASE WHEN x3 = 1 THEN 'surface_land=300.0' END",
        "CASE WHEN x2 = 0 AND x7 <> 2 THEN 'price_period=mois' END",
        """CASE x3 WHEN 0 THEN 'options=["Piscine","Meuble","Garage"]' WHEN 1 THEN 'options=["Vue dégagée"]' END""",
        *(f"CASE WHEN x3 <> 2 THEN '{f}=' || {'(x3 = 0)' if f in ('garage', 'pool', 'furnished') else 'false'} END" for f in _FLAGS2),
    ),
    "image_urls": f"concat('{SITE_2}/p/', k, '.jpg|https://cdn.example/', k, '.jpg', {_many(SITE_2, 'q')})",
    "image_count": f"CAST(CASE WHEN {LONG} THEN 16 ELSE 2 END AS INTEGER)",
    "date_posted": "d",
}
REFLINE_VALID = "x7 <> 2"

_FLAGS3 = {
    "garage": "(x3 = 0)", "garden": "false", "terrace": "false", "elevator": "false", "pool": "false",
    "furnished": "(x3 = 1)", "concierge": "false", "air_conditioning": "false", "central_heating": "false",
    "security": "false", "double_glazing": "false", "equipped_kitchen": "false", "sea_view": "(x3 = 0)",
    "mountain_view": "false", "internet": "false",
}
_TEXT3 = """concat('Bel appartement lumineux avec une vue dégagée, proche des commerces et des écoles du quartier ', k)"""
PORTAL = {
    "seq": "k",
    "source": "'portal.example'",
    "listing_url": _URL3,
    "listing_id": f"CASE WHEN x7 = 1 THEN {_hash('portal_hash_', _URL3)} ELSE CAST(k AS VARCHAR) END",
    "title": "t",
    # all lines from the title to the first section but prices, sizes and counts
    "description": f"""CASE WHEN x7 = 3 THEN concat(t, ' | Portal') ELSE concat(CASE WHEN {LONG} THEN repeat('Annonce du jour' || chr(10), 600) ELSE '' END,
        CASE x4 WHEN 0 THEN concat('Quartier Nord à ', n, chr(10)) WHEN 1 THEN concat('Cité Sud à', chr(10), n, chr(10))
         WHEN 2 THEN concat('Cité Est, ', n, chr(10)) ELSE '' END,
        CASE WHEN x7 <> 2 AND x3 = 0 THEN concat('A partir de ', spaced, ' TND', chr(10)) ELSE '' END, {_TEXT3}, chr(10), 'Texte court') END""",
    "category": "'apartment'",
    "transaction_type": "'sale'",
    "price_raw": """CASE WHEN x7 = 2 THEN 'Prix a consulter' WHEN x3 = 0 THEN concat('A partir de ', spaced, ' TND')
        WHEN x3 = 1 THEN concat(spaced, ' dt') ELSE concat(spaced, ' euro') END""",
    "price_numeric": "CAST(CASE WHEN x7 <> 2 THEN amount END AS DOUBLE)",
    "currency": "CASE WHEN x7 <> 2 AND x3 = 2 THEN 'EUR' ELSE 'TND' END",
    "location_raw": f"""CASE x4 WHEN 0 THEN concat('Quartier Nord à ', n) WHEN 1 THEN concat('Cité Sud à ', n)
        WHEN 2 THEN concat('Cité Est, ', n) ELSE {_TEXT3} END""",
    # without a place line the first line with a comma is taken, here the text
    "city": "CASE WHEN x4 <> 3 THEN n ELSE concat('proche des commerces et des écoles du quartier ', k) END",
    "governorate": "CASE WHEN x4 <> 3 THEN n ELSE concat('proche des commerces et des écoles du quartier ', k) END",
    "neighborhood": """CASE x4 WHEN 0 THEN 'Quartier Nord' WHEN 1 THEN 'Cité Sud' WHEN 2 THEN 'Cité Est'
        ELSE 'Bel appartement lumineux avec une vue dégagée' END""",
    "surface": "CAST(m2 AS DOUBLE)",
    "rooms": "CAST(rooms_n AS DOUBLE)",
    "bedrooms": "CAST(beds_n AS DOUBLE)",
    "bathrooms": "CAST(2 AS DOUBLE)",
    "floor": "CAST(k % 12 AS DOUBLE)",
    "furnished": "(x3 = 1)",
    "criteria": _pairs(
        "concat('surface=', m2, '.0')", "concat('rooms=', rooms_n, '.0')", "concat('bedrooms=', beds_n, '.0')",
        "'bathrooms=2.0'", "'property_type=Appartement'", "'condition=Ancien'", "concat('floor=', k % 12)",
        *(f"'{f}=' || {v}" for f, v in _FLAGS3.items()),
    ),
    "image_urls": f"concat('{SITE_3}/p/', k, '.jpg', {_many(SITE_3, 'p')})",
    "image_count": f"CAST(CASE WHEN {LONG} THEN 15 ELSE 1 END AS INTEGER)",
    "date_posted": """CAST(CASE x5 WHEN 1 THEN CAST(d AS DATE) - CAST(k % 20 + 1 AS INTEGER) WHEN 2 THEN CAST(d AS DATE) - 14
        WHEN 3 THEN CAST(d AS DATE) - 30 ELSE CAST(d AS DATE) END AS VARCHAR)""",
}
PORTAL_VALID = "true"

EXPECTED = {
    "classifieds": (CLASSIFIEDS, CLASSIFIEDS_VALID),
    "refline": (REFLINE, REFLINE_VALID),
    "portal": (PORTAL, PORTAL_VALID),
}


def expected(profile: str, columns: list[str] | None = None, validate: bool = True) -> str:
    """DuckDB SQL of the expected records of a profile."""
    fields, valid = EXPECTED[profile]
    chosen = columns or list(fields)
    select = ",\n ".join(f"{fields[c]} AS {c}" for c in chosen)
    return f"WITH f AS ({FACTS}) SELECT {select} FROM f" + (f" WHERE {valid}" if validate else "")
