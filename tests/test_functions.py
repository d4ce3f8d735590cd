import datetime as dt
import unicodedata
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listwright.functions import dates, text, urls, values


@pytest.mark.parametrize(
    "build, given_text, expected",
    [
        (values.number_of_digits, "250.50 TND", 25050.0),
        (values.number_plain, "250.000", 250.0),
        (values.number_plain, "25,000", 25000.0),
        (values.number_plain, "250 000", None),
        (values.number_dotted, "1.250.000", None),
        (values.number_dotted, "250,5", 250.5),
        (values.number_dotted, "١٢", 12.0),
        (values.number_spoken, "A partir de 250 000", 250000.0),
        (values.first_count, "10+", 10.0),
        (values.first_decimal, "120.5 m²", 120.5),
        (values.parse_boolean, "Non disponible", True),
        (values.parse_boolean, "Oui", True),
        (values.parse_boolean, "10", True),
        (values.parse_boolean, "Non", False),
        (values.criteria_key, "Nombre de chambres", "bedrooms"),
        (values.criteria_key, "Pièces", "pièces"),
        (values.criteria_key, "Pieces", "rooms"),
        (values.criteria_key, "Surface (m²)", "surface_m²"),
        (values.currency_code, "Dt", "DT"),
        (values.currency_code, "dt", "TND"),
        (values.currency_code_any_case, "euro", "EUR"),
        (values.normalise_category, " Terrain ", "land"),
        (values.normalise_category, "Ferme", "Ferme"),
        (dates.parse_posted, "2024-01-28T23:30:00-05:00", dt.date(2024, 1, 28)),
        (dates.parse_posted, "2024-01-28T23:30:00Z", dt.date(2024, 1, 28)),
        (dates.parse_posted, "2024-01-28 at noon", None),
        (dates.parse_posted, "20240125", dt.date(2024, 1, 25)),
        (dates.parse_posted, "2024-W04-7", dt.date(2024, 1, 28)),
        (dates.parse_posted, "January 25, 2024", dt.date(2024, 1, 25)),
        (dates.parse_posted, " 5/1/2024 ", dt.date(2024, 1, 5)),
        (dates.parse_posted, "31/02/2024", None),
        (dates.parse_posted, "N/A", None),
        (dates.parse_stored, "25/01/2024", None),
        (dates.parse_french, "05/01/85", dt.date(1985, 1, 5)),
        (dates.parse_french, "05/01/68", dt.date(2068, 1, 5)),
        (dates.parse_french, "05/01/2024", dt.date(2024, 1, 5)),
        (dates.parse_french, "05/01/224", None),
        (text.slug_path, "La Marsa/Sidi  Bou-Saïd", "la-marsa/sidi-bou-said"),
        (text.ascii_fold, "Équipée œuf m²", "Equipee uf m2"),
        (text.refline_label, "Parabole / TV !", "parabole / tv"),
        (text.portal_label, "État : l'annonceur*", "etat : lannonceur"),
    ],
)
def test_scalar_cases(one, build, given_text, expected):
    assert one(build, given_text) == expected


def test_relative_dates(one):
    as_of = F.lit("2024-03-31").cast("date")
    for written, day in {
        "il y a 3 jours": "2024-03-28", "il y a 2 semaines": "2024-03-17", "il y a 1 mois": "2024-03-01",
        "il y a 5 heures": "2024-03-31",
    }.items():
        assert str(one(lambda c: dates.parse_relative_french(c, as_of), written)) == day


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=20, max_size=40))
def test_fold_is_compatibility_decomposition(spark, samples):
    samples = [s.replace("\x00", "") for s in samples] + ["½ ﬁn … \U0001d400 ™ ال"]
    df = spark.createDataFrame([(s,) for s in samples], "t string").select("t", text.ascii_fold(F.col("t")).alias("f"))
    for row in df.collect():
        assert row.f == unicodedata.normalize("NFKD", row.t).encode("ascii", "ignore").decode()


def test_lines_are_normalised_like_single_labels(spark):
    lines = ["État  du\tbien", "***", "  ", "Café / Thé", "€", "x"]
    df = spark.createDataFrame([(lines,), ([],)], "lines array<string>")
    got = df.select(
        text.normalise_lines(F.col("lines"), text.PORTAL_KEEP).alias("bulk"), F.transform("lines", text.portal_label).alias("each")
    ).collect()
    assert all(r.bulk == r.each for r in got)


def test_resolve_url_like_the_standard_library(spark):
    base = "https://www.site.example"
    refs = ["a/b", "/a/../b", "?q=1", "#f", "", "//h/x", "mailto:x", "http://z/y", "../a", "./a/./b/..", "/x/?a=../b", "/a#b"]
    df = spark.createDataFrame([(r,) for r in refs], "t string").select("t", urls.resolve_url(F.col("t"), base).alias("u"))
    assert {r.t: r.u for r in df.collect()} == {r: urljoin(base, r) for r in refs}


def test_fold_of_texts_that_stay_or_turn_ascii(one):
    from listwright.functions.text import ascii_fold

    for given, folded in (("", ""), ("plain", "plain"), ("é²à", "e2a"), ("ﬁn ½ Œ", "fin 12 "), ("日本x", "x"), ("a b", "a b"), (None, None)):
        assert one(ascii_fold, given) == folded, given
