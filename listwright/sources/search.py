"""Search grids: start URLs of searches and the URLs of their result pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.text import lookup, portal_label, slug_path
from listwright.functions.urls import resolve_url
from listwright.settings import PORTAL, Site


def _known(table: dict[str, str], value: Column, what: str) -> Column:
    """Table value, or an error naming the unknown input."""
    valid = ", ".join(sorted(table))
    message = F.concat(F.lit(f"Unsupported {what} '"), value, F.lit(f"'. Expected one of: {valid}"))
    return F.coalesce(lookup(table, portal_label(value)), F.raise_error(message).cast("string"))


def transaction_code(value: Column) -> Column:
    """'vente', 'louer', ... -> sale / rent; unknown text is an error."""
    return _known(rules.TRANSACTIONS, value, "transaction")


def property_key(value: Column) -> Column:
    """Normalised property type; unknown text is an error."""
    return _known({k: k for k in rules.PROPERTY_TYPES}, value, "property type")


def property_category(key: Column) -> Column:
    return lookup({k: v[2] for k, v in rules.PROPERTY_TYPES.items()}, key)


def start_url(
    transaction: Column, property_type: Column, location: Column, level: Column, explicit: Column, site: Site = PORTAL
) -> Column:
    """Start URL of a search; an explicit URL wins, then the location path."""
    slugs = {f"{k}/{t}": v[i] for k, v in rules.PROPERTY_TYPES.items() for i, t in enumerate(("sale", "rent"))}
    slug = lookup(slugs, F.concat_ws("/", property_key(property_type), transaction_code(transaction)))
    level = F.coalesce(F.nullif(level, F.lit("")), F.lit(rules.DEFAULT_LEVEL))
    anywhere = location.isNull() | (location == "") | (level == rules.WHOLE_COUNTRY_LEVEL)
    return (
        F.when(explicit != "", resolve_url(explicit, site.base_url))
        .when(anywhere, F.concat(F.lit(f"{site.base_url}/fr/{rules.WHOLE_COUNTRY_LEVEL}/"), slug))
        .otherwise(F.concat(F.lit(f"{site.base_url}/fr/"), level, F.lit("/"), slug_path(location), F.lit("/"), slug))
    )


def search_grid(
    requests: DataFrame, transactions: list[str], property_types: list[str], site: Site = PORTAL
) -> DataFrame:
    """Every request (location, level, explicit_url) x transaction x property type.

    The two lists are arguments, so the product is an explode per request, not
    a join.
    """
    grid = requests.withColumn("transaction", F.explode(F.array(*map(F.lit, transactions)))).withColumn(
        "property_type", F.explode(F.array(*map(F.lit, property_types)))
    )
    url = start_url(
        F.col("transaction"), F.col("property_type"), F.col("location"), F.col("level"), F.col("explicit_url"), site
    )
    return grid.withColumns(
        {
            "start_url": url,
            "transaction_type": transaction_code(F.col("transaction")),
            "category": property_category(property_key(F.col("property_type"))),
        }
    )


def page_url(start: Column, page_no: Column, profile: str) -> Column:
    """URL of result page n in the shape of the profile."""
    n = page_no.cast("string")
    if profile == "classifieds":
        later = F.concat(start, F.lit("?page="), n)
    elif profile == "refline":
        later = F.concat(start, F.lit("?l=0&page="), n, F.lit("&tri=1"))
    elif profile == "portal":
        numbered = r":p:[0-9]+/?$"
        later = F.concat(F.regexp_replace(start, numbered, ""), F.lit(":p:"), n)
    else:
        raise ValueError(f"unknown profile: {profile}")
    return F.when(page_no <= 1, start).otherwise(later)


def page_urls(searches: DataFrame, pages: Column, profile: str) -> DataFrame:
    """One row per search and result page 1..pages."""
    numbered = searches.withColumn("page_no", F.explode(F.sequence(F.lit(1), pages.cast("int"))))
    return numbered.withColumn("page_url", page_url(F.col("start_url"), F.col("page_no"), profile))


# --- pages to searches --------------------------------------------------------------

SALT = 16  # groups that the pages of one prefix are dealt to


def search_path(url: Column) -> Column:
    """A URL without page number, query, fragment and closing slash; scheme and host in small letters."""
    plain = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"(:p:[0-9]+)?/*$", "")
    host = F.regexp_extract(plain, r"^[^/]*//[^/]*", 0)
    return F.concat(F.lower(host), F.substr(plain, F.length(host) + 1))


def _prefixes(path: Column) -> Column:
    """(depth, prefix) of a path: all of it, and what is left without its last parts."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("prefix")))


def with_search(pages: DataFrame, searches: DataFrame, key: str, url: str = "url", order: str = "search_id", columns: tuple[str, ...] = ("category", "transaction_type")) -> DataFrame:
    """(key, search columns) of each page: those of the search it was found by.

    That is the search whose start URL has the most path parts in common with
    the page's URL, all of its own among them; of searches with the same start
    URL the first by ``order``, then by the columns.  Pages of no search get NULL.  ``key`` names a
    page.

    Both sides are joined on the hash of a prefix: a search has one, a page as
    many as its URL has parts.  A search that most pages belong to is met in
    ``SALT`` groups, each with a copy of the search and a share of the pages.
    """
    wanted = [order, *columns]
    starts = searches.select(search_path(F.col("start_url")).alias("start"), F.struct(*wanted).alias("search")).groupBy("start").agg(F.min("search").alias("search"))
    starts = starts.select("start", "search", F.xxhash64("start").alias("h"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    own = pages.select(F.col(key).alias("_key"), search_path(F.col(url)).alias("_path"))
    emitted = own.select("_key", F.inline(F.coalesce(_prefixes(F.col("_path")), F.array()))).select(
        "_key", "depth", "prefix", F.xxhash64("prefix").alias("h2"), F.pmod(F.xxhash64("_key"), F.lit(SALT)).cast("int").alias("salt2"))
    met = emitted.join(starts, (F.col("h2") == F.col("h")) & (F.col("salt2") == F.col("salt")) & (F.col("prefix") == F.col("start")), "left")
    deepest = met.groupBy("_key").agg(F.max_by("search", F.when(F.col("search").isNotNull(), F.col("depth"))).alias("search"))
    found = deepest.select(F.col("_key").alias(key), *(F.col("search")[c].alias(c) for c in wanted))
    # a page without a URL has no prefix
    return found.unionByName(pages.where(search_path(F.col(url)).isNull()).select(key, *(F.lit(None).cast(searches.schema[c].dataType).alias(c) for c in wanted)))
