"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _without_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", done)
            .when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
            .otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.split(path, "/")
    kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array(F.lit("")), step)
    trailing = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(kept, "/"), trailing)


def resolve_url(href: Column, base_url: str) -> Column:
    """Absolute form of ``href`` on a site root such as ``https://host``."""
    scheme = base_url.split(":", 1)[0]
    tail = F.regexp_extract(href, r"[?#].*$", 0)
    path = F.regexp_extract(href, r"^[^?#]*", 0)
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    rooted = F.when(rooted.rlike(r"/\.{1,2}(/|$)"), _without_dot_segments(rooted)).otherwise(rooted)
    # most links are paths from the root with nothing to take apart; the tail's pattern ends at a line end
    one_piece = ~href.contains("?") & ~href.contains("#") | ~href.rlike(r"[\n\r\x{85}\x{2028}\x{2029}]")
    plain = href.startswith("/") & ~href.startswith("//") & ~href.contains("/.") & one_piece
    return (
        F.when(plain, F.concat(F.lit(base_url), href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(scheme + ":"), href))
        .when(path == "", F.concat(F.lit(base_url), tail))
        .otherwise(F.concat(F.lit(base_url), rooted, tail))
    )


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)
