"""Site settings: everything about a source that is configuration, not logic."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Site:
    """One listing site.

    ``hash_prefix`` starts generated listing ids, ``title_suffix`` is the site
    name cut from ``<title>`` texts ("Flat - SiteName" becomes "Flat").
    """

    name: str
    domain: str
    base_url: str
    start_url: str
    title_suffix: str
    hash_prefix: str = "hash_"
    file_prefix: str = "listings"


# Neutral defaults; pass your own Site objects for real sources.
CLASSIFIEDS = Site(
    name="classifieds",
    domain="classifieds.example",
    base_url="https://www.classifieds.example",
    start_url="https://www.classifieds.example/listing/c/Immobilier",
    title_suffix="Classifieds",
    hash_prefix="hash_",
    file_prefix="classifieds",
)
REFLINE = Site(
    name="refline",
    domain="refline.example",
    base_url="https://www.refline.example",
    start_url="https://www.refline.example/immo/immobilier",
    title_suffix="Refline",
    hash_prefix="refline_hash_",
    file_prefix="refline",
)
PORTAL = Site(
    name="portal",
    domain="portal.example",
    base_url="https://www.portal.example",
    start_url="https://www.portal.example/fr/sc/appartements-a-vendre",
    title_suffix="Portal",
    hash_prefix="portal_hash_",
    file_prefix="portal",
)

SITES = {site.name: site for site in (CLASSIFIEDS, REFLINE, PORTAL)}
