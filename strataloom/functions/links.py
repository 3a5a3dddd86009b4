"""Links and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.functions.text import stripped, text_or_empty

# Forms of arXiv identifiers, and the resolver of DOIs.
OLD_ARXIV = r"(?i)arxiv\.org/(?:abs|pdf|html)/([a-z-]+/[0-9]{7})"
NEW_ARXIV = r"([0-9]{4}\.[0-9]{4,5})"
DOI_HOST = "https://doi.org/"
# Names under which the local provider is asked for.
LOCAL_PROVIDER = ["localkimi", "local-kimi", "lk"]


def arxiv_id(link: Column) -> Column:
    """The arXiv identifier, without version, that a link or a bare identifier names; else empty."""
    link = stripped(text_or_empty(link))
    old, new = F.regexp_extract(link, OLD_ARXIV, 1), F.regexp_extract(link, NEW_ARXIV, 1)
    meant = link.rlike(r"(?i)arxiv\.org") | link.rlike("(?i)^arxiv:") | link.rlike(r"^[0-9]{4}\.[0-9]{4,5}(?:v[0-9]+)?$")
    return F.when(old != "", old).when(meant, new).otherwise("")


def normalize_link(link: Column) -> Column:
    """A link to join on: a bare DOI gets its resolver, http(s) links stay, nothing is empty."""
    link = stripped(text_or_empty(link))
    return F.when((link == "") | link.startswith("http://") | link.startswith("https://"), link).otherwise(F.concat(F.lit(DOI_HOST), link))


def chat_url(base: Column) -> Column:
    """The chat completions endpoint below a base URL, appended once."""
    base = F.regexp_replace(text_or_empty(base), "/+$", "")
    return F.when(base.endswith("/chat/completions"), base).otherwise(F.concat(base, F.lit("/chat/completions")))


def url_path(url: Column) -> Column:
    """The path of a URL, without query and fragment."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)


def is_network_first(path: Column) -> Column:
    """Data, feeds and generated pages are fetched before the cache is asked."""
    page = (path.contains("/daily/") | path.contains("/weekly/")) & path.endswith(".html")
    return path.endswith(".json") | path.endswith(".xml") | path.contains("/data/") | page


def served(path: Column, answered: Column, cached: Column) -> Column:
    """Where a guarded request's answer comes from: `network`, `cache` or `error`.

    What is fetched first falls to the cache where the network fails; other paths ask the cache first.
    """
    fresh = F.when(answered, "network").when(cached, "cache")
    kept = F.when(cached, "cache").when(answered, "network")
    return F.coalesce(F.when(is_network_first(path), fresh).otherwise(kept), F.lit("error"))


def is_stored(path: Column, answered: Column, cached: Column) -> Column:
    """Whether the answer is put into a cache: all that came well from the network."""
    return F.coalesce(answered, F.lit(False)) & (served(path, answered, cached) == "network")


def is_guarded(method: Column, url: Column, own: str) -> Column:
    """Requests that the cache serves at all: GET, same origin."""
    return (method == "GET") & (origin(url) == own)


def provider_name(name: Column) -> Column:
    name = F.lower(stripped(text_or_empty(name)))
    return F.when(name.isin(LOCAL_PROVIDER), "local").otherwise(name)


def without_docs(path: Column) -> Column:
    """Every docs/ removed; null where nothing is left."""
    return F.nullif(F.replace(text_or_empty(path), F.lit("docs/"), F.lit("")), F.lit(""))


def article_id(title: Column, doi: Column, link: Column) -> Column:
    """The first twelve hex digits of the MD5 of title and DOI, or link without a DOI."""
    place = F.coalesce(F.nullif(doi, F.lit("")), link, F.lit(""))
    return F.substring(F.md5(F.concat(text_or_empty(title), place)), 1, 12)
