"""URL expressions: RFC 3986 parts by one pattern, normal form, resolution of relative references, and crawl filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Fixed values.
SKIPPED = "jpg jpeg png gif svg webp css js ico woff woff2 ttf zip tar gz mp4 mp3".split()
JS_DOMAINS = ["incometaxindia.gov.in"]
NOT_LINKS = ("#", "mailto:", "tel:", "javascript:")


def part(url: Column, which: str) -> Column:
    """scheme, authority, path, query or fragment of url; empty where it has none."""
    return F.regexp_extract(url, _PARTS, ["scheme", "authority", "path", "query", "fragment"].index(which) + 1)


def url_hash(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 16)


def domain_of(url: Column) -> Column:
    return F.lower(part(url, "authority"))


def normalize(url: Column) -> Column:
    """url without fragment and trailing slashes, scheme and authority in small letters."""
    bare = F.regexp_replace(url, "#.*$", "")
    scheme, authority, query = part(bare, "scheme"), part(bare, "authority"), part(bare, "query")
    whole = F.concat(
        F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(""),
        F.when(authority != "", F.concat(F.lit("//"), F.lower(authority))).otherwise(""),
        part(bare, "path"),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
    return F.regexp_replace(whole, "/+$", "")


def is_pdf(url: Column, content_type: Column | None = None) -> Column:
    found = F.lower(url).endswith(".pdf")
    return found if content_type is None else found | F.coalesce(content_type.contains("application/pdf"), F.lit(False))


def should_skip(url: Column) -> Column:
    """True for resources that are no pages, by the suffix of the path's last part."""
    suffix = F.lower(F.regexp_extract(part(url, "path"), r"[^/](\.[^./]+)/*$", 1))
    return suffix.isin(["." + s for s in SKIPPED])


def is_link(href: Column) -> Column:
    """Whether a stripped href leads to another page."""
    out = href != ""
    for p in NOT_LINKS:
        out = out & ~href.startswith(p)
    return out


def remove_dots(path: Column) -> Column:
    """path without "." and ".." segments (RFC 3986, 5.2.4)."""
    step = lambda acc, seg: F.when(seg == ".", acc).when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, seg))
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    slash = F.when(path.rlike(r"(^|/)\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), slash)


def join(base: Column, href: Column) -> Column:
    """href resolved against base."""
    scheme, authority, path = part(base, "scheme"), part(base, "authority"), part(base, "path")
    site = F.concat(scheme, F.lit("://"), authority)
    no_tail = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.substring(href, F.length(no_tail) + 1, F.length(href))
    folder = F.coalesce(F.nullif(F.regexp_extract(path, "^(.*/)[^/]*$", 1), F.lit("")), F.lit("/"))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, remove_dots(no_tail), tail))
        .when(href.startswith("?"), F.concat(site, path, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .otherwise(F.concat(site, remove_dots(F.concat(folder, no_tail)), tail))
    )


def url_title(url: Column) -> Column:
    """A title from the path: "/" as " > ", "-" as a blank, capitals; the url itself where the path is empty."""
    path = F.regexp_replace(part(url, "path"), "^/+|/+$", "")
    named = T.title_case(F.replace(F.replace(path, F.lit("-"), F.lit(" ")), F.lit("/"), F.lit(" > ")))
    return F.when(named == "", url).otherwise(named)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
