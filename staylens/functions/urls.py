"""URLs of hotel pages, file keys and folders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that a search keeps; ``order`` is set anew.
KEPT_PARAMETERS = ("ss",)


def page_key(url: Column, compat: bool = False) -> Column:
    """File name of a page: last path part without .html, hyphens as underscores. ``.vi.html`` pages get the same key as
    the crawler writes; compat keeps their .vi."""
    last = F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)
    stem = F.regexp_replace(last, r"\.html$", "") if compat else F.substring_index(last, ".", 1)
    return F.concat(F.translate(stem, "-", "_"), F.lit(".json"))


def page_url(key: Column, base: str) -> Column:
    return F.concat(F.lit(base), F.translate(F.regexp_replace(key, r"\.json$", ""), "_", "-"), F.lit(".html"))


def clean(href: Column, site: str) -> Column:
    """Without query, absolute."""
    cut = F.substring_index(F.substring_index(href, "?", 1), "#", 1)
    return F.when(F.startswith(cut, F.lit("http")), cut).otherwise(F.concat(F.lit(site), cut))


def rewrite_query(url: Column, order: str) -> Column:
    """The URL with only the kept parameters and the given order."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parameters = F.filter(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1).isin(*KEPT_PARAMETERS))
    return F.concat(
        F.regexp_extract(url, r"^[^?#]*", 0), F.lit("?"), F.array_join(F.concat(F.array_sort(parameters), F.array(F.lit(f"order={order}"))), "&")
    )


def folder_of(path: Column) -> Column:
    """Folder that a file lies in."""
    return F.element_at(F.split(F.translate(path, "\\", "/"), "/"), -2)


def is_range_folder(name: Column) -> Column:
    """Digits, a hyphen, digits."""
    return name.rlike(r"^[0-9-]*-[0-9-]*$") & name.rlike(r"\d")


def slug_title(slug: Column) -> Column:
    return F.initcap(F.translate(slug, "-_", "  "))


def property_count(text: Column) -> Column:
    found = F.regexp_extract(text, r"(?i)([\d,]+)\s+propert(?:y|ies)\s+found", 1)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("int")


def range_bucket(n: Column, size: int = 100, compat: bool = False) -> Column:
    """``0-50``, ``51-100``, then hundreds; compat calls the second one ``1-100``."""
    low = (F.floor((n - 1) / size) * size + 1).cast("long")
    start = low if compat else F.when(n <= size, F.lit(size // 2 + 1)).otherwise(low)
    return F.when(n <= size // 2, F.lit(f"0-{size // 2}")).otherwise(F.concat_ws("-", start.cast("string"), (low + size - 1).cast("string")))
