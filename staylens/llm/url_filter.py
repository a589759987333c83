"""URL rules and a weighted URL vocabulary.

Terms are found with an Aho-Corasick automaton over the whole lower-cased URL behind its ``://`` (all of it where there is
none), query and fragment included; a hit counts only between boundaries (no letter or digit beside it). One strict term
rejects a URL, as do ``soft_limit`` different soft terms. Rules (host and path prefix) come first: a rule fits its host and
all subdomains if the path starts with the rule's path, and the longest rule (characters of host and path together) wins.

Nulls and URLs without ``://`` have an empty host and path, so no rule fits them; terms alone decide, and a null has none.
Repeated rows get equal results, extra columns are ignored, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.workers import map_batches

STRICT = ("casino", "porn", "xxx", "viagra", "escort", "sexcam", "slots", "hentai", "malware", "phishing")
SOFT = (
    "cheap", "pills", "free", "bets", "bet", "betting", "ads", "track", "tracker", "win", "winner", "bonus", "loan",
    "loans", "payday", "poker", "jackpot", "adult", "dating", "replica", "pharma", "pharmacy", "meds", "spam", "click",
    "popup", "banner", "warez", "crack", "torrent",
)
SOFT_LIMIT = 2
#: (action, host, path) of the rules of the contract.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
NAMES = ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
SCHEMA = "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int"


@lru_cache(maxsize=8)
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for words, hard in ((soft, False), (strict, True)):
        for w in words:
            found.add_word(w, (w, hard))
    found.make_automaton()
    return found


def term_hits(where: str, strict=STRICT, soft=SOFT) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms of a lower-cased string, checked for boundaries on both sides."""
    hard: set[str] = set()
    easy: set[str] = set()
    for end, (word, is_hard) in automaton(strict, soft).iter(where):
        start = end - len(word)
        if (start < 0 or not where[start].isalnum()) and (end + 1 >= len(where) or not where[end + 1].isalnum()):
            (hard if is_hard else easy).add(word)
    return hard, easy


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path as the contract cuts them."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    cut = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return host.translate(_ASCII_LOWER), tail[:cut]


def searched(url: str | None) -> str:
    """The part of a URL that terms are searched in, lower-cased."""
    before, found, rest = (url or "").partition("://")
    return (rest if found else before).lower()


class Rules:
    """Rules by host; a look-up walks the host's own suffixes, so its cost does not grow with the rules of other hosts."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for action, host, path in rules:
            self.by_host.setdefault(host, []).append((path, action))
        for of_host in self.by_host.values():
            of_host.sort(key=lambda x: -len(x[0]))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[int, str | None, str | None] = (-1, None, None)
        while host:
            for start, action in self.by_host.get(host, ()):
                if path.startswith(start):
                    if len(host) + len(start) > best[0]:
                        best = (len(host) + len(start), host + start, action)
                    break
            _, _, host = host.partition(".")
        return best[1], best[2]


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """One row per page: see SCHEMA; verdict is allow or block."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Rules(rules)
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = parts(url)
                rule, action = known.find(host, path)
                hard, easy = term_hits(searched(url), strict, soft)
                bad = bool(hard) or len(easy) >= soft_limit
                rows.append((host, path, rule, action or ("block" if bad else "allow"), len(hard), len(easy)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.string()] * 4 + [pa.int32()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *arrays], names=NAMES)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).transform(map_batches, judged, SCHEMA)


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query: the verdict on every page's url."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _terms(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


ORACLE = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE coalesce(url, '') END AS searched FROM pages),
h AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM h),
k(action, rh, rp) AS (VALUES {", ".join(str(r) for r in RULES)}),
m AS (SELECT page_id, rh || rp AS rule, action, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS n
      FROM p JOIN k ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp)),
t AS (SELECT page_id, regexp_extract_all(lower(searched), '[\\pL\\pN]+') AS w FROM u),
c AS (SELECT page_id, len(list_intersect(w, {_terms(STRICT)}))::INT AS strict_hits, len(list_intersect(w, {_terms(SOFT)}))::INT AS soft_hits FROM t)
SELECT p.page_id, p.host, p.path, m.rule,
  coalesce(m.action, CASE WHEN strict_hits > 0 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  strict_hits, soft_hits
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.n = 1 JOIN c ON c.page_id = p.page_id
"""
