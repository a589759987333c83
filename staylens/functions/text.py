"""Text cleaning as Column expressions. Word characters are letters, digits and the underscore of any script."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.binding import let
from staylens.functions.lexicons import ABBREVIATIONS

W = r"[\p{L}\p{N}_]"
NOT_BEFORE, NOT_AFTER = rf"(?<!{W})", rf"(?!{W})"
BOUNDARY = rf"(?:(?<={W})(?!{W})|(?<!{W})(?={W}))"
BLANK = r"(?U:\s)"
#: What emoji removal deletes: one character class, ranges included, so digits and some letters go with it.
EMOJI_CLASS = r"[!'-?D_\x{24C2}-\x{10FFFF}]+"
#: Emoji and text smileys alone.
EMOJI_ONLY = (
    r"(?:[\x{1F1E0}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0F}\x{200D}]|::?-?D+|:-?\)+|=\)+|:'-?\)+|;-?\)+|:\(+|:/-?\(|<3)+"
)


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, rf"^{BLANK}+|{BLANK}+$", "")


def safe_strip(x: Column) -> Column:
    return F.coalesce(strip(x.cast("string")), F.lit(""))


def collapse_blanks(x: Column) -> Column:
    """Runs of white space as one space; single spaces, the most, are left as they are."""
    return strip(F.regexp_replace(x, rf" {BLANK}+|(?U:[\s&&[^ ]]){BLANK}*", " "))


def remove_emoji(x: Column, compat: bool = True) -> Column:
    """Null becomes empty. compat deletes the whole class, else only emoji and smileys go."""
    return strip(F.regexp_replace(F.coalesce(x, F.lit("")), EMOJI_CLASS if compat else EMOJI_ONLY, ""))


def contains_emoji(x: Column, compat: bool = True) -> Column:
    return F.coalesce(x.rlike(EMOJI_CLASS if compat else EMOJI_ONLY), F.lit(False))


def collapse_chars(x: Column) -> Column:
    """Runs of one character become that character, legitimate doubles included; line breaks stay."""
    return F.regexp_replace(x, r"([^\n])\1+", "$1")


def collapse_words(x: Column) -> Column:
    """Runs of one word, whatever the case, become its first spelling."""
    return F.regexp_replace(x, rf"(?iu){NOT_BEFORE}({W}+){NOT_AFTER}(?:{BLANK}+\1{NOT_AFTER})+", "$1")


def collapse_repeats(x: Column) -> Column:
    return strip(collapse_chars(collapse_words(x)))


def has_repeats(x: Column) -> Column:
    """A word twice in a row, or a character four times."""
    twice = rf"(?iu){NOT_BEFORE}({W}+){NOT_AFTER}{BLANK}+\1{NOT_AFTER}"
    return F.coalesce(x.rlike(twice) | x.rlike(r"([^\n])\1{3,}"), F.lit(False))


def dominated_by_char(x: Column, least: int = 5, share: float = 0.7) -> Column:
    """One character makes up more than the share of a text of at least ``least`` characters."""
    most = F.aggregate(
        F.array_distinct(F.split(x, "")),
        F.lit(0),
        lambda a, c: F.greatest(a, F.when(c == "", 0).otherwise(F.length(x) - F.length(F.replace(x, c, F.lit(""))))),
    )
    return F.coalesce((F.length(x) >= least) & (most > F.length(x) * share), F.lit(False))


def is_empty(x: Column, least: int = 5) -> Column:
    """Null, blank, shorter than least, or without a letter or digit."""
    return x.isNull() | (F.length(strip(x)) < least) | ~x.rlike(r"[\p{L}\p{N}]")


def normalize(x: Column) -> Column:
    """Lower case words and basic punctuation; give NFC text (see nfc())."""
    kept = F.regexp_replace(remove_emoji(x), r"[^\p{L}\p{N}_\s.,;:?!]", " ")
    return F.regexp_replace(collapse_blanks(F.lower(kept)), rf"^{BLANK}*-{BLANK}*", "")


def nfc(df: DataFrame, column: str) -> DataFrame:
    """df with the column in Unicode NFC. Only rows that can change cross into Python: plain text has no marks and
    no characters with a canonical decomposition outside the Latin blocks."""
    may_change = F.coalesce(F.col(column).rlike(r"[\p{M}\x{0340}-\x{0387}\x{1F71}-\x{1FFD}\x{2000}-\x{2001}\x{2126}-\x{212B}\x{2329}-\x{232A}\x{F900}-\x{FAFF}\x{1100}-\x{11FF}]"), F.lit(False))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part[column] = [unicodedata.normalize("NFC", t) if isinstance(t, str) else t for t in part[column]]
            yield part

    return df.filter(~may_change).unionByName(df.filter(may_change).mapInPandas(run, df.schema))


def combine(*parts: Column) -> Column:
    """Non-blank parts, stripped and joined by a space; null if none is left."""
    blank_to_null = [F.nullif(strip(p), F.lit("")) for p in parts]
    return F.nullif(F.concat_ws(" ", *blank_to_null), F.lit(""))


def word_count(x: Column) -> Column:
    return F.size(F.filter(F.split(x, rf"{BLANK}+"), lambda t: t != "")).cast("long")


def _escape(key: str) -> str:
    return "".join(c if c.isalnum() or c in " _" else "\\" + c for c in key)


def _tried(keys: set[str]) -> str:
    """Pattern of keys that share their beginnings, the longest that fits first. A text is compared with 255 keys by way of the few
    letters that may come next, not with one key after the other."""
    ends, rest = "" in keys, sorted({k[0] for k in keys if k}, key=lambda c: (-max(len(k) for k in keys if k[:1] == c), c))
    branches = [_escape(c) + _tried({k[1:] for k in keys if k[:1] == c}) for c in rest] + ([""] if ends else [])
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def mapping_pattern(mapping: dict[str, str]) -> str:
    """All keys, longest first, between word boundaries: where every key begins (ends) with a letter or digit, nothing but the sign before
    (after) it is left to tell."""
    keys = {k.lower() for k in mapping}
    before = NOT_BEFORE if all(k[:1].isalnum() for k in keys) else BOUNDARY
    after = NOT_AFTER if all(k[-1:].isalnum() for k in keys) else BOUNDARY
    return rf"(?iu){before}{_tried(keys)}{after}"


#: Put around hits; texts that hold it are split at the hits instead.
_MARK = "\x01"


def replaced(x: Column, mapping: dict[str, str] | None = None) -> Column:
    """(text, n): apply_mapping() and count_replacements() by one search.

    The hits are marked and the text is split at the marks, so it is searched once; a text that holds the mark itself is split at the hits
    and both lists are woven together.
    """
    mapping = ABBREVIATIONS if mapping is None else mapping
    if not mapping:
        return F.struct(x.alias("text"), F.lit(0).cast("long").alias("n"))
    pattern = mapping_pattern(mapping)
    table = F.create_map(*[F.lit(v) for k, word in mapping.items() for v in (k.lower(), word)])
    first = lambda h: F.substring(h, 1, 1)

    def cased(hit: Column) -> Column:
        word = F.coalesce(F.try_element_at(table, F.lower(hit)), hit)
        capital = F.concat(F.upper(first(word)), F.lower(F.substring(word, 2, 1_000_000)))
        is_upper = (F.upper(hit) == hit) & (F.lower(hit) != hit)
        return F.when(is_upper, F.upper(word)).when((F.upper(first(hit)) == first(hit)) & (F.lower(first(hit)) != first(hit)), capital).otherwise(word)

    def joined(parts: Column) -> Column:
        text = F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, cased(p)).otherwise(p)), "")
        return F.struct(text.alias("text"), F.floor((F.size(parts) - 1) / 2).cast("long").alias("n"))

    marked = let(F.split(F.regexp_replace(x, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1), joined)
    found = F.regexp_extract_all(x, F.lit(pattern), F.lit(0))
    gaps = F.split(x, pattern, -1)
    woven = F.array_join(F.zip_with(gaps, F.transform(found, cased), lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")
    none = F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n"))
    return F.when(x.isNull(), none).when(F.contains(x, F.lit(_MARK)), F.struct(woven.alias("text"), F.size(found).cast("long").alias("n"))).otherwise(marked)


def apply_mapping(x: Column, mapping: dict[str, str] | None = None) -> Column:
    """Abbreviations written out in one pass from left to right; what comes out is not looked at again.

    Upper-case and capitalised hits keep their case.
    """
    return replaced(x, mapping)["text"]


def count_replacements(x: Column, mapping: dict[str, str] | None = None) -> Column:
    return F.coalesce(F.regexp_count(x, F.lit(mapping_pattern(ABBREVIATIONS if mapping is None else mapping))), F.lit(0)).cast("long")


def stay_duration(x: Column) -> Column:
    """``{n} đêm`` where a number stands before it, else the stripped text; null becomes empty."""
    nights = F.regexp_extract(F.lower(x), rf"(\d+){BLANK}*đêm", 1)
    return F.when(x.isNull(), "").when(nights != "", F.concat(nights, F.lit(" đêm"))).otherwise(strip(x))


def nights(x: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(x), rf"(\d+){BLANK}*đêm", 1).try_cast("int"), F.lit(-1))


def segment(x: Column, lexicon: tuple[str, ...]) -> Column:
    """Longest-match segmentation by a lexicon of multi-word terms: their words are joined by underscores.

    An approximation of a statistical segmenter, which can be plugged in with any Arrow UDF instead.
    """
    return segmented(x, lexicon)["text"]


def segmented(x: Column, lexicon: tuple[str, ...]) -> Column:
    """(text, n): segment() and the number of terms that it has joined, by one search."""
    return replaced(x, {w: w.replace(" ", "_") for w in lexicon if " " in w})


def word_tokens(x: Column, least: int = 2) -> Column:
    """Lower-case runs of at least ``least`` word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(rf"{W}{{{least},}}"), F.lit(0))


def label_count(n: Column, compat: bool = False) -> Column:
    """4500 as 4.5K, 1234567 as 1.23M; compat repeats the unit and keeps the zeros."""

    def unit(value: Column, letter: str) -> Column:
        text = F.format_string("%.2f", value)
        if compat:
            return F.concat(text, F.lit(letter * 2))
        return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit(letter))

    n = n.cast("double")
    return F.when(n >= 1e6, unit(n / 1e6, "M")).when(n >= 1e3, unit(n / 1e3, "K")).otherwise(n.cast("long").cast("string"))
