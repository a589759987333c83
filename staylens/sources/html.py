"""Hotel and review records from landed HTML: markers in the page's own attributes, read without executing anything."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from staylens.schema import CATEGORIES, HOTEL

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Labels of the sub-scores.
SCORE_LABELS = {
    "nhân viên phục vụ": "service_staff",
    "tiện nghi": "amenities",
    "sạch sẽ": "cleanliness",
    "thoải mái": "comfort",
    "đáng giá tiền": "value_for_money",
    "địa điểm": "location",
    "wifi miễn phí": "free_wifi",
}


class Node:
    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def text(self) -> str:
        return " ".join(" ".join(c if isinstance(c, str) else c.text() for c in self.children).split())

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def marked(self, mark: str) -> list[Node]:
        return [n for n in self.walk() if n.attributes.get("data-testid") == mark]

    def said(self, mark: str) -> str | None:
        found = self.marked(mark)
        return found[0].text() or None if found else None


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Node("", {})]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs))
        self.stack[-1].children.append(node)
        if tag not in _VOID and len(self.stack) < 400:
            self.stack.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        if self.stack[-1].tag not in ("script", "style"):
            self.stack[-1].children.append(data)


def tree(page: str) -> Node:
    parser = _Tree()
    parser.feed(page)
    parser.close()
    return parser.stack[0]


def _number(text: str | None) -> float | None:
    try:
        return float((text or "").replace(",", ".").split()[-1])
    except (ValueError, IndexError):
        return None


def sub_scores(root: Node) -> dict[str, float | None]:
    """Scores by category: a label that equals a known one, else one that contains it; the first of a category counts."""
    out: dict[str, float | None] = dict.fromkeys(CATEGORIES)
    for node in root.marked("review-subscore"):
        words = unicodedata.normalize("NFC", node.text()).lower().rsplit(" ", 1)
        if len(words) == 2:
            name = SCORE_LABELS.get(words[0]) or next((c for label, c in SCORE_LABELS.items() if label in words[0]), None)
            if name and out[name] is None:
                out[name] = _number(words[1])
    return out


def review_card(card: Node) -> dict | None:
    """A review, or None where the writer, the stay or the content is missing."""
    avatar, stay = card.marked("review-avatar"), card.marked("review-stay-info")
    content = [m for mark in ("review-title", "review-positive-text", "review-negative-text") for m in card.marked(mark)]
    if not avatar or not stay or not content:
        return None
    names = [n.text() for n in avatar[0].walk() if not any(isinstance(c, Node) for c in n.children) and n.text()]
    score = card.marked("review-score")
    hidden = next((n for s in score for n in s.walk() if n.attributes.get("aria-hidden") == "true"), score[0] if score else None)
    info = [n.text() for n in stay[0].walk() if n.tag in ("li", "span", "div") and n.text()] + [None] * 3
    image = next((n.attributes.get("src") for n in avatar[0].walk() if n.tag == "img"), None)
    return {
        "reviewer": {"name": names[0] if names else None, "country": names[1] if len(names) > 1 else None, "avatar": image},
        "review": {
            "date": card.said("review-date"),
            "rating": card.said("review-title"),
            "score": _number(hidden.text()) if hidden else None,
            "room_type": info[0],
            "stay_duration": info[1],
            "group_type": info[2],
            "comment_positive": card.said("review-positive-text"),
            "comment_negative": card.said("review-negative-text"),
        },
    }


def hotel(page: str | None) -> dict:
    root = tree(page or "")
    titles = [n.text() for n in root.walk() if n.tag in ("h1", "h2", "title") and n.text()]
    reviews = [r for r in map(review_card, root.marked("review-card")) if r]
    return {
        "name": root.said("property-name") or root.said("title") or (titles[0] if titles else None),
        "address": root.said("address"),
        "description": root.said("property-description"),
        "rating": root.said("review-score-value"),
        "total_rating": root.said("review-count"),
        "evaluation_categories": sub_scores(root),
        "reviews": reviews,
    }


def extract_hotels(pages: DataFrame, column: str = "html") -> DataFrame:
    """The other columns of pages, and ``hotel`` (see schema.HOTEL) for each."""
    rest = [f for f in pages.schema.fields if f.name != column]
    schema = T.StructType([*rest, T.StructField("hotel", HOTEL)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_type(HOTEL)
        for batch in batches:
            found = pa.array([hotel(h) for h in batch.column(column).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), found], names=schema.names)

    return pages.mapInArrow(run, schema)


def name_from_title(title: Column) -> Column:
    """Hotel's name in a title ``... về NAME - ...``."""
    return F.regexp_replace(F.trim(F.regexp_extract(title, r"về\s+([^–\-]+)", 1)), r"[.,\s]+$", "")


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
