"""Spreadsheets (.xlsx) read as the zipped XML that they are, so nothing but the standard library is needed."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
#: Hidden names of a sheet that goes on with another one's rows: that sheet, and the rows that stand before.
CONTINUED, ROWS_BEFORE = "continued_sheet", "rows_before"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _texts(item: ElementTree.Element) -> str:
    """All runs of a string, without its phonetic guides."""
    return "".join(t.text or "" for run in item for t in ([run] if run.tag == f"{_MAIN}t" else run.findall(f"{_MAIN}t") if run.tag == f"{_MAIN}r" else []))


def _column(reference: str) -> int:
    """Place of the column that a cell reference names, A being 0."""
    n = 0
    for letter in re.match("[A-Z]*", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _listed(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names and links of a workbook's sheets."""
    return [(s.get("name"), s.get(_LINK)) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]


def sheet_names(stream: BinaryIO) -> list[str]:
    with zipfile.ZipFile(stream) as book:
        return [name for name, _ in _listed(book)]


def sheet_parts(stream: BinaryIO) -> list[tuple[str, str, int]]:
    """For each sheet its name, the sheet that it continues (else itself) and how many rows of that stand before its head."""
    with zipfile.ZipFile(stream) as book:
        root = ElementTree.fromstring(book.read("xl/workbook.xml"))
        named = {(n.get("name"), n.get("localSheetId")): n.text or "" for n in root.iter(f"{_MAIN}definedName")}
        names = [s.get("name") for s in root.iter(f"{_MAIN}sheet")]
    parts = []
    for i, name in enumerate(names):
        of, before = named.get((CONTINUED, str(i))), named.get((ROWS_BEFORE, str(i)))
        parts.append((name, of[1:-1].replace('""', '"'), int(before)) if of and before else (name, name, 0))
    return parts


def sheet_rows(content: bytes | BinaryIO, sheet: str | int = 0) -> Iterator[list[str | None]]:
    """Cells of each row of a sheet, by its name or place, as text; the content as bytes or as a stream that can be sought in."""
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as book:
        found = _listed(book)
        link = found[sheet][1] if isinstance(sheet, int) else dict(found)[sheet]
        links = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        target = links[link]
        path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_texts(x) for x in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")]
        with book.open(path) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str | None] = []
                for cell in row.findall(f"{_MAIN}c"):
                    at = _column(cell.get("r") or "")
                    at = at if at >= 0 else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    value = cell.findtext(f"{_MAIN}v")
                    if cell.get("t") == "s" and value is not None:
                        value = shared[int(value)]
                    elif cell.get("t") == "inlineStr":
                        value = _texts(cell.find(f"{_MAIN}is"))
                    elif cell.get("t") == "b":
                        value = "True" if value == "1" else "False"
                    cells[at] = value
                yield cells
                row.clear()


def read_sheet(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A spreadsheet as text columns that its first row names; several files are read one after another, each by its own task.

    Cells beyond the named columns are dropped, absent ones are null.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    first = files.orderBy("path").limit(1).select("content").first()
    head = next(sheet_rows(bytes(first[0]), sheet), []) if first else []
    names = [n if n else f"column_{i + 1}" for i, n in enumerate(head)]
    if not names:
        return spark.createDataFrame([], "row string").drop("row")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = [(r + [None] * len(names))[: len(names)] for r in sheet_rows(content, sheet)][1:]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)

    return files.select(F.col("content")).mapInArrow(run, schema)
