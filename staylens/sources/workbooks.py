"""Workbooks of several sheets (.xlsx) as a Spark data source: a partition for each sheet that is read, a task for each workbook
that is written.

Rows have the schema WORKBOOK: the workbook's name, the sheet and its place, the row's number from 0 (the head) and its cells as text.
A task writes its workbooks row by row to a folder of its own job; only the commit of the job puts them in their place, so a lost
task or a failed job leaves nothing behind and a repeated one replaces its workbooks whole.
"""

from __future__ import annotations

import posixpath
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as Win
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from staylens.sources.sheets import CONTINUED, ROWS_BEFORE, sheet_parts, sheet_rows

WORKBOOK = "file string, sheet string, place int, row long, cells array<string>"
#: Rows of a sheet at most, by the format. A longer table goes on in sheets of the same head, whose hidden names say what they continue.
SHEET_ROWS = 1_048_576
_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
_LINKS = "http://schemas.openxmlformats.org/package/2006/relationships"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def letters(place: int) -> str:
    """The name of a column, A being 0."""
    name = ""
    place += 1
    while place:
        place, rest = divmod(place - 1, 26)
        name = chr(65 + rest) + name
    return name


def printable(text: str) -> str:
    """text without the control characters that XML cannot hold."""
    return "".join(c for c in text if c >= " " or c in "\t\n\r") if any(c < " " for c in text) else text


class Workbook:
    """A workbook that is written row by row to a stream; its sheets come one after the other."""

    def __init__(self, stream, most: int = SHEET_ROWS):
        self.book, self.most, self.names = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED), most, []
        self.continued: dict[int, tuple[str, int]] = {}
        self.sheet, self.part, self.rows, self.head = None, None, 0, None

    def _begin(self, name: str) -> None:
        self._end()
        self.names.append(name)
        self.part = self.book.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w", force_zip64=True)
        self.part.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.rows = 0

    def _end(self) -> None:
        if self.part:
            self.part.write(b"</sheetData></worksheet>")
            self.part.close()
            self.part = None

    def _put(self, cells: list[str | None]) -> None:
        self.rows += 1
        inner = "".join(
            f'<c r="{letters(i)}{self.rows}" t="inlineStr"><is><t xml:space="preserve">{escape(printable(c))}</t></is></c>' for i, c in enumerate(cells) if c is not None
        )
        self.part.write(f'<row r="{self.rows}">{inner}</row>'.encode())

    def add(self, sheet: str, cells: list[str | None]) -> None:
        """A row; the first one of a sheet is its head."""
        if sheet != self.sheet:
            self._begin(sheet)
            self.sheet, self.head, self.parts = sheet, cells, 1
        elif self.rows >= self.most:
            self.parts += 1
            self._begin(f"{sheet} ({self.parts})")
            self.continued[len(self.names) - 1] = (sheet, (self.parts - 1) * (self.most - 1))
            self._put(self.head)
        self._put(cells)

    def close(self) -> None:
        self._end()
        numbered = list(enumerate(self.names, 1))
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_KIND}.worksheet+xml"/>' for i, _ in numbered)
        sheets = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in numbered)
        doubled = lambda name: escape(name.replace('"', '""'))
        hidden = "".join(
            f'<definedName name="{CONTINUED}" localSheetId="{i}" hidden="1">"{doubled(name)}"</definedName><definedName name="{ROWS_BEFORE}" localSheetId="{i}" hidden="1">{n}</definedName>'
            for i, (name, n) in self.continued.items()
        )
        sheets = f"<sheets>{sheets}</sheets>" + (f"<definedNames>{hidden}</definedNames>" if hidden else "")
        links = "".join(f'<Relationship Id="rId{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in numbered)
        files = {
            "[Content_Types].xml": f'<Types xmlns="{_TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_KIND}.sheet.main+xml"/>{parts}</Types>',
            "_rels/.rels": f'<Relationships xmlns="{_LINKS}"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}">{sheets}</workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_LINKS}">{links}</Relationships>',
        }
        for name, text in files.items():
            self.book.writestr(name, _HEAD + text)
        self.book.close()


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that the driver and all executors reach, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else posixpath.abspath(path))


@dataclass
class SheetPartition(InputPartition):
    path: str
    place: int
    sheet: str
    joined: int
    before: int


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.joined = options["path"], options.get("joined", "false").lower() == "true"

    def partitions(self) -> list[SheetPartition]:
        """A partition for each sheet; the driver reads the names of the sheets alone."""
        store, path = file_system(self.folder)
        listed = [path] if store.get_file_info(path).is_file else [f.path for f in store.get_file_info(fs.FileSelector(path))]
        found = []
        for name in sorted(x for x in listed if x.lower().endswith(".xlsx")):
            with store.open_input_file(name) as stream:
                first: dict[str, int] = {}
                for i, (sheet, of, before) in enumerate(sheet_parts(stream)):
                    first.setdefault(sheet, i)
                    found.append(SheetPartition(name, i, of, first[of], before) if self.joined else SheetPartition(name, i, sheet, i, 0))
        return found

    def read(self, partition: SheetPartition | None) -> Iterator[tuple]:
        if partition is None:  # what Spark reads where there are no partitions
            return
        store, _ = file_system(self.folder)
        file = posixpath.basename(partition.path).removesuffix(".xlsx")
        with store.open_input_file(partition.path) as stream:
            for row, cells in enumerate(sheet_rows(stream, partition.place)):
                if row or not partition.before:  # the head stands once
                    yield file, partition.sheet, partition.joined, partition.before + row, cells


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WorkbookWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.folder, self.job, self.most = options["path"], uuid.uuid4().hex, int(options.get("sheetRows", SHEET_ROWS))

    def _pending(self, path: str) -> str:
        return f"{path}/_pending-{self.job}"

    def write(self, rows: Iterator) -> Written:
        """Rows of a workbook have to come together, by sheet."""
        store, path = file_system(self.folder)
        store.create_dir(self._pending(path), recursive=True)
        done, name, book, stream = [], None, None, None
        for r in rows:
            if r["file"] != name:
                if book:
                    book.close()
                    stream.close()
                name, place = r["file"], f"{self._pending(path)}/{uuid.uuid4().hex}"
                stream = store.open_output_stream(place)
                book = Workbook(stream, self.most)
                done.append((place, name))
            book.add(r["sheet"], r["cells"])
        if book:
            book.close()
            stream.close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = file_system(self.folder)
        for message in messages:
            for place, name in message.files if message else []:
                store.move(place, f"{path}/{name}.xlsx")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, path = file_system(self.folder)
        if store.get_file_info(self._pending(path)).type != fs.FileType.NotFound:
            store.delete_dir(self._pending(path))


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return WORKBOOK

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)

    def writer(self, schema, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(self.options)


def read_workbooks(spark: SparkSession, path: str, joined: bool = False) -> DataFrame:
    """All sheets of a workbook or of those of a folder, see WORKBOOK. ``joined`` gives the rows of a table that goes on in further
    sheets as those of its first one, numbered through and with one head; each sheet is still the work of its own task."""
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook").option("joined", joined).load(path)


def write_workbooks(sheets: dict[str, DataFrame], path: str, order: dict[str, tuple[str, ...]], by: str | None = None, name: str = "report", sheet_rows: int = SHEET_ROWS) -> None:
    """Tables as the sheets of one workbook, or of one for each value of the column ``by``, which all of them have.

    Rows are sorted by the columns of ``order``, which make it total. A workbook is one file and so one task, which streams it;
    many are written at once. Without ``by`` a table without rows is a sheet with a head alone.
    """
    spark = next(iter(sheets.values())).sparkSession
    spark.dataSource.register(WorkbookSource)
    parts = []
    for place, (sheet, df) in enumerate(sheets.items()):
        columns = [c for c in df.columns if c != by]
        head = F.array(*map(F.lit, columns)).alias("cells")
        file = F.regexp_replace(F.coalesce(F.col(by).cast("string"), F.lit("null")), "[/\\\\]", "_") if by else F.lit(name)
        rows = df.select(file.alias("file"), F.array(*[F.col(f"`{c}`").cast("string") for c in columns]).alias("cells"), *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order[sheet])])
        within = Win.partitionBy("file").orderBy(*[f"order_{i}" for i in range(len(order[sheet]))])
        own = rows.select("file", F.row_number().over(within).cast("long").alias("row"), "cells")
        heads = rows.select("file").distinct() if by else spark.range(1).select(F.lit(name).alias("file"))
        both = own.unionByName(heads.select("file", F.lit(0).cast("long").alias("row"), head))
        parts.append(both.select("file", F.lit(sheet).alias("sheet"), F.lit(place).alias("place"), "row", "cells"))
    every = reduce(DataFrame.unionByName, parts)
    dealt = every.repartition("file").sortWithinPartitions("file", "place", "row")
    dealt.write.format("workbook").option("sheetRows", sheet_rows).mode("append").save(path)
