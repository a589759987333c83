"""A log of urls that runs append to, as a Spark data source with commit and abort.

Each run has a folder of its own name. Tasks write to a folder of their job beside it, which only the job's commit moves into
place: a lost task or a failed job leaves nothing, and a run that is repeated replaces its folder, so each url of it is there once.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from staylens.sources.workbooks import file_system

LOG = "run string, url string"


def _named(run: str) -> str:
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError("a run is named by letters, digits, dots and hyphens")
    return run


@dataclass
class LogPartition(InputPartition):
    run: str
    path: str


class LogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]

    def partitions(self) -> list[LogPartition]:
        """A partition for each file of a run that is in place."""
        store, path = file_system(self.folder)
        listed = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        return [LogPartition(m[1], f.path) for f in sorted(listed, key=lambda f: f.path) if (m := re.search(r"/run=([^/]+)/[^/]+\.txt$", f.path))]

    def read(self, partition: LogPartition | None) -> Iterator[tuple[str, str]]:
        if partition is None:  # what Spark reads where there are no partitions
            return
        store, _ = file_system(self.folder)
        with store.open_input_stream(partition.path) as stream:
            rest = b""
            while part := stream.read(1 << 20):
                *lines, rest = (rest + part).split(b"\n")
                for line in lines:
                    yield partition.run, line.decode()


@dataclass
class Done(WriterCommitMessage):
    file: str | None


class LogWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.folder, self.run, self.job = options["path"], options["run"], uuid.uuid4().hex
        _named(self.run)

    def write(self, rows: Iterator) -> Done:
        store, path = file_system(self.folder)
        pending = f"{path}/_pending-{self.job}"
        store.create_dir(pending, recursive=True)
        name = f"{uuid.uuid4().hex}.txt"
        with store.open_output_stream(f"{pending}/{name}") as stream:
            for row in rows:
                stream.write(row["url"].replace("\n", " ").encode() + b"\n")
        return Done(name)

    def commit(self, messages: list[Done | None]) -> None:
        """The files of tasks that were committed make up the run; others of the job, of tasks that ran twice, go."""
        store, path = file_system(self.folder)
        pending, place = f"{path}/_pending-{self.job}", f"{path}/run={self.run}"
        store.create_dir(pending, recursive=True)
        kept = {m.file for m in messages if m}
        for f in store.get_file_info(fs.FileSelector(pending)):
            if posixpath.basename(f.path) not in kept:
                store.delete_file(f.path)
        if store.get_file_info(place).type != fs.FileType.NotFound:
            store.delete_dir(place)
        store.move(pending, place)

    def abort(self, messages: list[Done | None]) -> None:
        store, path = file_system(self.folder)
        pending = f"{path}/_pending-{self.job}"
        if store.get_file_info(pending).type != fs.FileType.NotFound:
            store.delete_dir(pending)


class RunLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "run_log"

    def schema(self) -> str:
        return LOG

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def writer(self, schema, overwrite: bool) -> LogWriter:
        return LogWriter(self.options)


def append_run(urls: DataFrame, path: str, run: str) -> None:
    """The urls (column url, nulls left out) as the log's run of that name."""
    urls.sparkSession.dataSource.register(RunLog)
    rows = urls.filter("url IS NOT NULL").selectExpr(f"'{_named(run)}' AS run", "url")
    rows.write.format("run_log").option("run", run).mode("append").save(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(run, url) of all runs in place."""
    spark.dataSource.register(RunLog)
    return spark.read.format("run_log").load(path)
