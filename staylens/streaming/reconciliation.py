"""What has to be fetched again, kept up to date by a stream of what happened to urls.

Each url has its state: whether it is listed, was fetched, failed or timed out. An event changes it, and a change of what follows
from it (see operators.links.reconcile, the batch operator over all events) is emitted with its number; nothing else is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What an event says of its url.
KINDS = ("listed", "ok", "error", "late")
CHANGES = "province string, url string, number long, type string"


def outcome(listed: bool, ok: bool, error: bool, late: bool, variant: str) -> str | None:
    """The type that the flags lead to, None where nothing has to be done."""
    missing = listed and not ok
    if variant == "current":
        return "Error" if error else "Missing" if missing and not late else None
    return "Timeout" if late and (error or missing) else "Error" if error else "Missing" if missing else None


class Reconciler(StatefulProcessor):
    """State of a url: its flags, the last type emitted and how many changes there were."""

    def __init__(self, variant: str = "current"):
        self.variant = variant

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("url", "listed boolean, ok boolean, error boolean, late boolean, type string, number long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        flags, kind, number = [False] * 4, None, 0
        if self.state.exists():
            *flags, kind, number = self.state.get()
        for part in rows:
            seen = set(part["kind"])
            flags = [f or k in seen for f, k in zip(flags, KINDS, strict=True)]
        now = outcome(*flags, self.variant)
        changed = now != kind
        self.state.update((*flags, now, number + changed))
        if changed:
            yield pd.DataFrame({"province": [key[0]], "url": [key[1]], "number": [number + 1], "type": [now]})

    def close(self) -> None:
        pass


def changes(events: DataFrame, variant: str = "current") -> DataFrame:
    """CHANGES of a stream of events (province, url, kind), each url's numbered from 1; a null type says that it is settled.

    Needs the RocksDB state store (see STATE_STORE).
    """
    known = events.filter(F.col("kind").isin(*KINDS) & F.col("province").isNotNull() & F.col("url").isNotNull())
    return known.groupBy("province", "url").transformWithStateInPandas(Reconciler(variant), CHANGES, "Append", "None")


STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def standing(emitted: DataFrame) -> DataFrame:
    """(province, url, type) of what has to be fetched again, from the changes emitted so far; those of a repeated batch count once."""
    last = emitted.groupBy("province", "url").agg(F.max_by("type", "number").alias("type"))
    return last.filter("type IS NOT NULL")
