"""Incremental cataloguing: new files of a lake are described as they arrive."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from colonnade.plans.catalog import build_catalog
from colonnade.session import shared_folder, stage
from colonnade.sources.lake import with_names

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
ARRIVED_SCHEMA = "path string, modificationTime timestamp, length long, sidecar string, again boolean"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Mates(StatefulProcessor):
    """Brings the two files of a name together in whatever batches they arrive.

    The state of a name is its data file and its sidecar.  A data file goes out with its sidecar as soon as both are
    there.  Without one it goes out at once, or when ``wait_ms`` have passed; should the sidecar come after that, the
    data file goes out once more, marked ``again``.  Files of other names go through and leave no state.
    """

    def __init__(self, wait_ms: int) -> None:
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.data = handle.getValueState("data", "path string, modificationTime timestamp, length long, sent boolean")
        self.sidecar = handle.getValueState("sidecar", "path string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out, fresh, arrived = [], False, False
        data = self.data.get() if self.data.exists() else None
        for row in pd.concat(list(rows)).sort_values("modificationTime").itertuples(index=False):  # the files of one name
            file = (row.path, row.modificationTime.to_pydatetime(), int(row.length))
            if row.kind == "data":
                data, fresh = (*file, False), True
            elif row.kind == "sidecar":
                self.sidecar.update((row.path,))
                arrived = True
            else:
                out.append((*file, None, False))
        if data and (fresh or arrived):
            for timer in list(self.handle.listTimers()) if self.wait_ms else ():
                self.handle.deleteTimer(timer)
            sidecar = self.sidecar.get()[0] if self.sidecar.exists() else None
            send = sidecar is not None or self.wait_ms == 0
            if send:
                out.append((*data[:3], sidecar, bool(data[3])))
            else:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
            self.data.update((*data[:3], send))
        yield _frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        data = self.data.get()
        self.data.update((*data[:3], True))
        yield _frame([(*data[:3], None, False)])

    def close(self) -> None:
        pass


def _frame(rows: Iterable[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["path", "modificationTime", "length", "sidecar", "again"]).astype(
        {"modificationTime": "datetime64[ns]", "length": "int64", "again": "bool"}
    )


def with_mates(files: DataFrame, wait_seconds: float = 0) -> DataFrame:
    """Stream of the files to describe, each data file with its sidecar: (path, modificationTime, length, sidecar, again).

    The query that runs it needs the RocksDB state store.
    """
    ends = F.regexp_extract("path", r"_(data|metadata)\.(csv|CSV)$", 1)
    named = files.select(
        "path", "modificationTime", "length",
        F.when(ends == "data", "data").when(ends == "metadata", "sidecar").otherwise("other").alias("kind"),
        F.regexp_replace("path", r"_(?:data|metadata)\.(csv|CSV)$", "_*.$1").alias("name"),
    )
    return named.groupBy("name").transformWithStateInPandas(
        Mates(int(wait_seconds * 1000)), outputStructType=ARRIVED_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime" if wait_seconds else "None",
    )


def watch(
    spark: SparkSession,
    root: str,
    output: str,
    reference_lists: DataFrame,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files: int = 1000,
    wait_seconds: float = 0,
    **options,
) -> StreamingQuery:
    """Start a stream over the files below ``root`` that keeps the catalog below ``output`` up to date.

    A batch that is repeated after a failure finds its files up to date and skips them, so each is described once.  A
    data file waits ``wait_seconds`` for its sidecar; it is described again when the sidecar comes later than that.
    """

    def describe(batch: DataFrame, _: int) -> None:
        # read several times below, so written once: the state is not touched again
        arrived = with_names(stage(batch, "arrived"), "sidecar", "again")
        build_catalog(spark, root, output, reference_lists, files=arrived, **options)

    files = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files).load(root).select("path", "modificationTime", "length")
    )
    writer = with_mates(files, wait_seconds).writeStream.foreachBatch(describe).option(
        "checkpointLocation", checkpoint or f"{shared_folder(spark)}/watch"
    )
    return start(spark, writer, available_now)


def start(spark: SparkSession, writer: DataStreamWriter, available_now: bool = True) -> StreamingQuery:
    """Start a query with the state store it needs; the session's own settings are put back.

    Timers ask for a batch without data, time after time, so a run over the files that are there does without such
    batches: its timers fire in the next batch with data.
    """
    needed = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB}
    if available_now:
        needed["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {key: spark.conf.get(key, None) for key in needed}
    for key, value in needed.items():
        spark.conf.set(key, value)
    try:
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
