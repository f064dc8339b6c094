"""Continuous arrival of daily drops, each loaded once it is complete."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daymend.functions.measures import file_stem
from daymend.plans.flow import SalesFlow

_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
_PART = r"\.csv/[^/]+\.csv$"
_MARK = r"([^/=]+?)(?:\.of-(\d+))?(?:\.again-\d+)?\.done$"
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _arrivals(files: DataFrame) -> DataFrame:
    """What each file is to its drop: name, kind (file, part or mark), parts that a mark asks for."""
    path = F.col("path")
    mark = path.rlike(_MARK)
    asked = F.regexp_extract(path, _MARK, 2)
    return files.select(
        F.when(mark, F.regexp_extract(path, _MARK, 1)).otherwise(file_stem(path)).alias("name"),
        F.when(mark, "mark").when(path.rlike(_PART), "part").otherwise("file").alias("kind"),
        F.when(mark & (asked != ""), asked.cast("long")).otherwise(F.lit(0)).cast("long").alias("parts"))


def _held(quiet_ms: int):
    """Holds the parts of a drop in state (parts seen, parts asked for) until it is complete, then tells its name once."""
    def hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        told = pd.DataFrame({"source_file": [key[0]]})
        if state.hasTimedOut:
            state.remove()
            yield told
            return
        seen, asked = state.get if state.exists else (0, -1)
        whole = False
        for rows in batches:
            seen += int((rows["kind"] == "part").sum())
            whole |= bool((rows["kind"] == "file").any())
            marks = rows.loc[rows["kind"] == "mark", "parts"]
            asked = max(asked, int(marks.max())) if len(marks) else asked
        if whole or 0 <= asked <= seen:
            if state.exists:
                state.remove()
            yield told
        else:
            state.update((seen, asked))
            state.setTimeoutDuration(quiet_ms)

    return hold


def stream_drops(flow: SalesFlow, folder: str, checkpoint: str, max_files_per_trigger: int = 1,
                 quiet: float = 600, every: str | None = None) -> StreamingQuery:
    """Load every drop of the folder once, as it becomes complete.

    A drop that is one file is complete as it arrives. The part files of a drop that is a folder are counted in the
    state of the stream until the marker of the drop has arrived, a file ``<name>.done`` beside it, or
    ``<name>.of-<n>.done`` if the drop has n parts (not empty: Spark reads no empty files); or else until no file of the drop has come for ``quiet`` seconds. The drop is
    then told once, and its days are built once, however many triggers its parts took. Parts that come later
    are held as a new delivery, for a marker of another name (``<name>.again-2.done``) or the timer.

    Without ``every`` the stream ends when all that has arrived is taken in. Timers then fire with the next files that
    arrive; with ``every`` (as in "30 seconds") the stream goes on, and they fire on their own.

    The stream carries file names; the rows are read by the batch reader, so columns go by header name
    here too. Running a batch again after a failure gives the same tables, which makes the sink
    exactly-once, and a second file for a day adds to the day.
    """
    spark = flow.store.spark
    files = spark.readStream.format("binaryFile").schema(_FILE) \
        .option("maxFilesPerTrigger", max_files_per_trigger) \
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,done}").load(folder)

    def load(batch: DataFrame, _: int) -> None:
        names = sorted(r.source_file for r in batch.distinct().collect())
        if names:
            flow.load_files(names)

    complete = _arrivals(files).groupBy("name").applyInPandasWithState(
        _held(int(quiet * 1000)), "source_file string", "seen long, asked long", "append", GroupStateTimeout.ProcessingTimeTimeout)
    writer = complete.writeStream.outputMode("append").foreachBatch(load).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    # a stream with timers asks for another batch at any time, so one that is to end must not run batches without files
    before = spark.conf.get(_NO_DATA)
    spark.conf.set(_NO_DATA, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(_NO_DATA, before)


def run_drops(flow: SalesFlow, folder: str, checkpoint: str, max_files_per_trigger: int = 1, quiet: float = 600) -> None:
    """``stream_drops`` and wait for the end."""
    stream_drops(flow, folder, checkpoint, max_files_per_trigger, quiet).awaitTermination()
