"""Structured Streaming jobs over antivirus verdicts.

Lateness is this library's own policy: verdicts more than two days behind the newest are late.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from concordat import constants as C
from concordat import schemas as S
from concordat.settings import DEFAULT_PROFILE, Profile
from concordat.sources.releases import explode_verdicts

LATENESS = "2 days"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FLAG_SCHEMA = "sha256 string, engine string, fetched_at timestamp, category string, prev_category string"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def read_verdict_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """New verdict documents as exploded rows."""
    docs = (
        spark.readStream.schema(S.AV_DOCUMENT).option("multiLine", True)
        .option("maxFilesPerTrigger", max_files).json(folder)
    )
    return explode_verdicts(docs)


def vendor_table(spark: SparkSession, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """(engine): the vendors whose flags raise an alert."""
    return spark.createDataFrame([(v,) for v in profile.major_vendors], "engine string")


def drop_repeats(verdicts: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return verdicts.withWatermark("fetched_at", lateness).dropDuplicatesWithinWatermark(
        ["sha256", "engine", "fetched_at"]
    )


def escalate(verdicts: DataFrame, vendors: DataFrame) -> DataFrame:
    """Flagged rows with `severity`: alert for a listed vendor's engine, info for any other."""
    listed = vendors.select("engine", F.lit(True).alias("major"))
    return (
        verdicts.where(F.col("category").isin(*C.AV_FLAGGED))
        .join(listed, "engine", "left")
        .withColumn("severity", F.when(F.col("major"), "alert").otherwise("info"))
        .drop("major")
    )


class _FlagTracker(StatefulProcessor):
    """Keeps the newest category per (binary, engine) and reports clean-to-flagged turns."""

    def __init__(self, flagged: Sequence[str]):
        self.flagged = frozenset(flagged)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "fetched_at timestamp, tie long, category string")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        row = initialState.iloc[0]  # one per key
        self.last.update((row["fetched_at"].to_pydatetime(), int(row["tie"]), row["category"]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # Chunks of one batch arrive in no order and state must see time order, so the narrow
        # columns of this key's new rows are sorted here. A batch is bounded by the source's
        # maxFilesPerTrigger; older history is only the one state row.
        new = pd.concat([c[["fetched_at", "tie", "category"]] for c in rows], ignore_index=True)
        new = new.sort_values(["fetched_at", "tie"], kind="stable")
        before = None
        if self.last.exists():
            at, tie, before = self.last.get()
            at = pd.Timestamp(at)
            new = new[(new["fetched_at"] > at) | ((new["fetched_at"] == at) & (new["tie"] >= tie))]
        if new.empty:
            return
        prev = new["category"].shift(1)
        prev.iloc[0] = before
        turns = new[new["category"].isin(self.flagged) & prev.notna() & ~prev.isin(self.flagged)]
        end = new.iloc[-1]
        self.last.update((end["fetched_at"].to_pydatetime(), int(end["tie"]), end["category"]))
        if len(turns):
            yield pd.DataFrame({
                "sha256": key[0], "engine": key[1], "fetched_at": turns["fetched_at"], "category": turns["category"],
                "prev_category": prev[turns.index]})

    def close(self) -> None:
        pass


def _tie(verdicts: DataFrame):
    return F.col("event_id").cast("long") if "event_id" in verdicts.columns else F.lit(0).cast("long")


def newest_categories(history: DataFrame) -> DataFrame:
    """(sha256, engine, fetched_at, tie, category): the newest verdict of each binary and engine in a batch history."""
    rows = history.select("sha256", "engine", "fetched_at", _tie(history).alias("tie"), "category")
    last = F.max_by(F.struct("fetched_at", "tie", "category"), F.struct("fetched_at", "tie")).alias("_l")
    return rows.groupBy("sha256", "engine").agg(last).select("sha256", "engine", "_l.*")


def retro_flags(verdicts: DataFrame, flagged: Sequence[str] = C.AV_FLAGGED, history: DataFrame | None = None) -> DataFrame:
    """Clean-to-flagged turns per (sha256, engine); rows older than the kept one are ignored.

    Rows of one moment are ordered by event_id where the stream has it. A new stream knows nothing of what came before it and would
    miss the first turn of every binary; `history`, a batch of earlier verdicts, gives it the newest category of each to begin with. It
    is read when the query first starts and not on later restarts.
    """
    begin = None if history is None else newest_categories(history).groupBy("sha256", "engine")
    return verdicts.select("sha256", "engine", "fetched_at", _tie(verdicts).alias("tie"), "category").groupBy("sha256", "engine").transformWithStateInPandas(
        statefulProcessor=_FlagTracker(flagged), outputStructType=FLAG_SCHEMA, outputMode="Append", timeMode="None", initialState=begin,
    )


def daily_flags(verdicts: DataFrame, flagged: Sequence[str] = C.AV_FLAGGED, lateness: str = LATENESS) -> DataFrame:
    """Flagged verdicts per day and file; a day is emitted once the watermark has passed it."""
    return (
        verdicts.withWatermark("fetched_at", lateness)
        .groupBy(F.window("fetched_at", "1 day").alias("w"), "filename")
        # a sum, not a count: the state store names what it keeps after the aggregate, and open_days reads both
        .agg(F.sum(F.coalesce(F.col("category").isin(*flagged).cast("long"), F.lit(0).cast("long"))).alias("n_flagged"),
             F.count(F.lit(1)).alias("n_verdicts"))
        .select(F.col("w.start").alias("day"), "filename", "n_flagged", "n_verdicts")
    )


def open_days(spark: SparkSession, checkpoint: str) -> DataFrame:
    """As daily_flags, for the days that its watermark has not passed yet, read from the state of a stopped query.

    A day is either in the query's output or here, never in both.
    """
    state = spark.read.format("statestore").load(checkpoint)
    flagged, total = F.col("value")["sum"], F.col("value")["count"]
    window = state.schema["key"].dataType.fields[0].name
    start = F.col("key").getField(window)["start"]
    return state.select(start.alias("day"), F.col("key.filename").alias("filename"), flagged.alias("n_flagged"), total.alias("n_verdicts"))


def once_per_batch(spark: SparkSession, path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that writes each batch to a folder of its number, once.

    The folders are the ledger: a batch is written elsewhere and renamed to its place, and one whose place is taken is a replay after a
    restart and is left out. Two queries must not share a path.
    """
    def sink(rows: DataFrame, batch_id: int) -> None:
        jvm = spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/batch={batch_id}")
        place = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if place.exists(done):
            return
        staged = f"{path}/_staged/{batch_id}-{uuid.uuid4().hex}"
        rows.write.parquet(staged)
        if not place.rename(jvm.org.apache.hadoop.fs.Path(staged), done):
            raise RuntimeError(f"batch {batch_id} could not be put in its place")

    return sink


def alerts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What the sink has written; the batch's number is a column."""
    return spark.read.schema(f"{schema}, batch long").parquet(path)


def run_available(
    stream: DataFrame, checkpoint: str, path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
):
    """Process what is there and stop; restart continues from the checkpoint."""
    writer = stream.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        query = writer.foreachBatch(foreach_batch).start()
    else:
        query = writer.format("parquet").start(path)
    query.awaitTermination()
    return query
