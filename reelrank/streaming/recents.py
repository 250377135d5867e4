"""Each user's newest ratings, kept by the stream of the ratings themselves.

The state of a user is the list of the newest ``num`` ratings, which Spark keeps per key and
recovers from the stream's checkpoint. A batch merges its ratings into the lists of its users
and hands on the lists that it has touched, as ``mid:score`` entries, newest first. A list
that no rating has touched for the time to live, if there is one, is forgotten.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from reelrank.operators.ingest import CORRUPT, parse_rating_events
from reelrank.operators.scoring import MAX_RECENT
from reelrank.plans.topk import top_per_group
from reelrank.sources import schemas
from reelrank.sources.tables import TableStore

RECENTS_TABLE = "StreamRecents"
#: State of many keys lives in RocksDB, outside the heap.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_STATE = "timestamp int, mid int, score double"
_BATCHES = T.StructType([*schemas.RECENT_LISTS.fields, T.StructField("batch_id", T.LongType())])


class NewestRatings(StatefulProcessor):
    """Keeps the ``num`` newest ratings of a key; equal times go by item, then score."""

    def __init__(self, num: int, ttl_seconds: int | None = None):
        self.num, self.ttl = num, ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getListState(
            "newest", _STATE, None if self.ttl is None else 1_000 * self.ttl
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        held = [tuple(row) for row in self.newest.get()] if self.newest.exists() else []
        for part in rows:  # a user's rows come in parts, of which the newest are held
            fresh = zip(part["timestamp"], part["mid"], part["score"], strict=True)
            found = ((int(t), int(mid), float(score)) for t, mid, score in fresh)
            held = heapq.nlargest(self.num, [*held, *heapq.nlargest(self.num, found)])
        self.newest.put(held)
        entries = [f"{mid}:{score}" for _, mid, score in held]
        yield pd.DataFrame({"uid": [key[0]], "entries": [entries]})

    def close(self) -> None:
        pass


def recents(events: DataFrame, num: int = MAX_RECENT, ttl_seconds: int | None = None) -> DataFrame:
    """``(uid, entries)``: the lists of the users in each batch of the stream ``events``."""
    complete = events.filter(
        " and ".join(f"{name} is not null" for name in ("uid", "mid", "score", "timestamp"))
    )
    return complete.groupBy("uid").transformWithStateInPandas(
        statefulProcessor=NewestRatings(num, ttl_seconds),
        outputStructType=schemas.RECENT_LISTS,
        outputMode="Update",
        timeMode="None" if ttl_seconds is None else "ProcessingTime",
    )


def start(
    lines: DataFrame,
    sink: TableStore,
    checkpoint: str,
    num: int = MAX_RECENT,
    ttl_seconds: int | None = None,
    interval: str | None = "2 seconds",
) -> StreamingQuery:
    """Keep the lists of a stream of lines under ``sink``; see :func:`latest`.

    A batch replaces its own folder, so running it again changes nothing. Lines that cannot
    be read are left to the rescoring stream, which sets them aside.
    """
    parsed = parse_rating_events(lines)
    events = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.replace(batch, f"{RECENTS_TABLE}/batch_id={batch_id}")

    writer = recents(events, num, ttl_seconds).writeStream.foreachBatch(write)
    writer = writer.outputMode("update").option("checkpointLocation", checkpoint)
    paced = {"availableNow": True} if interval is None else {"processingTime": interval}
    conf, key = lines.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, PROVIDER)  # the stream takes its settings when it starts
    try:
        return writer.trigger(**paced).start()
    finally:
        conf.set(key, before)


def latest(spark: SparkSession, sink: TableStore) -> DataFrame:
    """``(uid, entries)``: the current list of every user."""
    batches = sink.parts(spark, RECENTS_TABLE, "batch_id=")
    if not batches:
        return spark.createDataFrame([], schemas.RECENT_LISTS)
    root = sink.path(RECENTS_TABLE)
    lists = (
        spark.read.format(sink.format)
        .options(**sink.options)
        .schema(_BATCHES)
        .option("basePath", root)
        .load([f"{root}/batch_id={batch}" for batch in sorted(batches)])
    )
    return top_per_group(lists, ["uid"], [F.desc("batch_id")], 1).select("uid", "entries")
