"""Graph building from a landing folder, file by file, with Structured Streaming.

Each micro-batch turns its records into triples and appends them; a subject's type and label may
come again in a later batch. `stream_first` follows the appended triples with keyed state and passes
on each triple once, and of some predicates only the first object that a subject ever had; its state
outlives restarts in its checkpoint, so nothing is read again. `compacted` makes a set in one batch
job instead. A restart repeats at most the batch that was cut off, which overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from taxograph import vocab as V
from taxograph.operators import triples
from taxograph.sources import sinks


def records_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8, file_format: str = "parquet") -> DataFrame:
    """New files of a landing folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(file_format).load(path)


def stream_triples(records: DataFrame, build: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Append the triples of all records that are there now, then stop; run again for later ones."""

    def append(batch: DataFrame, number: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return records.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_object(_key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The row with the least row_id of a key's first batch; nothing later."""
    rows = list(frames)
    if not state.exists:
        state.update((True,))
        yield pd.concat(rows).sort_values("row_id", kind="stable").head(1)


def stream_first(spark: SparkSession, landed: str, out: str, checkpoint: str, once: tuple[str, ...] = (V.RDFS + "label",)) -> list[StreamingQuery]:
    """Follow the triples that stream_triples appended, then stop; run again for later ones.

    Predicates in `once` keep the object that comes first: the least row_id of the first batch that has
    one. A landed batch has a row per subject of such a predicate, if `build` makes its labels a set, so
    that no state key gathers a hot subject's rows. Both parts are written as triples under out.
    """
    schema = spark.read.parquet(landed).drop("batch").schema
    rows = spark.readStream.schema(schema).parquet(f"{landed}/batch=*")
    chosen = F.col("p").isin(*once)
    whole = rows.filter(~chosen).dropDuplicates(["s", "p", "o", "o_kind", "o_dtype"])
    first = rows.filter(chosen).groupBy("s", "p").applyInPandasWithState(first_object, schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)
    parts = (("set", whole), ("first", first.select(*schema.names)))
    return [df.writeStream.format("parquet").outputMode("append").option("path", f"{out}/{name}").option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start() for name, df in parts]


def read_first(spark: SparkSession, out: str) -> DataFrame:
    """What stream_first has passed on so far."""
    return spark.read.parquet(f"{out}/set").unionByName(spark.read.parquet(f"{out}/first"))


def compacted(spark: SparkSession, out: str, to: str) -> None:
    """The streamed triples as one set, by predicate."""
    sinks.write_triples(triples.as_set(spark.read.parquet(out).drop("batch")), to)


def new_taxa(records: DataFrame, key: str, event_time: str, late: str = "1 day") -> DataFrame:
    """The first record of each key within the watermark, as a stream."""
    return records.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])
