"""Structured Streaming forms of the incremental jobs.

Every sink writes one folder per micro-batch and replaces it when the batch is repeated after a failure, so
each batch counts once.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from newsweave.operators.extraction import extraction_errors, extraction_results, parse_responses
from newsweave.operators.joins import pending
from newsweave.operators.ordering import keep_one
from newsweave.session import cut
from newsweave.sources.keyed import ROWS_PER_BUCKET, KeyTable


def stream_parquet(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """Parquet files arriving at a folder; a single file has to be named by a pattern."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_sink(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches written so far; empty before the first."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(location):
        return spark.createDataFrame([], f"{schema}, batch int")
    return spark.read.schema(f"{schema}, batch int").parquet(path)


RESULTS = "url string, extracted_entities string, entity_relationships string"
ERRORS = "url string, error string, rate_limited boolean"


def incremental_extract(
    stream: DataFrame,
    extract: Callable[[DataFrame], DataFrame],
    sink: str,
    errors: str,
    checkpoint: str,
    retry_failed: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> StreamingQuery:
    """Extract the articles that arrive and were not handled in an earlier batch or run.

    ``extract`` maps articles to (url, response_text, error). Runs until the available input is used up. Of articles of one
    address the last of the first batch that holds it counts. What was handled is looked up in a ``KeyTable`` beside the
    sink, of which a batch reads only the folders of its own addresses; for a sink without one it is made from the sink.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        handled = KeyTable(spark, f"{sink}-keys", "url", rows_per_bucket)
        if handled.bits() is None:
            handled.start(batch, number)
            if number:
                handled.add(read_sink(spark, sink, RESULTS).filter(F.col("batch") < number), number - 1)
        done = handled.known(handled.start(batch, number))
        replies = extract(pending(keep_one(batch, ["url"], "seq", "last"), done))
        parsed = cut(parse_responses(replies))
        results = extraction_results(parsed, retry_failed)
        write_batch(results, sink, number)
        write_batch(extraction_errors(parsed), errors, number)
        handled.add(results, number)

    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _each_batch(stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Write ``reduce`` of every micro-batch until the available input is used up."""
    return (
        stream.writeStream.foreachBatch(lambda batch, number: write_batch(reduce(batch), sink, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def earliest(rows: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The row of the earliest time per key, rows without a time last; of rows alike in time the least in the other columns."""
    rest = [c for c in rows.columns if c not in keys]
    others = [F.col(c) for c in rest if c != time]
    first = F.min(F.struct(F.col(time).isNull().alias("missing"), F.col(time), *others)).alias("first")
    return rows.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"first.{c}") for c in rows.columns])


def first_arrivals(stream: DataFrame, keys: list[str], time: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Each batch writes its earliest row per key; ``earliest`` of the sink is that of all rows, however late some came."""
    return _each_batch(stream, lambda batch: earliest(batch, keys, time), sink, checkpoint)


def daily_counts(stream: DataFrame, time: str, keys: list[str], sink: str, checkpoint: str) -> StreamingQuery:
    """Each batch writes its rows per day and key; ``total_counts`` adds them up, so late rows count like others."""
    return _each_batch(stream, lambda batch: batch.groupBy(F.to_date(time).alias("date"), *keys).agg(F.count(F.lit(1)).alias("n")), sink, checkpoint)


def total_counts(written: DataFrame, keys: list[str]) -> DataFrame:
    return written.groupBy("date", *keys).agg(F.sum("n").alias("n"))


def daily_means(stream: DataFrame, time: str, value: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Each batch writes sum and number of the values of a day; ``total_means`` makes the means of them."""
    parts = (F.sum(value).alias("total"), F.count(value).alias("n"))
    return _each_batch(stream, lambda batch: batch.groupBy(F.to_date(time).alias("date")).agg(*parts), sink, checkpoint)


def total_means(written: DataFrame) -> DataFrame:
    return written.groupBy("date").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("mean"))


def latest(rows: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The row of the latest time per key, rows without a time first; of rows alike in time the greatest in the other columns."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max(F.struct(F.col(time).isNotNull().alias("there"), F.col(time), *[F.col(c) for c in rest if c != time])).alias("last")
    return rows.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col(f"last.{c}") for c in rows.columns])


class Generations:
    """Partial results of micro-batches that can be reduced again, in folders ``span=<first>-<last>`` of batches.

    Each batch writes a span of its own; whenever ``fan`` spans of one size are complete they are reduced to one of the next
    size. So after n batches a reader finds about fan * log(n) folders and a row was written log(n) times. A span counts
    once it is whole, and hides the spans within it, so a run that ends anywhere leaves a readable sink, and a repeated
    batch changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, reduce: Callable[[DataFrame], DataFrame], fan: int = 8):
        self.spark, self.path, self.schema, self.reduce, self.fan = spark, path, schema, reduce, fan
        jvm = spark.sparkContext._jvm
        self._location = lambda below: jvm.org.apache.hadoop.fs.Path(f"{path}/{below}" if below else path)
        self._files = self._location("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def spans(self) -> list[tuple[int, int]]:
        """The whole spans that are not within another."""
        if not self._files.exists(self._location("")):
            return []
        named = (re.fullmatch(r"span=(\d+)-(\d+)", entry.getPath().getName()) for entry in self._files.listStatus(self._location("")))
        whole = [(int(m[1]), int(m[2])) for m in named if m and self._files.exists(self._location(f"{m[0]}/_SUCCESS"))]
        return sorted(s for s in whole if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in whole))

    def _read(self, spans: list[tuple[int, int]]) -> DataFrame:
        if not spans:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/span={a}-{b}" for a, b in spans])

    def read(self) -> DataFrame:
        """The result of all batches so far."""
        return self.reduce(self._read(self.spans()))

    def write(self, batch: DataFrame, number: int) -> None:
        self.reduce(batch).write.mode("overwrite").parquet(f"{self.path}/span={number}-{number}")
        size = self.fan
        while (number + 1) % size == 0:
            first = number + 1 - size
            parts = [s for s in self.spans() if first <= s[0] and s[1] <= number]
            if len(parts) > 1:
                self.reduce(self._read(parts)).write.mode("overwrite").parquet(f"{self.path}/span={first}-{number}")
                for a, b in parts:
                    self._files.delete(self._location(f"span={a}-{b}"), True)
            size *= self.fan


def reduced(stream: DataFrame, sink: Generations, checkpoint: str) -> StreamingQuery:
    """Keep the sink reduced as batches arrive, until the available input is used up."""
    return (
        stream.writeStream.foreachBatch(lambda batch, number: sink.write(batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_arrivals(stream: DataFrame, keys: list[str], time: str, sink: str, fan: int = 8) -> Generations:
    """Sink for the latest row per key, whatever the order of the files; a changed row takes the place of an older one."""
    return Generations(stream.sparkSession, sink, stream.schema, lambda rows: latest(rows, keys, time), fan)
