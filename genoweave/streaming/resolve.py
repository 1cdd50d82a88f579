"""The stateless operators over streams: headers classified as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.ids import classify, embedded, primary_token


def classified_stream(headers: DataFrame) -> DataFrame:
    """A stream of headers (header, ...) with transcript_id and db_source; `unknown` for those that no rule fits."""
    token = primary_token(F.col("header"))
    rows = headers.withColumn("g_class", classify(token)).withColumn("g_embedded", F.when(F.col("g_class").isNull(), embedded(F.col("header"))))
    out = rows.withColumns({"transcript_id": F.coalesce("g_embedded.transcript_id", token), "db_source": F.coalesce("g_class.db_source", "g_embedded.db_source", F.lit("unknown"))})
    return out.drop("g_class", "g_embedded")


def resolve_stream(headers: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs a function on each batch of classified headers; a batch resolver's joins work there as they do on tables."""
    writer = classified_stream(headers).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
