"""New query records as a stream against a fixed index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.normalize import normalize
from ..operators.blocking import Index, candidate_lists


def candidates_of_stream(stream: DataFrame, index: Index, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes the candidate lists of each micro-batch; a batch that is run again replaces its own folder.

    ``index`` should be one with a path, or each batch makes its tables anew.
    """

    def write(batch: DataFrame, number: int) -> None:
        own = normalize(batch)
        candidate_lists(own, index.candidates(own)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
