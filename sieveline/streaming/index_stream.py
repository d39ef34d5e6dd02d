"""Keep an index current from a stream of documents in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..sources.index import DocumentIndex


def index_stream(
    documents: DataFrame, index: DocumentIndex, checkpoint: str, partial: bool = False
) -> DataStreamWriter:
    """Writer that applies each micro-batch to ``index``; start it with the trigger you need.

    Every micro-batch scans and writes the copy once, so choose triggers that gather large batches.
    A document whose fields are split over micro-batches keeps them all: rows with the id and the
    ``seq`` of the stored document are merged into it. A micro-batch that is replayed after a
    failure therefore changes nothing.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        # Read from the source once; an executor that is lost only costs its share again. A source may
        # give a few large parts, so documents are dealt out first, as they have to be for assembling.
        batch = batch.repartition("doc_id").persist()
        try:
            if batch.isEmpty():
                return
            if partial:
                index.index_partial(batch)
            else:
                index.index(batch, continued=True)
        finally:
            batch.unpersist()

    return documents.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
