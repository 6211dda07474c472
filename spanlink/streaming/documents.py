"""The document pipeline over a stream: every operator works within a document, so each micro-batch is a batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from spanlink.config import Config
from spanlink.plans.extract import extract_documents


def extract_stream(docs: DataFrame, config: Config, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes the pairs of a stream of docs (doc_id, text) to path, a folder a micro-batch, so that a repeated one overwrites itself."""

    def each(batch: DataFrame, number: int) -> None:
        extract_documents(batch, config)["pairs"].write.mode("overwrite").parquet(f"{path}/batch={number}")

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
