"""Model backends that find entities and pairs in a text and say how long it took."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

EXTRACTED = "doc_id string, entities array<struct<text:string,category:string>>, pairs array<struct<event:string,location:string>>, seconds double, error string"


class Backend(Protocol):
    """A model in a worker: warmup() comes once before the first text, cleanup() once after the last, even if a text fails."""

    name: str

    def warmup(self) -> None: ...

    def extract(self, text: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
        """Entities (text, category) and pairs (event, location)."""

    def cleanup(self) -> None: ...


def extract_all(articles: DataFrame, load: Callable[[], Backend]) -> DataFrame:
    """EXTRACTED of articles (doc_id, text) by the backend that load() gives each worker.

    A text on which the backend fails has empty arrays, null seconds and its error; a backend that fails to warm up
    fails the job. A null text counts as empty. Seconds differ in each run, so write the rows before they are used twice.
    """
    schema = to_arrow_schema(_schema(articles))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = load()
        backend.warmup()
        try:
            for batch in batches:
                rows = []
                for doc_id, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    began = time.perf_counter()
                    try:
                        entities, pairs = backend.extract(text or "")
                        row = ([{"text": t, "category": c} for t, c in entities], [{"event": e, "location": p} for e, p in pairs], time.perf_counter() - began, None)
                    except Exception as e:  # noqa: BLE001
                        row = ([], [], None, f"{type(e).__name__}: {e}"[:200])
                    rows.append(dict(zip(schema.names, (doc_id, *row), strict=True)))
                yield pa.RecordBatch.from_pylist(rows, schema)
        finally:
            backend.cleanup()

    return articles.select("doc_id", "text").mapInArrow(run, _schema(articles))


def _schema(articles: DataFrame) -> StructType:
    schema = _parse_datatype_string(EXTRACTED)
    schema["doc_id"].dataType = articles.schema["doc_id"].dataType
    return schema
