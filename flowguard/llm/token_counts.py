"""Token counts by count-only Viterbi."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.unigram import Unigram, read_vocabulary


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_chars`` of every row: the number of pieces of the
    best unigram segmentation of the whole text (see ``unigram``). Aho-Corasick finds
    the pieces that end at each place; the dynamic program carries the best score
    and its piece count, and keeps only the places a piece can reach back to. Words
    that a task has met are not segmented again.

    Null or empty text: 0. Repeated rows are counted each; ids are passed through,
    nulls too. Only the two named columns are read. An empty table gives no rows. The
    vocabulary (bounded by the model) is sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram(sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([model.count(t) for t in texts], pa.int64()),
                 pa.array([len(t or "") for t in texts], pa.int64())], ["doc_id", "n_tokens", "n_chars"])

    kind = docs.schema[id_col].dataType.simpleString()
    return src.mapInArrow(count, f"doc_id {kind}, n_tokens long, n_chars long")
