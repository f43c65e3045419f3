"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proven once, before any text is read.
Counting then looks pre-tokens up in that table and puts only the rest through the merges. One pass
over the text, no shuffle; each task holds one Arrow batch and a bounded memo.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import prepare_workers, id_and_text
from medallion.llm.wordbpe import encoder_for, prove_whole_tokens

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
LIMIT = 2048


def count_tokens(documents: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    A null text counts as empty (0 bytes, 0 tokens); texts of any length are read whole, in slices
    cut at white space. Repeated rows are counted each; a null ``doc_id`` stays null. Other columns
    are not read. An empty table gives no rows.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    whole = spark.sparkContext.broadcast(prove_whole_tokens(tokenizer_path))

    def count(batches):
        encoder = encoder_for(tokenizer_path, whole)
        for batch in batches:
            tokens = [encoder.count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = id_and_text(documents).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, SCHEMA)
