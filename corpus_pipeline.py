"""From raw documents to packed sequences: language, lines, near copies, benchmark, packing.

Every stage takes (spark, documents, folder of the tables) and returns a DataFrame; all but the
last return documents, of the columns given. Each works on what the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import decontamination, language_id, line_dedup, packing, simhash
from medallion.llm.catalog import WORD_BPE
from medallion.llm.common import free_name, read_table, written

#: A text is rejected if less of its n-grams than this belong to any one language.
LEAST_SCORE = 0.4


def _like(kept: DataFrame, documents: DataFrame) -> DataFrame:
    """``kept`` with the columns of ``documents``; ``n_chars`` follows the text if it is there."""
    return kept.select(*[
        F.char_length("text").cast(documents.schema["n_chars"].dataType).alias("n_chars")
        if name == "n_chars" else F.col(name) for name in documents.columns])


def keep_languages(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts that belong to none of the languages learned.

    Languages are learned from these documents. ``lang`` keeps the value that the table gives; where
    it is null, the prediction is put in.
    """
    return language_id.keep_known(documents, LEAST_SCORE)


def drop_shared_lines(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that many documents share; a document of which only blanks are left goes.

    A text that had no line cut stays as it is, a blank one too.
    """
    dropped = free_name(documents, "_dropped")
    cut = line_dedup.with_lines_dropped(documents, dropped=dropped)
    kept = cut.where((F.col(dropped) == 0) | (F.btrim("text", F.lit(" \t\n\r")) != ""))
    return _like(kept, documents)


def drop_near_copies(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are near copies of each other, the one with the smallest id stays."""
    return simhash.representatives(documents)


def drop_contaminated(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, those without an id too; of rows that share an id
    only those whose own text holds one. Items without an id count like others."""
    return decontamination.clean(documents, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 4096 tokens."""
    return packing.pack(documents, WORD_BPE).drop("ids")


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: No SQL has the language model, XXH64 or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next."""
    rows = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if number + 1 < len(STAGES):
            rows = written(rows, f"pipeline-{name}")
    return rows
