"""What the text operators share: column choice, written intermediate tables, bounded batches."""

from __future__ import annotations

import re
import tempfile
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import medallion
from medallion.session import scratch_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six bytes [\x20\x09-\x0D] that bytes.split() splits at.
BLANKS = " \t\n\x0b\x0c\r"
#: Bytes of text that reach a Python worker in one Arrow batch.
BATCH_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; a null text is empty."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def free_name(documents: DataFrame, wanted: str) -> str:
    """``wanted``, longer as long as the table has a column of that name."""
    taken = {name.lower() for name in documents.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_name(text: Column) -> Column:
    """128 bits of a text: with its id they name a row, one without an id too; null counts as empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def crc_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    as_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % F.lit(buckets)


def crc_bucket_of(doc_id: int | None, buckets: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % buckets


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """Send this package to the Python workers and bound an Arrow batch by bytes.

    10,000 rows of very long text would not fit a worker. The package is sent once per application,
    so that executors need nothing installed but the public libraries.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(medallion.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="medallion-")) / "medallion.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_CUT = re.compile(r"[ \t\n\r\x0b\x0c]")


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The text in slices of about ``size`` characters, cut only at ASCII white space."""
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:] if at else text
