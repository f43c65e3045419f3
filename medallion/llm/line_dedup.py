"""Dedup of lines across documents.

Lines become 128-bit hashes with document and place, are range-partitioned by hash and sorted, in
a second order, by document (largest first) and place. A task streams its range: the lines of the
first document of a hash stay, those of the others go as soon as a third document has come. The
range partitioning may cut a frequent hash between documents, so that no task holds a third of
all lines; only what lies at a task's ends is then settled with its neighbours. The answer is a
compressed bitmap per document, not text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import (
    BLANKS, ascii_lower, free_name, id_and_text, prepare_workers, written,
)

MIN_CHARS = 20
MIN_DOCS = 3
_DROP, _EDGE, _SEEN = 0, 1, 2
_LINE = "h1 long, h2 long, sid long, th long, pos int, n_lines int"
_RULED = f"kind int, {_LINE}, n_docs int"
#: Stands for a null doc_id: smaller than any id, so such a row never keeps a shared line.
_NO_ID = -(1 << 63)


def keyed_rows(documents: DataFrame) -> DataFrame:
    """``sid, th, text``: id and text hash together name a row, repeated ids included."""
    return id_and_text(documents).select(
        "doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("sid"),
        F.xxhash64("text").alias("th"), "text")


def line_hashes(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Each line whose key has at least ``min_chars`` code points."""
    split = keyed_rows(documents).select("sid", "th", F.split("text", "\n", -1).alias("lines"))
    lines = split.select("sid", "th", F.size("lines").alias("n_lines"),
                         F.posexplode("lines").alias("pos", "line"))
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    return lines.select("sid", "th", "n_lines", "pos", key.alias("key")).where(
        F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
        "sid", "th", "pos", "n_lines")


_SCHEMA = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("sid", pa.int64()),
                     ("th", pa.int64()), ("pos", pa.int32()), ("n_lines", pa.int32())])


def _ruled(kind: int, batch: pa.RecordBatch, n_docs: int = 0) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), *batch.columns,
         pa.array(np.full(n, n_docs, np.int32))],
        names=["kind", *batch.schema.names, "n_docs"])


class _Range:
    """Streams one sorted range, run of equal hashes by run.

    The run that a batch ends in stays open. Memory: a batch, and of the open run the lines of the
    documents before the one that settles it.
    """

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.hash = None

    def _open(self, part: pa.RecordBatch, first: bool):
        self.first, self.docs, self.doc, self.held = first, 0, None, []
        self.top = part.column(2)[0].as_py()
        self.hash = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
        yield from self._go_on(part)

    def _go_on(self, part: pa.RecordBatch):
        if self.first:  # it may have begun in the range before
            yield _ruled(_EDGE, part)
            return
        sid = part.column(2).to_numpy()
        new = np.concatenate([[sid[0] != self.doc], sid[1:] != sid[:-1]])
        rank = self.docs + np.cumsum(new)
        self.doc, self.docs = sid[-1], int(rank[-1])
        later = part.filter(pa.array(rank > 1))
        if later.num_rows:
            self.held.append(later)
        if self.docs >= self.min_docs:
            for held in self.held:
                yield _ruled(_DROP, held)
            self.held = []

    def read(self, batch: pa.RecordBatch):
        h1, h2, sid = (batch.column(i).to_numpy() for i in range(3))
        n = len(h1)
        run = np.empty(n, bool)
        run[0] = self.hash != (h1[0], h2[0])
        run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts = np.flatnonzero(run)
        head = int(starts[0]) if len(starts) else n
        if head:
            yield from self._go_on(batch.slice(0, head))
        if not len(starts):
            return
        if self.hash is None:
            end = int(starts[1]) if len(starts) > 1 else n
            yield from self._open(batch.slice(0, end), first=True)
            head, starts = end, starts[1:]
            if not len(starts):
                return
        # Runs that begin and end within the batch, all at once.
        tail = int(starts[-1])
        if tail > head:
            new = run[head:tail] | np.concatenate([[True], sid[head + 1:tail] != sid[head:tail - 1]])
            seen, number = np.cumsum(new), np.cumsum(run[head:tail]) - 1
            first = seen[starts[:-1] - head] - 1
            rank = seen - first[number]
            total = rank[np.append(starts[1:-1] - head, tail - head) - 1][number]
            drop = (rank > 1) & (total >= self.min_docs)
            if drop.any():
                yield _ruled(_DROP, batch.slice(head, tail - head).filter(pa.array(drop)))
        yield from self._open(batch.slice(tail), first=False)

    def end(self):
        """The run at the range's end may go on in the next one."""
        if self.hash is None or self.first:
            return
        seen = pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in
             zip((*self.hash, self.top, 0, -1, 0), _SCHEMA, strict=True)], schema=_SCHEMA)
        yield _ruled(_SEEN, seen, min(self.docs, self.min_docs))
        for held in self.held:
            yield _ruled(_EDGE, held)


def dropped_lines(documents: DataFrame, min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS) -> DataFrame:
    """``sid, th, pos, n_lines`` of every line that goes."""

    def stream(batches):
        ranged = _Range(min_docs)
        for batch in batches:
            if batch.num_rows:
                yield from ranged.read(batch)
        yield from ranged.end()

    order = ["h1", "h2", F.col("sid").desc(), "th", "pos"]
    ruled = written(
        line_hashes(documents, min_chars).repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("h1", "h2", "sid", "th", "pos", "n_lines").mapInArrow(stream, _RULED),
        "line-dedup")
    # Two hashes at most per range lie at its ends, so these sums are small however large the
    # table is; the documents of one of them may be many, and are counted in two steps.
    ends = ruled.where(F.col("kind") != _DROP)
    sums = ends.groupBy("h1", "h2", "sid").agg(F.max("n_docs").alias("n_docs")).groupBy(
        "h1", "h2").agg(F.max("sid").alias("top"), F.greatest(
            F.max("n_docs").cast("long"), F.count("*")).alias("docs"))
    settled = ruled.where(F.col("kind") == _EDGE).join(
        F.broadcast(sums), ["h1", "h2"]).where(
        (F.col("docs") >= min_docs) & (F.col("sid") != F.col("top")))
    columns = ["sid", "th", "pos", "n_lines"]
    return ruled.where(F.col("kind") == _DROP).select(*columns).union(settled.select(*columns))


def pack_bitmap(drop, n_lines: int) -> bytes:
    keep = np.ones(n_lines, np.uint8)
    keep[drop] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines)


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """``sid, th, n_dropped, bitmap`` for every document that loses lines.

    ``bitmap`` is the zlib-compressed bit string of the lines, first line first, 1 for kept. ``sid``
    is ``doc_id`` (the smallest long for null) and ``th`` the text's hash: together they name a row,
    so rows that repeat an id keep their own answer. A line's key is the line stripped of blanks at
    both ends, A-Z lower-cased; a shared line stays only in the largest ``doc_id`` that holds it,
    there as often as it is; a null id is the smallest. Null texts count as empty.
    """
    prepare_workers(documents.sparkSession)

    def pack(batches):
        for batch in batches:
            bitmaps, counts = [], []
            lists, lines = batch.column("drop"), batch.column("n_lines").to_pylist()
            for drop, n in zip(lists, lines, strict=True):
                places = drop.values.to_numpy()
                bitmaps.append(pack_bitmap(places, n))
                counts.append(len(places))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid"), batch.column("th"), pa.array(counts, pa.int64()),
                 pa.array(bitmaps, pa.binary())], names=["sid", "th", "n_dropped", "bitmap"])

    # A document's lines are bounded by its own text; rows that repeat it give equal places.
    places = dropped_lines(documents, min_chars, min_docs).groupBy("sid", "th", "n_lines").agg(
        F.collect_set("pos").alias("drop"))
    return places.mapInArrow(pack, "sid long, th long, n_dropped long, bitmap binary")


def _cut(name: str):
    """The text column without the lines that the bitmap of that name clears; the bitmap goes."""
    def run(batches):
        for batch in batches:
            at, bitmaps = batch.schema.get_field_index("text"), batch.column(name)
            texts = []
            for text, bitmap in zip(batch.column(at), bitmaps, strict=True):
                text = text.as_py()
                if bitmap.is_valid:
                    lines = text.split("\n")
                    kept = unpack_bitmap(bitmap.as_py(), len(lines))
                    text = "\n".join(x for x, k in zip(lines, kept, strict=True) if k)
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).drop_columns([name])
    return run


def with_lines_dropped(documents: DataFrame, min_chars: int = MIN_CHARS,
                       min_docs: int = MIN_DOCS, dropped: str = "_dropped") -> DataFrame:
    """The rows of the table with all their columns, the text without the lines that go, and the
    number of them as ``dropped``, a name the table must not have. A null text stays null."""
    sid, th, bitmap = (free_name(documents, name) for name in ("_sid", "_th", "_bitmap"))
    bitmaps = keep_bitmaps(documents, min_chars, min_docs).select(
        F.col("sid").alias(sid), F.col("th").alias(th),
        F.col("n_dropped").alias(dropped), F.col("bitmap").alias(bitmap))
    marked = documents.withColumns({
        sid: F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
        th: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    joined = marked.join(bitmaps, [sid, th], "left").drop(sid, th).withColumn(
        dropped, F.coalesce(dropped, F.lit(0).cast("long")))
    return joined.mapInArrow(_cut(bitmap), joined.drop(bitmap).schema)


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per row of the table: ``doc_id, n_lines, n_dropped, text``, the text without the
    lines that go. Null texts come back empty; a text whose lines all go is empty."""
    rows = id_and_text(documents)
    newlines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit("")))
    cut = with_lines_dropped(
        rows.withColumn("n_lines", (newlines + 1).cast("long")), min_chars, min_docs)
    return cut.select("doc_id", "n_lines", F.col("_dropped").alias("n_dropped"), "text")


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
shared AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
r AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.top AS gone
  FROM k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM r GROUP BY doc_id
"""
