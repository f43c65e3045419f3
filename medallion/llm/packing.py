"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Every task tokenises its documents and best-fits the pieces it has seen into bins. Nearly full bins
are emitted. The others go on as single items to the next round, where several tasks' leftovers
meet in one task and are best-fitted again, and so on up a tree until one task holds what is left or
a round leaves more than 95 % of the bins of the one before; the next is then the last, and bins of
its different tasks are emitted as they are, underfull ones too.
Only leftovers are shuffled, never the text, and a task holds a bounded number of bins.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import prepare_workers, id_and_text, written
from medallion.llm.wordbpe import encoder_for, prove_whole_tokens

CAPACITY = 4096
END_ID = 1
#: Pieces a task fits at once, and leftover bins one task of a later round takes.
WINDOW = 50_000
PER_TASK = 20_000

_BIN = ("bin long, fill long, done boolean, members array<struct<doc_id: long, piece: int, "
        "start: long, length: long, ids_crc32: long, offset: long, ids: binary>>")
_MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64()),
                     ("ids", pa.binary())])


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item: largest first, into the fullest bin that still takes it.

    Open bins lie in stacks by room left; a bit set of the stacks in use finds the tightest one.
    Equal sizes keep their order, so the result depends on nothing but the sizes.
    """
    bins = np.empty(len(sizes), dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = opened = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = stacks[room].pop()
            if not stacks[room]:
                used ^= 1 << room
        else:
            room, number, opened = capacity, opened, opened + 1
        bins[item] = number
        left = room - size
        if left:
            stacks[left].append(number)
            used |= 1 << left
    return bins


def _emit(parts: list[pa.Array], sizes: np.ndarray, owner: np.ndarray, capacity: int,
          slack: int, last: bool, first_bin: int) -> pa.RecordBatch:
    """Bins of the items: ``parts`` are members, ``owner`` the item each member belongs to."""
    members = pa.concat_arrays(parts)
    bins = best_fit(sizes, capacity)
    of_member = bins[owner]
    order = np.argsort(of_member, kind="stable")
    members = members.take(pa.array(order))
    lengths = members.field("length").to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.bincount(of_member, minlength=int(bins.max()) + 1)
    starts = np.concatenate([[0], np.cumsum(counts)])
    ends = np.cumsum(lengths)
    before = ends - lengths
    offsets = before - np.repeat(before[starts[:-1]], counts)
    fill = np.bincount(bins, weights=sizes, minlength=len(counts)).astype(np.int64)
    members = pa.StructArray.from_arrays(
        [pa.array(offsets) if f.name == "offset" else members.field(f.name) for f in _MEMBER],
        fields=list(_MEMBER))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(first_bin, first_bin + len(counts))), pa.array(fill),
         pa.array(np.full(len(counts), True) if last else fill >= capacity - slack),
         pa.ListArray.from_arrays(pa.array(starts, pa.int32()), members)],
        names=["bin", "fill", "done", "members"])


def _first_bin(round_number: int) -> int:
    """Bins are numbered by round, task and place, so that numbers never meet."""
    return (round_number << 56) | (TaskContext.get().partitionId() << 28)


def _cut(doc_id, ids: bytes, capacity: int, keep_ids: bool) -> list[tuple]:
    step = 4 * capacity
    return [(doc_id, at // step, at // 4, len(part) // 4, zlib.crc32(part), 0,
             part if keep_ids else None)
            for at in range(0, len(ids), step) for part in (ids[at:at + step],)]


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         end_id: int = END_ID, slack: int | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids``.

    A document's ids are followed by ``end_id``; only documents longer than ``capacity`` are cut,
    into pieces of ``capacity`` and a rest. Pieces of a sequence lie gapless from offset 0. A null
    or empty text is one piece holding ``end_id`` alone. Repeated rows are packed each; a null
    ``doc_id`` stays null. ``ids`` holds the ids as unsigned 32-bit little-endian integers if
    ``keep_ids`` is set, else null. ``slack`` is the room a bin may have left to be emitted before
    the last round (default a 256th of the capacity). An empty table gives no rows.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    whole = spark.sparkContext.broadcast(prove_whole_tokens(tokenizer_path))
    slack = capacity // 256 if slack is None else slack
    end = int(end_id).to_bytes(4, "little")

    def first(batches):
        encoder, number = encoder_for(tokenizer_path, whole), _first_bin(0)
        parts, rows, held = [], 0, 0

        def flush():
            nonlocal parts, rows, held, number
            table = pa.concat_arrays(parts)
            sizes = table.field("length").to_numpy(zero_copy_only=False).astype(np.int64)
            out = _emit(parts, sizes, np.arange(len(sizes)), capacity, slack, False, number)
            number += out.num_rows
            parts, rows, held = [], 0, 0
            return out

        for batch in batches:
            pieces = []
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text"), strict=True):
                pieces += _cut(doc_id, encoder.encode(text.as_py()) + end, capacity, keep_ids)
            if pieces:
                columns = list(zip(*pieces, strict=True))
                parts.append(pa.StructArray.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _MEMBER, strict=True)],
                    fields=list(_MEMBER)))
                rows += len(pieces)
                held += parts[-1].nbytes
            if rows >= WINDOW or held >= 64 << 20:
                yield flush()
        if rows:
            yield flush()

    def again(round_number: int, last: bool):
        def run(batches):
            number, parts, fills, owners, items = _first_bin(round_number), [], [], [], 0

            def flush():
                nonlocal number, parts, fills, owners, items
                out = _emit(parts, np.concatenate(fills), np.concatenate(owners), capacity, slack,
                            last, number)
                number += out.num_rows
                parts, fills, owners, items = [], [], [], 0
                return out

            for batch in batches:
                if not batch.num_rows:
                    continue
                lists = batch.column("members")
                parts.append(lists.flatten())
                fills.append(batch.column("fill").to_numpy().astype(np.int64))
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                owners.append(np.repeat(np.arange(items, items + len(sizes)), sizes))
                items += len(sizes)
                if items >= 4 * PER_TASK or sum(p.nbytes for p in parts) >= 128 << 20:
                    yield flush()
            if items:
                yield flush()
        return run

    rounds = [written(id_and_text(documents).mapInArrow(first, _BIN), "packing")]
    left_before = None
    while True:
        left = rounds[-1].where("not done")
        count = left.count()
        if not count:
            break
        groups = -(-count // PER_TASK)
        # More rounds help only while leftovers of different tasks still find each other.
        last = groups == 1 or (left_before is not None and count > 0.95 * left_before)
        left_before = count
        rounds.append(written(
            left.repartition(groups).mapInArrow(again(len(rounds), last), _BIN), "packing"))
        if last:
            break
    bins = reduce(DataFrame.union, [r.where("done") for r in rounds])
    pieces = bins.select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m"))
    return pieces.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32",
                         "sequence_id", "m.offset", "m.ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` of packed pieces made with ``keep_ids``.

    A sequence holds at most ``capacity`` ids, so a group is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(ordered, F.lit(b"").cast("binary"),
                    lambda done, part: F.concat(done, part["ids"])).alias("ids"))
