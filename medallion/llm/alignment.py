"""Cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes. Where a token of each ends at the same byte the two are linked,
and a link's weight is how often its pair of ids is linked in the whole corpus.

1. Every task encodes its texts and sorts their (B id, A id, document, times) records. They leave as
   a run: zstd blocks, cut where the radix of the B id changes, in a written table.
2. Blocks are dealt out by radix; tasks merge the runs of a radix over a heap and add up each pair. As
   blocks arrive by their first pair, only those open at the present pair are in memory. A radix with
   much is split by run into salts, and the counts of its salts are merged once more. B comes first in
   the order, so the end of a B id yields its maximum.
3. The blocks stream past the counts of their radix, which the vocabularies bound, and give every
   document its share back, summed by run.

Both vocabularies break their text at a blank behind a character that is none, so texts are encoded
in such stretches and stretches that come again are remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import id_and_text, prepare_workers, written

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: B ids of one radix; bounds the counts a task holds to RADIX times the other vocabulary.
RADIX = 128
#: Records of a block, and pairs and records of a salt.
BLOCK, SALT_PAIRS, SALT_RECORDS = 1 << 16, 1 << 21, 1 << 23
#: Documents whose sums a task holds before it lets them go.
HELD = 1 << 20
#: Bytes of text that make a run.
RUN_BYTES = 4 << 20
MEMO_STRETCHES, MEMO_CHARS = 200_000, 64
#: U+2581 is B's blank; a text that holds it has other bytes in B.
_MARK = "▁"
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
#: Fixed value: how byte-level vocabularies part a text before their merges.
_PRE_TOKENS = (r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Ends of a text that cannot stand beside another stretch.
_LOOSE = re.compile(r"\A(?:[\s\u180e]|\Z)|[\s\u180e]\Z")
_CUT = re.compile(r"(?<=[^\s᠎▁]) (?=\S)")

RUNS = ("kind int, run long, docs_in_run int, radix int, first long, n_pairs long, n_records long, "
        "pairs binary, documents binary, place int, doc_id long, n_a long, n_b long, "
        "n_groups long, groups_sha256 string")
SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(
        np.ascontiguousarray(a, "<i8").tobytes() for a in arrays))


def _unpacked(blob: bytes, parts: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<i8").reshape(parts, -1)


class Aligner:
    """Token groups of a text; ``links`` are ``B id << 32 | A id`` of tokens that end together."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [n for n in range(256) if n not in plain]
        letters = {chr(n): n for n in plain} | {chr(256 + k): n for k, n in enumerate(others)}
        self.bytes_a = {number: bytes(letters[c] for c in entry)
                        for entry, number in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(n)[3:5], 16)]) if self.b.is_byte(n)
            else self.b.id_to_piece(n).replace(_MARK, " ").encode() for n in range(len(self.b))]
        # The same merges by a faster library, for letters all Unicode versions agree on.
        self.latin_a = tiktoken.Encoding("a", pat_str=_PRE_TOKENS, special_tokens={}, mergeable_ranks={
            entry: number for number, entry in self.bytes_a.items()})
        last = max(self.bytes_a) + 1
        self.sizes_a = np.array([len(self.bytes_a.get(n, b"")) for n in range(last)], np.int64)
        self.sizes_b = np.array([len(b) for b in self.bytes_b], np.int64)
        self.text_a, self.last_a, self.text_b, self.last_b = (
            np.array([f"{n}{mark}" for n in range(size)], object)
            for size, mark in ((last, ","), (last, "|"), (len(self.b), ","), (len(self.b), ";")))
        self.memo: dict[str, int] = {}
        self.known: list[tuple | None] = []

    def align(self, text: str) -> tuple[int, int, int, str, bytes] | None:
        """``n_a, n_b, n_groups, groups, links`` of blank + text; None if either has other bytes."""
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        bytes_a, bytes_b = [self.bytes_a[n] for n in ids_a], [self.bytes_b[n] for n in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
            return None
        groups, links, i, begun_a, begun_b, at_a = [], array("q"), 0, 0, 0, 0
        at_b = 0
        for j, piece in enumerate(bytes_b):
            at_b += len(piece)
            while at_a < at_b:
                at_a += len(bytes_a[i])
                i += 1
            if at_a == at_b:
                groups.append(",".join(map(str, ids_a[begun_a:i])) + "|"
                              + ",".join(map(str, ids_b[begun_b:j + 1])))
                links.append(ids_b[j] << 32 | ids_a[i - 1])
                begun_a, begun_b = i, j + 1
        return len(ids_a), len(ids_b), len(groups), ";".join(groups), links.tobytes()

    def learn(self, parts: list[str], encode_a: Callable[[str], list[int]]) -> None:
        """Align many stretches as one text; the same as ``align`` of each, as none begins or ends
        with a blank."""
        whole = " ".join(parts)
        ids_a, ids_b = encode_a(" " + whole), self.b.encode(whole)
        if not (b"".join(map(self.bytes_a.__getitem__, ids_a)) == b" " + whole.encode()
                == b"".join(map(self.bytes_b.__getitem__, ids_b))):
            self.known.extend(map(self.align, parts))
            return
        flat_a, flat_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[flat_a]), np.cumsum(self.sizes_b[flat_b])
        common = np.isin(ends_a, ends_b, assume_unique=True)
        common_b = np.isin(ends_b, ends_a, assume_unique=True)
        # A's tokens of a group, then B's: their texts with the mark that follows each.
        group_a = np.cumsum(common) - common
        group_b = np.cumsum(common_b) - common_b
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        marked = np.concatenate([
            np.where(common, self.last_a[flat_a], self.text_a[flat_a]),
            np.where(common_b, self.last_b[flat_b], self.text_b[flat_b])])[order].tolist()
        links = flat_b[common_b] << 32 | flat_a[common]
        till = np.cumsum([len(part.encode()) + 1 for part in parts])
        till_a, till_b = np.searchsorted(ends_a, till) + 1, np.searchsorted(ends_b, till) + 1
        counts_a, counts_b = np.diff(till_a, prepend=0), np.diff(till_b, prepend=0)
        groups = np.diff(np.cumsum(common)[till_a - 1], prepend=0)
        tokens = np.cumsum(counts_a + counts_b)
        at_token = at_link = 0
        for n_a, n_b, n, token in zip(counts_a.tolist(), counts_b.tolist(), groups.tolist(),
                                      tokens.tolist()):
            self.known.append((n_a, n_b, n, "".join(marked[at_token:token])[:-1],
                               links[at_link:at_link + n].tobytes()))
            at_token, at_link = token, at_link + n

    def stretches(self, texts: list[str]) -> list[list[int]]:
        """Numbers in ``known`` of the stretches of each text; none for one without tokens."""
        memo, split = self.memo, []
        for text in texts:
            split.append(_CUT.split(text) if text and _MARK not in text else [])
        fresh = set(chain.from_iterable(split)).difference(memo)
        loose = [part for part in fresh if _LOOSE.search(part)]
        fresh.difference_update(loose)
        plain = [part for part in fresh if not _BEYOND_LATIN.search(part)]
        others = list(fresh.difference(plain))
        base = len(self.known)
        if plain:
            self.learn(plain, self.latin_a.encode_ordinary)
        if others:
            self.learn(others, lambda text: self.a.encode(text, add_special_tokens=False).ids)
        self.known.extend(map(self.align, loose))
        memo.update(zip([*plain, *others, *loose], range(base, len(self.known))))
        found = [list(map(memo.__getitem__, parts)) for parts in split]
        for part in [*fresh, *loose]:
            if len(part) > MEMO_CHARS:
                del memo[part]
        if None in self.known:
            for n, text in enumerate(texts):
                if any(self.known[k] is None for k in found[n]):
                    # Bytes that one stretch lacks could be those another has too many.
                    self.known.append(self.align(text))
                    found[n] = [len(self.known) - 1] if self.known[-1] else []
        return found

    def forget(self) -> None:
        """Between runs: numbers are good within one."""
        if len(self.known) > MEMO_STRETCHES:
            self.memo.clear()
            self.known.clear()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _records(aligner: Aligner, stretches: list[list[int]]) -> tuple[np.ndarray, ...]:
    """``link, document, times`` of a run, sorted by link and document, each pair of them once."""
    lengths = np.array([len(s) for s in stretches], np.int64)
    numbers = np.fromiter((n for s in stretches for n in s), np.int64, int(lengths.sum()))
    size = max(len(aligner.known), 1)
    both, times = np.unique(np.repeat(np.arange(len(lengths)), lengths) * size + numbers,
                            return_counts=True)
    documents, numbers = both // size, both % size
    used, where = np.unique(numbers, return_inverse=True)
    held = [aligner.known[n][4] for n in used.tolist()]
    sizes = np.array([len(h) // 8 for h in held], np.int64)
    flat = np.frombuffer(b"".join(held), "=i8")
    each, begins = sizes[where], (np.cumsum(sizes) - sizes)[where]
    at = np.repeat(begins - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
    links, documents, times = flat[at], np.repeat(documents, each), np.repeat(times, each)
    order = np.lexsort((documents, links))
    links, documents, times = links[order], documents[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(links) != 0) | (
        np.diff(documents) != 0)])) if len(links) else np.zeros(0, np.int64)
    return links[new], documents[new], np.add.reduceat(times, new) if len(new) else times


def _blocks(links: np.ndarray, documents: np.ndarray, times: np.ndarray) -> Iterator[tuple]:
    """``radix, first, n_pairs, n_records, pairs, documents`` of the blocks of a run."""
    radix = (links >> 32) // RADIX
    edges = [0, *(np.flatnonzero(np.diff(radix)) + 1).tolist(), len(links)] if len(links) else []
    for begin, end in zip(edges, edges[1:]):
        for low in range(begin, end, BLOCK):
            high = min(low + BLOCK, end)
            part = links[low:high]
            new = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
            pairs = part[new]
            yield (int(radix[low]), int(pairs[0]), len(pairs), high - low,
                   _packed(np.diff(pairs, prepend=0), np.diff(np.append(new, high - low)),
                           np.add.reduceat(times[low:high], new)),
                   _packed(np.diff(documents[low:high], prepend=0), times[low:high]))


def _small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about RUN_BYTES of text, or of one text that is longer."""
    for batch in batches:
        sizes = np.array([len(t.as_buffer()) for t in batch.column("text")], np.int64)
        part = (np.cumsum(sizes) - sizes) // RUN_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if high > low:
                yield batch.slice(low, high - low)


def _runs(path_a: str, path_b: str):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _ALIGNERS:
            _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
        aligner, number = _ALIGNERS[path_a, path_b], TaskContext.get().partitionId() << 32
        names = [field.split()[0] for field in RUNS.split(", ")]
        for batch in _small(batches):
            aligner.forget()
            found = aligner.stretches(batch.column("text").to_pylist())
            rows = []
            for place, (doc_id, numbers) in enumerate(zip(
                    batch.column("doc_id").to_pylist(), found)):
                held = [aligner.known[n] for n in numbers]
                groups = ";".join([h[3] for h in held])
                rows.append((0, number, None, None, None, None, None, None, None, place, doc_id,
                             sum([h[0] for h in held]), sum([h[1] for h in held]),
                             sum([h[2] for h in held]),
                             hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
            for block in _blocks(*_records(aligner, found)):
                rows.append((1, number, len(found), *block, *[None] * 6))
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), _RUN_TYPES)],
                names=names)
    return encode


_RUN_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
              pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
              pa.int64(), pa.string()]


def _items(pairs: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
    for low in range(0, len(pairs), 256):
        yield from zip(pairs[low:low + 256].tolist(), counts[low:low + 256].tolist())


def merge_runs(blocks: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """``pair, count`` in order of pairs, of sorted blocks that come in order of their first pair."""
    heap: list[tuple] = []
    pair, total, number = None, 0, 0

    def drained(upto: int | None) -> Iterator[tuple[int, int]]:
        nonlocal pair, total
        while heap and (upto is None or heap[0][0] < upto):
            key, who, count, rest = heap[0]
            if key != pair:
                if pair is not None:
                    yield pair, total
                pair, total = key, 0
            total += count
            following = next(rest, None)
            if following is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (following[0], who, following[1], rest))

    for pairs, counts in blocks:
        rest = _items(pairs, counts)
        key, count = next(rest)
        yield from drained(key)
        heapq.heappush(heap, (key, number, count, rest))
        number += 1
    yield from drained(None)
    if pair is not None:
        yield pair, total


def _grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator]]:
    """Rows as dicts, by runs of equal ``keys``; a group is streamed."""
    rows = (row for batch in batches for small in range(0, batch.num_rows, 64)
            for row in batch.slice(small, 64).to_pylist())
    return groupby(rows, key=lambda row: tuple(row[k] for k in keys))


def _chunks(items: Iterable[tuple[int, ...]], size: int = BLOCK) -> Iterator[np.ndarray]:
    items = iter(items)
    while chunk := list(islice(items, size)):
        yield np.array(chunk, np.int64).T


def _salted_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted pairs of each salt of a radix, as one run more."""
    def opened(rows):
        for row in rows:
            gaps, _, counts = _unpacked(row["pairs"], 3)
            yield np.cumsum(gaps), counts

    for (radix, _), rows in _grouped(batches, ["radix", "salt"]):
        for pairs, counts in _chunks(merge_runs(opened(rows))):
            yield pa.RecordBatch.from_pylist([{
                "radix": radix, "first": int(pairs[0]), "pairs": _packed(pairs, counts)}],
                schema=pa.schema([("radix", pa.int32()), ("first", pa.int64()),
                                  ("pairs", pa.binary())]))


def _with_best(merged: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """``pair, count, whether the count is the highest of its B id``; holds one B id's pairs."""
    held: list[tuple[int, int]] = []
    highest = 0
    for pair, count in merged:
        if held and held[0][0] >> 32 != pair >> 32:
            yield from ((p, c, int(c == highest)) for p, c in held)
            held, highest = [], 0
        held.append((pair, count))
        highest = max(highest, count)
    yield from ((p, c, int(c == highest)) for p, c in held)


def _final_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix,), rows in _grouped(batches, ["radix"]):
        merged = merge_runs(tuple(_unpacked(row["pairs"], 2)) for row in rows)
        for pairs, counts, best in _chunks(_with_best(merged)):
            yield pa.RecordBatch.from_pylist([{
                "radix": radix, "first": int(pairs[0]), "pairs": _packed(pairs, counts, best)}],
                schema=pa.schema([("radix", pa.int32()), ("first", pa.int64()),
                                  ("pairs", pa.binary())]))


_SHARES = "run long, best binary, total binary"


def _shares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the links of each block add to the documents of its run, summed by run."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    schema = pa.schema([("run", pa.int64()), ("best", pa.binary()), ("total", pa.binary())])

    def let_go():
        for run, (best, total) in sums.items():
            yield pa.RecordBatch.from_pylist(
                [{"run": run, "best": _packed(best), "total": _packed(total)}], schema=schema)
        sums.clear()

    held = 0
    for _, rows in _grouped(batches, ["radix", "salt"]):
        counted, table = [], None
        for row in rows:
            if row["kind"] == 0:
                counted.append(_unpacked(row["pairs"], 3))
                continue
            if table is None:
                table = np.concatenate(counted, axis=1)
            gaps, entries, _ = _unpacked(row["pairs"], 3)
            found = np.searchsorted(table[0], np.cumsum(gaps))
            gaps, times = _unpacked(row["documents"], 2)
            documents = np.cumsum(gaps)
            if row["run"] not in sums:
                held += row["docs_in_run"]
                sums[row["run"]] = (np.zeros(row["docs_in_run"], np.int64),
                                    np.zeros(row["docs_in_run"], np.int64))
            best, total = sums[row["run"]]
            np.add.at(best, documents, np.repeat(table[2][found], entries) * times)
            np.add.at(total, documents, np.repeat(table[1][found], entries) * times)
            if held > HELD:
                yield from let_go()
                held = 0
    yield from let_go()


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the result: the shares of a run come first, then its documents."""
    fields = [field.split()[0] for field in SCHEMA.split(", ")]
    schema = pa.schema([(name, pa.string() if name == "groups_sha256" else pa.int64())
                        for name in fields])
    for _, rows in _grouped(batches, ["run"]):
        best = total = None
        out = []
        for row in rows:
            if row["kind"] == 0:
                one, other = _unpacked(row["best"], 1)[0], _unpacked(row["total"], 1)[0]
                best, total = (one, other) if best is None else (best + one, total + other)
                continue
            at = row["place"]
            out.append({name: row.get(name) for name in fields} | {
                "n_links": row["n_groups"], "n_best": 0 if best is None else int(best[at]),
                "count_sum": 0 if total is None else int(total[at])})
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def spilled_runs(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The written runs: a row per document (kind 0) and a row per block (kind 1)."""
    prepare_workers(documents.sparkSession)
    return written(id_and_text(documents).mapInArrow(_runs(path_a, path_b), RUNS), "align-runs")


def pair_counts(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``radix, first, pairs`` with counts and maxima, written, and ``radix, salts``.

    There is a row of salts per RADIX ids of the vocabulary, so that table is small at any size.
    """
    blocks = runs.where("kind = 1")
    salts = written(blocks.groupBy("radix").agg(F.greatest(
        F.ceil(F.sum("n_pairs") / SALT_PAIRS), F.ceil(F.sum("n_records") / SALT_RECORDS),
        F.lit(1)).cast("int").alias("salts")), "align-salts")
    kind = "radix int, first long, pairs binary"
    partial = _salted(blocks, salts).select("radix", "salt", "first", "run", "pairs").repartition(
        "radix", "salt").sortWithinPartitions("radix", "salt", "first").mapInArrow(
        _salted_counts, kind)
    return written(partial.repartition("radix").sortWithinPartitions("radix", "first").mapInArrow(
        _final_counts, kind), "align-counts"), salts


def _salted(blocks: DataFrame, salts: DataFrame) -> DataFrame:
    return blocks.join(F.broadcast(salts), "radix").withColumn(
        "salt", F.pmod(F.xxhash64("run"), F.col("salts")).cast("int"))


def align_tokenizers(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    A text that is null or empty, or that either tokenizer gives back with other bytes, has no
    tokens: all counts are 0 and the digest is ''. Special strings inside texts are plain text. A
    link is a pair of tokens that end at the same byte, so every group has one. Repeated rows count
    each, also in the corpus; a null ``doc_id`` stays null. Texts are read whole. Other columns are not
    read. An empty table gives no rows.
    """
    runs = spilled_runs(documents, path_a, path_b)
    counts, salts = pair_counts(runs)
    spread = counts.join(F.broadcast(salts), "radix").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    none = F.lit(None)
    both = spread.select(
        "radix", "salt", F.lit(0).alias("kind"), "first", none.cast("long").alias("run"),
        none.cast("int").alias("docs_in_run"), "pairs", none.cast("binary").alias("documents"),
    ).unionByName(_salted(runs.where("kind = 1"), salts).select(
        "radix", "salt", "kind", "first", "run", "docs_in_run", "pairs", "documents"))
    shares = both.repartition("radix", "salt").sortWithinPartitions(
        "radix", "salt", "kind", "first").mapInArrow(_shares, _SHARES)
    rows = runs.where("kind = 0").select(
        "run", F.lit(1).alias("kind"), "place", "doc_id", "n_a", "n_b", "n_groups",
        "groups_sha256", none.cast("binary").alias("best"), none.cast("binary").alias("total"))
    empty = [none.cast(kind).alias(name) for name, kind in rows.dtypes[2:8]]
    return shares.select("run", F.lit(0).alias("kind"), *empty, "best", "total").unionByName(
        rows).repartition("run").sortWithinPartitions("run", "kind", "place").mapInArrow(
        _documents, SCHEMA)
