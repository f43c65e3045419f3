"""Benchmark decontamination by CGK embedding.

Items and item-sized windows of the documents are strings of words. A random walk over a string
(CGK embedding) writes the word it stands on and moves on or not, as a random function of step and
word says; strings at a small edit distance soon walk alike again, so their embeddings differ in
few places. Bit sampling hashes a few places of the embedding, again and again with other places
and other walks. Walks drift apart with every edit, so a fixed number of samples is enough only
up to some length: items of more than STRETCH words are cut into parts of about equal length up to
that. If every part had more edits than its length allows, the item would have too (pigeonhole), so
one part is found where the item is. Pairs that meet are verified by the exact edit distance of the
whole item to the best stretch of the text.

A window that shares too few word pairs with all items cannot be within the distance (q-gram
lemma), so only the others are embedded; this loses nothing. The benchmark is the stated query set:
it is sent to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.chartext import Lookup
from medallion.llm.common import free_name, id_and_text, prepare_workers, text_name

SIMILARITY = 0.8
WALKS = 2
SAMPLES = 32
PLACES = 3
#: Words of an item in one part. At 20 % edits about 1 in 100 strings of up to this length do not meet.
STRETCH = 40
#: Documents searched, and windows embedded, at once.
ROWS = 1_000
WINDOWS = 10_000
#: Text of the benchmark in one block.
BLOCK_BYTES = 8 << 20
SEED = 20240

_WORD = re.compile(r"\w+")
#: What keeps a text from being words, one blank or line end between them, with at most one of
#: these marks behind each.
_UNEVEN = re.compile(r"[^\w .,\n]|[.,][^ \n]")
_LEADING = (" .", " ,", "\n.", "\n,")


def _even(text: str) -> bool:
    return not (_UNEVEN.search(text) or text[:1] in (".", ",") or any(m in text for m in _LEADING))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def allowed(length: int, similarity: float = SIMILARITY) -> int:
    """Edits an item of so many words may be away."""
    return int(length * (1 - similarity) + 1e-9)


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """``distance, start, end`` of the stretch of ``text`` nearest to ``item`` in word edits.

    Of equal stretches the one that ends first, and of those the shortest.
    """
    n = len(text)
    index = np.arange(n + 1)
    row, start = np.zeros(n + 1, np.int64), index.copy()
    for i, word in enumerate(item):
        # Cost and start travel as one number, so that ties prefer the later start.
        packed = row * (n + 2) + (n + 1 - start)
        step = np.empty(n + 1, np.int64)
        step[0] = packed[0] + (n + 2)
        step[1:] = np.minimum(packed[:-1] + (text != word) * (n + 2), packed[1:] + (n + 2))
        step = np.minimum.accumulate(step - index * (n + 2)) + index * (n + 2)
        row, start = step // (n + 2), n + 1 - step % (n + 2)
    end = int(row.argmin())
    return int(row[end]), int(start[end]), end


def _mix(values: np.ndarray, seed: int) -> np.ndarray:
    """64 pseudo-random bits per value."""
    x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _repeated(codes: np.ndarray) -> np.ndarray:
    """For each place but the first and the last, whether the pair there repeats the one before."""
    return (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2])


@dataclass
class Index:
    """One block of the benchmark: vocabulary, word pairs, and hash tables per item length."""

    ids: list[int | None]
    items: list[np.ndarray]
    parts: list[tuple[int, int, np.ndarray]]  # item, place of its first word, words
    vocabulary: dict[str, int]
    similarity: float
    walks: int
    samples: int
    places: int
    short: dict[int, dict[tuple[int, ...], list[int]]]  # by length: words of items found exactly
    pairs: Lookup = None
    lengths: list[int] = field(default_factory=list)
    sampled: dict[int, np.ndarray] = field(default_factory=dict)
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    bits: list[list[np.ndarray]] = field(default_factory=list)
    labels: np.ndarray = None
    spelled: dict[str, int] = field(default_factory=dict)
    distinct: list[np.ndarray] = field(default_factory=list)
    needs: dict[int, int] = field(default_factory=dict)

    @classmethod
    def build(cls, items: list[tuple[int | None, str]], similarity: float = SIMILARITY,
              walks: int = WALKS, samples: int = SAMPLES, places: int = PLACES) -> Index:
        vocabulary: dict[str, int] = {}
        ids, coded = [], []
        for number, text in items:
            words = words_of(text)
            if words:
                ids.append(number)
                coded.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1)
                                       for w in words], np.int64))
        parts, short = [], {}
        for number, code in enumerate(coded):
            if not allowed(len(code), similarity):
                short.setdefault(len(code), {}).setdefault(tuple(code.tolist()), []).append(number)
                continue
            offset = 0
            for part in np.array_split(code, -(-len(code) // STRETCH)):
                parts.append((number, offset, part))
                offset += len(part)
        self = cls(ids, coded, parts, vocabulary, similarity, walks, samples, places, short)
        longest = max((len(c) for _, _, c in parts), default=0)
        symbols = np.arange(len(vocabulary) + 1)
        self.bits = [[_mix(symbols, SEED + 1000 * w + block) for block in range(
            -(-2 * longest // 64))] for w in range(walks)]
        self.labels = _mix(symbols, SEED)
        self.spelled = {w + mark: n for w, n in vocabulary.items() for mark in ("", ".", ",")}
        self.distinct = [np.unique(c) for c in coded]
        pairs = [self.pair_keys(c) for c in coded if allowed(len(c), similarity)]
        keys = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.uint64)
        self.pairs = Lookup(keys, np.ones(len(keys)))
        random = np.random.default_rng(SEED)
        for length in sorted({len(c) for _, _, c in parts}):
            steps = 2 * length
            self.sampled[length] = random.integers(0, steps, (walks, samples, places))
            own = [i for i, (_, _, c) in enumerate(parts) if len(c) == length]
            text = np.concatenate([np.append(parts[i][2], 0) for i in own])
            starts = np.arange(len(own)) * (length + 1)
            keys = self.keys(text, starts, starts + length, length)
            rows = np.tile(np.array(own), (keys.shape[0], 1))
            flat, item = keys.ravel(), rows.ravel()
            sort = np.argsort(flat, kind="stable")
            self.tables[length] = flat[sort], item[sort]
            self.lengths.append(length)
            self.needs[length] = max(0, min(self._needed(parts[i][2]) for i in own))
        return self

    def _needed(self, item: np.ndarray) -> int:
        """Word pairs that a stretch within the distance shares with the item or part, at least.

        An edit takes two pairs. A pair that repeats the one before it is not counted: a stretch may
        begin within such a run, and in an item that has runs an edit may take one pair more.
        """
        runs = int(_repeated(item).sum()) if len(item) > 2 else 0
        edits = allowed(len(item), self.similarity)
        return len(item) - 2 - runs - (3 if runs else 2) * edits

    def codes(self, text: str) -> np.ndarray:
        """Numbers of the words of a lower-cased text; 0 for a word that no item has."""
        words = text.split() if _even(text) else _WORD.findall(text)
        return np.fromiter(map(self.spelled.get, words, repeat(0)), np.int64, len(words))

    @staticmethod
    def pair_keys(codes: np.ndarray) -> np.ndarray:
        return (codes[:-1].astype(np.uint64) << np.uint64(32)) | codes[1:].astype(np.uint64)

    def keys(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray,
             length: int) -> np.ndarray:
        """Hash keys of the windows, a row per walk and sample.

        ``text[end]`` exists; at its end a window reads the blank symbol 0 and stays there.
        """
        steps = 2 * length
        out = np.empty((self.walks * self.samples, len(starts)), np.uint64)
        for walk in range(self.walks):
            wanted = self.sampled[length][walk]
            written = np.zeros((steps, len(starts)), np.uint64)
            at = starts.copy()
            for step in range(steps):
                symbol = np.where(at < ends, text[at], 0)
                written[step] = self.labels[symbol]
                at += (self.bits[walk][step // 64][symbol] >> np.uint64(step % 64)).astype(
                    np.int64) & (at < ends)
            for sample, chosen in enumerate(wanted):
                key = out[walk * self.samples + sample]
                key[:] = walk * self.samples + sample
                for place in chosen:
                    key *= np.uint64(0x9E3779B97F4A7C15)
                    key += written[place]
        return out

    def candidates(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows ``part, start`` that met in a hash table.

        ``text`` holds documents in a row, a blank symbol after each; ``ends`` gives for every place
        the end of its document.
        """
        n = len(text)
        places = np.flatnonzero((text[:-1] > 0) & (text[1:] > 0))
        hit = np.zeros(n, np.int32)
        hit[places] = self.pairs.get(
            (text[places].astype(np.uint64) << np.uint64(32)) | text[places + 1].astype(np.uint64))[1]
        hit[1:-1][_repeated(text)] = 0
        sums = np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
        found = []
        needs = self.needs
        widest = max(m + allowed(m, self.similarity) - 1 for m in self.lengths)
        at = np.arange(n)
        at = at[sums[np.minimum(at + widest, ends)] - sums[:-1] >= min(needs.values())]
        for length in self.lengths:
            until = np.minimum(at + (length + allowed(length, self.similarity) - 1), ends[at])
            starts = at[sums[until] - sums[at] >= needs[length]]
            known, parts = self.tables[length]
            for part in range(0, len(starts), WINDOWS):
                own = starts[part:part + WINDOWS]
                keys = self.keys(text, own, np.minimum(own + length, ends[own]), length)
                for row in keys:
                    low = np.searchsorted(known, row)
                    met = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == row)
                    if len(met):
                        count = np.searchsorted(known, row[met], "right") - low[met]
                        before = np.repeat(np.cumsum(count) - count, count)
                        entry = np.repeat(low[met], count) + np.arange(count.sum()) - before
                        found.append(np.stack([parts[entry], np.repeat(own[met], count)], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)

    def exact(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """``item, start, end`` of the first stretch equal to each item that may have no edit."""
        out, known = [], np.flatnonzero(codes > 0)
        for length, items in self.short.items():
            if len(known) < length:
                continue
            firsts = np.array(sorted({words[0] for words in items}), np.int64)
            open_items = dict(items)
            for at in known[np.isin(codes[known], firsts)].tolist():
                for item in open_items.pop(tuple(codes[at:at + length].tolist()), ()):
                    out.append((item, at, at + length))
                if not open_items:
                    break
        return sorted(out)

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """``text, item id, item length, distance, start, end`` of each item found in one of the
        lower-cased texts: its best stretch."""
        codes = [self.codes(text) for text in texts]
        lengths = np.array([len(c) + 1 for c in codes], np.int64)
        last = np.cumsum(lengths) - 1
        exact = [(number, self.ids[item], end - start, 0, start, end)
                 for number, code in enumerate(codes) for item, start, end in (
                     self.exact(code) if self.short else ())]
        if not len(lengths) or not self.lengths:
            return exact
        text = np.concatenate([np.append(c, 0) for c in codes])
        pairs = self.candidates(text, np.repeat(last, lengths))
        owner = np.searchsorted(last, pairs[:, 1])
        near: dict[tuple[int, int], list[int]] = {}
        for number, (part, start) in zip(owner.tolist(), pairs.tolist(), strict=True):
            item, offset, _ = self.parts[part]  # where the item begins if no edit is before the part
            near.setdefault((number, item), []).append(
                start - offset - int(last[number] - lengths[number] + 1))
        out = exact
        for (number, item), starts in sorted(near.items()):
            wanted, words = self.items[item], codes[number]
            edits = allowed(len(wanted), self.similarity)
            # A part may also meet a few words beside its own best stretch.
            slack = edits + (allowed(STRETCH, self.similarity) if len(wanted) > STRETCH else 0)
            starts.sort()
            best, at = None, 0
            while at < len(starts):  # overlapping neighbourhoods are verified together
                begin = max(0, starts[at] - slack)
                end = max(0, starts[at] + len(wanted) + edits + slack)
                while at + 1 < len(starts) and starts[at + 1] - slack <= end:
                    at += 1
                    end = max(0, starts[at] + len(wanted) + edits + slack)
                at += 1
                stretch = words[begin:end]
                if np.isin(self.distinct[item], stretch).sum() < len(self.distinct[item]) - edits:
                    continue  # every word of the item that is missing takes an edit
                distance, a, b = best_stretch(wanted, stretch)
                if distance <= edits and (best is None or distance < best[0]):
                    best = distance, begin + a, begin + b
            if best:
                out.append((number, self.ids[item], len(wanted), *best))
        return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [items.where(number == i) for i in range(count)]


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns. A row is named by its id
    and its text's hash: one without an id goes only if its own text holds an item, and so do rows
    that share an id."""
    last, (sid, th) = F.lit((1 << 63) - 1), (free_name(documents, n) for n in ("_sid", "_th"))
    leaks = _search(documents, benchmark).select(
        F.coalesce("doc_id", last).alias(sid), F.col("th").alias(th)).distinct()
    marked = documents.withColumns({
        sid: F.coalesce(F.col("doc_id").cast("long"), last),
        th: text_name(F.col("text"))})
    return marked.join(leaks, [sid, th], "left_anti").drop(sid, th)


def contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 walks: int = WALKS, samples: int = SAMPLES, places: int = PLACES,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, item_words, distance,
    similarity, start_word, end_word, start_char, end_char``.

    Words are runs of letters, digits and underscores, lower-cased; an item is found if a stretch
    of the whole text is within ``(1 - similarity)`` of the item's words in word edits. The best
    stretch is given, the first of equal ones. Items so short that no edit is allowed are found as
    exact copies. Null or empty texts and items give no rows. Rows that repeat a document or an item, id and text, give
    equal rows; items that share a text are each found. A null ``item_id`` is searched for like any
    other and, like a null ``doc_id``, stays null. Other columns are not read.
    """
    return _search(documents, benchmark, similarity, walks, samples, places, block_bytes).drop("th")


def _search(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
            walks: int = WALKS, samples: int = SAMPLES, places: int = PLACES,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``contaminated`` with ``th``, the hash of the document's text."""
    spark = documents.sparkSession
    prepare_workers(spark)
    result = None
    for block in _blocks(benchmark, block_bytes):
        items = sorted(((r.item_id, r.text) for r in block.collect()),
                       key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        shared = spark.sparkContext.broadcast(Index.build(items, similarity, walks, samples, places))

        def search(batches, shared=shared):
            index = shared.value
            for batch in (whole.slice(at, ROWS) for whole in batches
                          for at in range(0, whole.num_rows, ROWS)):
                rows, ids = [], batch.column("doc_id").to_pylist()
                hashes = batch.column("th").to_pylist()
                texts = [text.lower() for text in batch.column("text").to_pylist()]
                found = index.matches(texts)
                for number, item, length, distance, a, b in found:
                    spans = [m.span() for n, m in zip(range(b), _WORD.finditer(texts[number]))
                             if n >= a]
                    rows.append((ids[number], item, length, distance, 1 - distance / length, a, b,
                                 spans[0][0], spans[-1][1], hashes[number]))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, _TYPES.values(), strict=True)],
                        names=list(_TYPES))

        found = id_and_text(documents).withColumn("th", text_name(F.col("text"))).mapInArrow(
            search, "doc_id long, item_id long, item_words int, distance int, similarity double, "
                    "start_word int, end_word int, start_char int, end_char int, th string")
        result = found if result is None else result.union(found)
    return result


_TYPES = {"doc_id": pa.int64(), "item_id": pa.int64(), "item_words": pa.int32(),
          "distance": pa.int32(), "similarity": pa.float64(), "start_word": pa.int32(),
          "end_word": pa.int32(), "start_char": pa.int32(), "end_char": pa.int32(), "th": pa.string()}
