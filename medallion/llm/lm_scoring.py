"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts with counts from all training documents. A byte is coded in the
longest context that knows it; leaving a context costs its escape probability, and the symbols of
the context that was left are excluded from the shorter one. The longest contexts count how often a
byte follows; shorter ones, which only meet what the longer ones do not know, count in how many next
longer contexts it follows. Every count gives ``DISCOUNT`` of itself to the escape. Beside it stands
a plain unigram base over words.

Nothing is cut off: every byte string of the training documents counts, and the counts stay in
tables that grow with the corpus. A window has one log-probability wherever it stands. Those that
make up one part in ``NODES`` of all are broadcast with it, which spares most lookups a shuffle; all
other windows of a document meet theirs in a join. Windows that training never saw are resolved
once each, by a join per order. Words are likewise looked up in a table of those that make up one
part in ``WORDS`` of all tokens; all other words meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.chartext import Lookup
from medallion.llm.common import crc_bucket, id_and_text, prepare_workers, written

ORDER = 5
#: What each symbol of a context gives to its escape.
DISCOUNT = 0.3
NODES = 4_000_000
WORDS = 1_000_000
HELD_OUT, HELD_OUT_IS = 7, 2
#: UTF-8 never holds these two bytes: what stands before a text, and its end.
BEFORE, END = 0xFE, 0xFF
SYMBOLS = 255
CHUNK = 1 << 18
#: Documents scored at once.
ROWS = 512
FLUSH_WORDS = 300_000
#: Windows counted at once, and different ones that a task holds before it gives its sums away.
GRAMS, FLUSH_GRAMS = 1 << 21, 1 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def windows(texts: list[bytes], order: int):
    """``owner, keys``: for every byte and the end of each text, it and the ``order`` bytes before.

    Texts are taken several at a time, long ones in slices that overlap by the context.
    """
    before = bytes([BEFORE]) * order
    owner, parts, size = [], [], 0

    def done():
        data = np.frombuffer(b"".join(parts), np.uint8)
        lengths = np.array([len(p) for p in parts])
        number = np.repeat(np.array(owner), lengths)
        count = len(data) - order
        keys = np.zeros(count, np.uint64)
        for i in range(order + 1):
            keys <<= np.uint64(8)
            keys |= data[i:i + count]
        # A slice's first bytes are context only.
        ends = np.cumsum(lengths)
        real = np.ones(len(data), bool)
        for i in range(order):
            real[ends - lengths + i] = False
        return number[order:][real[order:]], keys[real[order:]]

    for n, text in enumerate(texts):
        data = before + text + bytes([END])
        for at in range(0, len(data) - order, CHUNK):
            part = data[at:at + CHUNK + order]
            owner.append(n)
            parts.append(part)
            size += len(part)
            if size >= CHUNK:
                yield done()
                owner, parts, size = [], [], 0
    if parts:
        yield done()


def _tagged(keys: np.ndarray, order: int) -> np.ndarray:
    """Keys of all orders in one table: the order in the highest byte, which no key reaches."""
    return keys | np.uint64((order + 1) << 56)


def _suffix(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & np.uint64((1 << (8 * n)) - 1)


@dataclass
class Trie:
    """Probabilities of all orders, as base-10 logarithms in flat tables: the plain version of
    ``known_logs`` and ``unknown_logs``, in the memory of one process."""

    order: int
    symbol: Lookup    # (order, context, symbol): log of the discounted count
    context: Lookup   # (order, context): row of ``costs``
    costs: np.ndarray  # log total; log escape probability; the same two in the next shorter
    #                    context, without the symbols of this one
    unseen: float     # log probability of a symbol no context knows

    @classmethod
    def build(cls, grams: dict[int, tuple[np.ndarray, np.ndarray]], order: int) -> Trie:
        """``grams``: counts of the kept byte strings by length, 1 to ``order`` + 1, sorted. Only
        those of the longest are read; shorter strings count the kept ones that end in them."""
        symbol_keys, symbol_values, context_keys, costs = [], [], [], []
        below = None
        for k in range(order + 1):
            keys, counts = grams[k + 1]
            if k < order:
                longer = _suffix(grams[k + 2][0], k + 1)
                counts = np.bincount(np.searchsorted(keys, longer), minlength=len(keys))
                counts = np.maximum(counts, 1)  # no longer string was kept
            counts = counts.astype(float)
            symbol_keys.append(_tagged(keys, k))
            symbol_values.append(np.log10(counts - DISCOUNT))
            contexts, place, distinct = np.unique(
                keys >> np.uint64(8), return_inverse=True, return_counts=True)
            whole = np.bincount(place, weights=counts, minlength=len(contexts))
            own = np.stack([np.log10(whole), np.log10(DISCOUNT * distinct / whole)], axis=1)
            shorter = np.zeros((len(contexts), 2))
            if k and len(contexts):
                # The shorter context knows every symbol of this one.
                parents, p_whole, p_distinct, p_keys, p_counts = below
                parent = np.searchsorted(parents, _suffix(contexts, k - 1))
                there = np.searchsorted(p_keys, _suffix(keys, k))
                taken = np.bincount(place, weights=p_counts[there], minlength=len(contexts))
                others = p_distinct[parent] - distinct
                # Without other symbols leaving is sure.
                left = np.where(others > 0, p_whole[parent] - taken, 1.0)
                out = np.where(others > 0, DISCOUNT * others, 1.0)
                shorter = np.stack([np.log10(left), np.log10(out / left)], axis=1)
            context_keys.append(_tagged(contexts, k))
            costs.append(np.concatenate([own, shorter], axis=1))
            below = (contexts, whole, distinct, keys, counts)
        keys = np.concatenate(context_keys)
        known = len(grams[1][0])
        return cls(order, Lookup(np.concatenate(symbol_keys), np.concatenate(symbol_values)),
                   Lookup(keys, np.arange(len(keys), dtype=float)), np.concatenate(costs),
                   -np.log10(max(SYMBOLS - known, 1)))

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of each window's last byte after the others."""
        out = np.zeros(len(keys))
        rows = np.arange(len(keys))
        child = np.full(len(keys), -1)  # the context that was left, if any
        for k in range(self.order, -1, -1):
            if not len(rows):
                return out
            here = keys[rows]
            place, found = self.context.get(_tagged(_suffix(here >> np.uint64(8), k), k))
            place = place.astype(np.int64)
            count, coded = self.symbol.get(_tagged(_suffix(here, k + 1), k))
            entered = child >= 0
            costs = np.where(entered[:, None], self.costs[np.maximum(child, 0), 2:],
                             self.costs[place, :2] if len(self.costs) else 0.0)
            coded &= found
            out[rows] += np.where(coded, count - costs[:, 0], np.where(found, costs[:, 1], 0.0))
            child = np.where(found, place, child)[~coded]
            rows = rows[~coded]
        out[rows] += self.unseen
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        total = np.zeros(len(texts))
        for owner, keys in windows(texts, self.order):
            total += np.bincount(owner, weights=self.logs(keys), minlength=len(texts))
        return total


def held_out(doc_id: Column) -> Column:
    return crc_bucket(doc_id, HELD_OUT) == HELD_OUT_IS


def _count(parts: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts; keys without counts count one each."""
    keys = np.concatenate([keys for keys, _ in parts])
    if all(n is None for _, n in parts):
        return np.unique(keys, return_counts=True)
    counts = np.concatenate([np.ones(len(k), np.int64) if n is None else n for k, n in parts])
    keys, place = np.unique(keys, return_inverse=True)
    return keys, np.bincount(place, weights=counts, minlength=len(keys)).astype(np.int64)


def _gather(order: int):
    """Counts of words and of byte windows, added up within a task as far as they fit. Exactly one
    of both is set."""
    def run(batches):
        words: Counter = Counter()
        raw: list[np.ndarray] = []
        waiting = 0
        sums: list[tuple[np.ndarray, np.ndarray]] = []

        def word_rows():
            keys, counts = list(words), list(words.values())
            for at in range(0, len(keys), 50_000):
                k, c = keys[at:at + 50_000], counts[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.binary()), pa.nulls(len(k), pa.int64()), pa.array(c, pa.int64())],
                    names=["word", "gram", "n"])
            words.clear()

        def gram_rows():
            for keys, counts in sums:
                for at in range(0, len(keys), 50_000):
                    k, c = keys[at:at + 50_000], counts[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(k), pa.binary()), pa.array(k.view(np.int64)), pa.array(c)],
                        names=["word", "gram", "n"])
            sums.clear()

        def add():
            nonlocal waiting
            if raw:
                sums[:] = [_count([*sums, _count([(k, None) for k in raw])])]
            raw.clear()
            waiting = 0

        for batch in batches:
            joined = []
            for text in batch.column("text"):
                own = words_of(text.as_py())
                words.update(own)
                joined.append(b" ".join(own))
                if len(words) >= FLUSH_WORDS:
                    yield from word_rows()
            for _, keys in windows(joined, order):
                raw.append(keys)
                waiting += len(keys)
                if waiting >= GRAMS:
                    add()
                    if len(sums[0][0]) >= FLUSH_GRAMS:
                        yield from gram_rows()
        add()
        yield from word_rows()
        yield from gram_rows()
    return run


def _mask(n: int) -> Column:
    return F.lit((1 << (8 * n)) - 1)


def known_logs(grams: DataFrame) -> DataFrame:
    """``gram, n, logs`` of the windows of training: each is coded in its whole context. A context
    has at most SYMBOLS windows."""
    context = Window.partitionBy(F.shiftrightunsigned("gram", 8))
    return grams.select("gram", "n", (F.log10(F.col("n") - DISCOUNT) - F.log10(
        F.sum("n").over(context))).alias("logs"))


def levels(grams: DataFrame, order: int) -> dict[int, DataFrame]:
    """``gram, n`` per order: the byte strings of that context and a symbol. Below ``order`` a string
    counts the strings one byte longer that end in it."""
    found = {order: grams}
    for k in range(order - 1, -1, -1):
        found[k] = written(
            found[k + 1].groupBy(F.col("gram").bitwiseAND(_mask(k + 1)).alias("gram")).agg(
                F.count("*").alias("n")), f"lm-order-{k}")
    return found


def _contexts(grams: DataFrame, k: int, wanted: DataFrame) -> DataFrame:
    """``context, symbols``: the counts of what follows the wanted contexts of ``k`` bytes."""
    context = F.shiftrightunsigned("gram", 8).alias("context")
    symbol = F.col("gram").bitwiseAND(_mask(1)).alias("symbol")
    # Of short contexts there are few.
    wanted = F.broadcast(wanted) if k <= 2 else wanted
    return grams.select(context, symbol, "n").join(wanted, "context", "left_semi").groupBy(
        "context").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "n"))).alias("symbols"))


def unknown_logs(unknown: DataFrame, grams: dict[int, DataFrame], order: int) -> DataFrame:
    """``gram, logs`` of the distinct windows ``gram`` that training never saw.

    From the longest context down: one that training does not know costs nothing, one that does not
    know the symbol its escape. The next shorter one then leaves out the symbols of that one, all of
    which it knows. ``grams`` are the ``levels`` of training.
    """
    symbol = F.col("gram").bitwiseAND(_mask(1))
    known = grams[0].count()
    rows = unknown.select("gram", F.lit(0.0).alias("logs"), F.lit(False).alias("coded"),
                          F.lit(None).cast("map<bigint, bigint>").alias("left"))
    for k in range(order, -1, -1):
        context = F.shiftrightunsigned("gram", 8).bitwiseAND(_mask(k)).alias("context")
        found = _contexts(grams[k], k, unknown.select(context).distinct())
        rows = rows.withColumn("context", context).join(
            F.broadcast(found) if k < 2 else found, "context", "left")  # 257 contexts at most
        count = F.try_element_at("symbols", symbol)
        of_left = F.aggregate(F.map_keys("left"), F.lit(0).cast("long"),
                              lambda total, x: total + F.try_element_at("symbols", x))
        whole = F.aggregate(F.map_values("symbols"), F.lit(0).cast("long"), lambda total, x: total + x)
        rows = rows.select(
            "gram", "logs", "coded", "left", "symbols", count.alias("count"),
            (whole - F.coalesce(of_left, F.lit(0))).alias("rest"),
            (F.size("symbols") - F.when(F.col("left").isNull(), 0).otherwise(F.size("left"))).alias(
                "others"))
        # Without other symbols leaving is sure.
        weight = F.coalesce(F.col("count") - DISCOUNT, F.col("others") * DISCOUNT)
        cost = F.when(F.col("others") > 0, F.log10(weight) - F.log10("rest")).otherwise(0.0)
        rows = rows.select(
            "gram",
            (F.col("logs") + F.when(F.col("coded") | F.col("symbols").isNull(), 0.0).otherwise(
                cost)).alias("logs"),
            (F.col("coded") | F.col("count").isNotNull()).alias("coded"),
            F.coalesce("symbols", "left").alias("left"))
    unseen = -float(np.log10(max(SYMBOLS - known, 1)))
    return rows.select("gram", (F.col("logs") + F.when(F.col("coded"), 0.0).otherwise(
        F.lit(unseen))).alias("logs"))


def _score_windows(table: Lookup, texts: list[bytes], order: int):
    """``logs, ends, keys, counts``: sums over the windows in the table, a number per text, and the
    distinct other windows of each text, those of text i up to ``ends[i + 1]``."""
    total = np.zeros(len(texts))
    owners, others = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for owner, keys in windows(texts, order):
        logs, found = table.get(keys)
        total += np.bincount(owner, weights=logs, minlength=len(texts))
        owners.append(owner[~found])
        others.append(keys[~found])
    owner, keys = np.concatenate(owners), np.concatenate(others)
    sort = np.lexsort((keys, owner))
    owner, keys = owner[sort], keys[sort]
    new = np.ones(len(keys), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(keys)))
    ends = np.searchsorted(owner[first], np.arange(len(texts) + 1))
    return total, ends, keys[first], counts


def score_documents(documents: DataFrame, order: int = ORDER, nodes: int = NODES,
                    frequent: int = WORDS) -> DataFrame:
    """One row per row of the table: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``.

    Trained on rows whose crc32(doc_id as text) mod 7 is not 2. Texts are read whole, A-Z
    lower-cased, as words joined by one blank, and an end. ``score`` is the trie's base-10
    log-probability of that; the code length in bits is its negative over log10(2). ``base_score``
    is the unigram sum. A null or blank text is its end alone; a null ``doc_id`` counts as the
    empty text; repeated rows come out, and count, each. Without training rows every byte is
    equally likely and the base is 0. ``nodes`` and ``frequent`` say how much is broadcast, and
    change no score.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    rows = id_and_text(documents).withColumn("held_out", held_out(F.col("doc_id")))
    learning = rows.where(~F.col("held_out"))
    partial = written(learning.select("text").mapInArrow(
        _gather(order), "word binary, gram long, n long"), "lm-counts")
    ends = learning.count()
    words = written(partial.where("word is not null").groupBy("word").agg(F.sum("n").alias("c")),
                    "lm-words")
    sums = words.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    tokens, distinct = (sums.n or 0) + ends, sums.v + (1 if ends else 0)
    grams = written(partial.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")),
                    "lm-grams")
    grams_seen = grams.agg(F.sum("n")).first()[0] or 0
    known_windows = written(known_logs(grams), "lm-logs")
    # At most ``nodes`` windows make up that much each.
    top = known_windows.where(F.col("n") * nodes >= grams_seen).select("gram", "logs").toArrow()
    often = F.col("c") * frequent >= tokens
    table = words.where(often).toArrow()  # at most ``frequent`` words make up that much each
    logs = np.log10(table["c"].to_numpy().astype(float) + 1)
    shared = spark.sparkContext.broadcast(
        (Lookup(top["gram"].to_numpy().view(np.uint64), top["logs"].to_numpy()),
         dict(zip(table["word"].to_pylist(), logs.tolist(), strict=True))))
    end_log = float(np.log10(ends + 1))

    def score(batches):
        common, known = shared.value
        number = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts, n_tokens, n_known, logs = [], [], [], []
                words, counts, ends_at = [], [], [0]
                for text in batch.column("text"):
                    own = words_of(text.as_py())
                    texts.append(b" ".join(own))
                    found = np.fromiter(map(known.get, own, repeat(np.nan)), float, len(own))
                    rare = np.isnan(found)
                    others = Counter(own[i] for i in np.flatnonzero(rare))
                    words.extend(others.keys())
                    counts.extend(others.values())
                    ends_at.append(len(words))
                    n_tokens.append(len(own) + 1)
                    n_known.append(int(len(own) - rare.sum()) + (1 if ends else 0))
                    logs.append(float(found[~rare].sum()) + end_log)
                others = pa.StructArray.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(counts, pa.int32())], ["word", "n"])
                window_logs, ends_of, keys, times = _score_windows(common, texts, order)
                strange = pa.StructArray.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(times, pa.int32())], ["gram", "n"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"),
                     pa.array(np.arange(number, number + len(texts))),
                     pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                     pa.array(logs, pa.float64()),
                     pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), others),
                     pa.ListArray.from_arrays(pa.array(ends_of, pa.int32()), strange),
                     pa.array(window_logs)],
                    names=["doc_id", "held_out", "row", "n_tokens", "known", "logs", "rare",
                           "windows", "score"])
                number += len(texts)

    scored = written(rows.mapInArrow(
        score, "doc_id long, held_out boolean, row long, n_tokens long, known long, logs double, "
               "rare array<struct<word: binary, n: int>>, "
               "windows array<struct<gram: long, n: int>>, score double"), "lm-scored")
    # A word that is not in the table is rare, so no key of this join is hot.
    rare = scored.select("row", F.inline("rare")).join(words.where(~often), "word", "left").select(
        "row", F.when(F.col("c").isNotNull(), F.col("n")).alias("n"),
        (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("logs"))
    asked = scored.select("row", F.inline("windows"))
    unknown = written(asked.select("gram").distinct().join(grams, "gram", "left_anti"), "lm-unknown")
    all_logs = known_windows.select("gram", "logs").union(
        unknown_logs(unknown, levels(grams, order), order))
    strange = asked.join(all_logs, "gram").select("row", (F.col("n") * F.col("logs")).alias("logs"))
    nothing = F.lit(None)
    per_row = rare.withColumn("window_logs", nothing.cast("double")).union(strange.select(
        "row", nothing.cast("int"), nothing.cast("double"), "logs")).groupBy("row").agg(
        F.sum("n").alias("rare_known"), F.sum("logs").alias("rare_logs"), F.sum("window_logs").alias(
            "window_logs"))
    joined = scored.drop("rare", "windows").join(per_row, "row", "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
         - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))).alias("base_score"),
        (F.col("score") + F.coalesce("window_logs", F.lit(0.0))).alias("score"))
