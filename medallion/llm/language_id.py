"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the n-grams of all languages: every slot has a bit per language,
and the slots of an n-gram, anded, give the languages that contain it. A document is put to the
filter n-gram by n-gram; the bits are counted per language, corrected for the filter's false
positives, and the highest count decides. The filter has a fixed size whatever it is learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.chartext import grams, stretches
from medallion.llm.common import crc_bucket, id_and_text, prepare_workers

ORDERS = (2, 3, 4)
SLOT_BITS = 20
HASHES = 3
#: Documents per language, in expectation, that the filter is learned from.
SAMPLE = 3_000
#: A language holds an n-gram if it is at least this often there, and at least this part as often
#: as in the language that uses it most.
MIN_COUNT = 3
MIN_RATIO = 1 / 24
UNKNOWN = "und"
HELD_OUT, HELD_OUT_IS = 4, 2
_SCALE = 1 << 20
#: Odd multipliers of the slot hashes: fractions of the golden ratio and of roots, rounded to odd.
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


@dataclass
class Filter:
    languages: list[str]
    slots: np.ndarray   # a row per slot, 64 languages per word
    orders: tuple[int, ...] = ORDERS
    hashes: int = HASHES

    @classmethod
    def empty(cls, languages: list[str], slot_bits: int = SLOT_BITS) -> Filter:
        words = max(1, -(-len(languages) // 64))
        return cls(languages, np.zeros((1 << slot_bits, words), np.uint64))

    def _places(self, keys: np.ndarray):
        shift = np.uint64(64 - (len(self.slots).bit_length() - 1))
        for number in range(self.hashes):
            mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(_MULTIPLIERS[number])
            yield (mixed >> shift).astype(np.int64)

    def add(self, keys: np.ndarray, language: np.ndarray) -> None:
        for number in range(len(self.languages)):
            word, bit = number // 64, np.uint64(1 << (number % 64))
            for places in self._places(keys[language == number]):
                self.slots[places, word] |= bit

    def containing(self, keys: np.ndarray) -> np.ndarray:
        """Bit masks of the languages that contain each n-gram, or seem to."""
        masks = None
        for places in self._places(keys):
            masks = self.slots[places] if masks is None else masks & self.slots[places]
        return masks

    def false_positives(self) -> np.ndarray:
        """Per language, the chance that a foreign n-gram seems contained."""
        filled = [((self.slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
                  for i in range(len(self.languages))]
        return np.array(filled) ** self.hashes

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        hits = np.zeros((len(self.languages), len(texts)))
        total = np.zeros(len(texts))
        lettered = np.zeros(len(texts), bool)
        for owner, codes, ends in stretches(texts):
            lettered[owner] = True
            for n in self.orders:
                keys, part = grams(codes, ends, n)
                masks, mine = self.containing(keys), owner[part]
                total += np.bincount(mine, minlength=len(texts))
                for i in range(len(self.languages)):
                    bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                    hits[i] += np.bincount(mine, weights=bit, minlength=len(texts))
        wrong = self.false_positives()[:, None]
        count = np.maximum(hits - wrong * total, 0) / np.maximum(1 - wrong, 1e-9)
        shares = np.clip(count / np.maximum(total, 1), 0, 1)
        best = shares.argmax(axis=0)
        score = np.where(lettered, shares.max(axis=0), 0.0)
        return [self.languages[b] if ok else UNKNOWN
                for b, ok in zip(best, lettered, strict=True)], score


def learned_rows(doc_id: Column) -> Column:
    return crc_bucket(doc_id, HELD_OUT) != HELD_OUT_IS


def _counted(orders: tuple[int, ...]):
    def run(batches):
        for batch in batches:
            by_language: dict[str, list[str]] = {}
            texts = batch.column("text")
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                by_language.setdefault(lang, []).append(text.as_py())
            for lang, own in by_language.items():
                for _, codes, ends in stretches(own):
                    for n in orders:
                        keys, counts = np.unique(grams(codes, ends, n)[0], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(keys), pa.string()),
                             pa.array(keys.view(np.int64)), pa.array(counts)],
                            names=["lang", "gram", "n"])
    return run


def learn(documents: DataFrame, sample: int = SAMPLE, slot_bits: int = SLOT_BITS) -> Filter | None:
    """The filter of all languages with training rows; None if there are none.

    About ``sample`` documents per language are drawn by a hash of their id; what comes to the driver
    is bounded by that, and the filter by ``slot_bits``.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & learned_rows(F.col("doc_id")))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(_SCALE))
    limits = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                            for x in (lang, -(-sample * _SCALE // n))])
    counts = rows.where(place < limits[F.col("lang")]).select("lang", "text").mapInArrow(
        _counted(ORDERS), "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    most = F.max("share").over(Window.partitionBy("gram"))
    held = counts.withColumn("share", share).where(F.col("n") >= MIN_COUNT).withColumn(
        "most", most).where(F.col("share") >= MIN_RATIO * F.col("most")).select(
        "lang", "gram").toArrow()
    built = Filter.empty(sorted(sizes), slot_bits)
    number = {lang: i for i, lang in enumerate(built.languages)}
    built.add(held["gram"].to_numpy().view(np.uint64),
              np.array([number[lang] for lang in held["lang"].to_pylist()], np.int64))
    return built


def _predictor(documents: DataFrame, sample: int):
    prepare_workers(documents.sparkSession)
    return documents.sparkSession.sparkContext.broadcast(learn(documents, sample))


def identify(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of the table: ``doc_id, held_out, lang_pred, score``.

    Learned only from rows with a language whose crc32(doc_id as text) mod 4 is not 2. ``lang_pred``
    is ``und`` with score 0 for a null text, a text without letters, and for all texts if nothing
    can be learned. ``score`` is the part of the text's n-grams that the language contains, after
    the correction. Ties go to the language first in the alphabet. Whole texts are read; repeated
    rows come out each; a null ``doc_id`` counts as the empty text.
    """
    shared = _predictor(documents, sample)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if shared.value is None:
                langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                langs, scores = shared.value.decide(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = id_and_text(documents).select(
        "doc_id", "text", (~learned_rows(F.col("doc_id"))).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(documents: DataFrame, least_score: float, sample: int = SAMPLE) -> DataFrame:
    """The documents whose text belongs to a language, with all their columns.

    A row stays if its text has letters and at least ``least_score`` of its n-grams belong to one
    language. A null ``lang`` is filled with the prediction. If nothing can be learned, rows with
    letters stay.
    """
    shared = _predictor(documents, sample)
    columns = documents.columns
    text, lang = columns.index("text"), columns.index("lang")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            if shared.value is None:
                keep = np.array([any(c.isalpha() for c in t) for t in texts], bool)
                langs = [None] * len(texts)
            else:
                langs, scores = shared.value.decide(texts)
                keep = (scores >= least_score) & np.array([x != UNKNOWN for x in langs], bool)
            given = batch.column(lang).to_pylist()
            filled = [a if a is not None else b for a, b in zip(given, langs, strict=True)]
            out = list(batch.columns)
            out[lang] = pa.array(filled, batch.schema.field(lang).type)
            yield pa.RecordBatch.from_arrays(out, schema=batch.schema).filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)
