"""Toxicity by class-conditional Kneser-Ney models of words.

A model of the toxic and one of the ordinary training documents give each word a probability: the
share of the class's documents-and-words that are this one, discounted, and what the discount frees
goes to backoff counts that both classes share. A word that few documents hold is then nearly as likely in
either model. A document is scored by the difference of its two log-likelihoods: per word over the
whole text, of its strongest word and of its strongest run of words, as a few strong words can
drown in a long text. A logistic curve weighs the three; it is fitted on the training documents, each scored
without its own counts. Everything is fitted on a bounded sample of labelled documents and is a small
table; scoring is one pass over the text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import crc_bucket, id_and_text, prepare_workers, slices, written

DISCOUNT = 0.75
#: Words of a strongest run.
RUN = 3
#: Labelled documents per class, in expectation, that the models and the curve are fitted on.
SAMPLE = 10_000
#: Training documents that hold a word, at least; all rarer ones are one unknown word.
KNOWN = 2
HELD_OUT = 5
#: Words a task holds before it passes their counts on.
HELD_WORDS = 500_000
SHRINKAGE = 0.1
_SCALE = 1 << 20
_WORD = re.compile(r"\w+")


def words_of(part: str) -> list[str]:
    return _WORD.findall(part.lower())


@dataclass
class Model:
    """``ordinary`` and ``toxic``: documents of each class that hold each of ``words``; ``totals`` and
    ``kinds``: counts and different words of each class, unknown ones included."""

    words: list[str]
    ordinary: np.ndarray
    toxic: np.ndarray
    totals: tuple[int, int]
    kinds: tuple[int, int]
    centre: np.ndarray = field(default_factory=lambda: np.zeros(3))
    spread: np.ndarray = field(default_factory=lambda: np.ones(3))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    _places: dict[str, int] = None
    _ratios: list[np.ndarray] = None

    def shared(self, ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Backoff probability: documents of both classes that hold the word; an unknown word has a half."""
        whole = float((self.ordinary + self.toxic).sum()) + 0.5 * (len(self.words) + 1)
        return (ordinary + toxic + 0.5) / whole

    def log_ratio(self, ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Toxic minus ordinary log-probability of words with these counts."""
        back, logs = self.shared(ordinary, toxic), []
        for counts, total, kinds in zip((ordinary, toxic), self.totals, self.kinds):
            logs.append(np.log((np.maximum(counts - DISCOUNT, 0) + DISCOUNT * kinds * back) / total))
        return logs[1] - logs[0]

    def ratios(self, own: int | None = None) -> np.ndarray:
        """Of every word and, last, the unknown one, against the unknown one; ``own`` is the class
        of a document whose counts are taken out."""
        if self._ratios is None:
            o, t = np.append(self.ordinary, 0.0), np.append(self.toxic, 0.0)
            found = [self.log_ratio(o, t), self.log_ratio(np.maximum(o - 1, 0), t),
                     self.log_ratio(o, np.maximum(t - 1, 0))]
            self._ratios = [f - f[-1] for f in found]
            self._places = {word: n for n, word in enumerate(self.words)}
        return self._ratios[0 if own is None else own + 1]

    def features(self, texts: list[str], own: list[int] | None = None) -> np.ndarray:
        """Per text the mean ratio, the highest, and the highest mean of RUN words in a row (of all,
        where there are fewer); the training's average for a text without words."""
        rows = np.empty((len(texts), 3))
        for n, text in enumerate(texts):
            table = self.ratios(None if own is None else own[n])
            place, unknown = self._places.get, len(self.words)
            total, count, most, best = 0.0, 0, -np.inf, -np.inf
            carried = np.empty(0)
            for part in slices(text):
                numbers = [place(word, unknown) for word in words_of(part)]
                if not numbers:
                    continue
                values = table[numbers]
                total, count = total + float(values.sum()), count + len(values)
                most = max(most, float(values.max()))
                row = np.concatenate([carried, values])
                if len(row) >= RUN:
                    sums = np.cumsum(np.concatenate([[0.0], row]))
                    best = max(best, float((sums[RUN:] - sums[:-RUN]).max()) / RUN)
                carried = row[-(RUN - 1):]
            rows[n] = (total / count, most, best if count >= RUN else total / count) if count else (
                self.centre)
        return rows

    def scores(self, texts: list[str]) -> np.ndarray:
        return _logistic(_with_one((self.features(texts) - self.centre) / self.spread), self.weights)

    def fit(self, features: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> None:
        """A weighted logistic curve by Newton steps, a little shrunk.

        A higher ratio never counts against toxicity: a feature that would is left out. On a few
        documents it may, as each is scored without its own counts.
        """
        w = weights / weights.mean()
        self.centre = (features * w[:, None]).sum(axis=0) / w.sum()
        self.spread = np.maximum(features.std(axis=0), 1e-9)
        x = _with_one((features - self.centre) / self.spread)
        used = np.ones(4, bool)
        while True:
            beta = np.zeros(4)
            beta[used] = _newton(x[:, used], toxic, w, SHRINKAGE * (np.arange(4)[used] < 3))
            if (beta[:3] >= 0).all():
                self.weights = beta
                return
            used[int(beta[:3].argmin())] = False


def _newton(x: np.ndarray, toxic: np.ndarray, w: np.ndarray, shrink: np.ndarray) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(100):
        p = _logistic(x, beta)
        slope = x.T @ (w * (toxic - p)) - shrink * beta
        bend = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(shrink) + 1e-9 * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def _logistic(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))


def _counted(batches):
    """How many documents of either class hold each word, added up within a task."""
    held: tuple[Counter, Counter] = Counter(), Counter()

    def let_go():
        for word in held[0].keys() | held[1].keys():
            yield word, held[0][word], held[1][word]
        held[0].clear()
        held[1].clear()

    def rows(items):
        items = list(items)
        if items:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*items), (pa.string(), pa.int64(), pa.int64()))],
                names=["word", "ordinary", "toxic"])

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            held[label].update({word for part in slices(text.as_py()) for word in words_of(part)})
            if len(held[0]) + len(held[1]) > HELD_WORDS:
                yield from rows(let_go())
    yield from rows(let_go())


def learned_rows(doc_id: Column) -> Column:
    return crc_bucket(doc_id, HELD_OUT) != 0


def labelled(documents: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict]:
    """``text, toxic`` of the drawn training documents, each id and text once, and class sizes.

    Rows are drawn by a hash of id and text, so neither a repeated id nor a repeated row gathers;
    there are about ``sample`` of a class, or all where it has fewer.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
        & learned_rows(F.col("doc_id"))).distinct()
    named = id_and_text(documents).withColumn("th", F.xxhash64("text"))
    known = named.select("doc_id", "th").distinct().join(usable, "doc_id")
    known = written(known, "toxicity")
    sizes = {row.toxic: row["count"] for row in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id", "th"), F.lit(_SCALE))
    limit = {y: -(-min(sample, n) * _SCALE // n) for y, n in sizes.items()}
    drawn = known.where(place < F.when(F.col("toxic") == 1, F.lit(limit.get(1, 0))).otherwise(
        F.lit(limit.get(0, 0))))
    # About two samples of ids and hashes: their number is the parameter's, not the table's.
    rows = named.join(F.broadcast(drawn), ["doc_id", "th"]).dropDuplicates(["doc_id", "th", "toxic"])
    return written(rows.select("text", "toxic"), "toxicity"), sizes


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The fitted models; None if the training rows do not hold words of both classes.

    What comes to the driver, the words of drawn documents and three numbers of each, is bounded by
    ``sample``.
    """
    rows, sizes = labelled(documents, labels, sample)
    if len(sizes) < 2:
        return None
    counts = written(rows.mapInArrow(_counted, "word string, ordinary long, toxic long").groupBy(
        "word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "toxicity")
    whole = counts.agg(F.sum("ordinary"), F.sum("toxic"), F.count(F.when(F.col("ordinary") > 0, 1)),
                       F.count(F.when(F.col("toxic") > 0, 1))).first()
    if not whole[0] or not whole[1]:
        return None
    table = counts.where(F.col("ordinary") + F.col("toxic") >= KNOWN).orderBy("word").toArrow()
    model = Model(table["word"].to_pylist(), table["ordinary"].to_numpy().astype(float),
                  table["toxic"].to_numpy().astype(float), (whole[0], whole[1]),
                  (whole[2], whole[3]))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            found = shared.value.features(batch.column("text").to_pylist(),
                                          batch.column("toxic").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *[pa.array(found[:, k]) for k in range(3)]],
                names=["toxic", "a", "b", "c"])

    kept = rows.mapInArrow(scored, "toxic int, a double, b double, c double").orderBy(
        "toxic", "a", "b", "c").toArrow()
    y = kept["toxic"].to_numpy().astype(float)
    weights = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (len(y) - y.sum()))
    model.fit(np.column_stack([kept[k].to_numpy() for k in "abc"]), y, weights)
    model._places = model._ratios = None
    return model


def score_toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of the table: ``doc_id, held_out, score, predicted``.

    Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0; a null label or
    a label of no document is not used, and repeated labels count once. Words are runs of letters,
    digits and underscores, lower-cased. Whole texts are scored; a null text, or one without words,
    scores as the training's average text. Without labels of both classes every score is 0. A null
    ``doc_id`` counts as the empty text. Repeated rows come out each, but train once; other columns
    are not read; an empty table gives no rows.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    model = train(documents, labels, sample=sample)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores = (np.zeros(len(texts)) if shared.value is None else shared.value.scores(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = id_and_text(documents).select(
        "doc_id", "text", (~learned_rows(F.col("doc_id"))).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
