"""Language identification: averaged hashed subword embeddings and a linear softmax.

Words of letters, lower-cased, give character n-grams with word edges; each n-gram hashes to one of
``buckets`` embeddings.  A text is the mean of its n-grams' embeddings, a linear layer gives
the languages.  Both are trained by stochastic gradient descent in numpy, on
a bounded sample of labelled rows.  Scores are calibrated: a temperature is fitted on a part of the
sample that training has not seen, and the rejection bound is the score below which
that part holds no more than a given share of its documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import CACHE_ENTRIES, Cache, table_batches

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    buckets: int = 4096
    dimension: int = 16
    ngrams: tuple[int, ...] = (1, 2, 3)
    sample_per_language: int = 500
    sample: int = 4000
    updates: int = 3000
    batch: int = 32
    rate: float = 1.0
    seed: int = 7
    rejected_share: float = 0.002


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least_score: float


def gram_cache(settings: Settings) -> Cache:
    return Cache(lambda gram: zlib.crc32(gram.encode()) % settings.buckets)


def subwords(word: str, settings: Settings, grams: Cache) -> np.ndarray:
    """Bucket numbers of a word's n-grams."""
    edged = f"<{word.lower()}>"
    return np.array([grams[edged[k : k + n]] for n in settings.ngrams for k in range(len(edged) - n + 1)], np.int64)


class WordRows(dict):
    """Rows of a matrix with, per word, the sum of its n-grams' embeddings and their number."""

    def __init__(self, embeddings: np.ndarray, settings: Settings):
        super().__init__()
        self.embeddings, self.settings, self.grams = embeddings, settings, gram_cache(settings)
        self.matrix = np.zeros((CACHE_ENTRIES, embeddings.shape[1] + 1), np.float32)

    def __missing__(self, word: str) -> int:
        buckets = subwords(word, self.settings, self.grams)
        row = self[word] = len(self)
        self.matrix[row, :-1], self.matrix[row, -1] = self.embeddings[buckets].sum(axis=0), len(buckets)
        return row

    def total(self, words: list[str]) -> np.ndarray:
        """Sum of the rows of some words, far fewer than the matrix has rows."""
        if len(self) + len(words) > len(self.matrix):
            self.clear()
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.matrix[rows].sum(axis=0, dtype=np.float64)


def text_counts(text: str, cache: Cache, buckets: int) -> np.ndarray:
    found = list(map(cache.__getitem__, LETTERS.findall(text)))
    return np.bincount(np.concatenate(found), minlength=buckets) if found else np.zeros(buckets, np.int64)


def labelled_sample(docs: DataFrame, settings: Settings) -> DataFrame:
    """A bounded sample of the labelled rows, spread over languages, as n-gram counts.

    Rows are taken in the order of a hash of the id and the text.  A row is known by id, text and language, and
    rows equal in all three count once, so an id that many rows share fills no more of the sample than its texts.
    """
    of_text = F.xxhash64("text")
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", of_text.alias("of_text"))
    known = known.withColumn("draw", F.xxhash64(F.lit(settings.seed), "doc_id", "of_text"))
    row = ["draw", "doc_id", "of_text", "lang"]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*row))
    drawn = known.select(*row).distinct().withColumn("rank", rank).filter(F.col("rank") <= settings.sample_per_language)
    drawn = drawn.orderBy("rank", *row).limit(settings.sample)
    right = F.broadcast(drawn.select(*[F.col(c).alias(f"_{c}") for c in row]))  # at most ``sample`` rows
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in row])
    chosen = known.join(right, same, "left_semi")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = gram_cache(settings)
        cache = Cache(lambda word: subwords(word, settings, grams))
        for rows in table_batches(batches):
            counts = [text_counts(text, cache, settings.buckets) for text in rows["text"]]
            used = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(rows[c], pa.int64()) for c in row[:3]), pa.array(rows["lang"], pa.string()),
                 pa.array([u.astype("<i4").tobytes() for u in used], pa.binary()),
                 pa.array([c[u].astype("<i8").tobytes() for c, u in zip(counts, used, strict=True)], pa.binary())],
                names=[*row, "items", "n"],
            )

    counted = chosen.select(*row, "text").mapInArrow(count, "draw long, doc_id long, of_text long, lang string, items binary, n binary")
    return counted.groupBy(*row).agg(F.first("items").alias("items"), F.first("n").alias("n"))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(sample: DataFrame, settings: Settings) -> Model | None:
    """Fit on the driver; the sample is bounded by the settings.  None without labelled text."""
    rows = sorted(sample.collect(), key=lambda r: (r.draw, r.of_text, r.lang))
    rows = [r for r in rows if len(r["items"])]
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    place = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([place[r.lang] for r in rows])
    counts = []
    for row in rows:
        n = np.frombuffer(row["n"], "<i8").astype(np.float32)
        counts.append((np.frombuffer(row["items"], "<i4"), n / n.sum()))
    rng = np.random.default_rng(settings.seed)
    emb = rng.normal(0, 1, (settings.buckets, settings.dimension)).astype(np.float32)
    weights = np.zeros((settings.dimension, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    fit = np.arange(len(rows))[len(rows) // 5 :] if len(rows) >= 20 else np.arange(len(rows))
    held = np.arange(len(rows))[: len(rows) // 5] if len(rows) >= 20 else fit

    def means(some: np.ndarray) -> np.ndarray:
        return np.array([counts[k][1] @ emb[counts[k][0]] for k in some], np.float32)

    epochs = -(-settings.updates * settings.batch // len(fit))
    for epoch in range(epochs):
        rate = settings.rate * (1 - epoch / epochs)
        order = rng.permutation(fit)
        for at in range(0, len(order), settings.batch):
            some = order[at : at + settings.batch]
            x = means(some)
            error = softmax(x @ weights + bias)
            error[np.arange(len(some)), labels[some]] -= 1
            back = error @ weights.T
            weights -= rate / len(some) * (x.T @ error)
            bias -= rate / len(some) * error.sum(axis=0)
            for k, g in zip(some, back, strict=True):  # a text uses each of its buckets once
                emb[counts[k][0]] -= rate * counts[k][1][:, None] * g
    logits = means(held) @ weights + bias
    losses = {}
    for temperature in np.geomspace(0.1, 10, 41):
        p = softmax(logits / temperature)[np.arange(len(held)), labels[held]]
        losses[float(temperature)] = float(-np.log(np.maximum(p, 1e-9)).mean())
    temperature = min(losses, key=lambda t: (losses[t], t))
    scores = softmax(logits / temperature).max(axis=1)
    least = min(float(np.quantile(scores, settings.rejected_share)), 0.5)
    return Model(languages, emb, weights, bias, temperature, least)


def predict(docs: DataFrame, model: Model | None, settings: Settings) -> DataFrame:
    """doc_id, lang_pred, score and rejected; only the text is used.

    A text that is null or has no letter is ``und`` with score 0.  ``rejected`` marks
    scores below the calibrated bound; the best language is given all the same.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = WordRows(model.embeddings, settings) if model is not None else None
        for rows in table_batches(batches):
            preds, scores, doubts = [], [], []
            for text in rows["text"]:
                words = LETTERS.findall(text) if text and model is not None else []
                if not words:
                    preds.append(UNKNOWN), scores.append(0.0), doubts.append(True)
                    continue
                total = np.zeros(settings.dimension + 1)
                for at in range(0, len(words), 4096):
                    total += vectors.total(words[at : at + 4096])
                p = softmax((total[:-1] / total[-1] @ model.weights + model.bias) / model.temperature)
                best = int(p.argmax())
                preds.append(model.languages[best]), scores.append(float(p[best]))
                doubts.append(scores[-1] < model.least_score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["doc_id"], pa.int64()), pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(doubts, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    schema = "doc_id long, lang_pred string, score double, rejected boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def held_out(doc_id) -> F.Column:
    """True for a quarter of the documents, by a checksum of the id; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Train on the rows that are not held out, predict for every row.

    Rows: doc_id, held_out, lang_pred, score, rejected.  Null languages and texts take no part in
    training; without labelled text every prediction is ``und``.
    """
    model = train(labelled_sample(docs.filter(~held_out(F.col("doc_id"))), settings), settings)
    found = predict(docs, model, settings)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
