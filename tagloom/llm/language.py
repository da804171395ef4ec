"""Language identification by string kernels: blended-spectrum presence, Nystroem landmarks, kernel ridge regression."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch
from tagloom.llm.vectors import slices, small_batches

#: Labelled rows the classifier is fitted on, about; at most twice as many are taken.
FIT_ROWS = 6_000
LANDMARKS = 128
#: A landmark has so many different n-grams at least.
LANDMARK_GRAMS = 100
#: Letters with a symbol of their own; all others share one.
LETTERS = 126
RIDGE = 1e-2
UNKNOWN = "und"

_BASE = LETTERS + 2
_STARTS = (0, _BASE, _BASE + _BASE**2)
_GRAMS = _BASE + _BASE**2 + _BASE**3
_BATCH = 64


def _points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)


class Symbols:
    """The symbol of every code point: 0 for what is no letter, then the known letters, then all others."""

    def __init__(self, letters: str):
        self.low = np.array([_BASE - 1 if chr(i).isalpha() else 0 for i in range(0x10000)], dtype=np.int64)
        self.high: dict[int, int] = {}
        for i, letter in enumerate(letters):
            if ord(letter) < 0x10000:
                self.low[ord(letter)] = i + 1
            else:
                self.high[ord(letter)] = i + 1

    def of(self, points: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(points, 0xFFFF)]
        for at in np.flatnonzero(points > 0xFFFF):
            point = int(points[at])
            out[at] = self.high.get(point, _BASE - 1 if chr(point).isalpha() else 0)
        return out


def grams(text: str | None, symbols: Symbols, last: np.ndarray) -> np.ndarray:
    """The distinct 1- to 3-grams of the whole text as numbers; everything between words is one symbol.

    ``last`` is working space of ``_GRAMS`` numbers, which spares a sort.
    """
    line = symbols.of(_points(text))
    if not line.any():
        return np.empty(0, dtype=np.int64)
    line = np.concatenate(([0], line, [0]))
    line = line[np.concatenate(([True], (line[1:] != 0) | (line[:-1] != 0)))]
    pairs = line[:-1] * _BASE + line[1:]
    codes = np.concatenate((line[line > 0], pairs + _STARTS[1], pairs[:-1] * _BASE + line[2:] + _STARTS[2]))
    at = np.arange(len(codes), dtype=np.int32)
    last[codes] = at
    return codes[last[codes] == at]


def _space() -> np.ndarray:
    return np.zeros(_GRAMS, dtype=np.int32)


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbols = Symbols("")
    for batch in slices(batches):
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            points = _points(text)
            values, times = np.unique(points[symbols.of(points) > 0], return_counts=True)
            counts.update(dict(zip(values.tolist(), times.tolist())))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["point", "times"])


def _gram_lists(letters: str):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, symbols = _space(), Symbols(letters)
        for batch in slices(batches):
            found = [grams(text, symbols, last) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["lang", "grams"])

    return build


@dataclass
class Presence:
    """Rows of weights for the n-grams that occur in landmarks; other n-grams weigh nothing."""

    letters: str
    codes: np.ndarray
    rows: np.ndarray
    space: tuple | None = None

    def products(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per batch of texts: where it starts, presence vectors times ``rows``, and the self kernels."""
        if self.space is None:
            self.space = _space(), np.full(_GRAMS, -1, dtype=np.int32), Symbols(self.letters)
        last, row, symbols = self.space
        row[self.codes] = np.arange(len(self.codes), dtype=np.int32)
        for start in range(0, len(texts), _BATCH):
            found = [grams(text, symbols, last) for text in texts[start : start + _BATCH]]
            own = np.array([len(x) for x in found], dtype=np.float64)
            hits = [row[x] for x in found]
            hits = [x[x >= 0] for x in hits]
            out = np.zeros((len(found), self.rows.shape[1]))
            for i, hit in enumerate(hits):
                if hit.size:
                    out[i] = np.ones(hit.size) @ self.rows[hit]
            yield start, out, own


@dataclass
class Model:
    """One-versus-rest ridge scores as weights of n-grams."""

    languages: list[str]
    presence: Presence
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for start, products, own in self.presence.products(texts):
            value = products / np.sqrt(np.maximum(own, 1.0))[:, None] + self.bias[None, :]
            share = np.clip((value + 1.0) / 2.0, 0.0, 1.0)
            best = value.argmax(axis=1)
            total = share.sum(axis=1)
            certainty = np.where(total > 0, share[np.arange(len(best)), best] / np.maximum(total, 1e-12), 1.0 / len(self.languages))
            names += [self.languages[b] if n else UNKNOWN for b, n in zip(best, own)]
            scores[start : start + len(own)] = np.where(own > 0, certainty, 0.0)
        return names, scores


def _kernel_rows(presence: Presence):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, rows = batch.column(1).to_pylist(), []
            for _, products, own in presence.products(texts):
                rows += list(products / np.sqrt(np.maximum(own, 1.0))[:, None])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["lang", "kernel"])

    return build


def held_out(doc_id: Column) -> Column:
    """Rows kept from fitting: crc32 of the id as text leaves 2 when divided by 4.  A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, scratch: Scratch, text_column: str, lang_column: str, key_column: str) -> Model | None:
    """Fits on a hashed sample of ``labelled`` rows of bounded size; None if no row has a language and letters."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(
        F.col(key_column).alias("key"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    share = min(1.0, FIT_ROWS / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).limit(2 * FIT_ROWS)
    sample = scratch.keep(chosen.select("key", "lang", "text"), "sample")
    counts = sample.select("text").mapInArrow(_letter_counts, "point long, times long").groupBy("point").agg(F.sum("times").alias("times"))
    letters = "".join(chr(r.point) for r in counts.orderBy(F.desc("times"), "point").limit(LETTERS).collect())
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not letters or not languages:
        return None
    lists = sample.select("lang", "text", "key").withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key", "text")))
    lists = lists.where(F.col("turn") <= 4 * -(-LANDMARKS // len(languages))).orderBy("turn", "lang").select("lang", "text")
    found = lists.mapInArrow(_gram_lists(letters), "lang string, grams array<long>").collect()
    enough = [r for r in found if len(r.grams) >= LANDMARK_GRAMS] or [r for r in found if r.grams]
    by_language: dict[str, list] = {}
    for r in enough:
        by_language.setdefault(r.lang, []).append(np.array(r.grams))
    landmarks = [g[i] for i in range(LANDMARKS) for g in by_language.values() if i < len(g)][:LANDMARKS]
    if not landmarks:
        return None
    codes = np.unique(np.concatenate(landmarks))
    member = np.zeros((len(codes), len(landmarks)))
    for j, own in enumerate(landmarks):
        member[np.searchsorted(codes, own), j] = 1.0 / np.sqrt(len(own))
    square = member.T @ member
    values, vectors = np.linalg.eigh(square)
    keep = values > 1e-8 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    kernel = sample.select("lang", "text").mapInArrow(_kernel_rows(Presence(letters, codes, member)), "lang string, kernel array<double>")
    got = kernel.toArrow()
    features = np.array(got.column("kernel").to_pylist()) @ whiten
    features = np.hstack((features, np.ones((len(features), 1))))
    truth = np.array(got.column("lang").to_pylist())
    targets = np.where(truth[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    system = features.T @ features + RIDGE * len(features) / 100 * np.eye(features.shape[1])
    solved = np.linalg.solve(system, features.T @ targets)
    return Model(languages, Presence(letters, codes, member @ (whiten @ solved[:-1])), solved[-1])


def _predicting(model: Model | None, at: int, names: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            found, scores = model.predict(texts) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], names)

    return predict


def identify(docs: DataFrame, model: Model | None, text_column: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score, from the whole text alone.

    A text that is null or has no letters is ``und`` with score 0, as is every text if there was
    nothing to learn from.  The output names must not be columns of ``docs``.
    """
    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*docs.schema.fields]).add(lang_pred, StringType()).add(score, DoubleType())
    return docs.mapInArrow(_predicting(model, docs.columns.index(text_column), schema.names), schema)


def languages_of(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row; learned from the rows that are not held out and have an id."""
    model = fit(docs.where(F.col(id_column).isNotNull() & ~held_out(F.col(id_column))), scratch, text_column, lang_column, id_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return identify(rows, model).drop("text")
