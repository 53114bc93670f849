"""Language identification in two steps: the family first, then one-versus-one linear support vector
machines between the languages of that family.

A text is turned into counts of byte n-grams (one to three bytes, ASCII letters lower-cased), hashed to `DIMENSIONS`
columns, damped by a square root and scaled to length one; the whole text counts. Models are fitted on
the driver from a sample of labelled rows: at most `PER_LANGUAGE` different texts of each language, those
with the smallest digest, whose features are computed in Spark. A family is one against
the rest; inside a family each pair of languages votes. Languages without a known family make one of their own.

Null text and text without a letter give `und` with score 0, and so does everything if nothing is
labelled. Rows are judged one by one, so repeated rows agree; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dealgauge.llm.scratch import ship
from dealgauge.llm.text_arrays import Texts, slices

DIMENSIONS = 4096
PER_LANGUAGE = 600
STEPS = 300
PENALTY = 1e-4
UNKNOWN = "und"

#: Families of common languages by their two-letter codes.
FAMILIES = {
    "germanic": "en de nl sv da no is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru pl cs uk bg sr hr sk sl",
    "uralic": "fi et hu",
    "semitic": "ar he mt",
    "turkic": "tr az kk uz",
    "indo-aryan": "hi bn ur pa mr",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(language: str) -> str:
    return FAMILY_OF.get(language.split("-")[0].lower(), language)


def features(texts: Texts) -> np.ndarray:
    """One row per text: damped, scaled counts of hashed byte n-grams. Rows are filled in groups, so that
    memory does not follow the number of short texts."""
    data = texts.data
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint32)
    # digits and line ends say nothing about a language
    data = np.where((data < 97) & (data != 39), np.uint32(32), data)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(texts.offsets))
    counts = np.zeros((len(texts), DIMENSIONS), np.float32)
    flat = counts.reshape(-1)
    code = np.zeros(len(data), np.uint32)
    for length in (1, 2, 3):
        n = len(data) - length + 1
        if n <= 0:
            break
        code = code[:n] * np.uint32(257) + data[length - 1:]
        column = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
        inside = owner[:n] == owner[length - 1:]
        place = (owner[:n] * DIMENSIONS + column)[inside]
        flat += np.bincount(place, minlength=len(flat)).astype(np.float32)
    np.sqrt(counts, out=counts)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    return counts


#: Texts whose counts are held at once.
ROWS = 256


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    for batch, texts in slices(batches):
        for at in range(0, batch.num_rows, ROWS):
            to = min(at + ROWS, batch.num_rows)
            lo, hi = texts.offsets[at], texts.offsets[to]
            yield batch.slice(at, to - at), Texts(texts.data[lo:hi], texts.offsets[at:to + 1] - lo)


def fit_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by accelerated gradient steps; `y` is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, momentum = w, 1.0
    rate = 1.0 / (2 * 2.0 + PENALTY)
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        grad = PENALTY * ahead - 2 * (share * y * slack) @ x
        new = ahead - rate * grad
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead, w, momentum = new + (momentum - 1) / following * (new - w), new, following
    return w


class Model:
    """Family machines, one against the rest, and pair machines inside each family."""

    def __init__(self, x: np.ndarray, languages: list[str]):
        self.languages = sorted(set(languages))
        labels = np.array(languages)
        homes = np.array([family_of(v) for v in languages])
        self.families = sorted(set(homes))
        self.members = {f: [v for v in self.languages if family_of(v) == f] for f in self.families}
        self.by_family = np.array([fit_svm(x, np.where(homes == f, 1, -1).astype(np.float32)) for f in self.families]) \
            if len(self.families) > 1 else None
        self.pairs = {}
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                rows = (labels == a) | (labels == b)
                self.pairs[a, b] = fit_svm(x[rows], np.where(labels[rows] == a, 1, -1).astype(np.float32))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and a score of 0 to 1: how sure the family is, times how sure the weakest vote is."""
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        out, score = np.empty(len(x), object), np.ones(len(x))
        home = np.zeros(len(x), int)
        if self.by_family is not None:
            margins = x @ self.by_family.T
            home = margins.argmax(1)
            ordered = np.sort(margins, axis=1)
            score = 1 / (1 + np.exp(-2.0 * (ordered[:, -1] - ordered[:, -2])))
        for i, f in enumerate(self.families):
            rows = np.flatnonzero(home == i)
            if not len(rows):
                continue
            members = self.members[f]
            votes, weakest = np.zeros((len(rows), len(members))), np.full((len(rows), len(members)), np.inf)
            for (a, b), w in self.pairs.items():
                if a in members:
                    m = x[rows] @ w
                    for v, sign in ((a, 1), (b, -1)):
                        k = members.index(v)
                        votes[:, k] += sign * m > 0
                        weakest[:, k] = np.minimum(weakest[:, k], sign * m)
            best = (votes + 1e-3 * np.tanh(np.where(np.isinf(weakest), 0, weakest))).argmax(1)
            out[rows] = np.array(members, object)[best]
            low = weakest[np.arange(len(rows)), best]
            score[rows] *= np.where(np.isinf(low), 1, 1 / (1 + np.exp(-2.0 * low)))
        return out, np.clip(score, 0, 1)


def labelled_sample(documents: DataFrame, training: str, per_language: int) -> DataFrame:
    """At most `per_language` different texts of each language: those with the smallest digest."""
    rows = documents.filter(training).filter("lang is not null and text is not null").filter(F.col("text").rlike(r"\p{L}")).select(
        "text", "lang", F.xxhash64("text").alias("order"))
    first = Window.partitionBy("lang").orderBy("order")
    chosen = rows.select("lang", "order").distinct().withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_language)
    return rows.join(F.broadcast(chosen), ["lang", "order"]).groupBy("lang", "order").agg(F.min("text").alias("text"))


def fit(documents: DataFrame, training: str = "true", per_language: int = PER_LANGUAGE) -> Model | None:
    """The model of the rows that `training` (SQL) selects; only texts and languages are used."""
    ship(documents.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _parts(batches):
            x = features(texts).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])

    sample = labelled_sample(documents, training, per_language).select("text", "lang")
    found = sample.mapInArrow(rows, "lang string, x binary").toArrow()
    if not found.num_rows:
        return None
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
    return Model(x, found.column("lang").to_pylist())


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """All columns of `documents` with lang_pred and score. Only texts go to Python and only predictions come back; the
    rows stay in Spark."""
    names = [c for c in documents.columns if c not in ("lang_pred", "score")]
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few weights per pair of languages

    def predicted(text: pa.Array, has_letter: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, has_letter], names=["text", "has_letter"])
        preds, scores = [], []
        for part, texts in _parts([batch]):
            told = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            pred, score = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
            if shared.value is not None and told.any():
                pred, score = shared.value.predict(features(texts))
                pred[~told], score[~told] = UNKNOWN, 0.0
            preds.extend(pred)
            scores.append(score)
        return pa.StructArray.from_arrays(
            [pa.array(preds, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]), pa.float64())], names=["lang_pred", "score"])

    # a filter on the prediction must not compute it again
    told = F.arrow_udf(predicted, "lang_pred string, score double").asNondeterministic()
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = documents.select(*[F.col(_quoted(c)) for c in names], told("text", has_letter).alias(_TOLD))
    return rows.select(*[F.col(_quoted(c)) for c in names], F.col(f"`{_TOLD}`.lang_pred"), F.col(f"`{_TOLD}`.score"))


_TOLD = "told by the model"


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"
