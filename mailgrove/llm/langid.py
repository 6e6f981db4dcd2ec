"""Language identification by character Kneser-Ney models (operator 1).

One model per learned language; the language of the lowest length-normalised cross-entropy
wins (ties: the first in alphabetical order). Confidence and rejection are calibrated on all
training rows: their texts fall into two halves, and each half is scored by a trial model that
has counted the other only. Then all training rows are counted. A text is rejected if its
cross-entropy is beyond what all but `1 - KEEP` of the training rows of its length have: the
limit is level + spread / root of the characters.

Defined cases: a null text, or one without letters (\\p{L}), is `und` with score 0 and is
rejected; a null lang teaches nothing; with no training rows every text is `und` and the stage
rejects all; a single learned language is always predicted; with texts in one half only nothing
with a letter is rejected; repeated rows are repeated; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm import charlm
from mailgrove.llm.shared import arrow_batches, keep_rows, pick, settle, unsettle, worker_state

ORDER = 4
#: Share of training rows within the limit of rejection, and nats a character added for safety.
KEEP, SLACK = 0.995, 0.5
#: Scales of the confidence to choose from.
SCALES = [0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0]


def fold(doc_id, n: int):
    """crc32 of doc_id as text, modulo n (null ids: 0)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)), F.lit(0)).cast("int")


class Scorer:
    """Sums over whole documents of what is known of their words."""

    def __init__(self, model: charlm.Model):
        self.words = charlm.Words(model)

    @classmethod
    def of(cls, model: charlm.Model) -> Scorer:
        """One a worker, so that what it knows of words lasts from task to task."""
        return worker_state((cls.__name__, model.name), lambda: cls(model))

    def documents(self, texts: pa.Array):
        """(log-likelihood [docs, labels], characters [docs])."""
        words, index, offsets = charlm.distinct_words(texts)
        known = self.words.lookup(words)
        sums = np.concatenate([np.zeros((1, known.shape[1])), np.cumsum(known[index], axis=0)])
        out = sums[offsets[1:]] - sums[offsets[:-1]]
        return out[:, :-1], out[:, -1]


class Fitted(NamedTuple):
    langs: list
    model: charlm.Model | None
    scale: float
    level: float
    spread: float

    def limit(self, n: np.ndarray) -> np.ndarray:
        """The most nats a character that a text of n characters may have."""
        return self.level + self.spread / np.sqrt(np.maximum(n, 1))


def _entropy(ll, n):
    return -ll / np.maximum(n, 1)[:, None]


def _confidence(entropy, n, scale):
    """Posterior of the best label from the entropy margins, damped for long texts."""
    gap = (entropy - entropy.min(axis=1, keepdims=True)) * (scale * np.minimum(n, 200.0))[:, None]
    return 1.0 / np.exp(-np.minimum(gap, 700)).sum(axis=1)


def _scored(rows: DataFrame, model: charlm.Model) -> DataFrame:
    """rows (text, label) -> a table of those with letters: characters, least cross-entropy, loss of the confidence at each scale."""

    def run(batches):
        for batch in arrow_batches(batches, charlm.DOCS):
            ll, n = Scorer.of(model).documents(batch.column(0))
            some = n > 0
            ll, n, label = ll[some], n[some], batch.column(1).to_numpy()[some]
            entropy = _entropy(ll, n)
            right = entropy.argmin(axis=1) == label
            loss = [-np.where(right, np.log(c), np.log1p(-np.minimum(c, 1 - 1e-9))) for c in (_confidence(entropy, n, s) for s in SCALES)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()) for x in (n, entropy.min(axis=1), *loss)], ["n", "least", *(f"loss{i}" for i in range(len(SCALES)))])

    return settle(rows.select("text", "label").mapInArrow(run, ", ".join(["n double", "least double", *(f"loss{i} double" for i in range(len(SCALES)))])), "language-calibration")


def ranked(values: DataFrame, value, at: int) -> float:
    """The value at place `at` (from 0) of all values in order, exactly: by counts of ever narrower ranges, at most 1025 rows each."""
    values = values.select(value.alias("v"))
    lo, hi = values.agg(F.min("v"), F.max("v")).first()
    while lo < hi:
        cell = F.floor((F.col("v") - lo) / (hi - lo) * 1024)
        for r in sorted(values.filter(F.col("v").between(lo, hi)).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect(), key=lambda r: r["cell"]):
            if at < r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            at -= r["n"]
    return lo


def _calibrated(seen: DataFrame) -> tuple[float, float, float]:
    """(scale of the confidence, level and spread of the limit) by all rows of _scored."""
    count, *loss = seen.agg(F.count(F.lit(1)), *[F.sum(f"loss{i}") for i in range(len(SCALES))]).first()
    if not count:
        return 0.2, math.inf, 0.0
    least, root = F.col("least"), F.sqrt("n")
    middle = ranked(seen, least, (count - 1) // 2)
    # chance alone moves a mean over n characters by spread / root(n); short texts have the wider limit
    spread = 4 * ranked(seen, F.abs(least - middle) * root, (count - 1) // 2) / 0.6745
    level = ranked(seen, least - spread / root, math.ceil(KEEP * (count - 1)))
    return SCALES[int(np.argmin(loss))], max(level, middle) + SLACK, spread


def fit(rows: DataFrame, order: int = ORDER) -> Fitted:
    """rows (doc_id, text, lang): the fitted models. Every row counts, for the models and for confidence and rejection."""
    known = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())  # one row a language
    if not langs:
        return Fitted([], None, 1.0, 0.0, 0.0)
    label = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1
    fitted = known.withColumn("label", label)
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")  # by text, so that copies stay on one side
    sides = fitted.select("text", (F.col("label") * 2 + half).alias("label"))
    words = settle(charlm.count_words(sides, 2 * len(langs)).select("word", F.expr("label div 2").cast("int").alias("label"), (F.col("label") % 2).alias("half"), "n"), "language-words")
    scale, level, spread = 0.2, math.inf, 0.0
    if words.select("half").distinct().count() == 2:
        trial = [_scored(fitted.filter(half != side), charlm.fit_model(words.filter(F.col("half") == side), order, len(langs), shared=False)) for side in (0, 1)]
        scale, level, spread = _calibrated(trial[0].union(trial[1]))
        for table in trial:
            unsettle(table)
    model = charlm.fit_model(words.groupBy("word", "label").agg(F.sum("n").alias("n")), order, len(langs), shared=False)
    unsettle(words)
    return Fitted(langs, model, scale, level, spread)


def judged(texts: pa.Array, fitted: Fitted):
    """(index of the language, len(langs) for none; score; cross-entropy, nan for none; whether rejected) of each text."""
    size, none = len(texts), len(fitted.langs)
    if fitted.model is None:
        return np.full(size, none), np.zeros(size), np.full(size, np.nan), np.ones(size, bool)
    ll, n = Scorer.of(fitted.model).documents(texts)
    entropy, some = _entropy(ll, n), n > 0
    low = np.where(some, entropy.min(axis=1), np.nan)
    return np.where(some, entropy.argmin(axis=1), none), np.where(some, _confidence(entropy, n, fitted.scale), 0.0), low, ~(low <= fitted.limit(n))


def predict(rows: DataFrame, fitted: Fitted) -> DataFrame:
    """rows (doc_id, text) -> doc_id, lang_pred, score, cross_entropy, rejected."""

    def run(batches):
        names = np.array([*fitted.langs, "und"], dtype=object)
        for batch in arrow_batches(batches, charlm.DOCS):
            best, score, low, rejected = judged(batch.column(1), fitted)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(low, from_pandas=True), pa.array(rejected)], ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def training_rows(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    rows = pick(docs, doc_id="long", text="string", lang="string")
    return rows.filter(fold(F.col("doc_id"), folds) != held)


def stage(docs: DataFrame) -> DataFrame:
    """docs without the documents whose language is rejected; with nothing learned, all are."""
    fitted = fit(training_rows(docs))

    @F.pandas_udf("boolean")
    def keeps(text: pd.Series) -> pd.Series:
        ok = [~judged(pa.array(text.iloc[at : at + charlm.DOCS], pa.string(), from_pandas=True), fitted)[3] for at in range(0, len(text), charlm.DOCS)]
        return pd.Series(np.concatenate(ok) if ok else [], dtype=bool)

    return keep_rows(docs, lambda text: keeps(text.cast("string")), "text")


def op1_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(pick(docs, doc_id="long", text="string"), fit(training_rows(docs)))
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


QUERIES = {"op1_language_id": op1_language_id}
