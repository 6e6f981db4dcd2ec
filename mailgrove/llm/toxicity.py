"""Toxicity by class-conditional Kneser-Ney models (operator 3).

Two character models, of toxic and of ordinary texts, share their back-off counts: an
expression that only few texts hold is explained alike by both, and the log-likelihoods differ
only where the classes' own counts do. The log-likelihood ratio is normalised by length, nats a
character, over the whole text and over each passage of PASSAGE words in a row: the text, its
highest passage and its second highest make three ratios of one scale. A logistic curve, fitted
with a model that hasn't counted the rows it is fitted on, turns them into a score; then all
labelled training rows are counted.

Defined cases: a null or letterless text has ratios of zero, and its score is what the curve
gives there; a text of one passage has that passage as its second highest too; a row without a
label, with a null label or label outside 0 and 1 teaches nothing; if either class has no training
row, every score is the share of toxic training rows (0 with none); if the rows kept for the curve
are all of one class, the curve is fitted on the other rows; repeated rows are repeated; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm import charlm
from mailgrove.llm.langid import Scorer, fold
from mailgrove.llm.shared import arrow_batches, keep_rows, pick, settle, unsettle

ORDER = 6
#: Words of a passage.
PASSAGE = 2
#: Rows the curve is fitted on, at most: of one in APART texts, those with the least hash.
CALIBRATION_ROWS, APART = 20_000, 4
#: Labels, of 12 bytes each, that are sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


class Fitted(NamedTuple):
    model: charlm.Model | None
    weights: np.ndarray | None
    share: float


class Ratios(Scorer):
    def features(self, texts: pa.Array) -> np.ndarray:
        """[docs, 3]: nats a character that speak for the toxic class, over the whole text, its highest and its second highest passage."""
        words, index, offsets = charlm.distinct_words(texts)
        known = self.words.lookup(words)
        flat = np.stack([known[:, 1] - known[:, 0], known[:, 2]], axis=1)[index]
        sums = np.concatenate([np.zeros((1, 2)), np.cumsum(flat, axis=0)])
        size = np.diff(offsets)
        whole = sums[offsets[1:]] - sums[offsets[:-1]]
        out = np.zeros((len(size), 3))
        out[:, 0] = whole[:, 0] / np.maximum(whole[:, 1], 1)
        count = -(-size // PASSAGE)
        doc = np.repeat(np.arange(len(size)), count)
        if len(doc):
            firsts = np.cumsum(count) - count
            begin = offsets[doc] + PASSAGE * (np.arange(len(doc)) - firsts[doc])
            end = np.minimum(begin + PASSAGE, offsets[doc + 1])
            passage = sums[end] - sums[begin]
            ratio = passage[:, 0] / np.maximum(passage[:, 1], 1)
            order = np.lexsort((-ratio, doc))
            some = np.flatnonzero(count)
            out[some, 1] = ratio[order[firsts[some]]]
            out[some, 2] = ratio[order[firsts[some] + np.minimum(count[some] - 1, 1)]]
        return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (last: intercept) by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Training rows (text, label): documents that have one label and aren't in the held-out fold."""
    rows = pick(docs, doc_id="long", text="string").filter(fold(F.col("doc_id"), folds) != held)
    marks = settle(pick(labels, doc_id="long", toxic="int").filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label")), "toxicity-marks")
    few = marks.count() <= BROADCAST_ROWS  # else the texts are shuffled to their labels
    return rows.join(F.broadcast(marks) if few else marks, "doc_id").select("text", "label")


def _features(rows: DataFrame, model: charlm.Model):
    """rows (text, label) -> a table of the three ratios and the label on the driver; for bounded rows only."""

    def run(batches):
        for batch in arrow_batches(batches, charlm.DOCS):
            x = Ratios.of(model).features(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(x[:, 2]), batch.column(1)], ["a", "b", "c", "label"])

    return rows.mapInArrow(run, "a double, b double, c double, label int").toPandas()


def fit(training: DataFrame, order: int = ORDER) -> Fitted:
    """training (text, label): the fitted models and curve. Every row counts."""
    apart = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(APART)) == 0  # by text, so that copies stay on one side
    size = {(r["label"], r["apart"]): r["n"] for r in training.groupBy("label", apart.alias("apart")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = sum(n for (label, _), n in size.items() if label == 1)
    share = toxic / max(1, sum(size.values()))
    if not 0 < share < 1:
        return Fitted(None, None, share)
    words = settle(charlm.count_words(training.select("text", (F.col("label") * 2 + apart.cast("int")).alias("label")), 4).select("word", F.expr("label div 2").cast("int").alias("label"), (F.col("label") % 2).alias("apart"), "n"), "toxicity-words")
    whole = charlm.fit_model(words.groupBy("word", "label").agg(F.sum("n").alias("n")), order, 2, shared=True)
    two = all(size.get((label, True)) and size.get((label, False)) for label in (0, 1))
    trial = charlm.fit_model(words.filter("apart = 0"), order, 2, shared=True) if two else whole
    some = training.filter(apart if two else F.lit(True)).orderBy(F.xxhash64("text", F.lit(1)), "text", "label").limit(CALIBRATION_ROWS).repartition(32)
    seen = _features(some, trial)
    weights = _logistic(seen[["a", "b", "c"]].to_numpy(), seen["label"].to_numpy().astype(float)) if seen["label"].nunique() == 2 else None
    unsettle(words)
    return Fitted(whole if weights is not None else None, weights, share)


def score_texts(fitted: Fitted, texts: pa.Array) -> np.ndarray:
    if fitted.model is None:
        return np.full(len(texts), fitted.share)
    return 1 / (1 + np.exp(-np.clip(Ratios.of(fitted.model).features(texts) @ fitted.weights[:-1] + fitted.weights[-1], -30, 30)))


def score(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """docs -> doc_id, score: the higher, the likelier toxic."""

    def run(batches):
        for batch in arrow_batches(batches, charlm.DOCS):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_texts(fitted, batch.column(1)))], ["doc_id", "score"])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")


def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those whose score is 0.5 or more."""
    fitted = fit(labelled(docs, labels))

    @F.pandas_udf("boolean")
    def keeps(text: pd.Series) -> pd.Series:
        ok = [score_texts(fitted, pa.array(text.iloc[at : at + charlm.DOCS], pa.string(), from_pandas=True)) < 0.5 for at in range(0, len(text), charlm.DOCS)]
        return pd.Series(np.concatenate(ok) if ok else [], dtype=bool)

    return keep_rows(docs, lambda text: keeps(text.cast("string")), "text")


def op3_toxicity(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, fit(labelled(docs, labels)))
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op3_toxicity": op3_toxicity}
