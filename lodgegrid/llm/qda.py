"""Quality classifier: regularised quadratic discriminant analysis.

Each document becomes a short vector of transformed statistics of its whole text. Two Gaussians, one
per label, are fitted to the labelled rows from sums alone (count, sum, sum of outer products), which
Spark adds up over all of them; no row is sampled. Each class covariance is shrunk first towards the
pooled one and then towards a multiple of the identity, and only its Cholesky factor goes to the
tasks. A score is the logistic of the difference of the two log densities plus the log prior odds.

Cases
-----
* A NULL text counts as empty; an empty text has a vector and a score like any other.
* A NULL ``doc_id`` never carries a label. Repeated rows are scored one by one.
* Several labels of one ``doc_id`` all count; NULL labels and labels other than 0 and 1 do not.
* If a class has no labelled row, every score is the share of label 1, smoothed by one row of each.
* Columns beyond ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgegrid.session import cut_lineage

from .common import documents, id_carried, id_restored, remainder, small_batches

SYMBOLS = b"#*$%&|<>{}[]\\^~=+_@/"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = b"abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "log_words", "log_word_length", "symbols", "bars", "upper_case", "exclamations",
    "repeated_neighbours", "distinct_words", "sentence_ends", "commas", "repeated_lines", "digits",
)
THRESHOLD = 0.3
#: Plain words added to every text, so that shares of a few words stay near the usual.
PRIOR_WORDS = 20
#: Share of the pooled covariance in each class covariance, and of the identity in the outcome.
POOLED_SHARE = 0.3
IDENTITY_SHARE = 0.1


def features(text: str | None) -> list[float]:
    """The statistics of one text, transformed to be nearer to Gaussian.

    Shares are damped by ``PRIOR_WORDS`` and go through a square root, lengths through a logarithm.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n_words, n_bytes, in_words = len(words), len(raw), sum(map(len, words))
    upper = n_bytes - len(raw.translate(None, UPPER))
    lower = n_bytes - len(raw.translate(None, LOWER))
    symbols = n_bytes - len(raw.translate(None, SYMBOLS))
    digits = n_bytes - len(raw.translate(None, b"0123456789"))
    lines = [line for line in raw.split(b"\n") if line]
    same = sum(a == b for a, b in zip(words, words[1:]))
    w, c = n_words + PRIOR_WORDS, n_bytes + PRIOR_WORDS * 6
    shares = (
        symbols / c,
        raw.count(b"|") / w,
        upper / (upper + lower + PRIOR_WORDS * 6),
        raw.count(b"!") / w,
        same / w,
        (len(set(words)) + PRIOR_WORDS) / w,
        (raw.count(b".") + raw.count(b"?")) / w,
        raw.count(b",") / w,
        (len(lines) - len(set(lines))) / (len(lines) + PRIOR_WORDS),
        digits / c,
    )
    return [
        np.log1p(n_words), np.log((in_words + PRIOR_WORDS * 6) / w),
        *np.sqrt(np.minimum(shares, 1.0)),
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """``doc_id`` and its vector ``x``, one row per document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "_no_id": batch["_no_id"],
                "x": [features(t) for t in batch["text"]],
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return id_restored(id_carried(small_batches(docs).select("doc_id", "text")).mapInPandas(
        run, f"doc_id {kind}, _no_id boolean, x array<double>"))


@dataclass(frozen=True)
class Model:
    """Two Gaussians on standardised vectors; ``factors`` are inverses of the Cholesky factors."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    log_dets: tuple[float, ...]
    log_prior_odds: float
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        if not self.factors:
            return np.full(len(x), self.share)
        z = (x - self.centre) / self.scale
        density = [
            -0.5 * (np.square((z - mean) @ factor.T).sum(axis=1) + log_det)
            for mean, factor, log_det in zip(self.means, self.factors, self.log_dets)
        ]
        odds = density[1] - density[0] + self.log_prior_odds
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def class_sums(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: rows, sum of vectors, sum of outer products. ``labelled`` has ``label``, ``x``."""
    d = len(FEATURES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(-1, d)
            label = batch["label"].to_numpy()
            for k in (0, 1):
                own = x[label == k]
                sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        label, place = np.divmod(np.arange(sums.size), sums.shape[1])
        yield pd.DataFrame({"label": label, "place": place, "value": sums.ravel()})

    parts = labelled.select("label", "x").mapInPandas(run, "label int, place int, value double")
    total = np.zeros((2, 1 + d + d * d))
    # 2 * (1 + d + d * d) rows, whatever the input
    for row in parts.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        total[row.label, row.place] = row.value
    return {k: (total[k, 0], total[k, 1:1 + d], total[k, 1 + d:].reshape(d, d)) for k in (0, 1)}


def fit(sums: dict, pooled_share: float = POOLED_SHARE, identity_share: float = IDENTITY_SHARE) -> Model:
    """The regularised discriminant from the sums of the two classes."""
    counts = np.array([sums[k][0] for k in (0, 1)])
    share = float((counts[1] + 1) / (counts.sum() + 2))
    d = len(FEATURES)
    if counts.min() == 0:
        return Model(np.zeros(d), np.ones(d), (), (), (), 0.0, share)
    means = [sums[k][1] / counts[k] for k in (0, 1)]
    scatter = [sums[k][2] - counts[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / counts.sum()
    centre = (sums[0][1] + sums[1][1]) / counts.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    pooled_z = pooled / np.outer(scale, scale)
    factors, log_dets = [], []
    for k in (0, 1):
        own = scatter[k] / counts[k] / np.outer(scale, scale)
        mixed = (1 - pooled_share) * own + pooled_share * pooled_z
        level = max(np.trace(mixed) / d, 1e-3)
        chol = np.linalg.cholesky((1 - identity_share) * mixed + identity_share * level * np.eye(d))
        factors.append(np.linalg.inv(chol))
        log_dets.append(2 * float(np.log(np.diag(chol)).sum()))
    return Model(
        centre, scale, tuple((m - centre) / scale for m in means), tuple(factors), tuple(log_dets),
        float(np.log(counts[1] / counts[0])), share,
    )


def learn(vectors: DataFrame, labels: DataFrame) -> Model:
    """Fit to the labelled rows of ``vectors`` that are not held out."""
    known = labels.filter(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("label"))
    return fit(class_sums(
        vectors.filter(~F.col("held_out")).join(known, F.col("doc_id") == F.col("label_id"))))


def _with_fold(vectors: DataFrame, folds: int) -> DataFrame:
    return vectors.withColumn("held_out", F.coalesce(remainder("doc_id", folds) == 0, F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Labels of rows whose crc32 remainder by ``folds`` is 0 are never learned from.
    """
    # one pass over the texts; the fit and the scores both read the small vectors
    vectors = _with_fold(cut_lineage(feature_table(docs), "qda-features"), folds)
    model = learn(vectors, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
            score = model.score(x)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "_no_id": batch["_no_id"], "held_out": batch["held_out"], "score": score,
                "predicted": (score >= threshold).astype("int32"),
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return id_restored(id_carried(vectors.select("doc_id", "held_out", "x")).mapInPandas(
        run, f"doc_id {kind}, _no_id boolean, held_out boolean, score double, predicted int"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns.

    The texts are read twice instead of being joined to their scores, so none is shuffled. The vectors
    are written before they are summed: where the labels are broadcast, one task would else hold two
    Python workers, and an executor keeps all it has started.
    """
    model = learn(_with_fold(cut_lineage(feature_table(docs), "qda-features"), folds), labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in text], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(x))

    return docs.filter(score(F.col("text")) >= threshold)


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
