"""Toxicity: linear classifier over character n-grams scaled by naive Bayes log-count ratios.

1. Document frequencies of hashed n-grams per class are counted in the tasks and
   summed by n-gram; r = log ratio of the smoothed class frequencies.
2. The ``features`` n-grams whose r stands out most from chance (z value) stay.
3. A logistic regression is fitted on x = r * presence.
4. Scoring looks for the kept n-grams in the whole text and applies the logistic
   function to the weighted sum.

Bounds: training reads about ``max_train`` labelled documents, picked by a hash of
the id among all that may be learned from, equal rows of an id counting once; their
feature lists (at most ``features`` numbers each) are what the driver fits on.

Defined results: a null text scores as an empty one (the intercept's score), and
both count as documents without n-grams in training; with
one class only to learn from every score is the smoothed share of toxic labels,
with nothing to learn from it is next to 0; ids labelled twice count as toxic if any label says so;
repeated rows get equal results; other columns pass through, and a column of the
score's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from contrail.llm.chargrams import gram_hashes
from contrail.llm.common import sample_by_hash, shared_table

ORDERS = (3, 4, 5)
MAX_TRAIN = 8_192
FEATURES = 2_048
MIN_Z = 3.0
SMOOTHING = 1.0
L2 = 1e-3
STEPS = 400
FILTER_BITS = 20


@dataclass
class ToxicityModel:
    keys: np.ndarray  # sorted n-gram hashes, uint32
    weights: np.ndarray  # weight times log-count ratio of each
    intercept: float
    orders: tuple[int, ...]
    mask: np.ndarray  # by the leading bits of a hash: whether any key has them

    def present(self, text: str) -> np.ndarray:
        """Sorted numbers of the features that occur in ``text``."""
        found = [np.empty(0, np.int64)]
        if len(self.keys):
            for hashes in gram_hashes(text, self.orders):
                near = hashes[self.mask[hashes >> np.uint32(32 - FILTER_BITS)]]
                at = np.minimum(np.searchsorted(self.keys, near), len(self.keys) - 1)
                found.append(at[self.keys[at] == near])
        return np.unique(np.concatenate(found))

    def score(self, text: str | None) -> float:
        z = self.intercept + (self.weights[self.present(text)].sum() if text else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500.0, 500.0))))


def with_keys(keys: np.ndarray, weights: np.ndarray, intercept: float, orders: tuple[int, ...]) -> ToxicityModel:
    mask = np.zeros(1 << FILTER_BITS, dtype=bool)
    mask[keys >> np.uint32(32 - FILTER_BITS)] = True
    return ToxicityModel(keys, weights, intercept, orders, mask)


def count_documents(batches: Iterator[pd.DataFrame], orders: tuple[int, ...]) -> Iterator[pd.DataFrame]:
    """(gram, pos, neg): documents of each class that hold an n-gram, summed over a batch."""
    for batch in batches:
        for toxic, name, other in ((1, "pos", "neg"), (0, "neg", "pos")):
            texts = batch["text"][batch["toxic"] == toxic]
            none = np.empty(0, np.uint32)  # an empty text has no n-grams
            seen = [np.unique(np.concatenate([none, *gram_hashes(t, orders)])) for t in texts]
            if seen:
                grams, n = np.unique(np.concatenate(seen), return_counts=True)
                yield pd.DataFrame({"gram": grams.astype("int64"), name: n.astype("int64"), other: np.int64(0)})[["gram", "pos", "neg"]]


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated, scaled gradient descent on the mean logistic loss."""
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    feature = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    value = r[feature]
    n, d = len(rows), len(r)
    # Each coordinate has its own step, from a diagonal bound on the curvature.
    size = np.bincount(owner, np.abs(value), minlength=n) + 1.0
    bound = np.append(np.bincount(feature, np.abs(value) * size[owner], minlength=d), size.sum()) / (4.0 * n) + L2
    share = (y.sum() + 0.5) / (n + 1.0)
    w = look = np.zeros(d + 1)
    w[d] = look[d] = np.log(share / (1.0 - share))
    for k in range(STEPS):
        z = np.bincount(owner, value * look[feature], minlength=n) + look[d]
        error = 1.0 / (1.0 + np.exp(-np.clip(z, -500.0, 500.0))) - y
        gradient = np.append(np.bincount(feature, value * error[owner], minlength=d), error.sum()) / n
        gradient[:d] += L2 * look[:d]
        ahead = look - gradient / bound
        look = ahead + k / (k + 3.0) * (ahead - w)
        w = ahead
    return w[:d], float(w[d])


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_train: int = MAX_TRAIN,
    features: int = FEATURES,
    orders: tuple[int, ...] = ORDERS,
) -> ToxicityModel:
    """The model learned from about ``max_train`` of the ``labels`` rows and their texts."""
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    picked = sample_by_hash(usable, F.col(key), max_train).groupBy(F.col(key).alias("_id")).agg(F.max(label).alias("toxic"))
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    narrow = texts.join(F.broadcast(picked), F.col("_key") == F.col("_id")).select("_id", "text", F.col("toxic").cast("int"))
    sample = shared_table(narrow.distinct().drop("_id"), "toxicity-sample")  # about max_train rows
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        share = (n_pos + 0.5) / (n_pos + n_neg + 1.0) if n_pos + n_neg else 0.0
        odds = np.log(share / (1 - share)) if share else -500.0
        return with_keys(np.empty(0, np.uint32), np.empty(0), float(odds), orders)

    def log_share(count, total: int):
        return F.log((F.col(count) + SMOOTHING) / F.lit(total + 2 * SMOOTHING))

    spread = sample.repartition(max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    frequencies = (
        spread.mapInPandas(lambda it: count_documents(it, orders), "gram long, pos long, neg long")
        .groupBy("gram")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .withColumn("r", log_share("pos", n_pos) - log_share("neg", n_neg))
        .withColumn("z", F.abs("r") / F.sqrt(1 / (F.col("pos") + SMOOTHING) + 1 / (F.col("neg") + SMOOTHING)))
        .filter(F.col("z") >= MIN_Z)
        .orderBy(F.desc("z"), "gram")
        .limit(features)
    )
    kept = sorted((r["gram"], r["r"]) for r in frequencies.select("gram", "r").collect())
    keys = np.array([k for k, _ in kept], dtype=np.uint32)
    ratios = np.array([v for _, v in kept], dtype=np.float64)
    finder = with_keys(keys, ratios, 0.0, orders)

    def feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [finder.present(t).astype(np.int16).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "found": found})

    rows = spread.mapInPandas(feature_rows, "toxic int, found binary").collect()  # bounded by the sample
    rows.sort(key=lambda x: (x["toxic"], bytes(x["found"])))  # any order of tasks gives the same sums
    lists = [np.frombuffer(bytes(x["found"]), np.int16).astype(np.int64) for x in rows]
    weights, intercept = fit_logistic(lists, np.array([x["toxic"] for x in rows], dtype=np.float64), ratios)
    return with_keys(keys, weights * ratios, intercept, orders)


def score(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype="float64")

    return df.withColumn(out, scored(F.col(text)))
