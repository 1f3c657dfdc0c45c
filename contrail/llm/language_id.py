"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in the tasks and sums them by (language,
bucket); the log-probability matrix (buckets x languages) is broadcast. Scoring
counts the n-grams of a batch of texts as sparse rows (text, bucket, count) and multiplies them
with the matrix, ``CELLS`` numbers at a time, however long a text is.

Bounds: training reads about ``max_train`` labelled documents, picked by a hash
of the id among all that may be learned from (documented sample; everything
else is over all rows). The matrix has 2**bits rows and one column per learned
language; more than ``max_languages`` languages are refused. A scoring task holds the
matrix, one piece of a text (``chargrams.PIECE``), and ``CELLS`` products of 8 bytes.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with nothing to learn from every text is ``und``; repeated rows get equal
results; other columns pass through; a null language or id is never learned from.
Equal scores go to the first language in order.
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
from contrail.llm.common import free_name, sample_by_hash

ORDERS = (1, 2, 3)
BITS = 16
MAX_TRAIN = 20_000
SMOOTHING = 0.1
UNDETERMINED = "und"
CELLS = 1 << 21  # products of counts and matrix held at once


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray  # one per language
    log_prob: np.ndarray  # buckets x languages, float32
    orders: tuple[int, ...]
    bits: int

    def sparse_rows(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(text's number, buckets, counts): the n-grams of every piece of every text, each bucket once a piece and order."""
        kind = np.uint16 if self.bits <= 16 else np.uint32  # numpy sorts 16 bits by radix
        for at, text in enumerate(texts):
            for hashes in gram_hashes(text, self.orders):
                buckets = np.sort((hashes >> np.uint32(32 - self.bits)).astype(kind), kind="stable")
                first = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))[: len(buckets)]
                yield at, buckets[first], np.diff(np.append(first, len(buckets)))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log posterior of every language, up to a constant, one row a text."""
        total = np.repeat(self.log_prior[None, :], len(texts), axis=0)
        most = max(1, CELLS // max(1, len(self.languages)))
        held: list[tuple[int, np.ndarray, np.ndarray]] = []

        def add() -> None:
            rows = [at for at, _, _ in held]
            starts = np.cumsum([0] + [len(n) for _, _, n in held[:-1]])
            products = self.log_prob[np.concatenate([b for _, b, _ in held])] * np.concatenate([n for _, _, n in held])[:, None]
            np.add.at(total, rows, np.add.reduceat(products, starts, axis=0))
            held.clear()

        size = 0
        for at, buckets, counts in self.sparse_rows(texts):
            for cut in range(0, len(buckets), most):
                part = (at, buckets[cut : cut + most], counts[cut : cut + most])
                if held and size + len(part[2]) > most:
                    add()
                    size = 0
                held.append(part)
                size += len(part[2])
        if held:
            add()
        return total


def count_grams(batches: Iterator[pd.DataFrame], orders: tuple[int, ...], bits: int) -> Iterator[pd.DataFrame]:
    """(lang, bucket, n, docs) over a partition; the documents of a language are counted in bucket -1."""
    grams: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            own = grams.setdefault(lang, np.zeros(1 << bits, np.int64))
            docs[lang] = docs.get(lang, 0) + 1
            for hashes in gram_hashes(text, orders):
                own += np.bincount(hashes >> np.uint32(32 - bits), minlength=1 << bits)
    for lang, own in grams.items():
        at = np.flatnonzero(own)
        yield pd.DataFrame(
            {"lang": lang, "bucket": np.append(at, -1).astype("int32"), "n": np.append(own[at], docs[lang]).astype("int64")}
        )


def train(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_train: int = MAX_TRAIN,
    max_languages: int = 256,
    orders: tuple[int, ...] = ORDERS,
    bits: int = BITS,
) -> LanguageModel:
    """The model learned from about ``max_train`` of the ``labelled`` rows."""
    usable = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    sample = sample_by_hash(usable, F.col(key), max_train)
    counted = (
        sample.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        .mapInPandas(lambda it: count_grams(it, orders, bits), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    found = counted.persist()
    try:
        languages = sorted(r["lang"] for r in found.filter("bucket = -1").select("lang").limit(max_languages + 1).collect())
        if len(languages) > max_languages:
            raise ValueError(f"more than {max_languages} languages to learn")
        rows = found.toPandas()  # at most languages x (buckets + 1) rows
    finally:
        found.unpersist()
    grams = np.full((1 << bits, len(languages)), SMOOTHING)
    docs = np.ones(len(languages))
    column = rows["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(dtype=np.int64)
    bucket, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    gram = bucket >= 0
    grams[bucket[gram], column[gram]] += n[gram]
    docs[column[~gram]] = n[~gram]
    log_prob = np.log(grams / grams.sum(axis=0)).astype(np.float32)
    return LanguageModel(languages, np.log(docs / docs.sum()), log_prob, orders, bits)


def identify(df: DataFrame, model: LanguageModel, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its posterior probability."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            langs = np.full(len(texts), UNDETERMINED, dtype=object)
            scores = np.zeros(len(texts))
            at = np.flatnonzero(texts.notna().to_numpy()) if own.languages else np.empty(0, np.int64)
            if len(at):
                s = own.scores([texts.iat[i] for i in at])
                best = s.argmax(axis=1)
                langs[at] = np.array(own.languages, dtype=object)[best]
                scores[at] = 1.0 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
            yield pd.DataFrame({"lang": langs, "score": scores})

    lettered = F.when(F.col(text).rlike(r"\p{L}"), F.col(text))
    made = free_name(df, "_predicted")
    predicted = df.withColumn(made, predict(lettered))
    return predicted.withColumns({out: F.col(f"{made}.lang"), score: F.col(f"{made}.score")}).drop(made)
