"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. A stage's result is written as Parquet and
reread as the next one's ``docs``. No SQL form exists (classifiers are trained,
pieces are searched); ``test_pipeline`` in ``tests/llm/test_python.py`` runs it and holds the
join stage to a result made by hand, and each operator has tests of its own.

Defined results: a null text scores as an empty one for toxicity and goes in the language
stage (undetermined), as texts without letters do; repeated rows are near copies of each other, of
which one stays; of equal keys and texts any row, as they can't be told apart; an empty table gives no rows; columns
besides those of ``documents`` pass all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import jaccard_join, language_id, sentencepiece_nbest, source_mix, toxicity
from contrail.llm.common import read_table, shared_table
from contrail.llm.queries import language_model, toxicity_model

MIN_LANGUAGE_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir), out="_score")
    return scored.filter("_score < 0.5").select(*docs.columns)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of at least ``MIN_LANGUAGE_SCORE``."""
    predicted = language_id.identify(docs, language_model(docs), out="_lang_pred", score="_lang_score")
    sure = (F.col("_lang_pred") != language_id.UNDETERMINED) & (F.col("_lang_score") >= MIN_LANGUAGE_SCORE)
    return predicted.filter(sure).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard_join.first_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: a row per document and pass, with the words taken."""
    return source_mix.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, score, pieces, alternatives) of every row."""
    encoded = sentencepiece_nbest.encode(docs, sentencepiece_nbest.load())
    return encoded.select(
        "doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), F.col("piece_score").alias("score"),
        "pieces", "alternatives",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", keep_known_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, starting from ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
