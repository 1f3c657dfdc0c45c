"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (
    hamming_topk,
    hard_negatives,
    jaccard_join,
    language_id,
    license_scan,
    pii_bootstrap,
    quality_rules,
    rendezvous,
    sentencepiece_nbest,
    source_mix,
    toxicity,
    warc_bundles,
    whitening,
)
from contrail.llm.common import read_table, remainder_of_id
from contrail.session import scratch_path


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model: str = sentencepiece_nbest.MODEL) -> DataFrame:
    """Every text as its best piece list, the next best segmentations as edits, and whether the pieces decode to the text."""
    lattice = sentencepiece_nbest.load(model)
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = sentencepiece_nbest.encode(docs, lattice)
    decoded = sentencepiece_nbest.decode(encoded, lattice)
    plain = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(sentencepiece_nbest.MARK), F.lit(" "))
    return decoded.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.col("piece_score").alias("score"), "pieces", "alternatives",
        (F.col("decoded") == plain).alias("decodes"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document, as text lists."""
    scanned = license_scan.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return scanned.select(
        "doc_id",
        F.array_join("license_sentences", ",").alias("license_sentences"),
        F.array_join("licenses", ",").alias("licenses"),
        F.size("license_sentences").cast("long").alias("n_license_sentences"),
    )


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal weight by rendezvous hashing of doc_id."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return rendezvous.shard_slots(docs).withColumn("law", F.lit("key")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at five-word Jaccard similarity of 0.8 or more."""
    return jaccard_join.classes(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records into seekable bundles, and what the bundles hold."""
    path = scratch_path(spark, "warc-bundles")
    warc_bundles.write_bundles(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    records = warc_bundles.read_records(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return source_mix.taken_words(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Learned from the labels whose crc32(doc_id) mod 5 is not 0."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic").filter(remainder_of_id(F.col("doc_id"), 5) != 0)
    return toxicity.train(docs.select("doc_id", "text"), labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(remainder_of_id(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.drop("text")


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    """Learned from the documents whose crc32(doc_id) mod 3 is not 1."""
    return language_id.train(docs.select("doc_id", "text", "lang").filter(remainder_of_id(F.col("doc_id"), 3) != 1))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(remainder_of_id(F.col("doc_id"), 3) == 1, F.lit(False))
    predicted = language_id.identify(docs.select("doc_id", "text"), language_model(docs))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows, by Hamming distance of sign codes, of every row whose id is divisible by 100."""
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return hamming_topk.top_k(vectors, F.col("vec_id") % 100 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 3 hard negatives for each of the first 5 positives of every row whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0, label=label)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every usable embedding, one row each."""
    whitened, model = whitening.whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    shares = F.array(*[F.lit(float(x)) for x in model.explained]).cast("array<double>")
    return whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and places of the personal data of every document."""
    found = pii_bootstrap.find_spans(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: ~s["added"])
    counts = [pii_bootstrap.count_of(base, k).alias(f"n_{k}") for k in pii_bootstrap.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii_bootstrap.span_list(base), 256).alias("base_sha256"), pii_bootstrap.span_list(F.col("spans")).alias("spans")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_license_scan,
        op3_rendezvous_shards,
        op4_ngram_jaccard_join,
        op5_warc_bundles,
        op6_source_mix,
        op7_toxicity,
        op8_quality_rules,
        op9_language_id,
        op10_hamming_topk,
        op11_hard_negatives,
        op12_whitening,
        op13_pii,
    )
}
