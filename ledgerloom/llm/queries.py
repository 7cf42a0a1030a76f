"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.llm import (bpe, divergence, fingerprints, html, jaccard, language, lines, packing,
                            pieces, sharding, toxicity, vectors, whitening)
from ledgerloom.llm.common import in_fold, read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~in_fold())
    return (toxicity.score(docs, model, lang_col="lang")
            .select("doc_id", in_fold().alias("held_out"), "score",
                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "rejected"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs, ~in_fold())
    return (language.predict(docs, model)
            .select("doc_id", in_fold().alias("held_out"), "lang_pred", "score"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(read(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str,
            tokenizer: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    codec = bpe.Codec(tokenizer).with_lexicon(bpe.frequent_words(docs))
    coded = bpe.encode_decode(docs, codec)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedupe_lines(docs)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes: an even map, edited once by the bytes per slot."""
    rows = sharding.sized(read(spark, sf_dir, "documents"))
    slot_map = sharding.SlotMap.create(spark, storage.new_dir(spark, "slots"), 24)
    version = slot_map.rebalance(sharding.bytes_per_slot(rows))
    return (sharding.placed(rows, slot_map.read(version))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "vslot"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(read(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str,
                       model: str = public_tokenizers.path("piece_bpe_32k.model")) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode_decode(docs, pieces.Vocabulary(model), check="agrees")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(listed, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, _ = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return whitening.by_component(done)


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_language, op3_jaccard_join, op4_bpe, op5_packing, op6_near_vectors,
    op7_line_dedup, op8_sharding, op9_fingerprints, op10_html, op11_divergence,
    op12_sentencepiece, op13_whitening)}
ORACLES: dict[str, str] = {"op11_divergence": divergence.SQL}
