"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import anchor_tree, credentials, fuzzy_lines, neighbour_quality, pfair, phrase_growth, piece_transducer, product_quantiser, sentence_toxicity, signature_tree, suffix_automata, threshold_search, winnowing
from zonalis.llm.sql import SQL

PIECES = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _fold(parts: int, held: int) -> Column:
    """Whether crc32 of doc_id as text leaves the held-out remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == held, F.lit(False))


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Noisy-or of sentence scores, trained on the labels outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = sentence_toxicity.train(docs, table(spark, folder, "labels").filter(~_fold(3, 1)))
    out = sentence_toxicity.score_toxicity(docs, model)
    return out.select("doc_id", _fold(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                      F.size("offending").alias("n_offending"))


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbours' votes in the latent space of the labels outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = neighbour_quality.train(docs, table(spark, folder, "labels").filter(~_fold(4, 2)))
    out = neighbour_quality.score_quality(docs, model)
    return out.select("doc_id", _fold(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_neighbours")


@query
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words covered by a window of 13 words that starts in a document of a smaller id."""
    out = suffix_automata.dedup_substrings(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of equal label linked from a cosine of 0.93."""
    return product_quantiser.embedding_components(table(spark, folder, "embeddings"), threshold=0.93)


@query
def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in blocks of 64, interleaved to equal shares of the sources."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return pfair.schedule(docs)


@query
def op6_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 best integer inner products of every vec_id divisible by 50 with all other rows."""
    rows = threshold_search.quantised(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    found = threshold_search.top_products(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct 4-word shingles in lower case, linked from a Jaccard similarity of 0.85."""
    return signature_tree.jaccard_components(
        table(spark, folder, "documents"), k=4, threshold=signature_tree.Threshold(85, 100), fold_case=True)


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that repeat, closely or exactly, an earlier one."""
    return fuzzy_lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), short=True)


@query
def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every whole text, and whether decoding them gives the text back."""
    model = piece_transducer.read_model(PIECES)
    coded = piece_transducer.encode(table(spark, folder, "documents").select("doc_id", "text"), model)
    both = piece_transducer.decode(coded, model)
    return both.select("doc_id", "tokens", F.size("tokens").cast("long").alias("n_tokens"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Base secrets and the weak parts that complete them, in every whole text."""
    return credentials.digest(credentials.find_credentials(table(spark, folder, "documents").select("doc_id", "text")))


@query
def op11_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every whole text and of its text edited with the next document's."""
    found = winnowing.fingerprint_edits(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        *[winnowing.written(F.col(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")], "near_edited", "near_next")


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """For every vec_id divisible by 100 and its 5 best of the same label, the 5 best of other labels
    within 80 to 100 % of their score; a seventh of the labels is changed first."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return anchor_tree.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op13_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 best phrases of two or three words of every language."""
    return phrase_growth.mine_phrases(table(spark, folder, "documents"))


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in SQL.items() if name in QUERIES}
