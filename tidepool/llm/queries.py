"""The registered queries of the document operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import documents
from tidepool.llm import burst_trie, filter_audit
from tidepool.llm.imatch import fingerprints
from tidepool.llm.langid import identify, learn
from tidepool.llm.merge_automaton import round_trip
from tidepool.llm.nbest import nbest_digests
from tidepool.llm.packing import pack_documents
from tidepool.llm.quality import judge, train
from tidepool.llm.registry import ORACLES, QUERIES, query
from tidepool.llm.secret_scan import scan_documents
from tidepool.llm.simhash import near_duplicates
from tidepool.llm.substring_dedup import dedup_substrings
from tidepool.llm.token_counts import token_counts
from tidepool.llm.token_files import read_documents, write_token_files
from tidepool.session import new_folder

__all__ = ["ORACLES", "QUERIES"]


@query("op1_substrings")
def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds, and every text without them."""
    found = dedup_substrings(documents(spark, sf_dir).select("doc_id", "text", F.length("text").cast("long").alias("n_chars")))
    listed = F.concat_ws(",", F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    gone = F.col("n_chars") - F.length("text")
    return found.select("doc_id", "n_chars", gone.alias("n_removed"), F.size("removed").alias("n_spans"), listed.alias("spans"), "text")


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as Arrow files and read back from them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(documents(spark, sf_dir), path, new_folder(spark, "tokens"), end_id=1)
    return read_documents(manifest)


@query("op3_nbest")
def op3_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document."""
    return nbest_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), n_best=4)


@query("op4_pack")
def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


@query("op5_imatch")
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every document and of its edited text."""
    return fingerprints(documents(spark, sf_dir))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints are linked at two or fewer differing bits."""
    return near_duplicates(documents(spark, sf_dir), words=3, bits=2)


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of SentencePiece tokens of every document."""
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, from a ledger that starts empty."""
    return scan_documents(documents(spark, sf_dir))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether it is kept."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    judged = judge(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = documents(spark, sf_dir)
    return identify(docs, learn(docs))


@query("op11_automaton")
def op11_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the tokenization automaton, and the text that they decode to."""
    done = round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return done.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


@query("op12_trie")
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, rebuilt on their families' first turns."""
    return burst_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op13_filter_audit")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLES["op12_trie"] = burst_trie.ORACLE
ORACLES["op13_filter_audit"] = filter_audit.ORACLE
