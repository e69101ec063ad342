"""The registered queries opN_* and their DuckDB oracles.

Each query reads its whole table, applies its operator and derives the digest
columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import held_out, ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    """Register under the function's name, with the oracle of that name if there is one."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark), sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    if hasattr(oracles, fn.__name__):
        ORACLE[fn.__name__] = getattr(oracles, fn.__name__)
    return run


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the threshold table for every document."""
    from .quality_rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases, template labels and coverage for every document."""
    from .license_scan import license_scan
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FTRL score of every document; labels only from rows not held out."""
    from . import toxicity
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register
def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CNN quality score of every document; labels only from rows not held out."""
    from . import byte_cnn
    docs = table(spark, sf_dir, "documents")
    model = byte_cnn.train(docs, table(spark, sf_dir, "labels"))
    return byte_cnn.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register
def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from .minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@register
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    from .decontaminate import decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path() -> str:
    """The vocabulary file of the token-file queries, where the public tokenizers are installed."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register
def op8_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    from .token_planes import token_files
    return token_files(table(spark, sf_dir, "documents"), tokenizer_path())


@register
def op3_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations of the whole log, rendered."""
    from .chat import format_chats
    return format_chats(table(spark, sf_dir, "conversations"))


@register
def op6_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    from .mixing import mix
    return mix(table(spark, sf_dir, "documents"))


@register
def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    from .sharding import shard
    return shard(table(spark, sf_dir, "documents"))


@register
def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more hold."""
    from . import line_dedup
    path = f"{sf_dir}/documents.parquet"
    common = line_dedup.common_lines(spark, line_dedup.file_batches(spark, path))
    return line_dedup.drop_lines(spark.read.parquet(path), common).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    from .lexical_search import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op11_veb_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the rebuilt conversations."""
    from . import prefix_trie as trie
    from .common import stored
    turns = stored(trie.ordered(table(spark, sf_dir, "conversations")), "ordered")
    return trie.prefix_trie(*trie.rebuilt(turns, trie.lengths(turns)))
