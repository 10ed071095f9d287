"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared checkpoint folder
and reads it again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm import bpe, langid, mixing, repeats, simhash
from starfold.llm.recovery import written
from starfold.llm.registry import importable

RANKS = "byte_bpe_multi_50k.tiktoken"
# SQL can say neither the learned languages nor the fingerprints; tests/llm compares with a plain version.
ORACLE_SQL = None


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def stage(function):
    """A stage can be called by itself, from any folder."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is clearly one of those labelled here; what has no letter or hangs between two goes.

    So do null and empty texts. Where no document is labelled, nothing can be told and all stay. Other columns stay as they
    are, whatever their names.
    """
    model = langid.fit(docs)
    if not model.languages:
        return docs
    own = {name: f"__own_{name}" for name in ("lang_pred", "score", "ambiguous") if name in docs.columns}
    found = langid.identify(docs.withColumnsRenamed(own), model)
    clear = found.filter((F.col("lang_pred") != langid.UNDETERMINED) & ~F.col("ambiguous"))
    return clear.select(*(F.col(own.get(name, name)).alias(name) for name in docs.columns))


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on shingles of five words and a similarity of 0.8 or more.

    Null and empty texts have no shingles and are copies of each other: one of them stays.
    """
    return simhash.near_copies(docs, shingle=5, similarity=0.8)


@stage
def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur more than once; a text of nothing else is left empty."""
    return recounted(repeats.remove_repeats(docs)).select(*docs.columns)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the one at a source's cut as far as the cut.

    A document that the mix takes in several epochs is there once for each; one of which it takes no word is not there, nor
    is one without words. Repeated rows are documents of their own: all get their place, and only equal rows are told apart
    by chance. Each row has a number of its own in a written table, by which it meets its share, so that neither repeated
    rows nor one id under several sources meet in one key.
    """
    rows = written(docs.withColumn("__mix_row", F.monotonically_increasing_id()), "mix-rows")
    hashed = [field.name for field in docs.schema if not isinstance(field.dataType, T.MapType)]
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64(*(F.col(f"`{n}`") for n in hashed)))
    sizes = rows.select(key.alias("key"), "source", mixing.word_count(F.col("text")).alias("size"), "__mix_row")
    taken = mixing.mix(sizes, "key", carry=["__mix_row"]).filter("taken > 0").select(
        "__mix_row", F.col("size").alias("__mix_size"), F.col("taken").alias("__mix_taken")
    )
    epochs = """transform(sequence(1, cast(ceil(__mix_taken / __mix_size) as int)),
                          i -> least(__mix_size, __mix_taken - (i - 1) * __mix_size))"""
    copies = rows.join(taken, "__mix_row").withColumn("__mix_words", F.explode(F.expr(epochs)))
    cut = mixing.first_words(F.col("text"), F.col("__mix_words"))
    text = F.when(F.col("__mix_words") == F.col("__mix_size"), F.col("text")).otherwise(cut)
    return recounted(copies.withColumn("text", text)).select(*docs.columns)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, which decode to the text's bytes; a null text has none.

    Columns named ``ids`` and ``n_tokens`` are replaced.
    """
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.encode_column(docs, path, pattern).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", remove_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
