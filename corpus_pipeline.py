"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns the columns of documents, but for
the last, which returns the packed pieces. ``run`` writes each stage's result to the shared checkpoint folder and
reads it again, so a lost executor never costs more than the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tianguis.llm import language, mixing, packing, simhash, suffix_array
from tianguis.llm.common import discard, small_batches, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn languages from the documents that have a lang, label the spans of every text, and let those go that
    are null or have no letter. Texts of several languages stay whatever their shares, and texts with letters stay
    where there is no labelled document to learn from. lang itself is left as it came."""
    small_batches(spark)
    model = language.fit(docs.where(language.learns()).select("lang", "text"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    if not model.languages:
        return language.lettered(docs)
    return language.predict(rows, model, ["row"]).where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id, null ids last. Rows are
    grouped by their fingerprints alone, so unrelated texts under one id both stay, and copies without an id go."""
    small_batches(spark)
    return simhash.distinct_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that an earlier place has too are cut out; a document of which nothing is left
    goes, and n_chars follows the text."""
    small_batches(spark)
    others = [c for c in docs.columns if c != "text"]
    found = suffix_array.deduplicate(docs, others)
    found = found.where("n_bytes = 0 or kept_text <> ''")
    columns = {c: F.col("row").getField(c) for c in others} | {"text": F.col("kept_text")}
    if "n_chars" in others:
        columns["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring the sources to target weights: every document stays, and small sources are repeated, at most twice
    over, until the temperature found for that limit is met. Rows come in the order of the mix: by block, and inside
    it by slot, so that what is written and read again carries the permutation."""
    small_batches(spark)
    mixed = mixing.mix(docs).repartitionByRange("__block", "__slot")
    mixed = mixed.sortWithinPartitions("__block", "__slot", "__epoch", "doc_id", "text")
    return mixed.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2048 at balanced attention cost."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), added_tokens=True)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]

#: No stage but the last checks of lengths could be put in SQL; the tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs, given = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        if given is not None:
            discard(given)
        given = docs
    return STAGES[-1][1](spark, docs, sf_dir)
