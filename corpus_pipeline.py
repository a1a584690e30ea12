"""From raw documents to token ids: quality, near-duplicates, repeated passages, language mix, SentencePiece.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of the documents they
were handed, extra columns included. ``run`` writes each stage's result as Parquet and hands it on. Stages that send texts to
Python set the session's Arrow batches to BATCH_TEXTS rows, as their last step runs when the result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm import dartminhash, mixing, pieces, quality, suffix_index
from isoreach.llm.common import BATCH_TEXTS
from isoreach.llm.queries import PIECE_MODEL, TARGETS, labelled_languages, table
from isoreach.operators.joins import Workspace, arrow_rows, lookup_join


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    arrow_rows(spark, BATCH_TEXTS)
    scored = quality.quality_scores(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return scored.filter("predicted = 1").select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id (a null id comes last).

    Every row is a document of its own, whatever its id; rows equal in all columns become one.
    """
    arrow_rows(spark, BATCH_TEXTS)
    work = Workspace(spark)
    # Extra columns may have any name and type: the row's key gets a free name, and maps, which have no hash, go in as JSON.
    key = "_key"
    while key in {c.lower() for c in docs.columns}:
        key = "_" + key
    column = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
    maps = [c for c, kind in docs.dtypes if "map<" in kind]
    hashed = {c: F.to_json(F.struct(x)) if c in maps else x for c, x in column.items()}
    keyed = docs.withColumn(key, F.xxhash64(*(x for c in docs.columns for x in (hashed[c], column[c].isNull()))))
    found = dartminhash.near_documents(keyed.select(F.col(key).alias("doc_id"), "text"))
    found = work.save(found.select(F.col("doc_id").alias(key), "component_id"), "near-rows")
    ids = keyed.select(key, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key).alias("_rank"))
    first = found.join(ids, key).groupBy("component_id").agg(F.min("_rank").alias("_rank")).select(F.col("_rank")[key].alias(key))
    gone = work.save(found.select(key).join(first, key, "left_anti"), "near-gone")
    left = lookup_join(keyed, gone, [key], "left_anti")
    if keyed.groupBy(key).count().filter("count > 1").limit(1).count():
        left = left.dropDuplicates([key, *(c for c in docs.columns if c not in maps)])
    return left.select(*column.values())


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of long repeated passages; n_chars follows the text."""
    arrow_rows(spark, BATCH_TEXTS)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    carry = [c for c in docs.columns if c not in new]  # the old text would go through Python a second time
    out = suffix_index.remove_repeats(docs, with_text=True, carry=carry)
    return out.select(*((new[c] if c in new else F.col(f"_c{carry.index(c)}")).alias(c) for c in docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of languages below their target are repeated; none is dropped."""
    arrow_rows(spark, BATCH_TEXTS)
    mixed = mixing.mix(docs, labelled_languages(spark, sf_dir, docs), TARGETS, floor=1.0, keep_all=True, keep=True)
    copies = F.explode(F.sequence(F.lit(1), mixing.copies(F.col("rate"), F.col("doc_id"))))
    return mixed.select("_row", copies.alias("_copy")).select("_row.*")


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    arrow_rows(spark, BATCH_TEXTS)
    return pieces.encode(docs, PIECE_MODEL)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeated_passage_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]

#: Trained models and hashes decide the rows, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    work = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
