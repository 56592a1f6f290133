"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

quality rules -> quality classifier -> SimHash near-dedup -> suffix-array dedup -> best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.

The near-duplicate stage links two texts if the Jaccard similarity of their sets of five-word shingles is 0.8 or more; it is
computed exactly for all pairs that share a block of minima or of the SimHash fingerprint. The passage stage
looks for repeats of 250 bytes, and of 51 words where those have fewer bytes.

Defined cases: a document with a null or empty text is rejected by the first stage; a null id passes like any other and stands
for a group of near copies only if all its ids are null; null metadata and labels count as missing; repeated rows are copies
of one another; a document of which the passage stage leaves nothing is packed as its end id alone; extra columns pass
through all stages but the last, whatever their names; an empty table gives an empty result; very long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import best_fit_packing, cotraining, near_copies, quality_rules, suffix_dedup
from tessera.llm.common import drop_staged, id_text, prepare, staged

PASSAGE_BYTES, PASSAGE_WORDS, GRAM = 250, 51, 70


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return cotraining.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_copies.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    cut = suffix_dedup.cleaned(docs, PASSAGE_BYTES, GRAM, words=PASSAGE_WORDS)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return best_fit_packing.pack_documents(id_text(docs))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", passages),
    ("best_fit_packing", packing),
]

#: Fingerprints, trained models and tokenizers are beyond SQL; tests/llm holds the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, old = staged(stage(spark, docs, sf_dir), f"stage-{name}"), stored
        if old is not None:
            drop_staged(old)
        stored = docs
    return STAGES[-1][1](spark, docs, sf_dir)
