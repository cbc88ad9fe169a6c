"""The corpus pipeline: toxicity, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again as the next one's docs.
All but the last return the columns of documents:

* toxicity: documents predicted toxic go.
* simhash: of each class of near-duplicates the document with the smallest id stays.
* secrets: secrets are masked in the texts.
* mixing: sources are mixed to their targets; documents may go or repeat, each whole. Rows are written in training
  order; a later scan need not keep it.
* bpe: token ids of the text, their number, and the digest of the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import bpe, mixing, secrets, simhash_index, toxicity
from strandline.llm.common import rewritten, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("simhash", simhash_index.stage),
    ("secrets", secrets.stage),
    ("mixing", mixing.stage),
    ("bpe", bpe.stage),
]

#: The learned models of the first and third stage cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = rewritten(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
