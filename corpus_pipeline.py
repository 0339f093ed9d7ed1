"""The corpus pipeline: five stages over ``documents``, each applying one operator of ``tidepool.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as
Parquet in the shared folder and rereads it as the next one's docs. All but the last return documents with
the columns they came with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm.common import table
from tidepool.llm.decontaminate import drop_contaminated
from tidepool.llm.exact import drop_exact_copies
from tidepool.llm.pieces import encode_documents
from tidepool.llm.simhash import drop_near_copies
from tidepool.llm.toxicity import drop_toxic
from tidepool.session import checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents scored 0.7 or more go; the dictionaries learn from labels of ``documents``."""
    return drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of equal texts the longest original stays, then the smallest doc_id."""
    return drop_exact_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group linked at 4 bits or fewer stays, that with the smallest doc_id."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents with a word inside a benchmark window go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the best segmentations of each document left."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Compression lengths, bit votes over XXH64 and piece lattices are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the last."""
    docs, home = table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{home}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
