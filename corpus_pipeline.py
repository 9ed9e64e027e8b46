"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; ``run`` writes every stage's rows as Parquet in the shared folder and
reads them back for the next.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import pii
from sluice.llm.common import table
from sluice.llm.jaccard_join import one_of_each
from sluice.llm.mixing import mix
from sluice.llm.packing import pack
from sluice.llm.quality import classify
from sluice.llm.queries import tokenizer_path
from sluice.session import new_run_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, keeps."""
    out = "verdict of the classifier"
    return classify(docs, table(spark, sf_dir, "labels"), out=out).where(F.col(out)["kept"]).drop(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id."""
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, ``n_chars`` counted anew."""
    return pii.mask(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    out = "share of the mix"
    copies = F.array_repeat(F.lit(1), F.col(out)["copies"].cast("int"))
    return mix(docs, out=out).withColumn(out, F.explode(copies)).drop(out)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixture),
    ("packing", sequences),
]

#: Fitted models, similarity components and packing are beyond SQL; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the packed sequences."""
    docs = table(spark, sf_dir, "documents")
    folder = new_run_dir(spark, "corpus-pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
