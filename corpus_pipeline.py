"""From raw documents to packed sequences: language, exact and near duplicates, leaks, packing.

Every stage works on all that its predecessor kept. All but the last return the columns of
``documents`` as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import documents, written
from jobmart.llm.decontaminate import without_leaks
from jobmart.llm.exact_dedup import drop_duplicates
from jobmart.llm.langid import NO_LANGUAGE, language_of, profiles
from jobmart.llm.near_dedup import drop_near_duplicates
from jobmart.llm.packing import pack_documents
from jobmart.llm.vocabularies import PACKING_ENCODING, SEQUENCE_TOKENS

#: A text this little like the nearest language profile is in none of the languages.
LEAST_LIKE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus; texts without a letter or unlike all profiles go.

    Profiles are learned from the rows that name a language. If none does, every text with a letter stays.
    """
    learned = profiles(docs)
    if not learned:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_of(spark, learned)(F.col("text"))
    return docs.withColumn("_found", found) \
        .where((F.col("_found.lang_pred") != NO_LANGUAGE) & (F.col("_found.score") >= LEAST_LIKE)).drop("_found")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts (five words a shingle, similarity of 0.8 or more)."""
    return drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of the remaining documents stands in a training sequence."""
    return pack_documents(docs, PACKING_ENCODING, SEQUENCE_TOKENS)


STAGES = [
    ("language ID", language_id),
    ("exact duplicates", exact_duplicates),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: The stages fit models, search by hashing and evolve packings, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
