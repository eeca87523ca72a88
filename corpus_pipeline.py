"""A corpus pipeline over `documents`: five stages, each a function of (spark, docs, sf_dir).

Every stage is written as Parquet and reread as the next one's input. All but the last return
the columns of `documents`; the last adds the piece ids of the text and its length in pieces.
"""

from pyspark.sql import functions as F

from quarry.llm import decontamination, language_id, near_duplicates, secret_scan, sentence_pieces
from quarry.llm.common import stored


def language(spark, docs, sf_dir):
    """Drop documents in no learned language: no letters, or explained worse than by a background model."""
    model = language_id.train(docs)
    return language_id.keep_known_languages(docs, model)


def near_duplicate(spark, docs, sf_dir):
    """Keep the smallest document of every group of near duplicates (five words, 0.8)."""
    return near_duplicates.keep_one_per_group(docs, percent=80, size=5)


def benchmark_decontamination(spark, docs, sf_dir):
    """Drop documents of which a twentieth of the words stands in benchmark passages."""
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark, docs, sf_dir):
    """Mask values that look like live secrets: those that few sources share. No document goes."""
    return secret_scan.redact_live(docs, repository=F.concat_ws("/", "source", "lang"), owner="source")


def pieces(spark, docs, sf_dir):
    """Encode the texts and check by decoding that nothing is lost."""
    encoded = sentence_pieces.encode_checked(docs, out="piece_ids", exact="exact")
    return encoded.withColumn("n_pieces", F.size("piece_ids").cast("bigint"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate),
    ("decontamination", benchmark_decontamination),
    ("secrets", secrets),
    ("pieces", pieces),
]

# Stages 1 and 5 score with learned or fixed piece models, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on the documents of a folder; stages are stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
