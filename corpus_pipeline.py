"""Documents to training rows: quality, near duplicates, contamination, personal data, tokens.

Each stage gets what the stage before kept, as a table written to the shared work folder and read again. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountrisk.llm import bpe, decontaminate, jaccard, pii, pu_quality
from accountrisk.llm.common import as_bytes, table
from accountrisk.session import written

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = pu_quality.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def row_key(docs: DataFrame) -> Column:
    """Digest of the whole row; equal for rows equal in every column only."""
    others = F.struct(*[F.col(c) for c in docs.columns if c != "text"], F.col("text").isNull().alias("no_text"))
    return F.unhex(F.md5(F.concat(F.to_json(others, {"ignoreNullFields": "false"}).cast("binary"), as_bytes("text"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that of the smallest id; a null id is the last to stay, rows of
    equal ids go by the digest of the whole row. Texts without words are near copies of nothing; of rows equal in
    every column one stays."""
    keyed = docs.withColumn("row_key", row_key(docs))
    groups = written(jaccard.link_documents(keyed, id_col="doc_id", text_col="text", key_col="row_key"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))["row_key"]
    stay = groups.groupBy("component").agg(first.alias("kept_key")).select("kept_key").distinct()
    times = groups.groupBy("row_key").agg((F.count("*") > 1).alias("again"))
    stay = written(stay.join(times, F.col("kept_key") == F.col("row_key")).select("kept_key", "again"), "stay")

    def rows(again: bool) -> DataFrame:
        keys = stay.where(F.col("again") == again).select("kept_key")
        return keyed.join(keys, F.col("row_key") == F.col("kept_key"), "left_semi")

    kept = rows(False).select(*docs.columns)
    return kept if stay.where("again").isEmpty() else kept.union(rows(True).dropDuplicates(["row_key"]).select(*docs.columns))


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more repeats windows of benchmark items go; the others stay as they are."""
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.find_and_redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and the text they decode to."""
    encoded = bpe.encode_and_decode(docs, public_tokenizers.path(TOKENIZER), keep_memo=False)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
