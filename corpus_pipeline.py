"""From documents to a training sample in five stages, each over what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import decontam, mixing, pii_votes, quality_cascade, simhash
from lodgeflow.llm.common import fresh, landed, table

# In all stages rows of one id, and rows repeated in every column, are rows of their own unless a stage says
# otherwise; a null text counts as empty; an empty table gives an empty one; columns besides those of documents
# pass through under their own names, whatever these are. Each stage decides a row by its text (and, where it says
# so, by its id), so ties are broken alike on every run.


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null, empty and blank texts are rejected as too short; repeated rows fare alike."""
    ok = fresh(docs, "_quality")
    return quality_cascade.kept(docs, ok).where(ok).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, of rows tied on it any one.

    Null, empty and blank texts are one group. A row without an id stays only if its group has no id.
    """
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by test items. Texts without words are clean; repeated rows fare alike."""
    hits = fresh(docs, "_hits")
    found = decontam.with_hits(docs, table(spark, sf_dir, "benchmark"), hits)
    return found.where(~decontam.contaminated(hits)).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` following. A null text stays null.

    The scan is written with the rows, so the model's fit and the masking share it.
    """
    found, spans = fresh(docs, "_found"), fresh(docs, "_spans")
    scanned = landed(docs.withColumn(found, pii_votes.scanned(F.col("text"))), "scanned")
    model = pii_votes.trained(scanned, found)
    return (
        scanned.withColumn(spans, pii_votes.all_spans(model, found))
        .withColumn("text", pii_votes.masked(F.col("text"), F.col(spans)))
        .withColumn("n_chars", F.length("text").cast("bigint"))
        .select(*docs.columns)
    )


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents, with their topic, tokens and sampling probability.

    A topic that the table brings is used and kept; the other new columns get names that are free. Texts without
    tokens have their cell's probability; rows of one id share their draw.
    """
    topic = F.col("topic").cast("string") if "topic" in docs.columns else None
    cells = mixing.planned(mixing.measured(docs, topic))
    added = {c: fresh(docs, c) for c in ("topic", "n_tokens", "probability") if c != "topic" or c not in docs.columns}
    rows = mixing.measured(docs.withColumn("doc_id", F.struct(*docs.columns)), topic)
    chosen = rows.join(cells.select(*mixing.DIMENSIONS, "probability"), list(mixing.DIMENSIONS))
    chosen = chosen.where(mixing.draw(F.col("doc_id")["doc_id"]) < F.col("probability"))
    old = [F.col("doc_id")[c].alias(c) for c in docs.columns]
    return chosen.select(*old, *(F.col(c).alias(name) for c, name in added.items()))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing_to_targets),
]

#: SQL has neither automata, fingerprints nor raking; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
