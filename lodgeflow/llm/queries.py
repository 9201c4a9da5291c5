"""The registered queries of this package: thin wraps that derive each contract's columns."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import brown_lm, chat_format, decontam, html_wrapper, infill, mixing, pii_votes, quality_cascade, simhash, suffix_dedup, toxicity, warc, whitening
from lodgeflow.llm.oracles import ORACLES  # noqa: F401
from lodgeflow.llm.common import landed, per_row, table
from lodgeflow.session import scratch_dir


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("rest")).cast("bigint").alias("n_removed"),
        F.size("runs").cast("bigint").alias("n_spans"),
        F.sha2("rest", 256).alias("kept_sha256"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], said.schema)

    def digests(formatted: str, loss_spans: list[dict]) -> dict:
        turns = "".join(f"{role}\n{text}\n" for role, text in chat_format.parsed(formatted))
        loss = chat_format.unescaped("".join(formatted[s["start"] : s["end"]] for s in loss_spans))
        return {
            "turns_sha256": sha256(turns.encode()).hexdigest(),
            "loss_chars": len(loss),
            "loss_sha256": sha256(loss.encode()).hexdigest(),
            "formatted_chars": len(formatted),
        }

    kind = "struct<turns_sha256:string, loss_chars:bigint, loss_sha256:string, formatted_chars:bigint>"
    out = chat_format.formatted(said.unionByName(extra))
    return out.select("conv_id", "n_turns", per_row(digests, kind)("formatted", "loss_spans").alias("d")).select(
        "conv_id", "n_turns", "d.*"
    )


def op3_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.scores(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_cascade.judged(docs).select("doc_id", "quality.*")


def _listed(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", parts)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = landed(docs.select("doc_id", pii_votes.scanned(docs.text).alias("found")), "pii")
    model = pii_votes.trained(found, "found")
    base = F.col("found.base")
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in pii_votes.KINDS]
    counts = [(F.size(kinds) - n).cast("bigint").alias(f"n_{k}") for n, k in zip(counts, pii_votes.KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(pii_votes.all_spans(model, "found")).alias("spans"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(mixing.measured(table(spark, sf_dir, "documents")), "measured")
    return mixing.mixed(rows, mixing.planned(rows))


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.with_hits(docs, table(spark, sf_dir, "benchmark"), "hits")
    items = F.array_sort(F.transform("hits.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "hits.n_words",
        decontam.n_hit("hits").alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        decontam.contaminated("hits").alias("contaminated"),
    )


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_wrapper.main_texts(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path, compression="gzip")
    page = lambda name: F.regexp_extract(name, "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")
    return warc.read(spark, path).where("kind = 'record'").select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.trained(docs.where(~held_out), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = whitening.whitened(rows).select("vec_id", "white.*")
    each = F.posexplode(F.arrays_zip("whitened", "explained"))
    return found.select("vec_id", "n", "deviation", "identity_error", each.alias("at", "c")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("c")["whitened"].alias("whitened"),
        F.col("c")["explained"].alias("explained"),
        "identity_error",
    )


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = infill.with_infill(docs)
    return found.select(
        "doc_id",
        "infill.n",
        "infill.form",
        "infill.prefix_chars",
        "infill.middle_chars",
        F.sha2("infill.output", 256).alias("output_sha256"),
        F.sha2(infill.text_of("infill"), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_suffix": op1_suffix,
    "op2_chat": op2_chat,
    "op3_brown": op3_brown,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_mixing": op6_mixing,
    "op7_decontam": op7_decontam,
    "op8_simhash": op8_simhash,
    "op9_html": op9_html,
    "op10_warc": op10_warc,
    "op11_toxicity": op11_toxicity,
    "op12_whitening": op12_whitening,
    "op13_infill": op13_infill,
}
