"""The operators of this folder as queries over the tables of a folder: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm import (
    ann,
    bpe,
    near_dup,
    packing,
    pii,
    ranked,
    secrets,
    sharding,
    simhash,
    spans,
    toxicity,
    turns,
    urls,
    warc,
)
from tallyguard.llm.common import join_keys, shipping, stored, table
from tallyguard.llm.oracles import SQL  # noqa: F401

URL_RULES = [
    urls.Rule(urls.ALLOW, "com", "/"),
    urls.Rule(urls.BLOCK, "example.com", "/en/"),
    urls.Rule(urls.ALLOW, "www.example.com", "/en/"),
    urls.Rule(urls.BLOCK, "net", "/es/"),
    urls.Rule(urls.BLOCK, "net", "/fr/"),
]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs).select("doc_id", *spans.digest_columns("pii", pii.BASE_KINDS))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train(secrets.labelled_strings(docs))
    return secrets.find(docs, model).select("doc_id", *spans.digest_columns("secrets", secrets.BASE_KINDS))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).drop("text")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), count=8)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For ids divisible by 100: ``n_near``, the other documents within 3 bits, and ``near``, their fingerprints'
    representatives with distance and number of documents. A representative is the smallest id of a fingerprint;
    every document names its own, so a fingerprint's members are the rows with that ``representative``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = stored(simhash.compare_with_edit(docs), "simhash")
    asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    matched = stored(simhash.near_documents(prints.filter(asked), prints), "simhash-near")
    found = join_keys(prints, matched, "fingerprint", "n_docs")
    found = found.withColumns({c: F.when(asked, F.col(c)) for c in ("n_near", "near")})
    own, new, after = (F.col(f"{x}fingerprint") for x in ("", "edited_", "next_"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.hex16(own).alias("fingerprint"),
        simhash.hex16(new).alias("edited_fingerprint"),
        simhash.likeness(own, new).alias("near_edited"),
        simhash.likeness(own, after).alias("near_next"),
        "n_near",
        "representative",
        "near",
    )


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = urls.train(urls.rule_labelled(pages, URL_RULES))
    judged = urls.judge(pages, URL_RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    harmed = turns.damaged(table(spark, sf_dir, "conversations"))
    return turns.summaries(harmed, dropped=F.col("dropped"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_secrets": op2_secrets,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_bpe": op5_bpe,
    "op6_ann": op6_ann,
    "op7_sharding": op7_sharding,
    "op8_simhash": op8_simhash,
    "op9_near_dup": op9_near_dup,
    "op10_urls": op10_urls,
    "op11_turns": op11_turns,
    "op12_warc": op12_warc,
    "op13_ranked": op13_ranked,
}
QUERIES = {name: shipping(query) for name, query in QUERIES.items()}
