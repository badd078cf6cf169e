"""Named queries of the training-data operators: each runs its operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from accountrisk.llm import bpe, conversations, decontaminate, html_text, jaccard, line_dedup, pii, pu_quality, quality_rules, records, suffix_dedup, variants, warc
from accountrisk.llm.common import sha256_of, table
from accountrisk.session import new_path

QUERIES = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_of(F.array_join("item_ids", ",")).alias("items_sha256"),
        "contaminated",
    )


@query
def op2_bpe(spark, sf_dir):
    path = public_tokenizers.path(TOKENIZER)
    decoded = bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_of(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256_of(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op3_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pu_quality.score_quality(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query
def op4_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind, spans="base"):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [*map(count, pii.KINDS), count("secret", "pii")]
    return found.select("doc_id", *counts, sha256_of(listed("base")).alias("base_sha256"), listed("pii").alias("spans"))


@query
def op8_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = records.write_records(docs, public_tokenizers.path(TOKENIZER), 1, new_path(spark, "records"))
    found = records.read_records(manifest, with_ids=False)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op10_jaccard(spark, sf_dir):
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


@query
def op5_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), sha256_of(F.col("kept")).alias("kept_sha256")
    )


@query
def op6_quality_rules(spark, sf_dir):
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"), keep_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    files = warc.write_archives(pages, new_path(spark, "warc"))
    captures = warc.transactions(warc.read_archives(files)).where(F.col("main").isNotNull())
    kind = pages.schema["page_id"].dataType
    return captures.select(
        F.col("main.page_id").cast(kind).alias("page_id"),
        F.col("main.payload_bytes").alias("payload_bytes"),
        F.col("main.payload_digest").alias("payload_digest"),
        F.col("main.record_type").alias("record_type"),
        F.col("main.refers_to").cast(kind).alias("refers_to"),
        F.size("requests").cast("long").alias("n_requests"),
        F.size("metadata").cast("long").alias("n_metadata"),
    )


@query
def op7_html_text(spark, sf_dir):
    found = html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "html"))
    lines = F.size(F.split("text", "\n")).cast("long").alias("n_lines")
    return found.select("page_id", F.length("text").cast("long").alias("n_chars"), lines, sha256_of(F.col("text")).alias("text_sha256"), "text")


@query
def op11_conversations(spark, sf_dir):
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


@query
def op12_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", sha256_of(F.col("text")).alias("kept_sha256"))


_STRIPPED = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
ORACLES["op12_line_dedup"] = f"""WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT row_id, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM texts
), keyed AS (
  SELECT *, translate({_STRIPPED}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM placed
), frequent AS (
  SELECT line_key FROM keyed WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT row_id) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(f.line_key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.line_key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.line_key = f.line_key GROUP BY row_id"""


@query
def op13_spelling_variants(spark, sf_dir):
    found = variants.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
