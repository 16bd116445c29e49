"""Queries of the ten training-data problems, as the driver contract wants them: name -> f(spark, sf_dir), name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import functions, leaks, pairs, personal, prose, secrets, split, syntax, tokens, variants
from corpusmill.plans.registry import WS
from corpusmill.runtime import table

#: Key of the surrogates in the registered query; a deployment passes its own.
DEMO_SECRET = "corpusmill-demo-key"


def _one(name: str, f: Callable[[DataFrame], DataFrame]):
    return lambda spark, d: f(table(spark, d, name))


def _two(a: str, b: str, f: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda spark, d: f(table(spark, d, a), table(spark, d, b))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": _two("source_docs", "chat_records", secrets.p1_found),
        "p1_redacted_files": _one("source_docs", lambda d: secrets.redacted(d, "file_id", "content").withColumnRenamed("id", "file_id")),
        "p1_redacted_chats": _one("chat_records", lambda d: secrets.redacted_messages(d, "record_id", "messages").withColumnRenamed("id", "record_id")),
        "p1_redacted_lines": _one("source_docs", lambda d: secrets.redacted(d, "file_id", "content").select(F.col("id").alias("file_id"), (F.length("text") - F.length(F.replace("text", F.lit("\n")))).alias("n_breaks"))),
        "p2_found": _one("source_docs", variants.p2_found),
        "p2_collapsed": _one("source_docs", variants.collapse),
        "p2_rows": _one("source_docs", lambda d: variants.collapse(d).agg(F.sum("copies").alias("n_rows"))),
        "p3_found": _one("source_docs", syntax.p3_found),
        "p3_rates": _one("source_docs", syntax.p3_rates),
        "p3_checked": _one("source_docs", lambda d: syntax.p3_rates(d).select("repo", "lang", "n_files")),
        "p4_found": _two("source_docs", "fim_triples", split.p4_found),
        "p4_pieces": _two("source_docs", "fim_triples", split.p4_pieces),
        "p4_rejoined": _two("source_docs", "fim_triples", split.p4_rejoined),
        "p5_found": _one("source_docs", prose.p5_found),
        "p5_languages": _one("source_docs", prose.file_languages),
        "p6_found": _one("chat_records", pairs.p6_found),
        "p7_found": _one("source_docs", functions.p7_found),
        "p7_pairs": _one("source_docs", functions.code_doc_pairs),
        "p8_ids": _one("documents", tokens.p8_ids),
        "p8_pieces": _one("documents", tokens.p8_pieces),
        "p8_decoded": _one("documents", tokens.p8_decoded),
        "p9_found": _two("documents", "eval_items", leaks.p9_found),
        "p9_passages": _two("documents", "eval_items", leaks.leaks),
        "p10_found": _one("documents", personal.p10_found),
        "p10_replaced": _one("documents", lambda d: personal.replaced(d, DEMO_SECRET).withColumnRenamed("id", "doc_id")),
        "p10_surrogates": _one("documents", lambda d: personal.replaced(d, DEMO_SECRET, mode="surrogate").withColumnRenamed("id", "doc_id")),
        "p10_collisions": _one("documents", lambda d: personal.collisions(d, DEMO_SECRET)),
    }


def oracle_sql() -> dict[str, str]:
    """Only what SQL can state independently of the operator: whole results, or what must hold of them."""
    extension = "lower(regexp_extract(file_path, '[^.]*$'))"
    return {
        "p1_redacted_lines": "SELECT file_id, (length(content) - length(replace(content, chr(10), '')))::INT AS n_breaks FROM source_docs",
        "p2_rows": "SELECT count(*) AS n_rows FROM source_docs WHERE regexp_matches(content, '[\\p{L}\\p{N}]')",
        "p3_checked": f"""
            SELECT repo, {extension} AS lang, count(*) AS n_files FROM source_docs
            WHERE contains(file_path, '.') AND {extension} IN ('py', 'json', 'toml', 'xml') AND regexp_matches(content, '[^{WS}]') GROUP BY ALL""",
        "p4_found": """
            SELECT 'source_docs' AS tbl, file_id AS rec_id FROM source_docs WHERE length(content) > 6000
            UNION ALL SELECT 'fim_triples', triple_id FROM fim_triples WHERE length(target_code) > 2000""",
        "p4_rejoined": """
            SELECT 'source_docs' AS tbl, file_id AS rec_id, true AS within, md5(content) AS text_md5 FROM source_docs WHERE length(content) > 6000
            UNION ALL SELECT 'fim_triples', triple_id, true, md5(target_code) FROM fim_triples WHERE length(target_code) > 2000""",
        "p8_decoded": "SELECT doc_id, md5(coalesce(text, '')) AS text_md5 FROM documents",
    }
