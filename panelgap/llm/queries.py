"""The dealt operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import pii
from .decontaminate import overlaps
from .divergence import divergence_audit
from .language_id import identify
from .language_model import score_texts
from .licenses import PositionalIndex, Scanner, inverse_frequencies, notices, phrases, scan_licenses
from .merkle import folded, leaf_hash, merkle_proofs, proof_digest
from .mixing import mix
from .oracle import DIVERGENCE_SQL, MERKLE_SQL, REPEATS_SQL, overlaps_sql, urls_sql
from .quality import quality_report
from .sharding import shard
from .simhash import simhash_components
from .substring_dedup import remove_repeats
from .urls import UrlRule, filter_urls

SHARDS = 8
URL_RULES = [UrlRule("com", "/", "allow"), UrlRule("example.com", "/en/", "block"),
             UrlRule("www.example.com", "/en/", "allow"), UrlRule("net", "/es/", "block"),
             UrlRule("net", "/fr/", "block")]


def id_crc_is(doc_id: str, modulus: int, rest: int) -> Column:
    """crc32 of the id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == rest, F.lit(False))


def _starts_with(prefix: str) -> Callable[[Column], Column]:
    return lambda s: s.startswith(prefix)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under the law of rows: the load bound has no slack, so counts are at most one apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(docs, SHARDS).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit(docs))
    return found.select(
        "doc_id", *[F.size(F.filter("strict", _starts_with(f"{k}:"))).cast("long").alias(f"n_{k}")
                    for k in pii.KINDS],
        F.sha2(F.array_join("strict", ","), 256).alias("base_sha256"), F.array_join("spans", ",").alias("spans"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                    read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents", "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return identify(docs, id_crc_is("doc_id", 3, 1))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", id_crc_is("doc_id", 5, 1))
    return score_texts(docs, ~F.col("held_out"), carry=["held_out"])


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"), emit="sha256")
            .withColumnRenamed("kept", "kept_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(read_table(spark, sf_dir, "documents", "lang", "source", "text"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's phrases come first in the index, so a find below their number is a base one."""
    docs, base = read_table(spark, sf_dir, "documents", "doc_id", "text"), phrases()
    index = PositionalIndex([*base, *notices()])
    found = scan_licenses(docs, Scanner(index, inverse_frequencies(docs, index)))
    ours = F.filter("found", lambda x: x["template"] < len(base))

    def labels(hits: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda x: x["label"]))), ",")

    starts = F.transform(ours, lambda x: x["first_word"])
    return found.select("doc_id", "n_words", F.size(ours).cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        labels(ours).alias("base_labels"), labels(F.col("found")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tampered leaf travels beside the original one and is folded through the same proof."""
    cols = ("doc_id", "source", "lang", "n_chars", "text")
    docs, first = read_table(spark, sf_dir, "documents", *cols), [F.col(c) for c in cols[:-1]]
    tampered = F.when(id_crc_is("doc_id", 2, 0), F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = merkle_proofs(docs, "source", "doc_id", leaf_hash(*first, F.col("text")),
                           carry={"tampered": leaf_hash(*first, tampered)})
    return (proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                          folded(F.col("tampered"), F.col("proof")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


#: Quality rules in DuckDB SQL: the measures of the contract and the rules of the cascade.
QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
grams AS (SELECT rid, i, list_aggregate(list_slice(ws, i, i + 7), 'string_agg', ' ') AS g
          FROM w, unnest(range(1, len(ws) - 6)) AS u(i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
cover AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n
          FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
m AS (SELECT doc_id, t, ws, ls, len(ws)::BIGINT AS n_words,
             length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(cover.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cover USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS stutters FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT (n_symbols > 0.2 * n_words)
       AND NOT (n_dup_lines >= 5 AND n_dup_lines > 0.5 * len(ls))
       AND word_chars BETWEEN 2 * n_words AND 16 * n_words
       AND NOT (t = upper(t) AND t <> lower(t))
       AND NOT (stutters > 0.5 * n_words)
       AND NOT (length(t) - length(replace(t, '!', '')) > 0.5 * n_words) AS kept
FROM b"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_sharding, op3_pii, op4_decontaminate, op5_mixing,
                                    op6_language_id, op7_simhash, op8_urls, op9_language_model, op10_substring_dedup, op11_divergence,
                                    op12_licenses, op13_merkle)}


def oracle_sql() -> dict[str, str]:
    """Only what SQL can say: the others rest on hash functions, fitted models or iteration."""
    return {"op1_quality": QUALITY_SQL, "op4_decontaminate": overlaps_sql(), "op8_urls": urls_sql(URL_RULES),
            "op10_substring_dedup": REPEATS_SQL, "op11_divergence": DIVERGENCE_SQL, "op13_merkle": MERKLE_SQL}
