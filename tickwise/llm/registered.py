"""The operators' registered queries: each applies one operator with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.config import scratch_path
from tickwise.llm import (bpe, conversations, decontaminate, fingerprint, host_reputation, langid, ngram_join, packing,
                          pii, quality, secrets, warc, whitening)
from tickwise.llm.common import documents

# The rules of the URL filter's contract.
URL_RULES = [
    host_reputation.Rule("allow", "org", "/"),
    host_reputation.Rule("block", "example.org", "/es/"),
    host_reputation.Rule("block", "example.org", "/en/1"),
    host_reputation.Rule("allow", "com", "/fr/"),
    host_reputation.Rule("block", "com", "/de/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(documents(spark, sf_dir), width=3, num=90, den=100).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.records_of(_table(spark, sf_dir, "pages")), path, gzip=True)
    # A response's digest and length are taken anew from the payload read back. Of revisits only headers are read:
    # the type is pushed down, and no payload is kept or decoded.
    responses = warc.read_archives(spark, path).where("record_type = 'response'").select(
        "record_id", "record_type", "refers_to", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))
    revisits = warc.read_archives(spark, path, payload=False).where("record_type = 'revisit'").select(
        "record_id", "record_type", "refers_to", "payload_bytes", "payload_digest")
    return responses.unionByName(revisits).select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


def op6_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(documents(spark, sf_dir)).drop("ids")


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damage(_table(spark, sf_dir, "conversations")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of(_table(spark, sf_dir, "embeddings"))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_ngram_join": op3_ngram_join,
    "op4_host_reputation": op4_host_reputation,
    "op5_warc": op5_warc,
    "op6_pii_spans": op6_pii_spans,
    "op7_secret_scan": op7_secret_scan,
    "op8_packing": op8_packing,
    "op9_fingerprint": op9_fingerprint,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_bpe_codec": op13_bpe_codec,
    "pipeline": pipeline,
}

_TWO = ", ".join(f"'{x}'" for x in host_reputation.TWO_LABEL_SUFFIXES)


def _fits(rule: host_reputation.Rule) -> str:
    return (f"((host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}'))")


_RULES = sorted(URL_RULES, key=lambda r: -len(r.text))
_RULE_TEXT = "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{r.text}'" for r in _RULES) + " END"
_RULE_VERDICT = "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{r.verdict}'" for r in _RULES) + " END"


def _strength(source: str, mu: str) -> str:
    """Prior strength of one level from the spread of its groups' counts around their parents' means."""
    rho = (f"CASE WHEN sum(n * (n - 1) * {mu} * (1 - {mu})) > 0 THEN (sum((k - n * {mu}) * (k - n * {mu})) "
           f"- sum(n * {mu} * (1 - {mu}))) / sum(n * (n - 1) * {mu} * (1 - {mu})) ELSE 0.05 END")
    return f"(SELECT 1 / least(greatest(coalesce({rho}, 0.05), 0.002), 0.5) - 1 FROM {source})"


ORACLE_SQL: dict[str, str] = {
    "op4_host_reputation": f"""
        WITH s AS (
          SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM (SELECT page_id, CASE WHEN coalesce(strpos(url, '://'), 0) > 0 THEN substr(url, strpos(url, '://') + 3)
                                     ELSE '' END AS rest FROM pages)
        ), o AS (
          SELECT host, count(*) AS n, sum(CASE WHEN coalesce(quality, 0) = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS k
          FROM s JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY host
        ), h AS (
          SELECT host, CASE WHEN two IN ({_TWO}) THEN array_to_string(l[-3:], '.') ELSE two END AS domain,
                 CASE WHEN two IN ({_TWO}) THEN two ELSE l[-1] END AS suffix,
                 CAST(coalesce(n, 0) AS DOUBLE) AS n, CAST(coalesce(k, 0) AS DOUBLE) AS k
          FROM (SELECT host, string_split(host, '.') AS l, array_to_string(string_split(host, '.')[-2:], '.') AS two
                FROM (SELECT DISTINCT host FROM s)) LEFT JOIN o USING (host)
        ), t AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS top FROM h),
        b1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(top) AS mu FROM h, t GROUP BY suffix),
        r1 AS (SELECT suffix, (a * mu + k) / (a + n) AS mean FROM b1, (SELECT {_strength("b1", "mu")} AS a)),
        b2 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k, any_value(mean) AS mu FROM h JOIN r1 USING (suffix)
               GROUP BY domain, suffix),
        r2 AS (SELECT domain, (a * mu + k) / (a + n) AS mean FROM b2, (SELECT {_strength("b2", "mu")} AS a)),
        b3 AS (SELECT host, n, k, mean AS mu FROM h JOIN r2 USING (domain)),
        r3 AS (SELECT host, st * mu + k AS a, st * (1 - mu) + n - k AS b FROM b3, (SELECT {_strength("b3", "mu")} AS st))
        SELECT page_id, host, path, {_RULE_TEXT} AS rule,
               coalesce({_RULE_VERDICT}, CASE WHEN a / (a + b) + {host_reputation.DEVIATIONS}
                 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) >= {host_reputation.FLOOR} THEN 'allow' ELSE 'block' END)
               AS verdict
        FROM s JOIN r3 USING (host)
    """,
    "op5_warc": """
        WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                 sha1(coalesce(html, '')) AS payload_digest
          FROM pages
        ), t AS (
          SELECT payload_digest, payload_bytes, max(page_id) AS top FROM p WHERE payload_bytes >= 1000
          GROUP BY ALL
        )
        SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
               CASE WHEN p.page_id < t.top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN p.page_id < t.top THEN t.top END AS refers_to
        FROM p LEFT JOIN t USING (payload_digest, payload_bytes)
    """,
}
