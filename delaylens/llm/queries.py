"""The registered queries of this package and, where SQL can express them, their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import byte_bpe, fill_in_middle, jaccard_join, line_dedup, mixing, nearest, periodic_runs, piece_sampling, quality_classifier, quality_rules, resharding, suffix_dedup, warc
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _on(table: str, digest):
    return lambda spark, folder: digest(read_table(spark, folder, table))


QUERIES["op1_piece_sampling"] = _on("documents", piece_sampling.digest)
QUERIES["op2_warc_zstd"] = _on("pages", warc.digest)
QUERIES["op3_mix_sources"] = _on("documents", mixing.digest)
QUERIES["op4_line_dedup"] = _on("documents", line_dedup.digest)
QUERIES["op5_quality_rules"] = _on("documents", quality_rules.digest)
QUERIES["op6_jaccard_join"] = _on("documents", jaccard_join.digest)
QUERIES["op7_suffix_dedup"] = _on("documents", suffix_dedup.digest)
QUERIES["op8_reshard"] = _on("documents", resharding.digest)
QUERIES["op9_nearest"] = _on("embeddings", nearest.digest)
QUERIES["op10_quality_classifier"] = lambda spark, folder: quality_classifier.digest(
    read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
QUERIES["op11_periodic_runs"] = _on("documents", periodic_runs.digest)
QUERIES["op12_fill_in_middle"] = _on("documents", fill_in_middle.digest)
QUERIES["op13_byte_bpe"] = _on("documents", byte_bpe.digest)
QUERIES["pipeline"] = corpus_pipeline.run
CHECKS["op5_quality_rules"] = quality_rules.check_sql()
CHECKS["op3_mix_sources"] = mixing.check_sql()
CHECKS["op2_warc_zstd"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h HAVING count(*) > 1)
SELECT page_id, strlen(p.h)::BIGINT AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h"""
CHECKS["op4_line_dedup"] = line_dedup.CHECK_SQL
CHECKS["op12_fill_in_middle"] = fill_in_middle.CHECK_SQL
