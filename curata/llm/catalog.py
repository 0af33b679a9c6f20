"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from curata.llm import ann, hnsw, maxent, minhash, mixing, packing, suffixes, toxicity, urls, warc
from curata.llm.common import table

QUERIES = {
    "op1_embedding_dedup": lambda spark, sf_dir: hnsw.near_duplicate_vectors(table(spark, sf_dir, "embeddings")),
    "op2_pack_documents": lambda spark, sf_dir: packing.pack(table(spark, sf_dir, "documents"), with_ids=False),
    "op3_maxent_scores": lambda spark, sf_dir: maxent.score_documents(table(spark, sf_dir, "documents")),
    "op4_mix_sources": lambda spark, sf_dir: mixing.mixture_digest(table(spark, sf_dir, "documents")),
    "op5_suffix_dedup": lambda spark, sf_dir: suffixes.repeats_digest(table(spark, sf_dir, "documents")),
    "op6_near_duplicates": lambda spark, sf_dir: minhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=2),
    "op7_filter_urls": lambda spark, sf_dir: urls.filter_urls(table(spark, sf_dir, "pages")),
    "op8_toxicity": lambda spark, sf_dir: toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op9_nearest_neighbours": lambda spark, sf_dir: ann.search(table(spark, sf_dir, "embeddings")),
    "op10_warc_revisits": lambda spark, sf_dir: warc.revisit_digest(table(spark, sf_dir, "pages")),
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {"op4_mix_sources": mixing.MIX_SQL, "op10_warc_revisits": warc.WARC_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
