"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tally.llm import context_mixing, conversation_trie, html_text, mixing, near_dedup, neighbours, packing, periodic_runs, privacy, quality, recipes, repeats, toxicity
from tally.llm.stage import documents, staged


def op1_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), width=3, percent=85)


def op2_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = staged(privacy.scan(documents(spark, sf_dir)), "pii")
    return privacy.digest(privacy.spans(scanned, privacy.train(scanned)))


def op3_boosted_dom_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_text.extract(pages, html_text.train(pages))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op5_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(documents(spark, sf_dir))


def op7_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return quality.judge(docs, carry=["doc_id"])


def op8_suffix_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(documents(spark, sf_dir), 400)


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"), carry=["doc_id"])


def op10_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op11_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.exact_duplicates(documents(spark, sf_dir))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.runs(documents(spark, sf_dir), layout=periodic_runs.planted))


QUERIES = {f.__name__: f for f in (op1_odd_sketch_near_dedup, op2_weak_supervision_pii, op3_boosted_dom_text, op4_nn_descent, op5_ftrl_toxicity, op6_context_mixing, op7_distribution_divergence,
                                     op8_suffix_run_dedup, op9_curriculum_mix, op10_minimum_bin_slack, op11_chunk_recipes, op12_conversation_trie, op13_periodic_runs)}
ORACLE: dict[str, str] = {
    "op11_chunk_recipes": """
WITH bare AS (SELECT doc_id, length(coalesce(text, '')) AS size,
                     regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
ranked AS (SELECT *, first(doc_id) OVER (PARTITION BY norm ORDER BY size DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY norm) AS group_size FROM bare)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM ranked""",
    "op12_conversation_trie": """
WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS seq
             FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
               xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                   lambda a, x: list_reduce(list_concat([xor(a, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                         lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END))) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (SELECT i.conv_id, 0 AS part, o.seq, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.base AND o.seq <= i.h
            UNION ALL SELECT i.conv_id, 1, o.seq, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.seq > i.h),
whole AS (SELECT i.conv_id, coalesce(list({'r': role, 't': text} ORDER BY part, seq) FILTER (WHERE seq IS NOT NULL), []) AS path
          FROM ids i LEFT JOIN rebuilt USING (conv_id) GROUP BY i.conv_id),
members AS (SELECT conv_id, len(path) AS length, unnest(range(0, len(path) + 1)) AS depth, path FROM whole),
nodes AS (SELECT path[1:depth] AS node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = length), '') AS ends
          FROM members GROUP BY node),
kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(node[depth].t) ELSE 0 END AS saved
               FROM nodes n LEFT JOIN kids k USING (node)),
above AS (SELECT node[1:d] AS node, count_if(n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, a.n_leaves::BIGINT AS n_leaves,
       a.saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN above a ON a.node = f.node
LEFT JOIN nodes p ON f.depth > 0 AND p.node = f.node[1:f.depth - 1]""",
}
