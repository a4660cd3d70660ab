"""Queries over documents: p7 to p9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelframe.llm.leakage import decontaminate, leaked_items
from reelframe.llm.packing import pack, token_counts
from reelframe.llm.splitting import split_documents
from reelframe.session import read

#: Letters of the shortest run that counts as a leak.
LEAST_RUN = 32
#: Attention cost of a container, as a share of that of one full piece, in p7_attention.
ATTENTION = 0.5


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", "text")


def _limits(spark: SparkSession, d: str, purpose: str) -> list[tuple]:
    rows = read(spark, d, "size_limit").where(f"purpose = '{purpose}'").collect()  # a list of settings
    return [(r["limit_id"], r["max_tokens"], r["overlap_tokens"]) for r in rows]


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """limit_id, container_id, id, piece, token_start, n_tokens for every size limit of purpose pack."""
    return pack(token_counts(_documents(spark, d)), [x[:2] for x in _limits(spark, d, "pack")])


def p7_attention(spark: SparkSession, d: str) -> DataFrame:
    """As p7_containers, with a bound on the attention cost that large pieces come up against."""
    return pack(token_counts(_documents(spark, d)), [x[:2] for x in _limits(spark, d, "pack")], attention=ATTENTION)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(_documents(spark, d), read(spark, d, "eval_item"), LEAST_RUN).select("doc_id", "item_id").distinct()


def p8_removed(spark: SparkSession, d: str) -> DataFrame:
    """The documents with leaked passages, what is removed of them and what is left."""
    return decontaminate(_documents(spark, d), read(spark, d, "eval_item"), LEAST_RUN)


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of the documents that exceed a size limit of purpose cut."""
    return split_documents(_documents(spark, d), _limits(spark, d, "cut"))


QUERIES = {"p7_containers": p7_containers, "p7_attention": p7_attention, "p8_found": p8_found, "p8_removed": p8_removed, "p9_pieces": p9_pieces}
# Every run of 32 letters of every text, in blocks (a substring is counted from the start of its text). DuckDB composes characters but knows no compatibility forms, which these tables' letters have none of.
_RUNS = r"""SELECT {0}, substr(b, i, 32) AS g FROM (SELECT {0}, substr(t, k, 231) AS b FROM (SELECT {0}, regexp_replace(lower(nfc_normalize(text)), '[^\p{{L}}]', '', 'g') AS t FROM {1} WHERE text IS NOT NULL) x, LATERAL (SELECT unnest(range(1, length(t) + 1, 200)) AS k)) y,
        LATERAL (SELECT unnest(range(1, least(length(b) - 31, 200) + 1)) AS i)"""
SQL: dict[str, str] = {"p8_found": f"WITH d AS ({_RUNS.format('doc_id', 'documents')}), e AS (SELECT DISTINCT * FROM ({_RUNS.format('item_id', 'eval_item')})) SELECT DISTINCT doc_id, item_id FROM d JOIN e USING (g)"}
