"""All queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

from reelframe.llm import queries_documents, queries_media, queries_tags

_MODULES = [queries_media, queries_tags, queries_documents]
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
