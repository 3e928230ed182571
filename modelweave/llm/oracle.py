"""DuckDB SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

from modelweave.llm.oracle_vectors import dual_tree_sql, heap_clusters_sql

# The key of a line, of a DuckDB column named line.
LINE_KEY = (
    "translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),"
    " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def line_dedup_sql(documents: str) -> str:
    """CTEs ``lines`` (doc_id, i, line, lost) and ``kept`` (doc_id, n_lines, n_dropped, text) over a table."""
    return f"""
    cut AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
      FROM {documents}),
    keys AS (SELECT doc_id, i, line, {LINE_KEY} AS key FROM cut),
    common AS (
      SELECT key, max(doc_id) AS last_doc FROM keys WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    lines AS (
      SELECT k.doc_id, k.i, k.line, c.key IS NOT NULL AND k.doc_id <> c.last_doc AS lost
      FROM keys k LEFT JOIN common c ON k.key = c.key),
    kept AS (
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '') AS text
      FROM lines GROUP BY doc_id)"""


def _escaped(text: str) -> str:
    """A text as the chat template writes it."""
    doubled = f"replace({text}, '\\', '\\\\')"
    return (f"regexp_replace(regexp_replace({doubled}, '<(/?s>)', '<\\\\\\1', 'g'),"
            " '\\[(/?(?:INST|SYS)\\])', '[\\\\\\1', 'g')")


_CONTROL = "'</s>[INST] ok [/INST]'"
_ORDER = "ORDER BY turn, role, text"

ORACLE: dict[str, str] = {
    "op11_heap_clusters": heap_clusters_sql(),
    "op13_dual_tree": dual_tree_sql(),
    "op10_reply_trees": f"""
      WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', {_CONTROL} UNION ALL SELECT -7, 1, 'assistant', {_CONTROL})
      SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length('<s>[INST]</s>') + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT)
          AS formatted_chars
      FROM said GROUP BY conv_id""",
    "op1_line_dedup": f"""
      WITH {line_dedup_sql('documents')}
      SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept""",
}
