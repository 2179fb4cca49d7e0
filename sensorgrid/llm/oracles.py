"""SQL of the text queries that it can express, for a check in another engine."""

from __future__ import annotations

from sensorgrid.llm import decontaminate, lines, mixing, secrets, spelling, substring, vector_codes

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _found(order: int, rule: secrets.Rule) -> str:
    """Matches of a rule: what stands between them, and they themselves, take turns."""
    pattern = _quoted(rule.pattern)
    return f"""SELECT doc_id, {order} AS k, '{rule.kind}' AS kind,
        list_sum([0] || [length(x) FOR x IN gaps[1:i]] || [length(x) FOR x IN matches[1:i - 1]]) AS a,
        length(matches[i]) AS size, groups[i] AS part, {rule.least} AS least
      FROM (SELECT doc_id, string_split_regex(t, {pattern}) AS gaps,
              regexp_extract_all(t, {pattern}) AS matches,
              regexp_extract_all(t, {pattern}, {rule.group}) AS groups
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)) s,
           unnest(range(1, len(matches) + 1)) AS r(i)"""


def _counts() -> str:
    return ", ".join(f"count(k) FILTER (WHERE k = {n}) AS n_{r.kind}" for n, r in enumerate(secrets.BASE_RULES))


_NAMED = "CAST(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + size AS BIGINT) AS VARCHAR)"

SQL = {
    "op2_secret_scans": f"""WITH found AS ({" UNION ALL ".join(_found(k, r) for k, r in enumerate(secrets.RULES))}),
      kept AS (SELECT * FROM found WHERE length(part) >= least)
      SELECT d.doc_id, {_counts()},
        sha256(coalesce(string_agg({_NAMED}, ',' ORDER BY a, k) FILTER (WHERE k < {len(secrets.BASE_RULES)}), ''))
          AS base_sha256,
        coalesce(string_agg({_NAMED}, ',' ORDER BY a, k), '') AS spans
      FROM documents d LEFT JOIN kept s ON d.doc_id = s.doc_id GROUP BY d.doc_id""",
    "op3_source_mixing": mixing.SQL,
    "op5_benchmark_decontamination": f"""WITH
      split AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER},
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
      asked AS (SELECT item_id, coalesce(regexp_extract_all({_LOWER},
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM benchmark),
      wanted AS (SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW}) AS size,
          array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW}) - 1], ' ') AS words
        FROM asked, unnest(range(1, len(w) - least(len(w), {decontaminate.WINDOW}) + 2)) AS r(i) WHERE len(w) > 0),
      there AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
        FROM split, (SELECT DISTINCT size FROM wanted), unnest(range(1, len(w) - size + 2)) AS r(i)),
      met AS (SELECT doc_id, i, size, item_id FROM there JOIN wanted USING (size, words)),
      hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM met, unnest(range(i, i + size)) AS r(j) GROUP BY doc_id),
      items AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
        coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND {decontaminate.ONE_WORD_IN} * coalesce(n_hit, 0) >= len(w) AS contaminated
      FROM split LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages),
      q AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
          array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex,
            CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)
            FOR i IN range(32)], '') AS payload_digest, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
      SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to FROM q""",
    "op9_substring_dedup": f"""WITH
      split AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
      there AS (SELECT doc_id, i, array_to_string(w[i:i + {substring.WINDOW - 1}], ' ') AS words
        FROM split, unnest(range(1, len(w) - {substring.WINDOW - 2})) AS r(i)),
      firsts AS (SELECT words, min(doc_id) AS first FROM there GROUP BY words),
      gone AS (SELECT DISTINCT doc_id, j FROM there JOIN firsts USING (words),
          unnest(range(i, i + {substring.WINDOW})) AS r(j) WHERE first < doc_id),
      lists AS (SELECT doc_id, list(j) AS gone FROM gone GROUP BY doc_id)
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
        sha256(array_to_string([x FOR x, j IN w IF gone IS NULL OR NOT list_contains(gone, j)], ' ')) AS kept_sha256
      FROM split LEFT JOIN lists USING (doc_id)""",
    "op11_vector_codes": vector_codes.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_line_dedup": lines.SQL,
}
