"""DuckDB SQL of the registered queries that SQL can express."""

ORACLE: dict[str, str] = {}

# The lengths of the template: "### " role "</role>" per block, text "</turn>" per turn, "\n" per block.
ORACLE["op3_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), esc AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/') AS etext,
         replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/') AS erole FROM rows
), marked AS (
  SELECT *, CASE WHEN lag(role) OVER w IS DISTINCT FROM role THEN 1 ELSE 0 END AS opens
  FROM esc WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, erole, etext)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, erole, etext)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, erole, etext)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(etext) + 7 + opens * (4 + length(erole) + 7 + 1))::BIGINT AS formatted_chars,
       sum(opens)::BIGINT AS n_blocks
FROM marked GROUP BY conv_id
"""

# Units are cut by the pattern itself; sha256() of DuckDB gives lower-case hex.
ORACLE["op11_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS unit
  FROM documents
), planned AS (
  SELECT *, len(unit)::BIGINT AS n,
         ('0x' || h[1:8])::BIGINT % (len(unit) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(unit) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut
), parts AS (
  SELECT doc_id, n, form, text, array_to_string(unit[1:least(c1, c2)], '') AS prefix,
         array_to_string(unit[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
         array_to_string(unit[greatest(c1, c2) + 1:], '') AS suffix FROM planned
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
