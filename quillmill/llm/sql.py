"""SQL (DuckDB) for the operators that SQL can express, over the same whole tables."""

from __future__ import annotations

from quillmill.llm.divergence import COMMON_WORDS

#: Payload digests, the first record of each payload, and what refers to it. Base32 takes five bits a sign.
OP9_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::bigint AS payload_bytes, sha256(body) AS address, sha1(body) AS hex FROM p),
b AS (SELECT *, list_reduce(list_prepend('', list_transform(range(40), lambda i: lpad(bin(strpos('0123456789abcdef', hex[i + 1]) - 1), 4, '0'))), lambda x, y: x || y) AS bits FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY address) AS first_id FROM b)
SELECT page_id, payload_bytes,
  list_reduce(list_prepend('', list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_reduce(list_prepend(0, list_transform(range(5), lambda k: bits[i * 5 + k + 1]::int * (16 >> k::int))), lambda x, y: x + y), 1))), lambda x, y: x || y) AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f"""

#: A turn's piece has 7 signs about an assistant's escaped text (<s>, </s>) and 16 and the role about another's
#: ("[INST] ", a line feed, " [/INST]"); each control string in a text is one sign longer. An example runs from the
#: first turn to its target; turns after the last target are one example more.
OP5_CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
s AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?INST\]')) + CASE WHEN role = 'assistant' THEN 7 ELSE 16 + length(role) END AS size FROM t),
r AS (SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS ordinal, count(*) OVER (PARTITION BY conv_id) AS n FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ordinal)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY ordinal) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR ordinal = n)::bigint AS formatted_chars
FROM r GROUP BY conv_id"""

_LISTED = " ".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in COMMON_WORDS.items())


def _distance(counts: str, reference: str) -> str:
    """The Jensen-Shannon distance of two lists of counts."""
    terms = f"list_transform(list_zip(list_transform({counts}, lambda x: x / list_sum({counts})), list_transform({reference}, lambda x: x / list_sum({reference}))), lambda z: CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END)"
    return f"CASE WHEN list_sum({counts}) > 0 AND list_sum({reference}) > 0 THEN sqrt(greatest(0, list_sum({terms}) / 2)) END"


#: Repeated words: each word in an 8-word window that stands twice, by windows as lists of words.
OP10_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT row, i, array_to_string(words[i:i + 7], ' ') AS gram FROM w, unnest(range(1, len(words) - 6)) AS u(i)),
a AS (SELECT row, i FROM g QUALIFY count(*) OVER (PARTITION BY row, gram) > 1),
r AS (SELECT row, sum(least(8, coalesce(nxt - i, 8)))::bigint AS n FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS nxt FROM a) GROUP BY row),
m AS (SELECT row, doc_id, lang, words, len(words)::bigint AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint AS n_symbols, (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
  coalesce(r.n, 0)::bigint AS n_repeat_words, len(regexp_extract_all(t, '\p{{Lu}}')) AS c1, len(regexp_extract_all(t, '[0-9]')) AS c2, len(regexp_extract_all(t, '[.,;:!?''"()-]')) AS c3, CASE lang {_LISTED} END AS listed FROM w LEFT JOIN r USING (row)),
h AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, [c1, c2, c3, n_symbols, greatest(0, word_chars - c1 - c2 - c3 - n_symbols)] AS chars, list_transform(listed, lambda x: len(list_filter(words, lambda y: y = x))) AS common FROM m),
k AS (SELECT * EXCLUDE (words), list_append(common, n_words - list_sum(common)) AS counts FROM h),
f AS (SELECT lang, [{', '.join(f'sum(chars[{i}])' for i in range(1, 6))}] AS char_reference, [{', '.join(f'sum(counts[{i}])' for i in range(1, 14))}] AS word_reference FROM k WHERE NOT base_failed GROUP BY lang),
j AS (SELECT k.*, CASE WHEN word_chars >= 300 THEN {_distance('chars', 'char_reference')} END AS cd, CASE WHEN n_words >= 100 AND listed IS NOT NULL THEN {_distance('counts', 'word_reference')} END AS wd FROM k LEFT JOIN f USING (lang))
SELECT doc_id, n_words, word_chars::bigint AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(cd <= 0.27, true) AND coalesce(wd <= 0.28, true) AS kept FROM j"""


def _assigned(book: str) -> str:
    """The nearest entry of each part: distance and index in one number, so that equal distances go to the lower index."""
    far = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"SELECT row, part, x, m % 64 AS i, m // 64 AS far FROM (SELECT row, part, any_value(x) AS x, min({far} * 64 + i) AS m FROM p JOIN {book} USING (part) GROUP BY row, part)"


def _refined(book: str, assigned: str) -> str:
    """The entries of a codebook, each replaced by the floors of its parts' means."""
    means = f"SELECT part, i, list(floor(s / n)::bigint ORDER BY pos) AS mean FROM (SELECT part, i, pos, sum(x[pos]) AS s, count(*) AS n FROM {assigned}, unnest(range(1, len(x) + 1)) AS u(pos) GROUP BY part, i, pos) GROUP BY part, i"
    return f"SELECT part, i, coalesce(mean, c) AS c FROM {book} LEFT JOIN ({means}) USING (part, i)"


OP12_VECTORS = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT row, part, e[part * (len(e) // 16) + 1:(part + 1) * (len(e) // 16)] AS x FROM v, unnest(range(16)) AS u(part)),
k0 AS (SELECT part, row - 1 AS i, x AS c FROM p WHERE row <= 64),
a0 AS MATERIALIZED ({_assigned("k0")}), k1 AS MATERIALIZED ({_refined("k0", "a0")}),
a1 AS MATERIALIZED ({_assigned("k1")}), k2 AS MATERIALIZED ({_refined("k1", "a1")}),
a2 AS MATERIALIZED ({_assigned("k2")}),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, i)) AS codebooks_sha256 FROM k2),
f AS (SELECT row, string_agg(lpad(lower(hex(i::bigint)), 2, '0'), '' ORDER BY part) AS code, sum(far)::bigint AS error FROM a2 GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error, codebooks_sha256 FROM f JOIN v USING (row), s"""
