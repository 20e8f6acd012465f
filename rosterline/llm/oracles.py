"""DuckDB SQL of corpus queries that SQL can express over whole tables."""

from __future__ import annotations

#: Base patterns as they stand in the contract. The learned spans are not in it: on the given tables nothing is learned.
_KINDS = {
    "email": (1, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": (2, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": (3, r"[0-9]([\x20-]?[0-9])+"),
    "phone": (4, r"\+[0-9][\x20().0-9-]+[0-9]"),
}

_FOUND = " UNION ALL ".join(
    f"SELECT r, {rank} AS rank, '{kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS v, unnest(list_transform(p[1:len(m)], lambda x: length(x))) AS gap"
    f" FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS p FROM docs)"
    for kind, (rank, pattern) in _KINDS.items()
)

OP7_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_FOUND}),
placed AS (SELECT *, CAST(sum(gap + length(v)) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS e, regexp_replace(v, '[^0-9]', '', 'g') AS digits FROM found),
good AS (
  SELECT r, rank, kind, e - length(v) AS s, e FROM placed
  WHERE CASE kind WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255'))) = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    ELSE length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''), lambda x, i:
      CASE WHEN i % 2 = 0 THEN 2 * CAST(x AS INTEGER) - CASE WHEN CAST(x AS INTEGER) > 4 THEN 9 ELSE 0 END ELSE CAST(x AS INTEGER) END)) % 10 = 0 END),
joined AS (
  SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY rank, s) AS spans, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone FROM good GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone, 0 AS n_learned,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""

#: The checksum goes bit by bit; the heaviest slot goes to the lightest shard, one a round.
OP8_SQL = """
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
bits AS (
  SELECT r, list_concat([4294967295], list_transform(string_split(bin_text, ''), lambda x: CAST(x AS BIGINT))) AS b FROM (
    SELECT r, string_agg(reverse(octet), '' ORDER BY i) AS bin_text FROM (
      SELECT r, i, lpad(bin(CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT)), 8, '0') AS octet
      FROM (SELECT r, h, unnest(range(1, length(h) // 2 + 1)) AS i FROM (SELECT r, hex(encode(text)) AS h FROM docs))) GROUP BY r)),
summed AS (SELECT r, xor(list_reduce(b, lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) AS crc FROM bits),
records AS (
  SELECT d.r, doc_id, octet_length(encode(text)) + 16 AS size, coalesce(crc, 0) AS crc, row_number() OVER (PARTITION BY doc_id, text) AS copy FROM docs d LEFT JOIN summed USING (r)),
slotted AS (SELECT *, CAST('0x' || substr(md5(concat_ws(':', doc_id, crc, copy)), 1, 8) AS BIGINT) % 8192 AS v FROM records),
loads AS (SELECT v, sum(size) AS bytes, count(*) AS n, row_number() OVER (ORDER BY sum(size) DESC, v) AS turn FROM slotted GROUP BY v),
dealt(turn, v, shard, held, slots) AS (
  SELECT 0, CAST(-1 AS BIGINT), 0, list_transform(range(0, 40), lambda x: CAST(0 AS HUGEINT)), list_transform(range(0, 40), lambda x: 0)
  UNION ALL
  SELECT turn, v, k, list_transform(held, lambda x, i: CASE WHEN i = k + 1 THEN x + bytes ELSE x END), list_transform(slots, lambda x, i: CASE WHEN i = k + 1 THEN x + 1 ELSE x END) FROM (
    SELECT l.turn, l.v, l.bytes, held, slots,
           list_reduce(range(0, 40), lambda a, b: CASE WHEN (held[a + 1], slots[a + 1], a) <= (held[b + 1], slots[b + 1], b) THEN a ELSE b END) AS k
    FROM dealt d JOIN loads l ON l.turn = d.turn + 1)),
map AS (SELECT v, shard, coalesce(sum(n) OVER (PARTITION BY shard ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM dealt JOIN loads USING (v))
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard, before + row_number() OVER (PARTITION BY v ORDER BY doc_id, crc, size, copy) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, v AS virtual_slot, 1 AS map_version
FROM slotted JOIN map USING (v)
"""

OP10_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
starts AS (SELECT r, s, md5(b[s + 1:s + 400]) AS h FROM (SELECT r, b, unnest(range(0, octet_length(b) - 399)) AS s FROM docs)),
twice AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
hits AS (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 400 THEN 0 ELSE 1 END AS fresh FROM starts SEMI JOIN twice USING (h)),
spans AS (SELECT r, min(s) AS a, max(s) + 400 AS e FROM (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS g FROM hits) GROUP BY r, g),
gone AS (SELECT r, sum(e - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r),
pieces AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS e FROM spans
  UNION ALL SELECT r, coalesce(max(e), 0), octet_length(any_value(b)) FROM docs LEFT JOIN spans USING (r) GROUP BY r),
kept AS (SELECT r, sha256(unhex(string_agg(CASE WHEN p.e > p.a THEN hex(b[p.a + 1:p.e]) ELSE '' END, '' ORDER BY p.a))) AS kept_sha256 FROM pieces p JOIN docs USING (r) GROUP BY r),
words AS (SELECT r, s, md5(array_to_string(w[s + 1:s + 50], ' ')) AS h FROM (SELECT r, w, unnest(range(0, len(w) - 49)) AS s FROM docs)),
again AS (SELECT h FROM words GROUP BY h HAVING count(*) > 1),
word_hits AS (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 50 THEN 0 ELSE 1 END AS fresh FROM words SEMI JOIN again USING (h)),
word_spans AS (SELECT r, max(s) + 50 - min(s) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS g FROM word_hits) GROUP BY r, g),
repeated AS (SELECT r, sum(n) AS n_repeated_words FROM word_spans GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256,
       CAST(coalesce(n_repeated_words, 0) AS BIGINT) AS n_repeated_words
FROM docs LEFT JOIN gone USING (r) LEFT JOIN kept USING (r) LEFT JOIN repeated USING (r)
"""
