"""What the operators return, in SQL that DuckDB runs over the same tables."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS window_text
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS window_text
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, size, i, item_id FROM dw JOIN bw USING (size, window_text)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

MIXING_SQL = """
WITH sizes AS (
  SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN size <= 0 THEN 1.0
    ELSE pow(size, 0.5) / sum(pow(size, 0.5)) FILTER (size > 0) OVER () * sum(size) OVER () / size END AS rate
  FROM sizes),
terms AS (
  SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1.0)) AS p
  FROM (SELECT *, unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k FROM rates)),
sums AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
drawn AS (
  SELECT *, CAST(CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
            / pow(16, 13) AS u FROM documents),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.u, count(s.k) AS n
  FROM drawn d LEFT JOIN sums s ON s.source IS NOT DISTINCT FROM d.source AND s.c <= d.u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       md5('17:order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted)
"""

NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 1], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION SELECT r.doc_id, l.y FROM reach r JOIN both_ways l ON l.x = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex),
bits AS (
  SELECT p.page_id, octet_length(encode(html)) AS payload_bytes, first,
         [CAST('0x' || substr(p.hex, 5 * k + 1, 5) AS BIGINT) FOR k IN range(8)] AS parts
  FROM p JOIN f ON f.hex = p.hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               ((parts[CAST(floor(j / 4) AS BIGINT) + 1] >> (15 - 5 * (j % 4))) & 31) + 1, 1) FOR j IN range(32)], '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""


def _canonical(text: str) -> str:
    from tablewright.llm.licenses import COPYRIGHT_LINE, EQUIVALENT, NOT_WORD

    out = f"trim(regexp_replace(regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g'), '{NOT_WORD}', ' ', 'g'))"
    for a, b in EQUIVALENT:
        out = f"replace({out}, '{a}', '{b}')"
    return out


def license_sql(known) -> str:
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in known)
    return f"""
WITH known AS (
  SELECT {_canonical("t")} AS body, min(license_id) AS license_id FROM (VALUES {values}) AS v(license_id, t) GROUP BY ALL),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, license_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  JOIN known ON {_canonical("line")} = body),
of_doc AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids FROM lines GROUP BY doc_id)
SELECT d.doc_id, k.license_id, coalesce(n, 0) AS n_license_lines, coalesce(ids, '') AS line_licenses
FROM d LEFT JOIN known k ON {_canonical("text")} = k.body LEFT JOIN of_doc o ON o.doc_id = d.doc_id
"""

SUBSTRINGS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS h
  FROM (SELECT *, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN twice USING (h)),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n
  FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

FILL_IN_MIDDLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS r3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS r4 FROM d),
cut AS (
  SELECT *, substr(text, 1, least(c1, c2)) AS p, substr(text, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS m,
         substr(text, greatest(c1, c2) + 1) AS s,
         CASE WHEN n = 0 OR r3 >= 90 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

_PART = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_LEAF.format("text")} AS leaf, {_LEAF.format(LOWER.format("text"))} AS altered,
         list_reduce(
           list_prepend(CAST(4294967295 AS UBIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda c: [CAST(ord(c) + 512 AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, x: CASE WHEN x > 0 THEN xor(c, x - 512) WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END
         ) AS crc
  FROM documents),
placed AS (
  SELECT *, CASE WHEN xor(crc, CAST(4294967295 AS UBIGINT)) % 5 = 0 THEN altered ELSE leaf END AS seen,
         row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i FROM d),
tree AS (
  SELECT coalesce('+' || source, '') AS t, 0 AS level, CAST(i AS BIGINT) AS i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT t, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16
  FROM tree WHERE n > 1 GROUP BY t, level, i // 16),
top AS (
  SELECT 0 AS level, CAST(row_number() OVER (ORDER BY encode(t)) - 1 AS BIGINT) AS i, h, count(*) OVER () AS n
  FROM tree WHERE n = 1
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16
  FROM top WHERE n > 1 GROUP BY level, i // 16),
subroots AS (SELECT t, h AS subroot, level AS height, row_number() OVER (ORDER BY encode(t)) - 1 AS place FROM tree WHERE n = 1),
levels AS (
  SELECT t, level, i, h FROM tree WHERE n > 1
  UNION ALL SELECT s.t, s.height + top.level, top.i, top.h FROM subroots s, top WHERE top.n > 1),
runs AS (SELECT t, level, i // 16 AS run, list(h ORDER BY i) AS hs FROM levels GROUP BY ALL),
spots AS (
  SELECT p.doc_id, p.leaf, p.seen, p.i AS start, s.t, s.subroot, s.height, s.place, p.source
  FROM placed p JOIN subroots s ON s.t = coalesce('+' || p.source, '')),
steps AS (
  SELECT a.t, a.start, r.level, r.hs,
         CASE WHEN r.level < a.height THEN a.start // CAST(pow(16, r.level) AS BIGINT)
              ELSE a.place // CAST(pow(16, r.level - a.height) AS BIGINT) END AS own
  FROM spots a JOIN runs r ON r.t = a.t AND r.run =
         CASE WHEN r.level < a.height THEN a.start // CAST(pow(16, r.level + 1) AS BIGINT)
              ELSE a.place // CAST(pow(16, r.level - a.height + 1) AS BIGINT) END),
sides AS (
  SELECT t, start, level, array_to_string(hs[1 : own % 16], '') AS l, array_to_string(hs[own % 16 + 2 :], '') AS r FROM steps),
proofs AS (SELECT t, start, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM sides GROUP BY ALL),
folds AS (
  SELECT a.t, a.start, 0 AS level, a.seen AS h, coalesce(p.ls, []) AS ls, coalesce(p.rs, []) AS rs
  FROM spots a LEFT JOIN proofs p ON p.t = a.t AND p.start = a.start
  UNION ALL
  SELECT t, start, level + 1, sha256(ls[level + 1] || h || rs[level + 1]), ls, rs FROM folds WHERE level < len(ls))
SELECT a.doc_id, a.leaf, a.subroot, (SELECT h FROM top WHERE n = 1) AS root,
       sha256(array_to_string(list_transform(range(1, len(f.ls) + 1), lambda k: f.ls[k] || f.rs[k]), '')) AS proof_sha256,
       f.h AS folded_root, f.h = (SELECT h FROM top WHERE n = 1) AS verified
FROM spots a JOIN folds f ON f.t = a.t AND f.start = a.start AND f.level = len(f.ls)
"""
