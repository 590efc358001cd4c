"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others (images, tokens, alignments, random rounding, checksums) are held
against brute-force versions in the tests.
"""

from __future__ import annotations

from finloom.llm import decontamination, importance, jaccard_join, line_dedup, merkle, quality_rules, substring_dedup, warc

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
g AS (SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + {jaccard_join.NGRAM - 1}], ' ')) AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - {jaccard_join.NGRAM - 2}))) AS i FROM w WHERE len(words) > 0)),
s AS (SELECT doc_id, md5(string_agg(gram, ',' ORDER BY gram)) AS key, count(*) AS size FROM g GROUP BY 1),
c AS (SELECT key, min(doc_id) AS rep, any_value(size) AS size, count(*) AS n_copies FROM s GROUP BY 1),
h AS (SELECT key, gram, size FROM c JOIN g ON g.doc_id = c.rep),
p AS (SELECT a.key AS a, b.key AS b FROM h a JOIN h b ON a.gram = b.gram AND a.key <> b.key
  GROUP BY a.key, b.key HAVING count(*) >= {jaccard_join.THRESHOLD} * (any_value(a.size) + any_value(b.size) - count(*)) - 1e-9),
r AS (SELECT key AS root, key FROM c UNION SELECT r.root, p.b FROM r JOIN p ON r.key = p.a),
m AS (SELECT r.root AS key, min(c.rep) AS class_id FROM r JOIN c ON c.key = r.key GROUP BY 1),
l AS (SELECT p.a AS key, sum(c.n_copies) AS linked FROM p JOIN c ON c.key = p.b GROUP BY 1)
SELECT d.doc_id, coalesce(m.class_id, d.doc_id) AS class_id, CAST(coalesce(c.n_copies, 1) AS BIGINT) AS n_copies,
  CAST(coalesce(c.n_copies - 1, 0) + coalesce(l.linked, 0) AS BIGINT) AS n_links, coalesce(m.class_id, d.doc_id) = d.doc_id AS keeper
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN c ON c.key = s.key LEFT JOIN m ON m.key = s.key LEFT JOIN l ON l.key = s.key"""

_SUBSTRING = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(words[i:i + {substring_dedup.WINDOW - 1}], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {substring_dedup.WINDOW - 2})) AS i FROM w)),
r AS (SELECT k FROM g GROUP BY 1 HAVING count(*) > 1),
s AS (SELECT doc_id, i AS pos, true AS start FROM g WHERE k IN (SELECT k FROM r)),
u AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
c AS (SELECT u.doc_id, word, pos, bool_or(coalesce(start, false)) OVER (PARTITION BY u.doc_id ORDER BY pos
  ROWS BETWEEN {substring_dedup.WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM u LEFT JOIN s USING (doc_id, pos)),
a AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM c GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN a USING (doc_id)"""

_WARC = f"""
WITH d AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= {warc.MIN_REVISIT_BYTES} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM d LEFT JOIN f USING (payload_digest)"""

_LINES = f"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(lines[i:i + {line_dedup.WINDOW - 1}], chr(10))) AS k
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - {line_dedup.WINDOW - 2})) AS i FROM l)),
s AS (SELECT doc_id, i AS pos, true AS start FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM g) WHERE place > 1),
u AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM l),
c AS (SELECT u.doc_id, line, pos, bool_or(coalesce(start, false)) OVER (PARTITION BY u.doc_id ORDER BY pos
  ROWS BETWEEN {line_dedup.WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM u LEFT JOIN s USING (doc_id, pos))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM c GROUP BY 1"""

_QUALITY = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
s AS (SELECT doc_id, i AS pos, count(*) OVER (PARTITION BY doc_id, k) > 1 AS twice FROM g),
u AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
v AS (SELECT u.doc_id, word, bool_or(coalesce(twice, false)) OVER (PARTITION BY u.doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS again
  FROM u LEFT JOIN s USING (doc_id, pos)),
a AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars, count(*) FILTER (again) AS n_repeat_words FROM v GROUP BY 1),
l AS (SELECT doc_id, source, text, line, pos, {_WORDS.replace("coalesce(text, '')", 'line')} AS parts
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM w)),
k AS (SELECT *, lower(array_to_string(parts, ' ')) AS norm FROM l WHERE len(parts) > 0),
n AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM k GROUP BY 1),
f AS (SELECT source, norm, count(DISTINCT text) AS docs FROM k GROUP BY 1, 2),
t AS (SELECT source, count(DISTINCT text) AS docs FROM w GROUP BY 1),
b AS (SELECT f.source, f.norm FROM f JOIN t ON f.source IS NOT DISTINCT FROM t.source
  WHERE f.docs > {quality_rules.LINE_DOCS} AND f.docs > {quality_rules.LINE_SHARE} * t.docs),
y AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS left_text FROM l LEFT JOIN b
  ON l.source IS NOT DISTINCT FROM b.source AND lower(array_to_string(l.parts, ' ')) = b.norm WHERE b.norm IS NULL GROUP BY 1),
x AS (SELECT doc_id, CAST(sum(len(parts)) AS BIGINT) AS gone FROM k SEMI JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.norm = b.norm GROUP BY 1),
q AS (SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0) AS n_boilerplate_words,
    sha256(coalesce(left_text, '')) AS kept_sha256
  FROM w LEFT JOIN y ON y.doc_id = w.doc_id LEFT JOIN a ON a.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN x ON x.doc_id = w.doc_id),
z AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PCT} * n_words AS base_failed FROM q)
SELECT *, NOT base_failed AND n_words - n_boilerplate_words >= {quality_rules.MIN_LEFT_SHARE} * n_words AS kept FROM z"""


def _leaf(text: str) -> str:
    values = (text if f == "text" else f for f in merkle.FIELDS)
    return "sha256(concat(" + ", ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values) + "))"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC_TABLE = """(SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))"""


def _crc(values: str) -> str:
    """s and crc for the strings s of a select, byte by byte in a recursive table c."""
    return f"""b AS (SELECT s, hex(encode(s)) AS h FROM ({values})),
c AS (SELECT s, h, 0 AS k, CAST(4294967295 AS BIGINT) AS reg FROM b
  UNION ALL SELECT s, h, k + 1, xor(reg >> 8, v) FROM c JOIN {_CRC_TABLE} t
  ON t.i = xor(reg & 255, CAST('0x' || substr(h, 2 * k + 1, 2) AS INT)) WHERE 2 * k < length(h)),
crc AS (SELECT s, xor(reg, 4294967295) AS crc FROM c WHERE 2 * k = length(h))"""


_MERKLE = f"""
WITH RECURSIVE {_crc("SELECT CAST(doc_id AS VARCHAR) AS s FROM documents")},
l AS (SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(_LOWER)} AS changed,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM documents),
t AS (SELECT 0 AS level, lang, pos, n, leaf AS h FROM l
  UNION ALL SELECT any_value(level) + 1, lang, pos // {merkle.FAN}, (n + {merkle.FAN - 1}) // {merkle.FAN}, sha256(string_agg(h, '' ORDER BY pos))
  FROM t WHERE n > 1 GROUP BY lang, n, pos // {merkle.FAN}),
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, pos, n, subroot AS h FROM s
  UNION ALL SELECT any_value(level) + 1, pos // {merkle.FAN}, (n + {merkle.FAN - 1}) // {merkle.FAN}, sha256(string_agg(h, '' ORDER BY pos))
  FROM u WHERE n > 1 GROUP BY n, pos // {merkle.FAN}),
tr AS (SELECT level, lang, pos // {merkle.FAN} AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL),
ur AS (SELECT level, pos // {merkle.FAN} AS run, list(h ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL),
p AS (SELECT doc_id, lang, leaf, 0 AS level, pos, CASE WHEN crc % 3 = 0 THEN changed ELSE leaf END AS fold, '' AS proof
    FROM l LEFT JOIN crc ON s = CAST(doc_id AS VARCHAR)
  UNION ALL SELECT doc_id, p.lang, leaf, p.level + 1, pos // {merkle.FAN},
    sha256(array_to_string(hs[:pos % {merkle.FAN}], '') || fold || array_to_string(hs[pos % {merkle.FAN} + 2:], '')),
    proof || array_to_string(hs[:pos % {merkle.FAN}], '') || array_to_string(hs[pos % {merkle.FAN} + 2:], '')
    FROM p JOIN tr ON tr.level = p.level AND tr.lang IS NOT DISTINCT FROM p.lang AND tr.run = pos // {merkle.FAN}),
q AS (SELECT p.doc_id, leaf, subroot, 0 AS level, s.pos, fold, proof FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang
    WHERE p.level = (SELECT max(level) FROM t WHERE t.lang IS NOT DISTINCT FROM p.lang)
  UNION ALL SELECT doc_id, leaf, subroot, q.level + 1, pos // {merkle.FAN},
    sha256(array_to_string(hs[:pos % {merkle.FAN}], '') || fold || array_to_string(hs[pos % {merkle.FAN} + 2:], '')),
    proof || array_to_string(hs[:pos % {merkle.FAN}], '') || array_to_string(hs[pos % {merkle.FAN} + 2:], '')
    FROM q JOIN ur ON ur.level = q.level AND ur.run = pos // {merkle.FAN})
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified
FROM q, (SELECT h FROM u WHERE n = 1) WHERE level = (SELECT max(level) FROM u)"""

_FOLDED_WORDS = rf"list_filter(regexp_split_to_array({_LOWER.replace('text', "coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_CONTAMINATION = f"""
WITH w AS (SELECT doc_id, {_FOLDED_WORDS} AS words FROM documents),
i AS (SELECT item_id, {_FOLDED_WORDS} AS words FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(words), {decontamination.WINDOW}) AS n, array_to_string(words[j:j + {decontamination.WINDOW - 1}], ' ') AS k
  FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - {decontamination.WINDOW - 2}))) AS j FROM i WHERE len(words) > 0)),
v AS (SELECT DISTINCT n, k FROM g),
o AS (SELECT doc_id, j, n, array_to_string(words[j:j + n - 1], ' ') AS k
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS j FROM w, (SELECT DISTINCT n FROM v))),
f AS (SELECT o.* FROM o JOIN v ON v.n = o.n AND v.k = o.k),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + n)) AS place FROM f) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM f JOIN g ON g.n = f.n AND g.k = f.k) GROUP BY 1)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h ON h.doc_id = w.doc_id LEFT JOIN m ON m.doc_id = w.doc_id"""

_B = importance.BUCKETS
_IMPORTANCE = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_FOLDED_WORDS} AS words FROM documents),
i AS (SELECT {_FOLDED_WORDS} AS words FROM benchmark),
df AS (SELECT doc_id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda j: words[j] || ' ' || words[j + 1]))) AS s FROM d),
bf AS (SELECT unnest(list_concat(words, list_transform(range(1, len(words)), lambda j: words[j] || ' ' || words[j + 1]))) AS s FROM i),
{_crc("SELECT s FROM df UNION SELECT s FROM bf")},
k AS (SELECT s, crc % {_B} AS bucket FROM crc),
e AS (SELECT doc_id, bucket FROM df JOIN k USING (s)),
sc AS (SELECT bucket, count(*) AS s FROM e GROUP BY 1),
tc AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (s) GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM df) AS sa, (SELECT count(*) FROM bf) AS ta),
x AS (SELECT r.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sa + {_B})::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (ta + {_B})::DOUBLE))) AS BIGINT) AS gain
  FROM n, range({_B}) r(bucket) LEFT JOIN sc ON sc.bucket = r.bucket LEFT JOIN tc ON tc.bucket = r.bucket),
w AS (SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM e JOIN x USING (bucket) GROUP BY 1),
z AS (SELECT d.doc_id, len(words) >= {importance.MIN_WORDS} AS may, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
  (CAST('0x' || sha256('{importance.SEED}:' || coalesce(d.doc_id::VARCHAR, ''))[:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w ON w.doc_id = d.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY may) AS all_rows FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= {importance.DRAWN_PCT} * all_rows // 100 THEN place END AS rank FROM r"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_jaccard_join": _JACCARD,
        "op3_substring_dedup": _SUBSTRING,
        "op4_warc": _WARC,
        "op5_line_dedup": _LINES,
        "op8_quality_rules": _QUALITY,
        "op11_merkle_manifest": _MERKLE,
        "op12_decontamination": _CONTAMINATION,
        "op13_importance_resampling": _IMPORTANCE,
    }
