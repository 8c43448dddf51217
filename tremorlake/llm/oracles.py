"""DuckDB SQL with the rows of the text queries, where SQL expresses the operator on whole tables.

No SQL for op1 (learned), op3 (learned), op6 and op7 (byte-level BPE), op9 (dynamic program), op11 (learned) and the pipeline: those are tested against brute-force versions.
"""

from __future__ import annotations


def _components(nodes: str, links: str) -> str:
    """Smallest id reachable from every node, by walking the links."""
    return f"""linked AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
walk(id, reached) AS (SELECT id, id FROM {nodes} UNION SELECT walk.id, linked.b FROM walk JOIN linked ON linked.a = walk.reached),
component AS (SELECT id, min(reached) AS component_id FROM walk GROUP BY id)"""


_OP2 = rf"""WITH RECURSIVE doc AS (SELECT doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM doc),
size AS (SELECT id, count(*) AS n FROM shingle GROUP BY id),
shared AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM shingle x JOIN shingle y ON x.s = y.s AND x.id < y.id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN size p ON p.id = a JOIN size q ON q.id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
{_components('doc', 'link')}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON c.id = d.doc_id LEFT JOIN size s ON s.id = d.doc_id"""

_OP4 = r"""WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM doc WHERE len(w) > 8)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM twice, range(8) AS eight(k) GROUP BY r),
held AS (SELECT r, host, translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS said,
    regexp_extract_all(unnest(string_split(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), chr(10))),
      '[^\x20\x09-\x0D]+') AS p FROM doc),
line AS (SELECT r, host, said, array_to_string(p, ' ') AS l, sum(len(p)) AS n FROM held WHERE len(p) > 0 GROUP BY ALL),
host_size AS (SELECT host, count(DISTINCT said) AS docs FROM held WHERE said <> '' GROUP BY host),
often AS (SELECT host, l, count(DISTINCT said) AS times FROM line GROUP BY host, l HAVING times > 20),
gone AS (SELECT r, sum(n) AS n FROM line JOIN often USING (host, l) JOIN host_size USING (host) WHERE times > CAST(0.05 AS DOUBLE) * docs GROUP BY r),
counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(w) - coalesce(gone.n, 0) AS BIGINT) AS n_words_left FROM doc LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND n_words_left >= 10 AND 100 * n_words_left >= 30 * n_words AS kept FROM judged"""

#: Eight groups of five bits are one group of five bytes, that is ten hexadecimal digits.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31 AS INT), 1)), '')"""

_OP5 = f"""WITH page AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
newest AS (SELECT hex AS h, max(page_id) AS response FROM page GROUP BY hex)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> response THEN response END AS refers_to
FROM page JOIN newest ON h = hex"""


def _found(kind: str, order: int, pattern: str, group: int) -> str:
    """Matches with their places: the lengths of the gaps and matches before them, added up."""
    return f"""SELECT doc_id, source, lang, '{kind}' AS kind, {order} AS o, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'start':
      list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
      'size': length(m[i]), 'value': v[i]}})) AS f FROM (
    SELECT doc_id, source, lang, regexp_split_to_array(text, {pattern}) AS g, regexp_extract_all(text, {pattern}) AS m,
      regexp_extract_all(text, {pattern}, {group}) AS v FROM documents WHERE regexp_matches(text, {pattern}))"""


_KEYWORD = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_QUOTE = """["'']?"""
_ASSIGN = rf"'{_KEYWORD}{_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)'"

_OP8 = f"""WITH found AS (
  {_found('assign', 1, _ASSIGN, 2)}
  UNION ALL {_found('access', 2, "'AKIA[A-Z0-9]{16,}'", 0)}
  UNION ALL {_found('hex', 3, "'[0-9a-f]{24,}'", 0)}
  UNION ALL {_found('key', 4, "'[A-Za-z0-9+/_-]{20,}'", 0)}),
span AS (SELECT doc_id, source, lang, kind, o, CAST(f.start AS BIGINT) AS a, CAST(f.start + f.size AS BIGINT) AS b, f.value AS value FROM found
  WHERE CASE WHEN kind = 'assign' THEN length(f.value) >= 6
             WHEN kind = 'key' THEN regexp_matches(f.value, '[a-z]') AND regexp_matches(f.value, '[A-Z]') AND regexp_matches(f.value, '[0-9]') ELSE true END),
owned AS (SELECT value AS v, count(DISTINCT coalesce(source, '')) < 3
    AND count(DISTINCT {{'owner': coalesce(source, ''), 'repo': concat_ws('/', source, lang)}}) < 4 AS live FROM span GROUP BY value),
mark AS (SELECT span.*, live, kind || ':' || a || ':' || b AS t FROM span JOIN owned ON v = value WHERE kind <> 'key' OR live),
per AS (SELECT doc_id AS id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(t, ',' ORDER BY a, o) FILTER (kind <> 'key') AS base, string_agg(t, ',' ORDER BY a, o) AS spans, count(*) FILTER (live) AS n_live,
  count(*) FILTER (NOT live) AS n_example FROM mark GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example FROM documents LEFT JOIN per ON id = doc_id"""

_OP10 = f"""WITH RECURSIVE vec AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (SELECT * FROM vec WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.id < y.id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
{_components('vec', 'link')}
SELECT v.id AS vec_id, (SELECT count(*) FROM link WHERE a = v.id OR b = v.id) AS n_links, component_id, v.id = component_id AS kept
FROM vec v JOIN component c ON c.id = v.id"""

_OP12 = r"""WITH doc AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
word AS (SELECT id, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS m FROM word GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
own AS (SELECT lang, source, term, count(*) AS c FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM doc),
dense AS (SELECT lang, source, term, coalesce(c, 0) AS c, m FROM grp JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)),
total AS (SELECT lang, source, sum(c) AS n, count(*) AS v, sum(m) AS nl FROM dense GROUP BY lang, source),
share AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 1)) // (n + v) AS p, 1 + (1000000000::HUGEINT * (m + 1)) // (nl + v) AS q
  FROM dense JOIN total USING (lang, source)),
apart AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
report AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM share WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM report QUALIFY part = 'pair' OR rank <= 200"""

_OP13 = r"""WITH step AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
doc AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
word AS (SELECT true AS own, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM doc
  UNION ALL SELECT false, 0, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
run AS (SELECT own, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f FROM word),
tally AS (SELECT own, r, f, count(*) AS n FROM run GROUP BY ALL),
named AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(hex(f)) // 2), lambda i: ('0x' || substr(hex(f), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, step.t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT f FROM tally), step),
per AS (SELECT own, r, bucket, sum(n)::BIGINT AS n FROM tally JOIN named USING (f) GROUP BY ALL),
side AS (SELECT bucket, coalesce(sum(n) FILTER (own), 0)::BIGINT AS s, coalesce(sum(n) FILTER (NOT own), 0)::BIGINT AS t FROM per GROUP BY bucket),
whole AS (SELECT sum(s)::BIGINT AS big_s, sum(t)::BIGINT AS big_t FROM side),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (big_s + 10000) / ((s + 1) * (big_t + 10000))))::BIGINT AS g FROM side, whole),
weighed AS (SELECT r, sum(n) AS n_features, sum(n * g) AS weight FROM per JOIN gain USING (bucket) WHERE own GROUP BY r),
scored AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM doc JOIN word USING (r) LEFT JOIN weighed USING (r) WHERE own),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM ranked"""

LLM_ORACLES: dict[str, str] = {
    "op2_minhash": _OP2,
    "op4_quality_rules": _OP4,
    "op5_warc": _OP5,
    "op8_secret_scans": _OP8,
    "op10_embedding_near_dedup": _OP10,
    "op12_source_divergence": _OP12,
    "op13_importance_resampling": _OP13,
}
