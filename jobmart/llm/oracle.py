"""DuckDB SQL of the queries that SQL can express, written from the definitions, not from the Spark plans."""

from __future__ import annotations

from jobmart.llm import mixing, quality, warc

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    ratio = {
        "n_words": "n_words", "mean_word_chars": "(CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END)",
        "symbol_ratio": "(CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END)",
        "stop_word_ratio": "(CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END)",
        "dup_line_ratio": "(CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END)",
        "repeat_word_ratio": "(CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END)"}
    ok = " AND ".join(f"{ratio[r.measure]} {op} {x}" for r in quality.RULES for op, x in ((">=", r.low), ("<=", r.high)) if x is not None)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
g AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
p AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(8)) AS k FROM r) GROUP BY rid),
ln AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(ws, '')), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(ln.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(ln.n, 0) AS n_lines, len(list_filter(ws, lambda w: lower(w) IN ({stop}))) AS n_stop
      FROM d LEFT JOIN p USING (rid) LEFT JOIN ln USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ({ok}) AS kept FROM b"""


def _mixing() -> str:
    weights = ", ".join(str(w) for w in mixing.WEIGHTS)
    n = len(mixing.WEIGHTS)
    return rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [{weights}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {n}]::DOUBLE AS weight FROM d GROUP BY source),
c AS (SELECT *, {mixing.CAP}::DOUBLE * source_size AS top FROM s),
o AS (SELECT *, sum(source_size) OVER ()::DOUBLE - coalesce(sum(top) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
             sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
      FROM c WINDOW w AS (ORDER BY top / weight, source NULLS LAST)),
f AS (SELECT *, left_over / open_weight AS level, left_over / open_weight * weight <= top AS free FROM o),
t AS (SELECT source, source_size, least(top, CASE WHEN free THEN (SELECT first(level ORDER BY top / weight, level) FROM f WHERE free) * weight ELSE top END) AS target,
             ('0x' || substr(md5('mix:' || coalesce(source, chr(0))), 1, 12))::BIGINT / {float(16 ** 12)} AS u FROM f),
k AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
r AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, coalesce((doc_id % {mixing.BUCKETS} + {mixing.BUCKETS}) % {mixing.BUCKETS}, -1), doc_id NULLS FIRST) - 1 AS n FROM d)
SELECT doc_id, size, source_size, target,
       CAST(size * least(floor(u + rate * (n + 1)) - floor(u + rate * n), {int(mixing.CAP)}) AS BIGINT) AS taken
FROM r JOIN k ON r.source IS NOT DISTINCT FROM k.source"""


def _warc() -> str:
    permitted = ", ".join(f"'{h}'" for h in warc.PERMITTED)
    u = "regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    return rf"""
WITH p AS (SELECT coalesce(page_id, 0) AS p, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, '"' || substr(md5(html), 1, 12) || '"' AS tag, 1717200000 + (p * 7919) % 2592000 AS t0, {u} AS u FROM p),
c AS (SELECT *, 0 AS n, t0 AS t, tag AS etag FROM q
      UNION ALL SELECT *, 1, t0 + 3600, tag FROM q WHERE p % 3 = 0 UNION ALL SELECT *, 2, t0 + 93600, tag FROM q WHERE p % 3 = 0
      UNION ALL SELECT *, 3, t0 + 18000, 'W/' || tag FROM q WHERE p % 3 = 1 UNION ALL SELECT *, 4, t0 + 108000, '"changed"' FROM q WHERE p % 10 = 7
      UNION ALL SELECT *, 5, t0 - 7200, tag FROM q WHERE p % 10 = 9),
k AS (SELECT *, '<urn:page:' || p || ':' || n || '>' AS record_id,
             regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), ':(80|443)$', '') || regexp_replace(regexp_extract(regexp_replace(u, '^[^/?]*', ''), '^([^?]*)', 1), '/+$', '') AS place,
             array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{warc._TRACKING}'))), '&') AS args FROM c),
a AS (SELECT *, place || CASE WHEN args <> '' THEN '?' || args ELSE '' END AS url_key, strftime(to_timestamp(t) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM k),
v AS (SELECT r.*, (SELECT max({{'t': f.t, 'id': f.record_id}}) FROM a f WHERE f.n = 0 AND f.url_key = r.url_key AND f.t < r.t).id AS refers_to FROM a r WHERE r.n > 0),
j AS (SELECT v.*, f.html AS body, f.etag AS old_tag, f.stamp AS old_stamp, octet_length(encode(f.html)) AS size FROM v LEFT JOIN a f ON f.record_id = v.refers_to),
s AS (SELECT *, CASE WHEN refers_to IS NULL THEN 'unresolved' WHEN regexp_replace(etag, '^W/', '') = regexp_replace(old_tag, '^W/', '') THEN 'resolved' ELSE 'validator_mismatch' END AS status FROM j)
SELECT record_id, url_key, replace(replace(stamp, 'T', ' '), 'Z', '') AS captured, status, refers_to,
       CASE WHEN status = 'resolved' THEN array_to_string(['cache-control: max-age=' || (CASE WHEN 'cache-control' IN ({permitted}) THEN n * 60 ELSE 0 END), 'content-length: ' || size,
            'content-type: text/html; charset=utf-8', 'date: ' || (CASE WHEN 'date' IN ({permitted}) THEN stamp ELSE old_stamp END), 'etag: ' || etag], chr(10)) END AS headers,
       CASE WHEN status = 'resolved' THEN CAST(length(body) AS BIGINT) END AS body_chars, CASE WHEN status = 'resolved' THEN md5(body) END AS body_md5
FROM s"""


def _centroids(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Plain rounds: every vector against every centroid, every time."""
    floor = "(s - ((s % n) + n) % n) // n"  # of the exact quotient, also below zero
    dist = "CAST(list_sum(list_transform(list_zip(v, cv), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT)"
    steps = "".join(f"""
a{i} AS MATERIALIZED (SELECT rid, min({{'d': {dist}, 'c': c}}) AS m FROM e, c{i} GROUP BY rid),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(nv, cv) AS cv FROM c{i} LEFT JOIN (
  SELECT c, list({floor} ORDER BY j) AS nv FROM (SELECT m.c AS c, j, sum(v[j]) AS s, count(*) AS n FROM e JOIN a{i} USING (rid), range(1, {dim + 1}) t(j) GROUP BY ALL) GROUP BY c) USING (c)),"""
                    for i in range(rounds))
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v AS cv FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM e) ORDER BY h NULLS LAST, v LIMIT {k}),{steps}
f AS (SELECT rid, min({{'d': {dist}, 'c': c}}) AS m FROM e, c{rounds} GROUP BY rid)
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(cv, ',')) AS centroid_sha256
FROM f JOIN e USING (rid) JOIN c{rounds} ON c{rounds}.c = m.c"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295]::BIGINT[], {codes}), lambda a, b: {bits}), 4294967295)"


def _merkle() -> str:
    def leaf(n_chars: str) -> str:
        cols = ["doc_id", "source", "lang", n_chars, "text"]
        parts = [f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols]
        return f"sha256({' || '.join(parts)})"

    def tree(name: str, leaves: str) -> str:
        return f"""
{name} AS (SELECT grp, 0 AS lvl, pos, h, n FROM {leaves}
  UNION ALL SELECT grp, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY grp, lvl, pos // 2, n)"""

    tampered = f"{_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, lang AS grp, {leaf('n_chars')} AS h,
    CASE WHEN {tampered} THEN {leaf('(CAST(n_chars AS HUGEINT) + 1)')} END AS changed FROM documents),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM d),{tree("t", "l")},
sr AS MATERIALIZED (SELECT grp AS name, h AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
tl AS (SELECT '' AS grp, pos, subroot AS h, n FROM sr),{tree("u", "tl")},
w AS MATERIALIZED (
  SELECT rid, a.lvl AS step, (l.pos >> a.lvl) % 2 = 1 AS is_right, s.h AS sibling FROM l JOIN (SELECT DISTINCT grp, lvl, n FROM t) a ON a.grp IS NOT DISTINCT FROM l.grp AND a.n > 1
    LEFT JOIN t s ON s.grp IS NOT DISTINCT FROM l.grp AND s.lvl = a.lvl AND s.pos = xor(l.pos >> a.lvl, 1)
  UNION ALL
  SELECT rid, a.lvl + (SELECT max(lvl) FROM t x WHERE x.grp IS NOT DISTINCT FROM l.grp), (sr.pos >> a.lvl) % 2 = 1, s.h FROM l JOIN sr ON sr.name IS NOT DISTINCT FROM l.grp
    JOIN (SELECT DISTINCT lvl, n FROM u) a ON a.n > 1 LEFT JOIN u s ON s.lvl = a.lvl AND s.pos = xor(sr.pos >> a.lvl, 1)),
f AS (SELECT rid, 0 AS step, coalesce(changed, h) AS h FROM l
  UNION ALL SELECT f.rid, f.step + 1, sha256(CASE WHEN is_right THEN coalesce(sibling, '') || f.h ELSE f.h || coalesce(sibling, '') END) FROM f JOIN w USING (rid, step)),
e AS (SELECT rid, arg_max(h, step) AS folded_root FROM f GROUP BY rid),
p AS (SELECT rid, string_agg(sibling, '' ORDER BY step) AS proof FROM w WHERE sibling IS NOT NULL GROUP BY rid)
SELECT doc_id, l.h AS leaf, subroot, r.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = r.h AS verified
FROM l JOIN sr ON sr.name IS NOT DISTINCT FROM l.grp JOIN e USING (rid) LEFT JOIN p USING (rid), (SELECT h FROM u WHERE n = 1) r"""


def oracle_sql() -> dict[str, str]:
    return {"op4_warc_revisits": _warc(), "op6_quality_rules": _quality(), "op7_mixing": _mixing(),
            "op11_centroids": _centroids(), "op12_merkle": _merkle()}
