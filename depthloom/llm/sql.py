"""DuckDB statements that give the rows of the corpus queries over whole tables."""

from __future__ import annotations

_SPACES = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format("text")}, ''), '{_ALNUM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}') AS w
      FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format("text")}, ''), '{_SPACES}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""


def op7(regions: tuple, grown: tuple, seed: int) -> str:
    """Shards, slots and CRC-32, the last by the reversed polynomial 0xEDB88320 over the bytes."""
    name = "coalesce(CAST(doc_id AS VARCHAR), 'null')"

    def tree(of: tuple) -> str:
        shards = [(r, k, s, w) for r, racks in enumerate(of) for k, rack in enumerate(racks) for s, w in enumerate(rack)]
        return ", ".join(f"({r}, {k}, {s}, {n}, {w})" for n, (r, k, s, w) in enumerate(shards))

    def drawn(path: str, weight: str) -> str:
        return f"-ln((CAST('0x' || substr(md5(u.k || ':{seed}:' || {path}), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0) / {weight}"

    def levels(t: str) -> str:
        """The tree's three draws, each among the children of the node that won the one before."""
        return f"""
{t}1 AS (SELECT k, arg_min(r, d) AS r FROM (SELECT u.k, r, {drawn("r", "w")} AS d FROM u, (SELECT r, sum(w) AS w FROM {t} GROUP BY r)) GROUP BY k),
{t}2 AS (SELECT k, r, arg_min(rack, d) AS rack FROM (SELECT u.k, u.r, c.k AS rack, {drawn("u.r || '.' || c.k", "w")} AS d
      FROM {t}1 u JOIN (SELECT r, k, sum(w) AS w FROM {t} GROUP BY r, k) c ON c.r = u.r) GROUP BY k, r),
{t}3 AS (SELECT k, arg_min(n, d) AS s FROM (SELECT u.k, n, {drawn("u.r || '.' || u.rack || '.' || c.s", "w")} AS d
      FROM {t}2 u JOIN {t} c ON c.r = u.r AND c.k = u.rack) GROUP BY k)"""

    step = "n"
    for i in range(8):
        step = f"SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END AS c FROM ({step if i else 'SELECT CAST(range AS BIGINT) AS n, CAST(range AS BIGINT) AS c FROM range(256)'})"
    return f"""
WITH tab AS (SELECT list(c ORDER BY n) AS t FROM ({step})),
d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, {name} AS k FROM documents),
u AS (SELECT DISTINCT k FROM d),
a(r, k, s, n, w) AS (VALUES {tree(regions)}),
b(r, k, s, n, w) AS (VALUES {tree(grown)}),{levels("a")},{levels("b")},
x AS (SELECT id, hex(encode(text)) AS h, strlen(text) AS n FROM d),
c AS (SELECT id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(regexp_extract_all(h, '..'), lambda e: CAST('0x' || e AS BIGINT))),
        lambda a, e: xor(a // 256, t[CAST(xor(a % 256, e) AS INTEGER) + 1])), CAST(4294967295 AS BIGINT)) AS text_crc32 FROM x, tab),
p AS (SELECT d.doc_id, CAST(strlen(d.text) AS BIGINT) + 16 AS size, c.text_crc32, CAST(o.s AS INTEGER) AS shard, CAST(g.s AS INTEGER) AS grown_shard, md5(d.k || ':{seed}:slot') AS kk
      FROM d JOIN c USING (id) JOIN a3 o ON o.k = d.k JOIN b3 g ON g.k = d.k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY kk, size, text_crc32) - 1 AS slot, grown_shard FROM p
"""


OP9 = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_SPACES}')) AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':9') AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM d GROUP BY source),
w AS (SELECT *, CAST((place - 1) % 3 + 1 AS DOUBLE) AS weight, source_size * 3 AS most FROM s),
r AS (SELECT *, most / weight AS ratio FROM w),
o AS (SELECT *, coalesce(sum(most) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS most_before,
             sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
             sum(source_size) OVER () AS total FROM r),
f AS (SELECT *, CASE WHEN (total - most_before) / weight_left <= ratio THEN (total - most_before) / weight_left END AS fits FROM o),
t AS (SELECT source, source_size, least(CAST(most AS DOUBLE), arg_min(fits, (ratio, place)) FILTER (fits IS NOT NULL) OVER () * weight) AS target FROM f),
b AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(budget // greatest(source_size, 1) * size + greatest(0, least(size, budget % greatest(source_size, 1) - before)) AS BIGINT) AS taken FROM b
"""

OP10 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACES}') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
l AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM g) WHERE r > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM l),
v AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
k AS (SELECT v.doc_id, count(*) AS n, string_agg(v.word, ' ' ORDER BY v.j) AS kept FROM v ANTI JOIN x ON v.doc_id = x.doc_id AND v.j = x.j GROUP BY v.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def op6(depth: int, share: float, similar: float, documents: int) -> str:
    """The template tree over lines; md5 stands for leaves and templates as in the DataFrame form. Each row loses its own lines."""
    mask = "lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS doc, coalesce(text, '') AS text FROM documents),
s AS (SELECT id, doc_id, doc, text, string_split(text, chr(10)) AS cut FROM d),
l AS (SELECT id, doc, pos, list_filter(regexp_split_to_array(line, '[ \t\r]+'), lambda t: t <> '') AS tokens
      FROM (SELECT id, doc, unnest(cut) AS line, unnest(range(len(cut))) AS pos FROM s)),
f AS (SELECT id, doc, pos, tokens, md5(concat_ws(' ', len(tokens), array_to_string(list_transform(tokens[1:{depth}], {mask}), ' '))) AS leaf FROM l WHERE len(tokens) > 0),
h AS (SELECT leaf FROM f GROUP BY leaf HAVING count(DISTINCT doc) >= {documents}),
m AS (SELECT f.* FROM f SEMI JOIN h USING (leaf)),
t AS (SELECT leaf, place, token, count(*) AS n FROM (SELECT leaf, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM m) GROUP BY ALL),
b AS (SELECT leaf, place, token, n, sum(n) OVER (PARTITION BY leaf, place) AS total, row_number() OVER (PARTITION BY leaf, place ORDER BY n DESC, token) AS r FROM t),
x AS (SELECT leaf, list(CASE WHEN n >= total * {share} THEN token ELSE NULL END ORDER BY place) AS fixed FROM b WHERE r = 1 GROUP BY leaf),
o AS (SELECT id, doc, pos, md5(CASE WHEN len(list_filter(range(1, len(tokens) + 1), lambda i: coalesce(tokens[i] = fixed[i], false))) >= len(tokens) * {similar}
        THEN array_to_string(list_transform(fixed, lambda t: coalesce(t, '<*>')), ' ')
        ELSE array_to_string(list_transform(tokens, {mask}), ' ') END) AS template FROM m JOIN x USING (leaf)),
w AS (SELECT template FROM o GROUP BY template HAVING count(DISTINCT doc) >= {documents}),
g AS (SELECT id, list(DISTINCT pos) AS gone FROM o SEMI JOIN w USING (template) GROUP BY id)
SELECT doc_id, CAST(len(list_filter(cut, lambda c: regexp_matches(c, '[^ \t\r]'))) AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_dropped,
       sha256(CASE WHEN gone IS NULL THEN text ELSE
         array_to_string(list_transform(list_filter(range(len(cut)), lambda i: NOT list_contains(gone, i)), lambda i: cut[i + 1]), chr(10)) END) AS kept_sha256
FROM s LEFT JOIN g USING (id)
"""
