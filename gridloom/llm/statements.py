"""Statements in DuckDB SQL for the operators that SQL can express in one statement."""

from __future__ import annotations

TOP_SCORES = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

#: The checksum of the text in column ``x`` as a list of bytes ``b``, by the table ``crc.t``.
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b),
      lambda a, x: xor(a >> 8, crc.t[CAST(xor(a & 255, x) AS INTEGER) + 1])))"""
_CRC_TABLE = """crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
    ORDER BY i) AS t FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))"""
_BYTES = "list_transform(range(strlen(x)), lambda i: CAST('0x' || substr(hex(encode(x)), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(c: str) -> str:
    return f"coalesce(strlen({c}) || ':' || {c}, '-')"


def _levels(name: str, count: int) -> tuple[str, str, str, str]:
    """Of a tree over ``{name}0`` (g, pos, n, h): its levels, its roots, joins of a leaf ``d`` with its runs, and their siblings."""
    ctes, joins, sides = [], [], []
    for i in range(count):
        ctes.append(f"{name}r{i} AS (SELECT g, pos // 16 AS run, max(n) AS n, list(h ORDER BY pos) AS hs FROM {name}{i} WHERE n > 1 GROUP BY g, pos // 16)")
        ctes.append(f"{name}{i + 1} AS (SELECT g, run AS pos, (n + 15) // 16 AS n, sha256(array_to_string(hs, '')) AS h FROM {name}r{i})")
        joins.append(f"LEFT JOIN {name}r{i} ON {name}r{i}.g = d.g AND {name}r{i}.run = d.pos // {16 ** (i + 1)}")
        slot = f"CAST(d.pos // {16**i} % 16 AS INTEGER)"
        sides.append((f"{name}r{i}.hs[:{slot}]", f"{name}r{i}.hs[{slot} + 2:]", f"{name}r{i}.hs IS NULL"))
    roots = " UNION ALL ".join(f"SELECT g, h FROM {name}{i} WHERE n = 1" for i in range(count + 1))
    path = "list_concat(" + ", ".join(f"CASE WHEN {no} THEN [] ELSE [[array_to_string({b}, ''), array_to_string({a}, '')]] END" for b, a, no in sides) + ")"
    return ", ".join(ctes), roots, " ".join(joins), path


_DOCS, _SUBROOTS, _DOC_JOINS, _DOC_PATH = _levels("l", 6)
_SOURCES, _ROOTS, _SOURCE_JOINS, _SOURCE_PATH = _levels("s", 5)

MANIFEST = f"""
WITH {_CRC_TABLE},
  d0 AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS g, text, CAST(doc_id AS VARCHAR) AS x,
    {_field("CAST(doc_id AS VARCHAR)")} || {_field("source")} || {_field("lang")} || {_field("CAST(n_chars AS VARCHAR)")} AS head FROM documents),
  d1 AS (SELECT *, {_BYTES} AS b, sha256(head || {_field("text")}) AS h FROM d0),
  d AS (SELECT doc_id, g, h, coalesce({_CRC} % 5 = 0, false) AS hit, sha256(head || {_field(f"translate(text, '{_UPPER}', '{_LOWER}')")}) AS changed,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d1, crc),
  l0 AS (SELECT g, pos, n, h FROM d), {_DOCS},
  subroots AS ({_SUBROOTS}),
  s0 AS (SELECT '' AS g, g AS source, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM subroots), {_SOURCES},
  root AS ({_ROOTS}),
  up AS (SELECT d.source, d.h AS subroot, {_SOURCE_PATH} AS path FROM s0 AS d {_SOURCE_JOINS}),
  down AS (SELECT d.*, {_DOC_PATH} AS path FROM d {_DOC_JOINS}),
  f AS (SELECT doc_id, down.h AS leaf, subroot, root.h AS root, list_concat(down.path, up.path) AS path, CASE WHEN hit THEN changed ELSE down.h END AS start
    FROM down JOIN up ON up.source = down.g, root),
  o AS (SELECT *, list_reduce(list_concat([[start, '']], path), lambda a, x: [sha256(x[1] || a[1] || x[2]), ''])[1] AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda p: p[1] || p[2]), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified FROM o"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

RESAMPLED = f"""
WITH {_CRC_TABLE},
  t AS (SELECT 'd' AS side, row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), NULL, {_WORDS} FROM benchmark),
  e AS (SELECT side, row, unnest(w) AS x, unnest(range(len(w))) AS i FROM t),
  f AS (SELECT side, row, x FROM e UNION ALL
    SELECT side, row, y FROM (SELECT side, row, x || ' ' || lead(x) OVER (PARTITION BY side, row ORDER BY i) AS y FROM e) WHERE y IS NOT NULL),
  u AS (SELECT x, {_BYTES} AS b FROM (SELECT DISTINCT x FROM f)),
  k AS (SELECT x, {_CRC} % 10000 AS bucket FROM u, crc),
  c AS (SELECT side, row, bucket, count(*) AS n FROM f JOIN k USING (x) GROUP BY ALL),
  tot AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM c GROUP BY bucket),
  whole AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s_all, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t_all FROM tot),
  g AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (s_all + 10000) / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
    FROM tot, whole),
  w AS (SELECT row, CAST(sum(n) AS BIGINT) AS n_features, sum(n * gain) AS total FROM c JOIN g USING (bucket) WHERE side = 'd' GROUP BY row),
  d AS (SELECT doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features,
      CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
      CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
    FROM t LEFT JOIN w USING (row) WHERE side = 'd'),
  s AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score, words >= 20 AND doc_id IS NOT NULL AS able FROM d),
  r AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS n FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n // 100 THEN place END AS rank FROM r"""
