"""DuckDB SQL of the prefix trie, the top-k search and the Merkle manifest."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a short ASCII text, bit by bit."""
    step = "lambda x, y: xor(x >> 1, (x & 1) * 3988292384)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), "
            f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], {step})), 4294967295)")


def _merkle(levels: int = 8) -> str:
    """Trees of up to 8^levels leaves a language and as many languages, a CTE for each level."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: f"sha256({' || '.join([field(c) for c in ('doc_id', 'source', 'lang', 'n_chars')] + [field(text)])})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [f"""WITH d AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf('text')} AS leaf,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f0
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
n0 AS (SELECT g, i, leaf AS h, n FROM p)"""]
    up = lambda a, b: (f"{b} AS (SELECT g, i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h, "  # noqa: E731
                       f"CASE WHEN n > 1 THEN (n + 7) // 8 ELSE 1 END AS n FROM {a} GROUP BY g, {a}.i // 8, {a}.n)")
    out += [up(f"n{k}", f"n{k + 1}") for k in range(levels)]
    out.append(f"s AS (SELECT g AS lang, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM n{levels})")
    out.append("t0 AS (SELECT '' AS g, i, subroot AS h, n FROM s)")
    out += [up(f"t{k}", f"t{k + 1}") for k in range(levels)]

    def climb(start: str, where: str, level: str, k: int, place: str) -> str:
        """Siblings of every document at one level, and what its hash becomes."""
        return f"""{where} AS (
  SELECT a.doc_id, a.leaf, a.g, a.i, a.proof || coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i <> a.{place} // {8 ** k} AND b.n > 1), '') AS proof,
         CASE WHEN max(b.n) > 1 THEN sha256(coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.{place} // {8 ** k}), '') || a.f ||
           coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.{place} // {8 ** k}), '')) ELSE a.f END AS f, a.key, a.subroot, a.j
  FROM {start} a JOIN {level} b ON b.g = a.key AND b.i // 8 = a.{place} // {8 ** (k + 1)}
  GROUP BY a.doc_id, a.leaf, a.g, a.i, a.proof, a.f, a.key, a.subroot, a.j)"""
    out.append("c0 AS (SELECT p.doc_id, p.leaf, p.g, p.i, '' AS proof, p.f0 AS f, p.g AS key, s.subroot, s.i AS j FROM p JOIN s ON s.lang = p.g)")
    out += [climb(f"c{k}", f"c{k + 1}", f"n{k}", k, "i") for k in range(levels)]
    out.append(f"u0 AS (SELECT * REPLACE ('' AS key) FROM c{levels})")
    out += [climb(f"u{k}", f"u{k + 1}", f"t{k}", k, "j") for k in range(levels)]
    root = f"(SELECT h FROM t{levels})"
    return ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, {root} AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = {root} AS verified FROM u{levels}"""


_TRIE = f"""
WITH x AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS place FROM x),
c AS (SELECT conv_id, count(*) AS n, {crc32("conv_id::VARCHAR")} % 9 AS h, conv_id - conv_id % 5 AS base FROM o GROUP BY conv_id),
l AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS m FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (
  SELECT o.conv_id, o.place - l.h + l.m AS depth, t, bytes FROM o JOIN l ON l.conv_id = o.conv_id WHERE o.place > l.h
  UNION ALL SELECT l.conv_id, o.place, t, bytes FROM o JOIN l ON l.base = o.conv_id WHERE o.place <= l.m),
k AS (
  SELECT conv_id, depth, bytes, md5(string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM l),
n AS (
  SELECT key, depth, min(k.conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
         sha256(coalesce(string_agg(k.conv_id::VARCHAR, ',' ORDER BY k.conv_id) FILTER (WHERE depth = l.m + greatest(l.n - l.h, 0)), '')) AS ends_sha256
  FROM k JOIN l ON l.conv_id = k.conv_id GROUP BY key, depth),
p AS (
  SELECT n.*, a.key AS parent_key, b.conv_id AS parent_conv_id
  FROM n LEFT JOIN k a ON a.conv_id = n.conv_id AND a.depth = n.depth - 1 LEFT JOIN n b ON b.key = a.key AND b.depth = a.depth),
f AS (SELECT parent_key AS key, depth - 1 AS depth, count(*) AS n_children FROM p WHERE parent_key IS NOT NULL GROUP BY ALL),
s AS (
  SELECT a.key, a.depth, sum((p.n_convs - 1) * p.bytes) AS saved_tokens, count(*) FILTER (WHERE f.n_children IS NULL) AS n_leaves
  FROM p JOIN k a ON a.conv_id = p.conv_id AND a.depth <= p.depth LEFT JOIN f ON f.key = p.key AND f.depth = p.depth
  GROUP BY a.key, a.depth)
SELECT p.conv_id, p.depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, coalesce(f.n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM p JOIN s ON s.key = p.key AND s.depth = p.depth LEFT JOIN f ON f.key = p.key AND f.depth = p.depth"""

_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""

ORACLE: dict[str, str] = {
    "op12_pivot_topk": _TOPK,
    "op11_prefix_trie": _TRIE,
    "op13_merkle_manifest": _merkle(),
}
