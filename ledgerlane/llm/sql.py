"""Independent DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit: 256 and more stand for the eight shifts behind each byte."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT] || [k::BIGINT FOR k IN range(256, 264)]))"
    shift = "CASE WHEN x < 256 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END"
    return f"xor(list_reduce({steps}, lambda crc, x: {shift}, 4294967295::BIGINT), 4294967295)"


#: The donor's first turns, then the own ones; nodes are lists of digests of the turns.
_TRIE = rf"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, sha256(coalesce(role, '') || chr(1) || coalesce(text, '')) AS d,
         {_WORDS}::BIGINT AS words FROM conversations),
convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS donor, {_crc32("conv_id::VARCHAR")} % 4 AS heads FROM own GROUP BY conv_id),
turns AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.d, o.words FROM convs c JOIN own o ON o.conv_id = c.donor AND o.pos <= c.heads
  UNION ALL SELECT c.conv_id, 1, o.pos, o.d, o.words FROM convs c JOIN own o USING (conv_id) WHERE o.pos > c.heads),
placed AS (
  SELECT conv_id, row_number() OVER w AS depth, md5(string_agg(d, ',') OVER w) AS node, words FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
member AS (
  SELECT conv_id, depth, node, words, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent FROM placed
  UNION ALL SELECT conv_id, 0, '', 0, NULL FROM convs),
reach AS (SELECT conv_id, max(depth) AS length FROM member GROUP BY conv_id),
node AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         coalesce(string_agg(CASE WHEN depth = length THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM member JOIN reach USING (conv_id) GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY parent),
full_node AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN kids USING (node)),
below AS (
  SELECT u.node, v.node AS other FROM member u JOIN member v ON u.conv_id = v.conv_id AND v.depth >= u.depth GROUP BY u.node, v.node),
sums AS (
  SELECT b.node, sum(((v.n_convs - 1) * v.words)) AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
  FROM below b JOIN full_node v ON v.node = b.other GROUP BY b.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM full_node n JOIN sums s USING (node) LEFT JOIN node p ON n.depth > 0 AND p.node = n.parent
"""


def _merkle(below: int = 6, above: int = 3) -> str:
    """Leaves up to 16^below a source, and 16^above sources."""

    def leaf(text: str) -> str:
        fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"

    def tree(name: str, levels: int, key: str) -> list[str]:
        """``name``0 to ``name``levels: (key, i, n, digest); a tree's last node stays as it is."""
        step = "SELECT {key}, CASE WHEN n > 1 THEN i // 16 ELSE i END AS i, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest"
        group = "GROUP BY {key}, n, CASE WHEN n > 1 THEN i // 16 ELSE i END"
        return [f"{name}{k + 1} AS ({step.format(key=key)} FROM {name}{k} {group.format(key=key)})" for k in range(levels)]

    def runs(name: str, levels: int, key: str) -> list[str]:
        return [f"{name}r{k} AS (SELECT {key}, i // 16 AS run, list(digest ORDER BY i) AS run_of FROM {name}{k} WHERE n > 1 GROUP BY {key}, i // 16)" for k in range(levels)]

    joins, folds, siblings = [], [], []
    for name, levels, key, place in (("s", below, "t", "place"), ("u", above, "one", "tree")):
        for k in range(levels):
            at = f"({place} // {16**k})"
            joins.append(f"LEFT JOIN {name}r{k} ON {name}r{k}.{key} = d.{key} AND {name}r{k}.run = {at} // 16")
            left, right = (f"array_to_string({name}r{k}.run_of[{part}], '')" for part in (f":({at} % 16)", f"({at} % 16 + 2):"))
            folds.append((f"{name}r{k}.run_of", left, right))
            siblings.append(f"coalesce({left} || {right}, '')")
    steps, before = [], "folding0"
    for k, (run, left, right) in enumerate(folds):
        names = ", ".join(c for c in ("doc_id", "leaf", "subroot", "proof_sha256"))
        steps.append(
            f"folding{k + 1} AS (SELECT {names}, parts, CASE WHEN parts[{k + 1}] IS NULL THEN node ELSE sha256(parts[{k + 1}].l || node || parts[{k + 1}].r) END AS node FROM folding{k})"
        )
        before = f"folding{k + 1}"
    parts = ", ".join(f"CASE WHEN {run} IS NULL THEN NULL ELSE {{'l': {left}, 'r': {right}}} END" for run, left, right in folds)
    views = [
        f"leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN "
        + leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
        + " END AS claim FROM documents)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n,"
        " dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t, 1 AS one FROM leaves)",
        "s0 AS (SELECT t, place AS i, n, leaf AS digest FROM ranked)",
        *tree("s", below, "t"),
        f"u0 AS (SELECT 1 AS one, t AS i, count(*) OVER () AS n, digest FROM s{below})",
        *tree("u", above, "one"),
        *runs("s", below, "t"),
        *runs("u", above, "one"),
        f"d AS (SELECT r.*, t AS tree, s{below}.digest AS subroot FROM ranked r JOIN s{below} USING (t))",
        f"folding0 AS (SELECT doc_id, leaf, subroot, coalesce(claim, leaf) AS node, sha256({' || '.join(siblings)}) AS proof_sha256, [{parts}] AS parts FROM d {' '.join(joins)})",
        *steps,
    ]
    root = f"(SELECT digest FROM u{above})"
    return "WITH " + ",\n".join(views) + (
        f"\nSELECT doc_id, leaf, subroot, {root} AS root, proof_sha256, node AS folded_root, node = {root} AS verified FROM {before}"
    )


STATEMENTS = {
    "op11_prefix_trie": _TRIE,
    "op12_merkle_manifest": _merkle(),
    "op6_warc": """
WITH payload AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
largest AS (SELECT html, max(page_id) AS response FROM payload GROUP BY html),
told AS (SELECT p.*, l.response, size >= 1000 AND response IS NOT NULL AND page_id IS DISTINCT FROM response AS again
         FROM payload p JOIN largest l USING (html))
SELECT page_id, size::BIGINT AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN response END AS refers_to FROM told
""",
    # Targets by a fixed point over the capped sources: a source is capped while its share of the rest is above its cap.
    "op8_mixing": rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', '0', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT 0 AS step, sum(source_size) * 1.5::DOUBLE / sum(weight) AS level FROM sources
  UNION ALL
  SELECT step + 1, level FROM (
    SELECT l.step, ((sum(source_size) * 1.5::DOUBLE - sum(CASE WHEN l.level * weight >= cap THEN cap ELSE 0 END))
           / nullif(sum(CASE WHEN l.level * weight < cap THEN weight ELSE 0 END), 0)) AS level
    FROM sources, levels l WHERE l.step < 50 GROUP BY l.step, l.level)),
targets AS (
  SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM levels WHERE step = 50) * weight, cap)) AS target FROM sources),
placed AS (
  SELECT s.doc_id, s.size, s.k, s.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY source, k) AS together FROM placed)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND (upto <= rest OR upto - rest < rest - (upto - together)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cut
""",
}
