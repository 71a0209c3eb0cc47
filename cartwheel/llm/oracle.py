"""DuckDB SQL of the text queries that SQL can express over whole tables.

The others have none: a trained model (1, 3, 9), a tokenizer (5), a parser (8)
the method's own spans and labels (6, 7), or components of either sign (13) are in their results.
"""

from __future__ import annotations

from cartwheel.llm.common import LOWER, UPPER
from cartwheel.llm.urls import LISTED, RULES

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"


def _words(column: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words("text", ALNUM)} AS w FROM documents),
b AS (SELECT item_id, {_words("text", ALNUM)} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0) x) y),
hit AS (SELECT p.doc_id, p.i, win.n, win.item_id
  FROM (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM d, (SELECT DISTINCT n FROM win) s WHERE len(w) >= n) x) p
  JOIN win ON p.n = win.n AND p.win = win.win),
places AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hit) x GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("text", WORD)} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2) p
  JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * common >= 75 * (nx.n + ny.n - common)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d
  UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


def _fits(name: str) -> str:
    """The longest key of the table ``name`` (key, verdict) that fits host and path."""
    host, path = "split_part(key, '/', 1)", "substr(key, instr(key, '/'))"
    return f"""(SELECT arg_max(key, length(key)) FROM {name}
    WHERE (host = {host} OR ends_with(host, '.' || {host})) AND starts_with(path, {path}))"""


URLS = f"""
WITH rules(key, verdict) AS (VALUES {_values(RULES)}),
listed(key, verdict) AS (VALUES {_values([(k, "block") for k in LISTED])}),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT *, {_fits("rules")} AS rule, {_fits("listed")} AS on_list FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL AND on_list IS NOT NULL THEN 'block' ELSE
  coalesce((SELECT verdict FROM rules WHERE key = rule), 'allow') END AS verdict,
  CASE WHEN rule IS NULL THEN on_list END AS listed
FROM f"""

MIXING = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 15) AS BIGINT) AS place FROM documents),
s AS (SELECT source, size AS source_size, list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)) AS weight,
  CAST(sum(size) OVER () AS DOUBLE) AS words FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source) x),
levels(level) AS (SELECT 1.5 * any_value(words) / sum(weight) FROM s
  UNION SELECT (1.5 * any_value(words) - sum(CASE WHEN weight * level > 2 * source_size THEN 2 * source_size ELSE 0 END))
    / sum(CASE WHEN weight * level > 2 * source_size THEN 0 ELSE weight END) FROM levels, s GROUP BY level),
t AS (SELECT source, source_size, CASE WHEN weight * level > 2 * source_size THEN CAST(2 * source_size AS DOUBLE) ELSE weight * level END AS target
  FROM s, (SELECT max(level) AS level FROM levels) x),
b AS (SELECT *, CAST(floor(target / greatest(1, source_size)) AS BIGINT) AS whole FROM t),
rounds(source, target, budget, after, stop, rest) AS (
  SELECT source, target, CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(-1 AS BIGINT), target - whole * source_size FROM b
  UNION ALL
  SELECT x.source, x.target, x.rest, x.stop, min(CASE WHEN upto > x.rest THEN place END),
    x.rest - coalesce(max(CASE WHEN upto <= x.rest THEN upto END), 0)
  FROM (SELECT r.source, r.target, r.rest, r.stop, d.place,
      sum(d.size) OVER (PARTITION BY r.source ORDER BY d.place) AS upto
    FROM rounds r LEFT JOIN d ON d.source IS NOT DISTINCT FROM r.source AND d.size > 0 AND d.place > r.stop AND d.size <= r.rest
    WHERE r.stop IS NOT NULL AND r.rest > 0.001 * r.target) x
  GROUP BY x.source, x.target, x.rest, x.stop),
again AS (SELECT DISTINCT d.doc_id, d.source, d.place FROM d JOIN rounds r ON d.source IS NOT DISTINCT FROM r.source
  WHERE r.after IS NOT NULL AND d.place > r.after AND d.size <= r.budget AND (r.stop IS NULL OR d.place < r.stop))
SELECT d.doc_id, d.size, b.source_size, b.target, d.size * (b.whole + CASE WHEN a.place IS NULL THEN 0 ELSE 1 END) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN again a ON a.doc_id IS NOT DISTINCT FROM d.doc_id AND a.source IS NOT DISTINCT FROM d.source AND a.place = d.place"""


def _leaf(text: str) -> str:
    fields = [f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in (
        "CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
    return f"sha256({' || '.join(fields)})"


def _tree(name: str, leaves: str) -> str:
    """Recursive tables ``name`` (t, l, i, d, n): all nodes of the trees of ``leaves`` (t, i, d, n)."""
    return f"""{name}(t, l, i, d, n) AS (SELECT t, 0, i, d, n FROM {leaves}
  UNION ALL SELECT t, l + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 2) // 3) FROM {name} WHERE n > 1 GROUP BY t, l, i // 3)"""


def _siblings(name: str, nodes: str) -> str:
    return f"""{name} AS (SELECT a.t, a.l, a.i, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
  coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS behind
  FROM {nodes} a JOIN {nodes} b ON a.t = b.t AND a.l = b.l AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.t, a.l, a.i)"""


def _walk(name: str, starts: str, siblings: str) -> str:
    return f"""{name}(r, t, l, i, proof, d) AS (SELECT r, t, 0, i, proof, d FROM {starts}
  UNION ALL SELECT w.r, w.t, w.l + 1, w.i // 3, w.proof || s.before || s.behind, sha256(s.before || w.d || s.behind)
  FROM {name} w JOIN {siblings} s ON s.t = w.t AND s.l = w.l AND s.i = w.i)"""


# SQL has no unsigned crc32: the bits of a byte, shifted eight times, are its table.
MERKLE = f"""
WITH RECURSIVE bits(b, k, v) AS (SELECT range, 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END FROM bits WHERE k < 8),
crc(id, s, c) AS (SELECT doc_id, CAST(doc_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) x
  UNION ALL SELECT id, substr(s, 2), xor(c >> 8, v) FROM crc JOIN bits ON k = 8 AND b = xor(c & 255, ascii(s)) WHERE s <> ''),
d AS (SELECT doc_id, source, {_leaf("text")} AS leaf,
  CASE WHEN c IS NOT NULL AND xor(c, CAST(4294967295 AS BIGINT)) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other
  FROM documents LEFT JOIN crc ON id = doc_id AND s = ''),
x AS (SELECT *, row_number() OVER () AS r, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
leaves AS (SELECT t, i, leaf AS d, n FROM x),
{_tree("nodes", "leaves")},
subs AS (SELECT CAST(-1 AS BIGINT) AS t, t AS i, d, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_tree("tops", "subs")},
{_siblings("low", "nodes")},
{_siblings("high", "tops")},
starts AS (SELECT r, t, i, '' AS proof, other AS d FROM x),
{_walk("way", "starts", "low")},
ends AS (SELECT r, CAST(-1 AS BIGINT) AS t, t AS i, proof, d FROM way QUALIFY row_number() OVER (PARTITION BY r ORDER BY l DESC) = 1),
{_walk("upper_way", "ends", "high")},
done AS (SELECT r, proof, d FROM upper_way QUALIFY row_number() OVER (PARTITION BY r ORDER BY l DESC) = 1)
SELECT x.doc_id, x.leaf, s.d AS subroot, root.d AS root, sha256(done.proof) AS proof_sha256, done.d AS folded_root, done.d = root.d AS verified
FROM x JOIN done USING (r) JOIN subs s ON s.i = x.t, (SELECT d FROM tops WHERE n = 1) root"""

ORACLE: dict[str, str] = {
    "op2_minhash": NEAR_DUPLICATES,
    "op4_decontamination": DECONTAMINATION,
    "op10_urls": URLS,
    "op11_mixing": MIXING,
    "op12_merkle": MERKLE,
}
