"""DuckDB SQL for the registered queries that SQL can express.

The others have brute-force tests: extraction, classifier, packing, personal data, pieces,
distances, canonical links and eigenvectors are not to be had from SQL.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: Nodes of a run, and heights written out: trees of FAN ** HEIGHTS leaves.
FAN, HEIGHTS = 8, 8

LINE_DEDUP = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM rows),
keyed AS (SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k GROUP BY r, doc_id"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

NEAR_DEDUP = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingled AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM worded),
sized AS (SELECT doc_id, len(s) AS n, s FROM shingled),
flat AS (SELECT doc_id, n, hash(x) AS h, x FROM (SELECT doc_id, n, unnest(s) AS x FROM sized)),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v FROM flat a JOIN flat b
  ON a.h = b.h AND a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, v FROM reach JOIN links ON b = u)
SELECT doc_id, n AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM sized JOIN reach ON a = doc_id GROUP BY doc_id, n"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: each byte comes with eight shifts."""
    bits = f"list_transform(range(0, 8 * length({text})), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr({text}, CAST(i // 8 + 1 AS BIGINT), 1)) ELSE 0 END::BIGINT)"
    step = "lambda c, x: CASE WHEN xor(c, x) % 2 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), {step}), 4294967295)"


def _leaf(text: str) -> str:
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', {c}) END"

    return f"sha256(concat({', '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))}))"


def _tree(name: str, leaves: str) -> str:
    """CTEs name_0 ... of a forest's heights (tree, p, d: place and digest; n: nodes of the tree), a lone node staying as it is."""
    ctes = [f"{name}_0 AS (SELECT tree, p, d, count(*) OVER (PARTITION BY tree) AS n FROM ({leaves}))"]
    for h in range(1, HEIGHTS + 1):
        ctes.append(
            f"{name}_{h} AS (SELECT tree, p // {FAN} AS p, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY p)) END AS d, "
            f"CAST(ceil(any_value(n) / {FAN}) AS BIGINT) AS n FROM {name}_{h - 1} GROUP BY tree, p // {FAN})")
    return ",\n".join(ctes)


def _path(name: str, rows: str) -> str:
    """CTEs that carry rows (tree, p, folded, proof and more) up a forest: siblings go to proof, folded becomes the node above."""
    ctes = [f"{name}_up_0 AS (SELECT * FROM {rows})"]
    for h in range(1, HEIGHTS + 1):
        ctes.append(f"""{name}_up_{h} AS (SELECT u.* EXCLUDE (p, folded, proof), u.p // {FAN} AS p,
  CASE WHEN k.n = 1 THEN u.folded ELSE sha256(concat(k.l, u.folded, k.r)) END AS folded,
  CASE WHEN k.n = 1 THEN u.proof ELSE concat(u.proof, k.l, k.r) END AS proof
  FROM {name}_up_{h - 1} u JOIN (
    SELECT tree, p, n, coalesce(string_agg(d, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(d, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name}_{h - 1} WINDOW run AS (PARTITION BY tree, p // {FAN} ORDER BY p)) k ON k.tree = u.tree AND k.p = u.p)""")
    return ",\n".join(ctes)


MERKLE = f"""
WITH leaves AS (SELECT doc_id, lang, concat(lang IS NULL, coalesce(lang, '')) AS tree, {_leaf('text')} AS leaf,
  CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS altered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
{_tree('low', 'SELECT tree, p, leaf AS d FROM placed')},
subroots AS (SELECT tree AS of, d AS subroot, '' AS tree, row_number() OVER (ORDER BY tree LIKE 'false%', encode(substr(tree, 5))) - 1 AS p FROM low_{HEIGHTS}),
{_tree('top', 'SELECT tree, p, subroot AS d FROM subroots')},
{_path('low', "(SELECT tree, p, coalesce(altered, leaf) AS folded, '' AS proof, doc_id, leaf FROM placed)")},
{_path('top', f"(SELECT s.tree, s.p, u.folded, u.proof, u.doc_id, u.leaf, s.subroot FROM low_up_{HEIGHTS} u JOIN subroots s ON s.of = u.tree)")}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified
FROM top_up_{HEIGHTS} JOIN (SELECT d FROM top_{HEIGHTS}) root ON true"""

#: Shards, virtual slots, and the CRC-32 of a list of bytes by the table of its 256 remainders.
SHARDS, SLOTS = 8, 8192
REMAINDERS = "list_transform(range(0, 256), lambda i: list_reduce(list_concat([i], range(0, 8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
SHARDING = f"""
WITH RECURSIVE remainders AS (SELECT {REMAINDERS} AS t),
texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (SELECT doc_id, size, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(0, length(h) // 2), lambda i: (('0x' || substr(h, 2 * i + 1, 2))::BIGINT))),
  lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM texts, remainders),
rows AS (SELECT *, CAST(('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), '-'), text_crc32)), 1, 8))::BIGINT % {SLOTS} AS INTEGER) AS virtual_slot FROM summed),
slots AS (SELECT virtual_slot AS v, virtual_slot % {SHARDS} AS s, sum(size) AS b FROM rows GROUP BY virtual_slot),
held AS (SELECT *, sum(b) OVER (PARTITION BY s ORDER BY b DESC, v) <= (SELECT sum(b) FROM slots) / {SHARDS} AS stays FROM slots),
pool AS (SELECT v, b, row_number() OVER (ORDER BY b DESC, v DESC) AS k FROM held WHERE NOT stays),
dealt AS (
  SELECT 0::BIGINT AS k, NULL::INTEGER AS v, NULL::BIGINT AS s, list_transform(range(0, {SHARDS}), lambda i: coalesce(loads[i], 0::HUGEINT)) AS l
  FROM (SELECT map_from_entries(list((s::BIGINT, b))) AS loads FROM (SELECT s, sum(b) AS b FROM held WHERE stays GROUP BY s))
  UNION ALL
  SELECT p.k, p.v, list_position(l, list_min(l)) - 1, list_transform(l, lambda x, i: CASE WHEN i = list_position(l, list_min(l)) THEN x + p.b ELSE x END)
  FROM dealt d JOIN pool p ON p.k = d.k + 1),
mapped AS (SELECT v, s FROM held WHERE stays UNION ALL SELECT v, s FROM dealt WHERE v IS NOT NULL)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(s AS INTEGER) AS shard, row_number() OVER (PARTITION BY s ORDER BY virtual_slot, doc_id NULLS FIRST) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, virtual_slot
FROM rows JOIN mapped ON v = virtual_slot"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_exact_dedup": EXACT_DEDUP,
    "op10_minhash_dedup": NEAR_DEDUP,
    "op11_merkle_manifest": MERKLE,
    "op13_slot_sharding": SHARDING,
}
