"""DuckDB SQL of the queries that SQL can express on whole tables."""

_EXACT_DEDUP = r"""
WITH hashed AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept,
       text_sha256
FROM hashed
WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""

# CRC-32 byte by byte from the table of its polynomial; DuckDB has no such function.
_IMPORTANCE_RESAMPLING = r"""
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), texts AS (
    SELECT 'corpus' AS side, doc_id AS id, text FROM documents
    UNION ALL SELECT 'target', item_id, text FROM benchmark
), words AS (
    SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), found AS (
    SELECT side, id, feature, count(*) AS n
    FROM (SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words)
    GROUP BY ALL
), bytes AS (
    SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM found)
), coded AS (
    SELECT feature, list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b FROM bytes
), bucketed AS (
    SELECT feature, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, steps[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
    FROM coded, crc
), held AS (
    SELECT bucket, sum(n) FILTER (side = 'target') AS t, sum(n) FILTER (side = 'corpus') AS s
    FROM found JOIN bucketed USING (feature) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(s), 0) FROM held)::DOUBLE + 10000)
               / ((coalesce(s, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(t), 0) FROM held)::DOUBLE + 10000))))::BIGINT AS gain
    FROM held
), weighed AS (
    SELECT id, sum(n) AS n, sum(n * gain) AS total
    FROM found JOIN bucketed USING (feature) JOIN gains USING (bucket)
    WHERE side = 'corpus' GROUP BY id
), scored AS (
    SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
           CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE floor(total::DOUBLE / n)::BIGINT END AS weight,
           floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
    FROM words LEFT JOIN weighed USING (id) WHERE side = 'corpus'
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""


def _coded(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_coded(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, first: str) -> str:
    """All nodes of the trees whose leaves are ``first``, and what stands left and right of each in its run."""
    run = "PARTITION BY tree, level, pos // 3 ORDER BY pos ROWS BETWEEN"
    return f"""{name} AS (
    SELECT 0 AS level, tree, pos, size, digest FROM {first}
    UNION ALL
    SELECT level + 1, tree, pos // 3, any_value((size + 2) // 3), sha256(string_agg(digest, '' ORDER BY pos))
    FROM {name} WHERE size > 1 GROUP BY level, tree, pos // 3
), {name}_steps AS (
    SELECT *, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name}
)"""


def _walk(name: str, start: str, steps: str) -> str:
    """From the nodes of ``start`` up to their trees' roots."""
    return f"""{name} AS (
    SELECT 0 AS level, * FROM {start}
    UNION ALL
    SELECT w.level + 1, doc_id, w.tree, w.pos // 3, sha256(l || folded || r), proof || l || r
    FROM {name} w JOIN {steps} s ON s.level = w.level AND s.tree = w.tree AND s.pos = w.pos
    WHERE s.size > 1
)"""


# An even CRC-32 of the decimal id: the bit by bit form, over the id's ASCII digits.
_CRC = """list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))"""

_MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('s' || source, '') AS tree,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size,
           {_leaf("text")} AS digest,
           CASE WHEN xor({_CRC}, 4294967295) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS found
    FROM documents
), {_levels("nodes", "leaves")}, tops AS (
    SELECT tree AS name, digest, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1
), {_levels("upper", "tops")}, first_walk AS (
    SELECT doc_id, tree, pos, found AS folded, '' AS proof FROM leaves
), {_walk("lower_walk", "first_walk", "nodes_steps")}, at_subroot AS (
    SELECT w.doc_id, w.tree AS name, w.folded, w.proof, n.digest AS subroot
    FROM lower_walk w JOIN nodes n ON n.level = w.level AND n.tree = w.tree AND n.pos = w.pos WHERE n.size = 1
), second_walk AS (
    SELECT doc_id, t.tree, t.pos, folded, proof FROM at_subroot a JOIN tops t ON t.name = a.name
), {_walk("upper_walk", "second_walk", "upper_steps")}, done AS (
    SELECT w.*, n.digest AS root FROM upper_walk w JOIN upper n ON n.level = w.level AND n.pos = w.pos WHERE n.size = 1
)
SELECT doc_id, leaves.digest AS leaf, subroot, root, sha256(done.proof) AS proof_sha256, done.folded AS folded_root, done.folded = root AS verified
FROM leaves JOIN at_subroot USING (doc_id) JOIN done USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op11_exact_dedup": _EXACT_DEDUP,
    "op12_importance_resampling": _IMPORTANCE_RESAMPLING,
    "op13_merkle_manifest": _MERKLE_MANIFEST,
}
