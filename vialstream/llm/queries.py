"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import decontaminate, fingerprints, language, lm, manifest, mixing, neardup, pii, quality, search, substrings, suffixes, tokens


def queries() -> dict:
    return {
        "op1_quality": quality.op1_quality,
        "op2_near_duplicates": neardup.op2_near_duplicates,
        "op3_decontaminate": decontaminate.op3_decontaminate,
        "op9_mix": mixing.op9_mix,
        "op4_fingerprints": fingerprints.op4_fingerprints,
        "op5_repeated_strings": suffixes.op5_repeated_strings,
        "op6_lm_score": lm.op6_lm_score,
        "op7_pii": pii.op7_pii,
        "op8_tokens": tokens.op8_tokens,
        "op10_language": language.op10_language,
        "op11_substrings": substrings.op11_substrings,
        "op12_manifest": manifest.op12_manifest,
        "op13_search": search.op13_search,
    }


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m.m, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) m USING (doc_id)"""

DECONTAMINATE = f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
v AS (SELECT item_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS v FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(v), 10) AS n, array_to_string(v[i:i+9], ' ') AS s FROM (SELECT item_id, v, unnest(range(1, greatest(len(v) - 8, 2))) AS i FROM v WHERE len(v) > 0)),
hit AS (SELECT DISTINCT d.doc_id, d.i, d.n, win.item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS s FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM win))) d JOIN win ON d.s = win.s AND d.n = win.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS sha FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM w LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)"""

REPEATED_STRINGS = """WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS m FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS p FROM b WHERE n >= 100)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS r FROM p) WHERE r > 1),
isle AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM dup)),
run AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM isle GROUP BY doc_id, g),
gap AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS s, s AS e FROM (SELECT * FROM run UNION ALL SELECT doc_id, n, n FROM b)),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS x FROM gap JOIN b USING (doc_id) GROUP BY doc_id),
t AS (SELECT doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
SELECT b.doc_id, b.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.x)) AS kept_sha256 FROM b JOIN kept USING (doc_id) LEFT JOIN t USING (doc_id)"""

SUBSTRINGS = """WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, -9223372036854775808) AS id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT rid, id, i, md5(array_to_string(w[i:i+12], ' ')) AS s FROM (SELECT rid, id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least AS (SELECT s, min(id) AS id FROM win GROUP BY s),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (s) WHERE win.id > least.id),
word AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_BITS = "list_transform(range(8 * len(coalesce(doc_id::VARCHAR, ''))), lambda i: (ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) >> (i % 8)::INTEGER) & 1)"
_ODD = f"(list_reduce(list_concat([4294967295], {_BITS})::BIGINT[], lambda c, b: xor(c >> 1, xor(c & 1, b) * 3988292384)) & 1) = 0"
_STEP = "array_to_string(hs[:pos % 3], '')", "array_to_string(hs[pos % 3 + 2:], '')"

MANIFEST = f"""WITH RECURSIVE leaf AS (SELECT row_number() OVER () AS rid, doc_id, source, {_LEAF.format("text")} AS leaf, CASE WHEN {_ODD} THEN {_LEAF.format("text")} ELSE {_LEAF.format("replace(text, chr(10), '')")} END AS other FROM documents),
base AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaf),
node AS (SELECT source, 0 AS lvl, pos, leaf AS h, n FROM base UNION ALL SELECT source, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM node WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
run AS (SELECT source, lvl, pos // 3 AS r, list(h ORDER BY pos) AS hs FROM node WHERE n > 1 GROUP BY ALL),
sub AS (SELECT source, lvl, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
high AS (SELECT 0 AS lvl, pos, subroot AS h, n FROM sub UNION ALL SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
hrun AS (SELECT lvl, pos // 3 AS r, list(h ORDER BY pos) AS hs FROM high WHERE n > 1 GROUP BY ALL),
walk AS (SELECT rid, source, 0 AS lvl, pos, '' AS proof, other AS cur FROM base UNION ALL
SELECT rid, w.source, w.lvl + 1, pos // 3, proof || {_STEP[0]} || {_STEP[1]}, sha256({_STEP[0]} || cur || {_STEP[1]}) FROM walk w JOIN run ON run.source IS NOT DISTINCT FROM w.source AND run.lvl = w.lvl AND r = pos // 3),
up AS (SELECT rid, subroot, 0 AS lvl, sub.pos, proof, cur FROM walk JOIN sub ON sub.source IS NOT DISTINCT FROM walk.source AND sub.lvl = walk.lvl UNION ALL
SELECT rid, subroot, u.lvl + 1, pos // 3, proof || {_STEP[0]} || {_STEP[1]}, sha256({_STEP[0]} || cur || {_STEP[1]}) FROM up u JOIN hrun ON hrun.lvl = u.lvl AND r = pos // 3)
SELECT doc_id, leaf, subroot, high.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = high.h AS verified FROM up JOIN high ON high.n = 1 AND high.lvl = up.lvl JOIN base USING (rid)"""

_TERMS = f"list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

SEARCH = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
g AS (SELECT count(*) AS nn, sum(len(w))::BIGINT AS ll FROM d WHERE len(w) > 0),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT qid, item_id, t, count(*) AS times FROM (SELECT row_number() OVER () AS qid, item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
s AS (SELECT qid, item_id, rid, sum(times * floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * nn) // ll))))::BIGINT AS score FROM q JOIN tf USING (t) JOIN df USING (t) JOIN d USING (rid), g GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM s JOIN d USING (rid) WHERE score > 0) WHERE rank <= 20"""


def oracle_sql() -> dict[str, str]:
    """Learned models, the tokenizer and seeded draws are no SQL; tests hold those against brute force."""
    return {"op2_near_duplicates": NEAR_DUPLICATES, "op3_decontaminate": DECONTAMINATE, "op5_repeated_strings": REPEATED_STRINGS, "op11_substrings": SUBSTRINGS, "op12_manifest": MANIFEST, "op13_search": SEARCH}
