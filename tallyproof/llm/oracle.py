"""SQL for DuckDB that gives the rows of the queries which can be written in it."""

OP2 = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
    SELECT r, doc_id, i, list_aggregate(w[i : i + 12], 'string_agg', ' ') AS words
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
),
lowest AS (SELECT words, min(doc_id) AS least FROM windows GROUP BY words),
hit AS (
    SELECT DISTINCT r, unnest(range(i, i + 13)) AS place
    FROM windows JOIN lowest USING (words) WHERE doc_id > least
),
gone AS (SELECT r, list(place) AS places FROM hit GROUP BY r),
kept AS (
    SELECT doc_id, w, list_filter(w, lambda x, i: NOT list_contains(coalesce(places, []), i)) AS k
    FROM words LEFT JOIN gone USING (r)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(k) AS BIGINT) AS n_removed,
       sha256(coalesce(list_aggregate(k, 'string_agg', ' '), '')) AS kept_sha256
FROM kept
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'
),
marked AS (
    SELECT *, role = 'assistant' AS learnt,
           length(role) + len(regexp_extract_all(role, '<\\*\|')) AS role_chars,
           length(text) + len(regexp_extract_all(text, '<\\*\|')) AS text_chars,
           len(regexp_extract_all(role, '[\\\n]')) + len(regexp_extract_all(role, '<\\*\|')) AS doubled
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (learnt), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (learnt), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + role_chars + doubled + 1 + text_chars + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP5 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(%s, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
""" % _LOWER.format("coalesce(text, '')")

OP7 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
searched AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS said
    FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM searched),
windows AS (
    SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS said
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs JOIN sizes ON size <= len(w))
),
hits AS (SELECT r, i, w.size AS size, item_id FROM windows w JOIN searched s ON w.size = s.size AND w.said = s.said),
words_hit AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r
),
items_hit AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)
""" % (_LOWER.format("coalesce(text, '')"), _LOWER.format("coalesce(text, '')"))


def _secrets() -> str:
    """The base kinds, the strong strings, and what few owners have of either."""
    patterns = {
        "assign": r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]{16,}",
        "hex": r"[0-9a-f]{24,}",
        "strong": r"[A-Za-z0-9+/_-]{20,}={0,2}",
    }
    scans = [
        f"SELECT r, source, {rank} AS rank, '{kind}' AS kind, regexp_extract_all(t, '{p}') AS m, "
        f"regexp_extract_all(t, '{p}', {2 if kind == 'assign' else 0}) AS v, regexp_split_to_array(t, '{p}') AS gaps FROM docs"
        for rank, (kind, p) in enumerate(patterns.items())
    ]
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
scans AS ({' UNION ALL '.join(scans)}),
matches AS (
    SELECT r, source, rank, kind, unnest(m) AS m, unnest(v) AS v, unnest(gaps[1 : len(m)]) AS gap, unnest(range(len(m))) AS i
    FROM scans WHERE len(m) > 0
),
placed AS (
    SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY r, rank ORDER BY i) AS BIGINT) AS stop FROM matches
),
base AS (
    SELECT r, source, rank, kind, v, stop - length(m) AS begin, stop FROM placed
    WHERE kind <> 'strong' AND (kind <> 'assign' OR length(v) >= 6)
),
strong AS (
    SELECT r, source, rank, kind, v, stop - length(m) AS begin, stop FROM placed p
    WHERE kind = 'strong' AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = p.r AND b.begin < p.stop AND b.stop > p.stop - length(p.m))
),
found AS (FROM base UNION ALL FROM strong),
few AS (SELECT v FROM (SELECT DISTINCT v, source FROM found) GROUP BY v HAVING count(*) < 3),
spans AS (
    SELECT r, begin, rank, stop, kind FROM base
    UNION ALL
    SELECT DISTINCT r, stop - length(v), 3, stop, 'live' FROM found JOIN few USING (v)
),
listed AS (
    SELECT r, string_agg(concat_ws(':', kind, begin, stop), ',' ORDER BY begin, rank, stop) AS spans,
           string_agg(concat_ws(':', kind, begin, stop), ',' ORDER BY begin, rank, stop) FILTER (rank < 3) AS base,
           count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex
    FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of code points below 2,048, bit by bit."""
    first, last = "192 + (unicode(x) >> 6)", "128 + (unicode(x) & 63)"
    octets = f"CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [{first}, {last}] END"
    steps = f"flatten(list_transform(flatten(list_transform(string_split({text}, ''), lambda x: {octets})), lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform({steps}, lambda b: CAST(b AS BIGINT))), lambda c, v: {step}), 4294967295)"


def _manifest() -> str:
    def leaf(text: str) -> str:
        values = [*(f"CAST({name} AS VARCHAR)" for name in ("doc_id", "source", "lang", "n_chars")), text]
        return f"sha256({' || '.join(f'''coalesce(strlen({v}) || ':' || {v}, '-')''' for v in values)})"

    def tree(nodes: str, leaves: str) -> str:
        return f"""
{nodes}(tree, level, spot, digest, n) AS (
    SELECT tree, 0, spot, digest, n FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, spot // 16, sha256(string_agg(digest, '' ORDER BY spot)), (any_value(n) + 15) // 16
    FROM {nodes} WHERE n > 1 GROUP BY tree, level, spot // 16
),
{nodes}_runs AS (SELECT tree, level, spot // 16 AS run, list(digest ORDER BY spot) AS digests FROM {nodes} WHERE n > 1 GROUP BY ALL)"""

    def climb(name: str, start: str, runs: str) -> str:
        before, after = "array_to_string(digests[1 : spot % 16], '')", "array_to_string(digests[spot % 16 + 2 : 16], '')"
        return f"""
{name}(r, tree, level, spot, folded, proof) AS (
    SELECT r, tree, 0, spot, folded, proof FROM ({start})
    UNION ALL
    SELECT c.r, c.tree, c.level + 1, c.spot // 16, sha256({before} || c.folded || {after}), c.proof || {before} || {after}
    FROM {name} c JOIN {runs} x ON x.tree = c.tree AND x.level = c.level AND x.run = c.spot // 16
),
{name}_top AS (SELECT r, tree, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM {name} GROUP BY r, tree)"""

    lowered = f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_LOWER.format('text')} ELSE text END"
    return f"""
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, doc_id, source, {leaf('text')} AS leaf, {leaf(f'({lowered})')} AS changed FROM documents
),
leaves AS (
    SELECT r, doc_id, leaf, changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, leaf AS digest,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot, count(*) OVER (PARTITION BY source) AS n
    FROM rows
),
{tree('nodes', 'leaves')},
subroots AS (SELECT -1 AS tree, tree AS spot, digest, count(*) OVER () AS n FROM nodes WHERE n = 1),
{tree('tops', 'subroots')},
{climb('low', "SELECT r, tree, spot, changed AS folded, '' AS proof FROM leaves", 'nodes_runs')},
{climb('high', "SELECT r, -1 AS tree, tree AS spot, folded, proof FROM low_top", 'tops_runs')}
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = t.digest AS verified
FROM leaves l JOIN high_top h USING (r) JOIN subroots s ON s.spot = l.tree JOIN tops t ON t.n = 1
"""


def _spelling() -> str:
    return f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
),
said AS (
    SELECT doc_id, {_LOWER.format('run')} AS word, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
),
hashed AS (SELECT word, n, {_crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word)")} AS h FROM said),
typed AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(word, CAST(h % length(word) AS INTEGER)) || substr(word, CAST(h % length(word) AS INTEGER) + 2)
           ELSE word END AS word, n
    FROM hashed
),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
shorter AS (
    SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1))::INTEGER AS i FROM words)
),
near AS (
    SELECT a.word AS word, b.word AS other FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT s.word, w.word FROM shorter s JOIN words w ON w.word = s.rest
    UNION
    SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
),
ranked AS (
    SELECT near.word, other, w.n, count(*) OVER (PARTITION BY near.word) AS n_near,
           row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) AS place
    FROM near JOIN words w ON w.word = other
),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN f.n >= 10 * w.n THEN other END AS form,
           CASE WHEN f.n >= 10 * w.n THEN f.n END AS form_n
    FROM words w LEFT JOIN ranked f ON f.word = w.word AND place = 1
),
followed(word, spot) AS (
    SELECT word, word FROM forms
    UNION ALL
    SELECT c.word, f.form FROM followed c JOIN forms f ON f.word = c.spot WHERE f.form IS NOT NULL
),
roots AS (SELECT c.word, c.spot AS root FROM followed c JOIN forms f ON f.word = c.spot WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": OP1,
        "op2_substring_dedup": OP2,
        "op5_ngram_jaccard": OP5,
        "op7_decontaminate": OP7,
        "op8_secrets": _secrets(),
        "op11_merkle_manifest": _manifest(),
        "op13_spelling": _spelling(),
    }
