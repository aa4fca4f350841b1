"""SQL for DuckDB of the queries that SQL can express.

Packing and token counts need a tokenizer and the SimHash needs XXH64, which SQL has
not; these are tested against plain versions.
"""

from __future__ import annotations

from .licenses import RULES, SENTENCES
from .quality import STOP_WORDS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
D = "d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents)"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP2 = rf"""WITH {D},
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '{WORD}') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
g AS (SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g) WHERE n > 1),
k AS (SELECT rid, count(DISTINCT i + o) AS n FROM r, range(0, 3) t(o) GROUP BY rid),
s AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
 CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(k.n, 0) AS BIGINT) AS n_repeat_words,
 CAST(len(list_filter(words, lambda x: list_contains([{', '.join(map(_quoted, dict.fromkeys(STOP_WORDS)))}], x))) AS BIGINT) AS n_stop_words, CAST(len(lines) AS BIGINT) AS n_lines FROM w LEFT JOIN k USING (rid)),
f AS (SELECT *, n_words < 50 OR 100*n_repeat_words > 50*n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND word_chars BETWEEN 2*n_words AND 15*n_words AND n_symbols <= 0.1*n_words AND n_stop_words >= 0.05*n_words AND n_dup_lines <= 0.5*n_lines AS kept FROM f"""

OP4 = rf"""WITH {D},
z AS (SELECT doc_id, source, CAST(len(regexp_extract_all(text, '{WORD}')) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM d),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, 2.0::DOUBLE*source_size AS cap FROM s0),
s2 AS (SELECT *, (1.5::DOUBLE*CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap/w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap/w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS step FROM s1),
s3 AS (SELECT source, source_size, least(cap, max(step) OVER () * w) AS target FROM s2),
o AS (SELECT row_number() OVER () AS rid, z.source, z.doc_id, z.size, s3.source_size, s3.target, CAST(coalesce(sum(z.size) OVER (PARTITION BY z.source ORDER BY key, z.doc_id, z.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos FROM z JOIN s3 ON z.source IS NOT DISTINCT FROM s3.source),
b0 AS (SELECT source, source_size, CAST(floor(target) AS BIGINT) AS lim, (source_size + 1023) // 1024 AS blocks, CAST(floor(target) AS BIGINT) // nullif(source_size, 0) AS passes, CAST(floor(target) AS BIGINT) % nullif(source_size, 0) AS over FROM s3),
b1 AS (SELECT *, CAST(passes*blocks + (over + 1023) // 1024 AS BIGINT) AS slots FROM b0 WHERE lim > 0),
b2 AS (SELECT *, CAST(sum(slots) OVER () AS BIGINT) AS total, CAST(sum(slots) OVER (ORDER BY source NULLS FIRST) AS BIGINT) AS upto FROM b1),
b3 AS (SELECT *, floor((upto - slots)/CAST(total AS DOUBLE)*281474976710656.0::DOUBLE) AS lo, floor(upto/CAST(total AS DOUBLE)*281474976710656.0::DOUBLE) AS hi FROM b2),
u AS (SELECT k, list_sum(list_transform(range(0, 48), lambda i: ((k >> i) & 1)*pow(2.0::DOUBLE, 47 - i))) AS u FROM range(0, (SELECT max(total) FROM b3)) t(k)),
y AS (SELECT b3.*, k AS position, row_number() OVER (PARTITION BY source ORDER BY k) - 1 AS rank FROM u JOIN b3 ON u >= lo AND u < hi),
h AS (SELECT source, count(*) AS have FROM y GROUP BY source),
t AS (SELECT source, blocks, passes, over, position, rank FROM y WHERE rank < slots UNION ALL
 SELECT source, blocks, passes, over, total + r, r FROM (SELECT b3.*, unnest(range(coalesce(have, 0), slots)) AS r FROM b3 LEFT JOIN h ON b3.source IS NOT DISTINCT FROM h.source)),
a AS (SELECT source, position, rank % blocks AS block, CASE WHEN rank // blocks < passes THEN 1024 ELSE least(1024, over - (rank % blocks)*1024) END AS words FROM t),
f AS (SELECT rid, sum(least(pos + size, block*1024 + words) - greatest(pos, block*1024)) AS taken, min(position) AS first_position FROM o JOIN a ON o.source IS NOT DISTINCT FROM a.source AND pos < block*1024 + words AND pos + size > block*1024 GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(first_position AS BIGINT) AS first_position FROM o LEFT JOIN f USING (rid)"""


def _escaped(x: str) -> str:
    out = f"replace({x}, chr(92), chr(92) || chr(92))"
    for control, letter in (("###", "h"), ("</turn>", "e"), (":", "c")):
        out = f"replace({out}, {_quoted(control)}, chr(92) || {_quoted(letter)})"
    return out


OP5 = rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(14 + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars,
 regexp_full_match(string_agg(role || ',', '' ORDER BY turn NULLS FIRST, role, text), '(system,)?(user,assistant,)*(user,)?') AND NOT string_agg(role || ',', '' ORDER BY turn NULLS FIRST, role, text) = '' AS valid
FROM c GROUP BY conv_id"""

OP6 = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024*CAST(x AS DOUBLE))) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


def _op7() -> str:
    def is_known(s: str, pattern: str) -> str:
        words = _quoted(pattern.strip("* "))
        return f"{s} = {words}" + (f" OR ends_with({s}, ' ' || {words})" if pattern[0] == "*" else "") + (f" OR starts_with({s}, {words} || ' ')" if pattern[-1] == "*" else "")

    longest = sorted(SENTENCES.items(), key=lambda x: -len(x[1].strip("* ")))
    known = "CASE " + " ".join(f"WHEN {is_known('s', v)} THEN {_quoted(k)}" for k, v in longest) + " END"
    low = f"replace(translate(text, '{UPPER}', '{LOWER}'), 'spdx-license-identifier:', 'spdx-license-identifier ')"
    # a full stop ends a sentence only before white space or the end, so such stops become line ends first
    cut = rf"regexp_split_to_array(regexp_replace(regexp_replace({low}, '[.!?]+([\x20\x09-\x0D])', chr(10) || '\1', 'g'), '[.!?]+$', '', 'g'), '[\n;:]+')"
    norm = f"list_transform({cut}, lambda s: trim(regexp_replace(s, '[^a-z0-9./-]+', ' ', 'g'), ' '))"
    ids = f"list_filter(list_transform({norm}, lambda s: {known}), lambda x: x IS NOT NULL)"
    # rules one after another over the list itself: every place where the run begins is emptied
    rules = ", ".join(f"({n}, {_quoted(name)}, [{', '.join(map(_quoted, run))}])" for n, (name, run) in enumerate(RULES))
    first = {name: n for n, (name, _) in reversed(list(enumerate(RULES)))}
    order = "CASE name " + " ".join(f"WHEN {_quoted(k)} THEN {n}" for k, n in first.items()) + " END"
    begins = "list_filter(range(1, len(ids) + 1), lambda i: ids[i:i + len(run) - 1] = run)"
    gone = "list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN len(list_filter(places, lambda p: i BETWEEN p AND p + len(run) - 1)) > 0 THEN '-' ELSE ids[i] END)"
    return f"""WITH RECURSIVE {D}, i AS (SELECT rid, doc_id, {ids} AS ids FROM d), r(n, name, run) AS (VALUES {rules}),
x AS (SELECT rid, 0 AS n, ids, CAST(NULL AS VARCHAR) AS hit FROM i WHERE len(ids) > 0 UNION ALL
 SELECT rid, n + 1, {gone}, CASE WHEN len(places) > 0 THEN name END FROM (SELECT x.rid, x.n, x.ids, r.name, r.run, {begins} AS places FROM x JOIN r ON r.n = x.n)),
o AS (SELECT rid, string_agg(name, ' ' ORDER BY {order}) AS licenses FROM (SELECT DISTINCT rid, hit AS name FROM x WHERE hit IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ' ') AS sentence_ids, coalesce(o.licenses, '') AS licenses FROM i LEFT JOIN o USING (rid)"""


OP8 = f"""WITH {D}, b AS (SELECT rid, doc_id, encode(text) AS b FROM d), w AS (SELECT rid, i, b[i:i + 199] AS s FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 198)) AS i FROM b WHERE octet_length(b) >= 200)),
t AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY s) AS n FROM w) WHERE n > 1),
n AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM t),
g AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM n), r AS (SELECT rid, k, min(i) AS lo, max(i) + 199 AS hi FROM g GROUP BY rid, k),
e AS (SELECT rid, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) + 1 AS a, lo - 1 AS z, lo FROM r UNION ALL SELECT rid, max(hi) + 1, NULL, 9223372036854775807 FROM r GROUP BY rid),
x AS (SELECT e.rid, string_agg(CASE WHEN a <= coalesce(z, octet_length(b)) THEN hex(b[a:coalesce(z, octet_length(b))]) ELSE '' END, '' ORDER BY lo) AS h FROM e JOIN b USING (rid) GROUP BY e.rid),
c AS (SELECT rid, sum(hi - lo + 1) AS n_removed, count(*) AS n_spans FROM r GROUP BY rid)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(CASE WHEN h IS NULL THEN b ELSE unhex(h) END) AS kept_sha256
FROM b LEFT JOIN c USING (rid) LEFT JOIN x USING (rid)"""

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP10 = f"""WITH {D}, l AS (SELECT rid, doc_id, i, lines[i] AS line, translate(trim(lines[i], {_WHITE}), '{UPPER}', '{LOWER}') AS key FROM (SELECT rid, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT rid, doc_id, string_split(text, chr(10)) AS lines FROM d))),
k AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(k.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (k.key IS NULL), '')) AS kept_sha256 FROM l LEFT JOIN k USING (key) GROUP BY rid, doc_id"""


#: CRC-32 of a text of ASCII characters, by its polynomial, a bit at a time.
def _crc32(s: str) -> str:
    steps = f"flatten(list_transform(range(1, length({s}) + 1), lambda i: [CAST(ascii({s}[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce(list_concat([4294967295], {steps}), lambda a, b: {step}), 4294967295)"


OP11 = f"""WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(role) || md5(text))) AS p, md5(role) || md5(text) AS m, length(text) AS n
 FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('s')} % 6 AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)),
k AS (SELECT c.*, least(h, coalesce(z.size, 0)) AS taken FROM c LEFT JOIN (SELECT conv_id, count(*) AS size FROM t GROUP BY conv_id) z ON z.conv_id = c.base),
r AS (SELECT conv_id, p, m, n FROM t WHERE conv_id % 100 = 0 UNION ALL SELECT k.conv_id, p, m, n FROM k JOIN t ON t.conv_id = base AND p <= taken WHERE k.conv_id <> base
 UNION ALL SELECT k.conv_id, p - h + taken, m, n FROM k JOIN t USING (conv_id) WHERE conv_id <> base AND p > h),
x AS (SELECT conv_id, p, n, md5(string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY p)) AS key FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM k),
y AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY p) AS up, p = max(p) OVER (PARTITION BY conv_id) AS last FROM x),
o AS (SELECT key, min(p) AS depth, min(conv_id) AS conv_id, min(up) AS up, count(*) AS n_convs, min(n) AS n, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last) AS ends FROM y GROUP BY key),
d AS (SELECT o.*, coalesce(q.n_children, 0) AS n_children FROM o LEFT JOIN (SELECT up AS key, count(*) AS n_children FROM o WHERE up IS NOT NULL GROUP BY up) q USING (key)),
s AS (SELECT y.key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * d.n) AS saved FROM d JOIN y ON y.conv_id = d.conv_id AND y.p <= d.depth GROUP BY y.key)
SELECT d.conv_id, d.depth, u.conv_id AS parent_conv_id, d.n_convs, d.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(d.ends, '')) AS ends_sha256
FROM d JOIN s USING (key) LEFT JOIN d u ON u.key = d.up"""

_RUN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP12 = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_RUN}'), []) AS w FROM documents),
i AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_RUN}'), []) AS w FROM benchmark),
r AS (SELECT DISTINCT item_id, m, array_to_string(w[k:k + m - 1], ' ') AS run FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM (SELECT *, least(10, len(w)) AS m FROM i WHERE len(w) > 0))),
p AS (SELECT rid, k, m, array_to_string(w[k:k + m - 1], ' ') AS run FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM r) WHERE len(w) >= m)),
o AS (SELECT DISTINCT rid, k, m FROM p SEMI JOIN r USING (m, run)), h AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(k, k + m)) AS k FROM o) GROUP BY rid),
f AS (SELECT rid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT rid, item_id FROM p JOIN r USING (m, run)) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN f USING (rid)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": OP2,
        "op4_source_mixing": OP4,
        "op5_chat_format": OP5,
        "op6_exact_top_k": OP6,
        "op7_license_scan": _op7(),
        "op8_suffix_dedup": OP8,
        "op10_line_dedup": OP10,
        "op11_prefix_trie": OP11,
        "op12_decontamination": OP12,
    }
