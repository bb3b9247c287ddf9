"""DuckDB SQL for the operators that SQL can express."""

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS l FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS k
            FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM b)),
lengths AS (SELECT DISTINCT l FROM b),
places AS (SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS k
           FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lengths)),
hits AS (SELECT doc_id, i, l, item_id FROM places JOIN windows USING (l, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5(doc_id::VARCHAR || ':mix:42'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
             source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, CASE WHEN level * w >= cap THEN cap
             ELSE w * max(CASE WHEN level * w < cap THEN level END) OVER () END AS target FROM l),
c AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS copies
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, floor(copies) AS whole, copies - floor(copies) AS p, target - floor(copies) * source_size AS need FROM c),
r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN p > 1e-12 AND before + size / 2.0 <= need THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""

OP9 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to FROM g
"""

OP11 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, e.vec_id, e.label, list_dot_product(a.v, e.v)::BIGINT AS score
      FROM e AS a JOIN e ON e.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def _edit(state: str, cost: str, letter: str, turn: str | None = None) -> str:
    turns = f"({state}).t" if turn is None else f"list_append(({state}).t, {turn})"
    return f"{{'c': ({state}).c + {cost}, 'a': ({state}).a || '{letter}', 't': {turns}}}"


def _least(*states: str) -> str:
    return f"list_sort([{', '.join(states)}])[1]"


def _op12() -> str:
    """States z (nothing yet), s, u, a hold (cost, audit, repaired turns); u1 and a1 are u and a with inserts added."""
    free = "NOT gone AND"
    stay = "role || ':' || text"
    far = "{'c': 1000000000::BIGINT, 'a': '', 't': []::VARCHAR[]}"
    key = "coalesce({}::VARCHAR, ' ')"
    return rf"""
WITH RECURSIVE f AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295::BIGINT],
               list_transform(string_split({key.format('conv_id')} || ':' || {key.format('turn')}, ''), lambda x: ord(x)::BIGINT)),
             lambda h, b: list_reduce(list_concat([xor(h, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
               lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS fault
  FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
      FROM f WHERE fault <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             NOT regexp_matches(text, '[^ 	-
]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
             NOT regexp_matches(text, '[.!?][ 	-
]*$') AS late,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) || substr(role, 1, 1) AS pair
      FROM d),
n AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
             count(*) FILTER (NOT blank AND NOT again AND late) AS truncated,
             count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
q AS (SELECT conv_id, i, role, text, substr(role, 1, 1) AS k, blank OR again AS gone, late::INT AS x FROM r),
w AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS z, {far} AS s, {far} AS u, {far} AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i,
         {_edit('z', '3', 'D')},
         CASE WHEN {free} k = 's' THEN {_least(_edit('s', '3', 'D'), _edit('z', 'x', 'K', stay))} ELSE {_edit('s', '3', 'D')} END,
         CASE WHEN gone THEN {_edit('u1', '3', 'D')}
              WHEN k = 'u' THEN {_least(_edit('u1', '3', 'D'), *[_edit(p, 'x + 2', 'R', "'user:' || text") for p in ('z', 's', 'a1')],
                                        *[_edit(p, 'x', 'K', stay) for p in ('z', 's', 'a1')])}
              ELSE {_least(_edit('u1', '3', 'D'), *[_edit(p, 'x + 2', 'R', "'user:' || text") for p in ('z', 's', 'a1')])} END,
         CASE WHEN gone THEN {_edit('a1', '3', 'D')}
              WHEN k = 'a' THEN {_least(_edit('a1', '3', 'D'), _edit('u1', 'x + 2', 'R', "'assistant:' || text"),
                                        _edit('u1', 'x', 'K', stay))}
              ELSE {_least(_edit('a1', '3', 'D'), _edit('u1', 'x + 2', 'R', "'assistant:' || text"))} END
  FROM (SELECT w.conv_id, q.i, role, text, k, gone, x, z, s, u1, {_least('a', _edit('u1', '2', 'I', "'assistant:'"))} AS a1
        FROM (SELECT *, {_least('u', *[_edit(p, '2', 'I', "'user:'") for p in ('z', 's', 'a')])} AS u1 FROM w) AS w
        JOIN q ON q.conv_id IS NOT DISTINCT FROM w.conv_id AND q.i = w.i + 1) AS step(conv_id, i, role, text, k, gone, x, z, s, u1, a1)),
e AS (SELECT w.conv_id, n.* EXCLUDE (conv_id), {_least('z', 'a', _edit('u', '2', 'I', "'assistant:'"),
                                    _edit(_edit('s', '2', 'I', "'user:'"), '2', 'I', "'assistant:'"))} AS best
      FROM w LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.i = coalesce(n.n, 0))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(array_to_string(best.t, chr(10))) AS repaired_sha256 FROM e
"""


OP12 = _op12()

ORACLES = {"op4_decontaminate": OP4, "op6_pareto_mix": OP6, "op9_warc": OP9, "op11_hard_negatives": OP11,
           "op12_conversations": OP12}
