"""DuckDB SQL for the queries that SQL can express.

Not expressible: compressed sizes (op3), trained models (op8), tokenizer ids (op6), the
forest (op4), keyed draws with collision rounds (op9), a CRC of a key (op11). These are
tested against brute force.
"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?(?:INST|SYS|ROLE)\])', '\1\\\2\3', 'g')) AS body,
    length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?(?:INST|SYS|ROLE)\])', '\1\\\2\3', 'g')) AS name
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(body + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 5 ELSE 18 + name END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

SHARDS = r"""
WITH rows AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), levels AS (
  SELECT d AS depth, h >> (60 - d) AS prefix, sum(bytes) AS b, count(*) AS n
  FROM rows, (SELECT CAST(unnest(range(0, 61)) AS INTEGER) AS d) GROUP BY 1, 2
), fit AS (
  SELECT depth, prefix, b, n FROM levels WHERE b <= 1048576 OR n = 1 OR depth = 60
), placed AS (
  SELECT r.doc_id, r.bytes, f.depth, f.prefix, f.b, f.n, row_number() OVER (PARTITION BY r.h ORDER BY f.depth) AS rn
  FROM rows r JOIN fit f ON f.prefix = r.h >> (60 - f.depth)
)
SELECT doc_id, bytes, depth, prefix, CAST(0 AS BIGINT) AS page, CAST(b AS BIGINT) AS shard_bytes, n AS shard_rows
FROM placed WHERE rn = 1
"""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), placed AS (
  SELECT *, CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)), 1, 12) AS BIGINT)
    % (2 * (1 + (SELECT count(*) FROM sized) // 100000)) AS block,
    length(bin(size + 1)) * 4 + (((size + 1) * 4 >> (length(bin(size + 1)) - 1)) & 3) AS class
  FROM sized
), numbered AS (
  SELECT doc_id, source, size, row_number() OVER (
    PARTITION BY source ORDER BY block % 2, CASE block % 2 WHEN 1 THEN -class ELSE class END, block,
    CASE block % 2 WHEN 1 THEN -size ELSE size END, doc_id NULLS FIRST) AS n
  FROM placed
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS rnk
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(CASE (rnk - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS w,
    source_size * CAST(2 AS DOUBLE) AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS total
  FROM by_source
), levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM weighed
), topped AS (
  SELECT source, source_size, w, cap, max(CASE WHEN lev < cap / w THEN lev END) OVER () AS lev FROM levels
), goal AS (
  SELECT source, source_size, CASE WHEN lev IS NULL OR cap / w <= lev THEN cap ELSE w * lev END AS target,
    CAST(CAST('0x' || substr(sha256('mix-1' || coalesce('=' || source, 'null')), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656 AS off
  FROM topped
), dealt AS (
  SELECT n.doc_id, n.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate, g.off, n.n
  FROM numbered n JOIN goal g ON n.source IS NOT DISTINCT FROM g.source
), counted AS (
  SELECT *, CAST(floor(n * rate + off) AS BIGINT) - CAST(floor((n - 1) * rate + off) AS BIGINT) AS copies FROM dealt
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM counted
"""


PHRASES = r"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), piece AS (
  SELECT lang, d, unnest(range(1, len(pieces) + 1)) AS i, unnest(pieces) AS piece FROM cut
), listed AS (
  SELECT lang, d, i, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM piece
), word AS (
  SELECT lang, d, i, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS a FROM listed
), chain AS (
  SELECT lang, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM word WINDOW w AS (PARTITION BY d, i ORDER BY pos)
), f1 AS (SELECT lang, a, count(*) AS f FROM chain GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS f FROM chain WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM chain WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
cuts AS (
  SELECT t.lang, t.a || ' ' || t.b AS phrase, 1 AS k, t.f AS a, x.f AS l, y.f AS r
  FROM f2 t JOIN f1 x ON x.lang = t.lang AND x.a = t.a JOIN f1 y ON y.lang = t.lang AND y.a = t.b
  WHERE NOT EXISTS (
    FROM f3 z WHERE z.lang = t.lang AND 100 * z.f >= 50 * t.f AND ((z.a = t.a AND z.b = t.b) OR (z.b = t.a AND z.c = t.b)))
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, 1, t.f, x.f, y.f
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.a = t.a JOIN f2 y ON y.lang = t.lang AND y.a = t.b AND y.b = t.c
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, 2, t.f, x.f, y.f
  FROM f3 t JOIN f2 x ON x.lang = t.lang AND x.a = t.a AND x.b = t.b JOIN f1 y ON y.lang = t.lang AND y.a = t.c
), scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN n USING (lang) QUALIFY rank <= 2000
"""


# Pairs by an inverted list of the shingles, then the ids that a walk over the links reaches.
SIMILAR = r"""
WITH RECURSIVE cut AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT d, s FROM (
    SELECT d, unnest(CASE WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM cut)
), sized AS (
  SELECT d, doc_id, coalesce(n, 0) AS n FROM cut LEFT JOIN (SELECT d, count(*) AS n FROM shingle GROUP BY d) USING (d)
), common AS (
  SELECT x.d AS a, y.d AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.d < y.d GROUP BY ALL
), linked AS (
  SELECT u.doc_id AS a, v.doc_id AS b FROM common JOIN sized u ON u.d = a JOIN sized v ON v.d = b
  WHERE 100 * c >= {percent} * (u.n + v.n - c)
), either AS (
  SELECT a, b FROM linked UNION SELECT b, a FROM linked
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM sized WHERE doc_id IS NOT NULL
  UNION SELECT r.a, e.b FROM reach r JOIN either e ON e.a = r.b
), component AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, s.n AS n_shingles, component_id{kept} FROM sized s LEFT JOIN component USING (doc_id)
"""


def _spans(kind: str, rank: int, regex: str, group: int, least: int) -> str:
    regex = regex.replace("'", "''")
    return f"""
  SELECT row_no, '{kind}' AS kind, {rank} AS rank, length(hits[i]) AS len,
    CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) AS BIGINT)
      + CAST(coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (
    SELECT *, unnest(range(1, len(hits) + 1)) AS i
    FROM (
      SELECT row_no, regexp_extract_all(text, '{regex}', 0) AS hits, regexp_extract_all(text, '{regex}', {group}) AS counts,
        string_split_regex(text, '{regex}') AS gaps
      FROM docs
    ) WHERE len(hits) > 0
  ) WHERE length(counts[i]) >= {max(1, least)}"""


def secrets_sql() -> str:
    from .secret_scan import BASE, RULES

    parts = "\n  UNION ALL".join(_spans(r.kind, i, r.regex, r.group, r.least) for i, r in enumerate(RULES))
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents),
found AS ({parts}
), listed AS (
  SELECT row_no, {counts},
    coalesce(string_agg(kind || ':' || s || ':' || (s + len), ',' ORDER BY s, rank, len) FILTER (WHERE kind IN ({base})), '') AS base,
    string_agg(kind || ':' || s || ':' || (s + len), ',' ORDER BY s, rank, len) AS spans
  FROM found GROUP BY row_no
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (row_no)
"""


ORACLES: dict[str, str] = {
    "op1_chat_masks": CHAT,
    "op2_extendible_shards": SHARDS,
    "op7_systematic_mix": MIX,
    "op5_hyperminhash": SIMILAR.format(size=5, percent=75, kept=", coalesce(s.doc_id = component_id, true) AS kept"),
    "op10_trigram_secrets": secrets_sql(),
    "op12_token_group_join": SIMILAR.format(size=4, percent=85, kept=""),
    "op13_setm_phrases": PHRASES,
}
