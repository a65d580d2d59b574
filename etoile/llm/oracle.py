"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from etoile.llm import licences, mixing

ORACLE: dict[str, str] = {}

_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE["op2_signature_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT u, v FROM pairs JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.node),
linked AS (SELECT u AS doc_id, count(*) AS n_links FROM links GROUP BY u)
SELECT r.doc_id, any_value(n.n) AS n_shingles, min(r.node) AS component_id, coalesce(any_value(l.n_links), 0) AS n_links
FROM reach r JOIN n ON n.doc_id = r.doc_id LEFT JOIN linked l ON l.doc_id = r.doc_id GROUP BY r.doc_id
"""

ORACLE["op5_exact_dedup"] = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

ORACLE["op6_repeats"] = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
starts AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i, w FROM w WHERE len(w) >= 13),
keyed AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS k FROM starts),
again AS (SELECT doc_id, i FROM keyed QUALIFY doc_id > min(doc_id) OVER (PARTITION BY k)),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM again),
lists AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
    CASE WHEN g IS NULL THEN w ELSE list_transform(list_filter(generate_series(1, len(w)), lambda i: NOT list_contains(g, i)), lambda i: w[i]) END AS k
  FROM w LEFT JOIN lists USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


def _mixing() -> str:
    """The sweeps, unrolled: each margin's weights from those of the margin before."""
    def level(column: str, targets: dict[str, float]) -> str:
        names = ", ".join(f"'{k}'" for k in targets)
        return f"CASE WHEN {column} IN ({names}) THEN {column} ELSE 'other' END"

    def values(targets: dict[str, float]) -> str:
        return ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in targets.items())

    topic = """CASE WHEN text IS NULL THEN 'other' WHEN contains(text, ' | ') THEN 'table'
      WHEN contains(text, '!! ') OR contains(text, '### ') OR contains(text, '*** ') THEN 'other' ELSE 'prose' END"""
    steps = [f"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '(none)') AS source, {level("coalesce(lang, '(none)')", mixing.LANGUAGES)} AS language,
      {level(f"({topic})", mixing.TOPICS)} AS topic, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS tokens FROM documents)""",
             "w0 AS MATERIALIZED (SELECT source, language, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS w FROM d GROUP BY ALL)",
             f"p AS (SELECT source, pow(sum(tokens) / (SELECT sum(tokens) FROM w0), {mixing.SOURCE_POWER}) AS p FROM w0 GROUP BY source)",
             "aim_source AS MATERIALIZED (SELECT source, p / (SELECT sum(p) FROM p) AS aim FROM p)"]
    for name, targets in (("language", mixing.LANGUAGES), ("topic", mixing.TOPICS)):
        steps += [f"raw_{name}({name}, t) AS (VALUES {values(targets)})",
                  f"""there_{name} AS (SELECT {name}, t, sum(tokens) / (SELECT sum(tokens) FROM w0) AS seen
                    FROM w0 LEFT JOIN raw_{name} USING ({name}) GROUP BY {name}, t HAVING sum(tokens) > 0)""",
                  f"""aim_{name} AS MATERIALIZED (SELECT {name}, CASE WHEN t IS NULL THEN seen ELSE
                    t / (SELECT sum(t) FROM there_{name}) * (1 - (SELECT coalesce(sum(seen), 0) FROM there_{name} WHERE t IS NULL)) END AS aim
                    FROM there_{name})"""]
    n = 0
    for _ in range(mixing.SWEEPS):
        for margin in ("source", "language", "topic"):
            steps.append(f"""w{n + 1} AS MATERIALIZED (SELECT source, language, topic, tokens,
              CASE WHEN sum(w) OVER (PARTITION BY {margin}) > 0 THEN w * aim / sum(w) OVER (PARTITION BY {margin}) ELSE 0 END AS w
              FROM w{n} JOIN aim_{margin} USING ({margin}))""")
            n += 1
    return "WITH " + ",\n".join(steps) + f""",
r AS (SELECT source, language, topic, w / tokens AS ratio FROM w{n} WHERE tokens > 0),
q AS (SELECT d.*, coalesce(ratio / (SELECT max(ratio) FROM r), 1.0) AS q FROM d LEFT JOIN r USING (source, language, topic))
SELECT doc_id, source, language, topic, tokens, round(q, 9) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 < q AS drawn
FROM q"""


ORACLE["op9_mixing"] = _mixing()


def _licenses() -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted(licences.TEMPLATES.items()))
    trigger, term = licences.TRIGGER, licences.TERM
    return rf"""
WITH files AS (SELECT doc_id AS file, source || '/' || lang || '/' || (doc_id // 1000) || '/' || doc_id AS path, coalesce(text, '') AS text FROM documents),
lines AS (SELECT file, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM files WHERE regexp_matches(text, '{trigger}')),
headers AS MATERIALIZED (SELECT file, line_no, line, len(regexp_extract_all(line, {_WORDS})) AS words FROM lines WHERE regexp_matches(line, '{trigger}')),
terms AS MATERIALIZED (SELECT file, line_no, term, count(*) AS tf
  FROM (SELECT file, line_no, unnest(regexp_extract_all(lower(line), '{term}')) AS term FROM headers) GROUP BY ALL),
held AS (SELECT term, count(*) AS n FROM terms GROUP BY term),
total AS (SELECT count(*) AS total FROM headers),
templates(template, line) AS (VALUES {rows}),
tt AS (SELECT template, term, count(*) AS tf FROM (SELECT template, unnest(regexp_extract_all(lower(line), '{term}')) AS term FROM templates) GROUP BY ALL),
model AS (SELECT template, term, tf * (ln((1.0 + total) / (1.0 + coalesce(n, 0))) + 1.0) AS v FROM tt LEFT JOIN held USING (term), total),
norms AS (SELECT template, sqrt(sum(v * v)) AS tn FROM model GROUP BY template),
weighted AS (SELECT file, line_no, term, tf * (ln((1.0 + total) / (1.0 + n)) + 1.0) AS w FROM terms JOIN held USING (term), total),
norm AS (SELECT file, line_no, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY ALL),
scored AS (SELECT file, line_no, template, round(sum(w * v) / any_value(tn) / any_value(norm), 9) AS cosine
  FROM weighted JOIN model USING (term) JOIN norms USING (template) JOIN norm USING (file, line_no) GROUP BY ALL),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY file, line_no ORDER BY cosine DESC, template) = 1),
good AS MATERIALIZED (SELECT * FROM best WHERE cosine >= {licences.MIN_COSINE}),
own AS (SELECT file, template AS license, cosine FROM good QUALIFY row_number() OVER (PARTITION BY file ORDER BY cosine DESC, template, line_no) = 1),
said AS (SELECT file, sum(words) AS said FROM headers SEMI JOIN good USING (file, line_no) GROUP BY file),
voices AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license, cosine, path FROM own JOIN files USING (file) JOIN said USING (file)
  WHERE 2 * said >= len(regexp_extract_all(text, {_WORDS}))),
licensed AS (SELECT * FROM voices QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, license DESC, path DESC) = 1),
near AS (SELECT file, l.license, l.cosine FROM files f JOIN licensed l
  ON regexp_replace(f.path, '/?[^/]*$', '') = l.dir OR starts_with(f.path, l.dir || '/') OR l.dir = ''
  QUALIFY row_number() OVER (PARTITION BY file ORDER BY length(l.dir) DESC) = 1)
SELECT f.file AS doc_id, coalesce(o.license, n.license) AS license,
  CASE WHEN o.license IS NOT NULL THEN 'own' WHEN n.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  round(coalesce(o.cosine, n.cosine), 6) AS cosine
FROM files f LEFT JOIN own o USING (file) LEFT JOIN near n USING (file)
"""


ORACLE["op3_licenses"] = _licenses()

ORACLE["op11_topk"] = """
WITH plain AS (SELECT vec_id, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row, list_transform(e, lambda x: floor(256 * x::DOUBLE)) AS v FROM plain),
scored AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT),
      lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295::BIGINT), 4294967295)"""


def _merkle() -> str:
    def field(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"

    def leaf(n: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', n, 'text'))})"

    # a level of every tree from the one below, and the path of every leaf, up to the root
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS leaf,
    CASE WHEN {_crc32('doc_id::VARCHAR')} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS other FROM documents),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS size FROM d),
low(tree, level, i, size, h) AS (
  SELECT tree, 0, i, size, leaf FROM numbered
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE size > 1 GROUP BY tree, i // 2),
lows AS MATERIALIZED (SELECT * FROM low),
roots AS MATERIALIZED (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS size FROM lows WHERE size = 1),
top(level, i, size, h) AS (
  SELECT 0, i, size, h FROM roots
  UNION ALL
  SELECT any_value(level) + 1, i // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE size > 1 GROUP BY i // 2),
tops AS MATERIALIZED (SELECT * FROM top),
climb(doc_id, leaf, tree, level, i, size, folded, proof) AS (
  SELECT doc_id, leaf, tree, 0, i, size, coalesce(other, leaf), '' FROM numbered
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.level + 1, c.i // 2, (c.size + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN folded WHEN c.i % 2 = 0 THEN folded || s.h ELSE s.h || folded END), proof || coalesce(s.h, '')
  FROM climb c LEFT JOIN lows s ON s.tree = c.tree AND s.level = c.level AND s.i = xor(c.i, 1) WHERE c.size > 1),
under AS MATERIALIZED (SELECT * FROM climb WHERE size = 1),
over(doc_id, leaf, subroot, level, i, size, folded, proof) AS (
  SELECT doc_id, leaf, r.h, 0, r.i, r.size, folded, proof FROM under u JOIN roots r USING (tree)
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.i // 2, (c.size + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN folded WHEN c.i % 2 = 0 THEN folded || s.h ELSE s.h || folded END), proof || coalesce(s.h, '')
  FROM over c LEFT JOIN tops s ON s.level = c.level AND s.i = xor(c.i, 1) WHERE c.size > 1)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM over o, (SELECT h FROM tops WHERE size = 1) r WHERE o.size = 1
"""


ORACLE["op13_merkle"] = _merkle()


def _repair() -> str:
    """Forward dynamic programming over four states, each with its least cost, letters and repaired rows."""
    never = 1000000000

    def add(s: str, cost, letter: str, row: str | None = None) -> str:
        rows = f"list_append({s}.t, {row})" if row else f"{s}.t"
        return f"{{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': {rows}}}"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def keep(initial: str) -> str:
        return f"(CASE WHEN r.r = '{initial}' AND NOT r.gone THEN 3 * r.cut ELSE {never} END)"
    change = f"(CASE WHEN NOT r.gone THEN 3 + 3 * r.cut ELSE {never} END)"

    def inserted(source: str) -> str:
        for _ in range(3):
            user = least("s2", *[add(s, 3, "I", "'user:'") for s in ("s0", "s1", "s3")])
            source = f"(SELECT conv_id, i, s0, s1, {user} AS s2, {least('s3', add('s2', 3, 'I', chr(39) + 'assistant:' + chr(39)))} AS s3 FROM {source})"
        return source
    own, user, assistant = "r.role || ':' || r.text", "'user:' || r.text", "'assistant:' || r.text"
    row = ", ".join([
        add("s0", 4, "D"), least(add("s1", 4, "D"), add("s0", keep("s"), "K", own)),
        least(add("s2", 4, "D"), *[x for s in ("s0", "s1", "s3") for x in (add(s, keep("u"), "K", own), add(s, change, "R", user))]),
        least(add("s3", 4, "D"), add("s2", keep("a"), "K", own), add("s2", change, "R", assistant))])
    far = f"{{'c': {never}::BIGINT, 'a': '', 't': []::VARCHAR[]}}"
    code = _crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE coded AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {code} % 20 AS code FROM conversations),
rows AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy FROM coded WHERE code <> 0)),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM rows),
said AS (SELECT *, rtrim(text, {space}) = '' AS blank, right(rtrim(text, {space}), 1) NOT IN ('.', '!', '?') AS open,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    left(lag(role) OVER o, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS odd
  FROM placed WINDOW o AS (PARTITION BY conv_id ORDER BY i)),
r AS MATERIALIZED (SELECT *, left(role, 1) AS r, blank OR again AS gone, open::BIGINT AS cut FROM said),
conv AS MATERIALIZED (SELECT c.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT blank AND NOT again AND open) AS truncated, count(*) FILTER (odd) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
dp(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}, {far}, {far}, {far} FROM conv
  UNION ALL
  SELECT d.conv_id, d.i + 1, {row} FROM {inserted("dp")} d JOIN r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1),
ended AS (SELECT conv_id, {least("s0", "s3")} AS s FROM {inserted("(SELECT dp.* FROM dp JOIN conv ON conv.conv_id IS NOT DISTINCT FROM dp.conv_id AND conv.n = dp.i)")})
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, s.c AS cost, s.a AS audit, sha256(coalesce(array_to_string(s.t, chr(10)), '')) AS repaired_sha256
FROM conv c JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE["op12_repair"] = _repair()
