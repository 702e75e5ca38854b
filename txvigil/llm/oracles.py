"""The same queries in SQL, where SQL can express them."""

from __future__ import annotations

# Words of a text; RE2 and Java read this class alike.
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {}

ORACLES["op7_host_quality"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), counted AS (
  SELECT *, {_WORDS} AS words,
    [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
  FROM docs
), grams AS (
  SELECT r, i, words[i:i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM counted)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY r
), measured AS (
  SELECT c.r, doc_id, source, len(words)::BIGINT AS n_words,
    (length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM counted c LEFT JOIN covered v ON v.r = c.r
), failing AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM failing GROUP BY source
), moments AS (
  SELECT sum(n) AS n, sum(f) / sum(n) AS m, sum(f * f / n) AS q, count(*) AS k, sum(n * n) AS s FROM hosts
), spread AS (
  SELECT n, m, m * (1 - m) AS w, k,
    (q - n * m * m - (k - 1) * m * (1 - m)) / nullif(n - s / n, 0) AS b FROM moments
), prior AS (
  SELECT m, CASE WHEN w = 0 THEN 1.0 WHEN k > 1 AND b > 0 THEN greatest(w / b - 1, 1.0) ELSE n END AS t
  FROM spread
), verdicts AS (
  SELECT source, (f + m * t) / (n + t) <= 0.5 AS fine FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND fine AS kept
FROM failing JOIN verdicts ON failing.source IS NOT DISTINCT FROM verdicts.source
"""

ORACLES["op10_mixing"] = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len({_WORDS}), 0)::BIGINT AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, 3 * source_size AS most,
    [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS weight,
    sum(source_size) OVER () AS total
  FROM sources
), levels AS (
  SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, source IS NULL, encode(source)
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source IS NULL, encode(source)
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), found AS (
  SELECT first(level ORDER BY most / weight) AS level FROM levels WHERE most >= weight * level
), goals AS (
  SELECT source, source_size, least(most::DOUBLE, coalesce(weight * (SELECT level FROM found), most))
    AS target FROM weighed
), lined AS (
  SELECT d.*, source_size, target, round(target)::BIGINT AS quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  (size * (
    (2 * ahead + size < 2 * quota)::INT
    + (2 * (ahead + source_size) + size < 2 * quota)::INT
    + (2 * (ahead + 2 * source_size) + size < 2 * quota)::INT
  ))::BIGINT AS taken
FROM lined
"""


def _trust(rounds: int = 10) -> str:
    """The propagation of op6, one table per round."""
    start = r"""
WITH cut AS (
  SELECT page_id, html, coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), '') AS h,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
), judged AS (
  SELECT page_id, html, path,
    translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM judged
), rulings AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END
    AS ruling FROM ruled
), targets AS (
  SELECT DISTINCT page_id, host AS src, translate(substring(unnest(regexp_extract_all(html,
    '(?i)\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?(//[^/?#"''\s>]+)', 1)), 3),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM judged WHERE host <> ''
), below AS (
  SELECT DISTINCT host AS src, regexp_extract(host, '^[^.]+\.(.*\..*)$', 1) AS dst FROM judged
), edges AS (
  SELECT src, dst, sum(w) AS w FROM (
    SELECT src, dst, count(*) AS w FROM targets WHERE src <> dst GROUP BY src, dst
    UNION ALL SELECT src, dst, 1 FROM below WHERE dst <> ''
    UNION ALL SELECT dst, src, 1 FROM below WHERE dst <> ''
  ) GROUP BY src, dst
), ways AS (
  SELECT 'allow' AS kind, src, dst, w FROM edges UNION ALL SELECT 'block', dst, src, w FROM edges
), shares AS (
  SELECT kind, src, dst, w / sum(w) OVER (PARTITION BY kind, src) AS share FROM ways
), seeds AS (
  SELECT ruling AS kind, host, count(*) / sum(count(*)) OVER (PARTITION BY ruling) AS seed
  FROM rulings WHERE ruling IS NOT NULL AND host <> '' GROUP BY ruling, host
), r0 AS (SELECT kind, host, seed AS score FROM seeds)"""
    for n in range(rounds):
        start += f""", r{n + 1} AS (
  SELECT kind, host, sum(score) AS score FROM (
    SELECT r.kind, dst AS host, 0.85::DOUBLE * score * share AS score
    FROM r{n} r JOIN shares s ON r.kind = s.kind AND r.host = s.src
    UNION ALL SELECT kind, host, 0.15::DOUBLE * seed FROM seeds
  ) GROUP BY kind, host)"""
    return start + f""", verdicts AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'block'), 0)
    > coalesce(sum(score) FILTER (kind = 'allow'), 0) * (1 + 1e-9) AS blocked
  FROM r{rounds} GROUP BY host
)
SELECT page_id, p.host, path, rule,
  coalesce(ruling, CASE WHEN coalesce(blocked, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM rulings p LEFT JOIN verdicts v ON v.host = p.host"""


ORACLES["op6_host_trust"] = _trust()

ORACLES["op5_line_dedup"] = r"""
WITH lined AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS content,
    unnest(range(len(string_split(text, chr(10))))) AS line FROM documents
), sets AS (
  SELECT doc_id, line, content, list_distinct(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) AS words
  FROM lined WHERE regexp_matches(content, '[^\x20\x09-\x0D]')
), once AS (
  SELECT min((doc_id, line)) AS place, content, any_value(words) AS words FROM sets GROUP BY content
), worded AS (
  SELECT place, len(words) AS n, unnest(words) AS word FROM once
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS times FROM worded
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY times, word) AS pos FROM counted
), fronts AS (
  SELECT * FROM ranked WHERE pos <= n // 5 + 1
), candidates AS (
  SELECT DISTINCT a.place AS a, b.place AS b FROM fronts a JOIN fronts b
    ON a.word = b.word AND a.place < b.place AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), gone AS (
  SELECT DISTINCT b AS place FROM candidates
  JOIN once x ON x.place = a JOIN once y ON y.place = b
  WHERE 100 * len(list_intersect(x.words, y.words))
    >= 80 * (len(x.words) + len(y.words) - len(list_intersect(x.words, y.words)))
), verdicts AS (
  SELECT l.doc_id, l.line, l.content,
    o.place IS NOT NULL AND ((l.doc_id, l.line) <> o.place OR o.place IN (SELECT place FROM gone)) AS removed
  FROM lined l LEFT JOIN once o ON o.content = l.content
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
    string_agg(content, chr(10) ORDER BY line) FILTER (NOT removed) AS rest
  FROM verdicts GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op2_ngram_jaccard"] = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_LOWER}), '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(
    [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, greatest(len(words) - 3, 1) + 1)]) END AS s
  FROM worded
), spread AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM spread a JOIN spread b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM shingled
  UNION SELECT doc_id, b FROM reached JOIN links ON other = a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM shingled
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""

ORACLES["op3_prefix_tree"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    -- '### ' and ': ' around the role, '</turn>' and a line break, a backslash per mark
    sum(14 + length(role) + length(text) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
      + length(regexp_replace(text, '[^\\#<]', '', 'g'))) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM whole
"""

ORACLES["op4_suffix_dedup"] = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
    length(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents
), starts AS (
  SELECT r, doc_id, i, substring(h, 2 * i + 1, 100) AS s
  FROM (SELECT r, doc_id, h, unnest(range(greatest(n - 49, 0))) AS i FROM docs)
), hits AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS first FROM starts)
  WHERE doc_id > first
), marked AS (
  SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, true)::INT AS opens FROM hits
), spans AS (
  SELECT r, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT *, sum(opens) OVER (PARTITION BY r ORDER BY i) AS g FROM marked) GROUP BY r, g
), pieces AS (
  SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM spans
), cut AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substring(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
  FROM pieces JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (r)
"""

ORACLES["op11_collision_counting"] = """
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), used AS (
  SELECT * FROM rows WHERE label IS NOT NULL AND v IS NOT NULL
    AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN v IF x <> 0]) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM used a JOIN used b
  ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT r AS a, r AS b FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), smallest AS (
  SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN rows ON b = rows.r GROUP BY a
), many AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN smallest USING (r) LEFT JOIN many USING (r)
"""


def _framed(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _levels(name: str, nodes: str, levels: int) -> str:
    """Levels of trees of up to 8 ** ``levels`` leaves, and their runs with all digests."""
    parts = [f"{name}0 AS ({nodes})"]
    for k in range(levels):
        parts.append(
            f"{name}runs{k} AS (SELECT tree, slot // 8 AS run, many, list(d ORDER BY slot) AS ds "
            f"FROM {name}{k} GROUP BY tree, slot // 8, many)"
        )
        parts.append(
            f"{name}{k + 1} AS (SELECT tree, run AS slot, (many + 7) // 8 AS many, "
            f"CASE WHEN many > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {name}runs{k})"
        )
    return ", ".join(parts)


def _folds(name: str, levels: int, leaves: str) -> str:
    """From ``leaves``(key, tree, slot, f, proof): f folded and proof extended, level by level."""
    parts, before = [], leaves
    for k in range(levels):
        at = f"(slot // {8**k}) % 8"
        left, right = f"array_to_string(ds[1:{at}], '')", f"array_to_string(ds[{at} + 2:], '')"
        parts.append(
            f"{name}fold{k} AS (SELECT l.key, l.tree, l.slot, "
            f"CASE WHEN r.many > 1 THEN sha256({left} || f || {right}) ELSE f END AS f, "
            f"CASE WHEN r.many > 1 THEN proof || {left} || {right} ELSE proof END AS proof "
            f"FROM {before} l JOIN {name}runs{k} r ON r.tree = l.tree AND r.run = l.slot // {8 ** (k + 1)})"
        )
        before = f"{name}fold{k}"
    return ", ".join(parts)


# Trees of up to 32,768 documents per language and 512 languages; a byte of the id at a time for its checksum.
_DOC_LEVELS, _TOP_LEVELS = 5, 3
_FIELDS = " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DOC_NODES = (
    "SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS slot, "
    "count(*) OVER (PARTITION BY tree) AS many, leaf AS d, key FROM leaves"
)
_TOP_NODES = (
    "SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS slot, count(*) OVER () AS many, "
    f"d, tree AS lang FROM doc{_DOC_LEVELS}"
)

ORACLES["op12_merkle_manifest"] = f"""
WITH docs AS (SELECT row_number() OVER () AS key, * FROM documents), bits AS (
  SELECT key, doc_id, list_concat([4294967295], flatten([
    [ascii(substring(CAST(doc_id AS VARCHAR), i, 1)), 0, 0, 0, 0, 0, 0, 0]
    FOR i IN range(1, length(CAST(doc_id AS VARCHAR)) + 1)])) AS steps FROM docs
), sums AS (
  SELECT key, xor(list_reduce([CAST(s AS BIGINT) FOR s IN steps],
    lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))), 4294967295) AS crc FROM bits
), leaves AS (
  SELECT key, doc_id, coalesce('=' || lang, '') AS tree,
    sha256({_FIELDS} || {_framed('text')}) AS leaf,
    sha256({_FIELDS} || {_framed(_LOWER)}) AS lowered,
    crc % 3 = 0 AS changed
  FROM docs JOIN sums USING (key)
), {_levels('doc', _DOC_NODES, _DOC_LEVELS)}, {_levels('top', _TOP_NODES, _TOP_LEVELS)},
claims AS (
  SELECT key, doc0.tree, slot, CASE WHEN changed THEN lowered ELSE leaf END AS f, '' AS proof
  FROM doc0 JOIN leaves USING (key)
), {_folds('doc', _DOC_LEVELS, 'claims')}, heads AS (
  SELECT key, '' AS tree, top0.slot, f, proof FROM doc{'fold'}{_DOC_LEVELS - 1} d JOIN top0 ON top0.lang = d.tree
), {_folds('top', _TOP_LEVELS, 'heads')}
SELECT doc_id, leaf, top0.d AS subroot, root.d AS root, sha256(proof) AS proof_sha256,
  f AS folded_root, f = root.d AS verified
FROM leaves JOIN topfold{_TOP_LEVELS - 1} t USING (key) JOIN top0 ON top0.lang = leaves.tree, top{_TOP_LEVELS} root
"""

ORACLES["op13_gnat_negatives"] = """
WITH grid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM grid a JOIN grid b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), negatives AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
