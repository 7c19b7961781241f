"""DuckDB SQL for the operators that SQL can express, computed another way than in Spark."""

from creditlens.llm import codes, decontaminate, line_dedup, merkle, quality_rules, warc

#: Words of documents with their places, as the rules read them.
_RULE_WORDS = r"""words AS (
  SELECT doc_id, lang, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"""


def _rules() -> str:
    counts = f"""{_RULE_WORDS},
runs AS (SELECT doc_id, i, list_slice(w, i, i + {quality_rules.WINDOW - 1}) AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {quality_rules.WINDOW - 2})) AS i FROM words)),
again AS (SELECT doc_id, i FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {quality_rules.WINDOW})) AS p FROM again) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM words),
line_counts AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
counted AS (
  SELECT d.doc_id, d.lang, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.n_lines, 0)::BIGINT AS n_lines,
    coalesce(l.n_dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(body, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
  FROM words d LEFT JOIN repeats r USING (doc_id) LEFT JOIN line_counts l USING (doc_id))"""
    grid = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, doc_id, lang, CASE WHEN {below} > 0 THEN {above} / {below}::DOUBLE ELSE 0 END AS value, {list(cutoffs)} AS grid FROM counted"
        for rule, (above, below, cutoffs) in quality_rules.RULES.items()
    )
    risk, error, rules = quality_rules.RISK, quality_rules.ERROR, len(quality_rules.RULES)
    return f"""WITH {counts},
ratios AS ({grid}),
held AS (SELECT rule, lang, value, unnest(grid)::DOUBLE AS cutoff FROM ratios
  WHERE lang IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
tallies AS (SELECT rule, lang, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS k FROM held GROUP BY ALL),
tails AS (SELECT *, CASE WHEN k >= n * {risk} THEN 1 ELSE list_sum(list_transform(range(0, k + 1),
    lambda i: exp(lgamma(n + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) END AS p FROM tallies),
judged AS (SELECT *, p > {error} / ((SELECT count(DISTINCT lang) FROM held) * {rules}) AS failed FROM tails),
worst AS (SELECT rule, lang, max(cutoff) FILTER (failed) AS cutoff FROM judged GROUP BY ALL),
chosen AS (SELECT j.rule, j.lang, min(j.cutoff) AS cutoff FROM judged j JOIN worst w ON j.rule = w.rule AND j.lang = w.lang
  AND (w.cutoff IS NULL OR j.cutoff > w.cutoff) GROUP BY ALL),
rejected AS (SELECT DISTINCT r.doc_id FROM ratios r JOIN chosen c ON r.rule = c.rule AND r.lang = c.lang AND r.value > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words)
    AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM counted"""


def _decontaminate() -> str:
    k = decontaminate.WINDOW
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH docs AS (SELECT doc_id, {words} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), {k}) AS size FROM (SELECT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, size, list_slice(w, i, i + size - 1) AS run FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS run
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)),
hits AS (SELECT d.doc_id, d.i, d.size, t.item_id FROM doc_windows d JOIN item_windows t ON d.size = t.size AND d.run = t.run),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
  sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered c USING (doc_id) LEFT JOIN named m USING (doc_id)"""


LINE_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _line_dedup() -> str:
    return f"""WITH lines AS (SELECT doc_id, i, line, {LINE_KEY} AS key
  FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
common AS (SELECT key FROM lines WHERE length(key) >= {line_dedup.LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCUMENTS}),
marked AS (SELECT lines.*, key IN (SELECT key FROM common) AS gone FROM lines)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def _warc() -> str:
    parts = r"'^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)'"
    key = f"""CASE WHEN NOT regexp_matches(uri, {parts}) THEN uri ELSE
      array_to_string(list_reverse(string_split(regexp_replace(lower(regexp_extract(uri, {parts}, 1)), '^www[.]', ''), '.')), ',') || ')'
      || CASE WHEN regexp_extract(uri, {parts}, 2) = '' THEN '/' ELSE regexp_extract(uri, {parts}, 2) END END"""
    return f"""WITH given AS (SELECT page_id, regexp_replace(coalesce(url, ''), '[\\x00-\\x20\\x7f]', '', 'g') AS uri, coalesce(html, '') AS html FROM pages),
sized AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest, {key} AS url_key FROM given),
latest AS (SELECT html, max(page_id) AS page FROM sized WHERE payload_bytes >= {warc.LEAST_BYTES} GROUP BY html)
SELECT s.page_id, payload_bytes, payload_digest, CASE WHEN l.page IS NULL OR l.page = s.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN l.page <> s.page_id THEN l.page END AS refers_to, url_key,
  row_number() OVER (PARTITION BY url_key ORDER BY s.page_id) AS capture_no
FROM sized s LEFT JOIN latest l ON s.html = l.html AND s.payload_bytes >= {warc.LEAST_BYTES}"""


def _merkle() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if name == "text" else name) for name in merkle.FIELDS) + ")"

    lowered = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    # DuckDB has no crc32 of text: eight steps a byte over the decimal id.
    crc = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)::UBIGINT[]), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END))"""
    return f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {leaf("text")} AS leaf,
    CASE WHEN xor({crc}, 4294967295::UBIGINT) % 3 = 0 THEN {leaf(lowered)} END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
up(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // {merkle.ARITY}, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + {merkle.ARITY - 1}) // {merkle.ARITY})
  FROM up WHERE n > 1 GROUP BY tree, level, pos // {merkle.ARITY}),
tops(level, pos, digest, n) AS (
  SELECT 100, tree, digest, count(*) OVER () FROM up WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // {merkle.ARITY}, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + {merkle.ARITY - 1}) // {merkle.ARITY})
  FROM tops WHERE n > 1 GROUP BY level, pos // {merkle.ARITY}),
nodes AS MATERIALIZED (SELECT tree, level, pos, digest, n FROM up WHERE n > 1 UNION ALL
  SELECT t.tree, level, pos, digest, n FROM tops, (SELECT DISTINCT tree FROM leaves) t WHERE n > 1),
paths(row, tree, level, pos, folded, proof) AS (
  SELECT p.rn, p.tree, CASE WHEN s.n = 1 THEN 100 ELSE 0 END, CASE WHEN s.n = 1 THEN p.tree ELSE p.pos END, coalesce(p.changed, p.leaf), ''
  FROM (SELECT *, row_number() OVER () AS rn FROM placed) p JOIN (SELECT tree, count(*) AS n FROM placed GROUP BY 1) s USING (tree)
  UNION ALL
  SELECT row, p.tree, CASE WHEN any_value(k.n) <= {merkle.ARITY} AND p.level < 100 THEN 100 ELSE p.level + 1 END,
    CASE WHEN any_value(k.n) <= {merkle.ARITY} AND p.level < 100 THEN p.tree ELSE p.pos // {merkle.ARITY} END,
    sha256(string_agg(CASE WHEN k.pos = p.pos THEN folded ELSE k.digest END, '' ORDER BY k.pos)),
    any_value(proof) || coalesce(string_agg(k.digest, '' ORDER BY k.pos) FILTER (k.pos <> p.pos), '')
  FROM paths p JOIN nodes k ON k.tree = p.tree AND k.level = p.level AND k.pos // {merkle.ARITY} = p.pos // {merkle.ARITY}
  GROUP BY row, p.tree, p.level, p.pos),
ends AS (SELECT row, arg_max(folded, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256 FROM paths GROUP BY row)
SELECT doc_id, leaf, u.digest AS subroot, t.digest AS root, proof_sha256, folded_root, folded_root = t.digest AS verified
FROM (SELECT *, row_number() OVER () AS rn FROM placed) p JOIN ends ON row = rn
JOIN (SELECT tree, digest FROM up WHERE n = 1) u USING (tree), (SELECT digest FROM tops WHERE n = 1) t"""


def _codes() -> str:
    parts = f"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
  list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (SELECT r, i // w AS part, i % w AS place, v[i + 1] AS x
  FROM (SELECT r, v, len(v) // {codes.PARTS} AS w, unnest(range(len(v))) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, r AS entry, place, x FROM cells WHERE r < {codes.ENTRIES})"""
    for i in range(codes.ROUNDS + 1):
        # The least distance, then the least entry, in one number.
        parts += f""",
near{i} AS MATERIALIZED (SELECT r, part, min(d * {codes.ENTRIES} + entry) AS best FROM (
  SELECT r, part, entry, sum((c.x - b.x) * (c.x - b.x)) AS d FROM cells c JOIN book{i} b USING (part, place) GROUP BY ALL) GROUP BY ALL)"""
        if i < codes.ROUNDS:
            parts += f""",
book{i + 1} AS MATERIALIZED (SELECT part, entry, place, coalesce(floor(m.s / m.n)::BIGINT, b.x) AS x FROM book{i} b LEFT JOIN (
  SELECT part, best % {codes.ENTRIES} AS entry, place, sum(x) AS s, count(*) AS n FROM cells JOIN near{i} USING (r, part) GROUP BY ALL) m USING (part, entry, place))"""
    last = codes.ROUNDS
    return f"""{parts},
coded AS (SELECT r, string_agg(printf('%02x', (best % {codes.ENTRIES})::INTEGER), '' ORDER BY part) AS code, sum(best // {codes.ENTRIES})::BIGINT AS error FROM near{last} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{last}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


WARC_SQL = _warc()
CODES_SQL = _codes()
MERKLE_SQL = _merkle()
QUALITY_RULES_SQL = _rules()
DECONTAMINATE_SQL = _decontaminate()
LINE_DEDUP_SQL = _line_dedup()
