"""DuckDB SQL of the queries that SQL can express, over the registered views."""

from __future__ import annotations

from usagelens.llm import chat, host_rules, importance, license_dice, url_model

OP3 = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
tri AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)),
again AS (SELECT r, t FROM tri GROUP BY r, t HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM tri JOIN again USING (r, t)) GROUP BY r),
counts AS (
  SELECT w.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '{host_rules.SYMBOL}', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(string_split(text, chr(10)),
                                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered c ON w.r = c.r),
base AS (
  SELECT *, n_words < {host_rules.MIN_WORDS}
            OR 100 * n_repeat_words > {host_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts),
hosts AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS k
  FROM base WHERE source IS NOT NULL GROUP BY source),
total AS (
  SELECT count(*) AS h, sum(n)::DOUBLE AS nn, sum(k)::DOUBLE AS kk, sum(n * n)::DOUBLE AS squares,
         sum(floor(k * k * 1000000 / n))::DOUBLE AS parts, sum(k)::DOUBLE / sum(n)::DOUBLE AS m FROM hosts),
fit AS (
  SELECT m, CASE WHEN m * (1 - m) * (nn - squares / nn - (h - 1)) > 0
    THEN least(greatest((parts / 1e6 - kk * kk / nn - m * (1 - m) * (h - 1))
                        / (m * (1 - m) * (nn - squares / nn - (h - 1))), {host_rules.LEAST}), {host_rules.MOST})
    ELSE {host_rules.LEAST} END AS g FROM total),
verdict AS (
  SELECT source, n, k, (k + m * ((1 - g) / g)) / (n + (1 - g) / g) <= {host_rules.MAX_RATE} AS ok FROM hosts, fit)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CAST(v.n AS BIGINT) AS host_n, CAST(v.k AS BIGINT) AS host_failed,
       NOT base_failed AND coalesce(ok, true) AS kept
FROM base LEFT JOIN verdict v ON base.source = v.source
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licences() -> str:
    rows = ", ".join(f"({i}, {_text(name)}, {max(1, len(license_dice.plain_words(text)) - 1)}, "
                     f"[{', '.join(map(_text, license_dice.plain_bigrams(text)))}], "
                     f"[{', '.join(map(_text, license_dice.anchors(license_dice.plain_bigrams(text))))}])"
                     for i, (name, text) in enumerate(license_dice.NOTICES))
    return f"""
WITH notices AS (SELECT * FROM (VALUES {rows}) AS v(template, license, m, b, anchors)),
texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM documents WHERE text IS NOT NULL),
pairs AS (
  SELECT r, doc_id, CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END AS p FROM texts),
places AS (SELECT r, len(p) AS np, unnest(p) AS pair, unnest(range(len(p))) AS pos FROM pairs),
anchored AS (SELECT template, m, unnest(anchors) AS pair FROM notices),
starts AS (
  SELECT DISTINCT r, template, unnest(range(
    least(greatest(pos - m + 1, 0), greatest(np - m, 0)),
    greatest(least(greatest(pos - m + 1, 0), greatest(np - m, 0)), least(pos, greatest(np - m, 0))) + 1)) AS s
  FROM places JOIN anchored USING (pair)),
windows AS (
  SELECT r, doc_id, template, license, s, least(m, len(p)) + 1 AS n, b, list_distinct(p[s + 1:s + m]) AS d
  FROM starts JOIN pairs USING (r) JOIN notices USING (template)),
hits AS (
  SELECT r, doc_id, template, license, s, n, 2.0::DOUBLE * len(list_intersect(d, b)) / (len(d) + len(b)) AS similarity
  FROM windows),
good AS (SELECT * FROM hits WHERE similarity >= {license_dice.THRESHOLD}::DOUBLE)
SELECT doc_id, license, CAST(count(*) AS BIGINT) AS n_units, max(similarity) AS similarity
FROM good h WHERE NOT EXISTS (
  SELECT 1 FROM good g WHERE g.r = h.r
    AND (g.similarity > h.similarity OR (g.similarity = h.similarity AND (g.n > h.n OR (g.n = h.n AND (
         g.template < h.template OR (g.template = h.template AND g.s < h.s))))))
    AND 2 * (least(h.s + h.n, g.s + g.n) - greatest(h.s, g.s)) > least(h.n, g.n))
GROUP BY doc_id, license
"""


OP5 = _licences()

OP2 = rf"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
coded AS (
  SELECT conv_id, place,
         coalesce(length(role) || 'r' || role, 'n') || coalesce(length(text) || 't' || text, 'n') AS code,
         '{chat.START}' || coalesce(role, 'unknown') || chr(10)
         || regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<| \1 |>', 'g')
         || '{chat.END}' || chr(10) AS shown
  FROM t),
prefixes AS (
  SELECT conv_id, place, shown, string_agg(code, '') OVER (PARTITION BY conv_id ORDER BY place) AS p,
         max(place) OVER (PARTITION BY conv_id) AS n FROM coded),
ends AS (SELECT conv_id, n, p FROM prefixes WHERE place = n),
keep AS (
  SELECT min(conv_id) AS conv_id, n, count(*) AS n_copies FROM ends
  WHERE p NOT IN (SELECT p FROM prefixes WHERE place < n) GROUP BY n, p)
SELECT keep.conv_id, CAST(keep.n AS BIGINT) AS n_turns, CAST(n_copies AS BIGINT) AS n_copies,
       string_agg(shown, '' ORDER BY place) AS text
FROM keep JOIN prefixes ON keep.conv_id = prefixes.conv_id GROUP BY ALL
"""


def url_model_sql(rules: list[url_model.Rule]) -> str:
    def chosen(field: str) -> str:
        best = "".join(
            f" WHEN (host = {_text(r.host)} OR ends_with(host, {_text('.' + r.host)})) AND starts_with(path, {_text(r.path)})"
            f" THEN {_text(getattr(r, field))}" for r in sorted(rules, key=lambda r: (-len(r.name), r.name)))
        return f"CASE{best} END"

    m, base, k, sets = url_model.M, 1 / url_model.ALPHABET, url_model.ORDER, url_model.SETS
    sums = ", ".join(f"sum({c}) AS {c}" for c in sets)
    levels = "".join(f"""
g{n} AS (SELECT substring(gram, 2) AS gram, {sums} FROM g{n + 1} GROUP BY 1),""" for n in range(k - 1, -1, -1))
    models = ""
    for n in range(k + 1):
        lower = f"JOIN p{n - 1} l ON substring(g.gram, 2) = l.gram" if n else ""
        shares = ", ".join(f"(g.{c}::DOUBLE + {m}::DOUBLE * {f'l.p_{c}' if n else f'{base!r}::DOUBLE'})"
                           f" / (t.{c}::DOUBLE + {m}::DOUBLE) AS p_{c}" for c in sets)
        models += f"""
t{n} AS (SELECT substring(gram, 1, {n}) AS context, {sums} FROM g{n} GROUP BY 1),
p{n} AS (SELECT g.gram, {shares} FROM g{n} g JOIN t{n} t ON substring(g.gram, 1, {n}) = t.context {lower}),"""
    held = ", ".join(map(_text, url_model.HELD_OUT))
    return f"""
WITH rest AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{url_model.UPPER}', '{url_model.LOWER}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, {chosen('name')} AS rule, {chosen('verdict')} AS label FROM split),
urls AS (SELECT url, min(label) AS label, substring(md5(url), 1, 1) IN ({held}) AS held FROM ruled GROUP BY url),
places AS (
  SELECT url, label, held, substring(t, i, {k + 1}) AS gram FROM (
    SELECT *, unnest(range(1, length(t) - {k} + 1)) AS i FROM (
      SELECT *, repeat(chr({ord(url_model.START)}), {k}) || url || chr({ord(url_model.END)}) AS t FROM urls))),
g{k} AS (
  SELECT gram, count(*) FILTER (label = 'allow' AND NOT held) AS a, count(*) FILTER (label = 'block' AND NOT held) AS r,
         count(*) FILTER (label = 'allow') AS all_a, count(*) FILTER (label = 'block') AS all_r
  FROM places GROUP BY gram),{levels}{models}
ratios AS (
  SELECT gram, CAST(round(1e6::DOUBLE * (ln(p_a) - ln(p_r))) AS BIGINT) AS ratio,
         CAST(round(1e6::DOUBLE * (ln(p_all_a) - ln(p_all_r))) AS BIGINT) AS all_ratio FROM p{k}),
scores AS (
  SELECT url, min(label) AS label,
         CAST(floor(sum(CASE WHEN label IS NULL THEN all_ratio ELSE ratio END)::DOUBLE / count(*)::DOUBLE
                    / {url_model.STEP}::DOUBLE) AS BIGINT) AS step
  FROM places JOIN ratios USING (gram) WHERE label IS NULL OR held GROUP BY url),
steps AS (
  SELECT step, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS r
  FROM scores WHERE label IS NOT NULL GROUP BY step),
gains AS (
  SELECT step, sum(a) OVER (ORDER BY step DESC) * (SELECT sum(r) FROM steps)
               - sum(r) OVER (ORDER BY step DESC) * (SELECT sum(a) FROM steps) AS gain FROM steps),
cut AS (SELECT coalesce((SELECT step FROM gains WHERE gain > 0 ORDER BY gain DESC, step LIMIT 1), 0) AS threshold)
SELECT page_id, host, path, rule,
       coalesce(ruled.label, CASE WHEN step >= threshold THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled LEFT JOIN scores ON ruled.url = scores.url AND ruled.label IS NULL, cut
"""


OP12 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN docs.doc_id > min(docs.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails
  FROM docs LEFT JOIN marks ON docs.doc_id = marks.doc_id),
masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails),
subsets AS (SELECT unnest(range(32)) AS s),
survivors AS (
  SELECT part, s, sum(CASE WHEN fails & s = 0 THEN n ELSE 0 END) AS n,
         sum(CASE WHEN fails & s = 0 THEN good ELSE 0 END) AS good,
         sum(CASE WHEN fails & s = 0 THEN toxic ELSE 0 END) AS toxic
  FROM masks, subsets GROUP BY part, s),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
places AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
         list_sum([1 << (instr('ABCDE', x) - 1) FOR x IN string_split(substr(filter_order, 1, step), '')])::INT AS after_set,
         1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1) AS bit
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
steps AS (
  SELECT x.part, p.filter_order, p.step, p.letter, y.n AS kept, x.n - y.n AS removed,
         z.n - f.n - (x.n - y.n) AS redundant, o.n - a.n AS unique_fails,
         x.good - y.good AS good_lost, x.toxic - y.toxic AS toxic_lost
  FROM places p
  JOIN survivors x ON x.s = p.after_set - p.bit
  JOIN survivors y ON y.part = x.part AND y.s = p.after_set
  JOIN survivors z ON z.part = x.part AND z.s = 0
  JOIN survivors f ON f.part = x.part AND f.s = p.bit
  JOIN survivors o ON o.part = x.part AND o.s = 31 - p.bit
  JOIN survivors a ON a.part = x.part AND a.s = 31)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM steps
"""


def importance_sql() -> str:
    """CRC-32 byte by byte from its table; each distinct run of words once."""
    table = ", ".join(str(int(x)) for x in importance._CRC)
    buckets, (part, whole) = importance.BUCKETS, importance.SHARE
    return rf"""
WITH t AS (
  SELECT 'd' AS k, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
w AS (
  SELECT k, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
pieces AS (  -- a stretch of 100 words and the two after it, so that no long list is repeated a word
  SELECT k, r, w[a:a + 101] AS w, len(w) - a + 1 AS n FROM (SELECT k, r, w, unnest(range(1, len(w) + 1, 100)) AS a FROM w)),
runs AS (
  SELECT k, r, w[i] AS run FROM (SELECT k, r, w, unnest(range(1, least(n, 100) + 1)) AS i FROM pieces)
  UNION ALL SELECT k, r, w[i] || ' ' || w[i + 1] FROM (SELECT k, r, w, unnest(range(1, least(n - 1, 100) + 1)) AS i FROM pieces)
  UNION ALL SELECT k, r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (
    SELECT k, r, w, unnest(range(1, least(n - 2, 100) + 1)) AS i FROM pieces)),
crc AS (SELECT [{table}]::BIGINT[] AS c),
bytes AS (
  SELECT run, list_transform(range(1, length(x) // 2 + 1), lambda i:
    16 * (instr('0123456789ABCDEF', substr(x, 2 * i - 1, 1)) - 1) + instr('0123456789ABCDEF', substr(x, 2 * i, 1)) - 1) AS b
  FROM (SELECT run, hex(run) AS x FROM (SELECT DISTINCT run FROM runs))),
buckets AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda x, y:
    xor(c[(xor(x, y::BIGINT) & 255) + 1], x >> 8)), 4294967295::BIGINT) % {buckets} AS bucket FROM bytes, crc),
counts AS (SELECT k, bucket, count(*) AS n FROM runs JOIN buckets USING (run) GROUP BY k, bucket),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (k = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (k = 'b'), 0)::BIGINT AS t
  FROM counts GROUP BY bucket),
total AS (SELECT sum(s)::BIGINT AS s_all, sum(t)::BIGINT AS t_all FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + {buckets}))::DOUBLE / ((s + 1) * (t_all + {buckets}))::DOUBLE))::BIGINT AS gain
  FROM sums, total),
weights AS (
  SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM runs JOIN buckets USING (run) JOIN gains USING (bucket) WHERE k = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN weights ON w.r = weights.r WHERE k = 'd'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {importance.MIN_WORDS} ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_words >= {importance.MIN_WORDS}) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {importance.MIN_WORDS} AND place <= {part} * n // {whole} THEN place END AS rank FROM ranked
"""


OP11 = importance_sql()

OP13 = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, unnest(hashes) AS h, unnest(range(1, len(hashes) + 1)) AS i FROM (
    SELECT r, doc_id, list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' '))) AS hashes FROM t)),
firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS j FROM windows JOIN firsts USING (h) WHERE doc_id > first_id),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM t),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY j) AS k, count(*) AS n FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN kept ON t.r = kept.r
"""
