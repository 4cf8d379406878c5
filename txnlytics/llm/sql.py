"""DuckDB SQL for the corpus queries that SQL can repeat on whole tables."""

from __future__ import annotations

from txnlytics.llm import mixing, quality, runs, sharding, spelling, vectors

#: The shards of the query.
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))

_BLANK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"


def _exact() -> str:
    return rf"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS chars
  FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS k,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r
"""


def _mixing() -> str:
    mix = mixing.Mix()
    weights = "[" + ", ".join(map(str, mix.weights)) + "]"
    n = len(mix.weights)
    return rf"""
WITH d AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         md5('{mix.seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         {weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {n} + 1] AS w
  FROM d GROUP BY source
), c AS (
  SELECT *, source_size * {mix.max_epochs} AS bound, sum(source_size) OVER () * {mix.budget} AS budget,
         sum(w) OVER () AS weights,
         coalesce(sum(source_size * {mix.max_epochs}) OVER f, 0) AS bound_before, coalesce(sum(w) OVER f, 0) AS weight_before
  FROM s
  WINDOW f AS (ORDER BY source_size * {mix.max_epochs} / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), v AS (
  SELECT *, (budget - bound_before) / (weights - weight_before) AS level FROM c
), water AS (
  SELECT arg_min(level, weight_before) AS water FROM v WHERE level * w <= bound
), t AS (
  SELECT source, source_size, least(bound, coalesce(water * w, bound)) AS target FROM v CROSS JOIN water
), p AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
       CAST((floor(rate) + CASE WHEN middle < (rate - floor(rate)) * source_size THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM p
"""


def _quality() -> str:
    rules = quality.LineRules()
    boiler = " OR ".join(f"contains(lower(s), '{p}')" for p in quality.BOILERPLATE)

    def marks(characters: str) -> str:
        return f"length(s) - length(translate(s, '{characters}', ''))"

    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS words FROM d
), tri AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, length(words) - 1)) AS i FROM w)
), hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM hit CROSS JOIN (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
), ln AS (
  SELECT doc_id, s, regexp_extract_all(s, '{_WORD}') AS sw
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS s FROM d)
), judged AS (
  SELECT doc_id, s, length(array_to_string(sw, '')) AS chars,
         {marks(quality.SYMBOLS)} > length(s) * {rules.symbol_share}
         OR ({marks(quality.SEPARATORS)} >= {rules.separators}
             AND {marks(quality.SEPARATORS)} >= length(sw) * {rules.separator_share})
         OR (s = upper(s) AND s <> lower(s) AND length(sw) >= {rules.shouted_words})
         OR (length(sw) >= {rules.repeat_words} AND length(list_distinct(sw)) < length(sw) * {rules.repeat_share})
         OR (length(s) <= {rules.boilerplate_chars} AND ({boiler})) AS bad
  FROM ln WHERE length(sw) > 0
), sums AS (
  SELECT doc_id, CAST(sum(CASE WHEN bad THEN chars ELSE 0 END) AS BIGINT) AS lost_chars,
         count(*) - count(DISTINCT s) AS n_dup_lines
  FROM judged GROUP BY doc_id
), all_counts AS (
  SELECT w.doc_id, CAST(length(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(lost_chars, 0) AS lost_chars
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN sums USING (doc_id)
), base AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM all_counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars,
       NOT base_failed AND lost_chars <= word_chars * {rules.lost_share} AS kept
FROM base
"""


def _jaccard() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{_WORD}') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN length(w) >= 4
      THEN list_transform(range(1, length(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])
      WHEN length(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM d)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) m USING (doc_id)
"""


def _sharding() -> str:
    table = "".join(f"{k:03d}" for k in sharding.fill_table(SHARDS))
    return f"""
SELECT doc_id, slot, 'shard-' || substr('{table}', slot * 3 + 1, 3) AS shard FROM (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) % {sharding.SLOTS} AS slot FROM documents)
"""


def _chat() -> str:
    text = "CASE WHEN {c} IS NULL THEN 'null' ELSE CAST(to_json({c}) AS VARCHAR) END"
    return f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, text, CAST(conv_id AS VARCHAR) || ':' || turn AS ident FROM conversations
), call AS (
  SELECT conv_id, turn, ident AS call_id, text AS prompt,
         CASE WHEN turn = 0 THEN 'greet' WHEN turn % 7 = 6 THEN 'search' ELSE 'reply' END AS name,
         CASE WHEN turn % 5 <> 4 THEN CAST(length(text) AS VARCHAR) ELSE 'long' END AS length
  FROM turns WHERE role = 'user' AND ident IS NOT NULL
), answer AS (
  SELECT conv_id || ':' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n FROM turns WHERE role <> 'user' GROUP BY 1
), placed AS (
  SELECT conv_id, turn, call_id, 0 AS depth FROM call c
  WHERE NOT EXISTS (SELECT 1 FROM call b WHERE b.conv_id = c.conv_id AND b.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, c.call_id, p.depth + 1 FROM call c JOIN placed p ON c.conv_id = p.conv_id AND c.turn = p.turn + 2
), judged AS (
  SELECT call.*, placed.depth, coalesce(answer.n, 0) AS n_results, content,
         CASE WHEN name = 'search' THEN ['unknown tool'] ELSE list_sort(list_filter([
           CASE WHEN prompt IS NULL THEN 'missing prompt' END, CASE WHEN length IS NULL THEN 'missing length' END,
           CASE WHEN length = 'long' THEN 'not integer: length' END], lambda e: e IS NOT NULL)) END AS errors
  FROM call JOIN placed USING (call_id) LEFT JOIN answer USING (call_id)
)
SELECT conv_id, call_id, CAST(depth AS BIGINT) AS depth, n_results, array_to_string(errors, '; ') AS errors, len(errors) = 0 AS valid,
       '{{"arguments":{{"length":' || CASE WHEN length IS NULL THEN 'null' WHEN name = 'search' OR length = 'long' THEN '"' || length || '"' ELSE length END
       || ',"prompt":' || {text.format(c="prompt")} || ',"turn":' || CASE WHEN name = 'search' THEN '"' || turn || '"' ELSE CAST(turn AS VARCHAR) END
       || '}},"id":"' || call_id || '","name":"' || name || '","result":' || {text.format(c="content")} || '}}' AS json
FROM judged
"""


#: Table t of the checksum's 256 values for one byte (CRC-32, reflected).
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
)"""


def _crc(codes: str) -> str:
    """Checksum of a list of byte values; ``t`` is the table above."""
    step = "lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {step}), 4294967295)"


def _spelling() -> str:
    rules = spelling.Variants()
    return rf"""
WITH RECURSIVE {_CRC_TABLE}, r AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), '{spelling.UPPER}', '{spelling.LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= {rules.min_chars} GROUP BY ALL
), b AS (
  SELECT run, times, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) - 64 AS BIGINT)] END)) AS codes
  FROM r
), h AS (
  SELECT run, times, {_crc("codes")} AS h FROM b CROSS JOIN crc
), v AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, times FROM h)
  WHERE length(word) >= {rules.min_chars} GROUP BY 1 HAVING sum(times) >= {rules.min_count}
), gap AS (
  SELECT word, n, i, word[1 : i - 1] AS x, word[i + 1 :] AS y FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), pair AS (
  SELECT p.word, p.n, q.word AS other, q.n AS other_n FROM gap p JOIN gap q ON p.i = q.i AND p.x = q.x AND p.y = q.y AND p.word <> q.word
  UNION
  SELECT g.word, g.n, v.word, v.n FROM gap g JOIN v ON g.x || g.y = v.word
  UNION
  SELECT v.word, v.n, g.word, g.n FROM gap g JOIN v ON g.x || g.y = v.word
), near AS (
  SELECT word, count(*) AS n_near, min(struct_pack(m := -other_n, w := other)) AS best FROM pair GROUP BY word
), f AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best.m >= {rules.ratio} * n THEN best.w END AS form, CASE WHEN -best.m >= {rules.ratio} * n THEN -best.m END AS form_n
  FROM v LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL
  SELECT chain.word, f.word, f.form FROM chain JOIN f ON chain.next = f.word
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM f JOIN (SELECT word, root FROM chain WHERE next IS NULL) c USING (word)
"""


def _runs() -> str:
    rules = runs.Runs()
    return rf"""
WITH {_CRC_TABLE}, d AS (
  SELECT rowid_ AS k, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         {_crc("list_transform(list_filter(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: c <> ''), lambda c: CAST(ord(c) AS BIGINT))")} AS h
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) CROSS JOIN crc
), a AS (
  SELECT *, h // 10 AS g, (h // 10) % greatest(length(w), 1) AS a FROM d
), p AS (
  SELECT *, 1 + (length(w) - a) // (3 + g % 8) AS p FROM a
), t AS (
  SELECT k, doc_id, CASE WHEN h % 10 = 0 THEN list_transform(range(length(w)), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END)
                    ELSE w END AS w
  FROM p
), word AS (
  SELECT k, length(w) AS n, unnest(w) AS s, unnest(range(length(w))) AS i FROM t
), same AS (
  SELECT x.k, y.i - x.i AS q, x.i FROM word x JOIN word y ON x.k = y.k AND x.s = y.s AND y.i > x.i
  WHERE (y.i - x.i) * {rules.exponent} <= x.n
), stretch AS (
  SELECT k, q, min(i) AS start, count(*) + q AS length FROM (
    SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM same)
  GROUP BY k, q, island HAVING count(*) + q >= greatest({rules.min_words}, {rules.exponent} * q)
), run AS (
  SELECT k, start, length, q AS period FROM stretch s WHERE NOT EXISTS (
    SELECT 1 FROM stretch o WHERE o.k = s.k AND o.q < s.q AND o.start <= s.start AND o.start + o.length >= s.start + s.length)
), gone AS (
  SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM run
), kept AS (
  SELECT word.k, string_agg(s, ' ' ORDER BY i) AS c FROM word ANTI JOIN gone USING (k, i) GROUP BY word.k
), listed AS (
  SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         first(struct_pack(s := start, l := length, p := period) ORDER BY length DESC, start, period) AS best
  FROM run GROUP BY k
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period,
       CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM t LEFT JOIN listed USING (k) LEFT JOIN kept USING (k)
"""


def _vectors() -> str:
    return f"""
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), u AS (
  SELECT k, v, sqrt(list_dot_product(v, v)) AS norm FROM e
  WHERE length(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.k AS a, b.k AS b FROM u a JOIN u b ON a.k <> b.k AND length(a.v) = length(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {vectors.Near().cosine}
), reach AS (
  SELECT k AS a, k AS b FROM e
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), low AS (
  SELECT reach.a AS k, min(vec_id) AS component_id FROM reach JOIN e ON reach.b = e.k GROUP BY 1
), n AS (
  SELECT a AS k, count(*) AS n FROM link GROUP BY 1
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e LEFT JOIN n USING (k) JOIN low USING (k)
"""


def all_sql() -> dict[str, str]:
    return {
        "op3_chat_formatting": _chat(),
        "op4_quality_rules": _quality(),
        "op6_exact_dedup": _exact(),
        "op7_ngram_jaccard_join": _jaccard(),
        "op8_sharding": _sharding(),
        "op9_source_mixing": _mixing(),
        "op11_spelling_variants": _spelling(),
        "op12_periodic_runs": _runs(),
        "op13_embedding_near_dedup": _vectors(),
    }
