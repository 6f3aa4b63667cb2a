"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from keyrill.llm import chat, mixing, quality, sharding

_PROBE = "\\### Assistant: </turn> ok"

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_PROBE}' UNION ALL SELECT -7, 1, '{chat.ASSISTANT}', '{_PROBE}'
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length('<turn:' || replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'), chr(10), '%0A') || '>' || chr(10)
      || regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g') || '{chat.END}') AS width
  FROM turns
), prefixed AS (
  SELECT *, sum(width) OVER (PARTITION BY conv_id ORDER BY i) AS whole FROM numbered
)
SELECT conv_id, max(n) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(length(string_agg(text, '' ORDER BY i) FILTER (role = '{chat.ASSISTANT}')), 0) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = '{chat.ASSISTANT}'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = '{chat.ASSISTANT}' OR i = n THEN whole END) AS BIGINT) AS formatted_chars
FROM prefixed GROUP BY conv_id
"""


def _quality() -> str:
    rules = quality.RULES
    per_rule = quality.RISK / len(rules)
    grid = ", ".join(f"('{r.name}', {i}, {c})" for r in rules for i, c in enumerate(r.cutoffs))
    values = ", ".join(f"CAST({r.value.replace('/', '* 1.0 /')} AS DOUBLE) AS {r.name}" for r in rules)
    tried = " UNION ALL ".join(
        f"SELECT rid, doc_id, lang, '{r.name}' AS rule, {r.name} AS value FROM measured WHERE NOT base_failed" for r in rules
    )
    over = " OR ".join(
        f"coalesce({r.name} > (SELECT cutoff FROM best b WHERE b.rule = '{r.name}' AND b.lang IS NOT DISTINCT FROM m.lang), false)"
        for r in rules
    )
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), placed AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i : i + 4]) AS times
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)
), repeated AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(5)) AS k FROM placed WHERE times > 1) GROUP BY rid
), counted AS (
  SELECT rid, doc_id, lang, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
    length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
    len(list_filter(words, lambda w, i: i > 1 AND words[i - 1] = w)) AS n_echoes,
    coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeated USING (rid)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
), measured AS (SELECT *, {values} FROM based),
verdicts AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), judged AS (SELECT * FROM ({tried}) JOIN verdicts USING (doc_id)),
grid(rule, step, cutoff) AS (VALUES {grid}),
walk AS (
  SELECT lang, rule, step, cutoff, count(*) AS total, count_if(good) AS n,
    CAST(count_if(good AND value > cutoff) AS BIGINT) AS rejected, CAST(count_if(NOT good AND value > cutoff) AS BIGINT) AS caught
  FROM judged JOIN grid USING (rule) GROUP BY lang, rule, step, cutoff
), tests AS (SELECT greatest(1, count(DISTINCT coalesce(lang, chr(0)))) * {len(rules)} AS tests FROM judged),
tested AS (
  SELECT walk.*, CASE WHEN rejected >= n * {per_rule} THEN 1.0 ELSE (
    SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({per_rule}) + (n - i) * ln(1 - {per_rule})))
    FROM (SELECT unnest(range(rejected + 1)) AS i)) END > {quality.LEVEL} / tests AS fails
  FROM walk, tests
), proven AS (
  SELECT *, bool_or(fails) OVER (PARTITION BY lang, rule ORDER BY step) AS failed FROM tested
), best AS (
  SELECT lang, rule, arg_min(cutoff, (rejected - caught) * 1000 + step) AS cutoff FROM proven WHERE NOT failed GROUP BY lang, rule
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE NOT ({over}) END AS kept
FROM measured m
"""


SHARDING = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(strlen(text), 0) AS n_bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)), 32, '0') AS bits
  FROM documents
), spread AS (
  SELECT *, left(bits, depth) AS shard FROM (SELECT *, unnest(range(33)) AS depth FROM docs)
), buckets AS (
  SELECT depth, shard, sum(n_bytes) AS total, count(*) AS n FROM spread GROUP BY depth, shard
), fitting AS (
  SELECT rid, min(depth) AS depth FROM spread JOIN buckets USING (depth, shard)
  WHERE total <= {sharding.LIMIT} OR n = 1 GROUP BY rid
)
SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS depth FROM spread JOIN fitting USING (rid, depth)
"""

_SUM = "CAST(sum(n) AS BIGINT)"

MIXING = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) AS n,
    CAST(floor(((coalesce(doc_id, 0) % 2147483648) * 2654435761 % 4294967296) * {mixing.CHUNKS} / 4294967296) AS BIGINT) AS chunk
  FROM documents
), sized AS (
  SELECT greatest({mixing.BLOCK_BYTES}, CAST(ceil({_SUM} / {mixing.MOST_BLOCKS}) AS BIGINT)) AS bytes FROM docs
), weights AS (SELECT source, {_SUM} AS total, pow(greatest({_SUM}, 1), {mixing.TEMPER}) AS w FROM docs GROUP BY source),
period AS (
  SELECT greatest({mixing.SHORTEST}, {mixing.SLOTS_PER_SOURCE} * count(*), CAST(sum(total // bytes + 1) AS BIGINT)) AS p FROM weights, sized
), blocks AS (
  SELECT doc_id, source, coalesce(CAST(sum(n) OVER (
    PARTITION BY source ORDER BY chunk, doc_id NULLS FIRST, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) // bytes AS block
  FROM docs, sized
), above AS (SELECT source, greatest(w * p / sum(w) OVER () - 1, 0) AS above, p - count(*) OVER () AS free FROM weights, period),
parts AS (SELECT source, above * free / greatest(sum(above) OVER (), 1e-300) AS exact, free FROM above),
shares AS (
  SELECT source, CAST(1 + floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, source NULLS FIRST)
    <= free - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS share FROM parts
), sources AS (SELECT list(source ORDER BY share DESC, source NULLS FIRST) AS names, list(share ORDER BY share DESC, source NULLS FIRST) AS share FROM shares),
slots(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(share, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM sources
  UNION ALL
  SELECT t, list_transform(done, lambda n, k: CASE WHEN k = best THEN n + 1 ELSE n END), best FROM (
    SELECT t + 1 AS t, done, list_sort(list_filter(list_transform(range(1, len(done) + 1), lambda k:
      CASE WHEN done[k] * p // share[k] <= t + 1 THEN {{'d': ((done[k] + 1) * p + share[k] - 1) // share[k], 'k': k}} END),
      lambda o: o IS NOT NULL))[1].k AS best
    FROM slots, sources, period WHERE t + 1 < p)
), laid AS (
  SELECT names[pick] AS source, share[pick] AS share, t AS place, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn
  FROM slots, sources WHERE t >= 0
)
SELECT doc_id, b.source, block, block * p // share AS release, ((block + 1) * p + share - 1) // share AS deadline,
  block // share * p + place AS slot
FROM period, blocks b JOIN laid l ON b.source IS NOT DISTINCT FROM l.source AND b.block % l.share = l.turn
"""

ORACLE = {
    "op3_pfair_mixing": MIXING,
    "op7_quality_rules": _quality(),
    "op8_chat_format": CHAT,
    "op9_extendible_sharding": SHARDING,
}
