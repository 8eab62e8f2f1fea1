"""SQL for DuckDB that says the same as the queries, where SQL can."""

import string

from valora.llm import quality

_LOWER = "translate(coalesce(text, ''), '{}', '{}')".format(string.ascii_uppercase, string.ascii_lowercase)
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"'[^\x20\x09-\x0D]+'"

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM (SELECT d.*, s.n, unnest(range(1, len(w) - s.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) s WHERE len(w) >= s.n)),
met AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw USING (n, t)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM met GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

COMPONENTS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS x FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS p, b.doc_id AS q, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT p, q FROM both_ JOIN n np ON np.doc_id = p JOIN n nq ON nq.doc_id = q WHERE 100 * c >= 90 * (np.n + nq.n - c)),
either_ AS (SELECT p, q FROM links UNION ALL SELECT q, p FROM links),
reach AS (SELECT DISTINCT p, p AS q FROM either_ UNION SELECT reach.p, either_.q FROM reach JOIN either_ ON reach.q = either_.p),
least_ AS (SELECT p, min(q) AS q FROM reach GROUP BY p)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(least_.q, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_ ON least_.p = d.doc_id"""


def _metric(rule: quality.Rule) -> str:
    return f"CAST(floor(greatest(0.0, least(1.0, {rule.metric})) * {quality.STEPS}) AS INTEGER)"


_RULES, _RISK = len(quality.RULES), quality.RISK / len(quality.RULES)
QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {_SPACED}) AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
t AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS k FROM t) WHERE k > 1),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
f AS (SELECT w.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cover USING (doc_id)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
s AS (SELECT doc_id, stratum, base_failed, {", ".join(f"{_metric(r)} AS {r.name}" for r in quality.RULES)} FROM g),
x AS (SELECT stratum, rule, step, good FROM (UNPIVOT (SELECT s.*, y.good FROM s JOIN (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) y
      USING (doc_id) WHERE NOT base_failed) ON {", ".join(r.name for r in quality.RULES)} INTO NAME rule VALUE step)),
c AS (SELECT stratum, rule, step, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad FROM x GROUP BY ALL),
r AS (SELECT stratum, rule, step, sum(good) OVER every AS good, sum(bad) OVER every AS bad, sum(good) OVER beyond AS good_rejected, sum(bad) OVER beyond AS bad_rejected
      FROM c WINDOW every AS (PARTITION BY stratum, rule), beyond AS (PARTITION BY stratum, rule ORDER BY step DESC)),
passed AS (SELECT stratum, rule, min(step) AS limit_ FROM r WHERE step > 0 AND good_rejected < good * {_RISK} AND bad_rejected * good > good_rejected * bad
           AND list_sum(list_transform(range(0, CAST(good_rejected AS BIGINT) + 1), lambda i: exp(lgamma(good + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END
               - lgamma(good - i + 1) + i * ln({_RISK}) + (good - i) * ln(1 - {_RISK})))) <= {quality.LEVEL} / (SELECT greatest(1, count(DISTINCT stratum)) FROM c) / {_RULES} / {quality.STEPS}
           GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id FROM (UNPIVOT s ON {", ".join(r.name for r in quality.RULES)} INTO NAME rule VALUE step) JOIN passed USING (stratum, rule) WHERE step >= limit_)
SELECT g.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND gone.doc_id IS NULL AS kept
FROM g LEFT JOIN gone USING (doc_id)"""


RANKED = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT doc_id, x, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS x FROM d) GROUP BY ALL),
s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d),
l AS (SELECT doc_id, 100 - 50 + (50 * len(w) * docs) // terms AS m FROM d, s WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, x FROM (SELECT item_id, unnest(w) AS x FROM (SELECT item_id, {_WORDS} AS w FROM benchmark))),
g AS (SELECT x, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY x),
r AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN g USING (x) JOIN t USING (x) JOIN l USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 50"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _crc32(text: str) -> str:
    """Bit by bit over the text's bytes."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    values = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {values}, lambda c, b: {step}), 4294967295)"


MANIFEST = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS lang, lang IS NOT NULL AS named, {_leaf("n_chars")} AS leaf, {_leaf("(n_chars + 1)")} AS tampered,
                            {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AS touched FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY named, lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY named, lang) AS size FROM d),
up AS (SELECT named, lang, size, 0 AS level, pos, leaf AS node FROM p UNION ALL
       SELECT named, lang, size, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM up WHERE (1 << level) < size GROUP BY named, lang, size, level, pos // 2),
subroots AS (SELECT named, lang, node AS subroot, row_number() OVER (ORDER BY named, lang) - 1 AS pos, count(*) OVER () AS size FROM up WHERE (1 << level) >= size),
top AS (SELECT size, 0 AS level, pos, subroot AS node FROM subroots UNION ALL
        SELECT size, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE (1 << level) < size GROUP BY size, level, pos // 2),
root AS (SELECT node AS root FROM top WHERE (1 << level) >= size),
steps AS (SELECT doc_id, up.level, up.pos < p.pos // (1 << up.level) AS before, up.node FROM p JOIN up USING (named, lang)
          WHERE (1 << up.level) < p.size AND up.pos = xor(p.pos // (1 << up.level), 1)
          UNION ALL
          SELECT doc_id, 100 + top.level, top.pos < subroots.pos // (1 << top.level), top.node FROM p JOIN subroots USING (named, lang) JOIN top
          ON (1 << top.level) < subroots.size AND top.pos = xor(subroots.pos // (1 << top.level), 1)),
high AS (SELECT p.doc_id, p.leaf, p.tampered, p.touched, p.size, subroots.size AS tops, subroots.subroot, root.root FROM p JOIN subroots USING (named, lang), root),
fold AS (SELECT doc_id, 0 AS level, CASE WHEN touched THEN tampered ELSE leaf END AS node, size, tops FROM high UNION ALL
         SELECT fold.doc_id, CASE WHEN fold.level < 100 AND (1 << least(fold.level, 30)) >= size THEN 100 ELSE fold.level + 1 END,
                CASE WHEN fold.level < 100 AND (1 << least(fold.level, 30)) >= size THEN fold.node
                     ELSE sha256(CASE WHEN before THEN steps.node ELSE '' END || fold.node || CASE WHEN NOT before THEN steps.node ELSE '' END) END, size, tops
         FROM fold LEFT JOIN steps USING (doc_id, level) WHERE fold.level < 100 OR (1 << greatest(fold.level - 100, 0)) < tops),
proofs AS (SELECT doc_id, string_agg(node, '' ORDER BY level) AS proof FROM steps GROUP BY doc_id)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, fold.node AS folded_root, fold.node = root AS verified
FROM high JOIN fold USING (doc_id) LEFT JOIN proofs USING (doc_id) WHERE fold.level >= 100 AND (1 << greatest(fold.level - 100, 0)) >= fold.tops"""


def _jumped(shards: int) -> str:
    return f"""(WITH RECURSIVE j AS (SELECT doc_id, CAST(('0x' || sha256(coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'))[1:16]) AS UBIGINT) AS state,
    CAST(0 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS next FROM documents UNION ALL
  SELECT doc_id, state, next, CAST(floor((next + 1) * (2147483648.0::DOUBLE / CAST((state >> 33) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, next, CAST((CAST(state AS HUGEINT) * 2862933555777941757 + 1) % 18446744073709551616 AS UBIGINT) AS state FROM j WHERE next < {shards}))
SELECT doc_id, CAST(max(shard) AS INTEGER) AS shard FROM j GROUP BY doc_id)"""


SHARDS = f"""
WITH s AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, coalesce(text, '') AS text FROM documents)
SELECT doc_id, size, {_crc32("text")} AS text_crc32, 'key' AS law, now_.shard, row_number() OVER (PARTITION BY now_.shard ORDER BY doc_id) - 1 AS slot, grown.shard AS grown_shard
FROM s JOIN {_jumped(24)} now_ USING (doc_id) JOIN {_jumped(25)} grown USING (doc_id)"""
