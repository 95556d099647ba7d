"""SQL that computes the same answers as the operators' queries, for DuckDB.

Classifiers, sketches and tokenizers have no SQL form; they are tested against brute force.
"""

from __future__ import annotations

from caseloom.llm import chat, decontaminate, licences, mixing, secrets

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _nibble(k: int) -> int:
    for _ in range(4):
        k = k >> 1 ^ 0xEDB88320 * (k & 1)
    return k


def _crc32(value: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes: two shifts by four bits a byte, folded over a list."""
    steps = f"flatten(list_transform(regexp_extract_all(hex({value}), '..'), lambda x: [CAST('0x' || x AS BIGINT), 0]))"
    table = f"[{', '.join(str(_nibble(k)) for k in range(16))}]"
    return (f"xor(list_reduce(list_prepend(4294967295, {steps}), "
            f"lambda c, b: xor(xor(c, b) >> 4, {table}[(xor(c, b) & 15) + 1])), 4294967295)")


_ITEM_WORDS = f"regexp_extract_all({_LOWERED}, {_text(decontaminate.LOWER_WORD)})"


def _words(table: str, key: str = "doc_id") -> str:
    """(key, w): the lower-cased words of a table's texts, as decontamination and resampling take them."""
    return f"SELECT {key}, {_ITEM_WORDS} AS w FROM {table}"


ORACLES: dict[str, str] = {}

_HEAD, _REST = "'<|' || coalesce(role, '') || '|>' || chr(10)", f"coalesce(text, '') || {_text(chat.END)}"
_PARTS = ", ".join(
    f"coalesce(string_agg(rendered, '' ORDER BY position) FILTER (part = '{part}'), '') AS {part}"
    for part in ("prompt", "chosen", "rejected"))
_MASKS = ", ".join(
    f"coalesce(string_agg((start + head) || ':' || (start + length(rendered)), ',' ORDER BY position) "
    f"FILTER (part = '{part}' AND role = 'assistant'), '') AS {part}_mask" for part in ("chosen", "rejected"))
ORACLES["op1_preference_format"] = f"""
WITH c AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
 l AS (SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS reply FROM c WHERE role = 'assistant' GROUP BY 1),
 sides AS (
  SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM c
  UNION ALL SELECT c.conv_id, 'rejected', turn, role, text FROM c LEFT JOIN l USING (conv_id) WHERE last_turn IS NULL OR turn < last_turn
  UNION ALL SELECT l.conv_id, 'rejected', l.last_turn, 'assistant', o.reply FROM l JOIN l o ON o.conv_id = xor(l.conv_id, 1)),
 p AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS position FROM sides),
 f AS (SELECT pair_id, position, count(*) = 2 AND count(DISTINCT (role, text)) = 1 AS same FROM p GROUP BY 1, 2),
 x AS (SELECT pair_id, coalesce(min(position) FILTER (NOT same) - 1, max(position)) AS prefix FROM f GROUP BY 1),
 r AS (SELECT p.*, prefix, CASE WHEN position <= prefix THEN 'prompt' ELSE side END AS part,
              length({_HEAD}) AS head, {_HEAD} || {_REST} AS rendered
       FROM p JOIN x USING (pair_id) WHERE position > prefix OR side = 'chosen'),
 s AS (SELECT *, coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, part ORDER BY position
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM r)
SELECT pair_id, CAST(max(prefix) AS BIGINT) AS prompt_turns, {_PARTS}, {_MASKS} FROM s GROUP BY pair_id"""

_KINDS = ", ".join(
    f"list_transform(range(1, len(m{k}) + 1), lambda i: {{'start': CAST(coalesce(list_sum(list_transform(g{k}[1:i], lambda x: length(x))), 0) "
    f"+ coalesce(list_sum(list_transform(m{k}[1:i - 1], lambda x: length(x))), 0) AS BIGINT), 'kind_order': {k}, "
    f"'long': length(m{k}[i]), 'counted': length(c{k}[i]) >= {rule.least}, 'kind': '{rule.kind}'}})"
    for k, rule in enumerate(secrets.RULES))
_FOUND = ", ".join(
    f"string_split_regex(t, {_text(rule.pattern)}) AS g{k}, regexp_extract_all(t, {_text(rule.pattern)}) AS m{k}, "
    f"regexp_extract_all(t, {_text(rule.pattern)}, {rule.group}) AS c{k}"
    for k, rule in enumerate(secrets.RULES))
_COUNTS = ", ".join(
    f"len(list_filter(s, lambda x: x.kind = '{rule.kind}')) AS n_{rule.kind}" for rule in secrets.RULES)
ORACLES["op3_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 f AS (SELECT doc_id, sha256(t) AS blob, {_FOUND} FROM d),
 s AS (SELECT doc_id, blob, list_sort(list_filter(flatten([{_KINDS}]), lambda x: x.counted)) AS s FROM f),
 o AS (SELECT doc_id, blob, {_COUNTS}, array_to_string(list_transform(s, lambda x: x.kind || ':' || x.start || ':' || (x.start + x.long)), ',') AS spans FROM s)
SELECT doc_id, n_assign, n_access, n_hex, sha256(spans) AS base_sha256, spans, blob FROM o"""

ORACLES["op4_decontamination"] = f"""
WITH b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
 i AS (SELECT item_id, w, least(len(w), {decontaminate.WINDOW_WORDS}) AS n FROM b WHERE len(w) > 0),
 g AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS gram
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
 d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
 k AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM g))),
 h AS (SELECT doc_id, item_id, p, k.n FROM k JOIN g USING (gram, n)),
 c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY 1),
 m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""

_NORMAL = "array_to_string(regexp_extract_all(lower(u), '[^\\x20\\x09-\\x0D\\x1C-\\x1F]+'), ' ')"
ORACLES["op8_repeated_lines"] = f"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS us FROM documents),
 u AS (SELECT doc_id, i, us[i] AS u, CAST(coalesce(list_sum(list_transform(us[1:i - 1], lambda x: length(x) + 1)), 0) AS BIGINT) AS start
       FROM (SELECT *, unnest(range(1, len(us) + 1)) AS i FROM d)),
 k AS (SELECT *, {_NORMAL} AS k FROM u),
 r AS (SELECT *, k != '' AND row_number() OVER (PARTITION BY k ORDER BY doc_id, start) > 1 AS gone,
         CASE WHEN k != '' THEN len(string_split(k, ' ')) ELSE 0 END AS words FROM k),
 b AS (SELECT *, sum(CASE WHEN gone OR k = '' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS kept_before FROM r),
 m AS (SELECT doc_id, max(words) AS longest_removed FROM (
   SELECT doc_id, kept_before, CAST(sum(words) AS BIGINT) AS words FROM b WHERE gone GROUP BY ALL) GROUP BY 1),
 s AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, CAST(coalesce(sum(words) FILTER (gone), 0) AS BIGINT) AS removed_words,
         coalesce(string_agg(start || ':' || (start + length(u)), ',' ORDER BY i) FILTER (gone), '') AS spans,
         coalesce(string_agg(u, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept FROM r GROUP BY 1)
SELECT doc_id, n_removed, spans, CASE WHEN text IS NOT NULL THEN kept END AS text, removed_words,
       coalesce(longest_removed, 0) AS longest_removed, coalesce(longest_removed, 0) >= 20 AS repeats_passage
FROM s JOIN d USING (doc_id) LEFT JOIN m USING (doc_id)"""

_KNOWN = ", ".join(f"({_text(head)}, {_text(tail)}, '{name}')" for head, tail, name in licences.known_sentences(licences.SENTENCES))
_RULE_TEXTS = ["".join(f",{s}," for s in rule) for _, rule in licences.RULES]
_NAMES = " ".join(f"WHEN '{text}' THEN '{name}'" for text, (name, _) in zip(_RULE_TEXTS, licences.RULES))
_TAKEN = f"regexp_extract_all(sequence, '{'|'.join(_RULE_TEXTS)}')"
ORACLES["op9_licence_scan"] = f"""
WITH RECURSIVE k(head, tail, name) AS (VALUES {_KNOWN}),
 y AS (SELECT *, array_to_string(string_split(head, ' ')[1:3], ' ') AS key FROM k),
 d AS (SELECT doc_id, list_filter(list_transform(string_split_regex(coalesce(text, ''), {_text(licences.SENTENCE_END)}),
     lambda x: CASE WHEN NOT regexp_matches(lower(x), '[a-z0-9]') AND regexp_matches(x, '[\\p{{L}}\\p{{N}}]') THEN '~'
                    ELSE trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')) END),
     lambda x: x != '') AS ps FROM documents),
 v AS (SELECT doc_id, ps, i, unnest([ps[i], regexp_replace(ps[i], '^{licences.ENTRY} ', '')]) AS first, unnest([0, 1]) AS bare
       FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM d)),
 c AS (SELECT * FROM v SEMI JOIN y ON y.key = array_to_string(string_split(concat_ws(' ', first, ps[i + 1], ps[i + 2]), ' ')[1:3], ' ')
       QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY bare) = 1),
 r AS (SELECT doc_id, i, j, array_to_string(list_concat([first], ps[i + 1:j]), ' ') AS run
       FROM (SELECT *, unnest(range(i, least(len(ps), i + 150) + 1)) AS j FROM c)),
 f AS (SELECT doc_id, i, name, min(j) AS j FROM r JOIN k ON CASE WHEN tail = '' THEN run = head ELSE
         starts_with(run, head) AND ends_with(run, tail) AND length(run) - length(head) - length(tail) < {licences.STAR_CHARS} END
       GROUP BY ALL),
 b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY j DESC, name DESC) = 1),
 g AS (SELECT * FROM (SELECT doc_id, i, j, name, 0 AS before FROM b QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) = 1)
       UNION ALL
       SELECT * FROM (SELECT b.doc_id, b.i, b.j, b.name, g.j AS before FROM g JOIN b ON b.doc_id = g.doc_id AND b.i > g.j
                      QUALIFY row_number() OVER (PARTITION BY b.doc_id ORDER BY b.i) = 1)),
 s AS (SELECT doc_id, count(*) AS n, string_agg(CASE WHEN before > 0 AND len(list_filter(ps[before + 1:i - 1], lambda x: NOT regexp_full_match(x, '{licences.ENTRY}'))) > 0 THEN ',' ELSE '' END || ',' || name || ',', '' ORDER BY i) AS q
       FROM g JOIN d USING (doc_id) GROUP BY 1),
 o AS (SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(q, '') AS sequence FROM d LEFT JOIN s USING (doc_id))
SELECT *, array_to_string(list_transform({_TAKEN}, lambda x: CASE x {_NAMES} END), ',') AS licences FROM o"""

ORACLES["op10_mixing"] = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_text(mixing.WORDS)})), 0) AS size FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
              [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM d GROUP BY 1),
 c AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place FROM s),
 v AS (SELECT *, CAST(3 * sum(source_size) OVER () - 4 * (sum(source_size) OVER w - source_size) AS BIGINT) AS rest,
              CAST(2 * (sum(weight) OVER () - sum(weight) OVER w + weight) AS BIGINT) AS per
       FROM c WINDOW w AS (ORDER BY place ROWS UNBOUNDED PRECEDING)),
 f AS (SELECT arg_min(rest, place) AS rest0, arg_min(per, place) AS per0 FROM v WHERE rest * weight < source_size * 2 * per),
 t AS (SELECT source, source_size, CASE WHEN rest * weight >= source_size * 2 * per OR rest0 IS NULL
              THEN CAST(source_size * 2 AS DOUBLE) ELSE CAST(rest0 * weight AS DOUBLE) / per0 END AS target FROM v, f),
 r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS rate FROM t),
 o AS (SELECT doc_id, size, source_size, target, CAST(floor(rate) AS INT) + CAST(
         CAST('0x' || md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:12] AS BIGINT) / 281474976710656e0
         < rate - floor(rate) AS INT) AS copies FROM d JOIN r ON r.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM o"""

ORACLES["op6_byte_shards"] = f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
 p AS (SELECT *, CAST(sum(size) OVER (ORDER BY doc_id) AS BIGINT) - size AS start, CAST(sum(size) OVER () AS BIGINT) AS total FROM d),
 s AS (SELECT *, CAST(least(15, (2 * start + size) * 16 // (2 * total)) AS INT) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM s"""

ORACLES["op7_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 g AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS gram
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS p FROM w)),
 z AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
 i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
 l AS (SELECT x, y FROM i JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y WHERE 100 * i.n >= 85 * (a.n + b.n - i.n)),
 e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
 r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other)
SELECT r.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(other) AS component_id
FROM r LEFT JOIN z USING (doc_id) GROUP BY r.doc_id"""

ORACLES["op12_importance"] = f"""
WITH w AS ({_words("documents")}), k AS ({_words("benchmark", "item_id")}),
 f AS (SELECT doc_id, unnest(w) AS g FROM w), i AS (SELECT unnest(w) AS g FROM k),
 v AS (SELECT g, {_crc32("g")} % 10000 AS b FROM (SELECT g FROM f UNION SELECT g FROM i)),
 s AS (SELECT b, count(*) AS s FROM f JOIN v USING (g) GROUP BY 1),
 t AS (SELECT b, count(*) AS t FROM i JOIN v USING (g) GROUP BY 1),
 a AS (SELECT CAST((SELECT count(*) FROM f) AS DOUBLE) AS raw, CAST((SELECT count(*) FROM i) AS DOUBLE) AS wanted),
 n AS (SELECT b, CAST(floor(1000e0 * ln(((coalesce(t, 0) + 1e0) * (raw + 10000e0)) / ((s + 1e0) * (wanted + 10000e0)))) AS BIGINT) AS gain
       FROM s LEFT JOIN t USING (b), a),
 x AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN v USING (g) JOIN n USING (b) GROUP BY 1),
 o AS (SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000e0 * ln(-ln(
         (CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5e0) / 4294967296e0))) AS BIGINT) AS score
       FROM w LEFT JOIN x USING (doc_id)),
 p AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS drawn
       FROM o WHERE n_features >= 20)
SELECT o.*, CASE WHEN rank <= drawn THEN rank END AS rank FROM o LEFT JOIN p USING (doc_id)"""

ORACLES["op13_spelling"] = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents) GROUP BY ALL),
 h AS (SELECT run, n, {_crc32("concat(doc_id, ':', run)")} AS h FROM r),
 m AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
 v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM m WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
 x AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
       FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM v)),
 q AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.p = b.p AND a.rest = b.rest AND a.word != b.word
       UNION SELECT x.word, x.n, v.word, v.n FROM x JOIN v ON x.rest = v.word
       UNION SELECT v.word, v.n, x.word, x.n FROM x JOIN v ON x.rest = v.word),
 b AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
              row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM q),
 f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
              CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN b ON b.word = v.word AND place = 1),
 c(word, root) AS (SELECT word, word FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, form, c.root, n, n_near, form_n FROM f JOIN c USING (word)
WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.word = c.root AND g.form IS NOT NULL)"""
