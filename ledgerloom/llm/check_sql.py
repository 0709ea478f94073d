"""DuckDB SQL for the operators' queries that SQL can express.

Tokenising, sketches and CRC-32 sums are not expressible; those queries have brute-force tests.
"""

from __future__ import annotations

# Kind, pattern, decisive group and its least length, by the contract's words; then the added kinds.
SECRETS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
               r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("bearer", r"[Bb]earer\x20+([A-Za-z0-9._~+/-]{20,}=*)", 0, 0),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
)
BASE = [kind for kind, *_ in SECRETS[:3]]

# When each quality rule fails, in the order of its bit.
FAILS = (
    "n_words < 50",
    "100 * n_repeat_words > 50 * n_words",
    "10 * n_symbols > word_chars",
    "100 * n_dup_lines > 50 * n_lines",
    "word_chars < 2 * n_words OR word_chars > 25 * n_words",
)

WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP2 = """
WITH pages_ AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h
                FROM pages),
first AS (SELECT h, min(page_id) AS first_page FROM pages_ WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN first_page < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_page < page_id THEN first_page END AS refers_to
FROM pages_ LEFT JOIN first USING (h)
"""

OP4 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
measured AS (
    SELECT *, 14 + length(role) + length(text)
        + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
        + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS chars
    FROM turns
),
joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
           coalesce(string_agg(text, '' ORDER BY turn, role, text)
                    FILTER (WHERE role = 'assistant'), '') AS learned
    FROM measured GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
       CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(chars AS BIGINT) AS formatted_chars
FROM joined
"""

OP5 = """
WITH texts AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h
    FROM documents
),
windows AS (
    SELECT doc_id, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS w
    FROM texts, unnest(range(0, greatest(n - 99, 0))) AS r(i)
),
again AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS place
        FROM windows) WHERE place > 1
),
marked AS (
    SELECT doc_id, i, CASE WHEN i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 100
                           THEN 1 ELSE 0 END AS opens FROM again
),
runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 100 AS z
    FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
    GROUP BY doc_id, run
),
gaps AS (
    SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM runs
    UNION ALL SELECT doc_id, 0, min(a) FROM runs GROUP BY doc_id
),
kept AS (
    SELECT doc_id, string_agg(substr(h, CAST(2 * g.a + 1 AS BIGINT),
                                     CAST(2 * (coalesce(g.z, n) - g.a) AS BIGINT)), ''
                              ORDER BY g.a) AS h
    FROM gaps AS g JOIN texts USING (doc_id) GROUP BY doc_id
),
counted AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept.h, texts.h))) AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _secret_parts() -> str:
    """One relation of (doc_id, kind, rank, s, e) per rule: running lengths of gaps and matches."""
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(SECRETS):
        pattern = pattern.replace("'", "''")
        parts.append(f"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, e - length(m) AS s, e FROM (
        SELECT doc_id, m, d, sum(length(p) + length(m)) OVER (
            PARTITION BY doc_id ORDER BY i) AS e
        FROM (SELECT doc_id, i, matches[i] AS m, groups[i] AS d, pieces[i] AS p
              FROM (SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS pieces,
                           regexp_extract_all(t, '{pattern}', 0) AS matches,
                           regexp_extract_all(t, '{pattern}', {group}) AS groups
                    FROM texts WHERE regexp_matches(t, '{pattern}')),
                   unnest(range(1, len(matches) + 1)) AS r(i))
    ) WHERE length(d) >= {least}""")
    return " UNION ALL ".join(parts)


OP7 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({_secret_parts()}),
listed AS (
    SELECT doc_id,
           {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)},
           string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ','
                      ORDER BY s, rank) FILTER (WHERE rank < {len(BASE)}) AS base,
           string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ','
                      ORDER BY s, rank) AS every
    FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)
"""

OP9 = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
    SELECT doc_id, {WORDS.format('t')} AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols
    FROM texts
),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
    FROM split, unnest(range(1, len(w) - 1)) AS r(i)
),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, unnest([0, 1, 2]) AS o(k)
    WHERE times > 1 GROUP BY doc_id
),
measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(list_aggregate(w, 'string_agg', '')) AS BIGINT) AS chars_,
           CAST(n_symbols AS BIGINT) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines
    FROM split LEFT JOIN covered USING (doc_id)
),
rated AS (SELECT *, coalesce(chars_, 0) AS word_chars FROM measured),
ledger AS (
    SELECT *, {" + ".join(f"CASE WHEN {fails} THEN {1 << i} ELSE 0 END"
                          for i, fails in enumerate(FAILS))} AS bits
    FROM rated
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS failed_bits
FROM ledger
"""

OP10 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                                 "'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
),
grams AS (
    SELECT DISTINCT doc_id, list_aggregate(w[i:i + 2], 'string_agg', chr(10)) AS g
    FROM words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS r(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM grams AS x JOIN grams AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * k >= 85 * (x.n + y.n - k)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT doc_id, doc_id AS other FROM words
    UNION SELECT r.doc_id, l.b FROM reached AS r JOIN both_ways AS l ON l.a = r.other
),
named AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM named LEFT JOIN sizes USING (doc_id)
"""

LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# The damage is dealt by CRC-32, bit by bit over a table; the repair is a shortest path over (rows done,
# role that stands last), whose labels are (cost, audit).
OP11 = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_prepend(CAST(n AS BIGINT), range(8)), lambda c, b:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS steps
    FROM range(256) AS r(n)
),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_prepend(4294967295, list_transform(string_split(concat(
               coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), ''),
               lambda x: CAST(ascii(x) AS BIGINT))) AS bytes
    FROM conversations
),
dealt AS (
    SELECT conv_id, turn, role, text, xor(list_reduce(bytes, lambda c, b:
               xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295) % 20 AS kind
    FROM keyed, crc
),
hurt AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                ELSE text END AS text
    FROM dealt, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id
                                 ORDER BY turn NULLS FIRST, md5(concat(role, chr(10), text))) AS i
    FROM hurt
),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                   WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated'
              END AS fault
    FROM placed
),
steps_ AS (SELECT conv_id, max(i) AS rows_ FROM judged GROUP BY conv_id),
-- A label per role that may stand last ('' for none); inserts first, then the next row.
walk(conv_id, i, last, label) AS (
    SELECT conv_id, 0, '', {'cost': CAST(0 AS BIGINT), 'audit': '', 'said': CAST([] AS VARCHAR[])} FROM steps_
    UNION ALL
    SELECT conv_id, i + 1, last_, min(label_) FROM (
        SELECT w.conv_id, w.i,
               CASE e WHEN 'D' THEN w.l WHEN 'K' THEN left(j.role, 1)
                      ELSE CASE w.l WHEN 'u' THEN 'a' ELSE 'u' END END AS last_,
               {'cost': w.cost + CASE e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                    + CASE WHEN e <> 'D' AND j.fault = 'truncated' THEN 3 ELSE 0 END,
                'audit': w.audit || e,
                'said': CASE e WHEN 'D' THEN w.said WHEN 'K' THEN w.said || [j.role || ':' || j.text]
                    ELSE w.said || [CASE w.l WHEN 'u' THEN 'assistant:' ELSE 'user:' END || j.text]
                    END} AS label_
        FROM (SELECT conv_id, i, last AS l, label.cost, label.audit, label.said FROM walk
              UNION ALL
              SELECT conv_id, i, CASE last WHEN 'u' THEN 'a' ELSE 'u' END, label.cost + 3,
                     label.audit || 'I',
                     label.said || [CASE last WHEN 'u' THEN 'assistant:' ELSE 'user:' END]
              FROM walk) AS w
        JOIN judged AS j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1,
        unnest(['D', 'K', 'R']) AS q(e)
        WHERE e = 'D' OR j.fault IS DISTINCT FROM 'blank' AND j.fault IS DISTINCT FROM 'duplicate'
              AND (e = 'R' OR CASE left(j.role, 1) WHEN 's' THEN w.l = '' WHEN 'u' THEN w.l <> 'u'
                                                   WHEN 'a' THEN w.l = 'u' ELSE false END)
    ) GROUP BY conv_id, i, last_
),
ended AS (
    SELECT w.conv_id, min({'cost': label.cost + 3 * (CASE last WHEN 's' THEN 2 WHEN 'u' THEN 1 ELSE 0 END),
                         'audit': label.audit || CASE last WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END,
                         'said': label.said || CASE last WHEN 's' THEN ['user:', 'assistant:']
                                                         WHEN 'u' THEN ['assistant:'] ELSE [] END}) AS best
    FROM walk AS w JOIN steps_ AS s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.rows_ = w.i
    GROUP BY w.conv_id
),
pairs AS (
    SELECT conv_id, left(role, 1) AS y, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS x, i
    FROM judged
),
illegal_ AS (
    SELECT conv_id, count(*) FILTER (WHERE i > 1 AND NOT (x = 's' AND y = 'u' OR x = 'u' AND y = 'a'
                                                          OR x = 'a' AND y = 'u')) AS illegal
    FROM pairs GROUP BY conv_id
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank,
           count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated
    FROM judged GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN illegal_ AS n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended AS e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP12 = rf"""
WITH docs AS (SELECT doc_id, {TERMS.format(LOWER.format("text"))} AS w FROM documents),
items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
           {TERMS.format(LOWER.format("text"))} AS w FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS g
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0
),
found AS (
    SELECT DISTINCT doc_id, i, x.k, x.g
    FROM (SELECT DISTINCT k FROM windows) AS s, docs, unnest(range(1, len(w) - k + 2)) AS r(i)
    JOIN (SELECT DISTINCT k, g FROM windows) AS x
        ON x.k = s.k AND x.g = array_to_string(w[i:i + s.k - 1], ' ')
),
hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + k)) AS r(p)
    GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found JOIN windows USING (k, g)) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP13 = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM documents, unnest(regexp_split_to_array(
        {LOWER.format("text")}, '[.,;:!?\x0A-\x0D]')) AS p(piece)
),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM pieces, unnest(range(1, 5)) AS q(k), unnest(range(1, len(w) - k + 2)) AS r(i)
    GROUP BY ALL
),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE f >= 30),
inside AS (
    SELECT DISTINCT x.lang, x.phrase
    FROM (SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase
          FROM frequent, unnest(range(2, 4)) AS q(m), unnest(range(1, k - m + 2)) AS r(i)
          WHERE m < k) AS longer
    JOIN frequent AS x ON x.lang = longer.lang AND x.phrase = longer.phrase
    WHERE 100 * CAST(longer.f AS HUGEINT) >= 80 * CAST(x.f AS HUGEINT)
),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, c1 AS cut, x.f AS l, y.f AS r,
           (2000000 * CAST(c.f AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS score
    FROM frequent AS c, unnest(range(1, c.k)) AS q(c1)
    JOIN grams AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c1], ' ')
    JOIN grams AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c1 + 1:], ' ')
    WHERE c.k > 1
),
lowest AS (
    SELECT * FROM cuts ANTI JOIN inside USING (lang, phrase)
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM lowest) JOIN totals USING (lang)
WHERE rank <= 2000
"""

CHECK_SQL: dict[str, str] = {
    "op2_warc": OP2,
    "op4_chat": OP4,
    "op5_suffix_dedup": OP5,
    "op7_secret_scans": OP7,
    "op9_quality_rules": OP9,
    "op10_minhash": OP10,
    "op11_repair": OP11,
    "op12_decontamination": OP12,
    "op13_collocations": OP13,
}
