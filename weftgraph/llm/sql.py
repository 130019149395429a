"""The SQL that the queries must agree with, where SQL can express them."""

from __future__ import annotations

from weftgraph.llm.license_scan import TEMPLATES

EXACT_DEDUP = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
  FROM documents
), g AS (
  SELECT doc_id, sha256(content) AS text_sha256,
         max(doc_id) OVER (PARTITION BY content) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""

# A word of a document is hit if it is inside a run of words that is a window of an item.
DECONTAMINATE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM iw
), dw AS (
  SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win
), covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_hit
  FROM (SELECT DISTINCT doc_id, p, n FROM hit), range(13) AS r(k) WHERE k < n GROUP BY 1
), items AS (
  SELECT doc_id, count(item_id) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1
)
SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)
), least AS (
  SELECT words, min(doc_id) AS first_id FROM win GROUP BY 1 HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, p + k AS p
  FROM win JOIN least USING (words), range(13) AS r(k) WHERE doc_id > first_id
), lost AS (
  SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p)
  GROUP BY 1
)
SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


# The remainders that crc32 takes byte by byte.
_CRC_TABLE = """crc(b, k, c) AS (
  SELECT b, 0, b FROM range(256) AS r(b)
  UNION ALL
  SELECT b, k + 1, xor(c >> 1, (c & 1) * 3988292384) FROM crc WHERE k < 8
), crc_table AS (
  SELECT b, c FROM crc WHERE k = 8
)"""

# Trees level by level, then every leaf climbs to its subroot and on to the root.
MERKLE = rf"""
WITH RECURSIVE {_CRC_TABLE}, crc_steps(doc_id, s, k, c) AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR), 0, 4294967295 FROM documents
  UNION ALL
  SELECT doc_id, s, k + 1, xor(crc_steps.c >> 8, t.c)
  FROM crc_steps JOIN crc_table AS t ON t.b = xor(crc_steps.c & 255, ord(s[k + 1])) WHERE k < length(s)
), chosen AS (
  SELECT DISTINCT doc_id FROM crc_steps WHERE k = length(s) AND xor(c, 4294967295) % 7 = 0
), d AS (
  SELECT doc_id, lang, source, n_chars, text,
         n_chars + CAST(chosen.doc_id IS NOT NULL AS BIGINT) AS n_chars_after
  FROM documents LEFT JOIN chosen USING (doc_id)
), parts AS (
  SELECT doc_id, lang, n_chars, n_chars_after,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM d
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT doc_id, coalesce('=' || lang, '-') AS lang,
           sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
           sha256(head || coalesce(strlen(CAST(n_chars_after AS VARCHAR)) || ':' || n_chars_after, '-') || tail) AS changed
    FROM parts)
), nodes(lang, l, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT lang, l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1
  GROUP BY lang, l, i // 2, n
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(l, i, n, h) AS (
  SELECT 0, i, n, subroot FROM subroots
  UNION ALL
  SELECT l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY l, i // 2, n
), up(doc_id, leaf, lang, l, i, n, h, proof) AS (
  SELECT doc_id, leaf, lang, 0, i, n, changed, '' FROM leaves
  UNION ALL
  SELECT doc_id, leaf, up.lang, up.l + 1, up.i // 2, (up.n + 1) // 2,
         sha256(CASE WHEN o.h IS NULL THEN up.h WHEN o.i < up.i THEN o.h || up.h ELSE up.h || o.h END),
         proof || coalesce(o.h, '')
  FROM up LEFT JOIN nodes AS o ON o.lang = up.lang AND o.l = up.l AND o.i = xor(up.i, 1) WHERE up.n > 1
), over(doc_id, leaf, subroot, l, i, n, h, proof) AS (
  SELECT doc_id, leaf, subroot, 0, s.i, s.n, h, proof FROM up JOIN subroots AS s USING (lang) WHERE up.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, over.l + 1, over.i // 2, (over.n + 1) // 2,
         sha256(CASE WHEN o.h IS NULL THEN over.h WHEN o.i < over.i THEN o.h || over.h ELSE over.h || o.h END),
         proof || coalesce(o.h, '')
  FROM over LEFT JOIN tops AS o ON o.l = over.l AND o.i = xor(over.i, 1) WHERE over.n > 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, over.h AS folded_root, over.h = root AS verified
FROM over, (SELECT h AS root FROM tops WHERE n = 1) WHERE over.n = 1
"""


# Words are near if they agree without one code point of each at the same place, or without one of the longer.
SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY 1, 2
), signed AS (
  SELECT *, hex(encode(doc_id || ':' || run)) AS s FROM counted
), steps(doc_id, run, s, k, c) AS (
  SELECT doc_id, run, s, 0, 4294967295 FROM signed
  UNION ALL
  SELECT doc_id, run, s, k + 1, xor(steps.c >> 8, t.c)
  FROM steps JOIN crc_table AS t ON t.b = xor(steps.c & 255, CAST('0x' || s[2 * k + 1 : 2 * k + 2] AS BIGINT))
  WHERE 2 * k < length(s)
), damaged AS (
  SELECT doc_id, run, CASE WHEN h % 199 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word
  FROM (SELECT doc_id, run, xor(c, 4294967295) AS h FROM steps WHERE 2 * k = length(s))
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM counted JOIN damaged USING (doc_id, run) WHERE length(word) >= 6
  GROUP BY 1 HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, word[: i - 1] AS head, word[i + 1 :] AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut AS a JOIN cut AS b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT cut.word, cut.n, words.word, words.n FROM cut JOIN words ON words.word = cut.head || cut.tail
  UNION
  SELECT words.word, words.n, cut.word, cut.n FROM cut JOIN words ON words.word = cut.head || cut.tail
), best AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r
  FROM near
), forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 5 * words.n THEN other END AS form, CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word AND r = 1
), chain(word, last_word, next_word) AS (
  SELECT word, word, form FROM forms
  UNION ALL
  SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.next_word
)
SELECT forms.word, form, last_word AS root, n, n_near, form_n
FROM forms JOIN chain ON chain.word = forms.word AND chain.next_word IS NULL
"""


def license_scan_sql() -> str:
    """For each template the windows of its length that hold most of its shingles."""
    notices = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))
    words = r"""regexp_extract_all(
      translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    return f"""
WITH t AS (
  SELECT template, {words.format("notice")} AS w FROM (VALUES {notices}) AS v(template, notice)
), ts AS (
  SELECT DISTINCT template, array_to_string(w[p : p + 4], ' ') AS s
  FROM (SELECT template, w, unnest(range(1, len(w) - 3)) AS p FROM t)
), sizes AS (
  SELECT template, count(*) AS n_shingles FROM ts GROUP BY 1
), d AS (
  SELECT doc_id, {words.format("text")} AS w FROM documents
), ds AS (
  SELECT doc_id, p, len(w) - 4 AS n, array_to_string(w[p + 1 : p + 5], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS p FROM d WHERE len(w) >= 5)
), hit AS (
  SELECT doc_id, p, n, template, s, n_shingles FROM ds JOIN ts USING (s) JOIN sizes USING (template)
), win AS (
  SELECT DISTINCT doc_id, template, n_shingles, p - k AS word
  FROM hit, range(0, 40) AS r(k) WHERE k < n_shingles AND p - k >= 0 AND p - k <= n - n_shingles
), counted AS (
  SELECT doc_id, template, win.n_shingles, word, count(DISTINCT s) AS n_found
  FROM win JOIN hit USING (doc_id, template) WHERE p >= word AND p < word + win.n_shingles
  GROUP BY 1, 2, 3, 4
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY n_found DESC, word) AS r FROM counted
)
SELECT doc_id, template, n_shingles, n_found, word FROM best WHERE r = 1 AND 100 * n_found >= 75 * n_shingles
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": SUBSTRING_DEDUP,
        "op3_decontaminate": DECONTAMINATE,
        "op10_license_scan": license_scan_sql(),
        "op6_exact_dedup": EXACT_DEDUP,
        "op11_spelling_variants": SPELLING,
        "op12_merkle_manifest": MERKLE,
    }
