"""SQL counterparts, where SQL can express an operator."""

from __future__ import annotations

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL
    SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), ''))
        AS loss_sha256,
    -- Marks, and one more character for each that is written with a backslash.
    sum(
        13 + length(role) + length(text)
        + length(regexp_replace(role, '[^\\#<\n]', '', 'g')) + length(regexp_replace(text, '[^\\#<]', '', 'g'))
    )::BIGINT AS formatted_chars
FROM turns
GROUP BY conv_id
"""

# The word patterns are written out: blank, and characters 9 to 13.
QUALITY = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
), grams AS (
    SELECT k, i, (w[i], w[i + 1], w[i + 2]) AS g FROM words, unnest(range(1, len(w) - 1)) AS t(i)
), often AS (
    SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM grams) WHERE n > 1
), covered AS (
    SELECT k, count(DISTINCT i + j) AS n FROM often, unnest([0, 1, 2]) AS t(j) GROUP BY k
), lines AS (
    SELECT k, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs
), measured AS (
    SELECT
        docs.doc_id, docs.lang, docs.source,
        len(w) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) AS n_lines,
        len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words
    FROM docs JOIN words USING (k) JOIN lines USING (k) LEFT JOIN covered USING (k)
), rated AS (
    SELECT *,
        CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbols_rate,
        CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats_rate,
        CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines_rate,
        CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length_rate
    FROM measured
), long AS (
    SELECT lang, source, 'symbols' AS measure, symbols_rate AS v FROM rated
    UNION ALL SELECT lang, source, 'repeats', repeats_rate FROM rated
    UNION ALL SELECT lang, source, 'dup_lines', dup_lines_rate FROM rated
    UNION ALL SELECT lang, source, 'word_length', word_length_rate FROM rated
), bucketed AS (
    SELECT lang, source, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket
    FROM long
), levels AS (
    SELECT 0 AS level, lang, source, measure, bucket FROM bucketed
    UNION ALL SELECT 1, lang, NULL, measure, bucket FROM bucketed
    UNION ALL SELECT 2, NULL, NULL, measure, bucket FROM bucketed
), ranked AS (
    SELECT *,
        count(*) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS upto,
        count(*) OVER (PARTITION BY level, lang, source, measure) AS total
    FROM levels
), cut AS (
    SELECT level, lang, source, measure, max(total) AS total,
        min(bucket) FILTER (WHERE 100 * upto >= 10 * total) AS q10,
        min(bucket) FILTER (WHERE 100 * upto >= 50 * total) AS q50,
        min(bucket) FILTER (WHERE 100 * upto >= 90 * total) AS q90
    FROM ranked GROUP BY ALL
), fences AS (
    SELECT level, lang, source, measure,
        CASE WHEN measure = 'word_length' THEN q10 - greatest(2 * (q50 - q10), 300) END AS low,
        q90 + greatest(2 * (q90 - q50), CASE measure WHEN 'symbols' THEN 50 WHEN 'repeats' THEN 200
            WHEN 'dup_lines' THEN 500 ELSE 300 END) AS high
    FROM cut WHERE total >= 200 OR level = 2
), wide AS (
    SELECT level, lang, source,
        max(high) FILTER (WHERE measure = 'symbols') AS symbols_high,
        max(high) FILTER (WHERE measure = 'repeats') AS repeats_high,
        max(high) FILTER (WHERE measure = 'dup_lines') AS dup_lines_high,
        max(high) FILTER (WHERE measure = 'word_length') AS word_length_high,
        max(low) FILTER (WHERE measure = 'word_length') AS word_length_low
    FROM fences GROUP BY ALL
), judged AS (
    SELECT rated.*,
        coalesce(a.symbols_high, b.symbols_high, c.symbols_high)::BIGINT AS symbols_high,
        coalesce(a.repeats_high, b.repeats_high, c.repeats_high)::BIGINT AS repeats_high,
        coalesce(a.dup_lines_high, b.dup_lines_high, c.dup_lines_high)::BIGINT AS dup_lines_high,
        coalesce(a.word_length_high, b.word_length_high, c.word_length_high)::BIGINT AS word_length_high,
        coalesce(a.word_length_low, b.word_length_low, c.word_length_low) AS word_length_low,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM rated
    LEFT JOIN wide a ON a.level = 0 AND a.lang IS NOT DISTINCT FROM rated.lang
        AND a.source IS NOT DISTINCT FROM rated.source
    LEFT JOIN wide b ON b.level = 1 AND b.lang IS NOT DISTINCT FROM rated.lang
    LEFT JOIN wide c ON c.level = 2
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND symbols_rate <= symbols_high AND repeats_rate <= repeats_high
        AND dup_lines_rate <= dup_lines_high AND word_length_rate <= word_length_high
        AND word_length_rate >= word_length_low AS kept,
    symbols_rate::BIGINT AS symbols_rate, repeats_rate::BIGINT AS repeats_rate,
    dup_lines_rate::BIGINT AS dup_lines_rate, word_length_rate::BIGINT AS word_length_rate,
    symbols_high, repeats_high, dup_lines_high, word_length_high
FROM judged
"""



def crc_table() -> str:
    """The remainders of the CRC-32 of each byte, as a list in SQL."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return "[" + ", ".join(map(str, table)) + "]::BIGINT[]"


SPELLING = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS raw FROM documents
), per_doc AS (
    SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
    FROM runs GROUP BY 1, 2
), bytes AS (
    SELECT run, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x, {crc_table()} AS crc FROM per_doc
), checked AS (
    SELECT run, c, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            range(1, length(x), 2), lambda i: (instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1
        )),
        lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])
    )) AS h FROM bytes
), slipped AS (
    SELECT c, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM checked
), words AS (
    SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), cut AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)
), pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.rest = words.word
    UNION
    SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.rest = words.word
), near AS (
    SELECT word, count(*) AS n_near FROM pairs GROUP BY word
), best AS (
    SELECT word, other, other_n FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other COLLATE C) = 1
), formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN other_n >= 2 * words.n THEN other END AS form, CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN near USING (word) LEFT JOIN best USING (word)
), followed AS (
    SELECT word, word AS at FROM formed
    UNION ALL
    SELECT followed.word, formed.form FROM followed JOIN formed ON formed.word = followed.at WHERE formed.form IS NOT NULL
), ends AS (
    SELECT followed.word, followed.at FROM followed JOIN formed ON formed.word = followed.at WHERE formed.form IS NULL
)
SELECT formed.word, form, ends.at AS root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

# A run of period q is a stretch of places whose word comes again q places later; of equal stretches, the least period counts.
PERIODIC = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        hex(encode(coalesce(doc_id::VARCHAR, ''))) AS x, {crc_table()} AS crc
    FROM documents
), checked AS (
    SELECT k, doc_id, w, len(w) AS n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            range(1, length(x), 2), lambda i: (instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1
        )),
        lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])
    )) AS h FROM docs
), drawn AS (
    SELECT k, doc_id, w, n, (h // 10) % n AS a, h // 10 % 8 AS g8, h % 10 = 0 AND n > 0 AND doc_id IS NOT NULL AS stutters FROM checked
), periods AS (
    SELECT *, CASE WHEN stutters THEN 1 + (n - a) // (3 + g8) END AS p FROM drawn
), words AS (
    SELECT k, n, i, CASE WHEN stutters AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
    FROM periods, unnest(range(n)) AS t(i)
), again AS (
    SELECT a.k, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.k = b.k AND a.word = b.word AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), islands AS (
    SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM again
), stretches AS (
    SELECT k, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY k, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT k, start, length, min(q) AS period FROM stretches GROUP BY ALL
), told AS (
    SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS written,
        first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS r
    FROM runs GROUP BY k
), kept AS (
    SELECT k, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words
    WHERE NOT EXISTS (
        FROM runs WHERE runs.k = words.k AND words.i >= runs.start + runs.period AND words.i < runs.start + runs.length
    ) GROUP BY k
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, r.start::BIGINT AS start, r.length::BIGINT AS length, r.period::BIGINT AS period,
    (1000 * r.length // r.period)::BIGINT AS exponent_milli,
    sha256(coalesce(written, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM docs LEFT JOIN told USING (k) LEFT JOIN kept USING (k)
"""

ORACLE: dict[str, str] = {
    "op7_chat_format": CHAT,
    "op10_adaptive_quality": QUALITY,
    "op11_spelling": SPELLING,
    "op12_periodic": PERIODIC,
}
