"""The registered queries as DuckDB SQL, from the given tables alone."""

from __future__ import annotations

import re

from quarry.operators import enrich, fusion

DIMS = 64

# The patterns as the rules state them, written out here so that the SQL does not lean on the engine.
SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"
NON_SPACE = r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
SPACE_SIGNS = "".join(map(chr, [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
WORD = r"[\p{L}\p{N}_]+"
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
TOKEN_WITH_SPACE = (
    r"(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}])[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]*"
)
TABLE_ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"
TAG = HTML_TAG = r"<[^>]+>"
HTML_BREAK = r"(?i)<br\b[^>]*>"
HTML_DROPPED = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<!doctype[^>]*>"
HTML_BLOCK = (
    r"(?is)(<table\b.*?</table>|<img\b[^>]*>|"
    r"</?(?:h[1-6]|p|li|ul|ol|div|nav|article|section|main|aside|header|footer|body|html|blockquote|pre)\b[^>]*>)"
)
HTML_DATA_IMAGE = r"(?is)^<img\b[^>]*\bsrc=[\"']data:image/([a-z]+);base64,([^\"']*)[\"']"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(SPACE_SIGNS)})"


def filled(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {lit(NON_SPACE)}), false)"


def spaced(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit(SPACES)}, ' ', 'g'), ' ')"


def tokens(x: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(TOKEN)}))::INT"


def markdown(x: str) -> str:
    cell = f"regexp_replace(c, {lit(TAG)}, '', 'g')"
    clean = f"replace(replace({spaced(cell)}, '&nbsp;', ' '), '&amp;', '&')"
    row = f"list_transform(regexp_extract_all(r, {lit(TABLE_CELL)}, 1), lambda c: {clean})"
    rows = f"list_filter(list_transform(regexp_extract_all({x}, {lit(TABLE_ROW)}, 1), lambda r: {row}), lambda q: len(q) > 0)"
    wide = "list_max(list_transform(z, lambda q: len(q)))"
    lines = f"list_transform(z, lambda q: '| ' || array_to_string(list_resize(q, {wide}, ''), ' | ') || ' |')"
    rule = f"['| ' || array_to_string(list_resize(['---'], {wide}, '---'), ' | ') || ' |']"
    table = f"array_to_string(list_concat(list_concat(({lines})[1:1], {rule}), ({lines})[2:]), chr(10))"
    bare = spaced(f"regexp_replace({x}, {lit(TAG)}, ' ', 'g')")
    return f"CASE WHEN len({rows}) > 0 THEN list_transform([{rows}], lambda z: {table})[1] ELSE {bare} END"


def unescape(x: str) -> str:
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {lit(entity)}, {lit(sign)})"
    return x


CTES: dict[str, str] = {}

CTES["docs"] = "SELECT *, 'doc_' || doc_id AS document FROM documents"
CTES["asked"] = "SELECT item_id AS query_id, text AS query FROM benchmark"
CTES["raw_lines"] = """
    SELECT document, unnest(string_split(text, chr(10))) AS raw,
           generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs"""
CTES["lines"] = f"""
    SELECT document, i, line FROM (SELECT document, i, {strip('raw')} AS line FROM raw_lines) WHERE line <> ''"""
CTES["els"] = f"""
    SELECT document, (row_number() OVER (PARTITION BY document ORDER BY i) - 1)::INT AS pos,
           CASE WHEN regexp_matches(line, '\\A#+ ') THEN 'Title'
                WHEN regexp_matches(line, '\\A[-*] ') THEN 'ListItem'
                WHEN length(line) <= 80 AND regexp_matches(line, '\\p{{L}}') AND NOT regexp_matches(line, '[.!?:;,]\\z')
                THEN 'Title' ELSE 'NarrativeText' END AS type,
           CASE WHEN regexp_matches(line, '\\A(?:#+|[-*]) ')
                THEN {strip("regexp_replace(line, '\\A(?:#+|[-*]) ', '')")} ELSE line END AS text
    FROM lines"""
TABLE_HTML = (
    "('<table><tr><td>' || replace(replace(text, '. ', '</td></tr><TR class=''r''><td>'), ' ', ' </td><td>')"
    " || '&amp;<b>.</b></td></tr></table>')"
)
CTES["kinds"] = """
    SELECT *, length(text) AS size,
           CASE WHEN length(text) % 7 = 0 THEN 'Table' WHEN length(text) % 11 = 0 THEN 'Image'
                WHEN length(text) % 13 = 0 THEN 'Title' ELSE type END AS kind FROM els"""
CTES["mixed"] = f"""
    SELECT document, pos, kind AS type,
           CASE WHEN (kind = 'Image' AND size % 2 = 0) OR (kind = 'Table' AND size % 14 = 0) THEN '' ELSE text END AS text,
           (pos // 10 + 1)::INT AS page_number,
           CASE WHEN kind = 'Table' AND size % 3 <> 0 THEN {TABLE_HTML} END AS text_as_html,
           CASE WHEN kind = 'Image' AND size % 3 <> 0 THEN md5(text) END AS image_base64,
           CASE WHEN kind = 'Image' THEN ['PNG ', 'jpg', 'image/gif', 'bmp'][size % 4 + 1] END AS filetype
    FROM kinds"""
CTES["valid"] = f"""
    SELECT * FROM mixed WHERE CASE WHEN type = 'Image' THEN coalesce(image_base64 <> '', false) ELSE {filled('text')} END"""
CTES["described"] = """
    SELECT * REPLACE (CASE WHEN type = 'Image' THEN '[IMAGE] ' || description ELSE text END AS text) FROM (
      SELECT *, CASE WHEN type <> 'Image' THEN NULL
                     WHEN left(image_base64, 1) < '8' THEN 'A picture of ' || left(image_base64, 8)
                     WHEN left(image_base64, 1) < 'c' THEN '[Image: description unavailable - empty response]'
                     ELSE '[Image: description unavailable]' END AS description FROM valid)"""
CTES["parts"] = f"""
    SELECT document, pos // 50 AS part, string_agg(t, chr(10) || chr(10) ORDER BY pos) AS text FROM (
      SELECT document, pos, type = 'Table' AND {filled('text_as_html')} AS is_table,
             CASE WHEN type = 'Table' AND {filled('text_as_html')} THEN {markdown('text_as_html')}
                  ELSE {strip('text')} END AS t FROM mixed)
    WHERE is_table OR t <> '' GROUP BY ALL"""
CTES["texts"] = """
    SELECT document, string_agg(text, chr(10) || chr(10) ORDER BY part) AS text,
           sha256(string_agg(sha256(text), chr(10) ORDER BY part)) AS sha FROM parts GROUP BY document"""

# -- hashed vectors: one row per text, from (key, text) -----------------------------------


def hashed(source: str, key: str, text: str) -> str:
    return f"""
    SELECT key, list((CASE WHEN length = 0 THEN 0 ELSE total / length END)::FLOAT ORDER BY place) AS v FROM (
      SELECT key, place, total, sqrt(sum(total * total) OVER (PARTITION BY key)) AS length FROM (
        SELECT key, place, sum(sign)::DOUBLE AS total FROM (
          SELECT key, ('0x' || substr(h, 1, 8))::BIGINT % {DIMS} AS place,
                 CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END AS sign
          FROM (SELECT key, md5(w) AS h FROM (
            SELECT {key} AS key, unnest(regexp_extract_all(lower({text}), {lit(WORD)})) AS w FROM {source}))
          UNION ALL SELECT {key}, p.place, 0 FROM {source}, (SELECT unnest(range({DIMS})) AS place) p)
        GROUP BY key, place))
    GROUP BY key"""


# -- chunks -------------------------------------------------------------------------------


def chunk_ctes(name: str, source: str, low: int, high: int, ratio: float = 0.0, similarity: float | None = None) -> None:
    """``name``_e: numbered elements; ``name``_walk: the rules, element by element; ``name``: chunks."""
    semantic = similarity is not None
    if semantic:
        CTES[f"{name}_v"] = hashed(f"(SELECT DISTINCT text FROM {source})", "text", "text")
    vector = "(SELECT v FROM {0}_v WHERE key = s.text)::DOUBLE[]".format(name) if semantic else "NULL::DOUBLE[]"
    images = "image_base64, filetype" + (", description" if source == "described" else ", NULL::VARCHAR AS description")
    page = "page_number"
    if source == "els":
        images, page = "NULL::VARCHAR AS image_base64, NULL::VARCHAR AS filetype, NULL::VARCHAR AS description", "NULL::INT AS page_number"
    body = "text" if source == "els" else (
        f"CASE WHEN type = 'Table' AND coalesce(text_as_html <> '', false) THEN {markdown('text_as_html')} ELSE text END"
    )
    if semantic:
        CTES[f"{name}_s"] = f"SELECT s.*, x.v::DOUBLE[] AS v FROM {source} s JOIN {name}_v x ON x.key = s.text"
    else:
        CTES[f"{name}_s"] = f"SELECT s.*, {vector} AS v FROM {source} s WHERE {'true' if source != 'els' else filled('text')}"
    CTES[f"{name}_e"] = f"""
    SELECT document, pos, type, {page}, {images}, v, {body} AS body, {tokens('text')} AS t,
           CASE WHEN type IN ('Table', 'Image') THEN 2 WHEN type = 'Title' THEN 1 ELSE 0 END AS kind,
           row_number() OVER (PARTITION BY document ORDER BY pos) AS nth,
           last_value(CASE WHEN type = 'Title' THEN text END IGNORE NULLS)
             OVER (PARTITION BY document ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section FROM {name}_s"""
    alike = (
        "CASE WHEN list_dot_product(w.c, w.c) = 0 OR list_dot_product(e.v, e.v) = 0 THEN 0 ELSE "
        "list_dot_product(w.c, e.v) / (sqrt(list_dot_product(w.c, w.c)) * sqrt(list_dot_product(e.v, e.v))) END"
        if semantic
        else "0"
    )
    size = "(w.own + w.ov)"
    if semantic:
        titled = "false"
        soft = f"({size} + e.t > {high} OR {alike} < {similarity}) AND NOT ({size} < {low} AND {alike} >= 0.5)"
    else:
        titled = f"e.kind = 1 AND {size} >= {low}"
        soft = f"{size} + e.t > {high} AND {size} >= {low}"
    again = f"array_to_string(list_slice(regexp_extract_all(txt, {lit(TOKEN_WITH_SPACE)}), -new_ov, -1), '')"
    centre = (
        "CASE WHEN cut THEN v ELSE list_transform(range(1, len(v) + 1), lambda i: (c[i] * mem + v[i]) / (mem + 1)) END"
        if semantic
        else "NULL::DOUBLE[]"
    )
    CTES[f"{name}_walk"] = f"""
    SELECT document, nth, 0 AS ord, kind, t AS own, 0 AS ov, 1 AS mem, v AS c, body AS txt FROM {name}_e WHERE nth = 1
    UNION ALL
    SELECT document, nth, ord + cut::INT, kind, CASE WHEN cut THEN t ELSE own + t END,
           CASE WHEN cut THEN new_ov ELSE ov END,
           CASE WHEN cut THEN 1 + (new_ov > 0)::INT ELSE mem + 1 END,
           {centre},
           CASE WHEN NOT cut THEN txt || chr(10) || chr(10) || body
                WHEN new_ov > 0 THEN '[...] ' || {strip(again)} || chr(10) || chr(10) || body ELSE body END
    FROM (
      SELECT *, hard OR titled OR soft AS cut,
             CASE WHEN soft AND NOT hard AND NOT titled
                  THEN floor((own + CASE WHEN ov > 0 THEN ov + 5 ELSE 0 END) * {ratio}::DOUBLE)::INT ELSE 0 END AS new_ov
      FROM (
        SELECT e.document, e.nth, e.kind, e.t, e.v, e.body, w.ord, w.own, w.ov, w.mem, w.c, w.txt,
               e.kind = 2 OR w.kind = 2 AS hard, {titled} AS titled, {soft} AS soft
        FROM {name}_walk w JOIN {name}_e e ON e.document = w.document AND e.nth = w.nth + 1))"""
    CTES[name] = f"""
    SELECT w.document || '_chunk_' || ord AS chunk_id, w.document, ord AS chunk_index, arg_max(txt, w.nth) AS original_content,
           arg_min(CASE WHEN type = 'Table' THEN 'table' WHEN type = 'Image' THEN 'image' ELSE 'text' END, w.nth) AS chunk_type,
           min(struct_pack(nth := w.nth, s := section)).s AS section_title,
           arg_min(page_number, w.nth) AS page_number,
           arg_min(struct_pack(x := CASE WHEN type = 'Table' THEN NULL ELSE type = 'Image' END), w.nth).x AS has_image,
           min(struct_pack(nth := w.nth, s := CASE WHEN type = 'Image' THEN description END)).s AS image_description,
           min(struct_pack(nth := w.nth, s := CASE WHEN type = 'Image' THEN filetype END)).s AS filetype,
           (count(*) + (max(ov) > 0)::INT)::INT AS element_count
    FROM {name}_walk w JOIN {name}_e e ON e.document = w.document AND e.nth = w.nth
    GROUP BY w.document, ord HAVING {filled('arg_max(txt, w.nth)')}"""


chunk_ctes("basic", "valid", 60, 120)
chunk_ctes("overlapped", "valid", 60, 120, 0.15)
chunk_ctes("alike", "valid", 60, 120, 0.15, 0.7)
chunk_ctes("told", "described", 60, 120)
chunk_ctes("whole", "els", 400, 800, 0.15)
chunk_ctes("small", "els", 60, 120)
chunk_ctes("default_sizes", "els", 300, 1000)
chunk_ctes("tiny", "valid", 10, 20)
chunk_ctes("tiny_overlapped", "valid", 10, 20, 0.15)

CHUNK_COLUMNS = (
    "chunk_id, document, chunk_index, original_content, contextualized_content, "
    f"{tokens('contextualized_content')} AS token_count, chunk_type, section_title, page_number, has_image, "
    "image_description, filetype, element_count"
)
FALLBACK = (
    "'This chunk is from ' || document || coalesce(CASE WHEN section_title <> '' THEN ' in the ' || section_title || "
    "' section' END, '') || coalesce(CASE WHEN page_number <> 0 THEN ' on page ' || page_number END, '') || '.'"
)


def records(source: str, context: str | None = None) -> str:
    text = f"{context} || chr(10) || chr(10) || original_content" if context else "original_content"
    return f"SELECT {CHUNK_COLUMNS} FROM (SELECT *, {text} AS contextualized_content FROM {source})"


# -- lexical ------------------------------------------------------------------------------

CTES["full_text"] = "SELECT doc_id, text FROM documents"


def lexical_ctes(prefix: str, source: str, key: str, text: str) -> None:
    CTES[f"{prefix}_words"] = f"SELECT {key} AS doc_id, regexp_extract_all(lower({text}), {lit(WORD)}) AS w FROM {source}"
    CTES[f"{prefix}_postings"] = f"""
    SELECT doc_id, doc_len, term, count(*)::INT AS tf FROM (
      SELECT doc_id, len(w)::INT AS doc_len, unnest(w) AS term FROM {prefix}_words) GROUP BY ALL"""
    CTES[f"{prefix}_stats"] = f"SELECT count(*) AS n_docs, avg(len(w)) AS avg_doc_len FROM {prefix}_words"
    CTES[f"{prefix}_idf"] = f"""
    SELECT term, df, ln((n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1) AS idf
    FROM (SELECT term, count(*) AS df FROM {prefix}_postings GROUP BY term), {prefix}_stats"""
    CTES[f"{prefix}_score"] = f"""
    SELECT query_id, doc_id, sum(qtf * idf * tf * 2.5::DOUBLE /
             (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / avg_doc_len))) AS score
    FROM asked_terms JOIN {prefix}_postings USING (term) JOIN {prefix}_idf USING (term), {prefix}_stats
    GROUP BY query_id, doc_id"""


CTES["asked_terms"] = f"""
    SELECT query_id, term, count(*) AS qtf FROM (
      SELECT query_id, unnest(regexp_extract_all(lower(query), {lit(WORD)})) AS term FROM asked) GROUP BY ALL"""
lexical_ctes("lex", "documents", "doc_id", "text")


def top(source: str, k: int, item: str, keep: str = "", ascending: bool = False) -> str:
    return f"""SELECT query_id, rank::INT AS rank, {item}, score{keep} FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) {'ASC' if ascending else 'DESC'}, {item}) AS rank
      FROM ({source})) WHERE rank <= {k}"""


# -- dense --------------------------------------------------------------------------------

CTES["doc_vectors"] = hashed("docs", "document || '_chunk_0'", "text")
CTES["records"] = """
    SELECT document || '_chunk_0' AS id, document, 0 AS chunk_index,
           CASE WHEN lang = 'en' THEN 'text' WHEN lang = 'fr' THEN 'table' ELSE 'image' END AS chunk_type,
           coalesce(source, '') AS section_title, (n_chars % 50)::INT AS page_number, n_chars % 5 = 0 AS has_image,
           text AS original_content, text AS full_content, v::DOUBLE[] AS v
    FROM docs JOIN doc_vectors ON key = document || '_chunk_0'"""
CTES["asked_vectors"] = hashed("asked", "query_id", "query")


def cosine(a: str, b: str) -> str:
    squares = f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
    return f"CASE WHEN {squares} = 0 THEN 0 ELSE list_dot_product({a}, {b}) / {squares} END"


def dense(searches: str, where: str = "true", columns: str = "") -> str:
    """Scores of (query_id, v) rows against the records."""
    return f"""SELECT q.query_id{columns}, r.id AS chunk_id, {cosine('r.v', 'q.v')} AS score
      FROM {searches} q, records r WHERE {where}"""


CTES["plain"] = "SELECT key AS query_id, v::DOUBLE[] AS v FROM asked_vectors"
SHOWN = "query_id, rank, chunk_id, round(score, 6) AS score, md5(original_content) AS content, document, chunk_type, page_number, has_image"


def shown(hits: str, more: str = "") -> str:
    return f"SELECT {SHOWN}{more} FROM ({hits}) h JOIN records r ON r.id = h.chunk_id"


def given_dense(score: str, ascending: bool = False) -> str:
    pairs = f"""SELECT q.query_id, e.vec_id AS id, {score} AS score
      FROM plain q, (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) e"""
    return f"SELECT query_id, rank, id, round(score, 6) AS score FROM ({top(pairs, 10, 'id', '', ascending)})"


# -- fusion -------------------------------------------------------------------------------


def fused_ctes(prefix: str, where: str, k: int, words_where: str = "true") -> None:
    CTES[f"{prefix}_dense"] = top(dense("plain", where), 2 * k, "chunk_id")
    found = f"""SELECT q.query_id, r.id AS chunk_id, score FROM lex_score q JOIN records r ON r.document = 'doc_' || doc_id
      WHERE score > 0 AND {words_where}"""
    CTES[f"{prefix}_words"] = top(found, 2 * k, "chunk_id")
    votes = f"""SELECT query_id, chunk_id, sum(vote) AS score FROM (
      SELECT query_id, chunk_id, 0.7::DOUBLE * (1.0::DOUBLE / (60 + rank)) AS vote FROM {prefix}_dense
      UNION ALL SELECT query_id, chunk_id, (1 - 0.7::DOUBLE) * (1.0::DOUBLE / (60 + rank)) FROM {prefix}_words) GROUP BY ALL"""
    CTES[f"{prefix}_fused"] = top(votes, k, "chunk_id")
    CTES[prefix] = f"""
    SELECT f.*, d.chunk_id IS NULL AS by_words FROM {prefix}_fused f
    LEFT JOIN {prefix}_dense d ON d.query_id = f.query_id AND d.chunk_id = f.chunk_id"""


fused_ctes("hybrid", "true", 10)
BOTH = """r.page_number >= 5 AND (q.query_id % 3 <> 0 OR r.page_number <= 25) AND (q.query_id % 5 <> 0 OR r.has_image)
    AND (q.query_id % 2 = 0 OR r.chunk_type = 'text')"""
fused_ctes("hybrid_both", BOTH, 10, BOTH)
fused_ctes("hybrid_part", "r.chunk_type = 'table'", 10)


def hybrid(source: str) -> str:
    def meta(name: str) -> str:
        return f"CASE WHEN by_words THEN NULL ELSE {name} END AS {name}"

    return f"""SELECT query_id, rank, chunk_id, round(score, 6) AS score,
      md5(CASE WHEN by_words THEN full_content ELSE original_content END) AS content, {meta('document')}, {meta('chunk_type')},
      {meta('page_number')}, {meta('has_image')}, CASE WHEN by_words THEN 'bm25' END AS source
      FROM {source} h JOIN records r ON r.id = h.chunk_id"""


CTES["answers"] = f"""
    SELECT a.query_id, a.query, {strip('b.query')} AS response FROM asked a
    LEFT JOIN asked b ON b.query_id = a.query_id + 1 AND a.query_id % 4 <> 3"""
CTES["variants"] = f"""
    SELECT query_id, 0 AS variant, query AS search_text FROM asked
    UNION ALL
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY i))::INT, line FROM (
      SELECT query_id, i, {strip('raw')} AS line FROM (
        SELECT query_id, unnest(string_split(replace(query, '. ', chr(10)), chr(10))) AS raw,
               generate_subscripts(string_split(replace(query, '. ', chr(10)), chr(10)), 1) AS i
        FROM asked WHERE query_id % 5 <> 0)) WHERE line <> ''"""
CTES["searches"] = """
    SELECT query_id, 0 AS variant, query AS search_text FROM asked
    UNION SELECT query_id, 0, coalesce(response, query) FROM answers
    UNION SELECT query_id, variant, search_text FROM variants WHERE variant <= 3"""
CTES["search_vectors"] = hashed("(SELECT DISTINCT search_text FROM searches)", "search_text", "search_text")
CTES["hyde_v"] = """
    SELECT query_id, response, v::DOUBLE[] AS v FROM answers JOIN search_vectors ON key = coalesce(response, query)"""
CTES["variant_v"] = "SELECT query_id, variant, v::DOUBLE[] AS v FROM variants JOIN search_vectors ON key = search_text"


def expanded(k: int, variants: int) -> str:
    each = f"""SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY query_id, variant ORDER BY round(score, 9) DESC, chunk_id) AS place
      FROM ({dense(f"(SELECT * FROM variant_v WHERE variant <= {variants})", columns=", q.variant")})) WHERE place <= {k}"""
    return top(f"SELECT query_id, chunk_id, avg(score) AS score FROM ({each}) GROUP BY ALL", k, "chunk_id")


def hyde(k: int) -> str:
    return top(dense("hyde_v", columns=", q.response"), k, "chunk_id", ", response")


def reranked(hits: str, k: int, more: str = "") -> str:
    """Ranking texts by query number: listed places first, then the old order."""
    listed = """SELECT query_id, place, n FROM (
        SELECT query_id, unnest(l) AS n, generate_subscripts(l, 1) AS place FROM (
          SELECT query_id, CASE query_id % 3 WHEN 1 THEN [3, 1, 2, 99] WHEN 2 THEN [7, 5, 2] END AS l FROM asked))"""
    return f"""SELECT query_id, rank, chunk_id, score{more} FROM (
      SELECT c.query_id, c.chunk_id, c.score{more}, row_number() OVER (
        PARTITION BY c.query_id ORDER BY CASE WHEN n <= size THEN place END NULLS LAST, c.rank)::INT AS rank
      FROM (SELECT *, max(rank) OVER (PARTITION BY query_id) AS size FROM ({hits})) c
      LEFT JOIN ({listed}) l ON l.query_id = c.query_id AND l.n = c.rank) WHERE rank <= {k}"""


CTES["advanced_lists"] = f"""
    SELECT query_id, chunk_id, score, 0 AS place, NULL AS hyde_query FROM ({top(dense('plain'), 20, 'chunk_id')})
    UNION ALL SELECT query_id, chunk_id, score, 1, response FROM ({hyde(20)})
    UNION ALL SELECT query_id, chunk_id, score, 2, NULL FROM ({expanded(20, 2)})"""
CTES["advanced"] = top(
    """SELECT query_id, chunk_id, avg(score) AS score, min(struct_pack(p := place, h := hyde_query)).h AS hyde_query
       FROM advanced_lists GROUP BY query_id, chunk_id""",
    10,
    "chunk_id",
    ", hyde_query",
)

# -- chunk search: the whole way ----------------------------------------------------------

CTES["made"] = records("small", FALLBACK)
CTES["made_v"] = hashed("made", "chunk_id", "contextualized_content")
lexical_ctes("made_lex", "made", "chunk_id", "contextualized_content")
CTES["made_dense"] = top(
    f"SELECT q.query_id, c.key AS chunk_id, {cosine('c.v::DOUBLE[]', 'q.v')} AS score FROM plain q, made_v c", 20, "chunk_id"
)
CTES["made_words"] = top("SELECT query_id, doc_id AS chunk_id, score FROM made_lex_score WHERE score > 0", 20, "chunk_id")
CTES["made_fused"] = top(
    """SELECT query_id, chunk_id, sum(vote) AS score FROM (
      SELECT query_id, chunk_id, 0.7::DOUBLE * (1.0::DOUBLE / (60 + rank)) AS vote FROM made_dense
      UNION ALL SELECT query_id, chunk_id, (1 - 0.7::DOUBLE) * (1.0::DOUBLE / (60 + rank)) FROM made_words) GROUP BY ALL""",
    10,
    "chunk_id",
)

# -- the queries --------------------------------------------------------------------------

ORACLE: dict[str, str] = {}

ORACLE["extract_route"] = """
SELECT '/in/' || name || suffix AS path, name || '.json' AS output, lower(suffix) AS extension,
       CASE WHEN lower(suffix) IN ('.pdf', '.pptx', '.docx') THEN 'hi_res'
            WHEN suffix IN ('.txt', '.md', '.csv') THEN 'fast' ELSE 'auto' END AS strategy,
       CASE WHEN suffix = '.pdf' THEN 'yolox' END AS hi_res_model_name,
       CASE WHEN lower(suffix) IN ('.pdf', '.pptx', '.docx') THEN true END AS tables,
       CASE WHEN lower(suffix) IN ('.pdf', '.pptx') THEN 'Image,Table' END AS image_blocks,
       CASE WHEN suffix = '.pdf' THEN 10 END AS split_pdf_concurrency_level, 'eng' AS languages
FROM (SELECT regexp_extract(source, '([^/]*)$', 1) || '.' || doc_id AS name, source,
             ['.pdf', '.PPTX', '.docx', '.html', '.txt', '.md', '.csv', '.xyz'][doc_id % 8 + 1] AS suffix FROM docs)"""
ORACLE["elements_from_text"] = "SELECT document, pos, type, text FROM els"

CTES["pieces"] = f"""
    SELECT document, i, CASE WHEN i = 1 THEN '' ELSE split_part(p, chr(2), 1) END AS tag,
           CASE WHEN i = 1 THEN p ELSE split_part(p, chr(2), 2) END AS rest FROM (
      SELECT document, unnest(string_split(m, chr(1))) AS p, generate_subscripts(string_split(m, chr(1)), 1) AS i FROM (
        SELECT page_id::VARCHAR AS document, regexp_replace(regexp_replace(
                 translate(html, chr(1) || chr(2), '  '), {lit(HTML_DROPPED)}, '', 'g'),
                 {lit(HTML_BLOCK)}, chr(1) || '\\1' || chr(2), 'g') AS m FROM pages))"""
_plain = spaced(unescape(f"regexp_replace(regexp_replace(rest, {lit(HTML_BREAK)}, ' ', 'g'), {lit(HTML_TAG)}, '', 'g')"))
_cells = spaced(unescape(f"regexp_replace(tag, {lit(HTML_TAG)}, ' ', 'g')"))
CTES["page_rows"] = f"""
    SELECT document, i, 1 AS o, 'Table' AS type, {_cells} AS text, tag AS text_as_html, NULL AS image_base64, NULL AS filetype
    FROM pieces WHERE regexp_matches(tag, '(?i)^<table\\b')
    UNION ALL SELECT document, i, 1, 'Image', '', NULL, regexp_extract(tag, {lit(HTML_DATA_IMAGE)}, 2),
           lower(regexp_extract(tag, {lit(HTML_DATA_IMAGE)}, 1))
    FROM pieces WHERE regexp_matches(tag, '(?i)^<img\\b') AND regexp_extract(tag, {lit(HTML_DATA_IMAGE)}, 2) <> ''
    UNION ALL SELECT * FROM (SELECT document, i, 2, CASE WHEN regexp_matches(tag, '(?i)^<h[1-6]\\b') THEN 'Title'
           WHEN regexp_matches(tag, '(?i)^<p\\b') THEN 'NarrativeText' WHEN regexp_matches(tag, '(?i)^<li\\b') THEN 'ListItem'
           ELSE 'UncategorizedText' END, {_plain} AS text, NULL, NULL, NULL FROM pieces) WHERE text <> ''"""
ORACLE["elements_from_html"] = """
SELECT document, (row_number() OVER (PARTITION BY document ORDER BY i, o) - 1)::INT AS pos, type, text, text_as_html,
       image_base64, filetype FROM page_rows"""
ORACLE["elements_from_csv"] = """
SELECT o_orderkey::VARCHAR AS document, 0 AS pos, 'Table' AS type,
       'key customer status priority note' || chr(10) || o_orderkey || ' ' || o_custkey || ' ' || o_orderstatus || ' '
       || o_orderpriority || ' ' || note AS text,
       '<table><tr><td>key</td><td>customer</td><td>status</td><td>priority</td><td>note</td></tr><tr><td>' || o_orderkey
       || '</td><td>' || o_custkey || '</td><td>' || o_orderstatus || '</td><td>' || o_orderpriority || '</td><td>' || note
       || '</td></tr></table>' AS text_as_html
FROM (SELECT *, CASE o_orderkey % 4
             WHEN 0 THEN 'by "' || o_orderpriority || '", late' || chr(10) || 'or never' WHEN 1 THEN ''
             WHEN 2 THEN '5" ' || o_orderpriority ELSE o_orderpriority END AS note FROM orders)"""
CTES["toxic"] = "SELECT DISTINCT 'doc_' || doc_id AS document FROM labels WHERE toxic = 1"
ORACLE["elements_from_json"] = "SELECT document, pos, type, text FROM els WHERE document NOT IN (SELECT document FROM toxic)"
CTES["log"] = """
    SELECT document || '.json' AS filename, CASE WHEN bad THEN 'failed' ELSE 'success' END AS status,
           CASE WHEN NOT bad THEN n END AS elements_count, NULL::VARCHAR AS strategy,
           CASE WHEN bad THEN 'not a JSON array of elements' END AS error
    FROM (SELECT d.document, d.document IN (SELECT document FROM toxic) AS bad, count(e.pos)::INT AS n
          FROM docs d LEFT JOIN els e USING (document) GROUP BY ALL)"""
ORACLE["extract_log"] = "SELECT * FROM log"
ORACLE["extract_summary"] = """
SELECT count(*) AS total, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
       sum(elements_count)::BIGINT AS elements FROM log"""
ORACLE["valid_elements"] = "SELECT document, pos, type, text FROM valid"
ORACLE["image_enriched_elements"] = """
SELECT document, pos, type, text, description AS image_description,
       CASE WHEN type = 'Image' THEN true END AS has_image, image_base64 FROM described"""
ORACLE["media_type"] = """
SELECT CASE filetype WHEN 'jpg' THEN 'image/jpeg' WHEN 'image/gif' THEN 'image/gif' ELSE 'image/png' END AS media_type,
       count(*) AS n FROM mixed WHERE type = 'Image' GROUP BY 1"""
ORACLE["section_titles"] = """
SELECT document, pos, type, last_value(CASE WHEN type = 'Title' THEN text END IGNORE NULLS)
       OVER (PARTITION BY document ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section_title FROM valid"""
ORACLE["hard_segments"] = """
SELECT document, pos, type, (count(*) FILTER (type IN ('Table', 'Image'))
       OVER (PARTITION BY document ORDER BY pos ROWS UNBOUNDED PRECEDING))::INT AS segment FROM valid"""
ORACLE["document_text"] = "SELECT document, part, text FROM parts"
ORACLE["token_counts"] = f"SELECT doc_id, {tokens('text')} AS tokens FROM documents"
ORACLE["word_tokens"] = """
SELECT doc_id, len(w)::INT AS n_words, md5(array_to_string(w, ' ')) AS words_md5 FROM lex_words"""
ORACLE["html_table_markdown"] = f"""
SELECT document, pos, {markdown('html')} AS markdown FROM (
  SELECT document, pos, {TABLE_HTML} AS html FROM els UNION ALL SELECT page_id::VARCHAR, -1, html FROM pages)"""
ORACLE["cosine_pairs"] = f"""
SELECT a.vec_id, round({cosine('a.v', 'b.v')}, 6) AS similarity
FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) a
JOIN (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) b ON b.vec_id = a.vec_id + 1"""
ORACLE["chunk_basic"] = records("basic")
ORACLE["chunk_overlap"] = records("overlapped")
ORACLE["chunk_semantic"] = records("alike")
ORACLE["long_chunk_overlap"] = records("tiny_overlapped")
ORACLE["chunk_text"] = f"""
SELECT document, pos // 3 AS chunk_ord, string_agg(t, chr(10) || chr(10) ORDER BY pos) AS text FROM (
  SELECT document, pos, CASE WHEN type = 'Table' AND coalesce(text_as_html <> '', false)
         THEN {markdown('text_as_html')} ELSE text END AS t FROM mixed) WHERE {filled('t')} GROUP BY ALL"""
CTES["told_contexts"] = f"""
    SELECT c.*, coalesce(response, {FALLBACK.replace('document', 'c.document')}) AS context FROM told c
    LEFT JOIN texts p ON p.document = c.document
    LEFT JOIN (SELECT sha256(p2.sha || chr(10) || o.original_content) AS id,
                      min({strip("' About ' || left(o.original_content, 9)")}) AS response
               FROM told o JOIN texts p2 ON p2.document = o.document WHERE o.chunk_index % 2 = 0 GROUP BY 1) a
      ON a.id = sha256(p.sha || chr(10) || c.original_content)"""
ORACLE["chunk_records"] = records("told_contexts", "context")
ORACLE["chunk_documents"] = records("whole", FALLBACK)
ORACLE["context_fallback"] = f"SELECT chunk_id, {FALLBACK} AS context FROM basic"
_head, _middle, _tail = (lit(p) for p in enrich.CONTEXT_PROMPT)


def _requests(source: str) -> str:
    return f"""
SELECT chunk_id, sha256(sha || chr(10) || original_content) AS request_id, length(prompt)::INT AS chars,
       md5(prompt) AS prompt_md5 FROM (
  SELECT chunk_id, original_content, sha, {_head} || text || {_middle} || original_content || {_tail} AS prompt
  FROM {source} JOIN texts USING (document))"""


ORACLE["context_requests"] = _requests("basic")
ORACLE["long_context_requests"] = _requests("tiny")
ORACLE["chunks_from_json"] = f"""
SELECT chunk_id || '_chunks.json' AS filename, unnest([0, 1])::INT AS file_pos, * FROM ({records('whole', FALLBACK)})"""
ORACLE["chunks_round_trip"] = f"""
SELECT document || '_chunks.json' AS filename, (row_number() OVER (PARTITION BY document ORDER BY chunk_index) - 1)::INT AS file_pos, *
FROM ({records('small', FALLBACK)})"""
ORACLE["chunk_defaults"] = records("default_sizes")
ORACLE["extract_files_log"] = """
SELECT file AS filename, CASE WHEN error IS NULL THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN error IS NULL THEN coalesce(n, 0)::INT END AS elements_count, CASE WHEN error IS NULL THEN 'fast' END AS strategy, error
FROM (SELECT document || ['.txt', '.MD', '.pdf', '.xyz'][doc_id % 4 + 1] AS file, CASE WHEN doc_id % 7 <> 0 THEN n END AS n,
             CASE WHEN doc_id % 4 >= 2 THEN 'no reader for file type ' || ['.pdf', '.xyz'][doc_id % 4 - 1]
                  WHEN doc_id % 5 = 0 THEN 'content is not UTF-8' END AS error
      FROM docs LEFT JOIN (SELECT document, count(*) AS n FROM els GROUP BY document) e USING (document))"""
ORACLE["elements_round_trip"] = "SELECT document, pos, type, text, page_number, text_as_html, image_base64, filetype FROM mixed"
ORACLE["search_ids_only"] = f"SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM ({top(dense('plain'), 5, 'chunk_id')})"
ORACLE["hash_embed"] = f"""
SELECT doc_id, place::INT AS place, round(value::DOUBLE, 6) AS value FROM (
  SELECT key AS doc_id, unnest(v) AS value, unnest(range({DIMS})) AS place FROM own_vectors) WHERE value <> 0"""
CTES["own_vectors"] = hashed("documents", "doc_id", "text")
CTES["said"] = "SELECT text FROM conversations UNION ALL SELECT query FROM asked UNION ALL SELECT query FROM asked"
CTES["cached"] = "SELECT DISTINCT text FROM conversations WHERE role = 'user'"
CTES["cached_v"] = hashed("cached", "text", "text")
ORACLE["embed_texts"] = f"""
SELECT md5(text) AS text_md5, round(coalesce(list_sum(list_transform(v, lambda x: abs(x::DOUBLE))), 0), 6) AS total,
       {DIMS} AS dims FROM said LEFT JOIN cached_v ON key = text"""
ORACLE["embedding_misses"] = """
SELECT DISTINCT sha256(text) AS text_sha, length(text)::INT AS chars FROM said WHERE text NOT IN (SELECT text FROM cached)"""
ORACLE["embedding_cache_stats"] = """
SELECT count(*) AS calls, count(*) - count(DISTINCT text) AS hits, count(DISTINCT text) AS misses FROM said"""
ORACLE["ask_twice"] = """
SELECT sha256(text) AS request_id, CASE WHEN n % 7 = 0 OR n % 5 = 0 THEN 2 ELSE 1 END AS sent,
       CASE WHEN n % 7 = 0 OR n % 5 = 0 THEN 'again ' ELSE 'said ' END || n AS response,
       CASE WHEN n % 7 = 0 THEN 'ConnectionError: not now' WHEN n % 5 = 0 THEN 'no response' END AS error
FROM (SELECT DISTINCT text, length(text) AS n FROM conversations WHERE role = 'user' AND text IS NOT NULL)"""
CTES["told_records"] = records("told")
CTES["told_v"] = hashed("told_records", "chunk_id", "contextualized_content")
ORACLE["prepare_vectors"] = """
SELECT chunk_id AS id, chunk_id, document, chunk_index::INT AS chunk_index, chunk_type, coalesce(section_title, '') AS section_title,
       coalesce(page_number, 0) AS page_number, element_count, token_count, coalesce(has_image, false) AS has_image,
       nullif(image_description, '') AS image_description, nullif(filetype, '') AS filetype,
       original_content, round(list_sum(list_transform(v, lambda x, i: x::DOUBLE * i)), 6) AS weighed,
       round(list_max(v)::DOUBLE, 6) AS largest FROM told_records JOIN told_v ON key = chunk_id"""
CTES["sent"] = """
    SELECT r.id, r.document, 'quality ' || quality AS section_title, page_number, 1 AS seq FROM records r JOIN labelled USING (document)
    UNION ALL SELECT r.id, r.document, 'resent', page_number, 2 FROM records r JOIN labelled USING (document) WHERE toxic = 1
    UNION ALL SELECT 'new_' || r.id, r.document, 'quality ' || quality, page_number, 3 FROM records r JOIN labelled USING (document)"""
CTES["labelled"] = "SELECT 'doc_' || doc_id AS document, quality, toxic FROM labels"
CTES["upserted"] = """
    SELECT id, document, section_title, page_number FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS nth FROM (
        SELECT id, document, section_title, page_number, 0 AS seq FROM records UNION ALL SELECT * FROM sent)) WHERE nth = 1"""
ORACLE["index_upsert"] = "SELECT * FROM upserted"
ORACLE["index_upsert_sequence"] = """
SELECT 'held' AS seen, id, document, section_title, page_number FROM records UNION ALL SELECT 'now', * FROM upserted"""
ORACLE["index_lifecycle"] = f"""
SELECT step, CASE step WHEN 'made' THEN 0 WHEN 'emptied' THEN 0 WHEN 'dropped' THEN NULL
       WHEN 'looked up' THEN (SELECT count(*) FROM records WHERE document IN (SELECT document FROM labelled WHERE toxic = 1))
       ELSE (SELECT count(*) FROM records) END AS total_vectors, CASE WHEN step <> 'dropped' THEN {DIMS} END AS dimensions
FROM (SELECT unnest(['made', 'filled', 'looked up', 'compacted', 'emptied', 'dropped']) AS step)"""
ORACLE["index_stats"] = f"""
SELECT (SELECT count(*) FROM sent) AS upserted, (SELECT count(*) FROM upserted) AS total_vectors, {DIMS} AS dimensions"""
ORACLE["filter_expr"] = """
SELECT id, document, page_number, chunk_type FROM records
WHERE document >= 'doc_2' AND page_number >= 5 AND page_number <= 30 AND chunk_type = 'text'"""
ORACLE["bm25_postings"] = "SELECT * FROM lex_postings"
ORACLE["bm25_stats"] = "SELECT n_docs, round(avg_doc_len, 6) AS avg_doc_len FROM lex_stats"
ORACLE["bm25_df"] = "SELECT term, df FROM lex_idf"
ORACLE["bm25_idf"] = "SELECT term, df, round(idf, 6) AS idf FROM lex_idf"
ORACLE["bm25_score"] = """
SELECT p.query_id, p.doc_id, round(coalesce(score, 0), 6) AS score FROM (
  SELECT DISTINCT doc_id, query_id FROM (
    SELECT doc_id, unnest(CASE WHEN doc_id % 2 = 0 THEN [0, 1] ELSE [0] END) AS further FROM documents) d
  JOIN (SELECT query_id, row_number() OVER (ORDER BY query_id) - 1 AS place, count(*) OVER () AS n FROM asked) a
    ON (doc_id + further) % n = place) p
LEFT JOIN lex_score s ON s.query_id = p.query_id AND s.doc_id = p.doc_id"""
ORACLE["bm25_search"] = f"""
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({top('SELECT * FROM lex_score WHERE score > 0', 10, 'doc_id')})"""
ORACLE["dense_topk"] = given_dense(cosine("e.v", "q.v"))
ORACLE["dense_topk_pruned"] = ORACLE["dense_topk"]
ORACLE["dense_topk_dot"] = given_dense("list_dot_product(e.v, q.v)")
ORACLE["dense_topk_euclidean"] = given_dense("list_distance(e.v, q.v)", True)
ORACLE["semantic_search"] = shown(top(dense("plain"), 5, "chunk_id"))
ORACLE["search_by_document"] = shown(top(dense("plain", "r.document = 'doc_7'"), 5, "chunk_id"))
ORACLE["search_by_type"] = shown(top(dense("plain", "r.chunk_type = 'table'"), 5, "chunk_id"))
ORACLE["search_by_page_range"] = shown(top(dense("plain", "r.page_number BETWEEN 5 AND 10"), 5, "chunk_id"))
ORACLE["search_combined"] = shown(
    top(dense("plain", "r.chunk_type = 'text' AND r.page_number BETWEEN 0 AND 40 AND NOT r.has_image"), 5, "chunk_id")
)
ORACLE["search_combined_per_query"] = shown(
    top(
        dense(
            "plain",
            """(q.query_id % 7 <> 3 OR r.document = 'doc_' || q.query_id)
            AND (q.query_id % 3 = 2 OR r.chunk_type = CASE q.query_id % 3 WHEN 0 THEN 'text' ELSE 'table' END)
            AND (q.query_id % 4 <> 1 OR r.page_number >= 10) AND (q.query_id % 4 >= 2 OR r.page_number <= 30)
            AND (q.query_id % 5 <> 0 OR NOT r.has_image)""",
        ),
        5,
        "chunk_id",
    )
)
_beginning = "(CASE WHEN length({0}) % 2 = 0 THEN left({0}, 40) ELSE {0} END)"
CTES["begun_docs"] = hashed("docs", "document || '_chunk_0'", _beginning.format("text"))
CTES["begun_asked"] = hashed("asked", "query_id", _beginning.format("query"))
_begun = f"""
  SELECT q.key AS query_id, d.key AS chunk_id, {cosine('d.v::DOUBLE[]', 'q.v::DOUBLE[]')} AS score FROM begun_asked q, begun_docs d"""
ORACLE["search_with_cached_vectors"] = shown(top(_begun, 5, "chunk_id"))
ORACLE["hybrid_rrf"] = hybrid("hybrid")
ORACLE["hybrid_filtered"] = hybrid("hybrid_part")
ORACLE["hybrid_filter_both"] = hybrid("hybrid_both")
ORACLE["hybrid_from_buckets"] = hybrid("hybrid")
ORACLE["hybrid_without_lexical"] = shown(top(dense("plain"), 10, "chunk_id"), ", NULL::VARCHAR AS source")
ORACLE["rerank_apply"] = shown(reranked(top(dense("plain"), 10, "chunk_id"), 5))
_head, _middle, _tail = (lit(p) for p in fusion.RERANK_PROMPT)
ORACLE["rerank_requests"] = f"""
SELECT query_id, sha256(prompt) AS request_id, length(prompt)::INT AS chars FROM (
  SELECT a.query_id, {_head} || query || {_middle} || string_agg(chr(10) || '[Document ' || rank || ']' || chr(10)
         || left(original_content, 500) || chr(10), '' ORDER BY rank) || {_tail} AS prompt
  FROM asked a JOIN ({top(dense('plain'), 10, 'chunk_id')}) h ON h.query_id = a.query_id
  JOIN records r ON r.id = h.chunk_id GROUP BY a.query_id, query)"""
ORACLE["expand_queries"] = "SELECT query_id, variant::INT AS variant, search_text FROM variants WHERE variant <= 3"
ORACLE["search_expanded"] = shown(expanded(5, 3))
ORACLE["hyde_search"] = shown(hyde(5), ", response AS hyde_query")
ORACLE["advanced_search"] = shown(reranked("SELECT * FROM advanced", 5, ", hyde_query"), ", hyde_query")
ORACLE["result_cards"] = """
SELECT query_id, rank, format('{:.4f}', score) AS score, chunk_id,
       CASE WHEN by_words THEN 'N/A' ELSE document END AS document, CASE WHEN by_words THEN 'N/A' ELSE chunk_type END AS chunk_type,
       CASE WHEN by_words THEN 'N/A' ELSE page_number::VARCHAR END AS page_number,
       CASE WHEN by_words THEN NULL ELSE nullif(section_title, '') END AS section_title,
       replace(left(CASE WHEN by_words THEN full_content ELSE original_content END, 200), chr(10), ' ') || '...' AS preview
FROM hybrid h JOIN records r ON r.id = h.chunk_id"""
ORACLE["results_json"] = f"""
SELECT query_id, rank, chunk_id, round(score, 6) AS score, md5(original_content) AS content, page_number
FROM ({top(dense('plain'), 5, 'chunk_id')}) h JOIN records r ON r.id = h.chunk_id"""
ORACLE["search_chunks"] = """
SELECT f.query_id, f.rank, f.chunk_id, round(f.score, 6) AS score,
       md5(CASE WHEN d.chunk_id IS NULL THEN contextualized_content ELSE original_content END) AS content,
       CASE WHEN d.chunk_id IS NOT NULL THEN document END AS document, CASE WHEN d.chunk_id IS NOT NULL THEN 'text' END AS chunk_type,
       CASE WHEN d.chunk_id IS NOT NULL THEN 0 END AS page_number, CASE WHEN d.chunk_id IS NOT NULL THEN false END AS has_image,
       CASE WHEN d.chunk_id IS NULL THEN 'bm25' END AS source
FROM made_fused f JOIN made m ON m.chunk_id = f.chunk_id
LEFT JOIN made_dense d ON d.query_id = f.query_id AND d.chunk_id = f.chunk_id"""


def sql(name: str) -> str:
    """A query with the tables it needs in front of it."""
    needed: list[str] = []

    def mentions(text: str, table: str) -> bool:
        return re.search(rf"(?:\b(?:FROM|JOIN)|,)\s*{table}\b", text) is not None

    def add(text: str, asking: str | None = None) -> None:
        for table in CTES:
            if table not in needed and table != asking and mentions(text, table):
                add(CTES[table], table)
                needed.append(table)

    add(ORACLE[name])
    definitions = ",\n".join(f"{table} AS MATERIALIZED ({CTES[table]})" if not table.endswith("_walk") else f"{table} AS ({CTES[table]})" for table in needed)
    return f"WITH RECURSIVE {definitions}\n{ORACLE[name]}" if needed else ORACLE[name]
