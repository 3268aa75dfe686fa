"""DuckDB statements for the queries whose result SQL can express.

They state the results by definition, without the operators' methods: every window,
every pair that shares a shingle, every masked position.
"""

from __future__ import annotations

from encore.llm.decontam import LEAST, MASKS, MIN_WORDS, WINDOW as OVERLAP

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{_SPACE}'), lambda x: x <> '')"


# record by record: the WARC header, the HTTP header, and the payload of a response
_LINE = r"chr(13) || chr(10)"
OP1 = f"""
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
    q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p),
    t AS (SELECT *, n >= 1000 AND page_id <> last AS again, sha1(html) AS digest,
                 'HTTP/1.1 200 OK' || {_LINE} || 'Content-Type: text/html; charset=utf-8' || {_LINE} || 'Content-Length: ' || n || {_LINE} || {_LINE} AS http
          FROM q),
    r AS (SELECT *, 'WARC/1.1' || {_LINE} || 'WARC-Type: ' || CASE WHEN again THEN 'revisit' ELSE 'response' END || {_LINE}
                    || 'WARC-Record-ID: <urn:x-record:' || page_id || '>' || {_LINE}
                    || coalesce('WARC-Target-URI: ' || replace(replace(url, chr(13), '%0D'), chr(10), '%0A') || {_LINE}, '')
                    || 'WARC-Date: 1970-01-01T00:00:00Z' || {_LINE} || 'WARC-Payload-Digest: sha1:' || digest || {_LINE}
                    || CASE WHEN again THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || {_LINE}
                                            || 'WARC-Refers-To: <urn:x-record:' || last || '>' || {_LINE} ELSE '' END
                    || 'Content-Type: application/http;msgtype=response' || {_LINE}
                    || 'Content-Length: ' || (strlen(http) + CASE WHEN again THEN 0 ELSE n END) || {_LINE} || {_LINE} || http
                    || CASE WHEN again THEN '' ELSE html END || {_LINE} || {_LINE} AS record FROM t)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN last END AS refers_to, strlen(record) AS record_bytes, sha256(record) AS record_sha256
    FROM r"""

# the derived traffic of ``chat.traffic`` and what follows for each call, without going through JSON
OP2 = """
    WITH RECURSIVE t AS (SELECT *, len(string_split_regex(trim(text), ' +')) AS n FROM conversations),
    a AS (SELECT conv_id, turn, n, text, turn % 11 = 10 AS twice,
                 turn >= 2 AS waits,
                 CASE WHEN n % 3 = 0 THEN 'fetch' WHEN n % 17 = 1 THEN 'browse' ELSE 'search' END AS name,
                 CASE WHEN turn % 3 = 0 THEN 'fuzzy' WHEN turn % 3 = 1 THEN 'loose' END AS mode
          FROM t WHERE role = 'assistant'),
    levels AS (SELECT conv_id, turn, 0 AS level FROM a WHERE NOT waits
               UNION ALL SELECT a.conv_id, a.turn, level + 1 FROM levels JOIN a ON a.conv_id = levels.conv_id AND a.turn = levels.turn + 2 AND a.waits),
    c AS (SELECT conv_id, turn, CAST(0 AS INTEGER) AS position, 'c' || turn AS call_id, name, level, n, mode,
                 CASE WHEN n % 3 <> 0 THEN '{"limit":' || n % 25 || CASE WHEN mode IS NULL THEN '' ELSE ',"mode":"' || mode || '"' END
                                           || ',"query":' || to_json(text) || '}'
                      WHEN n % 2 = 0 THEN '{"page":' || n || '}' ELSE '{"raw":"yes"}' END AS arguments,
                 CASE WHEN name = 'browse' THEN ['unknown tool'] WHEN name = 'fetch' THEN CASE WHEN n % 2 = 0 THEN [] ELSE ['missing page', 'type of raw'] END
                      ELSE CASE WHEN n % 25 BETWEEN 1 AND 20 THEN [] ELSE ['range of limit'] END || CASE WHEN mode = 'loose' THEN ['value of mode'] ELSE [] END
                 END AS errors
          FROM a LEFT JOIN levels USING (conv_id, turn)
          UNION ALL SELECT conv_id, turn, 1, 'c' || turn || 'b', 'fetch', 0, n, mode, '{"page":0.5}', [] FROM a WHERE twice),
    r AS (SELECT conv_id, turn AS result_turn, 'c' || (turn - 1) AS call_id, text AS content
          FROM t WHERE role <> 'assistant' AND turn >= 1)
    SELECT conv_id, turn, position, call_id, name, level, result_turn, CAST(result_turn IS NOT NULL AS BIGINT) AS n_results,
           array_to_string(errors, '; ') AS errors, len(errors) = 0 AS valid,
           '{"arguments":' || arguments || ',"call_id":"' || call_id || '","content":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null')
             || ',"errors":' || to_json(errors) || ',"level":' || coalesce(CAST(level AS VARCHAR), 'null') || ',"name":"' || name
             || '","valid":' || (len(errors) = 0) || '}' AS json
    FROM c LEFT JOIN r USING (conv_id, call_id)"""

OP4 = """
    WITH u AS (SELECT page_id, lower(coalesce(url, '')) AS low,
                      CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
               FROM pages),
    s AS (SELECT page_id, low,
                 translate(CASE WHEN contains(rest, '/') THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE rest END,
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
          FROM u),
    r AS (SELECT *, CASE
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM s)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN contains(low, '/wp-admin/') OR contains(low, '/wp-login.') OR contains(low, '/cgi-bin/')
                  OR contains(low, '/xmlrpc.') OR contains(low, '?sessionid=') OR contains(low, '&sessionid=')
                  OR low LIKE '%/cart/%checkout=%' OR contains(low, '://ads.') THEN 'block'
                ELSE 'allow' END AS verdict
    FROM r"""

# links of every document to every other with Jaccard similarity of at least 0.8, and what they reach
OP5 = f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_words("text")} AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN ['']
              ELSE list_transform(range(0, greatest(len(ws) - 4, 1)), lambda k: array_to_string(ws[k + 1:k + 5], ' ')) END) AS x FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE c >= 0.8 * (p.n + q.n - c)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
    class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
    links AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a)
    SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM class LEFT JOIN links USING (doc_id)"""


def _folded(text: str) -> str:
    """Words without case and punctuation, each with its place among all words."""
    fold = r"regexp_replace(replace(lower(x), 'ß', 'ss'), '[^\p{L}\p{M}\p{N}]+', '', 'g')"
    return f"list_filter(list_transform({_words(text)}, lambda x, i: {{'k': i - 1, 'w': {fold}}}), lambda e: e.w <> '')"


def _fitting() -> str:
    """At how many places the masks of an item's length fit the equal words."""
    def fit(mask: str) -> str:
        each = " AND ".join(f"eq[s + {k + 1}] = 1" for k, c in enumerate(mask) if c == "1")
        return f"len(list_filter(range(0, n_item - {len(mask) - 1}), lambda s: {each}))"
    return "CASE " + " ".join(f"WHEN n_item >= {n} THEN {' + '.join(map(fit, masks))}" for n, masks in MASKS) + " ELSE 1 END"


# every way to lay an item over a document that shares three words in a row with it (16 equal words of 20 leave four,
# the permitted changes of shorter items at least three), judged word by word; items below the masks' lengths are sought whole
OP6 = f"""
    WITH d AS (SELECT doc_id, list_transform(e, lambda x: x.k) AS ks, list_transform(e, lambda x: x.w) AS ws
               FROM (SELECT doc_id, {_folded("text")} AS e FROM documents)),
    i AS (SELECT *, row_number() OVER () AS no FROM (
              SELECT DISTINCT item_id, list_transform(e, lambda x: x.w) AS iw FROM (SELECT item_id, {_folded("text")} AS e FROM benchmark))
          WHERE len(iw) >= {MIN_WORDS}),
    dr AS (SELECT doc_id, q, ws[q + 1:q + 3] AS run FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 2)) AS q FROM d)),
    ir AS (SELECT no, p, iw[p + 1:p + 3] AS run FROM (SELECT no, iw, unnest(range(0, len(iw) - 2)) AS p FROM i)),
    c AS (SELECT DISTINCT doc_id, no, q - p AS laid FROM dr JOIN ir USING (run)),
    v AS (SELECT doc_id, item_id, no, CASE WHEN laid < 0 THEN laid ELSE ks[laid + 1] END AS start, len(iw) AS n_item,
                 CASE WHEN len(iw) < {MASKS[-1][0]} THEN len(iw) ELSE least(len(iw), {OVERLAP}) END AS width,
                 list_transform(range(0, len(iw)), lambda k: CASE WHEN laid + k >= 0 AND ws[laid + k + 1] = iw[k + 1] THEN 1 ELSE 0 END) AS eq
          FROM c JOIN d USING (doc_id) JOIN i USING (no)),
    ok AS (SELECT * FROM v WHERE list_max(list_transform(range(0, n_item - width + 1), lambda k: list_sum(eq[k + 1:k + width])))
                                 >= CASE WHEN n_item < {MASKS[-1][0]} THEN width ELSE ceil({LEAST} * width) END)
    SELECT doc_id, item_id, CAST(min(start) AS INTEGER) AS start_word, CAST(max(list_sum(eq)) AS BIGINT) AS n_equal,
           max(n_item) AS n_item, CAST(sum({_fitting()}) AS BIGINT) AS n_seeds
    FROM ok GROUP BY doc_id, item_id, no"""

OP8 = f"""
    WITH w AS (SELECT doc_id, {_words("text")} AS ws FROM documents),
    r AS (SELECT doc_id, s, array_to_string(ws[s + 1:s + 50], ' ') AS run
          FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 49)) AS s FROM w)),
    first AS (SELECT run, min(doc_id) AS owner FROM r GROUP BY run),
    cut AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS k FROM r JOIN first USING (run) WHERE owner < doc_id),
    gone AS (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text
             FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS k FROM w) ANTI JOIN cut USING (doc_id, k) GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

# the test pages have one layout: the article's element with a heading and paragraphs, some broken off by a bold word
OP11 = r"""
    WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS inner_html FROM pages),
    t AS (SELECT page_id, url, regexp_replace(regexp_replace(inner_html, '</?b>', '', 'g'), '</?(p|h1|br)>', ' ', 'g') AS t FROM a),
    d AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(t, '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM t)
    SELECT page_id, url, text, len(text) AS n_chars FROM d"""

# every prefix of every rebuilt conversation, by its turns themselves; CRC-32 bit by bit
OP13 = """
    WITH o AS (SELECT conv_id AS c, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST) AS t
               FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    h AS (SELECT c, t, xor(4294967295, list_reduce(
              list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
              lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h FROM o),
    r AS (SELECT h.c, list_concat(coalesce(b.t[1:h.h], []), h.t[h.h + 1:]) AS t FROM h LEFT JOIN o AS b ON b.c = h.c - h.c % 5),
    p AS (SELECT c, t, unnest(range(0, len(t) + 1)) AS depth FROM r),
    k AS (SELECT c, depth, t[1:depth] AS node, len(t) = depth AS at_end, CASE WHEN depth > 0 THEN strlen(t[depth][2]) ELSE 0 END AS bytes FROM p),
    n AS (SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (at_end), '')) AS ends_sha256
          FROM k GROUP BY node, depth),
    children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
    full_n AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN children USING (node)),
    over AS (SELECT n_children, n_convs, bytes, node, unnest(range(0, depth + 1)) AS d FROM full_n),
    sums AS (SELECT node[1:d] AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
             FROM over GROUP BY ALL)
    SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
    FROM full_n AS f JOIN sums USING (node) LEFT JOIN n AS u ON f.depth > 0 AND u.node = f.node[1:f.depth - 1]"""

ORACLE = {
    "op1_warc": OP1,
    "op2_chat_format": OP2,
    "op4_url_rules": OP4,
    "op5_ngram_join": OP5,
    "op6_decontamination": OP6,
    "op8_substring_dedup": OP8,
    "op11_main_text": OP11,
    "op13_prefix_trie": OP13,
}
