"""DuckDB SQL for the queries that SQL can express.

None for language ID (learned filters), sharding and packing (sequential placement), token files
(merged tokens), neighbours (approximate search) and language-model scores (learned weights): those are tested
against brute force.
"""

from __future__ import annotations

from wattfold.llm.mixing import EPOCHS, SEED, WEIGHTS
from wattfold.llm.warc import DATE, MARKUP

_OPEN, _MIDDLE, _CLOSE = "<s>[INST]", "[/INST]", "</s>"


def _escaped(text: str) -> str:
    return rf"regexp_replace({text}, '([<\[])(\\*/?(?:s>|INST\]))', '\1\\\2', 'g')"


CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS bigint) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       cast(sum({len(_OPEN + _MIDDLE + _CLOSE)} + length({_escaped('role')}) + length({_escaped('text')})) AS bigint)
           AS formatted_chars
FROM turns GROUP BY conv_id
"""

JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
    SELECT a, b FROM links
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""

MIX = rf"""
WITH sized AS (
    SELECT doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size
    FROM documents
), sources AS (
    SELECT source, cast(sum(size) AS bigint) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, list_extract({list(WEIGHTS)}, cast((place - 1) % {len(WEIGHTS)} + 1 AS bigint)) AS weight
    FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sources)
), ranked AS (
    SELECT *, cast(source_size * {EPOCHS} AS double) / weight AS ratio FROM weighed
), levels AS (
    SELECT *, cast(sum(source_size) OVER ()
                   - coalesce(sum(source_size * {EPOCHS}) OVER (ORDER BY ratio, place
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS double)
              / cast(sum(weight) OVER (ORDER BY ratio, place
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS double) AS level
    FROM ranked
), wanted AS (
    SELECT source, source_size, coalesce(least(cast(source_size * {EPOCHS} AS double),
           (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, place LIMIT 1) * weight), 0.0) AS target
    FROM levels
), placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source
                       ORDER BY md5(coalesce(cast(doc_id AS varchar), '') || '{SEED}'), doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE cast(
           (cast(floor(target) AS bigint) // source_size) * size
           + greatest(0, least(size, cast(floor(target) AS bigint) % source_size - before)) AS bigint) END AS taken
FROM placed JOIN wanted ON placed.source IS NOT DISTINCT FROM wanted.source
"""

DEDUP = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def _plain_text(html: str) -> str:
    """The same replacements; a pattern's flags stand in front of it in Java and apart in DuckDB."""
    text = html
    for pattern, replacement in MARKUP:
        flags = "g"
        if pattern.startswith("(?"):
            head, pattern = pattern[2:].split(")", 1)
            flags += head
        quoted = pattern.replace("'", "''")
        made = "chr(10)" if replacement == "\n" else "'" + replacement.replace("'", "''") + "'"
        text = f"regexp_replace({text}, '{quoted}', {made}, '{flags}')"
    return text


def _record_id(kind: str, about: str) -> str:
    md5 = f"md5('{kind}|' || {about})"
    cuts = " || '-' || ".join(f"substr({md5}, {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {cuts} || '>'"


_CRLF = "chr(13) || chr(10)"
WARC = rf"""
WITH source AS (
    SELECT page_id, url, coalesce(html, '') AS html,
           {_record_id('response', "cast(page_id AS varchar) || '|' || url")} AS refers_to,
           'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF} || 'Content-Length: '
               || strlen(coalesce(html, '')) || {_CRLF} || {_CRLF} || coalesce(html, '') AS response
    FROM pages
), digested AS (
    SELECT *, 'sha256:' || sha256(html) AS payload_digest, 'sha256:' || sha256(response) AS source_digest,
           {_record_id('conversion', 'refers_to')} AS conversion_id, {_record_id('metadata', 'refers_to')} AS metadata_id,
           regexp_replace(regexp_extract(html, '<title\b[^>]*>(.*?)</title', 1, 'is'), '\s+', ' ', 'g') AS title,
           regexp_extract_all(html, '<a\b[^>]*?\bhref\s*=\s*["'']([^"''\r\n]*)["'']', 1, 'i') AS links
    FROM source
), made AS (
    SELECT page_id, 'metadata' AS warc_type, metadata_id AS record_id, refers_to, url, payload_digest,
           'application/warc-fields' AS content_type,
           'source-status: HTTP/1.1 200 OK' || {_CRLF} || 'source-content-type: text/html; charset=utf-8' || {_CRLF}
           || 'source-content-length: ' || strlen(html) || {_CRLF} || 'source-block-digest: ' || source_digest || {_CRLF}
           || 'source-payload-digest: ' || payload_digest || {_CRLF} || 'conversion-record: ' || conversion_id || {_CRLF}
           || 'title: ' || title || {_CRLF}
           || array_to_string(list_transform(links, lambda x: 'outlink: ' || x || {_CRLF}), '') AS block
    FROM digested
    UNION ALL
    SELECT page_id, 'conversion', conversion_id, refers_to, url, payload_digest, 'text/plain; charset=utf-8',
           {_plain_text('html')}
    FROM digested
)
SELECT page_id, warc_type, record_id, refers_to, url AS target_uri, '{DATE}' AS warc_date, content_type,
       cast(strlen(block) AS bigint) AS content_length, 'sha256:' || sha256(block) AS block_digest, payload_digest,
       concat_ws({_CRLF}, 'WARC/1.1', 'WARC-Type: ' || warc_type, 'WARC-Record-ID: ' || record_id,
                 'WARC-Refers-To: ' || refers_to, 'WARC-Target-URI: ' || url, 'WARC-Date: {DATE}',
                 'WARC-Source-Payload-Digest: ' || payload_digest, 'WARC-Block-Digest: sha256:' || sha256(block),
                 'Content-Type: ' || content_type, 'Content-Length: ' || strlen(block)) AS headers,
       block
FROM made
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _crc_table() -> list[int]:
    rows = []
    for row in range(256):
        for _ in range(8):
            row = row >> 1 ^ 0xEDB88320 if row & 1 else row >> 1
        rows.append(row)
    return rows


def _crc32(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes, byte by byte."""
    byte = f"cast('0x' || substr(hex(encode({text})), cast(2 * i - 1 AS bigint), 2) AS bigint)"
    step = f"xor(c >> 8, {_crc_table()}[cast((xor(c, b) & 255) + 1 AS bigint)])"
    all_ones = "cast(4294967295 AS bigint)"
    made = f"list_prepend({all_ones}, list_transform(range(1, strlen({text}) + 1), lambda i: {byte}))"
    return f"xor(4294967295, list_reduce({made}, lambda c, b: {step}))"


SPELLING = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS k FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_UPPER.lower()}') AS run
        FROM documents)
    WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
    SELECT run, k, {_crc32("(coalesce(cast(doc_id AS varchar), '') || ':' || run)")} AS h FROM runs
), words AS (
    SELECT word, cast(sum(k) AS bigint) AS n FROM (
        SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), cuts AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN cuts b ON b.rest = a.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
), near AS (
    SELECT word, other, m, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near
    FROM pairs
), forms AS (
    SELECT w.word, other AS form, m FROM words w JOIN near ON near.word = w.word AND place = 1 WHERE m >= 10 * w.n
), chain AS (
    SELECT word, form AS root FROM forms
    UNION SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root
), roots AS (
    SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms)
)
SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, form, f.m AS form_n, coalesce(root, w.word) AS root
FROM words w LEFT JOIN (SELECT word, n_near FROM near WHERE place = 1) x ON x.word = w.word
LEFT JOIN forms f ON f.word = w.word LEFT JOIN roots r ON r.word = w.word
"""


def _repair() -> str:
    """Forward costs with the least edits and the repaired turns of each state, turn by turn."""
    none = "{'c': 1000000000, 'a': '', 'o': ''}"

    def state(cost: str, audit: str, turns: str) -> str:
        return f"{{'c': {cost}, 'a': {audit}, 'o': {turns}}}"

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def insert(of: str, role: str) -> str:
        return state(f"{of}.c + 5", f"{of}.a || 'I'", f"{of}.o || chr(10) || '{role}:'")

    def delete(of: str) -> str:
        return state(f"{of}.c + 2", f"{of}.a || 'D'", f"{of}.o")

    def keep(of: str, initial: str) -> str:
        kept = state(f"{of}.c + r.more", f"{of}.a || 'K'", f"{of}.o || chr(10) || r.role || ':' || r.text")
        return f"CASE WHEN r.forced OR r.initial <> '{initial}' THEN {none} ELSE {kept} END"

    def rerole(of: str, role: str) -> str:
        given = state(f"{of}.c + r.more + 1", f"{of}.a || 'R'", f"{of}.o || chr(10) || '{role}:' || r.text")
        return f"CASE WHEN r.forced THEN {none} ELSE {given} END"

    begun, told, asked, answered = (f"p.s{number}" for number in range(4))
    users = [way for of in (begun, told, answered) for way in (keep(of, "u"), rerole(of, "user"))]
    t1 = best(delete(told), keep(begun, "s"))
    t2 = best(delete(asked), *users)
    t3 = best(delete(answered), keep(asked, "a"), rerole(asked, "assistant"))
    return rf"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ') AS name
    FROM conversations
), faulty AS (
    SELECT *, {_crc32("name")} % 20 AS fault FROM named
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM faulty WHERE fault <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS written
    FROM damaged
), told AS (
    SELECT *, written = '' AS is_blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           substr(role, 1, 1) AS initial,
           lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
), rows AS (
    SELECT conv_id, i, role, text, initial, turn, is_blank, is_blank OR again AS forced, NOT is_blank AND again AS is_again,
           NOT is_blank AND NOT again AND right(written, 1) NOT IN ('.', '!', '?') AS is_open, before,
           CASE WHEN NOT is_blank AND NOT again AND right(written, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS more
    FROM told
), steps AS (
    SELECT conv_id, cast(0 AS bigint) AS i, {state('cast(0 AS bigint)', "''", "''")} AS s0, {none} AS s1,
           {{'c': cast(5 AS bigint), 'a': 'I', 'o': chr(10) || 'user:'}} AS s2,
           {{'c': cast(10 AS bigint), 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3
    FROM (SELECT DISTINCT conv_id FROM rows)
    UNION ALL
    SELECT conv_id, i, s0, s1, {best('t2', insert('t3','user'))} AS s2, t3 AS s3
    FROM (
        SELECT conv_id, i, s0, s1, t2, {best('t3', insert('t2','assistant'))} AS t3
        FROM (
            SELECT conv_id, i, s0, s1, {best('t2', insert('s0','user'), insert('s1','user'), insert('t3','user'))} AS t2, t3
            FROM (SELECT p.conv_id, r.i, {delete(begun)} AS s0, {t1} AS s1, {t2} AS t2, {t3} AS t3
                  FROM steps p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1)))
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate, count(*) FILTER (is_open) AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS last
    FROM rows GROUP BY conv_id
), ended AS (
    SELECT c.*, {best('s0', 's3')} AS best
    FROM counted c JOIN steps s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.last
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


ORACLES: dict[str, str] = {
    "op2_chat_format": CHAT,
    "op3_jaccard_join": JACCARD,
    "op7_source_mix": MIX,
    "op8_exact_dedup": DEDUP,
    "op9_warc_derivatives": WARC,
    "op11_structure_repair": _repair(),
    "op12_spelling_variants": SPELLING,
}
