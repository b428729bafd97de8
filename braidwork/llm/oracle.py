"""DuckDB SQL for the queries that SQL can express."""

from braidwork.llm.licenses import PHRASES, TEMPLATES, need, run_words, template_table
from braidwork.llm.quality import STOP_FORMS

_STOPS = ", ".join(f"'{w}'" for w in STOP_FORMS)

_TEMPLATE_ROWS = ", ".join(
    f"({k}, '{label}', {tokens}, {need(len(tokens), 0.8)}, {run_words(TEMPLATES[k][1])})" for k, label, tokens in template_table(TEMPLATES)
)
_PHRASE_ROWS = ", ".join(f"({phrase.split()}, '{label}')" for phrase, label in PHRASES)
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({_LOWER.format(text)}, '{_NOT_WORD}'), lambda x: x <> '')"


_NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    return f"list_filter(string_split_regex({_LOWER.format(text)}, '{_NOT_TERM}'), lambda x: x <> '')"


def _best(*ways: str) -> str:
    """The least of structs (cost, audit, text) that aren't null."""
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"


def _way(state: str, cost: str, letter: str, row: str, where: str = "TRUE") -> str:
    """A state with a letter more; ``row`` is what it adds to the repaired text."""
    return f"CASE WHEN {state} IS NOT NULL AND {where} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {row}}} END"


def _insert(state: str, *roles: str) -> str:
    return _way(state, str(2 * len(roles)), "I" * len(roles), " || ".join(f"chr(10) || '{r}:'" for r in roles))


# States 0 to 3: nothing, a system row, a user's, an assistant's.
_INSERTED = (
    f"s0 AS p0, s1 AS p1, {_best('s2', *[_insert(s, 'user') for s in ('s0', 's1', 's3')])} AS p2, "
    f"{_best('s3', _insert('s2', 'assistant'), *[_insert(s, 'user', 'assistant') for s in ('s0', 's1')])} AS p3"
)


def _taken(state: int) -> str:
    """What a row makes of the states before it."""
    role, froms = {0: ("", ()), 1: ("", (0,)), 2: ("user", (0, 1, 3)), 3: ("assistant", (2,))}[state]
    ways = [_way(f"p{state}", "3", "D", "''")]
    for p in froms:
        ways.append(_way(f"p{p}", "late", "K", "chr(10) || role || ':' || text", f"NOT gone AND initial = '{' sua'[state]}'"))
        if role:
            ways.append(_way(f"p{p}", "2 + late", "R", f"chr(10) || '{role}:' || text", "NOT gone"))
    return _best(*ways)


_STATE = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
_FATE = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
 lambda x: [ord(x)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))), lambda c, x: CASE WHEN x < 256 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT) % 20"""


SQL = {
    "op3_quality_rules": rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
p AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT r, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1),
n AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS j FROM c, (VALUES (0), (1), (2)) v(k)) GROUP BY r),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
             coalesce(n.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda x: list_contains([{_STOPS}], x))) AS n_stop,
             len(list_filter(ws, lambda x: ends_with(x, '!'))) AS n_shout
      FROM w LEFT JOIN n USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.1
       AND n_shout / n_words <= 0.3 AND n_stop / n_words >= 0.02
       AND CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END <= 0.5
       AND n_repeat_words / n_words <= 0.5 AS kept
FROM m""",
    "op9_licenses": f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, {_words('text')} AS ws FROM t),
ph(p, label) AS (VALUES {_PHRASE_ROWS}),
hit AS (SELECT r, label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i + 1 : i + len(p)] = p)) AS place
        FROM w, ph WHERE contains(' ' || array_to_string(ws, ' ') || ' ', ' ' || array_to_string(p, ' ') || ' ')),
base AS (SELECT r, count(*) AS n, min(place) AS a, max(place) AS b, list(DISTINCT label) AS ls FROM hit GROUP BY r),
line AS (SELECT r, block, {_words('line')} AS ws
         FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS block FROM t)),
te(k, label, ts, need, size) AS (VALUES {_TEMPLATE_ROWS}),
h AS (SELECT r, block, label, ts, need, list_max(list_transform(range(0, len(ws)), lambda i: len(list_intersect(list_distinct(ws[i + 1 : i + size]), ts)))) AS shared
      FROM line, te WHERE len(ws) >= need AND len(list_intersect(list_distinct(ws), ts)) >= need),
m AS (SELECT r, block, label, shared / len(ts) AS c FROM h WHERE shared >= need),
best AS (SELECT r, list(DISTINCT label) AS ls, max(c) AS c, count(DISTINCT block) AS n FROM m GROUP BY r)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.a::BIGINT AS first_word, base.b::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base.ls), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(best.ls, [])))), ','), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.c, 0.0)::DOUBLE END AS score, coalesce(best.n, 0)::BIGINT AS n_blocks
FROM w LEFT JOIN base USING (r) LEFT JOIN best USING (r)""",
    "op11_ranking": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("coalesce(text, '')")} AS ts FROM documents),
total AS (SELECT count(*) FILTER (len(ts) > 0) AS n, sum(len(ts))::BIGINT AS l FROM d),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t),
m AS (SELECT r, doc_id, 10 + (90 * len(ts) * n) // l AS m FROM d, total WHERE len(ts) > 0),
item AS (SELECT q, item_id, unnest(ts) AS t FROM (SELECT row_number() OVER () AS q, item_id, list_distinct({_terms("coalesce(text, '')")}) AS ts FROM benchmark)),
s AS (SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM item JOIN w USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY q, item_id, r, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""",
    "op13_conversations": f"""
WITH RECURSIVE fates AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_FATE} AS fate FROM conversations),
rows AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS k FROM fates),
conv AS (SELECT conv_id, row_number() OVER () AS q FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (SELECT q, turn, role, text, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid,
                  row_number() OVER (PARTITION BY q, role, text ORDER BY turn NULLS FIRST, k) AS nth, row_number() OVER (PARTITION BY q ORDER BY turn NULLS FIRST, role, text, k) AS i
           FROM rows JOIN conv ON rows.conv_id IS NOT DISTINCT FROM conv.conv_id),
judged AS (SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  lag(initial) OVER (PARTITION BY q ORDER BY i) AS before FROM placed),
word AS (SELECT q, i, role, text, initial, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS late FROM judged),
step AS (SELECT q, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}}::{_STATE} AS s0, NULL::{_STATE} AS s1, NULL::{_STATE} AS s2, NULL::{_STATE} AS s3 FROM conv
         UNION ALL
         SELECT q, i, {_taken(0)}, {_taken(1)}, {_taken(2)}, {_taken(3)}
         FROM (SELECT q, word.i, role, text, initial, gone, late, {_INSERTED} FROM step JOIN word USING (q) WHERE word.i = step.i + 1)),
ends AS (SELECT q, {_best('p0', 'p3')} AS e FROM (SELECT q, {_INSERTED} FROM step QUALIFY i = max(i) OVER (PARTITION BY q))),
n AS (SELECT q, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY q)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       e.c AS cost, e.a AS audit, sha256(substr(e.t, 2)) AS repaired_sha256
FROM conv JOIN ends USING (q) LEFT JOIN n USING (q)""",
}
