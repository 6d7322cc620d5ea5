"""DuckDB SQL for the queries that SQL can state. The others (trained models, signatures, parsers, tokenizer,
flow) are tested against brute force, exact round trips or held-out accuracy."""

from __future__ import annotations

from . import divergence
from . import license_index as lic
from . import line_rules as rules
from .chat_render import BODY, END, PROBE, TURN


def _class(marks: str) -> str:
    return "[" + "".join("\\" + m if ord(m) < 128 else m for m in marks) + "]"


def line_rules() -> str:
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in rules.BOILERPLATE)
    terminal = rules.TERMINAL.replace("'", "''").replace('\\"', '"').replace("\\''", "''")
    word = r"[^\x20\x09-\x0D]"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '{word}+') AS ws,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS body FROM d),
    win AS (SELECT rid, unnest(range(1, len(ws) - {rules.WINDOW - 2})) AS i, ws FROM w WHERE len(ws) >= {rules.WINDOW}),
    twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i:i + {rules.WINDOW - 1}]) AS n FROM win),
    rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {rules.WINDOW})) AS p FROM twice
            WHERE n > 1) GROUP BY rid),
    l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
    m AS (SELECT rid, line, len(regexp_extract_all(line, '{word}+')) AS n,
                 len(regexp_extract_all(line, '{_class(rules.SEPARATORS)}')) AS sep,
                 len(regexp_extract_all(line, '{_class(rules.NOISE)}')) AS noise FROM l),
    v AS (SELECT rid, n, CASE WHEN n = 0 THEN '' WHEN sep >= 2 AND sep * 5 >= n THEN 'navigation'
                 WHEN n <= 16 AND ({phrases}) THEN 'boilerplate'
                 WHEN noise >= n * 0.4::DOUBLE THEN 'punctuation'
                 WHEN n < 8 AND NOT regexp_matches(line, '{terminal}') THEN 'punctuation' ELSE '' END AS rule FROM m),
    s AS (SELECT rid, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (rule <> '') AS n_removed_lines, sum(n) AS total,
                 coalesce(sum(n) FILTER (rule <> ''), 0) AS n_removed_words,
                 array_to_string(list_sort(list_distinct(coalesce(list(rule) FILTER (rule <> ''), []))), ',') AS failed_rules
          FROM v GROUP BY rid),
    b AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                 len(regexp_extract_all(text, '{_class(rules.SYMBOLS)}')) AS n_symbols,
                 len(body) - len(list_distinct(body)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
                 s.n_lines, s.n_removed_lines, s.n_removed_words, s.failed_rules,
                 s.n_removed_words <= s.total * 0.3::DOUBLE AS line_kept
          FROM w JOIN s USING (rid) LEFT JOIN rep USING (rid)),
    f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND line_kept AS kept, n_lines, n_removed_lines, n_removed_words, failed_rules FROM f"""


def license_scan() -> str:
    """From the definition: every place where a template's key phrase could stand."""
    def words(ws: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in ws) + "]"

    templates = ", ".join(f"({k}, '{t.label}', {words(t.words)}, {t.key_at}, {len(t.key.split())})" for k, t in enumerate(lic.TEMPLATES))
    phrases = ", ".join(f"('{label}', {words(p.split())})" for p, label in lic.BASE)
    return f"""
    WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
                 translate(coalesce(text, ''), '{lic.UPPER}', '{lic.UPPER.lower()}'),
                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
    t AS (SELECT * FROM (VALUES {templates}) v(id, label, tw, key_at, key_n)),
    p AS (SELECT * FROM (VALUES {phrases}) v(label, pw)),
    tp AS (SELECT id, unnest(tw) AS word, generate_subscripts(tw, 1) - 1 AS k FROM t),
    vocabulary AS (SELECT DISTINCT word FROM tp UNION SELECT DISTINCT unnest(pw) FROM p),
    pos AS (SELECT * FROM (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM w)
            WHERE word IN (SELECT word FROM vocabulary)),
    starts AS (SELECT pos.rid, t.id, pos.i - t.key_at AS s FROM t JOIN pos ON pos.word = t.tw[t.key_at + 1]),
    agree AS (SELECT starts.rid, id, s, any_value(label) AS label,
                 count(*) FILTER (s + k >= 0 AND ws[s + k + 1] = word) AS n,
                 count(*) FILTER (s + k >= 0 AND ws[s + k + 1] = word AND k >= key_at AND k < key_at + key_n) AS nk,
                 any_value(key_n) AS key_n, count(*) AS total
              FROM starts JOIN tp USING (id) JOIN t USING (id) JOIN w ON w.rid = starts.rid
              GROUP BY starts.rid, id, s),
    found AS (SELECT rid, label, n / total::DOUBLE AS score FROM agree WHERE nk = key_n AND n / total::DOUBLE >= 0.7::DOUBLE),
    base AS (SELECT pos.rid, label, pos.i FROM p JOIN pos ON pos.word = pw[1] JOIN w ON w.rid = pos.rid
             WHERE ws[i + 1:i + len(pw)] = pw),
    b AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                 array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels FROM base GROUP BY rid),
    a AS (SELECT rid, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels FROM
          (SELECT rid, label FROM base UNION ALL SELECT rid, label FROM found) GROUP BY rid),
    s AS (SELECT rid, max(score) AS score FROM found GROUP BY rid)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
    FROM w LEFT JOIN b USING (rid) LEFT JOIN a USING (rid) LEFT JOIN s USING (rid)"""


def chat_render() -> str:
    marks = len(TURN) + len(BODY) + len(END)

    def escaped(x: str) -> str:
        return f"length({x}) + length(regexp_replace({x}, '[^\\\\<\\[]', '', 'g'))"

    return f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
    g AS (SELECT conv_id, count(*) AS n_turns,
                 string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                 coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
                 sum({marks} + {escaped('role')} + {escaped('text')}) AS formatted_chars FROM c GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           formatted_chars, TRUE AS append_only FROM g"""


def source_divergence() -> str:
    """Every kept term for every pair of sources, term by term."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, translate(coalesce(text, ''), '{upper}', '{lower}') AS text,
                      coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
    w AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {divergence.MIN_DOCS}),
    v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
    t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
    p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                 1 + {divergence.UNIT}::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(t.total, 0) + v.v) AS p
          FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
    q AS (SELECT lang, term, 1 + {divergence.UNIT}::HUGEINT * (n + 1) // (total + v) AS q FROM k JOIN v USING (lang)),
    f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
          UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term)
          WHERE n > 0 AND p > q)
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM r
    QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}"""
