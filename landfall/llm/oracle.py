"""DuckDB SQL for the queries whose rows SQL can express: quality rules, near-dedup and decontamination.

Each follows its definition, not the operator's way: exact set joins instead of signatures, and a recursive query for
components. The others need hashes, draws, models or a tokenizer that SQL does not have; tests hold them against plain Python.
"""

from __future__ import annotations

from landfall.llm import containment, quality_rules

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x20\x09-\x0D]+"


def _words(text: str, lower: bool) -> str:
    text = f"coalesce({text}, '')"
    return f"regexp_extract_all({f'translate({text}, {chr(39)}{_UPPER}{chr(39)}, {chr(39)}{_UPPER.lower()}{chr(39)})' if lower else text}, '{_WORD}')"


def _shingles(name: str, key: str, table: str, k: int, whole: bool) -> str:
    """CTEs `name`(key, s): distinct shingles; texts of fewer words are one shingle if `whole`."""
    short = f"UNION ALL SELECT {key}, array_to_string(w, ' ') AS s FROM {name}_words WHERE len(w) BETWEEN 1 AND {k - 1}" if whole else ""
    return f"""{name}_words AS (SELECT {key}, {_words('text', True)} AS w FROM {table}),
    {name} AS (SELECT DISTINCT {key}, s FROM (
        SELECT {key}, array_to_string(w[i:i + {k - 1}], ' ') AS s FROM {name}_words, unnest(range(1, len(w) - {k - 2})) AS t(i) WHERE len(w) >= {k} {short}))"""


def decontamination() -> str:
    k, percent = containment.SHINGLE, containment.PERCENT
    return f"""WITH {_shingles('d', 'doc_id', 'documents', k, False)}, {_shingles('q', 'item_id', 'benchmark', k, False)},
    sizes AS (SELECT item_id, count(*) AS n FROM q GROUP BY 1),
    shared AS (SELECT doc_id, item_id, count(*) AS c FROM d JOIN q USING (s) GROUP BY 1, 2)
    SELECT doc_id, item_id, n AS n_item_shingles, c AS n_shared, c / n AS containment FROM shared JOIN sizes USING (item_id) WHERE 100 * c >= {percent} * n"""


def near_duplicates(k: int, percent: int) -> str:
    return f"""WITH RECURSIVE {_shingles('d', 'doc_id', 'documents', k, True)},
    sizes AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM d x JOIN d y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= {percent} * (p.n + q.n - c)),
    reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
    SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1) USING (doc_id)"""


def _integer(expression: str) -> str:
    return expression.replace(" div ", " // ")


def quality() -> str:
    rules = quality_rules.RULES
    bucket = "greatest(length(bin(v)) - 6, 0) * 32 + (v >> greatest(length(bin(v)) - 6, 0))"
    start = "(b - greatest(b // 32 - 1, 0) * 32) << greatest(b // 32 - 1, 0)"
    values = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{name}' AS rule, {_integer(value)} AS v FROM m WHERE n_words > 0" for name, (value, *_) in rules.items())

    def quartiles(name: str, keys: str) -> str:
        group = f"{keys}rule"
        return f"""{name} AS (SELECT {group}, max(total) AS n, {', '.join(f"min(b) FILTER (4 * upto >= {i} * total) AS b{i}" for i in (1, 2, 3))} FROM (
            SELECT *, sum(c) OVER (PARTITION BY {group} ORDER BY b) AS upto, sum(c) OVER (PARTITION BY {group}) AS total FROM (
            SELECT {group}, b, count(*) AS c FROM bucketed GROUP BY ALL)) GROUP BY ALL)"""

    def blended(own: str, wider: str) -> str:
        prior = quality_rules.PRIOR_ROWS
        return ", ".join(f"({own}.n * ({start.replace('b', f'{own}.b{i}')}) + {prior} * {wider}{i}) // ({own}.n + {prior}) AS q{i}" for i in (1, 2, 3))

    def fence(of: str, reach: int, side: str) -> str:
        inner = f"{of}.q2 - {of}.q1" if side == "+" else f"{of}.q3 - {of}.q2"
        return f"{of}.q2 {side} {reach} * greatest({inner}, CASE {of}.rule {spread} END)"

    spread = " ".join(f"WHEN '{name}' THEN {least}" for name, (_, least, *_) in rules.items())
    upper = ", ".join(f"'{name}'" for name, (*_, up, _low) in rules.items() if up)
    lower = ", ".join(f"'{name}'" for name, (*_, low) in rules.items() if low)
    return f"""WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_words('text', False)} AS w FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM t, unnest(range(1, len(w) - 3)) AS g(i) WHERE len(w) >= 5),
    covered AS (SELECT doc_id, count(DISTINCT i + o) AS c FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS times FROM windows), range(5) AS r(o)
        WHERE times > 1 GROUP BY 1),
    lines AS (SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{_WORD}')] AS l FROM t),
    m AS (SELECT t.doc_id, lang, source, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c, 0) AS n_repeat_words,
        len(l) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '!')) AS n_exclaims, len(list_distinct(w)) AS n_distinct
        FROM t JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    measured AS ({values}), bucketed AS (SELECT *, {bucket} AS b FROM measured),
    {quartiles('own', 'lang, source, ')}, {quartiles('per_lang', 'lang, ')}, {quartiles('whole', '')},
    every AS (SELECT rule, {', '.join(f"{start.replace('b', f'whole.b{i}')} AS q{i}" for i in (1, 2, 3))} FROM whole),
    langs AS (SELECT per_lang.lang, rule, {blended('per_lang', 'every.q')} FROM per_lang JOIN every USING (rule)),
    owns AS (SELECT own.lang, own.source, own.rule, {blended('own', 'langs.q')} FROM own JOIN langs ON own.lang IS NOT DISTINCT FROM langs.lang AND own.rule = langs.rule),
    fences AS (SELECT o.lang, o.source, o.rule, greatest(least({fence('o', quality_rules.REACH, '-')}, {fence('l', quality_rules.REACH, '-')}), {fence('l', quality_rules.MOST_REACH, '-')}) AS low,
        least(greatest({fence('o', quality_rules.REACH, '+')}, {fence('l', quality_rules.REACH, '+')}), {fence('l', quality_rules.MOST_REACH, '+')}) AS high
        FROM owns o JOIN langs l ON o.lang IS NOT DISTINCT FROM l.lang AND o.rule = l.rule),
    broken AS (SELECT doc_id, count(*) AS n FROM measured x JOIN fences f ON x.rule = f.rule AND x.lang IS NOT DISTINCT FROM f.lang AND x.source IS NOT DISTINCT FROM f.source
        WHERE (x.rule IN ({upper}) AND v > high) OR (x.rule IN ({lower}) AND v < low) GROUP BY 1),
    judged AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken.doc_id IS NULL AS kept
    FROM judged LEFT JOIN broken USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality(),
        "op7_minhash": near_duplicates(3, 85),
        "op10_decontamination": decontamination(),
    }
