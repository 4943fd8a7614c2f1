"""SQL (DuckDB dialect) giving the expected result of each query from the same tables.

Written apart from the Spark expressions: the entity pattern below is the plain four-group form,
and splits, folds and scores are stated with ranks and windows over everything.
"""

from __future__ import annotations

from wordmill.catalog.queries import LEXICON
from wordmill.functions.constants import FAKE_TYPES, MONTHS, STOPWORDS
from wordmill.functions.stemming import KEPT_AFTER_PLURAL, SPECIAL, STEP_2, STEP_3, STEP_4

# The pattern of the entities.
_MONTH = "(?:" + "|".join(MONTHS) + ")[a-z]*"
_URL_CHAR = r"""[^\s)\]}''<>"]"""
_PATTERN = (
    r"(?i)(\b\d{4}-\d{2}-\d{2}\b|\b\d{2}/\d{2}/\d{4}\b|\b\d{2}\.\d{2}\.\d{4}\b"
    rf"|\b{_MONTH}\s\d{{1,2}},?\s\d{{4}}\b|\b\d{{1,2}}\s{_MONTH}\b"
    rf"|\b\d{{1,2}}(?:st|nd|rd|th)?\s(?:of\s)?{_MONTH}\b)"
    r"|(\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\b)"
    rf"|(https?://{_URL_CHAR}+|www\.{_URL_CHAR}+|\b[a-z0-9-]+\.[a-z]{{2,}}(?:/{_URL_CHAR}*)*)"
    r"|(\b\d+\b)"
)
_M = ["\x01", "\x02", "\x03", "\x04", "\x05"]
_MARKED = rf"{_M[0]}\1{_M[1]}\2{_M[2]}\3{_M[3]}\4{_M[4]}"
_KINDS = ["dates", "emails", "urls", "numbers"]
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def _marked(text: str) -> str:
    # Control characters 1 to 5 are neither word characters nor blanks; 14 to 18 are like them.
    plain = f"translate(lower(coalesce({text}, '')), '{''.join(_M)}', chr(14)||chr(15)||chr(16)||chr(17)||chr(18))"
    return f"regexp_replace({plain}, '{_PATTERN}', '{_MARKED}', 'g')"


def _found(marked: str, kind: str) -> str:
    gap = _KINDS.index(kind)
    inner = f"{_M[gap]}([^{_M[0]}-{_M[4]}]+){_M[gap + 1]}"
    return f"regexp_extract_all({marked}, '{inner}', 1)"


def _cleaned(marked: str) -> str:
    out = marked
    for i, name in enumerate(["DATE", "EMAIL", "URL", "NUMBER"]):
        before, after = "".join(_M[: i + 1]), "".join(_M[i + 1 :])
        out = f"regexp_replace({out}, '{before}[^{_M[0]}-{_M[4]}]+{after}', ' <{name}> ', 'g')"
    letters = f"regexp_replace({out}, '[^a-zA-Z <>]', ' ', 'g')"
    return f"trim(regexp_replace({letters}, '\\s+', ' ', 'g'))"


def _tokens(cleaned: str) -> str:
    return f"list_filter(string_split({cleaned}, ' '), lambda t: t <> '')"


def _kept(cleaned: str) -> str:
    return f"list_filter({_tokens(cleaned)}, lambda t: t NOT IN ({_STOP}))"


def _clean_of(text: str) -> str:
    return _cleaned(_marked(text))


def _tokens_cte(source: str, columns: str, text: str, name: str = "docs") -> str:
    """CTEs ending in ``docs``: the columns and the kept tokens of each row."""
    return (
        f"{name}_m AS MATERIALIZED (SELECT {columns}, {_clean_of(text)} AS c FROM {source}), "
        f"{name} AS MATERIALIZED (SELECT * EXCLUDE (c), {_kept('c')} AS tokens FROM {name}_m)"
    )


_DOCS = _tokens_cte("documents", "doc_id", "text")
_NEWS = (
    "news AS (SELECT d.doc_id AS id, CASE WHEN l.quality = 1 THEN 'reliable' ELSE 'fake' END AS type, "
    "d.text AS content, d.lang, d.source, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id))"
)
_NEWS_DOCS = (
    f"WITH {_NEWS}, "
    + _tokens_cte(
        "news", "id, type, lang, toxic, CASE WHEN type = 'reliable' THEN 1 ELSE 0 END AS label", "content"
    )
)
_MIXED = (
    "CASE lang WHEN 'de' THEN upper(type[1]) || type[2:] WHEN 'fr' THEN upper(type) "
    "WHEN 'es' THEN NULL ELSE type END"
)
_FAKE = ", ".join(f"'{t}'" for t in FAKE_TYPES)


def _format(entities: str) -> str:
    number = "try_cast(trim(p) AS DOUBLE)"
    numeric = "regexp_full_match(trim(p), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?')"
    part = (
        f"CASE WHEN regexp_full_match(trim(p), '[+-]?nan') THEN 'NaN' "
        f"WHEN regexp_full_match(trim(p), '[+-]?inf(inity)?') "
        f"THEN CASE WHEN trim(p)[1] = '-' THEN '-inf' ELSE 'inf' END "
        f"WHEN NOT {numeric} THEN p "
        f"WHEN isinf({number}) THEN 'inf' "
        f"WHEN {number} = floor({number}) THEN format('{{:.0f}}', {number}) "
        f"ELSE CAST({number} AS VARCHAR) END"
    )
    parts = f"string_split(array_to_string({entities}, '; '), ';')"
    return f"array_to_string(list_transform({parts}, lambda p: {part}), '; ')"


def _formatted(marked: str) -> str:
    return ", ".join(f"coalesce({_format(_found(marked, k))}, '') AS {k}" for k in _KINDS)


def _joined(marked: str, kind: str) -> str:
    return f"coalesce(array_to_string({_found(marked, kind)}, '|'), '') AS {kind}"


_ORDER_TEXT = (
    "'Order ' || o_orderkey || ' of ' || strftime(o_orderdate, '%Y-%m-%d') || ', shipped ' || "
    "strftime(o_orderdate, '%d/%m/%Y') || '; paid ' || strftime(o_orderdate, '%d.%m.%Y') || '. Due ' || "
    "strftime(o_orderdate, '%B %-d, %Y') || ' or ' || strftime(o_orderdate, '%-d %b') || ', on the ' || "
    "strftime(o_orderdate, '%-d') || 'th of ' || strftime(o_orderdate, '%B') || "
    "' at www.shop.example/' || strftime(o_orderdate, '%Y-%m-%d') || '/a;7 for 12.50'"
)
_TOKEN_ROWS = "tok AS (SELECT doc_id, unnest(tokens) AS token FROM docs)"
_DF_BOUNDS = (
    "dfs AS (SELECT token, count(DISTINCT doc_id) AS df FROM tok GROUP BY token), "
    "kept AS (SELECT * FROM dfs WHERE df >= 5 AND df <= 0.95 * (SELECT count(*) FROM docs))"
)


def _tfidf_ctes(docs: str, key: str, suffix: str = "") -> str:
    """``voc`` from ``docs`` and its weights ``w`` (key, token, weight)."""
    return (
        f"tf{suffix} AS (SELECT {key}, token, count(*) AS tf FROM (SELECT {key}, unnest(tokens) AS token FROM {docs}) "
        f"GROUP BY ALL), "
        f"voc{suffix} AS (SELECT token, ln((1.0 + (SELECT count(*) FROM {docs})) / (1.0 + count(*))) + 1 AS idf "
        f"FROM tf{suffix} GROUP BY token ORDER BY sum(tf) DESC, token LIMIT 50000), "
        + _weights(f"tf{suffix}", f"voc{suffix}", key, f"w{suffix}")
    )


def _weights(tf: str, voc: str, key: str, out: str) -> str:
    return (
        f"{out} AS (SELECT {key}, token, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY {key})) "
        f"AS weight FROM {tf} JOIN {voc} USING (token))"
    )


def _cnb_ctes(train: str, score: str) -> str:
    """``pred`` (id, label, prediction) for ``score`` by a model fitted on ``train``."""
    return (
        _tfidf_ctes(train, "id")
        + ", n AS (SELECT v.token, c.k, coalesce(sum(w.weight) FILTER (t.label <> c.k), 0) + 1 AS s "
        f"FROM voc v CROSS JOIN (VALUES (0), (1)) c(k) LEFT JOIN w ON w.token = v.token "
        f"LEFT JOIN {train} t ON t.id = w.id GROUP BY ALL), "
        "theta AS (SELECT token, k, -ln(s / sum(s) OVER (PARTITION BY k)) AS v FROM n), "
        f"stf AS (SELECT id, token, count(*) AS tf FROM (SELECT id, unnest(tokens) AS token FROM {score}) GROUP BY ALL), "
        + _weights("stf", "voc", "id", "sw")
        + ", scores AS (SELECT id, k, sum(weight * v) AS s FROM sw JOIN theta USING (token) GROUP BY ALL), "
        "best AS (SELECT id, k, row_number() OVER (PARTITION BY id ORDER BY s DESC, k) AS r FROM scores), "
        f"pred AS (SELECT d.id, d.label, coalesce(b.k, 0) AS prediction FROM {score} d "
        "LEFT JOIN best b ON b.id = d.id AND b.r = 1)"
    )


_PRED = f"{_NEWS_DOCS}, {_cnb_ctes('docs', 'docs')}"
_CLASS_SCORES = (
    "cls AS (SELECT DISTINCT unnest([label, prediction]) AS class FROM pred), "
    "cnt AS (SELECT class, count(*) FILTER (label = class) AS support, "
    "count(*) FILTER (prediction = class) AS predicted, "
    "count(*) FILTER (label = class AND prediction = class) AS hit FROM cls CROSS JOIN pred GROUP BY class), "
    "pr AS (SELECT class, support, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p, "
    "CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r FROM cnt), "
    "sc AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM pr)"
)
_LEXICON = ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in LEXICON)
_TWO = (
    "l AS (SELECT doc_id AS id, lang, text AS content, NULL::VARCHAR AS type FROM documents), "
    "r AS (SELECT NULL::BIGINT AS id, NULL::VARCHAR AS lang, text AS content, 'reliable' AS type FROM benchmark), "
    "b AS (SELECT * FROM l UNION ALL SELECT * FROM r)"
)
_TURNS = (
    "turns AS (SELECT conv_id AS id, turn, CASE role WHEN 'user' THEN 'reliable' WHEN 'assistant' THEN 'rumor' "
    "ELSE 'bias' END AS type FROM conversations)"
)
_SPLIT_PARTS = (
    "parts AS (SELECT doc_id AS id, text AS content, 'train' AS split FROM documents "
    "UNION ALL SELECT page_id, html, 'val' FROM pages UNION ALL SELECT item_id, text, 'test' FROM benchmark)"
)



def _stem_ctes(words: str) -> str:
    """CTEs ending in ``stems (token, stem)`` for a relation ``words (token)`` of distinct tokens.

    One CTE per step of the rules; ``p1`` and ``p2`` are the lengths in front of regions 1 and 2.
    """
    vowel, region = "[aeiouy]", "^.*?[aeiouy][^aeiouy]"
    short = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"

    def cut(value: str, n: int) -> str:
        return f"left({value}, greatest(length({value}) - {n}, 0))"

    def ending(suffixes) -> str:
        return "(" + "|".join(sorted(suffixes, key=len, reverse=True)) + ")$"

    def step(name: str, source: str, suffixes, word: str) -> str:
        found = f"regexp_extract(w, '{ending(suffixes)}')"
        return (
            f"{name} AS (SELECT token, p1, p2, done, CASE WHEN done OR f = '' THEN w ELSE {word} END AS w FROM "
            f"(SELECT *, left(w, length(w) - length(f)) AS b FROM (SELECT *, {found} AS f FROM {source})))"
        )

    def exchange(table: dict) -> str:
        return "CASE f " + " ".join(f"WHEN '{k}' THEN b || '{v}'" for k, v in table.items()) + " END"

    special = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPECIAL.items())
    kept = ", ".join(f"'{k}'" for k in sorted(KEPT_AFTER_PLURAL))
    past = (
        "CASE WHEN f IN ('eed', 'eedly') THEN CASE WHEN length(b) >= p1 THEN b || 'ee' ELSE w END "
        f"WHEN NOT regexp_matches(b, '{vowel}') THEN w WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e' "
        f"WHEN regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN {cut('b', 1)} "
        f"WHEN length(b) = p1 AND regexp_matches(b, '{short}') THEN b || 'e' ELSE b END"
    )
    plural = (
        f"CASE f WHEN 'sses' THEN {cut('w', 2)} WHEN 'us' THEN w WHEN 'ss' THEN w "
        f"WHEN 's' THEN CASE WHEN regexp_matches({cut('w', 2)}, '{vowel}') THEN {cut('w', 1)} ELSE w END "
        f"ELSE CASE WHEN length(w) > 4 THEN {cut('w', 2)} ELSE {cut('w', 1)} END END"
    )
    second = (
        "CASE WHEN length(b) < p1 OR (f = 'ogi' AND NOT regexp_matches(b, 'l$')) "
        f"OR (f = 'li' AND NOT regexp_matches(b, '[cdeghkmnrt]$')) THEN w ELSE {exchange(STEP_2)} END"
    )
    third = f"CASE WHEN length(b) < CASE f WHEN 'ative' THEN p2 ELSE p1 END THEN w ELSE {exchange(STEP_3)} END"
    fourth = "CASE WHEN length(b) < p2 OR (f = 'ion' AND NOT regexp_matches(b, '[st]$')) THEN w ELSE b END"
    fifth = (
        "CASE WHEN f = 'l' THEN CASE WHEN length(b) >= p2 AND regexp_matches(b, 'l$') THEN b ELSE w END "
        f"WHEN length(b) >= p2 OR (length(b) >= p1 AND NOT regexp_matches(b, '{short}')) THEN b ELSE w END"
    )
    return (
        f"s0 AS (SELECT token, regexp_replace(CASE WHEN token[1] = 'y' THEN 'Y' || token[2:] ELSE token END, "
        f"'([aeiouy])y', '\\1Y', 'g') AS w, length(token) < 3 OR token IN ({', '.join(repr(k) for k in SPECIAL)}) AS done FROM {words}), "
        f"s1 AS (SELECT *, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)')) "
        f"WHEN regexp_matches(w, '{region}') THEN length(regexp_extract(w, '{region}')) ELSE length(w) END AS p1 FROM s0), "
        f"s2 AS (SELECT *, CASE WHEN regexp_matches(w[p1 + 1:], '{region}') THEN p1 + length(regexp_extract(w[p1 + 1:], '{region}')) "
        f"ELSE length(w) END AS p2 FROM s1), "
        + step("s3", "s2", ["sses", "ied", "ies", "us", "ss", "s"], plural)
        + f", s4 AS (SELECT token, p1, p2, done OR w IN ({kept}) AS done, w FROM s3), "
        + step("s5", "s4", ["eed", "eedly", "ed", "edly", "ing", "ingly"], past)
        + ", s6 AS (SELECT token, p1, p2, done, CASE WHEN NOT done AND regexp_matches(w, '.[^aeiouy][yY]$') "
        + f"THEN {cut('w', 1)} || 'i' ELSE w END AS w FROM s5), "
        + step("s7", "s6", STEP_2, second) + ", " + step("s8", "s7", STEP_3, third) + ", "
        + step("s9", "s8", STEP_4, fourth) + ", " + step("s10", "s9", ["e", "l"], fifth)
        + f", stems AS MATERIALIZED (SELECT token, CASE token {special} ELSE replace(w, 'Y', 'y') END AS stem FROM s10)"
    )


def _stemmed(source: str, key: str) -> str:
    """CTEs ending in ``stemmed (key, stems)`` for the rows of ``source``, which has ``tokens``."""
    return (
        f"pos AS MATERIALIZED (SELECT {key}, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM {source}), "
        "words AS (SELECT DISTINCT token FROM pos), "
        + _stem_ctes("words")
        + f", stemmed AS (SELECT {key}, string_agg(stem, ' ' ORDER BY i) AS stems FROM pos JOIN stems USING (token) GROUP BY {key})"
    )


_STEM_DOCS = f"{_NEWS_DOCS}, {_stemmed('docs', 'id')}"
_ENGLISH = "coalesce(lang = 'en', FALSE)"


def _stem_bounds(rows: str) -> str:
    """``kept``: stems within the bounds of document frequency, over the documents that ``rows`` holds for."""
    return (
        "dfs AS (SELECT stem, count(DISTINCT id) AS df FROM pos JOIN stems USING (token) "
        f"WHERE id IN (SELECT id FROM docs WHERE {rows}) GROUP BY stem), "
        f"kept AS (SELECT * FROM dfs WHERE df >= 5 AND df <= 0.95 * (SELECT count(*) FROM docs WHERE {rows}))"
    )


# Documents of the first splits of the seeded order, up to a share of all of them.
_ORDERED = "ranked AS (SELECT id, row_number() OVER (ORDER BY md5(id || ':42'), id) AS r, count(*) OVER () AS n FROM docs)"
_TRAIN = "id IN (SELECT id FROM ranked WHERE r <= n * 8 // 10)"
_TRAIN_VAL = "id IN (SELECT id FROM ranked WHERE r <= n * 8 // 10 + n // 10)"


def _label_weights(rows: str) -> str:
    one = lambda label, name: (
        f"(SELECT round(count(*) / (count(DISTINCT label) * count(*) FILTER (label = {label}))::DOUBLE, 9) "
        f"FROM docs WHERE {rows}) AS {name}"
    )
    return one(0, "weight_fake") + ", " + one(1, "weight_reliable")


ORACLE: dict[str, str] = {
    "clean_text": f"SELECT doc_id, {_clean_of('text')} AS cleaned FROM documents",
    "extract_dates": f"SELECT o_orderkey, {_joined('m', 'dates')} FROM (SELECT o_orderkey, {_marked(_ORDER_TEXT)} AS m FROM orders)",
    "extract_emails": f"SELECT doc_id, {_joined('m', 'emails')} FROM (SELECT doc_id, {_marked('text')} AS m FROM documents)",
    "extract_urls": f"SELECT page_id, {_joined('m', 'urls')} FROM (SELECT page_id, {_marked('html')} AS m FROM pages)",
    "extract_numbers": f"SELECT doc_id, {_joined('m', 'numbers')} FROM (SELECT doc_id, {_marked('text')} AS m FROM documents)",
    "format_entities": (
        f"SELECT page_id, {_formatted('m')} FROM (SELECT page_id, "
        + _marked("url || ' ' || html")
        + " AS m FROM pages)"
    ),
    "tokens_no_stop": f"WITH {_DOCS} SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM docs",
    "drop_empty_docs": (
        f"WITH {_tokens_cte('conversations', 'conv_id, turn', 'text')} "
        "SELECT conv_id, turn, len(tokens)::INT AS n_tokens FROM docs WHERE len(tokens) > 0"
    ),
    "stem_tokens": (
        f"WITH {_DOCS}, {_stemmed('docs', 'doc_id')} SELECT doc_id, coalesce(stems, '') AS stems "
        "FROM docs LEFT JOIN stemmed USING (doc_id)"
    ),
    "top_words_stemmed": (
        f"WITH {_DOCS}, {_stemmed('docs', 'doc_id')} SELECT stem AS token, count(*) AS n "
        "FROM pos JOIN stems USING (token) GROUP BY stem ORDER BY n DESC, stem LIMIT 10000"
    ),
    "prepare_corpus": (
        f"WITH {_NEWS}, m AS MATERIALIZED (SELECT id, type, lang, {_marked('content')} AS m FROM news), "
        f"docs AS MATERIALIZED (SELECT id, type, lang, m, {_kept(_cleaned('m'))} AS tokens FROM m), {_stemmed('docs', 'id')} "
        f"SELECT id, type, lang, type AS label, {_formatted('m')}, stems FROM docs JOIN stemmed USING (id)"
    ),
    "split_tokens": (
        f"SELECT doc_id, len(string_split(c, ' '))::INT AS n_blank, "
        "len(list_filter(regexp_split_to_array(c, '\\s+'), lambda t: t <> ''))::INT AS n_whitespace, "
        "coalesce(array_to_string(regexp_extract_all(lower(c), '\\b\\w\\w+\\b'), ' '), '') AS words "
        f"FROM (SELECT doc_id, {_clean_of('text')} AS c FROM documents)"
    ),
    "label_binary": f"WITH {_NEWS} SELECT id, CASE WHEN lower({_MIXED}) = 'reliable' THEN 'reliable' ELSE 'fake' END AS label FROM news",
    "label_numeric": (
        f"WITH {_NEWS}, t AS (SELECT id, {_MIXED} AS type FROM news) SELECT id, "
        "CASE WHEN type = 'reliable' THEN 1 ELSE 0 END AS exact, "
        "CASE WHEN lower(type) = 'reliable' THEN 1 ELSE 0 END AS any_case FROM t"
    ),
    "keep_typed": (
        f"WITH {_NEWS}, t AS (SELECT id, {_MIXED} AS type FROM news) SELECT id, type, "
        "CASE WHEN lower(type) = 'reliable' THEN 1 ELSE 0 END AS label FROM t WHERE type IS NOT NULL"
    ),
    "label_statement": (
        "SELECT doc_id, CASE WHEN toxic = 0 THEN 1 ELSE 0 END AS label, "
        "CASE WHEN toxic = 0 THEN 1 ELSE 0 END AS label_of_boolean FROM labels"
    ),
    "label_group": (
        f"WITH t AS (SELECT doc_id, coalesce(['reliable', {_FAKE}][CAST(source[4:] AS INT) + 1], 'rumor') AS type "
        "FROM documents) SELECT doc_id, type, CASE type WHEN 'reliable' THEN 'reliable' ELSE 'fake' END AS grp "
        "FROM t WHERE type <> 'rumor'"
    ),
    "group_semi_join": (
        f"WITH {_TURNS} SELECT *, 'reliable' AS grp FROM turns WHERE id IN (SELECT id FROM turns WHERE type = 'reliable') "
        f"UNION ALL SELECT *, 'fake' AS grp FROM turns WHERE id IN (SELECT id FROM turns WHERE type IN ({_FAKE}))"
    ),
    "constant_label": "SELECT item_id, 'reliable' AS label, 'reliable' AS type FROM benchmark",
    "union_by_name": f"WITH {_TWO} SELECT id, lang, content, type FROM b",
    "union_left_columns": f"WITH {_TWO} SELECT id, lang, content FROM b",
    "union_three": f"WITH {_NEWS} SELECT id, type, lang FROM news",
    "predefined_split": (
        f"WITH {_SPLIT_PARTS}, {_tokens_cte('parts', 'id, split', 'content')} "
        "SELECT id, split, len(tokens)::INT AS n_tokens FROM docs WHERE len(tokens) > 0"
    ),
    "null_counts": (
        f"WITH {_TWO} SELECT 'left' AS frame, count(*) - count(lang) AS n_missing FROM l "
        "UNION ALL SELECT 'right', count(*) - count(lang) FROM r "
        "UNION ALL SELECT 'both', count(*) - count(lang) FROM b"
    ),
    "conditional_count": f"WITH {_NEWS} SELECT count(*) FILTER (type = 'reliable') AS n FROM news",
    "frame_report": f"WITH {_TWO} SELECT count(*) AS n_rows, 'id,lang,content,type' AS columns FROM b",
    "label_counts": f"WITH {_NEWS} SELECT type, count(*) AS n FROM news GROUP BY type",
    "top_words": f"WITH {_DOCS}, {_TOKEN_ROWS} SELECT token, count(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token LIMIT 10000",
    "top_words_head": f"WITH {_DOCS}, {_TOKEN_ROWS} SELECT token, count(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token LIMIT 20",
    "word_frequency_of_text": (
        "WITH w AS (SELECT unnest(regexp_split_to_array(text, '[\\s\\x1c-\\x1f\\x85\\x{a0}\\x{2028}\\x{2029}]+')) AS token FROM conversations) "
        "SELECT token, count(*) AS n FROM w WHERE token <> '' GROUP BY token"
    ),
    "recurring_words": f"WITH {_DOCS}, {_TOKEN_ROWS} SELECT token, count(*) AS n FROM tok GROUP BY token HAVING n > 1",
    "char_frequency": (
        "WITH c AS (SELECT unnest(string_split(text, '')) AS token FROM documents) "
        "SELECT token, count(*) AS n FROM c WHERE token <> '' GROUP BY token"
    ),
    "doc_term_counts": f"WITH {_DOCS}, {_TOKEN_ROWS} SELECT doc_id, token, count(*) AS tf FROM tok GROUP BY ALL",
    "merged_counts": f"WITH {_DOCS}, {_TOKEN_ROWS} SELECT token, count(*) AS n FROM tok GROUP BY token",
    "distinct_words": f"WITH {_DOCS}, {_TOKEN_ROWS} SELECT count(DISTINCT token) AS n_distinct FROM tok",
    "doc_frequency_bounds": f"WITH {_DOCS}, {_TOKEN_ROWS}, {_DF_BOUNDS} SELECT token, df FROM kept",
    "class_weights": (
        f"WITH {_NEWS}, c AS (SELECT type, count(*) AS n FROM news GROUP BY type) SELECT type, n, "
        "round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 9) AS weight FROM c"
    ),
    "shuffled_order": (
        "SELECT doc_id, md5(doc_id || ':42') AS ordering, "
        "row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) AS rank FROM documents"
    ),
    "exact_split": (
        "WITH r AS (SELECT doc_id, lang, source, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) AS r, "
        "count(*) OVER () AS n FROM documents) SELECT doc_id, lang, source, "
        "CASE WHEN r <= n * 8 // 10 THEN 'train' WHEN r <= n * 8 // 10 + n // 10 THEN 'val' ELSE 'test' END AS split FROM r"
    ),
    "stratified_folds": (
        f"WITH {_NEWS} SELECT id, type, (ntile(5) OVER (PARTITION BY type ORDER BY md5(id || ':42'), id) - 1)::INT AS fold FROM news"
    ),
    "bow_binary": (
        f"WITH {_DOCS}, {_TOKEN_ROWS}, {_DF_BOUNDS}, v AS (SELECT token FROM kept ORDER BY df DESC, token LIMIT 10000) "
        "SELECT DISTINCT doc_id, token, 1::BIGINT AS tf FROM tok JOIN v USING (token)"
    ),
    "bow_binary_vectors": (
        f"WITH {_DOCS}, {_TOKEN_ROWS}, {_DF_BOUNDS}, v AS (SELECT token FROM kept ORDER BY df DESC, token LIMIT 10000), "
        "h AS (SELECT doc_id, count(DISTINCT token) AS k FROM tok JOIN v USING (token) GROUP BY doc_id) "
        "SELECT doc_id, coalesce(k, 0)::INT AS n_terms FROM docs LEFT JOIN h USING (doc_id)"
    ),
    "bow_fixed_vocab": (
        f"WITH {_DOCS}, {_TOKEN_ROWS}, v AS (SELECT token FROM tok GROUP BY token ORDER BY count(*) DESC, token LIMIT 10000), "
        "x AS (SELECT doc_id, unnest(regexp_extract_all(lower(array_to_string(tokens, ' ')), '\\b\\w\\w+\\b')) AS token FROM docs) "
        "SELECT doc_id, token, count(*) AS tf FROM x JOIN v USING (token) GROUP BY ALL"
    ),
    "tfidf": f"{_NEWS_DOCS}, {_tfidf_ctes('docs', 'id')} SELECT id, token, round(weight, 6) AS weight FROM w",
    "transform_other_corpus": (
        f"{_NEWS_DOCS}, {_tfidf_ctes('docs', 'id')}, {_tokens_cte('conversations', 'conv_id, turn', 'text', 'o')}, "
        "otf AS (SELECT conv_id, turn, token, count(*) AS tf FROM (SELECT conv_id, turn, unnest(tokens) AS token FROM o) GROUP BY ALL), "
        + _weights("otf", "voc", "conv_id, turn", "ow")
        + " SELECT conv_id, turn, token, round(weight, 6) AS weight FROM ow"
    ),
    "lexicon_sentiment": (
        f"WITH lex(token, valence) AS (VALUES {_LEXICON}), "
        f"d AS MATERIALIZED (SELECT doc_id, {_clean_of('text')} AS c FROM documents), "
        f"t AS (SELECT doc_id, unnest({_tokens('c')}) AS token FROM d), "
        "a AS (SELECT doc_id, sum(coalesce(valence, 0)) AS s, sum(CASE WHEN valence > 0 THEN valence + 1 ELSE 0 END) AS p, "
        "sum(CASE WHEN valence < 0 THEN 1 - valence ELSE 0 END) AS m, count(*) FILTER (coalesce(valence, 0) = 0) AS z "
        "FROM t LEFT JOIN lex USING (token) GROUP BY doc_id) "
        "SELECT doc_id, round(coalesce(p / (p + m + z), 0), 6) AS pos, round(coalesce(m / (p + m + z), 0), 6) AS neg, "
        "round(coalesce(z / (p + m + z), 0), 6) AS neu, round(coalesce(s / sqrt(s * s + 15), 0), 6) AS compound "
        "FROM d LEFT JOIN a USING (doc_id)"
    ),
    "cnb_predict": f"{_PRED} SELECT * FROM pred",
    "cnb_predict_vectors": f"{_PRED} SELECT * FROM pred",
    "cross_corpus": (
        f"{_NEWS_DOCS}, en AS (SELECT * FROM docs WHERE lang = 'en'), "
        "other AS (SELECT * REPLACE (CASE WHEN toxic = 0 THEN 1 ELSE 0 END AS label) FROM docs WHERE lang <> 'en'), "
        f"{_cnb_ctes('en', 'other')} SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL"
    ),
    "accuracy": (
        f"{_PRED}, a AS (SELECT avg((label = prediction)::INT) AS v FROM pred) "
        "SELECT round(v, 9) AS accuracy, format('{:.2f}', v * 100) || ' %' AS percent FROM a"
    ),
    "f1_positive": f"{_PRED}, {_CLASS_SCORES} SELECT round(coalesce(sum(f) FILTER (class = 1), 0), 9) AS f1 FROM sc",
    "f1_weighted": f"{_PRED}, {_CLASS_SCORES} SELECT round(sum(f * support) / sum(support), 9) AS f1 FROM sc",
    "logreg_cv": (
        f"{_STEM_DOCS}, {_stem_bounds('TRUE')} SELECT (SELECT count(*) FROM docs) AS n_rows, (SELECT least(10000, count(*)) FROM kept) AS n_terms, "
        f"4 AS n_settings, TRUE AS scores_valid, TRUE AS at_optimum, {_label_weights('TRUE')}"
    ),
    "logreg_plain": (
        f"{_STEM_DOCS} SELECT (SELECT count(*) FROM docs) AS n_rows, "
        "(SELECT least(10000, count(DISTINCT stem)) FROM pos JOIN stems USING (token)) AS n_terms, TRUE AS at_optimum"
    ),
    "random_forest_trial": (
        f"{_STEM_DOCS}, {_stem_bounds(_ENGLISH)} SELECT (SELECT count(*) FROM docs WHERE {_ENGLISH}) AS n_rows, "
        "(SELECT least(10000, count(*)) FROM kept) AS n_terms, "
        f"(SELECT count(*) FROM docs WHERE NOT {_ENGLISH}) AS n_scored, 100 AS n_trees, TRUE AS depth_held, TRUE AS score_valid, "
        f"{_label_weights(_ENGLISH)}"
    ),
    "forest_grid": (
        f"{_STEM_DOCS}, {_ORDERED}, {_stem_bounds(_TRAIN)} SELECT (SELECT count(*) FROM docs WHERE {_TRAIN_VAL}) AS n_rows, "
        "(SELECT least(10000, count(*)) FROM kept) AS n_terms, "
        f"(SELECT count(*) FROM docs WHERE NOT {_TRAIN_VAL}) AS n_scored, 6 AS n_settings, TRUE AS scores_valid, TRUE AS best_chosen, "
        f"TRUE AS refit_as_chosen, {_label_weights(_TRAIN_VAL)}"
    ),
    "classification_report": (
        f"{_PRED}, {_CLASS_SCORES} SELECT class::VARCHAR AS class, round(p, 9) AS precision, round(r, 9) AS recall, "
        "round(f, 9) AS f1, support FROM sc "
        "UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT round(avg((label = prediction)::INT), 9) FROM pred), (SELECT count(*) FROM pred) "
        "UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), sum(support)::BIGINT FROM sc "
        "UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9), "
        "round(sum(f * support) / sum(support), 9), sum(support)::BIGINT FROM sc"
    ),
}
