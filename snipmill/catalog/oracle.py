"""SQL twins of the registered queries, for DuckDB on the same tables.

Written from the rules, not from the Spark code: lines are counted one by one
in a list, ranks come from plain window functions over whole groups, and the
syntax trees of the snippets are known from how their texts are put together.
"""

from __future__ import annotations

from snipmill.catalog import templates
from snipmill.catalog.inputs import EOS, LABELS, PAD, VOCABULARY

# White space and line ends as RE2 classes.
_W = (
    r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_NL = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_W}+|{_W}+$', '', 'g')"


def _lines(x: str) -> str:
    parts = f"string_split_regex({x}, '{_NL}')"
    return (
        f"CASE WHEN {parts}[-1] = '' THEN list_slice({parts}, 1, len({parts}) - 1) "
        f"ELSE {parts} END"
    )


def _count(test: str) -> str:
    """Number of lines that pass; ``l`` is the line."""
    return f"CAST(len(list_filter(lines, lambda l: {test})) AS INTEGER)"


def _any(test: str) -> str:
    return f"(len(list_filter(lines, lambda l: {test})) > 0)"


def _starts(prefix: str) -> str:
    return f"starts_with({_strip('l')}, '{prefix}')"


def _has(needle: str) -> str:
    return f"contains(l, '{needle}')"


DOCUMENTS = f"""
docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS original_id, source AS source_config_id,
    lang AS language, {_strip('text')} AS raw_content, doc_id AS ord
  FROM documents),
doc_pool AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, sha256(raw_content) AS snippet_id, row_number() OVER (
      PARTITION BY sha256(raw_content) ORDER BY language, source_config_id, ord) AS copy
    FROM docs WHERE length(raw_content) >= 20)
  WHERE copy = 1)
"""

_COLUMNS = ",\n".join(f"{text} AS {name}" for name, text in templates.RECORD_COLUMNS.items())
SNIPPETS = f"""
snippets AS MATERIALIZED (SELECT {_COLUMNS}, p_size FROM part),
snippet_pool AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, sha256(raw_content) AS snippet_id, row_number() OVER (
      PARTITION BY sha256(raw_content) ORDER BY language, source_config_id, ord) AS copy
    FROM snippets)
  WHERE copy = 1)
"""


def _lined(relation: str, where: str = "true") -> str:
    return (
        f"lined AS MATERIALIZED (SELECT *, {_lines('raw_content')} AS lines "
        f"FROM {relation} WHERE {where})"
    )


_LOC = "CAST(len(lines) AS INTEGER) AS loc"
_AVERAGE = (
    "CASE WHEN len(lines) > 0 THEN length(raw_content) / len(lines)::DOUBLE "
    "ELSE 0::DOUBLE END AS avg_line_length"
)

# The rules of each language over its list of lines.
_PYTHON = {"num_comments": f"CASE WHEN parsed THEN {_count(_starts('#'))} ELSE 0 END"}
_SLASHES = {"num_comments_sl": _count(_starts("//"))}
_BLOCKS = {"num_comments_ml_lines": _count(f"{_has('/*')} OR {_has('*/')}")}
_C = {
    "includes": _count(_starts("#include")),
    "main_function": _any(_has("main(")),
    "function_defs": _count(
        f"{_has('(')} AND {_has(')')} AND {_has('{')} AND NOT {_starts('#')} "
        f"AND NOT {_has(' class ')} AND NOT {_has(' struct ')}"
    ),
    **_SLASHES,
    **_BLOCKS,
}
_JAVA = {
    "num_imports": _count(_starts("import ")),
    "class_defs": _count(f"{_has('class ')} AND {_has('{')}"),
    "main_method": _any(_has("public static void main(String[] args)")),
    **_SLASHES,
    **_BLOCKS,
}
_RUST = {
    "uses": _count(_starts("use ")),
    "fn_defs": _count(f"{_starts('fn ')} OR {_has(' fn ')}"),
    "struct_defs": _count(_starts("struct ")),
    "impl_blocks": _count(f"{_starts('impl ')} OR {_has(' impl ')}"),
    "main_function": _any(_has("fn main()")),
    **_SLASHES,
}


def _named(rules: dict[str, str]) -> str:
    return ", ".join(f"{rule} AS {name}" for name, rule in rules.items())


# What is known of a Python snippet without parsing it.
_PARSED = f"NOT ({templates.BROKEN})"
_FUNCTIONS = f"CASE WHEN {_PARSED} THEN 3 + {templates.STEPS} ELSE 0 END"
_CLASSES = f"CASE WHEN {_PARSED} THEN 1 ELSE 0 END"
_NAMES = "list_sort(['a.b', 'path', 'walk', replace(p_name, ' ', '_')])"


def _char_sql(languages: str, rules: dict[str, str]) -> str:
    return (
        f"WITH {SNIPPETS}, {_lined('snippets', f'language IN ({languages})')} "
        f"SELECT original_id, language, {_LOC}, {_AVERAGE}, {_named(rules)} FROM lined"
    )


def _brief(relation: str) -> str:
    return (
        "SELECT original_id, source_config_id, language, sha256(raw_content) AS content_hash, "
        f"CAST(length(raw_content) AS INTEGER) AS content_length FROM {relation}"
    )


_PROMPT = (
    "CASE WHEN n_chars % 3 = 0 THEN concat(' ', chr(9), chr(10)) "
    "ELSE concat(chr(10), text, '  ') END"
)
_ANSWER = "concat(text, chr(10), source)"
_TWO = f"""two AS (
  SELECT CAST(doc_id AS VARCHAR) AS original_id, 'docs' AS source_config_id,
    'en' AS language, {_strip(_PROMPT)} AS prompt, {_strip(_ANSWER)} AS answer
  FROM documents)"""

# Lists of documents: an empty one counts and gives the empty text, which is no
# content; one with a null does not count, and the next list is taken.
_TEXT_LINES = "string_split(text, chr(10))"


def _joined(items: str) -> str:
    stripped = f"list_transform({items}, lambda x: {_strip('x')})"
    return f"array_to_string(list_filter({stripped}, lambda x: x <> ''), chr(10))"


_LISTS = f"""lists AS (
  SELECT CAST(doc_id AS VARCHAR) AS original_id, 'docs' AS source_config_id,
    'en' AS language,
    CASE WHEN n_chars % 4 = 0 THEN {_strip("concat(source, ' ')")}
      WHEN n_chars % 7 = 0 THEN ''
      WHEN n_chars % 5 = 0 THEN {_joined("[source, '  ', text]")}
      ELSE {_joined(_TEXT_LINES)} END AS raw_content
  FROM documents)"""


def _dealt(index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(LABELS))
    return f"CASE ({index}) % {len(LABELS)} {cases} END"


# Which of the dealt labels mean which language.
_MEANING = {"cpp": "('C++ 17', 'GNU c++')", "python": "('Python3')", "java": "('Java')"}


def _tagged(language: str) -> str:
    label = f"CASE WHEN role = 'system' THEN 'Java 13' ELSE {_dealt('conv_id + turn + i - 1')} END"
    return f"""
  SELECT concat(conv_id, '-', turn) AS original_id, '{language}_turns' AS source_config_id,
    '{language}' AS language, role,
    list_filter(list_transform(string_split(text, chr(10)), lambda x, i:
      CASE WHEN {label} IN {_MEANING[language]} THEN {_strip('x')} ELSE '' END),
      lambda x: x <> '')[1] AS solution
  FROM conversations"""


_TAGGED = f"""tagged AS (
  SELECT *, CASE WHEN solution IS NOT NULL
    THEN concat(role, chr(10), chr(10), '// Solution:', chr(10), solution) END AS raw_content
  FROM ({" UNION ALL ".join(_tagged(x) for x in ("cpp", "java", "python"))}))"""

_YIELD_TAGGED = f"""WITH {_TAGGED}
SELECT source_config_id, count(*) AS processed,
  count(*) FILTER (WHERE length(raw_content) >= 20) AS written,
  CAST(grouping(source_config_id) AS INTEGER) AS is_total
FROM tagged GROUP BY ROLLUP (source_config_id)"""

# Solutions listed in JSON: the first item as its variant leaves it.
_LISTED = f"""listed AS (
  SELECT concat(conv_id, '-', turn) AS original_id, 'lists' AS source_config_id,
    'python' AS language,
    CASE WHEN turn % 2 = 0 THEN role ELSE '' END AS problem,
    list_concat(
      CASE WHEN conv_id % 7 IN (0, 2, 3) THEN []
        WHEN conv_id % 7 = 1 THEN string_split(text, chr(10))
        ELSE string_split(text, chr(10)) END,
      CASE WHEN conv_id % 3 = 0 THEN ['', ' tail '] ELSE [] END) AS items
  FROM conversations),
solved AS (
  SELECT *, CASE WHEN len(items) > 0
    THEN array_to_string(items, concat(chr(10), chr(10), '---', chr(10), chr(10)))
    ELSE '' END AS solution
  FROM listed),
listed_records AS (
  SELECT *, CASE
    WHEN problem <> '' AND solution <> ''
      THEN concat(problem, chr(10), chr(10), '# Solutions:', chr(10), solution)
    WHEN solution <> '' THEN solution WHEN problem <> '' THEN problem END AS raw_content
  FROM solved)"""

_DESCRIPTION = "CASE conv_id % 4 WHEN 0 THEN '' WHEN 1 THEN '' ELSE role END"
_SOLUTION = "CASE turn % 3 WHEN 0 THEN text ELSE '' END"
_COMBINED = f"""parts AS (
  SELECT conv_id, turn, {_DESCRIPTION} AS d, {_SOLUTION} AS s FROM conversations),
wholes AS (
  SELECT conv_id, turn, CASE
    WHEN d <> '' AND s <> '' AND conv_id % 5 <> 0
      THEN concat(d, chr(10), chr(10), '# Solution:', chr(10), s)
    WHEN s <> '' THEN s WHEN d <> '' THEN d END AS whole
  FROM parts)"""

_RECORD_COLUMNS = "original_id, source_config_id, language, snippet_id"


def _report(relation: str) -> str:
    filled = "raw_content IS NOT NULL AND raw_content <> ''"
    return f"""
SELECT count(*) AS loaded,
  count(DISTINCT raw_content) FILTER (WHERE {filled}) AS unique_records,
  count(*) FILTER (WHERE NOT ({filled})) AS removed_empty,
  count(*) - count(DISTINCT raw_content) FILTER (WHERE {filled}) AS removed,
  count(*) FILTER (WHERE {filled})
    - count(DISTINCT raw_content) FILTER (WHERE {filled}) AS removed_duplicates
FROM {relation}"""


_USED = f"""used AS (
  SELECT DISTINCT sha256({_strip('text')}) AS snippet_id
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"""


def _first(relation: str, where: str, salt: str, n: str) -> str:
    return f"""
  SELECT snippet_id, language FROM (
    SELECT snippet_id, language,
      row_number() OVER (ORDER BY md5('{salt}|' || snippet_id), snippet_id) AS rn
    FROM {relation} WHERE {where})
  WHERE rn <= {n}"""


def _phases(relation: str, phases, replay_language: str) -> str:
    """Chained tables, two per phase, each excluding the ids of all before."""
    ctes, earlier = [], []

    def unused() -> str:
        return "".join(
            f" AND snippet_id NOT IN (SELECT snippet_id FROM {name})" for name in earlier
        )

    parts = []
    for i, (name, language, n, ratio) in enumerate(phases):
        is_main = f"language = '{language}'" if language else "true"
        ctes.append(
            f"main{i} AS MATERIALIZED ({_first(relation, is_main + unused(), name, str(n))})"
        )
        earlier.append(f"main{i}")
        parts.append((name, "main", f"main{i}"))
        if ratio and language != replay_language:
            quota = f"(SELECT floor(count(*) * {ratio}::DOUBLE) FROM main{i})"
            where = f"language = '{replay_language}'" + unused()
            rows = _first(relation, where, f"{name} replay", quota)
            ctes.append(f"replay{i} AS MATERIALIZED ({rows})")
            earlier.append(f"replay{i}")
            parts.append((name, "replay", f"replay{i}"))
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS phase, '{role}' AS role, snippet_id, language FROM {t}"
        for name, role, t in parts
    )
    ctes.append(
        f"""selection AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY phase
    ORDER BY md5(phase || ' order|' || snippet_id), snippet_id) AS position
  FROM ({union}))"""
    )
    return ",\n".join(ctes)


_DOCUMENT_PHASES = _phases(
    "doc_pool",
    (
        ("Focus", "de", 60, 0.0),
        ("French_Introduction", "fr", 100, 0.15),
        ("Spanish_Introduction", "es", 120, 0.10),
        ("Mixed", None, 250, 0.20),
    ),
    "de",
)
_SNIPPET_PHASES = _phases(
    "snippet_pool",
    (
        ("Python_Focus", "python", 300, 0.0),
        ("CPP_Introduction", "cpp", 200, 0.15),
        ("Java_Introduction", "java", 200, 0.10),
        ("Final_Mixed_Tune", None, 250, 0.20),
    ),
    "python",
)
_SELECTION = "phase, role, snippet_id, language, position"


def _split(relation: str) -> str:
    return f"""drawn AS (
  SELECT *, count(*) OVER (PARTITION BY phase) AS n,
    row_number() OVER (PARTITION BY phase
      ORDER BY md5('42|' || snippet_id), snippet_id) AS rn
  FROM {relation}),
sized AS (
  SELECT *, CASE WHEN n > 1 THEN greatest(CAST(floor(n * 0.15::DOUBLE) AS BIGINT), 1)
    ELSE 0 END AS val_n
  FROM drawn),
split AS MATERIALIZED (
  SELECT phase, snippet_id, CASE WHEN rn <= val_n THEN 'val' ELSE 'train' END AS part,
    CASE WHEN rn <= val_n THEN rn ELSE rn - val_n END AS place
  FROM sized)"""


_DOCUMENT_SPLIT = f"""WITH {DOCUMENTS},
members AS (SELECT language AS phase, snippet_id FROM doc_pool),
{_split('members')}"""

# Forty rounds that swap the places whose sum is a key, or not, by a bit of a hash.
_KEY = "CAST('0x' || substr(md5(epoch || '|' || r), 1, 15) AS BIGINT)"
_OTHER = f"(({_KEY} % m - x + m) % m)"
_EPOCH_PLACES = f"""counted_epochs AS (
  SELECT *, count(*) OVER (PARTITION BY phase, epoch, part) AS m FROM epochs),
placed AS (
  SELECT *, CASE WHEN part = 'val' THEN place - 1 ELSE list_reduce(
    list_concat([place - 1], range(40)), lambda x, r: CASE
      WHEN substr(md5(epoch || '|' || r || '|' || greatest(x, {_OTHER})), 1, 1) >= '8'
      THEN {_OTHER} ELSE x END) END AS p
  FROM counted_epochs)"""

_TOKENS = f"""tokens AS (
  SELECT doc_id, lang, CASE WHEN n_chars % 11 = 0 THEN NULL
    WHEN n_chars % 13 = 0 THEN CAST([] AS INTEGER[])
    ELSE list_transform(string_split(text, ' '), lambda w:
      CAST((length(w) * 1009 + ascii(w) * 31 + ascii(substr(w, -1)))
        % {VOCABULARY} + 1 AS INTEGER))
    END AS token_ids
  FROM documents),
real AS (
  SELECT *, CASE WHEN token_ids IS NULL THEN NULL
    WHEN len(token_ids) = 0 THEN [CAST({EOS} AS INTEGER)]
    ELSE list_slice(token_ids, 1, 512) END AS kept
  FROM tokens),
sequences AS (
  SELECT *,
    CASE WHEN kept IS NULL THEN list_transform(range(512), lambda i: {EOS})
      ELSE list_transform(range(512), lambda i: coalesce(kept[i + 1], {PAD})) END AS input_ids,
    list_transform(range(512), lambda i:
      CASE WHEN i < coalesce(len(kept), 0) THEN 1 ELSE 0 END) AS attention_mask
  FROM real)"""


def _evaluation(shift: int) -> str:
    return f"""WITH {_TOKENS},
places AS (
  SELECT lang, doc_id, unnest(range(512)) AS i, input_ids, attention_mask
  FROM sequences),
predicted AS (
  SELECT lang, doc_id, i, input_ids[i + 1]
      + CASE WHEN (doc_id + input_ids[i + 1] * 7 + i) % 10 < 6 THEN 0 ELSE 1 END AS pred,
    input_ids[i + 1 + {shift}] AS label, attention_mask[i + 1 + {shift}] AS attention
  FROM places),
counted AS (
  SELECT lang, count(*) FILTER (WHERE attention = 1) AS target_tokens,
    count(*) FILTER (WHERE attention = 1 AND label = pred) AS correct_tokens
  FROM predicted GROUP BY lang),
losses AS (
  SELECT lang, count(*) AS batches,
    sum(CASE WHEN token_ids IS NULL THEN 0 ELSE len(token_ids) / 100::DOUBLE END) AS loss
  FROM sequences GROUP BY lang)
SELECT lang AS phase, batches, target_tokens, correct_tokens,
  round(loss / batches, 6) AS avg_loss,
  round(correct_tokens / target_tokens::DOUBLE, 6) AS accuracy
FROM counted JOIN losses USING (lang)"""


def _as_text(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def _total(name: str, rules: dict[str, str], languages: str) -> str:
    return f"CASE WHEN lower(language) IN ({languages}) THEN {rules[name]} END"


_ALL_RULES = {
    "num_functions": f"CASE WHEN language = 'python' THEN {_FUNCTIONS} END",
    "num_classes": f"CASE WHEN language = 'python' THEN {_CLASSES} END",
    "num_comments": _total("num_comments", _PYTHON, "'python'"),
    "includes": _total("includes", _C, "'c', 'cpp'"),
    "function_defs": _total("function_defs", _C, "'c', 'cpp'"),
    "num_comments_sl": _total("num_comments_sl", _SLASHES, "'c', 'cpp', 'java', 'rust'"),
    "num_comments_ml_lines": _total("num_comments_ml_lines", _BLOCKS, "'c', 'cpp', 'java'"),
    "num_imports": _total("num_imports", _JAVA, "'java'"),
    "class_defs": _total("class_defs", _JAVA, "'java'"),
    "uses": _total("uses", _RUST, "'rust'"),
    "fn_defs": _total("fn_defs", _RUST, "'rust'"),
    "struct_defs": _total("struct_defs", _RUST, "'rust'"),
    "impl_blocks": _total("impl_blocks", _RUST, "'rust'"),
}
_MAIN = (
    f"CASE WHEN language IN ('c', 'cpp') THEN {_C['main_function']} "
    f"WHEN language = 'rust' THEN {_RUST['main_function']} END"
)
_ALL_FLAGS = {
    "main_function": _MAIN,
    "main_method": _total("main_method", _JAVA, "'java'"),
    "ast_parse_success": "CASE WHEN language = 'python' THEN parsed END",
}
_UNIFIED = f"""WITH {SNIPPETS},
everything AS (
  SELECT language, source_config_id, ord, raw_content, {_PARSED} AS parsed, p_size FROM snippets
  UNION ALL SELECT lang, source, doc_id, {_strip('text')}, NULL, NULL FROM documents
  UNION ALL SELECT 'html', 'pages', page_id, html, NULL, NULL FROM pages),
pool AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_content
    ORDER BY language, source_config_id, ord) AS copy
  FROM everything WHERE raw_content <> '') WHERE copy = 1),
{_lined('pool')}
SELECT language, count(*) AS n, CAST(sum(len(lines)) AS BIGINT) AS loc,
  {", ".join(f"CAST(sum({r}) AS BIGINT) AS {n}" for n, r in _ALL_RULES.items())},
  {", ".join(f"count(*) FILTER (WHERE {r}) AS {n}" for n, r in _ALL_FLAGS.items())}
FROM lined GROUP BY language"""

# Names of the exported metrics per language.
_EXPORT_KEYS = {
    "python": "loc,num_functions,num_classes,imports,ast_parse_success,"
    "syntax_error_detail,avg_line_length,num_comments",
    "c": "loc,includes,main_function,function_defs,avg_line_length,"
    "num_comments_sl,num_comments_ml_lines",
    "cpp": "loc,includes,main_function,function_defs,avg_line_length,"
    "num_comments_sl,num_comments_ml_lines",
    "java": "loc,imports,class_defs,main_method,avg_line_length,"
    "num_comments_sl,num_comments_ml_lines",
    "rust": "loc,uses,fn_defs,struct_defs,impl_blocks,main_function,"
    "avg_line_length,num_comments_sl",
    "Go": "loc,avg_line_length",
}

ORACLE: dict[str, str] = {
    "pool_summary": f"""WITH {DOCUMENTS}, {_lined('doc_pool')}
SELECT language, count(*) AS n, CAST(sum(len(lines)) AS BIGINT) AS sum_loc,
  round(avg(length(raw_content) / len(lines)::DOUBLE), 6) AS mean_line_length
FROM lined GROUP BY language""",
    "exact_dedup_keep_first": f"WITH {DOCUMENTS} SELECT {_RECORD_COLUMNS} FROM doc_pool",
    "dedup_across_languages": f"WITH {SNIPPETS} SELECT {_RECORD_COLUMNS} FROM snippet_pool",
    "dedup_report": f"WITH {DOCUMENTS} {_report('docs')}",
    "dedup_report_snippets": f"WITH {SNIPPETS} {_report('snippets')}",
    "extract_first_field": f"""WITH {_TWO}, records AS (
  SELECT *, CASE WHEN prompt <> '' THEN prompt ELSE answer END AS raw_content FROM two)
{_brief('records')}""",
    "extract_all_fields": f"""WITH {_TWO}, records AS (
  SELECT *, CASE WHEN prompt <> ''
    THEN concat(prompt, chr(10), '# Output:', chr(10), answer) ELSE answer END AS raw_content
  FROM two)
{_brief('records')}""",
    "extract_list_field": f"WITH {_LISTS} {_brief('lists')} WHERE raw_content <> ''",
    "extract_nested_solution": f"WITH {_TAGGED} {_brief('tagged')} WHERE raw_content IS NOT NULL",
    "extract_json_solutions": (
        f"WITH {_LISTED} {_brief('listed_records')} WHERE raw_content IS NOT NULL"
    ),
    "normalise_language": f"""SELECT label, CASE
    WHEN label IN ('C++ 17', 'GNU c++') THEN 'cpp' WHEN label = 'Python3' THEN 'python'
    WHEN label = 'Java 13' THEN 'java1' WHEN label = 'C' THEN 'c' ELSE 'pypy' END AS language,
  count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS sum_chars
FROM (SELECT {_dealt('conv_id + turn')} AS label, text FROM conversations)
GROUP BY label""",
    "combine_parts": f"""WITH {_COMBINED}
SELECT conv_id, turn, sha256(whole) AS content_hash,
  CAST(length(whole) AS INTEGER) AS content_length FROM wholes""",
    "min_length_filter": f"""WITH {DOCUMENTS}
SELECT original_id, CAST(length(raw_content) AS INTEGER) AS content_length
FROM docs WHERE length(raw_content) >= 20""",
    "record_ids": """SELECT doc_id AS ord, CASE
  WHEN n_chars % 3 = 0 THEN CAST(doc_id AS VARCHAR)
  WHEN n_chars % 2 = 0 THEN concat(source, '-', lang)
  ELSE concat('docs_', doc_id + 1) END AS original_id FROM documents""",
    "first_n_per_source": """SELECT source, doc_id, n_chars, rank FROM (
  SELECT source, doc_id, n_chars,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents)
WHERE rank <= 25""",
    "yield_report": f"""WITH {DOCUMENTS}
SELECT source_config_id, count(*) AS processed,
  count(*) FILTER (WHERE length(raw_content) >= 20) AS written,
  CAST(grouping(source_config_id) AS INTEGER) AS is_total
FROM docs GROUP BY ROLLUP (source_config_id)""",
    "yield_report_solutions": _YIELD_TAGGED,
    "zero_yield_sources": f"""SELECT * FROM ({_YIELD_TAGGED})
WHERE is_total = 0 AND processed > 0 AND written = 0""",
    "char_generic": f"""WITH texts AS (
  SELECT CAST(doc_id AS VARCHAR) AS original_id, lang AS language,
    {_strip('text')} AS raw_content FROM documents
  UNION ALL SELECT CAST(page_id AS VARCHAR), 'html', html FROM pages),
{_lined('texts')}
SELECT original_id, language, {_LOC}, {_AVERAGE} FROM lined""",
    "char_python_ast": f"""SELECT CAST(p_partkey AS VARCHAR) AS original_id,
  'python' AS language, CAST({_FUNCTIONS} AS INTEGER) AS num_functions,
  CAST({_CLASSES} AS INTEGER) AS num_classes,
  CASE WHEN {_PARSED} THEN array_to_string({_NAMES}, ',') ELSE '' END AS imports,
  {_PARSED} AS ast_parse_success, NOT ({_PARSED}) AS has_error
FROM part WHERE {templates.LANGUAGE} = 'python'""",
    "char_python_comments": f"""WITH {SNIPPETS}, {_lined('snippets', "language = 'python'")}
SELECT original_id, language, {_LOC}, {_AVERAGE},
  CAST(CASE WHEN {_PARSED} THEN {_count(_starts('#'))} ELSE 0 END AS INTEGER) AS num_comments
FROM lined""",
    "viable_python": f"""SELECT CAST(p_partkey AS VARCHAR) AS original_id,
  p_brand AS source_config_id
FROM part WHERE {templates.LANGUAGE} = 'python' AND {_PARSED}""",
    "char_c_cpp": _char_sql("'c', 'cpp'", _C),
    "char_java": _char_sql("'java'", _JAVA),
    "char_rust": _char_sql("'rust'", _RUST),
    "char_web_pages_as_c": f"""WITH texts AS (
  SELECT CAST(page_id AS VARCHAR) AS original_id, 'C' AS language,
    html AS raw_content FROM pages),
{_lined('texts')}
SELECT original_id, language, {_LOC}, {_named(_C)} FROM lined""",
    "char_unified": _UNIFIED,
    "language_distribution": f"""WITH {DOCUMENTS}
SELECT language, count(*) AS n FROM doc_pool GROUP BY language""",
    "sample_language": (
        f"WITH {DOCUMENTS} {_first('doc_pool', "language = 'de'", 'sample', '30')}"
    ),
    "sample_any": f"WITH {DOCUMENTS} {_first('doc_pool', 'true', 'sample', '400')}",
    "exclude_used": f"""WITH {DOCUMENTS}, {_USED}
SELECT snippet_id, language FROM doc_pool
WHERE snippet_id NOT IN (SELECT snippet_id FROM used)""",
    "replay_sample": f"""WITH {DOCUMENTS}, {_USED},
free AS (SELECT * FROM doc_pool WHERE snippet_id NOT IN (SELECT snippet_id FROM used)),
main AS MATERIALIZED ({_first('free', "language = 'fr'", 'main', '60')})
{_first('free', "language = 'de' AND snippet_id NOT IN (SELECT snippet_id FROM main)",
        'replay', '(SELECT floor(count(*) * 0.29::DOUBLE) FROM main)')}""",
    "phase_selection": f"WITH {DOCUMENTS}, {_DOCUMENT_PHASES} SELECT {_SELECTION} FROM selection",
    "phase_selection_snippets": (
        f"WITH {SNIPPETS}, {_SNIPPET_PHASES} SELECT {_SELECTION} FROM selection"
    ),
    "phase_languages": f"""WITH {SNIPPETS}, {_SNIPPET_PHASES}
SELECT phase, language, count(*) AS n FROM selection GROUP BY phase, language""",
    "plan_summary": f"""WITH {SNIPPETS}, {_SNIPPET_PHASES}, {_split('selection')},
counted AS (
  SELECT phase, count(*) AS selected, count(*) FILTER (WHERE part = 'train') AS train,
    count(*) FILTER (WHERE part = 'val') AS val,
    CASE WHEN phase = 'Final_Mixed_Tune' THEN 2 ELSE 3 END AS epochs
  FROM split GROUP BY phase)
SELECT phase, selected, train, val, train AS steps_per_epoch, train * epochs AS total_steps,
  CAST(floor(train * epochs * 0.1::DOUBLE) AS BIGINT) AS warmup_steps
FROM counted""",
    "selection_contents": f"""WITH {DOCUMENTS}, {_DOCUMENT_PHASES}
SELECT phase, role, original_id, CAST(length(raw_content) AS INTEGER) AS content_length
FROM selection JOIN doc_pool USING (snippet_id)""",
    "train_val_split": f"""{_DOCUMENT_SPLIT} SELECT phase, snippet_id, part, place,
  count(*) OVER (PARTITION BY phase, part) AS "of" FROM split""",
    "epoch_batches": f"""{_DOCUMENT_SPLIT},
epochs AS (SELECT *, unnest([1, 2, 3]) AS epoch FROM split),
{_EPOCH_PLACES}
SELECT phase, snippet_id, part, CAST(epoch AS INTEGER) AS epoch,
  CAST(p // 8 AS BIGINT) AS batch FROM placed""",
    "epoch_batches_zero": f"""{_DOCUMENT_SPLIT},
epochs AS (SELECT *, unnest([1, 2]) AS epoch FROM split WHERE phase <> 'de'),
{_EPOCH_PLACES}
SELECT phase, snippet_id, part, CAST(epoch AS INTEGER) AS epoch,
  CAST(p // 8 AS BIGINT) AS batch FROM placed""",
    "sequence_shape": f"""WITH {_TOKENS}
SELECT doc_id, {_as_text('input_ids')} AS input_ids,
  {_as_text('attention_mask')} AS attention_mask FROM sequences""",
    "label_mask": f"""WITH {_TOKENS}
SELECT doc_id, {_as_text(
        f'list_transform(input_ids, lambda x: CASE WHEN x = {PAD} THEN -100 ELSE x END)'
    )} AS labels FROM sequences""",
    "label_mask_attended": f"""WITH {_TOKENS}
SELECT doc_id, {_as_text('list_transform(range(512), lambda i: '
        'CASE WHEN attention_mask[i + 1] = 1 THEN input_ids[i + 1] ELSE -100 END)')} AS labels FROM sequences""",
    "eval_summary": _evaluation(0),
    "eval_summary_next_token": _evaluation(1),
    "jsonl_round_trip": f"""SELECT CAST(doc_id AS VARCHAR) AS original_id,
  source AS source_config_id, lang AS language, doc_id AS ord,
  sha256({_strip('text')}) AS content_hash FROM documents
UNION ALL SELECT CAST(page_id AS VARCHAR), 'pages', 'html', page_id, sha256(html) FROM pages""",
    "jsonl_good_lines": """SELECT concat(conv_id, '-', turn) AS original_id,
  role AS language, sha256(text) AS content_hash FROM conversations WHERE turn % 3 = 0""",
    "jsonl_quarantine": """SELECT CASE WHEN turn % 3 = 1 THEN 'cut off' ELSE 'not an object' END
  AS kind, count(*) AS n FROM conversations WHERE turn % 3 <> 0 GROUP BY ALL""",
    "pool_export_round_trip": f"""WITH {SNIPPETS}, {_lined('snippet_pool')}
SELECT language, count(*) AS n, CAST(sum(len(lines)) AS BIGINT) AS loc,
  CAST(sum(CASE WHEN language = 'python' THEN CASE WHEN {_PARSED} THEN 4 ELSE 0 END END)
    AS BIGINT) AS imported_names,
  CAST(sum({_total('num_imports', _JAVA, "'java'")}) AS BIGINT) AS num_imports,
  count(*) FILTER (WHERE {_MAIN}) AS main_function
FROM lined GROUP BY language""",
    "pool_export_lines": f"""WITH {SNIPPETS}
SELECT language, CASE language {" ".join(
        f"WHEN '{name}' THEN '{keys}'" for name, keys in _EXPORT_KEYS.items()
    )} END AS metrics, count(*) AS n FROM snippet_pool GROUP BY language""",
    "source_scan_first_rows": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ord,
  doc_id, sha256(text) AS content_hash FROM documents ORDER BY doc_id LIMIT 120""",
    "plain_corpus_scan": f"""SELECT ord, concat('docs_', ord + 1) AS original_id,
  sha256({_strip('text')}) AS content_hash
FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS ord FROM documents)
WHERE length({_strip('text')}) >= 20""",
    "extraction_status": f"""SELECT unnest(['fine', 'streamed', 'odd', 'empty', 'absent', 'partly', 'partly']) AS source,
  unnest(['done', 'done', 'missing fields', 'empty', 'failed', 'done', 'missing fields']) AS status,
  unnest([n, n, 0, 0, 0, n_some, 0]) AS processed, unnest([long, long, 0, 0, 0, long_some, 0]) AS written
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE length({_strip('text')}) >= 20) AS long,
  count(*) FILTER (WHERE doc_id % 3 <> 0) AS n_some,
  count(*) FILTER (WHERE doc_id % 3 <> 0 AND length({_strip('text')}) >= 20) AS long_some
  FROM documents)""",
    "known_sources": f"""WITH d AS (
  SELECT doc_id, source AS origin, {_strip('text')} AS body, {_strip("concat_ws(' ', source, text)")} AS code,
    concat_ws(' ', source, text) AS raw, row_number() OVER (ORDER BY doc_id) AS nth FROM documents
), one AS (SELECT *, CASE WHEN doc_id % 3 <> 0 THEN body END AS content FROM d),
two AS (SELECT *, coalesce(nullif(content, ''), code) AS either FROM one),
c AS (
  SELECT 'mbpp_py' AS source, 'python' AS language, doc_id, either AS content FROM two WHERE nth <= 10000
  UNION ALL SELECT 'humaneval_py', 'python', doc_id, either FROM two WHERE nth <= 2000
  UNION ALL SELECT 'alpaca_py_instr', 'python', doc_id, either FROM two WHERE nth <= 18000
  UNION ALL SELECT 'codeforces_py', 'python', doc_id, content FROM one WHERE nth <= 50000
  UNION ALL SELECT 'rust_code_snippets_new', 'rust', doc_id, content FROM one WHERE nth <= 5000
  UNION ALL SELECT 'c_code_snippets_new', 'c', doc_id, content FROM one WHERE nth <= 10000
  UNION ALL SELECT 'apps_py', 'python', doc_id, concat(CASE WHEN body <> '' THEN
    concat(body, chr(10), chr(10), '# Solutions:', chr(10)) END,
    origin, chr(10), chr(10), '---', chr(10), chr(10), raw) FROM d WHERE nth <= 50
  UNION ALL SELECT CASE WHEN doc_id % 2 = 0 THEN 'cpp_code_contests' ELSE 'java_code_contests' END,
    CASE WHEN doc_id % 2 = 0 THEN 'cpp' ELSE 'java' END, doc_id, concat(CASE WHEN body <> '' THEN
    concat(body, chr(10), chr(10), '// Solution:', chr(10)) END, code)
    FROM d WHERE nth <= 10000 AND code <> ''
)
SELECT source, language, CAST(doc_id AS VARCHAR) AS original_id, sha256(content) AS content_hash,
  0 AS n_not_done FROM c WHERE length(content) >= 20""",
    "compressed_records": f"""SELECT CAST(doc_id AS VARCHAR) AS original_id,
  sha256({_strip('text')}) AS content_hash, 0 AS n_unreadable FROM documents""",
    "broken_records": f"""SELECT CAST(doc_id AS VARCHAR) AS original_id,
  sha256({_strip('text')}) AS content_hash, true AS all_reported FROM documents""",
    "bounded_stream_scan": """SELECT least(count(*), 500) AS n_rows,
  least(count(*), 500) AS n_documents, 0::BIGINT AS n_strangers FROM documents""",
}
