"""DuckDB twins of the queries that SQL can express."""

OP3 = r"""
WITH captures AS (
  SELECT page_id, url, 1704067200 + ((page_id * 7654321 % 31536000) + 31536000) % 31536000 AS sec,
    regexp_replace(lower(regexp_extract(url,
      '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '\.$', '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), domains AS (
  SELECT regexp_replace(host, '^(www|m|blog)\.', '') AS value, min(page_id) AS first, count(*) AS n
  FROM captures WHERE host <> '' GROUP BY 1 HAVING min(page_id) % 3 = 0
), prefixes AS (
  SELECT rtrim(host || '/' || regexp_extract(path, '^/([^/]+)', 1), '/') AS value, min(page_id) AS first
  FROM captures WHERE host <> '' GROUP BY 1 HAVING min(page_id) % 5 = 0
), entries AS (
  SELECT 'domain' AS kind, value, 1704067200 + first * 104729 % 15768000 AS sec, 'add' AS action
  FROM domains
  UNION ALL SELECT 'domain', value, 1704067200 + 60 * 86400 + first * 104729 % 15768000, 'remove'
  FROM domains WHERE n % 3 <> 0
  UNION ALL SELECT 'domain', value, 1704067200 + 100 * 86400 + first * 104729 % 15768000, 'add'
  FROM domains WHERE n % 4 = 1
  UNION ALL
  SELECT 'prefix', value, 1704067200 + 30 * 86400 + first * 104729 % 15768000, 'add' FROM prefixes
), found AS (
  SELECT c.page_id, c.url, c.sec, e.kind, e.value,
    arg_max(e.action, (e.sec, e.action)) AS latest
  FROM captures c JOIN entries e ON e.sec <= c.sec AND c.host <> '' AND (
    (e.kind = 'domain' AND (c.host = e.value OR ends_with(c.host, '.' || e.value)))
    OR (e.kind = 'prefix' AND
        ((c.host || c.path) = e.value OR starts_with(c.host || c.path, e.value || '/'))))
  GROUP BY ALL
), active AS (
  SELECT page_id, url, sec, count(*) AS matches, min((kind, value)) AS first
  FROM found WHERE latest = 'add' GROUP BY ALL
)
SELECT c.page_id, c.url, c.sec AS fetched_second, a.matches IS NOT NULL AS blocked,
  coalesce(a.matches, 0) AS matches, a.first[1] AS match_kind, a.first[2] AS match_value
FROM captures c LEFT JOIN active a
  ON a.page_id = c.page_id AND a.url = c.url AND a.sec = c.sec
"""

# Every item laid over every word of every document: all pairs of equal words, grouped by
# the word of the document at which the item would begin. The best stretch begins at an
# equal word, or is the last one that fits.
OP7 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D.,;:!?"''()\[\]]+') AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), items AS (
  SELECT row_number() OVER () AS i, item_id, v, least(13, len(v)) AS n FROM (
    SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D.,;:!?"''()\[\]]+') AS v
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)
), doc_words AS (
  SELECT d, len(w) AS size, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM docs
), item_words AS (
  SELECT i, n, len(v) AS size, unnest(v) AS word, generate_subscripts(v, 1) - 1 AS q FROM items
), equal_words AS (
  SELECT d, i, n, p - q AS begin, q, least(x.size, w.size - (p - q)) - n AS last_start,
    count(*) OVER (PARTITION BY d, i, p - q) AS in_all
  FROM doc_words w JOIN item_words x USING (word)
), counted AS (
  SELECT d, i, n, begin,
    CASE WHEN q <= last_start THEN count(*) OVER (PARTITION BY d, i, begin ORDER BY q
      RANGE BETWEEN CURRENT ROW AND n - 1 FOLLOWING)
    ELSE count(*) FILTER (q >= last_start) OVER (PARTITION BY d, i, begin) END AS equal
  FROM equal_words WHERE 100 * in_all >= 75 * n AND last_start >= greatest(0, -begin)
), laid AS (
  SELECT doc_id, item_id, begin, max((equal, n)) AS best
  FROM counted JOIN docs USING (d) JOIN items USING (i, n)
  WHERE 100 * equal >= 75 * n GROUP BY doc_id, item_id, begin
)
SELECT doc_id, item_id, max(best)[1]::INTEGER AS equal_words, max(best)[2]::INTEGER AS of_words,
  count(*) AS layings
FROM laid GROUP BY doc_id, item_id
"""


def _merkle_up(name: str, keys: str, levels: int) -> str:
    """Levels of trees of 16 children: nodes with the digests beside them in their run."""
    run = f"PARTITION BY {keys}, pos // 16 ORDER BY pos ROWS BETWEEN"
    parts = []
    for k in range(levels):
        parts.append(f"""{name}_sides{k} AS (
  SELECT *, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}
), {name}{k + 1} AS (
  SELECT {keys}, pos // 16 AS pos, (n + 15) // 16 AS n, sha256(string_agg(d, '' ORDER BY pos)) AS d
  FROM {name}{k} WHERE n > 1 GROUP BY {keys}, pos // 16, n
)""")
    return ", ".join(parts)


def _merkle_down(name: str, keys: str, rows: str, levels: int) -> str:
    """Rows of ``rows``, node by node upwards: what they fold to and their siblings."""
    same = " AND ".join(f"s.{k} IS NOT DISTINCT FROM c.{k}" for k in keys.split(", "))
    parts = []
    for k in range(levels):
        parts.append(f"""{rows}{k + 1} AS (
  SELECT c.* REPLACE (CASE WHEN c.n > 1 THEN sha256(s.l || c.x || s.r) ELSE c.x END AS x,
      CASE WHEN c.n > 1 THEN c.proof || s.l || s.r ELSE c.proof END AS proof,
      c.pos // 16 AS pos, (c.n + 15) // 16 AS n)
  FROM {rows}{k} c LEFT JOIN {name}_sides{k} s ON s.pos = c.pos AND {same}
)""")
    return ", ".join(parts)


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: per character one step that mixes it in, and eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], {steps}::BIGINT[]), lambda a, b:
    CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


def _field(value: str) -> str:
    text = f"({value})::VARCHAR"
    return f"CASE WHEN {text} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# Up to 16^6 rows of a source and 16^5 sources.
_IN_SOURCE, _OF_SOURCES = 6, 5
OP13 = rf"""
WITH docs AS (
  SELECT doc_id, source, {_leaf("text")} AS d,
    CASE WHEN coalesce({_crc32("doc_id::VARCHAR")} % 5, 0) = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
      ELSE {_leaf("text")} END AS x
  FROM documents
), node0 AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM docs
), {_merkle_up("node", "source", _IN_SOURCE)}, subroots AS (
  {" UNION ALL ".join(f"SELECT source, d FROM node{k} WHERE n = 1" for k in range(_IN_SOURCE + 1))}
), top0 AS (
  SELECT source, d, 0 AS one, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n FROM subroots
), {_merkle_up("top", "one", _OF_SOURCES)}, root AS (
  {" UNION ALL ".join(f"SELECT d FROM top{k} WHERE n = 1" for k in range(_OF_SOURCES + 1))}
), row0 AS (SELECT *, '' AS proof FROM node0
), {_merkle_down("node", "source", "row", _IN_SOURCE)}, in_top0 AS (
  SELECT c.doc_id, c.d AS leaf, c.x, c.proof, t.d AS subroot, t.pos, t.n, 0 AS one
  FROM row{_IN_SOURCE} c JOIN top0 t ON t.source IS NOT DISTINCT FROM c.source
), {_merkle_down("top", "one", "in_top", _OF_SOURCES)}
SELECT doc_id, leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, x AS folded_root,
  x = root.d AS verified
FROM in_top{_OF_SOURCES}, root
"""

ORACLE: dict[str, str] = {"op3_temporal_list_join": OP3, "op7_spaced_seeds": OP7, "op13_merkle_manifest": OP13}
