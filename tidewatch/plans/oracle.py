"""DuckDB SQL for each registered query (the independent correctness oracle).

Table names are the driver's pre-registered views. Each statement restates the
fixture derivation of ``tidewatch.plans.fixtures`` in SQL and then the
operator's semantics, written plainly rather than in the Spark plan's shape.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixtures

MSG_EVENTS = """
msgs AS (
  SELECT CAST(event_id AS VARCHAR) AS MessageId, ts AS Created,
         [event_type] AS Keywords, []::VARCHAR[] AS Sectors,
         ['k' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 7 AS VARCHAR)] AS Groups,
         [CASE WHEN value >= 100 THEN 'high' ELSE 'low' END] AS Statuses
  FROM events
)"""

MSG_LINES = """
msgs AS (
  SELECT NULL::VARCHAR AS MessageId, l.l_shipdate AS Created,
         string_split(p.p_name, ' ') AS Keywords, [p.p_type] AS Sectors,
         [p.p_brand] AS Groups, [l.l_returnflag] AS Statuses
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

MSG_REPEATS = """
msgs AS (
  SELECT NULL::VARCHAR AS MessageId, l.l_shipdate AS Created,
         string_split(p.p_name || ' ' || p.p_name, ' ') AS Keywords, [p.p_type] AS Sectors,
         [p.p_brand] AS Groups, [l.l_returnflag] AS Statuses
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

MSG_FIXTURES = {"events": MSG_EVENTS, "lines": MSG_LINES, "repeats": MSG_REPEATS}


def _section(name: str) -> str:
    return (
        f"list_transform(coalesce({name}, []::VARCHAR[]), lambda v, i: "
        f"{{'section': '{name}', 'value': v, 'first': list_position({name}, v) = i}})"
    )


# qualifying records (P1, P2) exploded to entries, the hourly cube and spans
TREND_BASE = """
qual AS (
  SELECT * FROM msgs
  WHERE Created IS NOT NULL
    AND len(coalesce(Keywords, []::VARCHAR[])) + len(coalesce(Sectors, []::VARCHAR[]))
      + len(coalesce(Groups, []::VARCHAR[])) + len(coalesce(Statuses, []::VARCHAR[])) > 0
),
entries AS (
  SELECT date_trunc('hour', Created) AS hour, e.section AS section, e.value AS value, e.first AS first
  FROM (SELECT Created, unnest(list_concat(""" + ", ".join(_section(s) for s in ("Keywords", "Sectors", "Groups", "Statuses")) + """)) AS e
        FROM qual)
  WHERE e.value IS NOT NULL
),
cube AS (
  SELECT hour, section, value, count(*) AS occ, count(*) FILTER (WHERE first) AS rec
  FROM entries GROUP BY hour, section, value
),
spans AS (
  SELECT s.timespan, hour, section, value, occ, rec
  FROM cube, unnest(['alltime', strftime(hour, 'year-%Y'), strftime(hour, 'month-%Y-%m')]) AS s(timespan)
),
counts AS (
  SELECT timespan, section, value, sum(occ) AS occ, sum(rec) AS rec
  FROM spans GROUP BY timespan, section, value
),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY timespan ORDER BY occ DESC, section, value) AS rnk
    FROM counts) WHERE rnk <= 5
),
grid AS (
  SELECT h.timespan, h.hour, t.rnk, t.section, t.value
  FROM (SELECT DISTINCT timespan, hour FROM spans) h JOIN top t ON h.timespan = t.timespan
),
hourly AS (
  SELECT g.timespan, g.hour, epoch_ms(g.hour) AS hour_ms, g.rnk, g.section, g.value,
         coalesce(c.rec, 0) AS n, coalesce(c.occ, 0) AS occ
  FROM grid g LEFT JOIN cube c ON c.hour = g.hour AND c.section = g.section AND c.value = g.value
)"""

PREFIX = ("CASE section WHEN 'Keywords' THEN 'kw-' WHEN 'Sectors' THEN 'sec-' "
          "WHEN 'Groups' THEN 'g-' WHEN 'Statuses' THEN 'st-' END")


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def trend_sql(fixture: str, body: str) -> str:
    return with_ctes(MSG_FIXTURES[fixture], TREND_BASE, body=body)


TIMESERIES_LONG_BODY = f"""
SELECT timespan, hour_ms, CAST(rnk AS INTEGER) AS rank, {PREFIX} || value AS label,
       CAST(n AS BIGINT) AS n, CAST(occ AS BIGINT) AS occurrences
FROM hourly"""

SECTION_COUNTS_BODY = """
SELECT timespan, section, value, CAST(occ AS BIGINT) AS occurrences, CAST(rec AS BIGINT) AS records
FROM counts"""

TOPK_BODY = """
SELECT timespan, CAST(rnk AS INTEGER) AS rank, section, value,
       CAST(occ AS BIGINT) AS occurrences, CAST(rec AS BIGINT) AS records
FROM top"""

HOURLY_BODY = """
SELECT timespan, hour_ms, CAST(rnk AS INTEGER) AS rank, section, value,
       CAST(n AS BIGINT) AS n, CAST(occ AS BIGINT) AS occurrences
FROM hourly"""

DISTINCT_SPANS_BODY = "SELECT DISTINCT timespan FROM spans"

DOCUMENTS_BODY = f"""
SELECT d.timespan, l.labels, d.graph_data FROM (
  SELECT timespan, '[' || string_agg(rw, ',' ORDER BY hour_ms) || ']' AS graph_data FROM (
    SELECT timespan, hour_ms,
           '[' || hour_ms || ',' || string_agg(CAST(n AS VARCHAR), ',' ORDER BY rnk) || ']' AS rw
    FROM hourly GROUP BY timespan, hour_ms) GROUP BY timespan) d
JOIN (
  SELECT timespan, 'x,' || string_agg({PREFIX} || value, ',' ORDER BY rnk) AS labels
  FROM top GROUP BY timespan) l ON d.timespan = l.timespan"""


# ---------------------------------------------------------------- tagging

SPLIT = "'[ ,.]'"


def values_table(name: str, cols: str, rows: list[tuple]) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({cols}) AS (SELECT * FROM (VALUES {body}) AS v({cols}))"


def fuzzy_sql(a: str, b: str, use_jw: bool = True) -> str:
    """F6 restated in SQL: equality, or common substring of ceil(0.8·max) and JW > 0.5."""
    mx = f"greatest(length({a}), length({b}))"
    mn = f"least(length({a}), length({b}))"
    k = f"(({mx} * 4 + 4) // 5)"
    cond = (
        f"({mn} * 5 >= {mx} * 4 AND {mx} >= 5 AND "
        f"len(list_filter(range(1, length({a}) - {k} + 2), lambda i: contains({b}, substring({a}, i, {k})))) > 0"
    )
    if use_jw:
        cond += f" AND jaro_winkler_similarity({a}, {b}) > 0.5"
    return f"({a} = {b} OR {cond}))"


def candidates_sql(src: str, max_words: int) -> str:
    """(id, lang, n, term): distinct tokens (n = 1) and every n-gram of ``tok``."""
    parts = [f"SELECT id, lang, 1 AS n, unnest(list_distinct(tok)) AS term FROM {src}"]
    for n in range(2, max_words + 1):
        parts.append(
            f"SELECT id, lang, {n} AS n, unnest(list_transform(range(1, len(tok) - {n} + 2), "
            f"lambda i: array_to_string(tok[i:i + {n - 1}], ' '))) AS term FROM {src}"
        )
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ")"


DOC_TOK = f"""
dm AS (SELECT doc_id AS id, lang, string_split_regex(lower(text), {SPLIT}) AS tok FROM documents)"""

PART_TOK = f"""
pm AS (SELECT p_partkey AS id, 'en' AS lang, string_split_regex(lower(p_name), {SPLIT}) AS tok FROM part)"""

TOKENS = f"""WITH {DOC_TOK.strip()},
u AS (SELECT id, x.v AS v, x.i AS i
      FROM (SELECT id, unnest(list_transform(tok, lambda v, i: {{'v': v, 'i': i}})) AS x FROM dm)),
f AS (SELECT id, v, min(i) AS i FROM u GROUP BY id, v),
d AS (SELECT id, count(*) AS n, md5(string_agg(v, '|' ORDER BY i)) AS h FROM f GROUP BY id)
SELECT dm.id AS doc_id, CAST(len(dm.tok) AS BIGINT) AS n_tokens, CAST(d.n AS BIGINT) AS n_distinct,
       d.h AS tokens_md5
FROM dm JOIN d ON dm.id = d.id"""

NGRAMS = f"""WITH {DOC_TOK.strip()},
g AS (SELECT id,
        list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1]) AS bi,
        list_transform(range(1, len(tok) - 1), lambda i: tok[i] || ' ' || tok[i + 1] || ' ' || tok[i + 2]) AS tri
      FROM dm)
SELECT id AS doc_id, CAST(len(bi) AS BIGINT) AS n_bigrams,
       CAST(len(list_distinct(tri)) AS BIGINT) AS n_trigrams_distinct,
       md5(array_to_string(bi, '|')) AS bigrams_md5
FROM g"""


def keyword_match_sql(msg_cte: str, src: str, dict_rows: list[tuple], fuzzy: bool, where: str = "") -> str:
    max_words = max(len(k.split(" ")) for _, k in dict_rows)
    kw = values_table("kw", "lang, keyword", dict_rows)
    match = fuzzy_sql("kw.keyword", "c.term") if fuzzy else "(kw.keyword = c.term)"
    return f"""WITH {msg_cte.strip()}, {kw},
c AS ({candidates_sql(src, max_words)})
SELECT c.id AS id, kw.keyword AS keyword, count(*) AS n
FROM c JOIN kw ON c.lang = kw.lang AND c.n = len(string_split(kw.keyword, ' '))
WHERE {match} {where}
GROUP BY c.id, kw.keyword"""


def doc_pairs_sql(dict_rows: list[tuple]) -> str:
    kw = values_table("kw", "lang, key", dict_rows)
    return f"""WITH {DOC_TOK.strip()}, {kw},
vocab AS (SELECT DISTINCT lang, unnest(tok) AS term FROM dm),
kg AS (SELECT lang, key, unnest(list_distinct(list_transform(range(1, length(key) - 2), lambda i: substring(key, i, 4)))) AS gram FROM kw),
vg AS (SELECT lang, term, unnest(list_distinct(list_transform(range(1, length(term) - 2), lambda i: substring(term, i, 4)))) AS gram FROM vocab WHERE length(term) >= 4),
pairs AS (SELECT DISTINCT vg.term AS term, kg.key AS key FROM vg JOIN kg ON vg.lang = kg.lang AND vg.gram = kg.gram
          WHERE greatest(length(vg.term), length(kg.key)) >= 5
            AND least(length(vg.term), length(kg.key)) * 5 >= greatest(length(vg.term), length(kg.key)) * 4)"""


LCS_BODY = """
SELECT term, key, CAST(list_max(list_transform(range(1, length(key) + 1), lambda L:
         CASE WHEN L <= length(term) AND len(list_filter(range(1, length(key) - L + 2),
              lambda i: contains(term, substring(key, i, L)))) > 0 THEN L ELSE 0 END)) AS BIGINT) AS lcs
FROM pairs"""

# DuckDB compares bytes: letters outside ASCII become unused capitals, one to one on both sides.
_LETTERS = ("éèêçàâîôûùëïœæäöüßñáíóúìò", "ABCDEFGHIJKLMNOPQRSTUVWXY")
JW_BODY = f"""
SELECT term, key, round(jaro_winkler_similarity(translate(key, '{_LETTERS[0]}', '{_LETTERS[1]}'),
                                                translate(term, '{_LETTERS[0]}', '{_LETTERS[1]}')), 6) AS jw
FROM pairs"""


def fuzzy_pairs_docs_sql(dict_rows: list[tuple]) -> str:
    kw = values_table("kw", "lang, key", dict_rows)
    return f"""WITH {DOC_TOK.strip()}, {kw},
vocab AS (SELECT DISTINCT lang, unnest(tok) AS term FROM dm)
SELECT v.lang, v.term, kw.key FROM vocab v JOIN kw ON v.lang = kw.lang
WHERE v.term <> kw.key AND {fuzzy_sql('kw.key', 'v.term')}"""


def category_rows(lines: list[str], lang: str = "en") -> list[tuple]:
    rows = []
    for seq, line in enumerate(lines, start=1):
        f = [x.strip() for x in line.lower().split(",")]
        rows += [(lang, f[0], k, seq) for k in f[1:]]
    return rows


def category_match_sql(lines: list[str], mode: str = "any", phrases: bool = True, on_conflict: str = "last") -> str:
    rows = category_rows(lines)
    cat = values_table("cat", "lang, category, keyword, seq", rows)
    max_words = max(len(r[2].split(" ")) for r in rows) if phrases else 1
    if on_conflict == "last":
        table = "SELECT lang, keyword, arg_max(category, seq) AS category FROM cat GROUP BY lang, keyword"
    else:
        table = "SELECT DISTINCT lang, keyword, category FROM cat"
    head = f"""WITH {PART_TOK.strip()}, {cat},
c AS (SELECT DISTINCT id, lang, term FROM ({candidates_sql('pm', max_words)})),
t AS ({table})"""
    if mode == "any":
        return head + "\nSELECT DISTINCT c.id AS id, t.category FROM c JOIN t ON c.lang = t.lang AND c.term = t.keyword"
    return head + """,
need AS (SELECT lang, category, count(DISTINCT keyword) AS need FROM cat GROUP BY lang, category),
have AS (SELECT c.id, c.lang, d.category, count(DISTINCT c.term) AS have
         FROM c JOIN (SELECT DISTINCT lang, keyword, category FROM cat) d ON c.lang = d.lang AND c.term = d.keyword
         GROUP BY c.id, c.lang, d.category)
SELECT have.id AS id, have.category FROM have JOIN need ON have.lang = need.lang AND have.category = need.category
WHERE have.have = need.need"""


ROUTE_SOURCE = """
SELECT doc_id,
       CASE WHEN doc_id % 2 = 1 THEN 'twitter' ELSE source END AS Source,
       CASE WHEN doc_id % 2 = 1 AND lang = 'es' THEN 'id' ELSE lang END AS Language,
       md5(CASE WHEN doc_id % 2 = 1 THEN text ELSE 'nlp: ' || text END) AS sentence_md5
FROM documents"""

KEYWORD_DICTIONARY = """
SELECT DISTINCT 'en' AS lang, trim(k) AS keyword
FROM (SELECT unnest(string_split(lower(upper(p_name) || ' , ' || p_type || ','), ',')) AS k FROM part)"""

CATEGORY_DICTIONARY = """
WITH lines AS (SELECT p_partkey AS seq, string_split(lower(concat_ws(',', p_brand, p_name, lower(p_type))), ',') AS f FROM part),
cat AS (SELECT seq, trim(f[1]) AS category, trim(unnest(f[2:])) AS keyword FROM lines)
SELECT 'en' AS lang, keyword, arg_max(category, seq) AS category FROM cat GROUP BY keyword"""

TRACK_LIST = """
WITH t AS (SELECT p_partkey AS seq, x.i AS i, trim(lower(x.v)) AS term
           FROM (SELECT p_partkey, unnest(list_transform(string_split(concat_ws(',', p_name, p_type), ','),
                                                        lambda v, i: {'v': v, 'i': i})) AS x FROM part)),
n AS (SELECT row_number() OVER (ORDER BY seq, i) AS pos, term, count(*) OVER () AS total FROM t)
SELECT CAST(pos AS BIGINT) AS pos, term FROM n WHERE total <= 400 OR pos <= 399"""


TRACK_LIST_UNCAPPED = TRACK_LIST[: TRACK_LIST.index("\nSELECT CAST")] + "\nSELECT CAST(pos AS BIGINT) AS pos, term FROM n"

TRACK_LIST_DROPPED = TRACK_LIST_UNCAPPED + " WHERE total > 400 AND pos >= 400"

TOKENS_MIXED = """
SELECT doc_id, md5(array_to_string(string_split_regex(lower(text), '[ ,.]'), '|')) AS tokens_md5 FROM documents"""


def tag_shuffled_sql(dict_rows: list[tuple]) -> str:
    kw = values_table("kw", "lang, keyword", dict_rows)
    words = max(len(k.split(" ")) for _, k in dict_rows)
    return f"""WITH {PART_TOK.strip()}, {kw},
c AS ({candidates_sql("pm", words)}),
m AS (SELECT c.id, kw.keyword, count(*) AS k FROM c JOIN kw ON c.lang = kw.lang AND c.n = len(string_split(kw.keyword, ' '))
      WHERE {fuzzy_sql("kw.keyword", "c.term")} GROUP BY c.id, kw.keyword)
SELECT p.p_name AS name, m.keyword, CAST(sum(m.k) AS BIGINT) AS n
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN m ON m.id = p.p_partkey GROUP BY p.p_name, m.keyword"""


# ---------------------------------------------------------------- geo

def centre_sql(x: str, y: str, z: str) -> tuple[str, str]:
    """(lat, lon) SQL of a summed vector, rounded to 6, NULL for a zero vector."""
    hyp = f"sqrt({x} * {x} + {y} * {y})"
    zero = f"({hyp} < 1e-12 AND abs({z}) < 1e-12)"
    lat = f"CASE WHEN {zero} THEN NULL ELSE round(degrees(atan2({z}, {hyp})), 6) + 0.0 END"
    lon0 = f"round(degrees(atan2({y}, {x})), 6) + 0.0"
    lon = f"CASE WHEN {zero} THEN NULL WHEN {lon0} = -180.0 THEN 180.0 ELSE {lon0} END"
    return lat, lon


def vec_sql(lat: str, lon: str) -> tuple[str, str, str]:
    return (f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))",
            f"sin(radians({lat}))")


def r4(e: str) -> str:
    return f"(CAST({e} AS DOUBLE) + 0.0)"


_X, _Y, _Z = vec_sql("lat", "lon")
_CLAT, _CLON = centre_sql("sx", "sy", "sz")

USER_OBS = """
obs AS (SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(CAST(json_extract(props, '$.k') AS INTEGER) - 50 AS DOUBLE) AS lat,
               CAST((CAST(json_extract(props, '$.k') AS INTEGER) * 3) % 360 - 180 AS DOUBLE) AS lon, event_type, value
        FROM events)"""

USERS_A6 = f"""
a6 AS (SELECT user_id, {_CLAT} AS lat, {_CLON} AS lon FROM (
         SELECT user_id, sum({_X}) AS sx, sum({_Y}) AS sy, sum({_Z}) AS sz
         FROM (SELECT DISTINCT user_id, lat, lon FROM obs) GROUP BY user_id))"""

GEO_CENTER = f"""WITH {USER_OBS.strip()}
SELECT user_id, {r4(_CLAT)} AS lat, {r4(_CLON)} AS lon FROM (
  SELECT user_id, sum({_X}) AS sx, sum({_Y}) AS sy, sum({_Z}) AS sz FROM obs GROUP BY user_id)"""

USER_CENTROID = f"""WITH {USER_OBS.strip()}, {USERS_A6.strip()}
SELECT user_id, {r4('lat')} AS lat, {r4('lon')} AS lon, CAST(1.0 AS DOUBLE) AS confidence FROM a6"""

CONDENSE = """WITH """ + USER_OBS.strip() + """
SELECT user_id, CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) AS key, count(*) AS occurrences
FROM obs GROUP BY user_id, lat, lon"""

_BX = ("(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 1 END)")
BBOX_CENTER = """
WITH b AS (SELECT c_custkey, c_custkey % 7 = 0 AS nonpoly, CAST(c_nationkey * 5 - 60 AS DOUBLE) AS plat,
                  CAST(c_nationkey * 12 - 144 AS DOUBLE) AS plon, CAST(c_custkey % 5 + 1 AS DOUBLE) AS d FROM customer),
corners AS (SELECT c_custkey, nonpoly, unnest([plat - d, plat - d, plat + d, plat + d]) AS lat,
                   unnest([plon - d, plon + d, plon + d, plon - d]) AS lon FROM b),
s AS (SELECT c_custkey, bool_or(nonpoly) AS nonpoly, """ + f"sum({_X}) AS sx, sum({_Y}) AS sy, sum({_Z}) AS sz" + """
      FROM corners GROUP BY c_custkey)
SELECT c_custkey, CASE WHEN nonpoly THEN NULL ELSE """ + r4(_CLAT) + """ END AS lat,
       CASE WHEN nonpoly THEN NULL ELSE """ + r4(_CLON) + """ END AS lon FROM s"""

GEO_CUST = f"""
gc AS (SELECT c.c_custkey AS id, c.c_custkey % 3 AS kind,
         CASE WHEN c.c_custkey % 3 = 2 THEN 'crm' ELSE 'twitter' END AS source,
         CAST(n.n_nationkey * 5 - 60 AS DOUBLE) AS plat, CAST(n.n_nationkey * 12 - 144 AS DOUBLE) AS plon,
         CASE WHEN c.c_custkey % 3 = 0 AND c.c_custkey % 9 = 3 THEN '{{}}'
              WHEN c.c_custkey % 3 = 0 AND c.c_custkey % 9 = 6 THEN 'not json'
              WHEN c.c_custkey % 3 = 0 THEN 'point'
              WHEN c.c_custkey % 3 = 1 THEN ''
              ELSE lower(r.r_name) || CASE WHEN c.c_custkey % 2 = 1 THEN 's' ELSE '' END END AS geo,
         string_split_regex(lower(concat_ws(' ', c.c_name, n.n_name, r.r_name)), {SPLIT}) AS tok
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

GEO_POINTS = "WITH " + GEO_CUST.strip() + """
SELECT id, CASE WHEN geo = 'point' THEN plat END AS lat_ll, CASE WHEN geo = 'point' THEN plon END AS lon_ll,
       CASE WHEN geo = 'point' THEN plon END AS lat_gj, CASE WHEN geo = 'point' THEN plat END AS lon_gj
FROM gc"""

GAZ_REGIONS = """
gz_r AS (SELECT 'en' AS lang, lower(r_name) AS name, CAST(r_regionkey * 10 - 20 AS DOUBLE) AS lat,
                CAST(r_regionkey * 30 - 60 AS DOUBLE) AS lon, CAST(r_regionkey AS BIGINT) AS seq FROM region)"""

GAZ_NATIONS = """
gz_n AS (SELECT 'en' AS lang, lower(n_name) AS name, CAST(n_nationkey * 5 - 60 AS DOUBLE) AS lat,
                CAST(n_nationkey * 12 - 144 AS DOUBLE) AS lon, CAST(n_nationkey AS BIGINT) AS seq FROM nation)"""

GAZ_WORLD = """
gz_w AS (SELECT * FROM gz_r UNION ALL SELECT lang, name, lat, lon, seq + 100 FROM gz_n)"""


def first_hit_sql(terms: str, gz: str, prefer_exact: bool = False) -> str:
    """(lang, term) → first fuzzy gazetteer hit (name, lat, lon) by seq."""
    order = "struct_pack(ne := g.name <> t.term, s := g.seq)" if prefer_exact else "g.seq"
    return f"""SELECT t.lang, t.term, arg_min(struct_pack(name := g.name, lat := g.lat, lon := g.lon), {order}) AS h
FROM (SELECT DISTINCT lang, term FROM {terms}) t JOIN {gz} g ON t.lang = g.lang
WHERE {fuzzy_sql('g.name', 't.term')}
GROUP BY t.lang, t.term"""


def content_sql(prefer_exact: bool) -> str:
    return f"""WITH {GEO_CUST.strip()}, {GAZ_NATIONS.strip()},
toks AS (SELECT DISTINCT id, 'en' AS lang, unnest(tok) AS term FROM gc),
toks2 AS (SELECT * FROM toks WHERE length(term) >= 2),
fh AS ({first_hit_sql('toks2', 'gz_n', prefer_exact)})
SELECT toks2.id, toks2.term, fh.h.name AS name, fh.h.lat AS lat, fh.h.lon AS lon
FROM toks2 JOIN fh ON toks2.lang = fh.lang AND toks2.term = fh.term"""


USER_TEXT = f"""WITH {GEO_CUST.strip()}, {GAZ_REGIONS.strip()},
ut AS (SELECT id, 'en' AS lang, lower(geo) AS term FROM gc WHERE kind = 2 AND length(lower(geo)) >= 2),
fh AS ({first_hit_sql('ut', 'gz_r')})
SELECT ut.id, fh.h.name AS name, fh.h.lat AS lat, fh.h.lon AS lon FROM ut JOIN fh ON ut.lang = fh.lang AND ut.term = fh.term"""

USER_JOIN = f"""WITH {GEO_CUST.strip()}, {USER_OBS.strip()}, {USERS_A6.strip()}
SELECT gc.id, {r4('a6.lat')} AS lat, {r4('a6.lon')} AS lon, CAST(1.0 AS DOUBLE) AS confidence
FROM gc JOIN a6 ON CAST(gc.id AS VARCHAR) = a6.user_id WHERE gc.source = 'twitter' AND a6.lat IS NOT NULL"""

RESOLVE = f"""WITH {GEO_CUST.strip()}, {USER_OBS.strip()}, {USERS_A6.strip()}, {GAZ_REGIONS.strip()},
{GAZ_NATIONS.strip()}, {GAZ_WORLD.strip()},
tagged AS (SELECT id, 'Tagged' AS inference_type, plat AS lat, plon AS lon, CAST(1.0 AS DOUBLE) AS probability
           FROM gc WHERE kind = 0 AND geo = 'point'),
ut AS (SELECT id, 'en' AS lang, lower(geo) AS term FROM gc WHERE kind = 2 AND trim(geo) <> '' AND length(lower(geo)) >= 2),
uh AS ({first_hit_sql('ut', 'gz_w')}),
usertagged AS (SELECT ut.id, 'UserTagged' AS inference_type, uh.h.lat AS lat, uh.h.lon AS lon, CAST(1.0 AS DOUBLE) AS probability
               FROM ut JOIN uh ON ut.lang = uh.lang AND ut.term = uh.term),
untagged AS (SELECT * FROM gc WHERE id NOT IN (SELECT id FROM tagged) AND id NOT IN (SELECT id FROM usertagged)),
toks AS (SELECT DISTINCT id, 'en' AS lang, unnest(tok) AS term FROM untagged),
toks2 AS (SELECT * FROM toks WHERE length(term) >= 2),
ch AS ({first_hit_sql('toks2', 'gz_w')}),
content AS (SELECT toks2.id, 'Content' AS inference_type, ch.h.lat AS lat, ch.h.lon AS lon, CAST(1.0 AS DOUBLE) AS probability
            FROM toks2 JOIN ch ON toks2.lang = ch.lang AND toks2.term = ch.term),
handle AS (SELECT gc.id, 'TwitterUserHandle' AS inference_type, a6.lat, a6.lon, CAST(1.0 AS DOUBLE) AS probability
           FROM gc JOIN a6 ON CAST(gc.id AS VARCHAR) = a6.user_id WHERE gc.source = 'twitter' AND a6.lat IS NOT NULL)
SELECT id, inference_type, {r4('lat')} AS lat, {r4('lon')} AS lon, probability FROM (
  SELECT * FROM tagged UNION ALL SELECT * FROM usertagged UNION ALL SELECT * FROM content UNION ALL SELECT * FROM handle)"""

TRACK_FILTER = "WITH " + GEO_CUST.strip() + """,
m AS (SELECT gc.*, lower(concat_ws(' ', c.c_name, n.n_name, r.r_name)) AS text
      FROM gc JOIN customer c ON gc.id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT id FROM m
WHERE (contains(text, 'asia') OR contains(text, 'europe')
       OR (geo = 'point' AND plat BETWEEN -60.0 AND -30.0 AND plon BETWEEN -150.0 AND -60.0))"""


# ---------------------------------------------------------------- graph

EDGES = """
edges AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) AS src, 'o' || CAST(o_orderkey AS VARCHAR) AS dst FROM orders
          UNION ALL
          SELECT 'o' || CAST(l_orderkey AS VARCHAR), 's' || CAST(l_suppkey AS VARCHAR) FROM lineitem)"""

REPLY_EDGES = "WITH " + EDGES.strip() + "\nSELECT DISTINCT src, dst FROM edges"

ADJACENCY = "WITH " + EDGES.strip() + """,
e AS (SELECT DISTINCT src, dst FROM edges),
o AS (SELECT src AS user_id, count(*) AS n, min(dst) AS f, max(dst) AS l FROM e GROUP BY src),
i AS (SELECT dst AS user_id, count(*) AS n, min(src) AS f, max(src) AS l FROM e GROUP BY dst)
SELECT coalesce(o.user_id, i.user_id) AS user_id,
       CAST(coalesce(o.n, 0) AS BIGINT) AS n_to, CAST(coalesce(i.n, 0) AS BIGINT) AS n_by,
       o.f AS first_to, o.l AS last_to, i.f AS first_by, i.l AS last_by
FROM o FULL OUTER JOIN i ON o.user_id = i.user_id"""


ADJACENCY_LISTS = "WITH " + EDGES.strip() + """
SELECT DISTINCT src AS user_id, 'to' AS direction, dst AS neighbour FROM edges
UNION SELECT DISTINCT dst, 'by', src FROM edges"""

PLACE_OBSERVATIONS = """
SELECT c_custkey % 40 AS user_id, 'place' AS kind, 'p' || CAST(c_nationkey AS VARCHAR) AS key, count(*) AS occurrences
FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1, c_nationkey"""


def propagate_sql(iterations: int, body: str) -> str:
    ctes = [EDGES.strip(), """
und AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges) WHERE src <> dst),
anchors AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS user_id, CAST(s_nationkey * 5 - 60 AS DOUBLE) AS lat,
                   CAST(s_nationkey * 12 - 144 AS DOUBLE) AS lon FROM supplier),
users AS (SELECT DISTINCT user_id FROM (SELECT src AS user_id FROM edges UNION ALL SELECT dst FROM edges
                                        UNION ALL SELECT user_id FROM anchors)),
s0 AS (SELECT u.user_id, a.user_id IS NOT NULL AS anchor, NULL::DOUBLE AS llat, NULL::DOUBLE AS llon,
              0 AS ninf, false AS isnew
       FROM users u LEFT JOIN anchors a ON u.user_id = a.user_id)""".strip()]
    x, y, z = vec_sql("l.lat", "l.lon")
    for t in range(1, iterations + 1):
        prev = f"s{t - 1}"
        if t == 1:
            loc = "SELECT user_id, lat, lon FROM anchors"
        else:
            loc = f"SELECT user_id, lat, lon FROM anchors UNION ALL SELECT user_id, llat, llon FROM {prev} WHERE NOT anchor AND llat IS NOT NULL"
        ctes.append(f"""loc{t} AS ({loc}),
cen{t} AS (SELECT user_id, {_CLAT} AS lat, {_CLON} AS lon FROM (
  SELECT und.src AS user_id, sum({x}) AS sx, sum({y}) AS sy, sum({z}) AS sz
  FROM und JOIN loc{t} l ON und.dst = l.user_id GROUP BY und.src))""")
        found = "(NOT s.anchor AND c.lat IS NOT NULL)"
        if t < iterations:
            if t == 1:
                llat, llon = f"CASE WHEN {found} THEN c.lat END", f"CASE WHEN {found} THEN c.lon END"
                ninf = f"CASE WHEN {found} THEN 1 ELSE 0 END"
                isnew = found
            else:
                llat = f"CASE WHEN {found} THEN c.lat ELSE s.llat END"
                llon = f"CASE WHEN {found} THEN c.lon ELSE s.llon END"
                ninf = f"CASE WHEN {found} THEN s.ninf + 1 ELSE s.ninf END"
                isnew = f"({found} AND s.ninf = 0)"
            ctes.append(f"""s{t} AS (SELECT s.user_id, s.anchor, {llat} AS llat, {llon} AS llon, {ninf} AS ninf, {isnew} AS isnew
  FROM {prev} s LEFT JOIN cen{t} c ON s.user_id = c.user_id)""")
        else:
            ctes.append(f"""fin AS (SELECT s.user_id, s.anchor, s.ninf, CASE WHEN {found} THEN c.lat END AS flat,
  CASE WHEN {found} THEN c.lon END AS flon FROM {prev} s LEFT JOIN cen{t} c ON s.user_id = c.user_id)""")
    ctes.append("""result AS (SELECT f.user_id,
  CASE WHEN f.anchor THEN a.lat WHEN f.flat IS NOT NULL THEN f.flat END AS lat,
  CASE WHEN f.anchor THEN a.lon WHEN f.flat IS NOT NULL THEN f.flon END AS lon,
  CAST(CASE WHEN f.anchor THEN 1.0 WHEN f.flat IS NOT NULL THEN 0.5 END AS DOUBLE) AS confidence,
  CAST(f.ninf AS BIGINT) AS n_inferred
  FROM fin f LEFT JOIN anchors a ON f.user_id = a.user_id)""")
    return "WITH " + ",\n".join(ctes) + "\n" + body


PROPAGATE_BODY = f"SELECT user_id, {r4('lat')} AS lat, {r4('lon')} AS lon, confidence, n_inferred FROM result"


def metrics_body(iterations: int) -> str:
    parts = [f"SELECT {t} AS iteration, CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER (WHERE isnew) AS BIGINT) AS inferences FROM s{t}"
             for t in range(1, iterations)]
    parts.append(f"SELECT {iterations} AS iteration, CAST(count(*) AS BIGINT) AS processed, CAST(0 AS BIGINT) AS inferences FROM fin")
    return "SELECT CAST(iteration AS INTEGER) AS iteration, processed, inferences FROM (" + " UNION ALL ".join(parts) + ")"


MERGE_USERS = f"""WITH {USER_OBS.strip()}, {USERS_A6.strip()},
clicks AS (SELECT user_id, lat, lon FROM obs WHERE event_type = 'click'),
cw AS (SELECT user_id, lat, lon, count(*) AS w FROM clicks GROUP BY user_id, lat, lon),
new AS (SELECT user_id, {_CLAT} AS lat, {_CLON} AS lon FROM (
  SELECT user_id, sum(w * {_X.replace('lat', 'cw.lat').replace('lon', 'cw.lon')}) AS sx,
         sum(w * {_Y.replace('lat', 'cw.lat').replace('lon', 'cw.lon')}) AS sy,
         sum(w * {_Z.replace('lat', 'cw.lat')}) AS sz FROM cw GROUP BY user_id))
SELECT coalesce(n.user_id, o.user_id) AS user_id,
       {r4('CASE WHEN n.user_id IS NOT NULL AND n.lat IS NOT NULL THEN n.lat ELSE o.lat END')} AS lat,
       {r4('CASE WHEN n.user_id IS NOT NULL AND n.lat IS NOT NULL THEN n.lon ELSE o.lon END')} AS lon,
       CAST(CASE WHEN n.user_id IS NOT NULL AND n.lat IS NOT NULL THEN 0.5 WHEN o.lat IS NOT NULL THEN 1.0 END AS DOUBLE) AS confidence
FROM a6 o FULL OUTER JOIN new n ON o.user_id = n.user_id"""


# ---------------------------------------------------------------- ingest and streams

TWEETS_J = """
j AS (SELECT e.event_id, e.ts, e.user_id, e.event_type, CAST(json_extract(e.props, '$.k') AS INTEGER) AS k,
             d.text, d.lang AS dlang
      FROM events e LEFT JOIN documents d ON e.event_id % (SELECT count(*) FROM documents) = d.doc_id)"""

TWEET_ROW = "WITH " + TWEETS_J.strip() + """
SELECT CAST(floor((epoch_us(ts) // 1000) / 86400000) AS BIGINT) AS epoch_day, event_id AS id, user_id,
       'u' || CAST(user_id AS VARCHAR) AS user_screen_name, epoch_us(ts) // 1000 AS timestamp,
       CASE WHEN dlang = 'es' THEN 'in' ELSE dlang END AS lang,
       CASE WHEN event_type = 'click' THEN (user_id * 7) % 150 END AS in_reply_to,
       md5(text) AS text_md5,
       CASE WHEN event_type = 'view' THEN '{"type":"Point","coordinates":[' || CAST(k - 50 AS VARCHAR) || ','
            || CAST((k * 3) % 360 - 180 AS VARCHAR) || ']}' END AS geo
FROM j WHERE event_type <> 'error'"""

TWEET_ENVELOPE = "WITH " + TWEETS_J.strip() + """
SELECT event_id AS id, strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at,
       'twitter' AS source, CASE WHEN dlang = 'es' THEN 'in' ELSE dlang END AS lang,
       CAST(user_id AS VARCHAR) AS user_id, md5(text) AS text_md5
FROM j WHERE event_type <> 'error'"""

USER_STATE = "WITH " + TWEETS_J.strip() + f""",
t AS (SELECT user_id, (user_id * 7) % 150 AS target, event_type, CAST(k - 50 AS DOUBLE) AS lat,
             CAST((k * 3) % 360 - 180 AS DOUBLE) AS lon FROM j WHERE event_type <> 'error'),
u AS (SELECT user_id FROM t UNION SELECT target FROM t WHERE event_type = 'click'),
e AS (SELECT DISTINCT user_id AS src, target AS dst FROM t WHERE event_type = 'click'),
p AS (SELECT DISTINCT user_id, lat, lon FROM t WHERE event_type = 'view'),
c AS (SELECT user_id, count(*) AS n, sum({_X}) AS sx, sum({_Y}) AS sy, sum({_Z}) AS sz FROM p GROUP BY user_id)
SELECT u.user_id, coalesce(c.n, 0) AS n_points, CAST(0 AS BIGINT) AS n_places,
       (SELECT count(*) FROM e WHERE e.src = u.user_id) AS n_to, (SELECT count(*) FROM e WHERE e.dst = u.user_id) AS n_by,
       CASE WHEN c.n > 0 THEN {r4(_CLAT)} END AS lat, CASE WHEN c.n > 0 THEN {r4(_CLON)} END AS lon
FROM u LEFT JOIN c ON u.user_id = c.user_id"""

DEDUP_INSERT = "WITH " + TWEETS_J.strip() + """
SELECT CAST(floor((epoch_us(ts) // 1000) / 86400000) AS BIGINT) AS epoch_day, count(*) AS n, CAST(0 AS BIGINT) AS n_resent
FROM j WHERE event_type <> 'error' GROUP BY 1"""

BAD_RECORDS = """
SELECT reason, count(*) AS n FROM (
  SELECT CASE event_type WHEN 'error' THEN 'bad_created' WHEN 'purchase' THEN 'missing_created' ELSE 'ok' END AS reason
  FROM events
  UNION ALL
  SELECT CASE WHEN trim(l) = '' THEN 'empty'
              WHEN NOT json_valid(l) OR json_type(l) <> 'OBJECT' THEN 'malformed'
              ELSE 'object' END
  FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents))
GROUP BY reason"""

HOURLY_STREAM_BODY = """
SELECT epoch_ms(hour) AS hour_ms, section, value, CAST(occ AS BIGINT) AS occurrences, CAST(rec AS BIGINT) AS records
FROM cube"""

LATE_EVENTS = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"


# ---------------------------------------------------------------- extensions and remaining operators

def _tile_base() -> str:
    """TREND_BASE with a ``tile`` key added to every grouping."""
    reps = [
        ("SELECT date_trunc('hour', Created) AS hour, e.section", "SELECT date_trunc('hour', Created) AS hour, tile, e.section"),
        ("FROM (SELECT Created, unnest(", "FROM (SELECT Created, tile, unnest("),
        ("SELECT hour, section, value, count(*) AS occ", "SELECT hour, tile, section, value, count(*) AS occ"),
        ("FROM entries GROUP BY hour, section, value", "FROM entries GROUP BY hour, tile, section, value"),
        ("SELECT s.timespan, hour, section", "SELECT s.timespan, tile, hour, section"),
        ("SELECT timespan, section, value, sum(occ)", "SELECT timespan, tile, section, value, sum(occ)"),
        ("FROM spans GROUP BY timespan, section, value", "FROM spans GROUP BY timespan, tile, section, value"),
        ("PARTITION BY timespan ORDER BY", "PARTITION BY timespan, tile ORDER BY"),
        ("SELECT h.timespan, h.hour, t.rnk", "SELECT h.timespan, h.tile, h.hour, t.rnk"),
        ("FROM (SELECT DISTINCT timespan, hour FROM spans) h JOIN top t ON h.timespan = t.timespan",
         "FROM (SELECT DISTINCT timespan, tile, hour FROM spans) h JOIN top t ON h.timespan = t.timespan AND h.tile = t.tile"),
        ("SELECT g.timespan, g.hour,", "SELECT g.timespan, g.tile, g.hour,"),
        ("LEFT JOIN cube c ON c.hour = g.hour AND", "LEFT JOIN cube c ON c.hour = g.hour AND c.tile = g.tile AND"),
    ]
    s = TREND_BASE
    for a, b in reps:
        assert a in s, a
        s = s.replace(a, b)
    return s


MSG_EVENTS_TILED = """
msgs AS (
  SELECT CAST(event_id AS VARCHAR) AS MessageId, ts AS Created,
         [event_type] AS Keywords, []::VARCHAR[] AS Sectors,
         ['k' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 7 AS VARCHAR)] AS Groups,
         [CASE WHEN value >= 100 THEN 'high' ELSE 'low' END] AS Statuses,
         CAST(CAST(floor((CAST(json_extract(props, '$.k') AS INTEGER) - 50) / 30.0) AS BIGINT) AS VARCHAR) || '_' ||
         CAST(CAST(floor(((CAST(json_extract(props, '$.k') AS INTEGER) * 3) % 360 - 180) / 30.0) AS BIGINT) AS VARCHAR) AS tile
  FROM events
)"""

TILE_TIMESERIES = with_ctes(MSG_EVENTS_TILED, _tile_base(), body=f"""
SELECT timespan, tile, hour_ms, CAST(rnk AS INTEGER) AS rank, {PREFIX} || value AS label,
       CAST(n AS BIGINT) AS n, CAST(occ AS BIGINT) AS occurrences
FROM hourly""")


def category_confidence_sql(lines: list[str]) -> str:
    rows = category_rows(lines)
    cat = values_table("cat", "lang, category, keyword, seq", rows)
    return f"""WITH {PART_TOK.strip()}, {cat},
c AS (SELECT DISTINCT id, lang, term FROM ({candidates_sql('pm', 2)})),
need AS (SELECT lang, category, count(DISTINCT keyword) AS need FROM cat GROUP BY lang, category),
have AS (SELECT c.id, c.lang, d.category, count(DISTINCT c.term) AS have
         FROM c JOIN (SELECT DISTINCT lang, keyword, category FROM cat) d ON c.lang = d.lang AND c.term = d.keyword
         GROUP BY c.id, c.lang, d.category)
SELECT have.id AS id, have.category, round(have.have / need.need, 6) AS confidence
FROM have JOIN need ON have.lang = need.lang AND have.category = need.category"""


def translated_sql(dict_rows: list[tuple], tr_rows: list[tuple]) -> str:
    base = keyword_match_sql(DOC_TOK, "dm", dict_rows, fuzzy=True)
    body_at = base.index("\nSELECT c.id AS id")
    head = base[:body_at]
    tr = values_table("tr", "lang, term, canonical", tr_rows)
    return head + f""", {tr},
p AS (SELECT c.id, c.lang, kw.keyword FROM c JOIN kw ON c.lang = kw.lang AND c.n = len(string_split(kw.keyword, ' '))
      WHERE {fuzzy_sql('kw.keyword', 'c.term')})
SELECT p.id, coalesce(tr.canonical, p.keyword) AS canonical, count(*) AS n
FROM p LEFT JOIN tr ON p.lang = tr.lang AND p.keyword = tr.term
GROUP BY p.id, coalesce(tr.canonical, p.keyword)"""


WEIGHTED_CENTROID = f"""WITH {USER_OBS.strip()},
cw AS (SELECT user_id, lat, lon, count(*) AS w FROM obs GROUP BY user_id, lat, lon)
SELECT user_id, {r4(_CLAT)} AS lat, {r4(_CLON)} AS lon FROM (
  SELECT user_id, sum(w * {_X}) AS sx, sum(w * {_Y}) AS sy, sum(w * {_Z}) AS sz FROM cw GROUP BY user_id)"""


def fuzzy_categories_sql(lines: list[str]) -> str:
    rows = category_rows(lines)
    cat = values_table("cat", "lang, category, keyword, seq", rows)
    return f"""WITH {PART_TOK.strip()}, {cat},
c AS ({candidates_sql('pm', 2)}),
t AS (SELECT lang, keyword, arg_max(category, seq) AS category FROM cat GROUP BY lang, keyword)
SELECT DISTINCT c.id AS id, t.category FROM c JOIN t ON c.lang = t.lang AND c.n = len(string_split(t.keyword, ' '))
WHERE {fuzzy_sql('t.keyword', 'c.term')}"""


TIMESPAN_LABELS = """
SELECT event_id AS id, 'alltime' AS alltime, strftime(ts, 'year-%Y') AS year, strftime(ts, 'month-%Y-%m') AS month,
       strftime(ts, 'day-%Y-%m-%d') AS day, strftime(ts, 'hour-%Y-%m-%d%H:00') AS hour,
       epoch_ms(date_trunc('hour', ts)) AS hour_ms
FROM events"""

MATCHES_TIMESPAN = """
SELECT strftime(l.l_shipdate, 'month-%Y-%m') AS month, count(*) AS n
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE strftime(l.l_shipdate, 'year-%Y') = 'year-1997'
GROUP BY 1"""

NORMALIZE_SOURCE = """
SELECT doc_id, CASE lower(CASE doc_id % 5 WHEN 0 THEN 'rss' WHEN 1 THEN 'Twitter' WHEN 2 THEN 'facebook-messages'
                               WHEN 3 THEN 'FACEBOOK-COMMENTS' ELSE source END)
                 WHEN 'rss' THEN 0 WHEN 'twitter' THEN 1 WHEN 'facebook-messages' THEN 2
                 WHEN 'facebook-comments' THEN 3 ELSE 1 END AS code
FROM documents"""

GAZETTEER_DICTIONARY = """
WITH lines AS (
  SELECT n_name || ', ' || CAST(n_nationkey * 5 - 60 AS VARCHAR) || ',' || CAST(n_nationkey * 12 - 144 AS VARCHAR) || ' ' AS value,
         CAST(n_nationkey AS BIGINT) AS seq FROM nation
  UNION ALL SELECT r_name || ',' || CAST(r_regionkey AS VARCHAR), CAST(r_regionkey + 100 AS BIGINT) FROM region
  UNION ALL SELECT n_name || ',1.5,2.5', CAST(n_nationkey + 200 AS BIGINT) FROM nation WHERE n_regionkey = 0),
f AS (SELECT seq, string_split(value, ',') AS f FROM lines),
rows AS (SELECT seq, lower(f[1]) AS name, TRY_CAST(trim(f[2]) AS DOUBLE) AS lat, TRY_CAST(trim(f[3]) AS DOUBLE) AS lon
         FROM f WHERE len(f) = 3)
SELECT 'en' AS lang, name, arg_max(lat, seq) AS lat, arg_max(lon, seq) AS lon, min(seq) AS seq
FROM rows WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY name"""

BUILD_DICTIONARIES = """
WITH t AS (SELECT p_partkey AS seq, p_name AS term, lower(p_type) || ', ' || lower(p_brand) AS syn, upper(p_name) AS english FROM part),
x AS (SELECT seq, english, trim(term) AS t FROM t UNION ALL SELECT seq, english, trim(unnest(string_split(syn, ','))) FROM t)
SELECT 'en' AS lang, lower(t) AS term, arg_max(lower(english), seq) AS canonical FROM x WHERE length(t) > 0 GROUP BY lower(t)"""

BUILD_DICTIONARIES_KEYWORDS = BUILD_DICTIONARIES[: BUILD_DICTIONARIES.index("\nSELECT 'en'")] + """
SELECT DISTINCT 'en' AS lang, lower(t) AS keyword FROM x WHERE length(t) > 0"""

USER_BUCKETS = "WITH " + EDGES.strip() + """,
u AS (SELECT DISTINCT u FROM (SELECT src AS u FROM edges UNION ALL SELECT dst FROM edges))
SELECT substring(u, 1, 2) AS bucket, count(*) AS n FROM u GROUP BY 1"""

PRUNE_NEWLINES = "SELECT doc_id, md5(replace(replace(text, chr(10), ''), chr(13), '')) AS text_md5 FROM documents"


def write_timeseries_sql() -> str:
    return trend_sql("events", """
SELECT d.timespan AS name, md5('{"labels":["x","' || l.labels || '"],"graphData":' || d.graph_data || '}') AS doc_md5
FROM (
  SELECT timespan, '[' || string_agg(rw, ',' ORDER BY hour_ms) || ']' AS graph_data FROM (
    SELECT timespan, hour_ms,
           '[' || hour_ms || ',' || string_agg(CAST(n AS VARCHAR), ',' ORDER BY rnk) || ']' AS rw
    FROM hourly GROUP BY timespan, hour_ms) GROUP BY timespan) d
JOIN (SELECT timespan, string_agg(""" + PREFIX + """ || value, '","' ORDER BY rnk) AS labels FROM top GROUP BY timespan) l
ON d.timespan = l.timespan""")


def emit_sentence_sql(dict_rows: list[tuple], lines: list[str]) -> str:
    rows = category_rows(lines)
    cat = values_table("cat", "lang, category, keyword, seq", rows)
    kw = values_table("kw", "lang, keyword", dict_rows)
    mw = max(len(k.split(" ")) for _, k in dict_rows)
    return f"""WITH {PART_TOK.strip()}, {kw}, {cat},
c AS ({candidates_sql('pm', max(mw, 2))}),
k AS (SELECT c.id, kw.keyword FROM c JOIN kw ON c.lang = kw.lang AND c.n = len(string_split(kw.keyword, ' '))
      WHERE c.n <= {mw} AND {fuzzy_sql('kw.keyword', 'c.term')}),
t AS (SELECT lang, keyword, arg_max(category, seq) AS category FROM cat GROUP BY lang, keyword),
g AS (SELECT DISTINCT c.id, t.category FROM c JOIN t ON c.lang = t.lang AND c.term = t.keyword),
gl AS (SELECT id, string_agg(category, ',' ORDER BY category) AS groups FROM g GROUP BY id),
kl AS (SELECT id, string_agg(keyword, ',' ORDER BY keyword) AS keywords FROM k GROUP BY id)
SELECT gl.id, coalesce(kl.keywords, '') AS keywords, gl.groups FROM gl LEFT JOIN kl ON gl.id = kl.id"""


def _dist_sql(lat: str, lon: str, clat: str, clon: str) -> str:
    la1, lo1, la2, lo2 = (f"radians({x})" for x in (lat, lon, clat, clon))
    return (f"round(2 * asin(sqrt(pow(sin(({la2} - {la1}) / 2), 2) + cos({la1}) * cos({la2}) * "
            f"pow(sin(({lo2} - {lo1}) / 2), 2))), 9)")


ROBUST_CENTROID = f"""WITH {USER_OBS.strip()},
cw AS (SELECT user_id, lat, lon, count(*) AS w FROM obs GROUP BY user_id, lat, lon),
c1 AS (SELECT user_id, {_CLAT} AS clat, {_CLON} AS clon FROM (
  SELECT user_id, sum(w * {_X}) AS sx, sum(w * {_Y}) AS sy, sum(w * {_Z}) AS sz FROM cw GROUP BY user_id)),
d AS (SELECT cw.*, {_dist_sql('cw.lat', 'cw.lon', 'c1.clat', 'c1.clon')} AS dist FROM cw JOIN c1 ON cw.user_id = c1.user_id),
med AS (SELECT user_id, quantile_disc(dist, 0.5) AS med FROM d GROUP BY user_id),
kept AS (SELECT d.* FROM d JOIN med ON d.user_id = med.user_id WHERE d.dist <= med.med * 2.0)
SELECT user_id, {r4(_CLAT)} AS lat, {r4(_CLON)} AS lon FROM (
  SELECT user_id, sum(w * {_X}) AS sx, sum(w * {_Y}) AS sy, sum(w * {_Z}) AS sz FROM kept GROUP BY user_id)"""


def tag_job_sql() -> str:
    """Keywords (region names over tokens and bigrams) joined with the location cascade."""
    head = RESOLVE[: RESOLVE.index("\nSELECT id, inference_type")]
    return head + f""",
gm AS (SELECT id, 'en' AS lang, tok FROM gc),
cands AS ({candidates_sql('gm', 2)}),
kwm AS (SELECT c.id, r.name AS keyword FROM cands c JOIN gz_r r ON c.lang = r.lang
        AND c.n = len(string_split(r.name, ' ')) WHERE {fuzzy_sql('r.name', 'c.term')}),
kl AS (SELECT id, string_agg(keyword, ',' ORDER BY keyword) AS keywords, count(*) AS nk FROM kwm GROUP BY id),
locs AS (SELECT id, count(*) AS nl FROM (
  SELECT id FROM tagged UNION ALL SELECT id FROM usertagged UNION ALL SELECT id FROM content
  UNION ALL SELECT id FROM handle) GROUP BY id)
SELECT gc.id, coalesce(kl.keywords, '') AS keywords, CAST(coalesce(locs.nl, 0) AS BIGINT) AS n_locations,
       coalesce(locs.nl, 0) > 0 AS has_locations, coalesce(kl.nk, 0) = 0 AS no_signal
FROM gc LEFT JOIN kl ON gc.id = kl.id LEFT JOIN locs ON gc.id = locs.id"""


def keyword_messages_sql() -> str:
    base = tag_job_sql()
    head = base[: base.index("\nSELECT gc.id, coalesce(kl.keywords")]
    return head + """
SELECT kwm.keyword, gc.source AS Source, count(*) AS n, count(*) FILTER (WHERE coalesce(locs.nl, 0) > 0) AS n_located
FROM kwm JOIN gc ON kwm.id = gc.id LEFT JOIN locs ON kwm.id = locs.id
GROUP BY kwm.keyword, gc.source"""


FAN_OUT_DEAD_LETTERS = "WITH " + TWEETS_J.strip() + """,
good AS (SELECT CAST(event_id AS VARCHAR) AS item FROM j WHERE event_type <> 'error'),
bad AS (
    SELECT CASE k % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing_id' WHEN 2 THEN 'missing_time' WHEN 3 THEN 'missing_user' ELSE 'empty' END AS reason,
           CASE k % 5 WHEN 0 THEN '{"id":' || CAST(event_id AS VARCHAR) || ',"timestamp_ms":"0","text":"cut'
                      WHEN 1 THEN '{"timestamp_ms":"' || CAST(event_id AS VARCHAR) || '","user":{"id":1}}'
                      WHEN 2 THEN '{"id":' || CAST(event_id AS VARCHAR) || ',"timestamp_ms":"soon","user":{"id":1}}'
                      WHEN 3 THEN '{"id":' || CAST(event_id AS VARCHAR) || ',"timestamp_ms":"5"}' ELSE ' ' END AS line FROM j
    UNION ALL
    SELECT CASE WHEN trim(line) = '' THEN 'empty' ELSE 'malformed' END, line
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
)
SELECT place, CAST(NULL AS VARCHAR) AS reason, item, count(*) AS n FROM good, (VALUES ('table'), ('graph'), ('pipeline')) p(place) GROUP BY ALL
UNION ALL
SELECT 'dead', reason, md5(line), count(*) FROM bad GROUP BY ALL"""


def tag_dead_letters_sql(matches: str) -> str:
    return f"""WITH hits AS (SELECT id, sum(n) AS n FROM ({matches}) GROUP BY id),
p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 0 THEN 'malformed' WHEN p_partkey % 7 = 0 THEN 'no_dictionary' END AS reason FROM part)
SELECT p.id, reason, CASE reason WHEN 'malformed' THEN 1 WHEN 'no_dictionary' THEN 3 END AS attempt,
       CASE WHEN reason IS NULL THEN CAST(coalesce(hits.n, 0) AS BIGINT) END AS n_keywords
FROM p LEFT JOIN hits ON hits.id = p.id"""


LATE_ARCHIVES = "WITH " + TWEETS_J.strip() + """,
e AS (SELECT event_id, event_type, k, epoch_us(ts) // 1000 AS ms FROM j),
b AS (SELECT min(ms) + max(ms) AS twice FROM e),
f AS (SELECT e.*, ms * 2 <= twice AS half FROM e, b),
l AS (SELECT max(ms) FILTER (WHERE half) AS last FROM f),
a AS (SELECT * FROM (VALUES ('messages'), ('tweets')) x(archive))
SELECT archive, count(*) AS kept, CAST(coalesce(sum(event_id), 0) AS BIGINT) AS kept_ids,
       count(*) + count(*) FILTER (WHERE half AND k % 5 = 0) + count(*) FILTER (WHERE ms < last - 10000 AND k % 3 = 0) AS read,
       count(*) FILTER (WHERE ms < last - 10000 AND k % 3 = 0) AS late,
       count(*) FILTER (WHERE half AND k % 5 = 0) AS repeated
FROM a, f, l WHERE archive = 'messages' OR event_type <> 'error' GROUP BY archive"""


def track_sql(doc_terms: list[str], body: str) -> str:
    """The distinct terms of the whole list as ``terms``, then ``body``."""
    return f"""{TRACK_LIST_UNCAPPED[: TRACK_LIST_UNCAPPED.rindex("SELECT CAST(pos")].rstrip()},
{values_table("dt", "term", [(t,) for t in doc_terms])},
terms AS (SELECT term FROM n WHERE trim(term) <> '' UNION SELECT term FROM dt)
{body}"""


TRACK_PAIRS_BODY = "SELECT doc_id, term FROM documents JOIN terms ON contains(lower(text), term)"

TRACK_MESSAGES_BODY = """SELECT kind, count(*) AS n, CAST(sum(id) AS BIGINT) AS sum_of_ids
FROM (SELECT 'documents' AS kind, doc_id AS id, text FROM documents
      UNION ALL SELECT 'parts', p_partkey, p_name FROM part)
WHERE EXISTS (SELECT 1 FROM terms WHERE contains(lower(text), term)) GROUP BY kind"""


def lemma_sql(lemmas: list[tuple], keywords: list[str]) -> str:
    """English rules only: the messages are English."""
    def cut(w: str) -> str:
        return (f"CASE WHEN {w} LIKE '%ies' AND length({w}) >= 5 THEN {w}[:-4] || 'y' "
                f"WHEN {w} LIKE '%sses' AND length({w}) >= 6 THEN {w}[:-3] "
                f"WHEN {w} LIKE '%ing' AND length({w}) >= 6 THEN {w}[:-4] "
                f"WHEN {w} LIKE '%ed' AND length({w}) >= 5 THEN {w}[:-3] "
                f"WHEN {w} LIKE '%s' AND length({w}) >= 4 THEN {w}[:-2] ELSE {w} END")

    def lemma(w: str) -> str:
        return (f"coalesce((SELECT min(lemma) FROM lem WHERE form = {w}), "
                f"(SELECT min(lemma) FROM lem WHERE form = {cut(w)}), {cut(w)})")

    return f"""WITH {values_table("lem", "lang, form, lemma", lemmas)},
{values_table("kw", "keyword", [(k,) for k in keywords])},
t AS (SELECT DISTINCT p_partkey AS id, unnest(string_split_regex(lower(p_name), {SPLIT})) AS term FROM part),
w AS (SELECT DISTINCT term FROM t), wl AS (SELECT term, {lemma("term")} AS lemma FROM w),
k AS (SELECT keyword, {lemma("keyword")} AS lemma FROM kw WHERE NOT contains(keyword, ' '))
SELECT t.id, t.term, k.keyword, k.lemma FROM t JOIN wl USING (term) JOIN k ON wl.lemma = k.lemma"""


READ_MESSAGES = """
SELECT reason, kind, count(*) AS n, CAST(sum(id) AS BIGINT) AS sum_of_ids, CAST(sum(s) AS BIGINT) AS sum_of_seconds FROM (
  SELECT CASE event_type WHEN 'error' THEN 'bad_created' WHEN 'purchase' THEN 'missing_created' ELSE 'ok' END AS reason,
         CASE WHEN event_type IN ('error', 'purchase') THEN '' ELSE event_type END AS kind,
         CASE WHEN event_type NOT IN ('error', 'purchase') THEN event_id END AS id,
         CASE WHEN event_type NOT IN ('error', 'purchase') THEN epoch_us(ts) // 1000000 END AS s
  FROM events
  UNION ALL
  SELECT CASE WHEN trim(l) = '' THEN 'empty'
              WHEN NOT json_valid(l) OR json_type(l) <> 'OBJECT' THEN 'malformed'
              ELSE 'object' END, '', NULL, NULL
  FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents))
GROUP BY reason, kind"""

READ_REFDATA = """
WITH lines AS (SELECT 'en' AS lang, concat_ws(' , ', upper(p_name), p_type) AS value FROM part
               UNION ALL SELECT 'fr', concat_ws(',', n_name, CAST(n_regionkey AS VARCHAR)) FROM nation),
sizes AS (SELECT lang, count(*) AS n_lines FROM lines GROUP BY lang),
kw AS (SELECT DISTINCT lang, trim(unnest(string_split(lower(value), ','))) AS keyword FROM lines)
SELECT lang, keyword, n_lines, TRUE AS numbered, TRUE AS gapless FROM kw JOIN sizes USING (lang)"""

FAN_OUT_VALUES = "WITH " + TWEETS_J.strip() + """,
t AS (SELECT event_id AS id, md5(text) AS text_md5, user_id FROM j WHERE event_type <> 'error')
SELECT 'table' AS sink, id, text_md5, user_id FROM t
UNION ALL SELECT 'pipeline', id, text_md5, user_id FROM t
UNION ALL SELECT 'graph', id, text_md5, user_id FROM t"""
