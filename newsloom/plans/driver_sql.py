"""The driver's queries as DuckDB SQL over the same tables.

Regular expressions are RE2 here: no look-around, an ASCII ``\\b``.
"""

from __future__ import annotations

from newsloom import fixed_values as fixed
from newsloom.functions.prompts import ANALYSIS_TEMPLATE
from newsloom.operators import fusion, lexical
from newsloom.plans import driver_inputs as inputs
from newsloom.plans import driver_queries as q

ZONE = q.ZONE
SLOT = "strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M%S')"
BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def wall(ts: str, zone: str = ZONE) -> str:
    return f"timezone('{zone}', timezone('UTC', {ts}))"


def local_iso(ts: str, zone: str, offset: str) -> str:
    return f"strftime({wall(ts, zone)}, '%Y-%m-%d %H:%M:%S') || '{offset}'"


def utc_iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S') || '+0000'"


def fold(text: str) -> str:
    return f"trim(regexp_replace({text}, '{BLANKS}+', ' ', 'g'))"


SQL: dict[str, str] = {}

# ---- slots and time -------------------------------------------------------

SQL["slot_floor_counts"] = f"SELECT {SLOT} AS slot, count(*) AS n FROM events GROUP BY 1"


def manifest(start: str) -> str:
    return f"""
    WITH days AS (
      SELECT CAST({wall('ts')} AS DATE) AS day, max(ts) AS as_of FROM events GROUP BY 1
    )
    SELECT strftime(day, '%Y-%m-%d') AS local_day, strftime(s, '%Y%m%d%H%M%S') AS slot
    FROM days, unnest(generate_series({start}, as_of, INTERVAL 15 MINUTE)) AS u(s)
    """


MIDNIGHT = f"timezone('UTC', timezone('{ZONE}', CAST(day AS TIMESTAMP)))"
DAILY = manifest(MIDNIGHT)
PACKAGE = f"slot || '{fixed.PACKAGE_SUFFIX}' AS package"
SQL["slot_manifest"] = f"SELECT local_day, slot, {PACKAGE} FROM ({DAILY})"
WINDOW = manifest("time_bucket(INTERVAL 15 MINUTE, as_of - INTERVAL 120 MINUTE)")
SQL["slot_manifest_window"] = f"SELECT local_day, slot, {PACKAGE} FROM ({WINDOW})"
ARRIVED = f"(SELECT DISTINCT {SLOT} AS slot FROM events)"
SQL["slot_missing"] = f"SELECT * FROM ({DAILY}) WHERE slot NOT IN (SELECT slot FROM {ARRIVED})"
SQL["slot_arrivals"] = f"""
SELECT local_day, count(a.slot) AS ok, count(*) - count(a.slot) AS missing
FROM ({DAILY}) m LEFT JOIN {ARRIVED} a ON a.slot = m.slot GROUP BY local_day"""

SQL["stamp_parse"] = """
SELECT event_id,
       CASE event_type WHEN 'error' THEN stamp[1:8] WHEN 'signup' THEN 'x' || stamp[2:14]
            ELSE stamp END AS stamp,
       CASE WHEN event_type NOT IN ('error', 'signup')
            THEN CAST(floor(epoch(ts)) AS BIGINT) END AS seconds
FROM (SELECT *, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM events)"""


def dates(zone: str, offset: str) -> str:
    return f"""
SELECT event_id, strftime({wall('ts', zone)}, '%Y-%m-%d %H:%M:%S') AS date_local,
       {local_iso('ts', zone, offset)} AS date_local_iso, {utc_iso('ts')} AS date_utc_iso,
       strftime({wall('ts', zone)}, '%Y-%m-%d') AS local_day
FROM events"""


SQL["local_day_rows"] = (
    dates(ZONE, "-0400") + f" WHERE CAST({wall('ts')} AS DATE) = DATE '2024-01-15'"
)
SQL["local_wall_clock"] = dates(q.HALF_HOUR_ZONE, "-0330")

# ---- addresses, language and place ------------------------------------------

HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"
PATH = "lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1))"
QUERY = r"regexp_extract(url, '\?([^#]*)', 1)"
SQL["url_parts"] = (
    f"SELECT page_id, {HOST} AS host, {PATH} AS path, {QUERY} AS query FROM pages"
)
rule = q.SPANISH
HOST_HIT = (
    f"(suffix({HOST}, '.org') OR {HOST} IN ({', '.join(quoted(h) for h in rule.hosts)}))"
)
QUERY_HIT = rf"regexp_matches({QUERY}, '(^|&)(utm_source|ref)=(feed|x)(&|$)')"
SECTION_HIT = (
    "(" + " OR ".join(f"contains({HOST} || {PATH}, {quoted(s)})" for s in rule.sections) + ")"
)
for name, hit in [
    ("host_mask", HOST_HIT),
    ("query_mask", QUERY_HIT),
    ("section_mask", SECTION_HIT),
    ("url_mask", f"({HOST_HIT} OR {QUERY_HIT} OR {SECTION_HIT})"),
]:
    SQL[name] = f"SELECT page_id, {hit} AS hit FROM pages"
SQL["language_filter_by_rule"] = (
    f"SELECT page_id, url FROM pages WHERE {HOST_HIT} OR {QUERY_HIT} OR {SECTION_HIT}"
)
SQL["source_code"] = """
SELECT doc_id, CASE lang WHEN 'en' THEN 'ENG' WHEN 'fr' THEN 'FRA' WHEN 'de' THEN 'DEU'
                         WHEN 'es' THEN 'SPA' ELSE '' END AS code FROM documents"""
SQL["place_filter"] = r"""
SELECT c_custkey, n_name, locations
FROM customer JOIN (
  SELECT n_nationkey, n_name,
         CASE n_name WHEN 'NATION_1' THEN '1#Brazil#BR#' WHEN 'NATION_2' THEN '4#Recife#BRA#'
                     WHEN 'NATION_3' THEN 'x#BRA_1#' ELSE 'none' END AS locations
  FROM nation) ON c_nationkey = n_nationkey
WHERE regexp_matches(locations, '(?i)brazil|\bBRA\b')"""

# ---- feed ---------------------------------------------------------------------

FEED = f"""
(SELECT {SLOT} AS slot, event_id AS row_no, strftime(ts, '%Y%m%d%H%M%S') AS date,
        event_type AS source,
        CASE WHEN event_type = 'error' AND value >= 30 THEN '' ELSE
          'https://' || CASE event_type
            WHEN 'view' THEN 'g1.globo.com' WHEN 'click' THEN 'www.example.com'
            WHEN 'purchase' THEN 'News.Example.com.br:8080'
            WHEN 'signup' THEN 'www.bbc.com/portuguese' ELSE 'paper.example.org' END
          || '/' || user_id || CASE WHEN value > 20 THEN '?hl=pt-BR'
                                    WHEN value > 10 THEN '?lang=en&hl=' ELSE '' END END AS url,
        'TAX_' || upper(event_type) AS themes,
        CASE WHEN value < 5 THEN '1#Brazil#BR#' WHEN value < 15 THEN '4#Recife#BRA#'
             WHEN value < 25 THEN '1#Brasil#BRA_1#' ELSE '' END AS locations,
        CASE WHEN event_type = 'click' AND value < 8 THEN 'srclc:por;eng:GT-POR 1.0'
             WHEN event_type = 'click' THEN 'srclc:spa;eng:GT-SPA 1.0' ELSE '' END AS translation,
        date_trunc('second', ts) AS date_utc
 FROM events)"""
PT_URL = """(url LIKE 'https://g1.globo.com/%' OR url LIKE 'https://News.Example.com.br:%'
             OR url LIKE 'https://www.bbc.com/portuguese/%' OR url LIKE '%?hl=pt-BR')"""
PT_NOTE = "translation LIKE 'srclc:por;%'"
PLACE = r"regexp_matches(locations, '(?i)brazil|\bBRA\b')"
IN_DAY = f"CAST({wall('date_utc')} AS DATE) = DATE '2024-01-15'"
NEWS = f"""url, source, slot, row_no, {local_iso('date_utc', ZONE, '-0400')} AS date_local_iso,
           {utc_iso('date_utc')} AS date_utc_iso"""


def one_per_url(condition: str) -> str:
    return f"""(SELECT * FROM {FEED} WHERE {condition}
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY slot, row_no) = 1)"""


SQL["language_filter"] = (
    f"SELECT row_no, url, translation FROM {FEED} WHERE {PT_URL} OR {PT_NOTE}"
)
SQL["first_per_key"] = """
SELECT doc_id, source, lang, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""
PT = f"({PT_URL} OR {PT_NOTE})"
SQL["news_newest"] = f"SELECT {NEWS} FROM {one_per_url(PT)} ORDER BY date_utc DESC, url"
SQL["news_daily"] = f"""SELECT {NEWS} FROM {one_per_url(f'{PT} AND {IN_DAY} AND {PLACE}')}
ORDER BY date_utc DESC, url"""
SQL["news_top"] = (
    f"SELECT {NEWS} FROM {one_per_url('true')} ORDER BY date_utc DESC, url LIMIT {q.TOP}"
)
SQL["filter_funnel"] = f"""
SELECT count(*) AS rows_read, count(*) FILTER (d) AS in_day,
       count(*) FILTER (d AND u) AS url_hits, count(*) FILTER (d AND n) AS translation_hits,
       count(*) FILTER (d AND (u OR n)) AS after_language,
       count(*) FILTER (d AND (u OR n) AND p) AS after_place,
       count(DISTINCT url) FILTER (d AND (u OR n) AND p) AS after_dedup
FROM (SELECT url, {IN_DAY} AS d, {PT_URL} AS u, {PT_NOTE} AS n, {PLACE} AS p FROM {FEED})"""
SQL["funnel_observed"] = SQL["filter_funnel"]
SQL["filter_funnel_by_day"] = f"""
SELECT strftime({wall('date_utc')}, '%Y-%m-%d') AS local_day, count(*) AS rows_read,
       count(*) FILTER ({PT_URL}) AS url_hits, count(*) FILTER ({PT_NOTE}) AS translation_hits,
       count(*) FILTER ({PT}) AS after_language, count(DISTINCT url) FILTER ({PT}) AS after_dedup
FROM {FEED} GROUP BY 1"""

# ---- articles -------------------------------------------------------------------


def decoded(text: str) -> str:
    """The entities that occur in the pages; the ampersand last."""
    for entity, mark in [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")]:
        text = f"replace({text}, '{entity}', '{mark}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


TITLE = decoded("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
PAGE_LANG = """nullif(regexp_extract(html, '(?is)<html[^>]*?\\slang="([A-Za-z0-9-]+)"', 1), '')"""
REGION = r"""regexp_extract(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
             '(?is)<article[^>]*>(.*)</article>', 1)"""
BROKEN = rf"""regexp_replace(regexp_replace(regexp_replace({REGION}, '{BLANKS}+', ' ', 'g'),
  '(?i)</?(p|br|hr|div|section|article|main|ul|ol|li|h[1-6])\b[^>]*>', chr(10), 'g'),
  '<[a-zA-Z/!][^>]*>', '', 'g')"""
PAGE_TEXT = rf"""nullif(trim(regexp_replace(regexp_replace({decoded(BROKEN)}, '[ \t\x{{a0}}]+', ' ', 'g'),
  ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)), '')"""
SQL["page_title_lang"] = (
    f"SELECT page_id, nullif({fold(TITLE)}, '') AS title, {PAGE_LANG} AS lang FROM pages"
)
SQL["page_text"] = f"SELECT page_id, {PAGE_TEXT} AS text FROM pages"
SQL["page_status"] = f"""
SELECT page_id, CASE WHEN length({PAGE_TEXT}) >= 1000 THEN 'ok' ELSE 'extract-weak' END
       AS fetch_status FROM pages"""
SQL["enrich_top_n"] = f"""
WITH feed AS (
  SELECT page_id, ts, url || CASE WHEN event_type = 'error' THEN '?gone' ELSE '' END AS url
  FROM pages JOIN events ON event_id = page_id
), placed AS (
  SELECT *, row_number() OVER (ORDER BY ts DESC, url) <= {q.TOP} AS taken FROM feed
), articles AS (
  SELECT url, nullif({fold(TITLE)}, '') AS title, {PAGE_TEXT} AS text, {PAGE_LANG} AS lang,
         row_number() OVER (PARTITION BY url ORDER BY page_id) AS copy
  FROM pages
)
SELECT p.page_id, p.url, {utc_iso('p.ts')} AS date_utc_iso, a.title, a.text, a.lang,
       CASE WHEN NOT taken THEN NULL WHEN a.url IS NULL THEN 'fetch-failed'
            WHEN length(a.text) >= 200 THEN 'ok' ELSE 'extract-weak' END AS fetch_status
FROM placed p LEFT JOIN articles a ON a.url = p.url AND a.copy = 1 AND taken"""

# ---- videos and transcripts -------------------------------------------------------

SQL["enrich_from_store"] = SQL["enrich_top_n"]
SQL["handle_extract"] = f"""
SELECT page_id, CASE WHEN url LIKE 'https%'
  THEN regexp_extract(split_part(url, '/', 3), '^[A-Za-z0-9_-]+')
  ELSE '{fixed.UNKNOWN_CHANNEL}' END AS handle FROM pages"""
CHANNEL = "'https://www.youtube.com/@' || split_part(url, '/', 4)"
SQL["tab_url"] = f"""
SELECT page_id, {CHANNEL} || '/videos' AS videos,
       {CHANNEL} || CASE WHEN page_id % 2 = 0 THEN '/videos' ELSE '' END || '/shorts' AS shorts
FROM pages"""
VIDEO = "lpad(CAST(event_id AS VARCHAR), 11, 'v')"
SQL["watch_url"] = (
    f"SELECT event_id, 'https://www.youtube.com/watch?v=' || {VIDEO} AS url FROM events"
)
SQL["video_id"] = f"SELECT event_id, {VIDEO} AS video FROM events"


def listing(channel: str) -> str:
    return f"""
(SELECT {channel} AS channel,
        CASE WHEN event_type IN ('view', 'click') THEN 'videos'
             WHEN event_type IN ('purchase', 'signup') THEN 'shorts' ELSE 'live' END AS kind,
        event_id AS pos, 'v' || CAST(floor(value) AS BIGINT) AS video_id
 FROM events WHERE value >= 1)"""


def listed(channel: str, limit: int) -> str:
    return f"""(SELECT * FROM {listing(channel)}
    QUALIFY row_number() OVER (PARTITION BY channel, kind ORDER BY pos) <= {limit})"""


WATCH = f"'{fixed.WATCH_PREFIX}' || video_id"
SQL["tab_listing"] = f"SELECT * FROM {listed(chr(39) + 'c' + chr(39) + ' || user_id', 5)}"
UNION = f"""
SELECT channel, CAST(row_number() OVER (PARTITION BY channel ORDER BY kind DESC, pos) AS INTEGER)
         AS place, video_id, {WATCH} AS url
FROM (SELECT * FROM {listed("'c' || user_id", 3)} WHERE kind <> 'live'
      QUALIFY row_number() OVER (PARTITION BY channel, video_id ORDER BY kind DESC, pos) = 1)
QUALIFY place <= 3"""
SQL["kind_union_limit"] = UNION
DAILY_CHANNEL = "'c' || user_id || strftime(ts, '-%Y%m%d')"
SQL["kind_videos"] = f"""
WITH ids AS (SELECT * FROM {listed(DAILY_CHANNEL, 2)} WHERE kind <> 'live')
SELECT channel, CAST(row_number() OVER (PARTITION BY channel ORDER BY pos) AS INTEGER) AS place,
       video_id, {WATCH} AS url
FROM ids WHERE kind = 'videos'
   OR channel NOT IN (SELECT channel FROM ids WHERE kind = 'videos')"""

CLEAN_TITLE = r"""coalesce(nullif(substring(regexp_replace(trim(text, ' ' || chr(10) || chr(9)),
  '[<>:"/\\|?*]', '', 'g'), 1, 100), ''), CAST(doc_id AS VARCHAR))"""
SQL["title_clean"] = f"SELECT doc_id, {CLEAN_TITLE} AS title FROM documents"
TITLED = f"""(SELECT {CLEAN_TITLE} AS title, doc_id AS pos, CAST(doc_id AS VARCHAR) AS video_id
FROM documents)"""
SQL["title_last_wins"] = f"""SELECT * FROM {TITLED}
QUALIFY row_number() OVER (PARTITION BY title ORDER BY pos DESC) = 1"""
SQL["title_replaced"] = f"""SELECT * FROM {TITLED}
QUALIFY row_number() OVER (PARTITION BY title ORDER BY pos DESC) > 1"""
SQL["segments_to_text"] = """
SELECT conv_id AS video_id, string_agg(text, chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id"""
SQL["prefer_language"] = """
WITH ranked AS (
  SELECT doc_id // 4 AS video_id, lang AS language, doc_id AS seg_no,
         CASE lang WHEN 'es' THEN 1 WHEN 'fr' THEN 2 END AS place FROM documents
)
SELECT r.video_id, r.language, r.seg_no FROM ranked r
JOIN (SELECT video_id, min(place) AS best FROM ranked GROUP BY 1) b
  ON r.video_id = b.video_id AND r.place = b.best"""
SQL["links_rollup"] = (
    "SELECT source AS channel, count(*) AS links FROM documents GROUP BY ROLLUP (source)"
)
SQL["links_rejected"] = """
SELECT d.doc_id AS video_id, d.source,
       CASE WHEN l.toxic = 1 THEN 'disabled' ELSE 'no-transcript' END AS reason
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE l.toxic IS NULL OR l.toxic <> 0"""

# ---- cleaning, corpora, blocks -------------------------------------------------------

MARKED = """'0:15 oi 1:02:03 [MÚSICA alta]  ' || chr(9) || text || chr(10)
  || '[ __ ] [risos] 12:345 [Aplausos' || chr(10) || '] 9:59'"""
MARK = r"(?i)\[(aplausos|música|risos|music|applause|laughs|inaudível)[^\n]*?\]"
TIME_CODE = r"\b\d{1,2}:\d{2}(:\d{2})?\b"


def cleaned(text: str) -> str:
    no_codes = f"regexp_replace({text}, '{TIME_CODE}', '', 'g')"
    return fold(f"regexp_replace({no_codes}, '{MARK}', '', 'g')")


SQL["clean_text"] = f"SELECT doc_id, {cleaned(MARKED)} AS text FROM documents"
FILE = "lpad(CAST(doc_id AS VARCHAR), 12, '0')"
LINES = f"""
(SELECT corpus_key, file_name, CAST(u.i AS INTEGER) - 1 AS line_no, pieces[u.i] AS text
 FROM (SELECT source AS corpus_key, {FILE} AS file_name,
              string_split(text || CASE WHEN doc_id = max(doc_id) OVER (PARTITION BY source)
                                        THEN '' ELSE chr(10) END, chr(10)) AS pieces
       FROM documents), unnest(generate_series(1, len(pieces))) AS u(i))"""
SQL["corpus_by_source"] = f"SELECT * FROM {LINES}"


def blocks(lines: str, limit: int) -> str:
    """Line by line, all corpora at once: a new block when the line does not fit."""
    return f"""
WITH RECURSIVE lines AS MATERIALIZED (
  SELECT corpus_key, text,
         row_number() OVER (PARTITION BY corpus_key ORDER BY file_name, line_no) AS n
  FROM {lines}
), walk AS (
  SELECT corpus_key, n, CAST(length(text) AS BIGINT) AS size, CAST(1 AS BIGINT) AS block_no
  FROM lines WHERE n = 1
  UNION ALL
  SELECT l.corpus_key, l.n,
         CASE WHEN w.size + length(l.text) > {limit} THEN length(l.text)
              ELSE w.size + length(l.text) END,
         w.block_no + CASE WHEN w.size + length(l.text) > {limit} THEN 1 ELSE 0 END
  FROM walk w JOIN lines l ON l.corpus_key = w.corpus_key AND l.n = w.n + 1
)
SELECT w.corpus_key, w.block_no, string_agg(l.text, chr(10) ORDER BY l.n) AS text
FROM walk w JOIN lines l ON l.corpus_key = w.corpus_key AND l.n = w.n
GROUP BY w.corpus_key, w.block_no"""


SQL["blocks"] = blocks(LINES, 1500)
CLEAN_LINES = f"""
(SELECT source AS corpus_key, {FILE} AS file_name, 0 AS line_no, {cleaned('text')} AS text
 FROM documents
 UNION ALL
 SELECT source, {FILE}, 1, '' FROM documents
 QUALIFY doc_id < max(doc_id) OVER (PARTITION BY source))"""
SQL["blocks_clean_first"] = blocks(CLEAN_LINES, 4000)

# ---- prompts, responses, style books -----------------------------------------------------

SQL["prompts"] = """
SELECT conv_id AS corpus_key, turn AS block_no,
       'Idioma pt-BR, até 15 itens, sem nota.' || chr(10) || 'Trecho $ 15:' || chr(10) || text
       || chr(10) || 'Fim ${outro}' AS prompt
FROM conversations"""
BEFORE, AFTER = (
    ANALYSIS_TEMPLATE.replace("{{idioma|pt-BR}}", "pt-BR").replace("{{max_itens|10}}", "25").split("{{trecho}}")
)
SQL["prompt_defaults"] = f"""
SELECT conv_id AS corpus_key, turn AS block_no,
       md5({quoted(BEFORE)} || text || {quoted(AFTER)}) AS digest FROM conversations"""
SQL["responses_parsed"] = """
SELECT event_id,
       CASE WHEN event_type IN ('view', 'click')
            THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
       CASE event_type WHEN 'purchase' THEN '_erro_parse_json' WHEN 'signup' THEN '_erro_formato'
            WHEN 'error' THEN '_erro_chamada_ia' END AS kind,
       CASE event_type WHEN 'purchase' THEN 'sure: ' || props
            WHEN 'signup' THEN '[' || props || ']' END AS sample
FROM events"""
SQL["analysis_table"] = """
SELECT conv_id AS corpus_key, turn AS block_no,
       CASE WHEN role = 'assistant' THEN text END AS tom,
       CASE WHEN role <> 'assistant' THEN '_erro_chamada_ia' END AS kind
FROM conversations"""

TURNS = r"""
(SELECT role AS corpus_key, conv_id * 100 + turn AS block_no,
        string_split_regex(text, '\s+') AS w FROM conversations)"""
WORDS_OF = f"(SELECT *, w[u.i] AS form, u.i AS nth FROM {TURNS}, unnest(generate_series(1, len(w))) AS u(i))"


def of_words(name: str, condition: str, form: str) -> str:
    """A list whose items are some of a turn's words; ``pos`` counts those alone."""
    return f"""
SELECT '{name}' AS list, corpus_key, block_no,
       row_number() OVER (PARTITION BY corpus_key, block_no ORDER BY nth) AS pos,
       {{}} AS key, {form} AS form FROM {WORDS_OF} WHERE {condition}"""


UNIT = "chr(31)"
ITEMS = " UNION ALL ".join(
    [
        f"""SELECT 'estruturas_piada' AS list, corpus_key, block_no, 1 AS pos,
  lower(w[1]) || {UNIT} || lower(w[-1]) AS key,
  concat_ws('|', w[1], w[-1], array_to_string(w[1:2], '+')) AS form FROM {TURNS}""",
        of_words("gatilhos_comicos", "suffix(form, ',')", "concat_ws('|', form, 'alta', w[1])").format(
            f"lower(form) || {UNIT} || lower(w[1])"
        ),
        f"""SELECT 'moldes_frasais', corpus_key, block_no, 1, lower(trim(array_to_string(w[1:2], ' '))),
  concat_ws('|', array_to_string(w[1:2], ' '), 'abertura') FROM {TURNS}""",
        of_words("vicios_expressao", "length(form) >= 10", "concat_ws('|', form, w[-1])").format("lower(form)"),
        of_words("marcadores_discurso", "true", "form").format("lower(form)"),
        of_words("bordoes", "length(form) = 3", "concat_ws('|', form, w[1])").format("lower(form)"),
        of_words("interjeicoes", "length(form) <= 2", "form").format("lower(form)"),
        of_words("temas_recorrentes", "suffix(form, '.')", "form").format("lower(form)"),
        f"""SELECT 'exemplos_representativos', corpus_key, block_no, 1, lower(trim(array_to_string(w[1:3], ' '))),
  array_to_string(w[1:3], ' ') FROM {TURNS}""",
    ]
)


def ranked(cap: int) -> str:
    return f"""
(SELECT corpus_key, list, key, count(DISTINCT block_no) AS recurrence,
        arg_min(form, (block_no, pos)) AS form, min((block_no, pos)) AS first,
        CAST(row_number() OVER (PARTITION BY corpus_key, list
          ORDER BY count(DISTINCT block_no) DESC, min((block_no, pos)), key)
          AS INTEGER) AS place
 FROM ({ITEMS}) WHERE replace(key, {UNIT}, '') <> '' GROUP BY corpus_key, list, key QUALIFY place <= {cap})"""


SQL["fuse_items"] = f"SELECT * EXCLUDE (first) FROM {ranked(25)}"
PARTIALS = "(SELECT role AS corpus_key, count(*) AS partials FROM conversations GROUP BY role)"


def book_list(name: str) -> str:
    weight = "" if name in fusion.UNWEIGHTED else (
        " || ':' || CAST(CAST(round(recurrence / partials * 1000000) AS BIGINT) AS VARCHAR)"
    )
    return (
        f"coalesce(string_agg(form{weight}, ';' ORDER BY place) FILTER (list = '{name}'), '') AS {name}"
    )


SQL["style_books"] = f"""
SELECT corpus_key, corpus_key AS tom, {', '.join(map(book_list, fusion.LIST_KEYS))},
       CAST(NULL AS VARCHAR) AS observacoes,
       '{fixed.STYLE_VERSION}' AS versao, '2024-01-15T16:00:00' AS gerado_em, '{fixed.STYLE_SOURCE}' AS fonte
FROM {ranked(25)} JOIN {PARTIALS} USING (corpus_key) GROUP BY corpus_key"""
CONTEXT_LISTS = {
    "moldes_de_piada": ("moldes_frasais", 1),
    "estruturas_piada": ("estruturas_piada", 1),
    "gatilhos_comicos": ("gatilhos_comicos", 1),
    "marcadores": ("marcadores_discurso", 1),
    "bordoes": ("bordoes", 1),
    "interjeicoes": ("interjeicoes", 1),
}


def context_list(name: str) -> str:
    of, part = CONTEXT_LISTS[name]
    said = f"split_part(form, '|', {part})"
    return f"coalesce(string_agg({said}, ';' ORDER BY place) FILTER (list = '{of}' AND {said} <> ''), '') AS {name}"


SQL["style_context"] = f"""
SELECT corpus_key, corpus_key AS tom, {', '.join(map(context_list, CONTEXT_LISTS))},
       {', '.join(f'CAST(NULL AS VARCHAR) AS {n}' for n in ('humor', 'ritmo', 'ritmo_comico', 'pausas'))}
FROM {ranked(40)} GROUP BY corpus_key"""
SQL["books_failed"] = f"""
SELECT role AS corpus_key, CASE WHEN role <> 'user' THEN role END AS tom,
       CASE WHEN role = 'user' THEN 'none of ' || count(*) || ' blocks was analysed' END AS message,
       CASE WHEN role = 'user' THEN 'true' END AS failed,
       '{fixed.STYLE_VERSION}' AS versao, '2024-01-15T16:00:00' AS gerado_em
FROM conversations GROUP BY role"""
SQL["books_stamped"] = f"""
SELECT doc_id, lang AS tom, CASE WHEN doc_id % 2 = 0 THEN '1.0' ELSE '{fixed.STYLE_VERSION}' END AS versao,
       CASE WHEN doc_id % 3 = 0 THEN source ELSE '{fixed.STYLE_SOURCE}' END AS fonte,
       '2024-01-15T16:00:00' AS gerado_em FROM documents"""

VIEWS = """
(SELECT source AS corpus_key, doc_id, 'tom' AS field, lang AS value FROM documents
 UNION ALL SELECT source, doc_id, 'humor', CASE WHEN n_chars > 2000 THEN 'longo'
   WHEN n_chars > 500 THEN 'medio' END FROM documents
 UNION ALL SELECT source, doc_id, 'ritmo', CASE WHEN n_chars % 2 = 0 THEN 'par' ELSE 'impar' END
   FROM documents
 UNION ALL SELECT source, doc_id, 'ritmo_comico', 'misto' FROM documents
 UNION ALL SELECT source, doc_id, 'caixa_alta', CASE WHEN n_chars > 1000 THEN 'alta'
   ELSE 'baixa' END FROM documents)"""
FIELDS = ["tom", "humor", "ritmo", "ritmo_comico", "caixa_alta"]
FUSED = f"""
WITH views AS (
  SELECT corpus_key, field, value,
         row_number() OVER (PARTITION BY corpus_key, field
                            ORDER BY count(*) DESC, min(doc_id), value) AS place
  FROM {VIEWS} WHERE value IS NOT NULL GROUP BY 1, 2, 3
), wide AS (
  SELECT corpus_key, {', '.join(
    f"max(value) FILTER (field = '{f}' AND place = {p}) AS {f}_{p}" for f in FIELDS for p in (1, 2)
  )} FROM views GROUP BY 1
), totals AS (
  SELECT source AS corpus_key, count(*) AS partials, avg((n_chars % 8) / 8.0) AS confianca_global
  FROM documents GROUP BY 1
)
SELECT corpus_key, partials, {', '.join(f'{f}_1 AS {f}' for f in FIELDS)},
       CAST(NULL AS VARCHAR) AS pausas_elongadas,
       nullif(concat_ws('; ', {', '.join(f"'{f}: ' || {f}_1 || ' / ' || {f}_2" for f in FIELDS)}),
              '') AS observacoes, confianca_global
FROM totals JOIN wide USING (corpus_key)"""
SQL["fuse_scalars"] = FUSED
SQL["style_book_sink"] = f"SELECT * EXCLUDE (partials) FROM ({FUSED})"


def times(mark: str) -> str:
    return f"(length(text) - length(replace(text, '{mark}', '')))"


STOPS = f"greatest(1, {times('.')})"
PHRASES = " OR ".join(f"contains(text, {quoted(p)})" for p in q.CATCHPHRASES)
AVOIDED = " + ".join(f"CAST(contains(text, {quoted(w)}) AS INTEGER)" for w in q.AVOIDED)
SQL["style_score"] = f"""
SELECT doc_id, CAST(CAST(({PHRASES}) AS INTEGER)
  + CAST({times('?')} / {STOPS} >= 0.5 AS INTEGER)
  + CAST({times('!')} / {STOPS} >= 0.25 AS INTEGER) - ({AVOIDED}) AS INTEGER) AS score
FROM documents"""


def removed(text: str) -> str:
    for phrase in q.NEGATIVES:
        literal = phrase.replace(".", r"\.")
        text = f"regexp_replace({text}, {quoted(literal)}, '', 'gi')"
    return text


def inserted(text: str) -> str:
    pieces = rf"string_split(regexp_replace({text}, '([.!?]){BLANKS}+', '\1' || chr(1), 'g'), chr(1))"
    first, second = (quoted(" " + p) for p in q.INSERTED[:2])
    return f"""(SELECT array_to_string(list_concat(
      [pieces[1] || {first}],
      CASE WHEN len(pieces) > 1 THEN [pieces[2] || {second}] ELSE [] END, pieces[3:]), ' ')
      FROM (SELECT {pieces} AS pieces))"""


for name, edited in [
    ("phrase_remove", removed("text")),
    ("phrase_insert", inserted("text")),
    ("phrase_append", f"text || {quoted(' ' + q.INSERTED[0])}"),
    ("punch_up", inserted(removed("text"))),
    (
        "outline",
        r"'Introdução indignada sobre: ' || text || '\nResumo do conteúdo\nOpinião forte com final ácido'",
    ),
]:
    SQL[name] = f"SELECT doc_id, {edited} AS text FROM documents"

WORDS = r"regexp_extract_all(text, '[\p{L}\p{N}_]+')"
LONG_PAUSE = "(" + "|".join([r"…", r"\.{3,}"] + [f"{c}{{3,}}" for c in
             "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZßàáâäçèéêëíîïñóôöúùûüÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÚÙÛÜ"]) + ")"
SQL["lexical_profile"] = f"""
SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words,
       round(len(list_filter(words, lambda w: length(w) > 1 AND upper(w) = w AND lower(w) <> w))
             / greatest(len(words), 1), 6) AS caps_share,
       CASE WHEN pauses / greatest(len(words), 1) < 0.01 THEN 'baixa'
            WHEN pauses / greatest(len(words), 1) < 0.05 THEN 'media' ELSE 'alta' END AS pauses
FROM (SELECT doc_id, {WORDS} AS words, len(regexp_extract_all(text, '{LONG_PAUSE}')) AS pauses
      FROM documents)"""
SPOKEN = ", ".join(quoted(w) for w in lexical.INTERJECTIONS)
SQL["lexical_books"] = rf"""
WITH said AS (
  SELECT role AS corpus_key, conv_id * 100 + turn AS block_no, lower(w) AS key, count(*) AS n
  FROM (SELECT *, {WORDS} AS words FROM conversations), unnest(words) AS u(w) GROUP BY 1, 2, 3
), kinds AS (
  SELECT *, 'marcadores_discurso' AS list FROM said WHERE key IN ('the', 'de', 'la', 'und', 'que')
  UNION ALL SELECT *, 'interjeicoes' FROM said WHERE key IN ({SPOKEN})
  UNION ALL SELECT *, 'temas_recorrentes' FROM said WHERE length(key) >= {lexical.TOPIC_CHARS} AND n > 1
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY corpus_key, block_no, list ORDER BY n DESC, key) AS pos
  FROM kinds QUALIFY pos <= 25
)
SELECT corpus_key, list, key, count(*) AS recurrence,
       CAST(row_number() OVER (PARTITION BY corpus_key, list
         ORDER BY count(*) DESC, min((block_no, pos)), key) AS INTEGER) AS place
FROM placed GROUP BY corpus_key, list, key QUALIFY place <= 25"""


def said_runs(source: str, most: int, least: int) -> str:
    """Recurrent runs of two to ``most`` words in enough texts of a corpus."""
    runs = " UNION ALL ".join(
        f"""SELECT DISTINCT corpus_key, text_no, {n} AS words, array_to_string(w[i:i + {n - 1}], ' ') AS phrase
  FROM said, unnest(generate_series(1, len(w) - {n - 1})) AS u(i)"""
        for n in range(2, most + 1)
    )
    return f"""
WITH said AS (
  SELECT corpus_key, text_no, list_transform({WORDS}, lambda w: lower(w)) AS w FROM {source}
), runs AS ({runs}), counts AS (
  SELECT corpus_key, words, phrase, count(*) AS texts FROM runs GROUP BY ALL HAVING count(*) >= {least}
), parts AS (
  SELECT corpus_key, words - 1 AS words, texts, p AS phrase
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM counts),
       unnest([array_to_string(w[1:len(w) - 1], ' '), array_to_string(w[2:], ' ')]) AS u(p)
), longer AS (
  SELECT corpus_key, words, phrase, max(texts) AS longer FROM parts GROUP BY ALL
), placed AS (
  SELECT c.*, CAST(row_number() OVER (PARTITION BY corpus_key ORDER BY texts DESC, words DESC, phrase)
              AS INTEGER) AS place
  FROM counts c LEFT JOIN longer l USING (corpus_key, words, phrase) WHERE l.longer IS NULL OR l.longer < texts
)"""


SQL["catchphrases"] = said_runs("(SELECT source AS corpus_key, doc_id AS text_no, text FROM documents)", 4, 3) + """
SELECT corpus_key, phrase, CAST(words AS INTEGER) AS words, texts, place FROM placed WHERE place <= 50"""
SQL["lexical_catchphrases"] = said_runs(
    "(SELECT role AS corpus_key, conv_id * 100 + turn AS text_no, text FROM conversations)", 3, 3
) + f"""
SELECT corpus_key, coalesce(string_agg(item, ';' ORDER BY item), '') AS bordoes FROM (
  SELECT corpus_key, phrase || ':' || CAST(CAST(round(count(text_no) / any_value(partials) * 1000000) AS BIGINT) AS VARCHAR)
           AS item
  FROM {PARTIALS} LEFT JOIN placed p USING (corpus_key) LEFT JOIN said s USING (corpus_key)
  WHERE p.place IS NULL OR (p.place <= 25
    AND contains(' ' || array_to_string(s.w, ' ') || ' ', ' ' || p.phrase || ' '))
  GROUP BY corpus_key, phrase) GROUP BY corpus_key"""
SQL["recurrent_phrases"] = rf"""
WITH said AS (
  SELECT source AS corpus_key, doc_id, list_transform({WORDS}, lambda w: lower(w)) AS words
  FROM documents
), phrases AS (
  SELECT DISTINCT corpus_key, doc_id, words[u.i] || ' ' || words[u.i + 1] AS phrase
  FROM said, unnest(generate_series(1, len(words) - 1)) AS u(i)
)
SELECT corpus_key, phrase, count(*) AS texts,
       CAST(row_number() OVER (PARTITION BY corpus_key ORDER BY count(*) DESC, phrase)
            AS INTEGER) AS place
FROM phrases GROUP BY corpus_key, phrase HAVING count(*) >= 2 QUALIFY place <= 50"""

# ---- packages, sinks and sources -------------------------------------------------------------

SECONDS = "CAST(epoch(date_utc) AS BIGINT) AS seconds"
PACKED = f"""
(SELECT *, CAST(package[9:10] AS INTEGER) // {inputs.PACKAGE_HOURS} % 4 AS kind, CAST(tone AS DOUBLE) AS value,
        row_number() OVER (PARTITION BY package ORDER BY row_no) AS place
 FROM (SELECT f.*, CAST(e.value AS VARCHAR) AS tone,
              date[1:8] || lpad(CAST(CAST(date[9:10] AS INTEGER) // {inputs.PACKAGE_HOURS} * {inputs.PACKAGE_HOURS} AS VARCHAR), 2, '0')
                || '0000' AS package
       FROM {FEED} f JOIN events e ON e.event_id = f.row_no))"""
PACKAGE_WIDTH = "CASE kind " + " ".join(f"WHEN {k} THEN {w}" for k, w in inputs.WIDTHS.items()) + " END"
SHORT = f"value < {inputs.SHORT_UP_TO}"
MARK = "chr(34)"
SAID_BY = f"CASE WHEN source = 'signup' THEN '<signup>' || chr(9) || {MARK} || 'x' || {MARK} ELSE source END"
RAW_SAID_BY = f"""CASE WHEN source = 'signup'
  THEN {MARK} || '<signup>' || chr(9) || repeat({MARK}, 2) || 'x' || repeat({MARK}, 3) ELSE source END"""
OF_WIDTH = f"CASE WHEN {SHORT} OR {{}} THEN '' ELSE {{}} END"
PACKAGE_ROWS = f"""
SELECT package AS slot, place AS row_no, date, {SAID_BY} AS source, url,
       {OF_WIDTH.format('false', 'themes')} AS themes,
       {OF_WIDTH.format('kind = 3', 'locations')} AS locations,
       {OF_WIDTH.format('kind >= 2', 'tone')} AS tone,
       {OF_WIDTH.format('kind >= 2', 'translation')} AS translation,
       date_utc, kind, value
FROM {PACKED}"""
LONG = f"value >= {inputs.LONG_FROM}"
SQL["package_scan"] = f"""
SELECT slot, row_no, date, source, url, themes, locations, tone, translation, {SECONDS}
FROM ({PACKAGE_ROWS}) WHERE NOT ({LONG})
UNION ALL
SELECT DISTINCT package, 0, NULL, '', '', '', '', '', '', CAST(NULL AS BIGINT) FROM {PACKED}"""
CELLS_OF = {
    27: {1: "date", 3: "quoted", 4: "url", 8: "themes", 10: "locations", 15: "tone", 25: "translation"},
    10: {1: "date", 3: "quoted", 4: "url", 8: "themes", 9: "locations"},
    8: {1: "date", 3: "quoted", 4: "url", 7: "themes"},
}
CELLS_OF[26] = CELLS_OF[27]
TAB = " || chr(9) || "
WHOLE_LINES = " ".join(
    f"WHEN {k} THEN " + TAB.join(["CAST(row_no AS VARCHAR)"] + [CELLS_OF[w].get(p, "''") for p in range(1, w)])
    for k, w in inputs.WIDTHS.items()
)
SQL["package_line_rejects"] = f"""
SELECT package AS slot, place AS row_no, CAST({PACKAGE_WIDTH} AS INTEGER) AS width,
       CAST({PACKAGE_WIDTH} + 1 AS INTEGER) AS n_cells,
       CASE kind {WHOLE_LINES} END || chr(9) || 'more' AS line
FROM (SELECT *, {RAW_SAID_BY} AS quoted FROM {PACKED}) WHERE {LONG}"""
SQL["landing_ledger"] = f"""
SELECT package AS slot, CAST(CASE WHEN package[9:10] < '12' THEN 1 ELSE 2 END AS INTEGER) AS run,
       1 + count(*) FILTER (NOT ({LONG})) AS n_rows, count(*) FILTER ({LONG}) AS line_rejects
FROM {PACKED} GROUP BY package"""
SQL["landed_day"] = f"""
SELECT slot, row_no, url, {SECONDS} FROM ({PACKAGE_ROWS}) WHERE NOT ({LONG}) AND {IN_DAY}"""
SQL["package_rejects"] = """
SELECT '20240101' || lpad(CAST(page_id AS VARCHAR), 6, '0') AS slot, 'BadZipFile' AS error
FROM pages"""
ODD = f"""'"a", ' || themes || ';' || chr(10) || '"b' || chr(92) || {MARK}"""
for fmt in ("json", "parquet", "csv"):
    SQL[f"feed_{fmt}_sink"] = f"""
SELECT slot, row_no, url, source, {ODD} AS themes, locations, tone, translation,
       {local_iso('date_utc', ZONE, '-0400')} AS date_local_iso, {utc_iso('date_utc')} AS date_utc_iso,
       CAST(epoch_ms(date_utc) AS BIGINT) AS millis,
       strftime({wall('date_utc')}, '%Y-%m-%d') AS local_day
FROM (SELECT f.*, CAST(e.value AS VARCHAR) AS tone
      FROM {one_per_url('true')} f JOIN events e ON e.event_id = f.row_no)"""
SQL["text_sink"] = (
    f"SELECT {FILE} || '.txt' AS file_name, {cleaned('text')} AS text FROM documents"
)
SQL["link_sink"] = f"""
SELECT 'both' AS kind, row_number() OVER (ORDER BY channel, place) AS pos, url,
       left(split_part(url, 'watch?v=', 2), 11) AS video FROM ({UNION})"""
SQL["text_upsert"] = f"""
SELECT {FILE} AS file_name, CASE WHEN doc_id % 5 = 0 THEN {cleaned('text')} ELSE text END AS text FROM documents"""
SQL["json_upsert"] = """
SELECT doc_id, '{"lang":"' || lang || '","size":' ||
       CASE WHEN lang <> 'en' AND n_chars > 500 THEN CAST(n_chars AS VARCHAR) ELSE 'null' END ||
       ',"run":"' || CASE WHEN lang = 'en' THEN 'b' ELSE 'a' END || '"}' AS json FROM documents"""

# ---- whole chains -------------------------------------------------------------------------------

CHANNEL_LINES = f"""
(WITH ids AS (
  SELECT DISTINCT 'c' || user_id AS channel,
         CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE 1 END AS rank,
         event_id AS pos, lpad(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 11, 'v') AS video_id
  FROM events WHERE event_type <> 'error'
), listed AS (
  SELECT * FROM ids QUALIFY row_number() OVER (PARTITION BY channel, rank ORDER BY pos, video_id) <= 8
), once AS (
  SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY channel, video_id ORDER BY rank, pos) = 1
), linked AS (
  SELECT *, row_number() OVER (PARTITION BY channel ORDER BY rank, pos, video_id) AS place FROM once QUALIFY place <= 8
), spoken AS (
  SELECT lpad(CAST(conv_id AS VARCHAR), 11, 'v') AS video_id, string_agg(text, chr(10) ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id
), named AS (
  SELECT channel, place, text, coalesce(source, l.video_id) AS title
  FROM linked l JOIN spoken USING (video_id)
       LEFT JOIN (SELECT lpad(CAST(doc_id AS VARCHAR), 11, 'v') AS video_id, source FROM documents) USING (video_id)
  QUALIFY row_number() OVER (PARTITION BY channel, title ORDER BY place DESC) = 1
)
SELECT channel AS corpus_key, title || '.txt' AS file_name, 0 AS line_no, {cleaned('text')} AS text FROM named
UNION ALL
SELECT channel, title || '.txt', 1, '' FROM named
QUALIFY title || '.txt' < max(title || '.txt') OVER (PARTITION BY channel))"""
SQL["chain"] = blocks(CHANNEL_LINES, 3000)
SQL["channel_list"] = "SELECT url AS channel_url FROM pages WHERE page_id % 3 <> 0 AND page_id % 7 <> 0"
SQL["text_scan"] = """
SELECT md5(body) AS digest, CAST(length(body) AS INTEGER) AS n_chars
FROM (SELECT string_agg(text || chr(10), '' ORDER BY doc_id) AS body FROM documents GROUP BY source)"""
SPANISH_HIT = f"({HOST_HIT} OR {QUERY_HIT} OR {SECTION_HIT})"
SQL["language_argument"] = " UNION ALL ".join(
    f"SELECT {quoted(given)} AS given, page_id FROM pages WHERE {hit}"
    for given, hit in [("'spa', ENG", SPANISH_HIT), ("", "true"), ('""', "true"), (" , ", "true"), ("Spa", SPANISH_HIT)]
)

# ---- streams -----------------------------------------------------------------------------------

SQL["stream_ingest"] = f"SELECT date, source, url, {SECONDS} FROM {FEED}"
DROPPED = f"""
WITH sent AS (
  SELECT p.*, {SAID_BY} AS said_by,
    CASE WHEN day <= 10 AND NOT ((day = 5 AND hour < 12) OR (day = 10 AND hour % 12 = 6)) THEN 0
         WHEN day <= 20 AND NOT (day = 20 AND hour % 12 = 6) THEN 1 ELSE 2 END AS part
  FROM (SELECT *, CAST(package[7:8] AS INTEGER) AS day, CAST(package[9:10] AS INTEGER) AS hour FROM {PACKED}) p
), good AS (
  SELECT * FROM sent WHERE NOT ({LONG})
), marks AS (
  SELECT d AS part, (SELECT max(date_utc) FROM good WHERE part < d) - INTERVAL {inputs.DROP_DELAY} AS mark
  FROM range({inputs.DROPS}) AS r(d)
), timed AS (
  SELECT good.*, coalesce(date_utc < mark, false) AS late FROM good JOIN marks USING (part)
)"""
SQL["stream_late"] = f"""{DROPPED}
SELECT package AS slot, place AS row_no, url, {SECONDS} FROM timed WHERE late"""
SQL["stream_rejects"] = f"""{DROPPED}
SELECT 'line' AS kind, package AS slot, place AS row_no FROM sent WHERE {LONG}
UNION ALL SELECT DISTINCT 'undated', package, 0 FROM sent"""
SQL["stream_dedup"] = f"""{DROPPED}, gaps AS (
  SELECT *, coalesce(date_utc >= lag(date_utc) OVER (PARTITION BY url ORDER BY date_utc)
                                 + INTERVAL {inputs.DROP_DELAY}, true) AS begins
  FROM timed WHERE NOT late
), stories AS (
  SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY date_utc) AS story FROM gaps
), ended AS (
  SELECT *, max(date_utc) OVER (PARTITION BY url, story) AS last FROM stories
)
SELECT url, package AS slot, place AS row_no, said_by AS source FROM ended
WHERE last + INTERVAL {inputs.DROP_DELAY} <= (SELECT max(date_utc) FROM ended) - INTERVAL {inputs.DROP_DELAY}
QUALIFY row_number() OVER (PARTITION BY url, story ORDER BY package, place) = 1"""
SQL["stream_slots"] = f"""
SELECT slot, count(*) AS "rows", count(*) FILTER (url <> '') AS kept_rows
FROM {FEED} GROUP BY slot
HAVING strptime(slot, '%Y%m%d%H%M%S') + INTERVAL 15 MINUTE
       <= (SELECT max(date_utc) - INTERVAL 30 MINUTE FROM {FEED})"""
