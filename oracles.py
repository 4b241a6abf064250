"""The same queries in DuckDB SQL, written on their own: windows and CASE chains instead of the library's forms."""

from __future__ import annotations

from signal_lake.plans.views import view_sql

ORACLES: dict[str, str] = {}

# Fixed values, written out here so that a wrong entry of the library shows.
BOILERPLATE_PATTERNS = [
    r"the post .+ appeared first on .+", r"^the post$", r"^appeared first on$", r"^appeared first on\b", r"continue reading", r"^[→›»↗]+$",
    r"read (the )?(full |more |rest of the )?(article|post|story)", r"^[\[(\s]*\.{2,}[\])\s]*$", r"subscribe\s+to\s+our\s+newsletter", r"sign\s+up\s+for\s+free",
    r"unsubscribe\s+at\s+any\s+time", r"view\s+this\s+(email|newsletter)\s+in\s+your\s+browser", r"powered\s+by\s+\w+", r"click\s+here\s+to\s+read\s+more",
]
AD_MARKERS = ["erid:", "Реклама.", "ИНН ", "промокод", "utm_source=telegram"]
_NAMED = {"quot": '"', "apos": "''", "middot": "·", "copy": "©", "lt": "<", "gt": ">", "amp": "&"}

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_BOILERPLATE = "(?i)" + "|".join(
    f"(?:{p})".replace(r"\w", r"[\p{L}\p{N}_]").replace(r"[\[(\s]*", rf"(?:[\[(]|{_SPACE})*")
    .replace(r"[\])\s]*", rf"(?:[\])]|{_SPACE})*").replace(r"\s+", f"{_SPACE}+")
    for p in BOILERPLATE_PATTERNS
)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def lines(x: str) -> str:
    return f"string_split_regex({x}, '{_BREAK}')"


def is_boilerplate(x: str) -> str:
    return f"regexp_matches({strip(x)}, '{_BOILERPLATE}')"


def clean(x: str) -> str:
    kept = f"list_filter({lines(x)}, lambda l: NOT {is_boilerplate('l')})"
    squeezed = strip(r"regexp_replace(l, '[ \t\x{a0}]+', ' ', 'g')")
    joined = f"array_to_string(list_transform({kept}, lambda l: {squeezed}), chr(10))"
    return strip(rf"regexp_replace({joined}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def views(*names: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({view_sql(name)})" for name in names)


_AD = " OR ".join(f"contains(coalesce(raw_text, ''), '{marker}')" for marker in AD_MARKERS)
_HASH = f"""sha256(CASE WHEN url <> '' THEN lower({strip('url')})
  WHEN title <> '' THEN source_id || '::' || lower({strip('title')})
  ELSE source_id || '::' || substr(coalesce(clean, ''), 1, 300) END)"""

CLEANED = f"""{views('raw_items')},
cleaned AS (SELECT *, fetch_method = 'telegram_api' AND ({_AD}) AS is_ad, {clean("coalesce(raw_text, '')")} AS clean FROM raw_items)"""
HASHED = f"""{CLEANED},
hashed AS (SELECT *, {_HASH} AS content_hash, CASE WHEN is_ad THEN 'ad' WHEN length(clean) < 150 THEN 'short' END AS early FROM cleaned),
screened AS (SELECT * REPLACE (CASE WHEN early IS NULL THEN content_hash END AS content_hash) FROM hashed)"""


def outcome(name: str, rows: str, stored: str | None = None, order: str = "arrival", screened: bool = True) -> str:
    """CTEs giving ``name`` with the outcome of each row, looking back row by row."""
    fine = "WHERE early IS NULL" if screened else ""
    key_free = f"AND NOT EXISTS (SELECT 1 FROM {stored} s WHERE s.source_id = r.source_id AND s.external_content_id = r.external_content_id)" if stored else ""
    known = f"OR content_hash IN (SELECT content_hash FROM {stored})" if stored else ""
    turned_away = f"UNION ALL BY NAME SELECT *, false AS inserted, false AS is_duplicate FROM {rows} WHERE early IS NOT NULL" if screened else ""
    reason = "coalesce(early, CASE WHEN NOT is_duplicate AND NOT inserted THEN 'key_conflict' END)" if screened else "NULL"
    skip = "early IS NOT NULL OR" if screened else ""
    return f"""{name}_keyed AS (
  SELECT *, external_content_id IS NULL OR (row_number() OVER (PARTITION BY source_id, external_content_id ORDER BY {order}) = 1 {key_free}) AS inserted
  FROM {rows} r {fine}),
{name}_flagged AS (
  SELECT *, coalesce(count(*) FILTER (WHERE inserted) OVER (PARTITION BY content_hash ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0
    {known} AS is_duplicate FROM {name}_keyed),
{name}_all AS (SELECT * FROM {name}_flagged {turned_away}),
{name} AS (
  SELECT *, {reason} AS reason,
    CASE WHEN {skip} (NOT is_duplicate AND NOT inserted) THEN 'skipped' WHEN is_duplicate THEN 'duplicate' ELSE 'saved' END AS outcome
  FROM {name}_all)"""


BATCH = f"{HASHED},\n{outcome('ingested', 'screened')}"
_OUTCOME = "arrival, source_id, external_content_id, content_hash, inserted, is_duplicate, outcome, reason"

# --- text and scalars ---

ORACLES["clean_text"] = f"{CLEANED} SELECT arrival, clean AS normalized_text FROM cleaned"
_TEXT = "coalesce(raw_text, '')"
ORACLES["boilerplate"] = f"""{views('raw_items')}, split AS (SELECT arrival, {lines(_TEXT)} AS ls FROM raw_items)
SELECT arrival, len(ls) AS n_lines, len(list_filter(ls, lambda l: {is_boilerplate('l')})) AS n_boilerplate,
  sha256(array_to_string(list_filter(ls, lambda l: NOT {is_boilerplate('l')}), chr(10))) AS kept_sha FROM split"""


# Markup of the given pages as one alternation; every run of it is one gap.
_HIDDEN = r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
_MARKUP = _HIDDEN + r"|<[a-z/!?][^>]*>"


def decoded(x: str) -> str:
    """The references the pages hold; the ampersand last."""
    for name in ("quot", "apos", "middot", "copy", "lt", "gt", "amp"):
        x = f"replace({x}, '&{name};', '{_NAMED[name]}')"
    return x


def nodes(x: str) -> str:
    parts = f"string_split_regex({decoded(f'''regexp_replace({x}, '(?:{_MARKUP})+', chr(1), 'g')''')}, chr(1))"
    return f"array_to_string(list_filter(list_transform({parts}, lambda n: {strip('n')}), lambda n: n <> ''), chr(10))"


_GAPPED = f"regexp_replace(regexp_replace(replace(html, chr(1), ''), '(?:{_MARKUP})+', chr(1), 'g'), '^\\x01+|\\x01+$', '', 'g')"
ORACLES["html_text"] = f"{views('pages_marked')} SELECT page_id, replace({decoded(_GAPPED)}, chr(1), chr(10)) AS page_text FROM pages_marked"
ORACLES["ad_filter"] = f"{CLEANED} SELECT arrival, is_ad FROM cleaned"
ORACLES["min_length"] = f"{CLEANED} SELECT arrival, length(clean) AS n_chars, length(clean) < 150 AS is_short FROM cleaned"
_DATE = """CASE WHEN published_at IN ('2024-01-05T10:00:00Z', '2024-01-05 10:00:00+00', '05 Jan 24 10:00:00 GMT', '2024-01-05 10') THEN epoch(TIMESTAMP '2024-01-05 10:00:00')
  WHEN published_at IN ('2024-01-05T10:00:00+03:00', '2024-01-05T10:00:00+03', 'Fri, 05 Jan 2024 10:00:00 +0300', 'Fri, 05 Jan 24 10:00:00 +0300') THEN epoch(TIMESTAMP '2024-01-05 07:00:00')
  WHEN published_at IN ('2024-01-05', '01/05/24') THEN epoch(TIMESTAMP '2024-01-05') END"""
ORACLES["parse_dates"] = f"{views('landed_manual')} SELECT rec, published_at, CAST({_DATE} AS BIGINT) AS epoch FROM landed_manual"
ORACLES["content_hash"] = f"{HASHED} SELECT arrival, content_hash FROM hashed"
_TYPE = """CASE source_content_type WHEN 'rss_item' THEN 'article' WHEN 'web_page' THEN 'article' WHEN 'manual' THEN 'article'
  WHEN 'tg_message' THEN 'post' WHEN 'hn_item' THEN 'post' WHEN 'yt_video' THEN 'video' ELSE 'unknown' END"""
ORACLES["content_types"] = f"""{views('raw_items')}, kinds AS (
  SELECT 'hf_' || event_type AS source_content_type FROM events UNION ALL SELECT source_content_type FROM raw_items)
SELECT source_content_type, {_TYPE} AS content_type, count(*) AS n_items FROM kinds GROUP BY ALL"""
ORACLES["video_ids"] = """SELECT event_id, CASE WHEN event_id % 4 < 2 THEN substr(md5(CAST(event_id AS VARCHAR)), 1, 11) END AS video_id FROM events"""


def profile_ctes(labelled: str) -> str:
    """Trigram weights of ``labelled`` (lang, text), and of ``asked`` (key, text) the best language."""

    def grams(cols: str, rows: str) -> str:
        return f"""SELECT {cols}, unnest(list_transform(range(1, len(c) - 1), lambda i: (unicode(c[i]) * 7919 + unicode(c[i + 1]) * 127 + unicode(c[i + 2])) % 65536)) AS gram
    FROM (SELECT {cols}, string_split(lower(text), '') AS c FROM {rows} WHERE text <> '')"""

    return f"""counts AS (SELECT lang, gram, count(*) AS n FROM ({grams('lang', labelled)}) GROUP BY lang, gram),
weights AS (SELECT gram, lang, CAST(round(1000 * ln(1 + 1000000 * n / sum(n) OVER (PARTITION BY lang))) AS BIGINT) AS weight FROM counts),
asked_grams AS (SELECT key, gram, count(*) AS n FROM ({grams('key', '(SELECT * FROM asked WHERE length(text) >= 20)')}) GROUP BY key, gram),
scores AS (SELECT key, lang, sum(n * weight) AS score FROM asked_grams JOIN weights USING (gram) GROUP BY key, lang),
best AS (SELECT key, arg_max(lang, (score, lang)) AS detected FROM scores GROUP BY key)"""


ORACLES["language_detect"] = f"""WITH labelled AS (SELECT lang, text FROM documents WHERE doc_id % 2 = 0),
asked AS (SELECT doc_id AS key, text FROM documents), {profile_ctes('labelled')}
SELECT doc_id, lang, doc_id % 2 = 1 AS held_out, detected FROM documents LEFT JOIN best ON key = doc_id"""
ORACLES["language_fill"] = f"""{CLEANED}, labelled AS (SELECT source_language AS lang, clean AS text FROM cleaned WHERE source_language IS NOT NULL),
asked AS (SELECT arrival AS key, clean AS text FROM cleaned WHERE source_language IS NULL), {profile_ctes('labelled')}
SELECT arrival, source_language, coalesce(source_language, detected) AS language FROM cleaned LEFT JOIN best ON key = arrival"""
_DETECTED = f"""labelled AS (SELECT source_language AS lang, clean AS text FROM cleaned WHERE source_language IS NOT NULL),
asked AS (SELECT arrival AS key, clean AS text FROM cleaned WHERE source_language IS NULL), {profile_ctes('labelled')}"""
ORACLES["normalized_items"] = f"""{HASHED}, {_DETECTED} SELECT arrival, source_id, external_content_id, {_TYPE} AS content_type, nullif(clean, '') AS normalized_text,
  content_hash, coalesce(source_language, detected) AS language, 'normalized' AS status,
  CAST(epoch(TIMESTAMP '2024-01-01 07:00:00') AS BIGINT) + arrival % 28 * 86400 AS published_at FROM hashed LEFT JOIN best ON key = arrival"""

# --- dedup and ingestion ---

ORACLES["dedup_batch"] = f"""{HASHED},
{outcome('ingested', 'hashed', screened=False)} SELECT arrival, inserted, is_duplicate, outcome FROM ingested"""
ORACLES["ingest_batch"] = f"{BATCH} SELECT {_OUTCOME} FROM ingested"
_LATE = "(SELECT count(*) * 4 // 10 FROM documents)"
ORACLES["ingest_stream"] = f"""{HASHED}, early_part AS (SELECT * FROM screened WHERE arrival >= {_LATE}),
late_part AS (SELECT * FROM screened WHERE arrival < {_LATE}), {outcome('first_run', 'early_part')},
stored AS (SELECT source_id, external_content_id, content_hash FROM first_run WHERE inserted), {outcome('ingested', 'late_part', 'stored')}
SELECT {_OUTCOME} FROM first_run UNION ALL SELECT {_OUTCOME} FROM ingested"""
ORACLES["ingest_stream_exact"] = ORACLES["ingest_batch"]
_CUT = "(SELECT count(*) * 6 // 10 FROM documents)"
ORACLES["ingest_incremental"] = f"""{HASHED}, early_part AS (SELECT * FROM screened WHERE arrival < {_CUT}),
late_part AS (SELECT * FROM screened WHERE arrival >= {_CUT}), {outcome('first_run', 'early_part')},
stored AS (SELECT source_id, external_content_id, content_hash FROM first_run WHERE inserted), {outcome('ingested', 'late_part', 'stored')}
SELECT {_OUTCOME} FROM ingested"""
ORACLES["content_items"] = f"""{BATCH}, {_DETECTED.replace('FROM cleaned WHERE source_language IS NOT NULL', 'FROM cleaned WHERE NOT is_ad AND source_language IS NOT NULL')} SELECT source_id, external_content_id, {_TYPE} AS content_type, source_content_type, title,
  sha256(raw_text) AS content_sha, sha256(nullif(clean, '')) AS normalized_sha, url, content_hash, coalesce(source_language, detected) AS language,
  'deduplicated' AS status, is_duplicate, CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) AS fetched_at FROM ingested LEFT JOIN best ON key = arrival WHERE inserted"""
_COUNTERS = """count(*) FILTER (WHERE outcome = 'saved') AS saved, count(*) FILTER (WHERE outcome = 'duplicate') AS duplicates,
  count(*) FILTER (WHERE outcome = 'skipped') AS skipped, count(*) FILTER (WHERE outcome = 'error') AS errors"""
ORACLES["run_results"] = f"""{BATCH} SELECT source_id, count(*) AS fetched, {_COUNTERS},
  count(*) FILTER (WHERE outcome = 'error') = 0 AS success FROM ingested GROUP BY source_id"""

# --- registry ---


def trimmed(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def listed(x: str, separator: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, '{separator}'), lambda p: {strip('p')}), lambda p: p <> '')"


_LATIN = "replace(replace(replace(replace(replace(lower(trim(source_name)), 'ö', 'o'), 'ß', 'ss'), '×', 'x'), 'é', 'e'), '™', 'tm')"
_KEY = rf"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({_LATIN}, '[^a-z0-9_\s-]', '', 'g'), '[\s_]+', '-', 'g'), '^-+|-+$', '', 'g'), '-+', '-', 'g')"""
_URL = """CASE WHEN u = '' OR u LIKE '@%' THEN NULL WHEN u LIKE 't.me/%' THEN 'https://' || u
  WHEN lower(u) LIKE 'li search:%' OR lower(u) LIKE 'linkedin search:%' THEN NULL WHEN u LIKE 'http://%' OR u LIKE 'https://%' THEN u
  WHEN u LIKE '%.%' AND u NOT LIKE '% %' AND u NOT LIKE '%/%' THEN 'https://' || u
  WHEN u NOT LIKE '%/%' AND u NOT LIKE '% %' AND u NOT LIKE '%.%' THEN CASE WHEN p = 'FORUM' THEN 'https://news.ycombinator.com/' || u END
  WHEN u LIKE '%.%' AND u NOT LIKE '% %' THEN 'https://' || u END"""
_HANDLE = """CASE WHEN u = '' THEN NULL WHEN u LIKE '@%' THEN u WHEN u LIKE 't.me/%' THEN '@' || string_split(u, 't.me/')[-1]
  WHEN lower(u) LIKE 'li search:%' OR lower(u) LIKE 'linkedin search:%' THEN u WHEN u LIKE 'http://%' OR u LIKE 'https://%' THEN NULL
  WHEN u LIKE '%.%' AND u NOT LIKE '% %' THEN NULL ELSE u END"""
_METHOD = """CASE WHEN p = 'TG' THEN 'telegram_api' WHEN p IN ('SB', 'POD', 'NEWS', 'WEB') THEN 'rss' WHEN p = 'X' THEN 'x_api' WHEN p = 'LI' THEN 'linkedin_api'
  WHEN p IN ('FORUM', 'COMM') AND (lower(u) LIKE '%ycombinator%' OR lower(u) IN ('launches', 'news')) THEN 'hn_api'
  WHEN p = 'TOOL' THEN 'site_change_monitor' ELSE 'web_scraper' END"""
_LANGUAGE = "CASE WHEN r LIKE 'en+ru%' OR r LIKE '%mixed%' THEN 'mixed' WHEN r LIKE 'en%' THEN 'en' WHEN r LIKE 'ru%' THEN 'ru' END"
_FREQUENCY = """CASE WHEN lower(f) = '2-3x_week' THEN '3x_week' WHEN lower(f) IN ('daily', '3x_week', 'weekly') THEN lower(f) ELSE f END"""


def number(x: str) -> str:
    return f"CAST(trunc(TRY_CAST(trim({x}) AS DOUBLE)) AS INTEGER)"


FIELDS = f"""{views('registry_raw')}, trimmed_rows AS (
  SELECT *, trim(url_or_handle) AS u, upper(trim(primary_platform)) AS p, lower(trim(region)) AS r, trim(monitoring_frequency) AS f FROM registry_raw),
fields AS (SELECT *, {_KEY} AS canonical_key, {_URL} AS new_url, {_HANDLE} AS new_handle, {_METHOD} AS fetch_method,
  {_LANGUAGE} AS language, {_FREQUENCY} AS frequency FROM trimmed_rows),
waved AS (SELECT *, CASE WHEN fetch_method IN ('rss', 'telegram_api', 'hn_api', 'manual_import', 'youtube_transcript') THEN 1
  WHEN fetch_method IN ('x_api', 'linkedin_api') THEN 3 ELSE 2 END AS wave FROM fields)"""
SEED = f"""{FIELDS},
seed AS (
  SELECT row_no, trim(source_name) AS source_name, trim(source_name) AS canonical_name, canonical_key, coalesce(nullif(trim(type), ''), 'unknown') AS source_type,
    nullif(trim(region), '') AS region, language, nullif(trim(primary_platform), '') AS primary_platform,
    array_to_string(list_filter(list_concat([trim(primary_platform)], list_filter({listed('secondary_platforms', '[,;]')}, lambda s, i:
      s <> trim(primary_platform) AND list_position({listed('secondary_platforms', '[,;]')}, s) = i)), lambda s: s <> ''), ';') AS platforms,
    new_url AS url, new_handle AS handle, array_to_string({listed('themes', ';')}, ';') AS themes, CAST(NULL AS VARCHAR) AS signal_type,
    CAST({number('signal_quality')} AS SMALLINT) AS signal_quality, CAST(NULL AS SMALLINT) AS early_signal_potential,
    CAST(NULL AS SMALLINT) AS startup_signal_value, CAST(NULL AS SMALLINT) AS content_adaptation_value, CAST(NULL AS SMALLINT) AS brand_fit,
    CAST(coalesce(nullif({number('tier')}, 0), 3) AS SMALLINT) AS tier, CAST(wave AS SMALLINT) AS wave, nullif(frequency, '') AS monitoring_frequency,
    fetch_method, '{{}}' AS fetch_config, true AS is_active, CAST(NULL AS VARCHAR) AS notes
  FROM waved WHERE trim(source_name) <> '' AND canonical_key NOT IN ('reforge-blog-additional', 'ilya-krasinsky')
  QUALIFY row_number() OVER (PARTITION BY canonical_key ORDER BY row_no) = 1)"""

ORACLES["registry_keys"] = f"{FIELDS} SELECT row_no, canonical_key FROM fields"
ORACLES["registry_handles"] = f"{FIELDS} SELECT row_no, new_url AS url, new_handle AS handle FROM fields"
ORACLES["registry_methods"] = f"{FIELDS} ,m AS (SELECT * FROM waved) SELECT row_no, fetch_method, wave, language, frequency AS monitoring_frequency FROM m"
ORACLES["registry_dedup"] = f"{SEED} SELECT canonical_key, row_no, source_name FROM seed"
ORACLES["registry_transform"] = f"{SEED} SELECT * EXCLUDE (row_no) FROM seed"
ORACLES["registry_flat"] = ORACLES["registry_transform"]
ORACLES["registry_violations"] = f"""{SEED} SELECT canonical_key, concat_ws(';', CASE WHEN signal_quality NOT BETWEEN 1 AND 5 THEN 'signal_quality_range' END,
  CASE WHEN tier NOT BETWEEN 1 AND 3 THEN 'tier_range' END) AS violations FROM seed"""
_PROFILE = " UNION ALL ".join(
    f"SELECT '{f}' AS field, CAST({f} AS VARCHAR) AS value, count(*) AS n_sources FROM seed GROUP BY {f}"
    for f in ("tier", "source_type", "region", "monitoring_frequency")
)
ORACLES["registry_profile"] = f"""{SEED}, counts AS ({_PROFILE})
SELECT field, value, n_sources, round(n_sources / (SELECT count(*) FROM seed), 4) AS share FROM counts"""
ORACLES["active_sources"] = f"""{SEED} SELECT tier, wave, source_name, canonical_key, fetch_method FROM seed
WHERE row_no % 7 <> 0 AND fetch_method = 'rss' AND wave = 1 ORDER BY tier, wave, source_name, canonical_key"""
ORACLES["source_by_key"] = f"""{SEED} SELECT canonical_key, CASE WHEN row_no % 7 = 0 THEN 'not active' END AS problem FROM seed
UNION ALL SELECT 'gone-' || row_no, 'not found' FROM registry_raw"""
ORACLES["unroutable_sources"] = f"{SEED} SELECT canonical_key, 'm_' || fetch_method AS fetch_method FROM seed WHERE row_no % 9 = 0"
ERRORS = f"""{SEED}, errors AS (
  SELECT canonical_key, fetch_method, CASE WHEN fetch_method IN ('x_api', 'linkedin_api') THEN fetch_method || ' is not implemented'
    WHEN fetch_method = 'rss' AND url IS NULL THEN 'no feed address' WHEN fetch_method = 'telegram_api' AND handle IS NULL THEN 'no channel'
    WHEN fetch_method IN ('web_scraper', 'site_change_monitor') AND url IS NULL THEN 'no address to scrape' END AS message, true AS recorded
  FROM seed)"""
ORACLES["source_errors"] = f"{ERRORS} SELECT * FROM errors WHERE message IS NOT NULL"
_ERROR_ROWS = f"(SELECT canonical_key FROM ({ERRORS} SELECT * FROM errors WHERE message IS NOT NULL))"
ORACLES["run_summary"] = f"""{BATCH}, per_source AS (SELECT source_id, count(*) AS fetched, {_COUNTERS} FROM ingested GROUP BY source_id),
failed AS (SELECT count(*) AS n FROM {_ERROR_ROWS})
SELECT count(*) + any_value(n) AS sources, CAST(sum(fetched) AS BIGINT) AS fetched, CAST(sum(saved) AS BIGINT) AS saved,
  CAST(sum(duplicates) AS BIGINT) AS duplicates, CAST(sum(errors) + any_value(n) AS BIGINT) AS errors, any_value(n) AS failed_sources FROM per_source, failed"""
ORACLES["failed_sources"] = f"SELECT canonical_key AS source_id, CAST(1 AS BIGINT) AS errors FROM {_ERROR_ROWS}"
_T0, _T1 = "CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT)", "CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT)"
_THIRD = "(SELECT count(*) // 3 FROM customer)"
ORACLES["upsert_sources"] = f"""{SEED} SELECT sha256(canonical_key) AS id, canonical_key, source_name,
  CASE WHEN row_no > {_THIRD} THEN tier ELSE CAST(1 AS SMALLINT) END AS tier, row_no > {_THIRD} AS is_active,
  CASE WHEN row_no <= 2 * {_THIRD} THEN 3 ELSE 0 END AS error_count,
  CASE WHEN row_no <= 2 * {_THIRD} THEN {_T0} ELSE {_T1} END AS created_at, CASE WHEN row_no > {_THIRD} THEN {_T1} ELSE {_T0} END AS updated_at FROM seed"""
ORACLES["source_state"] = f"""{ERRORS} SELECT canonical_key, CASE WHEN message IS NULL THEN 0 ELSE 1 END AS error_count, message AS last_error_msg,
  CASE WHEN message IS NOT NULL THEN {_T1} END AS last_error_at, CASE WHEN message IS NULL THEN {_T1} END AS last_checked_at, {_T1} AS updated_at FROM errors"""
ORACLES["status_update"] = """WITH last AS (SELECT event_id % (SELECT count(*) FROM documents) AS id, max(event_id) AS seq FROM events GROUP BY 1)
SELECT doc_id AS id, CASE WHEN seq IS NULL THEN 'deduplicated' WHEN seq % 3 = 0 THEN 'candidate' ELSE 'selected' END AS status
FROM documents LEFT JOIN last ON id = doc_id"""
ORACLES["stored_changes"] = """WITH last AS (SELECT event_id % (SELECT count(*) FROM documents) AS id, max(event_id) AS seq FROM events WHERE event_id % 5 = 0 GROUP BY 1)
SELECT doc_id AS id, source AS source_id, CASE WHEN seq IS NULL THEN 'deduplicated' WHEN seq % 3 = 0 THEN 'candidate' ELSE 'selected' END AS status
FROM documents LEFT JOIN last ON id = doc_id WHERE CAST(substr(source, 4) AS INT) % 7 <> 2"""
ORACLES["cascade_delete"] = """SELECT doc_id AS arrival, source AS source_id FROM documents WHERE CAST(substr(source, 4) AS INT) % 2 = 1"""

_OWNED = f"""{SEED}, owned AS (SELECT sha256(f.canonical_key) AS new_source_id, s.canonical_key, s.canonical_name, s.source_name, s.tier, s.wave, s.handle,
  s.language AS new_language, s.fetch_method AS new_method, raw.* FROM ({view_sql('raw_items')}) raw
  JOIN fields f ON f.row_no = raw.arrival % (SELECT count(*) FROM customer) LEFT JOIN seed s ON s.canonical_key = f.canonical_key)"""
ORACLES["items_enriched"] = f"""{_OWNED} SELECT arrival AS pos, new_source_id AS source_id, canonical_name, new_language AS source_language,
  new_method AS fetch_method, handle FROM owned"""
ORACLES["ingest_wave1"] = f"""{_OWNED}, raw_wave AS (
  SELECT canonical_key, arrival AS pos, new_source_id AS source_id, external_content_id, new_method AS fetch_method, title, raw_text, url,
    row_number() OVER (ORDER BY tier, wave, source_name, canonical_key, arrival) AS arrival FROM owned WHERE wave = 1),
cleaned AS (SELECT *, fetch_method = 'telegram_api' AND ({_AD}) AS is_ad, {clean("coalesce(raw_text, '')")} AS clean FROM raw_wave),
hashed AS (SELECT *, {_HASH} AS content_hash, CASE WHEN is_ad THEN 'ad' WHEN length(clean) < 150 THEN 'short' END AS early FROM cleaned),
screened AS (SELECT * REPLACE (CASE WHEN early IS NULL THEN content_hash END AS content_hash) FROM hashed),
{outcome('ingested', 'screened')} SELECT canonical_key, pos, content_hash, inserted, is_duplicate, outcome, reason FROM ingested"""



def _run_ctes(run: int, part: str, stored: str | None) -> str:
    """One run of ``run_twice``: the landed documents by connector, in the order of the run, to outcomes."""
    newer = f"AND msg > coalesce((SELECT max(msg) FROM landed_{run - 1} l WHERE l.source_id = o.source_id AND l.method = 'telegram_api'), 0)" if run > 1 else ""
    return f"""landed_{run} AS (SELECT o.*, o.arrival AS msg FROM several o WHERE {part}),
picked_{run} AS (SELECT * FROM landed_{run} o WHERE method <> 'telegram_api' OR (raw_text IS NOT NULL AND trim(raw_text) <> '' {newer} AND msg > 0)
  QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY CASE method WHEN 'telegram_api' THEN -msg ELSE pos END) <= 50 OR method = 'manual_import'),
raw_{run} AS (SELECT source_id, canonical_key, new_language, method AS fetch_method,
    CASE method WHEN 'telegram_api' THEN CAST(msg AS VARCHAR) WHEN 'rss' THEN coalesce(external_content_id, nullif(url, '')) ELSE external_content_id END AS external_content_id,
    CASE WHEN method <> 'telegram_api' THEN title END AS title, CASE method WHEN 'rss' THEN coalesce(raw_text, '') ELSE raw_text END AS raw_text,
    CASE WHEN method <> 'telegram_api' THEN url END AS url,
    row_number() OVER (ORDER BY tier, wave, source_name, canonical_key, pos) AS arrival FROM picked_{run}),
cleaned_{run} AS (SELECT *, fetch_method = 'telegram_api' AND ({_AD}) AS is_ad, {clean("coalesce(raw_text, '')")} AS clean FROM raw_{run}),
hashed_{run} AS (SELECT *, {_HASH} AS content_hash, CASE WHEN is_ad THEN 'ad' WHEN length(clean) < 150 THEN 'short' END AS early FROM cleaned_{run}),
screened_{run} AS (SELECT * REPLACE (CASE WHEN early IS NULL THEN content_hash END AS content_hash) FROM hashed_{run}),
{outcome(f'run_{run}', f'screened_{run}', stored)},
stored_{run} AS (SELECT source_id, external_content_id, content_hash FROM run_{run} WHERE inserted),
counted_{run} AS (SELECT id AS source_id, count(r.source_id) AS fetched_{run}, count(*) FILTER (outcome = 'saved') AS saved_{run},
  count(*) FILTER (outcome = 'duplicate') AS duplicates_{run}, count(*) FILTER (outcome = 'skipped') AS skipped_{run}
  FROM named LEFT JOIN run_{run} r ON r.source_id = id GROUP BY id)"""


ORACLES["run_twice"] = f"""{SEED}, named AS (SELECT *, sha256(canonical_key) AS id, ['manual_import', 'telegram_api', 'rss'][row_no % 3 + 1] AS new_method FROM seed),
several AS (SELECT n.id AS source_id, n.canonical_key, n.tier, n.wave, n.source_name, n.language AS new_language, n.new_method AS method, raw.arrival AS pos, raw.* EXCLUDE (source_id, fetch_method)
  FROM ({view_sql('raw_items')}) raw JOIN fields f ON f.row_no = raw.arrival % (SELECT count(*) // 6 FROM customer) + 1 JOIN named n ON n.canonical_key = f.canonical_key),
{_run_ctes(1, "arrival < (SELECT count(*) * 7 // 10 FROM documents)", None)},
{_run_ctes(2, "arrival >= (SELECT count(*) * 4 // 10 FROM documents)", 'stored_1')},
both_runs AS (SELECT *, {_T0} AS fetched_at FROM run_1 UNION ALL SELECT *, {_T1} FROM run_2)
SELECT b.source_id, external_content_id, title, content_hash, new_language AS language, is_duplicate, fetched_at,
  fetched_1, saved_1, duplicates_1, skipped_1, fetched_2, saved_2, duplicates_2, skipped_2
FROM both_runs b JOIN counted_1 USING (source_id) JOIN counted_2 USING (source_id) WHERE inserted"""

# --- connectors ---

ORACLES["manual_items"] = f"""{views('landed_manual')} SELECT rec, coalesce(nullif(external_content_id, ''), nullif(id, '')) AS external_content_id,
  'manual' AS source_content_type, coalesce(nullif(raw_text, ''), nullif(content, ''), nullif(text, '')) AS raw_text, CAST({_DATE} AS BIGINT) AS published_at,
  CASE WHEN regexp_matches(trim(engagement_like_count), '^-?[0-9]+$') THEN CAST(trim(engagement_like_count) AS INTEGER) END AS engagement_like_count FROM landed_manual"""
_SHA = r"sha256(regexp_replace(text, '\s+', '', 'g'))"
_FEED_TIME = "CAST(epoch(TIMESTAMP '2024-01-05 07:00:00') AS BIGINT)"
ORACLES["feed_items"] = f"""SELECT doc_id, CAST(0 AS BIGINT) AS pos, 'g' || doc_id AS external_content_id, 'T ' || doc_id AS title, 'https://ex.org/' || doc_id AS url,
  source AS author_name, {_FEED_TIME} AS published_at, {_SHA} AS text_sha FROM documents WHERE doc_id % 11 = 0
UNION ALL SELECT doc_id, 1, 'https://ex.org/u' || doc_id, 'U', 'https://ex.org/u' || doc_id, NULL, NULL, {_SHA} FROM documents WHERE doc_id % 11 = 0
UNION ALL SELECT doc_id, 0, 'a' || doc_id, 'A ' || doc_id, 'https://ex.org/a' || doc_id, source, {_FEED_TIME} + 3 * 3600, {_SHA} FROM documents WHERE doc_id % 11 = 1
UNION ALL SELECT doc_id, 0, 'r' || doc_id, 'R' || chr(160) || doc_id, 'https://ex.org/r' || doc_id, NULL, {_FEED_TIME} - 7 * 3600, {_SHA} FROM documents WHERE doc_id % 11 = 2
UNION ALL SELECT doc_id, 0, 'x' || doc_id, 'X ' || doc_id, 'https://ex.org/x' || doc_id, NULL, NULL, {_SHA} FROM documents WHERE doc_id % 11 = 3
UNION ALL SELECT doc_id, 0, 'https://ex.org/p' || doc_id, 'P ' || doc_id, 'https://ex.org/p' || doc_id, NULL, NULL, {_SHA} FROM documents WHERE doc_id % 11 = 4
UNION ALL SELECT doc_id, 0, 'n' || doc_id, 'N ' || doc_id, 'https://ex.org/n' || doc_id, source, NULL, {_SHA} FROM documents WHERE doc_id % 11 = 8
UNION ALL SELECT doc_id, 0, 'm' || doc_id, 'M ' || doc_id, 'https://ex.org/m' || doc_id, NULL, NULL, sha256('a<channel>of<rssversion="2.0">and<atom:item>' || doc_id) FROM documents WHERE doc_id % 11 = 9
UNION ALL SELECT doc_id, 0, 'c' || doc_id, 'C ' || doc_id, NULL, NULL, NULL, {_SHA} FROM documents WHERE doc_id % 11 = 10"""
ORACLES["feed_errors"] = "SELECT doc_id, 'feed parse error' AS message FROM documents WHERE doc_id % 11 IN (5, 7)"


_DUMP_SHA = "sha256(CASE doc_id % 5 WHEN 3 THEN '<item><!--' || regexp_replace(replace(text, ']]>', ''), '\\s+', '', 'g') ELSE regexp_replace(text, '\\s+', '', 'g') END)"
ORACLES["feed_dump"] = f"""SELECT doc_id % 5 AS g, row_number() OVER (PARTITION BY doc_id % 5 ORDER BY doc_id) - 1 AS ahead,
  CASE doc_id % 5 WHEN 0 THEN 'g' WHEN 1 THEN 'a' WHEN 2 THEN 'r' ELSE 'c' END || doc_id AS external_content_id,
  CASE doc_id % 5 WHEN 0 THEN 'T ' WHEN 1 THEN 'A ' WHEN 2 THEN 'R ' ELSE 'C ' END || doc_id AS title, {_DUMP_SHA} AS text_sha
FROM documents WHERE doc_id % 5 < 4"""
ORACLES["feed_dump_errors"] = "SELECT DISTINCT CAST(4 AS BIGINT) AS g, CAST(NULL AS BIGINT) AS pos, 'feed parse error' AS message FROM documents"


def hn(limit: int, extra: str) -> str:
    return f"""{views('hn_items', 'hn_feed')} SELECT i.id, feed_rank, CAST(i.id AS VARCHAR) AS external_content_id, title, '' AS raw_text,
  coalesce(nullif(url, ''), 'https://news.ycombinator.com/item?id=' || i.id) AS url, author AS author_name, CAST(floor(epoch(time_ts)) AS BIGINT) AS published_at,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS engagement_comment_count
FROM hn_feed f JOIN hn_items i ON i.id = f.id WHERE feed_rank <= {limit} AND NOT deleted AND NOT dead {extra}"""


ORACLES["hn_items"] = hn(30, "AND score >= 0")
ORACLES["hn_show"] = hn(2000, "AND score >= 5 AND title LIKE 'Show HN%'")
ORACLES["hn_ask"] = hn(2000, "AND feed_rank % 2 = 1 AND score >= 5 AND title LIKE 'Ask HN%'")
_PAPER_TIME = "CASE WHEN doc_id % 4 < 2 THEN CAST(epoch(TIMESTAMP '2024-01-05 10:00:00') AS BIGINT) END"
ORACLES["hf_papers"] = f"""SELECT doc_id, 'p' || doc_id AS external_content_id, 'Paper ' || doc_id AS title, text AS raw_text,
  'https://huggingface.co/papers/p' || doc_id AS url, CASE WHEN doc_id % 3 > 0 THEN source END AS author_name, {_PAPER_TIME} AS published_at,
  CAST(doc_id % 50 AS INTEGER) AS engagement_comment_count FROM documents"""
ORACLES["hf_models"] = """SELECT event_id, 'org/m' || event_id AS external_content_id, 'org/m' || event_id AS title,
  'Tags: ' || array_to_string(list_transform(range(1, event_id % 13 + 2), lambda i: 't' || i), ', ') AS raw_text,
  'https://huggingface.co/org/m' || event_id AS url, event_type AS author_name, CAST(epoch(TIMESTAMP '2024-01-05 10:00:00') AS BIGINT) AS published_at,
  least(event_id % 13 + 1, 10) AS payload_tags FROM events"""
ORACLES["channel_messages"] = f"""{views('messages')}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY msg_id DESC) AS place FROM messages WHERE msg_id > 1)
SELECT channel_id, msg_id, CAST(msg_id AS VARCHAR) AS external_content_id, 'tg_message' AS source_content_type, text AS raw_text,
  'https://t.me/c' || channel_id || '/' || msg_id AS url FROM placed WHERE place <= 3 AND text <> ''"""
ORACLES["channel_cursor"] = f"{views('messages')} SELECT channel_id, max(msg_id) AS min_id FROM messages GROUP BY channel_id"
ORACLES["transcripts"] = """SELECT CAST(conv_id AS VARCHAR) AS video_id, count(*) AS segment_count, string_agg(text, ' ' ORDER BY turn) AS raw_text,
  'https://www.youtube.com/watch?v=' || conv_id AS url, 'Channel' AS author_name FROM conversations GROUP BY conv_id"""
ORACLES["transcript_pick"] = """WITH candidates AS (SELECT user_id AS video_id,
  CASE WHEN user_id % 4 = 0 THEN CASE event_id % 2 WHEN 0 THEN 'de' ELSE 'fr' END
    ELSE CASE event_id % 5 WHEN 0 THEN 'ru' WHEN 1 THEN 'en' WHEN 2 THEN 'de' ELSE 'fr' END END AS lang,
  event_type <> 'view' OR user_id % 3 = 0 AS is_generated FROM events),
usable AS (SELECT DISTINCT * FROM candidates WHERE lang IN ('ru', 'en') OR NOT is_generated)
SELECT video_id, lang, is_generated FROM usable QUALIFY row_number() OVER (PARTITION BY video_id
  ORDER BY CASE lang WHEN 'ru' THEN 1 WHEN 'en' THEN 2 ELSE 3 END, is_generated, lang) = 1"""
_BODY = f"regexp_replace(html, '{_HIDDEN}', '', 'g')"
_INNER = "coalesce(" + ", ".join(
    f"nullif(regexp_extract({_BODY}, '(?s){start}(.*?){end}', 1), '')"
    for start, end in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"))
) + f", {_BODY})"
_OG = f"""nullif(regexp_extract({_BODY}, '<meta name="a > b" property="og:title" content="([^"]*)">', 1), '')"""
_HEAD = f"""nullif({strip(f"regexp_extract({_BODY}, '(?s)<title>(.*?)</title>', 1)")}, '')"""
ORACLES["web_items"] = f"""{views('pages_aug')} SELECT page_id, url AS external_content_id, {decoded(f'coalesce({_OG}, {_HEAD})')} AS title,
  {nodes(_INNER)} AS raw_text, url FROM pages_aug"""
ORACLES["page_changes"] = f"""{views('page_snapshots')}, texts AS (
  SELECT url, snap, {nodes(f"regexp_extract({_BODY}, '(?s)<article>(.*?)</article>', 1)")} AS t FROM page_snapshots),
walked AS (SELECT *, lag(t) OVER (PARTITION BY url ORDER BY snap) AS before FROM texts)
SELECT url, snap, CASE WHEN before IS NULL THEN 'new' WHEN before = t THEN 'same' ELSE 'changed' END AS state FROM walked"""
ORACLES["page_change_items"] = f"""{views('page_snapshots')}, texts AS (
  SELECT url, snap, {nodes(f"regexp_extract({_BODY}, '(?s)<article>(.*?)</article>', 1)")} AS t FROM page_snapshots),
walked AS (SELECT *, lag(t) OVER (PARTITION BY url ORDER BY snap) AS before FROM texts),
split AS (SELECT url, snap, t, string_split(t, chr(10)) AS now, string_split(before, chr(10)) AS old FROM walked WHERE before <> t)
SELECT url || '#' || substr(sha256(t), 1, 16) AS external_content_id, url || '#' || substr(sha256(t), 1, 16) AS url, snap,
  array_to_string(list_filter(now, lambda l: l <> '' AND NOT list_contains(old, l)), chr(10)) AS raw_text,
  array_to_string(list_filter(old, lambda l: l <> '' AND NOT list_contains(now, l)), '|') AS removed FROM split"""
ORACLES["first_n_per_source"] = f"""{views('raw_items')} SELECT source_id, arrival FROM raw_items
QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY arrival) <= CASE fetch_method WHEN 'rss' THEN 7 WHEN 'telegram_api' THEN 5 ELSE 3 END"""

# --- what runs are made of ---

_BAD = "CASE WHEN signal_quality NOT BETWEEN 1 AND 5 THEN 'signal_quality_range' END, CASE WHEN tier NOT BETWEEN 1 AND 3 THEN 'tier_range' END"
ORACLES["registry_load"] = f"""{SEED}, checked AS (SELECT *, concat_ws(';', {_BAD}) AS violations FROM seed)
SELECT canonical_key, tier, CASE WHEN violations <> '' THEN NULL WHEN row_no <= {_THIRD} THEN {_T0} ELSE {_T1} END AS created_at,
  CASE WHEN violations = '' THEN {_T1} END AS updated_at, violations FROM checked"""
ORACLES["registry_configs"] = f"""{SEED} SELECT canonical_key, CAST(row_no AS BIGINT) AS item_limit, 'ru,' || canonical_key AS languages,
  platforms FROM seed"""
ORACLES["csv_import"] = "SELECT CAST(doc_id AS VARCHAR) AS external_content_id, source AS author_name, sha256(text) AS text_sha FROM documents"
ORACLES["json_import"] = ORACLES["csv_import"]
ORACLES["registry_list"] = f"""{SEED} SELECT canonical_key, source_name, fetch_method, tier, 'note "' || row_no || '",' || chr(10) || 'second line' AS notes FROM seed"""
ORACLES["distinct_stream"] = f"{BATCH} SELECT DISTINCT content_hash FROM ingested WHERE content_hash IS NOT NULL"
ORACLES["routed_items"] = """SELECT doc_id, CASE doc_id % 4 WHEN 2 THEN 'manual_import' WHEN 3 THEN 'own_api' ELSE 'huggingface_api' END AS fetch_method,
  CASE doc_id % 4 WHEN 0 THEN 'p' WHEN 1 THEN 'm' WHEN 3 THEN 'o' ELSE '' END || doc_id AS external_content_id,
  CASE doc_id % 4 WHEN 0 THEN 'hf_paper' WHEN 1 THEN 'hf_model' ELSE 'manual' END AS source_content_type,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 3 THEN lang ELSE source END AS author_name,
  sha256(CASE WHEN doc_id % 4 = 1 THEN 'Tags: ' || lang ELSE text END) AS text_sha FROM documents"""
ORACLES["dry_run"] = f"""{ERRORS}, failed AS (SELECT DISTINCT f.canonical_key AS failed_key FROM documents d
  JOIN fields f ON f.row_no = d.doc_id % (SELECT count(*) FROM customer) WHERE d.doc_id % 11 IN (5, 7)),
counted AS (SELECT canonical_key, CAST(message IS NOT NULL OR failed_key IS NOT NULL AS BIGINT) AS errors FROM errors LEFT JOIN failed ON failed_key = canonical_key)
SELECT canonical_key, CAST(0 AS BIGINT) AS fetched, CAST(0 AS BIGINT) AS saved, errors, errors = 0 AS success FROM counted"""
