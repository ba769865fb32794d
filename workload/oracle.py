"""DuckDB SQL with the same results as `workload.queries`, written on its own."""

from __future__ import annotations

from recordwash.functions.reasons import REASON_KEYWORDS, TITLE_KEYWORDS
from recordwash.schema import MATCH_FAMILY, OTHER_FAMILY, RECORD_FIELDS
from workload.fixtures import COURTS_CTE, FIRST_BATCH_YEAR, LINES_CTE, MESSAGES_CTE, VARIED_CTE


def _clean(x: str) -> str:
    return f"(CASE WHEN trim({x}) = '' OR {x} = 'null' THEN NULL ELSE {x} END)"


def _raw(key: str) -> str:
    return f"json_extract_string(value, '$.{key}')"


def _key(key: str) -> str:
    if key == key.lower():
        return _clean(_raw(key))
    return f"coalesce({_clean(_raw(key))}, {_clean(_raw(key.lower()))})"


def _number(x: str) -> str:
    return (
        f"replace(replace(translate({x}, '[【（〔]】）〕 　', '(((())))'), '号)', '号'), '((', '(')"
    )


def _alternatives(words: list[str]) -> str:
    return "|".join(sorted(set(words), key=lambda w: (-len(w), w)))


def _reason(title: str) -> str:
    disputes = f"(?:{_alternatives(REASON_KEYWORDS)})*.?纠纷"
    offences = f"{_alternatives(TITLE_KEYWORDS)}|爆炸物*.?"
    return (
        f"coalesce(nullif(array_to_string(regexp_extract_all({title}, '{disputes}'), ','), ''), "
        f"nullif(array_to_string(regexp_extract_all({title}, '{offences}'), ','), ''))"
    )


_NUMERALS = ", ".join(
    f"'{tens}{unit}'"
    for tens in ("", "十", "二十", "三十")
    for unit in ("", *"一二三四五六七八九")
    if tens + unit
)


def _court_in(c: str) -> str:
    return f"nullif(regexp_extract({c}, '[一-龥]{{2,}}人民法院'), '')"


def _number_in(c: str) -> str:
    found = _number(f"nullif(regexp_extract({c}, '[(（][21].*?[）)][一-龥]*\\d*[一-龥]*\\d*号'), '')")
    return f"split_part({found}, '&nbsp<br>', 1)"


def _type_in(c: str) -> str:
    return f"nullif(regexp_extract({c}, '[民刑]事'), '')"


def _doctype_in(c: str) -> str:
    found = f"nullif(regexp_extract({c}, '(?:判[\\s　]*决|裁[\\s　]*定)[\\s　]*书'), '')"
    return f"regexp_replace({found}, '[\\s　]', '', 'g')"


def _date_in(c: str) -> str:
    numeral = "[一二三四五六七八九十]{1,3}"
    pattern = f"[〇○Ｏ零一二三四五六七八九]{{4}}年{numeral}月{numeral}日"
    w = f"nullif(regexp_extract(regexp_replace({c}, '[ 　\\t\\n\\r]', '', 'g'), '{pattern}'), '')"

    def number(part: str) -> str:
        return f"lpad(cast(list_position([{_NUMERALS}], {part}) AS string), 2, '0')"

    year = f"translate(substr({w}, 1, 4), '〇○Ｏ零一二三四五六七八九', '0000123456789')"
    month = number(f"regexp_extract({w}, '年(.+)月', 1)")
    day = number(f"regexp_extract({w}, '月(.+)日', 1)")
    return f"try_cast({year} || '-' || {month} || '-' || {day} AS DATE)"


_FIELDS = {f: _key(f) for f in RECORD_FIELDS}
_FIELDS["caseNumber"] = _clean(_number(_key("caseNumber")))
_FIELDS["status"] = f"try_cast({_key('status')} AS INTEGER)"
_FIELDS["reason"] = _reason(_key("title"))

KEPT = f"""{MESSAGES_CTE},
kept AS MATERIALIZED (
  SELECT k, y, value FROM msgs WHERE value LIKE '{{%' AND value LIKE '%}}'
)"""

RECORDS = f"""{KEPT},
rec AS MATERIALIZED (
  SELECT k, y, value, {", ".join(f"{x} AS {f}" for f, x in _FIELDS.items())} FROM kept
)"""


def _field_code(declared: str, found: str, agrees: str) -> str:
    return (
        f"CASE WHEN {declared} IS NULL AND {found} IS NULL THEN 3 "
        f"WHEN {declared} IS NULL OR {found} IS NULL THEN 1 "
        f"WHEN coalesce({agrees}, false) THEN 1 ELSE 3 END"
    )


LEGS = f"""{RECORDS},
found AS MATERIALIZED (
  SELECT *, {_number_in("content")} AS f_number, {_court_in("content")} AS f_court,
    {_date_in("content")} AS f_date, {_type_in("content")} AS f_type
  FROM rec
),
legs AS (
  SELECT *,
    CASE WHEN caseNumber IS NULL AND f_number IS NULL THEN
        CASE WHEN court LIKE '%高级人民法院%' OR content LIKE '%死刑复核%' THEN 2 ELSE 3 END
      WHEN caseNumber IS NULL OR f_number IS NULL OR caseNumber = f_number THEN 1
      ELSE 3 END AS number_code,
    {_field_code("court", "f_court", "court = f_court")} AS court_code,
    {_field_code("judgementDate", "f_date", "try_cast(judgementDate AS DATE) = f_date")} AS date_code,
    {_field_code("caseType", "f_type", "caseType = f_type")} AS type_code
  FROM found
),
labelled AS (
  SELECT *,
    CASE number_code WHEN 1 THEN '案号正常' WHEN 2 THEN '无需案号类' ELSE '匹配异常' END AS number_label,
    CASE court_code WHEN 1 THEN '法院正常' ELSE '法院异常' END AS court_label,
    CASE date_code WHEN 1 THEN '裁判日期正常' ELSE '裁判日期异常' END AS date_label,
    CASE type_code WHEN 1 THEN '文书类型正常' ELSE '文书类型异常' END AS type_label
  FROM legs
)"""

_OTHERS = [f for f in RECORD_FIELDS if f not in ("caseNumber", "court")]
ROUTED = f"""{LEGS},
routed AS MATERIALIZED (
  SELECT k, y, value, coalesce(caseNumber, f_number) AS caseNumber,
    coalesce(court, f_court) AS court, {", ".join(_OTHERS)},
    CASE WHEN greatest(number_code, court_code, date_code, type_code) = 3 THEN 3
      ELSE number_code END AS route,
    nullif(concat_ws(',', CASE WHEN number_code <> 1 THEN number_label END,
      CASE WHEN court_code <> 1 THEN court_label END,
      CASE WHEN date_code <> 1 THEN date_label END,
      CASE WHEN type_code <> 1 THEN type_label END), '') AS check_notes
  FROM labelled
),
clean AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY caseNumber, court ORDER BY k) AS rn,
    count(*) OVER (PARTITION BY caseNumber, court) AS copies
  FROM routed WHERE route IN (1, 2)
)"""

HISTORY = f"""{ROUTED},
past AS MATERIALIZED (
  SELECT caseNumber, court FROM clean WHERE y < {FIRST_BATCH_YEAR}
),
batch AS MATERIALIZED (
  SELECT k, caseNumber, court FROM clean WHERE y >= {FIRST_BATCH_YEAR}
  QUALIFY row_number() OVER (PARTITION BY caseNumber, court ORDER BY k) = 1
)"""

_ON = "a.caseNumber = b.caseNumber AND a.court = b.court"
_RECORD = ", ".join(RECORD_FIELDS)


def _date(x: str) -> str:
    return (
        f"(CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast({x} AS DATE) "
        f"WHEN regexp_full_match({x}, '\\d{{8}}') THEN try_cast(substr({x}, 1, 4) || '-' || "
        f"substr({x}, 5, 2) || '-' || substr({x}, 7, 2) AS DATE) END)"
    )


_SUFFIX = "court LIKE '%' || f_court OR f_court LIKE '%' || court"
#: The same for messages in all their forms.
VARIED = (
    ROUTED.replace(MESSAGES_CTE, f"{MESSAGES_CTE}, {VARIED_CTE}")
    .replace("FROM msgs WHERE", "FROM varied WHERE json_valid(value) AND")
    .replace("court = f_court", _SUFFIX)
    .replace("try_cast(judgementDate AS DATE)", _date("judgementDate"))
)
_BY_CRAWL = f"{_date('crawlDate')} NULLS LAST, crawlDate NULLS LAST, k"


def _wash(chunk: str, routed: str = ROUTED, order: str = "k", judged: str = "judgementDate") -> str:
    """Chunks are washed in order; each is compared with what earlier ones kept."""
    return f"""WITH {routed},
    numbered AS (
      SELECT *, {chunk} AS chunk,
        CASE route
          WHEN 1 THEN '1' || chr(1) || caseNumber || chr(1) || court
          WHEN 2 THEN '2' || chr(1) || coalesce(court, chr(2)) || chr(1)
            || coalesce(title, chr(2)) || chr(1) || coalesce({judged}, chr(2))
        END AS match
      FROM routed
    ),
    singles AS (
      SELECT * FROM numbered
      QUALIFY row_number() OVER (PARTITION BY chunk, value ORDER BY k) = 1
    ),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY match, chunk ORDER BY {order}) AS rn,
        min(chunk) OVER (PARTITION BY match) AS first_chunk
      FROM singles
    ),
    fates AS (
      SELECT *, CASE WHEN route = 3 THEN NULL WHEN rn > 1 THEN 'batch'
        WHEN chunk > first_chunk THEN 'history' END AS dup_kind
      FROM ranked
    )
    SELECT k, CASE WHEN route = 3 THEN 'review' WHEN dup_kind IS NULL THEN 'main'
      ELSE 'duplicates' END AS dest, dup_kind, route, check_notes, {_RECORD}
    FROM fates"""


def _extracted(expression: str) -> str:
    return f"""WITH {KEPT}, texts AS (
      SELECT k, {_raw("content")} AS content, {_raw("title")} AS title FROM kept
    ) SELECT k, {expression} AS found FROM texts"""


def _part(i: int) -> str:
    return f"split_part(value, '|', {i})"


_DELIMITED = f"""WITH {LINES_CTE},
  sized AS (SELECT k, value, len(string_split(value, '|')) AS n FROM packed),
  cleaned AS (
    SELECT k, n,
      CASE WHEN n = 8 THEN translate({_part(1)}, '（）', '()') END AS caseNumber,
      CASE WHEN n = 8 THEN {_part(2)} END AS title,
      CASE WHEN n = 8 THEN {_part(3)} END AS court,
      CASE WHEN n = 8 THEN coalesce({_clean(_part(4))}, {_reason(_part(2))}) END AS reason,
      CASE WHEN n = 8 THEN replace({_part(5)}, '-', '') END AS publishDate,
      CASE WHEN n = 8 THEN {_part(6)} END AS sourceUrl,
      CASE WHEN n = 8 THEN {_part(7)} END AS content,
      CASE WHEN n = 8 THEN replace({_part(8)}, '-', '') END AS judgementDate,
      CASE WHEN n = 8 THEN {_type_in("value")} END AS caseType,
      CASE WHEN n <> 8 THEN 'fields: ' || cast(n AS string) END AS reject_reason
    FROM sized
  )"""
_DELIMITED_COLUMNS = (
    "caseNumber, title, court, reason, publishDate, sourceUrl, content, judgementDate, caseType"
)

_EVENT_RANGES = """
  SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS topic,
    cast(event_id % 4 AS INTEGER) AS part, min(event_id) AS from_offset,
    max(event_id) + 1 AS until_offset
  FROM events GROUP BY 1, 2, 3"""

_ROW_KEY = " || ".join(
    f"coalesce(length(cast({f} AS string)) || ':' || cast({f} AS string), '-')"
    for f in RECORD_FIELDS
)

ORACLE_SQL: dict[str, str] = {
    "message_distinct": """SELECT text, min(doc_id) AS first_doc_id, count(*) AS copies
      FROM documents GROUP BY text""",
    "message_filter": f"WITH {KEPT} SELECT k, value FROM kept",
    "json_key_fallback": f"WITH {RECORDS} SELECT k, {_RECORD} FROM rec",
    "message_rejects": f"""WITH {MESSAGES_CTE} SELECT k, value,
        CASE WHEN value LIKE '{{%' AND value LIKE '%}}' THEN 'malformed JSON'
          ELSE 'not a JSON object' END AS reject_reason
      FROM msgs WHERE NOT (value LIKE '{{%' AND value LIKE '%}}' AND json_valid(value))""",
    "status_cast": """SELECT event_id,
        try_cast(json_extract_string(props, '$.k') AS INTEGER) AS status FROM events""",
    "sparse_field_counts": f"WITH {KEPT} " + " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) AS total_rows, "
        f"count(*) FILTER (WHERE {_raw(f)} NOT IN ('null', ' ')) AS present_rows FROM kept"
        for f in RECORD_FIELDS
    ),
    "delimited_parse": f"{_DELIMITED} SELECT k, {_DELIMITED_COLUMNS}, reject_reason FROM cleaned",
    "delimited_cleanup": f"""{_DELIMITED}, lines AS (
        SELECT min(k) AS k FROM packed GROUP BY value
      ) SELECT {_DELIMITED_COLUMNS} FROM cleaned SEMI JOIN lines USING (k)
      WHERE reject_reason IS NULL""",
    "varied_rejects": f"""WITH {MESSAGES_CTE}, {VARIED_CTE} SELECT k, value,
        CASE WHEN value LIKE '{{%' AND value LIKE '%}}' THEN 'malformed JSON'
          ELSE 'not a JSON object' END AS reject_reason
      FROM varied WHERE NOT (value LIKE '{{%' AND value LIKE '%}}' AND json_valid(value))""",
    "wash_varied": _wash(
        f"CASE WHEN y < {FIRST_BATCH_YEAR} THEN 0 ELSE 1 END", VARIED, _BY_CRAWL,
        f"cast({_date('judgementDate')} AS VARCHAR), judgementDate",
    ),
    "stream_first_seen": f"""SELECT min(k) AS k, min(chunk) AS batch_id FROM (
        SELECT *, min(chunk) OVER (PARTITION BY route, number, court, title, date) AS first_chunk
        FROM (
          WITH {ROUTED} SELECT k, cast(CASE WHEN y < {FIRST_BATCH_YEAR} THEN 0 ELSE 1 END AS BIGINT) AS chunk,
            route, CASE route WHEN 1 THEN caseNumber END AS number, court,
            CASE route WHEN 2 THEN title END AS title, CASE route WHEN 2 THEN judgementDate END AS date
          FROM routed WHERE route IN (1, 2))
      ) WHERE chunk = first_chunk GROUP BY route, number, court, title, date""",
    "delimited_runs": f"""{_DELIMITED}, firsts AS (
        SELECT value AS line, min(k) AS k,
          min(CASE WHEN k % 10 < 5 THEN 0 WHEN k % 10 < 8 THEN 1 ELSE 2 END) AS run
        FROM packed GROUP BY value
      ) SELECT {_DELIMITED_COLUMNS}, reject_reason, cast(run AS BIGINT) AS batch_id,
        CASE WHEN reject_reason IS NOT NULL THEN line END AS value,
        CASE WHEN reject_reason IS NULL THEN 'cleaned' ELSE 'rejected' END AS dest
      FROM cleaned JOIN firsts USING (k)""",
    "id_range_scan": """WITH b AS (
        SELECT min(o_orderkey) AS lo, max(o_orderkey) - min(o_orderkey) + 1 AS width FROM orders
      ), s AS (
        SELECT cast(i AS INTEGER) AS stride, lo + (i * width) // 8 AS a,
          lo + ((i + 1) * width) // 8 - 1 AS z FROM b, range(8) t(i)
      ) SELECT stride, count(*) AS n, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
      FROM orders JOIN s ON o_orderkey BETWEEN a AND z GROUP BY stride""",
    "id_quantile_scan": """WITH ids AS (
        SELECT cast(o_orderkey AS BIGINT) * o_orderkey AS id FROM orders
      ), q AS (
        SELECT quantile_disc(id, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS ends FROM ids
      ) SELECT cast(len(list_filter(ends, lambda e: e < id)) AS INTEGER) AS stride, count(*) AS n,
        min(id) AS first_id, max(id) AS last_id FROM ids, q GROUP BY stride""",
    "casenumber_normalize": f"""WITH {MESSAGES_CTE}
      SELECT k, rawno, {_number("rawno")} AS caseNumber FROM parts""",
    "casenumber_extract": _extracted(_number_in("content")),
    "court_extract": _extracted(_court_in("content")),
    "casetype_extract": _extracted(_type_in("content")),
    "doctype_extract": _extracted(_doctype_in("content")),
    "cn_date_parse": _extracted(f"cast({_date_in('content')} AS string)"),
    "reason_extract": _extracted(_reason("title")),
    "reason_fill": f"{_DELIMITED} SELECT k, title, reason FROM cleaned WHERE n = 8",
    "field_checks": f"WITH {LEGS} SELECT k, " + ", ".join(
        f"{leg}_{part} AS {leg}_check_{part}"
        for leg in ("number", "court", "date", "type") for part in ("code", "label")
    ) + " FROM labelled",
    "route_judge": f"WITH {ROUTED} SELECT k, route, check_notes FROM routed",
    "route_counts": f"WITH {ROUTED} SELECT route, count(*) AS n FROM routed GROUP BY route",
    "duplicate_groups": f"""WITH {ROUTED} SELECT caseNumber, court, min(k) AS first_k,
        count(*) AS copies FROM clean GROUP BY caseNumber, court HAVING count(*) > 1""",
    "duplicate_members": f"""WITH {ROUTED} SELECT k, caseNumber, court, title, crawlDate, status,
        rn = 1 AS is_first FROM clean WHERE copies > 1""",
    "duplicate_ordinals": f"""WITH {ROUTED} SELECT k, caseNumber, court, title, crawlDate,
        row_number() OVER (PARTITION BY caseNumber, court ORDER BY crawlDate NULLS LAST, k) AS number,
        copies FROM clean WHERE copies > 1""",
    "court_identity": f"""WITH {COURTS_CTE}, names AS (
        SELECT DISTINCT court FROM spelled WHERE court IS NOT NULL
      ), met AS (
        SELECT a.court, b.court AS long FROM names a JOIN names b
        ON length(b.court) > length(a.court) AND b.court LIKE '%' || a.court
      ), longest AS (
        SELECT court, arg_max(long, length(long)) AS longest FROM met GROUP BY court
      ), known AS (
        SELECT court, longest FROM met JOIN longest USING (court)
        GROUP BY court, longest HAVING bool_and(longest LIKE '%' || long)
      ), named AS (
        SELECT k, number, court, coalesce(longest, court) AS canonical
        FROM spelled LEFT JOIN known USING (court)
      ) SELECT min(k) AS k, number, arg_min(court, k) AS court, canonical
      FROM named WHERE court IS NOT NULL GROUP BY number, canonical
      UNION ALL SELECT min(k), number, NULL, NULL FROM named WHERE court IS NULL GROUP BY number""",
    "batch_survivors": f"WITH {ROUTED} SELECT k, {_RECORD}, route FROM clean WHERE rn = 1",
    "batch_duplicates": f"WITH {ROUTED} SELECT k, {_RECORD}, route FROM clean WHERE rn > 1",
    "history_left": f"""WITH {HISTORY} SELECT a.k, a.caseNumber, a.court,
        b.caseNumber AS history_caseNumber, b.court AS history_court
      FROM batch a LEFT JOIN past b ON {_ON}""",
    "history_hits": f"""WITH {HISTORY} SELECT k, caseNumber, court FROM batch a
      WHERE EXISTS (SELECT 1 FROM past b WHERE {_ON})""",
    "history_hits_inner": f"""WITH {HISTORY} SELECT a.k, a.caseNumber, a.court
      FROM batch a JOIN past b ON {_ON}""",
    "history_misses": f"""WITH {HISTORY} SELECT k, caseNumber, court FROM batch a
      WHERE NOT EXISTS (SELECT 1 FROM past b WHERE {_ON})""",
    "family_view": f"WITH {RECORDS} SELECT k, " + ", ".join(
        [f"{f} AS match_{f}" for f in MATCH_FAMILY] + [f"{f} AS other_{f}" for f in OTHER_FAMILY]
    ) + " FROM rec",
    "stable_row_key": f"WITH {RECORDS} SELECT k, sha256({_ROW_KEY}) AS row_key FROM rec",
    "word_count": """SELECT word, count(*) AS n
      FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
      WHERE word <> '' GROUP BY word""",
    "offset_ranges": _EVENT_RANGES,
    "offset_upsert": f"""WITH r AS ({_EVENT_RANGES})
      SELECT 'readers' AS group_id, topic, part, arg_max(until_offset, day) AS until_offset,
        max(day) AS day FROM r GROUP BY topic, part""",
    "offset_start_map": f"""WITH r AS ({_EVENT_RANGES})
      SELECT topic, part, arg_max(until_offset, day) AS until_offset
      FROM r GROUP BY topic, part""",
    "wash_end_to_end": _wash(f"CASE WHEN y < {FIRST_BATCH_YEAR} THEN 0 ELSE 1 END"),
    "text_wash": f"""SELECT dest, dup_kind, route, count(*) AS n
      FROM ({_wash(f"CASE WHEN y < {FIRST_BATCH_YEAR} THEN 0 ELSE 1 END")})
      GROUP BY dest, dup_kind, route""",
    "stream_wash": _wash("CASE WHEN y < 1997 THEN 0 WHEN y < 1999 THEN 1 ELSE 2 END"),
    "stream_word_count": """SELECT batch_id, word, count(*) AS n
      FROM (SELECT cast(CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
          unnest(string_split(text, ' ')) AS word FROM documents)
      WHERE word <> '' GROUP BY batch_id, word""",
    "stream_echo": f"""WITH {MESSAGES_CTE},
      b AS (SELECT k, value, CASE WHEN y < {FIRST_BATCH_YEAR} THEN 0 ELSE 1 END AS batch_id FROM msgs)
      SELECT cast(batch_id AS BIGINT) AS batch_id, 0 AS partition, k AS "offset", value,
        min(k) OVER (PARTITION BY batch_id) AS from_offset,
        max(k) OVER (PARTITION BY batch_id) + 1 AS until_offset
      FROM b""",
}
