"""The catalogue's queries as plain SQL over the same tables, run by another engine."""

from __future__ import annotations

from cellflux.schema import MEASURES, RECORD_FIELDS, TOTALS
from cellflux.sources.adapters import EVENT_TYPE_OF

_FIELDS = ", ".join(f'"{f}"' for f in RECORD_FIELDS)
_TEXT_FIELDS = [f"COALESCE(CAST(\"{f}\" AS VARCHAR), '')" for f in RECORD_FIELDS]


def _measures(value: str = "value") -> str:
    return ",\n    ".join(
        f"CASE WHEN event_type = '{EVENT_TYPE_OF[m]}' THEN {value} END AS {m}" for m in MEASURES
    )


def _records(value: str = "value") -> str:
    return f"""records AS (
  SELECT event_id, ts,
    CAST(user_id AS INTEGER) AS cell_id,
    CAST(epoch_us(ts) // 1000 AS BIGINT) AS "timestamp",
    CAST(event_id % 5 AS INTEGER) AS country_code,
    {_measures(value)}
  FROM events
)"""


_REPAIRED = ",\n    ".join(f"CASE WHEN {m} >= 0 THEN {m} ELSE 0.0 END AS {m}" for m in MEASURES)

_CLEAN_BODY = f"""
  SELECT cell_id, "timestamp", country_code,
    {_REPAIRED},
    date_trunc('millisecond', ts) AS event_time,
    CAST(ts AS DATE) AS "date",
    CAST(extract(hour FROM ts) AS INTEGER) AS "hour"
  FROM records
  WHERE cell_id BETWEEN 1 AND 10000
"""

_CLEAN = f"cleaned AS ({_CLEAN_BODY})"

_LINEITEM_RECORDS = """records AS (
  SELECT CAST(l_orderkey AS INTEGER) AS cell_id,
    CAST(epoch_us(l_shipdate) // 1000 AS BIGINT) AS "timestamp",
    l_linenumber AS country_code,
    l_quantity AS sms_in, l_extendedprice AS sms_out, l_discount AS call_in,
    l_tax AS call_out, CAST(l_linenumber AS DOUBLE) AS internet,
    l_shipdate AS ts
  FROM lineitem
)"""


def _sums(digits: int) -> str:
    return ", ".join(
        f"round(sum({m}), {digits}) AS {t}" for m, t in zip(MEASURES, TOTALS, strict=True)
    )


_DAY = "strftime(\"date\", '%Y-%m-%d') AS \"date\""

_TYPED = f"WITH {_records()} SELECT {_FIELDS} FROM records"

_SHOW_EVENTS = f"""SELECT {_FIELDS},
  strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS event_time, {_DAY}, "hour"
FROM cleaned"""

_CLEAN_EVENTS = f"WITH {_records()}, {_CLEAN} {_SHOW_EVENTS}"


def _show_daily(digits: int) -> str:
    return f"""SELECT {_DAY}, cell_id, {_sums(digits)}
FROM cleaned GROUP BY cleaned."date", cell_id"""


_DAILY = f"WITH {_records()}, {_CLEAN} {_show_daily(4)}"

_SHOW_HOURLY = f"""SELECT {_DAY}, "hour", cell_id, {_sums(4)}
FROM cleaned GROUP BY cleaned."date", "hour", cell_id"""

_HOURLY = f"WITH {_records()}, {_CLEAN} {_SHOW_HOURLY}"

# A window is out once the watermark, ten minutes behind the latest event, has passed its end.
_SHOW_CLOSED = f""", closing AS (
  SELECT max(event_time) - INTERVAL 10 MINUTE AS watermark FROM cleaned
)
SELECT {_DAY}, "hour", cell_id, {_sums(4)}
FROM cleaned, closing
GROUP BY cleaned."date", "hour", cell_id, watermark
HAVING max(date_trunc('hour', event_time)) + INTERVAL 1 HOUR <= watermark"""

_STREAM_HOURLY = f"WITH {_records()}, {_CLEAN} {_SHOW_CLOSED}"

_TUMBLING = f"""WITH {_records()}, {_CLEAN},
windowed AS (SELECT *, date_trunc('hour', event_time) AS w FROM cleaned)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
  strftime(w, '%Y-%m-%d') AS "date", CAST(extract(hour FROM w) AS INTEGER) AS "hour",
  cell_id, {_sums(4)}
FROM windowed GROUP BY w, cell_id"""


def _unless(field: str, *kinds: int) -> str:
    damaged = ", ".join(str(k) for k in kinds)
    return f'CASE WHEN event_id % 10 NOT IN ({damaged}) THEN "{field}" END AS "{field}"'


# Damage by event_id % 10: 0 bad time, 1 only four fields, 2 two extra fields, 3 bad cell.
_PADDED_FIELDS = ", ".join(
    [_unless("cell_id", 3), _unless("timestamp", 0), "country_code", "sms_in"]
    + [_unless(m, 1) for m in MEASURES[1:]]
)


def _as_text(answer: str, *columns: str) -> str:
    texts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({texts}) FROM ({answer})"


_PADDED = f"WITH {_records()} SELECT {_PADDED_FIELDS} FROM records"

# The damaged records, cleaned from their fields alone.
_CLEAN_DAMAGED = f"""cleaned AS (
  SELECT cell_id, "timestamp", country_code,
    {_REPAIRED},
    make_timestamp("timestamp" * 1000) AS event_time,
    CAST(make_timestamp("timestamp" * 1000) AS DATE) AS "date",
    CAST(extract(hour FROM make_timestamp("timestamp" * 1000)) AS INTEGER) AS "hour"
  FROM damaged
  WHERE cell_id BETWEEN 1 AND 10000
)"""


def _damaged(where: str = "true") -> str:
    return f"""{_records()},
damaged AS (SELECT {_PADDED_FIELDS} FROM records WHERE {where}), {_CLEAN_DAMAGED}"""


_FULL_LINES = "event_id % 10 NOT IN (1, 2)"

_STRICT = f"{_PADDED} WHERE {_FULL_LINES}"

_LINE = " || chr(9) || ".join(_TEXT_FIELDS)

_LINES = f"WITH {_records()} SELECT event_id, {_LINE} AS line FROM records"

_HEAD = f"WITH {_records()} SELECT {_LINE} AS value FROM records ORDER BY event_id LIMIT 5000"

# The damaged lines that are no events, and why.
_TAB = " || chr(9) || "
_REJECTED = f"""WITH {_records()}, lines AS (
  SELECT cell_id, event_id % 10 AS kind, CASE event_id % 10
    WHEN 0 THEN {_TEXT_FIELDS[0]}{_TAB}'bad'{_TAB}{_TAB.join(_TEXT_FIELDS[2:])}
    WHEN 1 THEN {_TAB.join(_TEXT_FIELDS[:4])}
    WHEN 2 THEN {_LINE}{_TAB}'8'{_TAB}'9'
    WHEN 3 THEN 'x1'{_TAB}{_TAB.join(_TEXT_FIELDS[1:])}
    ELSE {_LINE} END AS line
  FROM records
), judged AS (
  SELECT line, CASE
    WHEN kind = 1 THEN 'too few fields'
    WHEN kind = 2 THEN 'too many fields'
    WHEN kind = 3 THEN 'cell is no number'
    WHEN cell_id IS NULL THEN 'cell missing'
    WHEN cell_id NOT BETWEEN 1 AND 10000 THEN 'cell out of range' END AS reason
  FROM lines
)
SELECT line, reason FROM judged WHERE reason IS NOT NULL"""

_LATE_ROWS = f"""WITH {_records()}, {_CLEAN}, closing AS (
  SELECT max(event_time) - INTERVAL 10 MINUTE AS watermark FROM cleaned
)
SELECT {_FIELDS}, strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS event_time, {_DAY}, "hour"
FROM cleaned, closing WHERE date_trunc('hour', event_time) + INTERVAL 1 HOUR <= watermark"""

ORACLES: dict[str, str] = {
    "typed_projection": _TYPED,
    "tsv_scan": _TYPED,
    "tsv_malformed": _as_text(_PADDED, "cell_id", "timestamp"),
    "wire_encode": _LINES,
    "wire_decode": _TYPED,
    "wire_decode_pad": _as_text(_PADDED, "cell_id", "timestamp"),
    "arity_filter": _as_text(_STRICT, "cell_id", "timestamp"),
    "wire_strip": f"{_TYPED} WHERE internet IS NOT NULL",
    "publish_lines": _TYPED,
    "replay_head": _HEAD,
    "replay_files": _HEAD,
    "replay_long_head": _HEAD,
    "replay_odd_names": _HEAD,
    "replay_single_file": f"WITH {_records()} SELECT {_LINE} AS value FROM records WHERE event_id % 2 = 0",
    "replay_numbered": f"""WITH {_records()}
SELECT row_number() OVER (ORDER BY event_id) AS number, {_LINE} AS value FROM records""",
    "rejected_lines": _REJECTED,
    "stream_rejected_lines": _REJECTED,
    "sorted_batch_daily": f"WITH {_damaged()} {_show_daily(4)}",
    "event_time_parts": f"""WITH {_records()}
SELECT event_id, "timestamp", strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time,
  strftime(ts, '%Y-%m-%d') AS "date", CAST(extract(hour FROM ts) AS INTEGER) AS "hour"
FROM records""",
    "metric_repair": f"""WITH {_records("value - 50")}
SELECT event_id, {", ".join(
    f"round(CASE WHEN {m} >= 0 THEN {m} ELSE 0.0 END, 4) AS {m}" for m in MEASURES
)} FROM records""",
    "balance_repair": """SELECT c_custkey,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0.0 END AS balance FROM customer""",
    "cell_range": (
        f"WITH {_LINEITEM_RECORDS} SELECT {_FIELDS} FROM records "
        "WHERE cell_id BETWEEN 1 AND 10000"
    ),
    "clean_events": _CLEAN_EVENTS,
    "hourly_totals": _HOURLY,
    "daily_totals": _DAILY,
    "daily_from_hourly": _DAILY,
    "daily_totals_lineitem": f"WITH {_LINEITEM_RECORDS}, {_CLEAN} {_show_daily(2)}",
    "hourly_totals_zone": f"""WITH {_records()}, utc AS ({_CLEAN_BODY}),
cleaned AS (
  SELECT * REPLACE (
    CAST(event_time + INTERVAL 330 MINUTE AS DATE) AS "date",
    CAST(extract(hour FROM event_time + INTERVAL 330 MINUTE) AS INTEGER) AS "hour"
  ) FROM utc
) {_SHOW_HOURLY}""",
    "malformed_daily_totals": f"WITH {_damaged()} {_show_daily(4)}",
    "malformed_stream_events": _as_text(
        f"WITH {_damaged(_FULL_LINES)} {_SHOW_EVENTS}", "timestamp", "hour"
    ),
    "malformed_stream_hourly": f"WITH {_damaged(_FULL_LINES)} {_SHOW_CLOSED}",
    "tumbling_totals": _TUMBLING,
    "sink_clean": _CLEAN_EVENTS,
    "sink_clean_regrouped": _CLEAN_EVENTS,
    "sink_daily": _DAILY,
    "sink_hourly": _HOURLY,
    "sink_overwrite": _DAILY,
    "sink_replace_failed": _DAILY,
    "daily_incremental": _DAILY,
    "batch_job_events": _CLEAN_EVENTS,
    "batch_job_hourly": _HOURLY,
    "batch_job_daily": _DAILY,
    "stream_clean": _CLEAN_EVENTS,
    "stream_hourly": _STREAM_HOURLY,
    "stream_hourly_steps": _STREAM_HOURLY,
    "stream_late": _STREAM_HOURLY,
    "stream_restart": _STREAM_HOURLY,
    "stream_job_events": _CLEAN_EVENTS,
    "stream_job_hourly": _STREAM_HOURLY,
    "stream_triggered": _STREAM_HOURLY,
    "stream_failure_stops_all": _CLEAN_EVENTS,
    "stream_drained": _HOURLY,
    "stream_far_future": _STREAM_HOURLY,
    "stream_shared_events": _CLEAN_EVENTS,
    "stream_shared_hourly": _STREAM_HOURLY,
    "stream_late_rows": _LATE_ROWS,
    "stream_compacted": _CLEAN_EVENTS,
}
