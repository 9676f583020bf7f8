"""The same queries as ANSI SQL over the ``events`` table, for the correctness check."""

from __future__ import annotations

from roadstream.schemas import GATE_POSITIONS

_GATE_ROWS = ", ".join(f"({gate}, {loc}::DOUBLE)" for gate, loc in GATE_POSITIONS)

# g: gates. d: detections. e: detections with the gate position, if any.
_DETECTIONS = f"""
WITH g(gate, loc) AS (VALUES {_GATE_ROWS}),
d AS (
  SELECT 'P' || user_id AS plate,
         CAST(event_id % 30 AS INTEGER) AS gate,
         CAST(event_id % 3 + 1 AS INTEGER) AS lane,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts_text,
         CASE WHEN event_type = 'error' THEN '?' ELSE event_type END AS nation,
         event_id AS "offset"
  FROM events
),
e AS (SELECT d.*, g.loc FROM d LEFT JOIN g ON d.gate = g.gate)
"""


def _pairs(keys: str) -> str:
    """p: consecutive located detections. s: those that moved, with their speed."""
    return f"""{_DETECTIONS},
p AS (
  SELECT e.*, lag(ts) OVER w AS pts, lag(loc) OVER w AS ploc
  FROM e WHERE loc IS NOT NULL
  WINDOW w AS (PARTITION BY {keys} ORDER BY ts, "offset")
),
s AS (
  SELECT p.*,
         CASE WHEN ts = pts THEN 'inf'::DOUBLE ELSE abs(loc - ploc) / (ts - pts) * 3600 END
           AS speed
  FROM p WHERE loc <> ploc
)
"""


_VEHICLE = _pairs("plate, nation")
_PLATE = _pairs("plate")
_LINE = "plate || ',' || gate || ',' || lane || ',' || ts_text || ',' || nation"
_TEXT = "plate || ' ' || gate || ' ' || lane || ' ' || ts_text || ' ' || nation"

# c: changes of gate positions.
_CHANGES = f"""{_DETECTIONS},
c AS (
  SELECT CAST(event_id // 10 % 30 AS INTEGER) AS gate, event_id AS version, ts,
         CASE WHEN event_id // 10 % 7 <> 3 THEN event_id % 1000 / 10.0::DOUBLE END AS loc
  FROM events WHERE event_id % 10 = 0
)
"""
# a: messages by the file, and so the batch, in which they arrive. w: the watermark that a batch drops by, which is
# that of the batch before, so it knows the batches up to two before. l: messages that are not dropped.
_LATE_FINES = f"""{_DETECTIONS},
r AS (SELECT min(event_id) AS first, max(event_id) AS last, greatest(6, (count(*) + 1999999) // 2000000) AS files FROM events),
a AS (
  SELECT e.*, epoch_us(v.ts) AS us,
         least(files - 1, (event_id - first) * files // (last - first + 1)
           + CASE event_id % 7 WHEN 3 THEN 2 WHEN 5 THEN 1 ELSE 0 END) AS batch
  FROM e JOIN events v ON v.event_id = e."offset", r
),
m AS (SELECT batch, max(us // 1000) AS ms FROM a GROUP BY batch),
w AS (
  SELECT b.batch, coalesce(max(m.ms) - 600000, 0) AS watermark
  FROM (SELECT DISTINCT batch FROM a) b LEFT JOIN m ON m.batch <= b.batch - 2 GROUP BY b.batch
),
l AS (SELECT a.* FROM a JOIN w ON w.batch = a.batch WHERE us > watermark * 1000 AND loc IS NOT NULL),
p AS (
  SELECT l.*, lag(ts) OVER v AS pts, lag(loc) OVER v AS ploc FROM l
  WINDOW v AS (PARTITION BY plate, nation ORDER BY ts, "offset")
)
SELECT nation, count(*) AS tot_fines FROM p
WHERE loc <> ploc AND (ts = pts OR abs(loc - ploc) / (ts - pts) * 3600 > 130) GROUP BY nation"""

_NATION_COUNTS = f"{_DETECTIONS} SELECT nation, count(*) AS count FROM d GROUP BY nation"
_KNOWN_NATION_COUNTS = f"""{_DETECTIONS}
SELECT nation, count(*) AS count FROM d WHERE nation IS DISTINCT FROM '?' GROUP BY nation"""
_COUNT_MAPS = f"""{_DETECTIONS}
SELECT nation, count(*) AS cnt FROM d WHERE nation IS DISTINCT FROM '?' GROUP BY nation"""
_ENRICHED_NATION_COUNTS = f"""{_DETECTIONS}
SELECT nation, count(*) AS count, count(loc) AS located
FROM e WHERE nation IS DISTINCT FROM '?' GROUP BY nation"""
_GATE_PLATE_COUNTS = f"""{_DETECTIONS}
SELECT gate, plate, count(*) AS cnt FROM d GROUP BY gate, plate"""
_LATEST = f"""{_DETECTIONS}
SELECT plate, arg_max(gate, "offset") AS gate, arg_max(ts, "offset") AS ts
FROM d GROUP BY plate"""
_FINES = f"""{_VEHICLE}
SELECT nation, count(*) AS tot_fines FROM s WHERE speed > 130 GROUP BY nation"""
_TICKETS = f"""{_PLATE}
SELECT plate, count(*) AS tickets FROM s WHERE speed > 130 GROUP BY plate"""

ORACLE_SQL = {
    "Q_decode": f'{_DETECTIONS} SELECT "offset", plate, gate, lane, ts, nation FROM d',
    "Q_gate_positions": f"""{_DETECTIONS}
SELECT g.gate, g.loc, g.gate || ' ' || g.loc AS text, count(d.gate) AS cnt
FROM g LEFT JOIN d ON g.gate = d.gate GROUP BY g.gate, g.loc""",
    "Q_topic_rows": f"""{_DETECTIONS}
SELECT plate AS key,
       plate || ',' || gate || ',' || lane || '.0,' || ts_text || ',' || nation AS value
FROM d""",
    "Q_encode": f'{_DETECTIONS} SELECT "offset", {_LINE} AS line FROM d',
    "Q_encode_enriched": f"""{_DETECTIONS}
SELECT "offset", plate, gate, lane, ts, nation, loc FROM e""",
    "Q_display": f"""{_DETECTIONS}
SELECT "offset", {_TEXT} AS text,
       {_TEXT} || ' ' || coalesce(CAST(loc AS VARCHAR), 'null') AS located_text
FROM e""",
    "Q_map_roundtrip": _COUNT_MAPS,
    "Q_latest_per_key": _LATEST,
    "Q_nation_counts": _NATION_COUNTS,
    "Q_known_nation_counts": _KNOWN_NATION_COUNTS,
    "Q_enriched_nation_counts": _ENRICHED_NATION_COUNTS,
    "Q_gate_join": f'{_DETECTIONS} SELECT "offset", gate, loc FROM e WHERE loc IS NOT NULL',
    "Q_gate_left_join": f'{_DETECTIONS} SELECT "offset", gate, loc FROM e',
    "Q_gate_plate_counts": _GATE_PLATE_COUNTS,
    "Q_plate_counts": f"{_DETECTIONS} SELECT plate, count(*) AS cnt FROM d GROUP BY plate",
    "Q_gate_plate_map": f"""{_DETECTIONS}
SELECT gate, count(DISTINCT plate) AS plates, count(*) AS cnt FROM d GROUP BY gate""",
    "Q_vehicle_track": f"""{_DETECTIONS}
, n AS (
  SELECT *, (row_number() OVER (PARTITION BY plate, nation ORDER BY ts, "offset") - 1) // 8 AS part,
         count(*) OVER (PARTITION BY plate, nation) AS cnt
  FROM e WHERE loc IS NOT NULL
)
SELECT plate, nation, part, min(ts) AS start_ts, any_value(cnt) AS cnt,
       string_agg(gate || '@' || ts, ',' ORDER BY ts, "offset") AS track
FROM n GROUP BY plate, nation, part""",
    "Q_consecutive_pairs": f"""{_VEHICLE}
SELECT plate, nation, pts, ts, ploc, loc FROM p WHERE pts IS NOT NULL""",
    "Q_speed_violations": f"""{_VEHICLE}
SELECT plate, nation, ts, round(speed, 6) AS speed FROM s WHERE speed > 130""",
    "Q_speed_values": f"""{_VEHICLE}
SELECT plate, nation, count(*) AS fines, round(max(speed), 6) AS max_speed
FROM s WHERE speed > 130 GROUP BY plate, nation""",
    "Q_fines_by_nation": _FINES,
    "Q_tickets_by_plate": _TICKETS,
    "Q_avg_speed": f"""{_VEHICLE}
SELECT nation, round(avg(speed), 6) AS avg_speed FROM s WHERE ts <> pts GROUP BY nation""",
    "Q_event_gap": f"""{_DETECTIONS}
SELECT "offset",
       greatest(ts - coalesce(lag(ts) OVER (PARTITION BY plate ORDER BY "offset"), ts), 0)
         * 1000 AS gap_ms
FROM d""",
    "Q_line_files": f"{_DETECTIONS} SELECT plate, gate, lane, ts, nation FROM d",
    "Q_gate_file": f"""{_DETECTIONS}
SELECT gate, loc, count(*) AS cnt FROM e WHERE loc IS NOT NULL GROUP BY gate, loc""",
    "S_nation_counts": _NATION_COUNTS,
    "S_known_nation_counts": _KNOWN_NATION_COUNTS,
    "S_enriched_nation_counts": _ENRICHED_NATION_COUNTS,
    "S_gate_plate_counts": _GATE_PLATE_COUNTS,
    "S_latest_per_key": _LATEST,
    "S_fines_by_nation": _FINES,
    "S_tickets_by_plate": _TICKETS,
    # No message of this table is late: its events are in order of time.
    "S_fines_watermarked": _FINES,
    "S_fines_restarted": _FINES,
    "S_topic_upserts": _COUNT_MAPS,
    "S_state_lookup": _KNOWN_NATION_COUNTS,
    "S_every_second": _NATION_COUNTS,
    # A gate that has no more messages fires its last count again each second.
    "S_every_second_again": f"{_DETECTIONS} SELECT gate, count(*) AS cnt, true AS again FROM d GROUP BY gate",
    "S_fines_late": _LATE_FINES,
    # A message sees the newest change that has a lower offset.
    "S_changing_gates": f"""{_CHANGES}
SELECT d."offset", d.plate, d.gate, c.loc, c.version FROM d ASOF LEFT JOIN c ON d.gate = c.gate AND d."offset" > c.version""",
    "S_two_stream_join": f"""{_CHANGES}
SELECT d."offset", d.plate, d.gate, c.loc, c.version
FROM d JOIN events v ON v.event_id = d."offset" JOIN c ON c.gate = d.gate
  AND v.ts BETWEEN c.ts - INTERVAL 1 HOUR AND c.ts + INTERVAL 1 HOUR""",
    "S_track_lookup": f'{_DETECTIONS} SELECT plate, nation, ts, "offset", loc FROM e WHERE loc IS NOT NULL',
    "S_changes_compacted": f"{_DETECTIONS} SELECT plate, count(*) AS cnt FROM d GROUP BY plate",
    "S_row_files": f"""{_DETECTIONS} SELECT "offset", plate, gate, nation FROM d WHERE nation IS DISTINCT FROM '?'""",
}
