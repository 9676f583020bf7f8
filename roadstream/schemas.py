"""Record layouts and the fixed gate table."""

from __future__ import annotations

SEPARATOR = ","
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_PATTERN = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"
UNKNOWN_NATION = "?"

# One broker message.
ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
# One line of a gate file.
GATE_LINE = "gate int, position double"
COUNT_MAP = "map<string,bigint>"

# Gate number and its position on the road in km.
GATE_POSITIONS = (
    (1, 124.7),
    (2, 74.6),
    (3, 124.7),
    (4, 46.5),
    (5, 106.1),
    (8, 117.8),
    (9, 31.8),
    (10, 54.5),
    (12, 113.8),
    (13, 134.5),
    (15, 98.4),
    (16, 60.5),
    (18, 66.8),
    (20, 88.4),
    (21, 20.8),
    (22, 135.3),
    (23, 80.8),
    (25, 106.1),
    (26, 48.5),
    (27, 22.6),
    (28, 31.8),
)
