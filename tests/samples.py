"""Made-up detections with hard cases, and the plain way to pair them."""

from __future__ import annotations

import random
from collections import defaultdict

from roadstream.schemas import GATE_POSITIONS

LOCATION = dict(GATE_POSITIONS)


def skewed_rows(seed: int, count: int = 600) -> list[tuple]:
    """Half of the rows belong to one vehicle, and a third of all share one second."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        if i % 3 == 0:
            plate, nation, ts = "HOT", "?", 50_000
        elif i % 6 == 1:
            plate, nation, ts = "HOT", "?", rng.randrange(0, 200_000)
        else:
            plate = f"P{rng.randrange(8)}"
            nation = rng.choice(["it", "fr", None])
            ts = rng.randrange(0, 40_000)
        rows.append((plate, rng.randrange(30), ts, nation))
    return rows


def pairs_by_hand(rows: list[tuple], by_plate: bool = False) -> list[tuple]:
    """``(plate, nation, prev_ts, ts, prev_loc, loc)`` for each consecutive pair."""
    tracks = defaultdict(list)
    for offset, (plate, gate, ts, nation) in enumerate(rows):
        if gate in LOCATION and ts is not None and plate is not None:
            key = plate if by_plate else (plate, nation)
            tracks[key].append((ts, offset, LOCATION[gate], plate, nation))
    pairs = []
    for track in tracks.values():
        track.sort(key=lambda d: d[:2])
        for before, now in zip(track, track[1:]):
            pairs.append((now[3], now[4], before[0], now[0], before[2], now[2]))
    return pairs


def is_fine(pair: tuple, limit: float = 130.0) -> bool:
    _, _, prev_ts, ts, prev_loc, loc = pair
    if loc == prev_loc:
        return False
    return ts == prev_ts or abs(loc - prev_loc) / (ts - prev_ts) * 3600 > limit


def fines_by_hand(rows: list[tuple], key: int = 1, by_plate: bool = False) -> dict:
    totals = defaultdict(int)
    for pair in pairs_by_hand(rows, by_plate):
        if is_fine(pair):
            totals[pair[key]] += 1
    return dict(totals)
