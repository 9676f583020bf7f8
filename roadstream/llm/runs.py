"""Runs of characters of whole texts, found on the UTF-8 bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from roadstream.llm.common import plain

_BYTES = np.arange(256)
ASCII_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
ASCII_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def runs_of(texts: pa.Array, inside: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts with A-Z lower-cased, and the start, the end and the text of each run of bytes ``inside``.

    Texts are parted by a zero byte, which is never inside. Nulls have no runs.
    """
    data = plain(texts).cast(pa.large_binary()).to_pylist()
    ends = np.cumsum(np.array([len(x) + 1 for x in data], np.int64))
    raw = np.frombuffer(b"\0".join([*data, b""]), np.uint8)
    edges = np.flatnonzero(np.diff(inside(raw).view(np.int8), prepend=0, append=0))
    starts = edges[::2]
    return _LOWER[raw], starts, edges[1::2], np.searchsorted(ends, starts, side="right")


def strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The runs as texts."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    inside = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(raw[inside]))


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive values, ``counts`` of them at a time, as binary rows."""
    offsets = np.concatenate([[0], np.cumsum(counts * values.itemsize)]).astype(np.int64)
    data = np.ascontiguousarray(values)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def values_of(column: pa.Array, kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    """The values of binary rows again, and how many each row has."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), kind), np.array([len(x) for x in data], np.int64) // np.dtype(kind).itemsize
