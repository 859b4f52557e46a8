"""Golomb-Rice coding of sorted integers, a whole array at a time."""

from __future__ import annotations

import numpy as np

HEAD = np.dtype([("count", "<u8"), ("first", "<u8"), ("shift", "<u1"), ("unary", "<u8")])


def encode(values: np.ndarray) -> bytes:
    """Code ascending unsigned integers; repeats are allowed.

    Differences are split at a power of two near their mean: the upper parts in
    unary, then the lower parts in a fixed number of bits.
    """
    values = np.asarray(values, np.uint64)
    if not len(values):
        return b""
    deltas = np.diff(values)
    mean = int(values[-1] - values[0]) // max(1, len(deltas))
    shift = max(0, mean.bit_length() - 1)
    upper = (deltas >> np.uint64(shift)).astype(np.int64)
    stops = np.cumsum(upper + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1 if len(stops) else 0, np.uint8)
    unary[stops] = 1
    places = np.arange(shift, dtype=np.uint64)
    lower = ((deltas[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    head = np.array([(len(values), values[0], shift, len(unary))], HEAD)
    return head.tobytes() + np.packbits(unary).tobytes() + np.packbits(lower.ravel()).tobytes()


def decode(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    head = np.frombuffer(data, HEAD, 1)[0]
    count, shift, length = int(head["count"]), int(head["shift"]), int(head["unary"])
    body = np.frombuffer(data, np.uint8, offset=HEAD.itemsize)
    cut = (length + 7) // 8
    stops = np.flatnonzero(np.unpackbits(body[:cut], count=length))
    upper = np.diff(stops, prepend=-1).astype(np.uint64) - np.uint64(1)
    bits = np.unpackbits(body[cut:], count=(count - 1) * shift).reshape(count - 1, shift)
    lower = bits.astype(np.uint64) @ (np.uint64(1) << np.arange(shift, dtype=np.uint64))
    deltas = (upper << np.uint64(shift)) | lower.astype(np.uint64)
    return head["first"] + np.concatenate([np.zeros(1, np.uint64), np.cumsum(deltas, dtype=np.uint64)])
