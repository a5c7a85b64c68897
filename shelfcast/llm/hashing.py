"""XXH64 over many byte slices at once."""

from __future__ import annotations

import numpy as np
import xxhash

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (  # fixed values of the hash
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SEED = 42
LONG = 4096


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lane(acc: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turn(acc + word * P2, 31) * P1


def xxh64_slices(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Hash of data[start:start + size] for each slice; ``data`` is uint8 and has 8 spare bytes at its end."""
    long = size >= LONG
    if long.any():  # the library's own hash, a slice at a time
        out = np.empty(len(start), np.uint64)
        out[~long] = xxh64_slices(data, start[~long], size[~long], seed)
        out[long] = [xxhash.xxh64_intdigest(data[a:a + n], seed) for a, n in zip(start[long], size[long])]
        return out
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    halves = np.ndarray((len(data) - 7,), "<u4", data, strides=(1,))
    start, size = start.astype(np.int64), size.astype(np.int64)
    seed = np.uint64(seed)
    with np.errstate(over="ignore"):
        acc = np.full(len(start), seed + P5, np.uint64)
        at, left = start.copy(), size.copy()
        large = np.flatnonzero(size >= 32)
        if len(large):
            lanes = [np.full(len(large), v, np.uint64) for v in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            who = np.arange(len(large))
            while len(who):
                here = at[large[who]]
                for k in range(4):
                    lanes[k][who] = _lane(lanes[k][who], words[here + 8 * k])
                at[large[who]] += 32
                left[large[who]] -= 32
                who = who[left[large[who]] >= 32]
            whole = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for lane in lanes:
                whole = (whole ^ _lane(np.zeros_like(lane), lane)) * P1 + P4
            acc[large] = whole
        acc += size.astype(np.uint64)
        who = np.flatnonzero(left >= 8)
        while len(who):
            acc[who] = _turn(acc[who] ^ _lane(np.zeros(len(who), np.uint64), words[at[who]]), 27) * P1 + P4
            at[who] += 8
            left[who] -= 8
            who = who[left[who] >= 8]
        who = np.flatnonzero(left >= 4)
        acc[who] = _turn(acc[who] ^ (halves[at[who]].astype(np.uint64) * P1), 23) * P2 + P3
        at[who] += 4
        left[who] -= 4
        who = np.flatnonzero(left > 0)
        while len(who):
            acc[who] = _turn(acc[who] ^ (data[at[who]].astype(np.uint64) * P5), 11) * P1
            at[who] += 1
            left[who] -= 1
            who = who[left[who] > 0]
        acc = (acc ^ (acc >> np.uint64(33))) * P2
        acc = (acc ^ (acc >> np.uint64(29))) * P3
        return acc ^ (acc >> np.uint64(32))
