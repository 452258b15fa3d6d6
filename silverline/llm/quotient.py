"""Counting quotient filters over packed word-id n-grams: sorted, lossless, small.

The ids of an n-gram are packed into a few lanes of equal width, and the lanes are permuted
by a bijection that spreads n-grams evenly. The first bits of the result are the quotient,
everything else is the remainder, and both together give the n-gram back. A block holds the
entries of one shard (the first quotient bits) in order: a bit per quotient that says whether
it occurs, a bit per entry that says whether its quotient ends there, the remainders in whole
bytes, and the counts in one byte each with longer ones at the end. Blocks are sorted alike,
so filters of many tasks are merged by merging their entries.
"""

from __future__ import annotations

import struct

import numpy as np

Lanes = list[np.ndarray]  # unsigned 64-bit numbers, the first lane counts most in the order
_ROUNDS = 3
_HEAD = struct.Struct("<QBQ")  # entries, quotient bits of the block, long counts


def shape(size: int, bits: int) -> tuple[int, int]:
    """How many lanes, and of what width, hold ``size`` ids of ``bits`` bits."""
    lanes = -(-size * bits // 64)
    return lanes, -(-size * bits // lanes)


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _moved(values: np.ndarray, by: int) -> np.ndarray:
    return values << np.uint64(by) if by >= 0 else values >> np.uint64(-by)


def pack(ids: Lanes, bits: int) -> Lanes:
    lanes, width = shape(len(ids), bits)
    out = [np.zeros(len(ids[0]), dtype=np.uint64) for _ in range(lanes)]
    for i, values in enumerate(ids):
        for j in range(lanes):
            by = i * bits - j * width
            if -bits < by < width:
                out[j] |= _moved(values, by) & _mask(width)
    return out


def unpack(lanes: Lanes, size: int, bits: int) -> Lanes:
    width = shape(size, bits)[1]
    out = [np.zeros(len(lanes[0]), dtype=np.uint64) for _ in range(size)]
    for i in range(size):
        for j, values in enumerate(lanes):
            by = i * bits - j * width
            if -bits < by < width:
                out[i] |= _moved(values, -by) & _mask(bits)
    return out


def _odd(step: int, width: int) -> int:
    return (0x9E3779B97F4A7C15 * (2 * step + 1)) % (1 << width) | 1


def _mixed(values: np.ndarray, step: int) -> np.ndarray:
    values = (values + np.uint64(step + 1)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def _steps(lanes: int) -> list[tuple[int, int, int]]:
    """(step, lane, lane that is mixed into it) in order; every lane comes after all others at least twice."""
    return [(r * lanes + j, j, (j + 1) % lanes) for r in range(_ROUNDS) for j in reversed(range(lanes))]


def permute(lanes: Lanes, width: int) -> Lanes:
    """Each step changes one lane by a bijection that depends on another lane: the whole can be undone."""
    lanes, mask, half = list(lanes), _mask(width), np.uint64((width + 1) // 2)
    for step, j, other in _steps(len(lanes)):
        x = lanes[j]
        if other != j:
            x = x ^ (_mixed(lanes[other], step) & mask)
        x = (x * np.uint64(_odd(step, width))) & mask
        lanes[j] = x ^ (x >> half)
    return lanes


def restore(lanes: Lanes, width: int) -> Lanes:
    """Undoes :func:`permute`."""
    lanes, mask, half = list(lanes), _mask(width), np.uint64((width + 1) // 2)
    for step, j, other in reversed(_steps(len(lanes))):
        x = lanes[j]
        x = ((x ^ (x >> half)) * np.uint64(pow(_odd(step, width), -1, 1 << width))) & mask
        if other != j:
            x = x ^ (_mixed(lanes[other], step) & mask)
        lanes[j] = x
    return lanes


def summed(lanes: Lanes, counts: np.ndarray) -> tuple[Lanes, np.ndarray]:
    """Entries in order, equal ones made one."""
    order = np.lexsort(lanes[::-1]) if len(lanes) > 1 else np.argsort(lanes[0], kind="stable")
    lanes = [lane[order] for lane in lanes]
    if not len(order):
        return lanes, counts
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for lane in lanes:
        new[1:] |= lane[1:] != lane[:-1]
    first = np.flatnonzero(new)
    return [lane[first] for lane in lanes], np.add.reduceat(counts[order], first)


def shard_bounds(lanes: Lanes, width: int, shard_bits: int) -> np.ndarray:
    """Where each of the 2^shard_bits shards begins and ends among ordered entries."""
    of = lanes[0] >> np.uint64(width - shard_bits) if shard_bits else np.zeros(len(lanes[0]), dtype=np.uint64)
    return np.searchsorted(of, np.arange((1 << shard_bits) + 1, dtype=np.uint64))


def _as_bytes(values: np.ndarray, bits: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _from_bytes(data: bytes, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    size = -(-bits // 8)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    return out.view("<u8").reshape(n).astype(np.uint64), at + n * size


def encode(lanes: Lanes, counts: np.ndarray, width: int, shard_bits: int) -> bytes:
    """A block of the ordered, distinct entries of one shard."""
    n = len(counts)
    quotient_bits = min(width - shard_bits, n.bit_length())
    rest = width - shard_bits - quotient_bits
    quotient = _moved(lanes[0], -rest) & _mask(quotient_bits)
    occupied = np.zeros(1 << quotient_bits, dtype=bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True)[:n]
    long = counts >= 255
    return b"".join(
        [
            _HEAD.pack(n, quotient_bits, int(long.sum())),
            np.packbits(occupied).tobytes(),
            np.packbits(ends).tobytes(),
            _as_bytes(lanes[0] & _mask(rest), rest),
            *[_as_bytes(lane, width) for lane in lanes[1:]],
            np.where(long, 255, counts).astype(np.uint8).tobytes(),
            counts[long].astype("<i8").tobytes(),
        ]
    )


def decode(block: bytes, lanes: int, width: int, shard: int, shard_bits: int) -> tuple[Lanes, np.ndarray]:
    """The entries of a block, in order."""
    n, quotient_bits, n_long = _HEAD.unpack_from(block)
    at = _HEAD.size
    size = -(-(1 << quotient_bits) // 8)
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(block, np.uint8, size, at), count=1 << quotient_bits))
    at += size
    size = -(-n // 8)
    ends = np.unpackbits(np.frombuffer(block, np.uint8, size, at), count=n).astype(np.int64)
    at += size
    rest = width - shard_bits - quotient_bits
    quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64) | np.uint64(shard << quotient_bits)
    first, at = _from_bytes(block, at, n, rest)
    out = [_moved(quotient, rest) | first]
    for _ in range(lanes - 1):
        lane, at = _from_bytes(block, at, n, width)
        out.append(lane)
    counts = np.frombuffer(block, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(block, "<i8", n_long, at + n)
    return out, counts


def merge(blocks: list[bytes], lanes: int, width: int, shard: int, shard_bits: int) -> tuple[Lanes, np.ndarray]:
    """The entries of several blocks of one shard, counts added."""
    parts = [decode(block, lanes, width, shard, shard_bits) for block in blocks]
    together = [np.concatenate([entries[j] for entries, _ in parts]) for j in range(lanes)]
    return summed(together, np.concatenate([counts for _, counts in parts]))
