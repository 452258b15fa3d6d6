"""Simple-8b coding of ids in 64-bit words, whole arrays at a time.

A word holds a selector in its top four bits and one of these in the other sixty:

* selector 1 to 14: ``COUNTS[s]`` ids of ``WIDTHS[s]`` bits each, the first in the lowest bits;
* selector 0, an escape: the next word is one id of 64 bits as it is.

Ids are cut into blocks of ``BLOCK`` ids. A block begins with a word of its own, and a table
has the place of every block's first word: blocks can be read alone, and all words of one
selector are unpacked together. A block's last word may have room left over, filled with zeros.

Frame: magic, then little-endian: n_ids u64, n_blocks u32, n_words u32, the block offsets u32,
the words u64.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"S8B1"
BLOCK = 1024
# Fixed values of the format: ids in a word, and bits of an id, by selector.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0], dtype=np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], dtype=np.int64)
ESCAPE = 0
_HEAD = struct.Struct("<4sQII")


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of every id. Above 2**53 the number may be one too high, which costs an escape at most."""
    if len(ids) and int(ids.max()) < len(_WIDTH_OF):
        return _WIDTH_OF[ids.astype(np.int64)]
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


_WIDTH_OF = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def encode(ids: np.ndarray) -> bytes:
    """A frame of the ids (unsigned, up to 64 bits)."""
    ids = np.ascontiguousarray(ids, dtype="<u8")
    n = len(ids)
    blocks = -(-n // BLOCK)
    # A block is a line; room beyond its end fits anything.
    widths = np.zeros((blocks, BLOCK + 60), dtype=np.uint8)
    lines = np.zeros(blocks * BLOCK, dtype=np.uint8)
    lines[:n] = _widths(ids)
    widths[:, :BLOCK] = lines.reshape(blocks, BLOCK)
    # The selector if a word began here: the most ids that all fit. ``widest``: of the next k ids.
    selector = np.full((blocks, BLOCK), ESCAPE, dtype=np.uint8)
    widest, k = widths, 1
    for s in range(14, 0, -1):
        while k < COUNTS[s]:
            widest = np.maximum(widest[:, :-1], widths[:, k:])
            k += 1
        fits = widest[:, :BLOCK] <= WIDTHS[s]
        if not fits.any():
            break
        np.copyto(selector, np.uint8(s), where=fits)
    # All blocks walk from word to word together.
    sizes = np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    steps = np.maximum(COUNTS, 1)
    rows, at, walked = np.arange(blocks), np.zeros(blocks, dtype=np.int64), []
    while (at < sizes).any():
        walked.append(np.where(at < sizes, at, -1))
        at = at + steps[selector[rows, np.minimum(at, BLOCK - 1)]]
    places = np.stack(walked, axis=1) if walked else np.zeros((0, 0), dtype=np.int64)
    row, turn = np.nonzero(places >= 0)
    inside = places[row, turn]
    begin = row * BLOCK + inside
    chosen = selector[row, inside].astype(np.int64)
    taken = np.minimum(steps[chosen], sizes[row] - inside)
    length = np.where(chosen == ESCAPE, 2, 1)
    place = np.cumsum(length) - length
    words = np.zeros(int(length.sum()), dtype="<u8")
    padded = np.append(ids, np.zeros(60, dtype="<u8"))
    for s in np.unique(chosen):
        own = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[own] + 1] = ids[begin[own]]
            continue
        lanes = np.arange(COUNTS[s])
        values = padded[begin[own][:, None] + lanes]
        values[lanes >= taken[own][:, None]] = 0
        shifted = values << (lanes * WIDTHS[s]).astype("<u8")
        words[place[own]] = np.bitwise_or.reduce(shifted, axis=1) | np.uint64(int(s) << 60)
    offsets = place[inside == 0].astype("<u4")
    return _HEAD.pack(MAGIC, n, len(offsets), len(words)) + offsets.tobytes() + words.tobytes()


def _parts(frame: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    magic, n, blocks, words = _HEAD.unpack_from(frame)
    if magic != MAGIC or len(frame) != _HEAD.size + 4 * blocks + 8 * words:
        raise ValueError("not a frame of this format")
    offsets = np.frombuffer(frame, "<u4", blocks, _HEAD.size)
    return n, offsets, np.frombuffer(frame, "<u8", words, _HEAD.size + 4 * blocks)


def _unpack(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks; ``first``: where each begins in ``words``; ``sizes``: its ids."""
    out = np.zeros(int(sizes.sum()), dtype="<u8")
    if not len(out):
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    # Escapes are rare, and what follows one is no selector: they are found in order.
    for k in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[k]:
            raw[k + 1] = True
    counts = np.where(raw, 1, COUNTS[selector])
    before = np.cumsum(counts) - counts
    block = np.searchsorted(first, np.arange(len(words)), side="right") - 1
    base = np.cumsum(sizes) - sizes
    place = base[block] + before - before[first][block]
    limit = (base + sizes)[block]
    out[place[raw]] = words[raw]
    for s in np.unique(selector[~raw]):
        if s == ESCAPE:
            continue
        own = np.flatnonzero((selector == s) & ~raw)
        lanes = np.arange(COUNTS[s])
        values = (words[own][:, None] >> (lanes * WIDTHS[s]).astype("<u8")) & np.uint64((1 << int(WIDTHS[s])) - 1)
        to = place[own][:, None] + lanes
        inside = to < limit[own][:, None]
        out[to[inside]] = values[inside]
    return out


def decode(frame: bytes) -> np.ndarray:
    """All ids of a frame as unsigned 64-bit integers."""
    n, offsets, words = _parts(frame)
    sizes = np.minimum(np.full(len(offsets), BLOCK), n - np.arange(len(offsets)) * BLOCK)
    return _unpack(words, offsets.astype(np.int64), sizes)


def decode_block(frame: bytes, number: int) -> np.ndarray:
    """The ids of one block, reading its words only."""
    n, offsets, words = _parts(frame)
    begin = int(offsets[number])
    end = int(offsets[number + 1]) if number + 1 < len(offsets) else len(words)
    size = min(BLOCK, n - number * BLOCK)
    return _unpack(words[begin:end], np.zeros(1, dtype=np.int64), np.array([size]))
