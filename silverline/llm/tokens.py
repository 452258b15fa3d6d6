"""Token ids of whole texts, by a tokenizer file, at the speed of a lookup per distinct word.

Byte-level BPE merges inside the pieces of its splitting pattern only, so the ids of a text
are those of its pieces in order. Texts are cut at places that are piece boundaries whatever
stands around them, many texts at once, as arrays of bytes: what lies between two cuts and is
letters and marks is one or two pieces, known by their bytes; equal pieces are brought together by
sorting, each distinct one is looked up once in a table of bounded size, and new ones are encoded by the
tokenizer. What is anything else is cut by a pattern, piece by piece. Files of another kind are
encoded text by text.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterable, Iterator

from itertools import chain

import numpy as np

# The public tokenizer of the registered queries, and the id that ends a document there.
TOKENIZER, END_ID = "byte_bpe_50k.json", 2
# Entries of one generation of the table of pieces, and of the pieces seen once; characters of its longest entries.
PIECES, LONGEST = 240_000, 32
# Characters of the texts that are encoded together.
TOGETHER = 1_000_000
# Pieces in one call of the model.
CALL = 256

_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARK = r".,;:!?*$%&#|<>()"
# Letters with the blank before them, marks, a single line end, or else anything up to the next sure boundary.
# Sure are: around letters that no other letter touches, whose token a blank before them always joins; between a character
# that is not white space and a blank or line end that is followed by one; between a mark and a letter
# (marks without the apostrophe, which starts contractions).
_PIECES = re.compile(
    rf" ?[{_LETTER}]++(?!\w)(?=[ \n]\S|[^\s]|\Z)|[{_MARK}]++(?=[ \n]\S|[A-Za-z]|\Z)|\n(?=\S)"
    r"|(?s:.+?)(?=(?<=\S)[ \n]\S|\Z)"
)
# A piece that the splitting pattern leaves whole: it goes straight to the tokenizer's merges.
_WHOLE = re.compile(rf"\n| ?[{_LETTER}]+|[{_MARK}]+")


# Classes of bytes. Solid ones are surely no white space; a separator lies between texts.
_OTHER, _LETTER_BYTE, _MARK_BYTE, _SOLID, _BLANK, _LINE, _SEPARATOR = range(7)
_SEPARATOR_BYTE = b"\xff"
_WORD = 16  # bytes of the longest piece that is known by its bytes


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.uint8)
    table[33:127] = _SOLID
    for low, high in (b"AZ", b"az"):
        table[low : high + 1] = _LETTER_BYTE
    table[list(_MARK.encode())] = _MARK_BYTE
    table[32], table[10], table[255] = _BLANK, _LINE, _SEPARATOR
    return table


_CLASS = _class_table()
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _classes(data: np.ndarray) -> np.ndarray:
    """The class of every byte; the two bytes of a letter from À to ɏ are letters."""
    found = _CLASS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
    first, second = data[lead], data[lead + 1]
    letter = ~((first == 0xC3) & ((second == 0x97) | (second == 0xB7))) & ~((first == 0xC9) & (second > 0x8F))
    lead = lead[letter]
    found[lead] = found[lead + 1] = _LETTER_BYTE
    return found


def _units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every unit in order, and whether it is a short piece of letters or marks, or one line end.

    ``data`` begins and ends with a separator; separators are in no unit.
    """
    kind = _classes(data)
    solid = (kind >= _LETTER_BYTE) & (kind <= _SOLID)
    blank = (kind == _BLANK) | (kind == _LINE)
    cuts = np.zeros(len(data) + 1, dtype=bool)
    cuts[1:-2] = blank[1:-1] & solid[:-2] & solid[2:]
    separators = np.flatnonzero(kind == _SEPARATOR)
    cuts[separators] = cuts[separators + 1] = True
    begin = np.flatnonzero(cuts)
    begin, end = begin[:-1], begin[1:]
    text = kind[begin] != _SEPARATOR
    begin, end = begin[text], end[text]
    # Runs of one class: where the run of a byte ends.
    change = kind[1:] != kind[:-1]
    run = np.concatenate([[0], np.cumsum(change, dtype=np.int32)])
    run_end = np.append(np.flatnonzero(change) + 1, len(data))
    led = blank[begin]
    letters = begin + led
    letters_end = run_end[run[letters]]
    marked = kind[np.minimum(letters_end, len(data) - 1)] == _MARK_BYTE
    marks_end = np.where(marked, run_end[run[np.minimum(letters_end, len(data) - 1)]], letters_end)
    simple = (kind[letters] == _LETTER_BYTE) & (marks_end == end)
    simple &= (letters_end - begin <= _WORD) & (end - letters_end <= _WORD)
    marked &= simple
    line = simple & (kind[begin] == _LINE)
    # A chunk gives its line end, its letters with the blank before them, its marks; or itself.
    per_chunk = 1 + line + marked
    place = np.cumsum(per_chunk) - per_chunk
    total = int(per_chunk.sum())
    unit_begin, unit_end, short = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, bool)
    unit_begin[place], unit_end[place], short[place] = begin, begin + 1, True
    word = place + line
    unit_begin[word] = np.where(line, letters, begin)
    unit_end[word] = np.where(simple, letters_end, end)
    short[word] = simple
    last = word[marked] + 1
    unit_begin[last], unit_end[last], short[last] = letters_end[marked], end[marked], True
    return unit_begin, unit_end, short


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of numbers: one place of each distinct pair, and for every pair which of these equals it."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ second * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed)
    differs = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    if (differs & (mixed[order][1:] == mixed[order][:-1])).any():  # two pairs of one number: order by the pairs
        order = np.lexsort((second, first))
        differs = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    new = np.concatenate([np.ones(min(len(order), 1), dtype=bool), differs])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def public_path(name: str = TOKENIZER) -> str:
    """Where a machine keeps the file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Table:
    """Ids by piece (its text or its bytes), of bounded size; ``find`` gives those of new pieces.

    A piece is kept apart until it is asked for again: most pieces of a corpus are seen once, and these do
    not push out the others. What was not asked for during a whole generation is forgotten.
    """

    def __init__(self, entries: int, find):
        self._entries, self._find = entries, find
        self._new: dict = {}
        self._old: dict = {}
        self._once: dict = {}

    def get(self, pieces: list) -> list[bytes]:
        """The ids of pieces, in order; a piece should be there once."""
        if len(self._new) > self._entries:
            self._old, self._new = self._new, {}
        values = list(map(self._new.get, pieces))
        unknown: list = []
        places: list[int] = []
        for place in [i for i, ids in enumerate(values) if ids is None]:
            piece = pieces[place]
            ids = self._old.get(piece) or self._once.pop(piece, None)
            if ids is None:
                unknown.append(piece)
                places.append(place)
            else:
                values[place] = self._new[piece] = ids
        if len(self._once) > self._entries:
            self._once = {}
        for piece, place, ids in zip(unknown, places, self._find(unknown), strict=True):
            values[place] = ids
            if len(piece) <= LONGEST:
                self._once[piece] = ids
        return values


class Encoder:
    """Encodes texts to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        self._by_piece = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(spec.get(part) for part in ("normalizer", "post_processor", "truncation", "padding"))
        )
        self._added = [t["content"] for t in spec.get("added_tokens", [])]
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        between = self._letters[0xC0]
        self._between = spec.get("model", {}).get("vocab", {}).get(between) if self._by_piece else None
        merged = chain.from_iterable(chain.from_iterable(spec.get("model", {}).get("merges", []))) if self._by_piece else ()
        self._by_piece = self._by_piece and self._between is not None and between not in set(merged)
        self._words = _Table(PIECES, self._new_words)
        self._pieces = _Table(PIECES // 8, self._new_pieces)

    def _plain(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [array("I", e.ids).tobytes() for e in encoded]

    def _new_words(self, words: list[bytes]) -> list[bytes]:
        """Whole pieces by the model alone, which is what the tokenizer would do with them.

        Many go in one call, with a byte between them that no merge has and no text can hold.
        """
        found: list[bytes] = []
        for at in range(0, len(words), CALL):
            spelt = b"\xc0".join(words[at : at + CALL]).decode("latin-1").translate(self._letters)
            ids = np.array([t.id for t in self._model.tokenize(spelt)], dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self._between), len(ids)).tolist()
            data, begin = ids.tobytes(), 0
            for end in ends:
                found.append(data[4 * begin : 4 * end])
                begin = end + 1
        return found

    def _new_pieces(self, pieces: list[str]) -> list[bytes]:
        whole = [p for p in pieces if _WHOLE.fullmatch(p)]
        ids = dict(zip(whole, self._new_words([p.encode() for p in whole]), strict=True))
        others = [p for p in pieces if p not in ids]
        ids.update(zip(others, self._plain(others), strict=True))
        return [ids[p] for p in pieces]

    def _cut(self, texts: list[str]) -> list[bytes]:
        """Texts by their pieces: one lookup for each distinct short piece, one for every other piece."""
        raw = [t.encode() for t in texts]
        data = b"".join([_SEPARATOR_BYTE, _SEPARATOR_BYTE.join(raw), _SEPARATOR_BYTE])
        begin, end, short = _units(np.frombuffer(data, np.uint8))
        padded = data + bytes(_WORD)
        at_any_byte = np.ndarray((len(data) + 8,), dtype="<u8", buffer=padded, strides=(1,))
        size = (end - begin)[short]
        first = at_any_byte[begin[short]] & _LOW_BYTES[np.minimum(size, 8)]
        second = at_any_byte[begin[short] + 8 - (size <= 8) * 8] & _LOW_BYTES[np.maximum(size - 8, 0)]
        sample, which = _distinct(first, second)
        a, b = begin[short][sample].tolist(), end[short][sample].tolist()
        ids = self._words.get([data[i:j] for i, j in zip(a, b, strict=True)])
        # What the source of every unit is: a distinct piece, or a unit of its own.
        source = np.empty(len(begin), dtype=np.int64)
        source[short] = which
        own = np.flatnonzero(~short)
        source[own] = len(ids) + np.arange(len(own))
        pieces = [_PIECES.findall(data[i:j].decode()) for i, j in zip(begin[own].tolist(), end[own].tolist(), strict=True)]
        distinct = list(dict.fromkeys(chain.from_iterable(pieces)))
        ids_of = dict(zip(distinct, self._pieces.get(distinct), strict=True)).__getitem__
        ids += [b"".join(map(ids_of, p)) for p in pieces]
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        each = sizes[source]
        until = np.concatenate([[0], np.cumsum(each)])
        found = flat[np.repeat(starts[source] - until[:-1], each) + np.arange(until[-1])].tobytes()
        # A text's units are those between its separators.
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        text_begin = 1 + np.cumsum(lengths + 1) - (lengths + 1)
        bounds = until[np.searchsorted(begin, np.append(text_begin, len(data)))] * 4
        return [found[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _some(self, texts: list[str]) -> list[bytes]:
        if not self._by_piece:
            return self._plain(texts)
        out = self._cut(texts)
        # The strings of special tokens are matched before anything is cut.
        special = [i for i, t in enumerate(texts) if any(a in t for a in self._added)]
        for i, ids in zip(special, self._plain([texts[i] for i in special]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of every text in order; NULL counts as the empty text."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size >= TOGETHER:
                yield from self._some(waiting)
                waiting, size = [], 0
        if waiting:
            yield from self._some(waiting)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for a file, kept from task to task."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)
