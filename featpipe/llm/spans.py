"""Words and n-grams of many texts as spans of bytes, hashed and interned with NumPy.

A batch of texts becomes one lower-cased buffer in which words are parted by one
space; a word or n-gram is a (start, length) in it. ``lanes`` holds the eight
bytes from every position as one number, so hashing and comparing spans are a
few array operations per eight bytes.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

#: Text bytes that are interned together.
BLOCK_BYTES = 2 << 20
#: Spans longer than this are hashed one by one.
LONG_SPAN = 64

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
LOWER = (_BYTES + 32 * _UPPER).astype(np.uint8)
#: Bytes of words: digits, letters and all of other characters.
IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

# primes of xxHash64
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


class Words(NamedTuple):
    """Words of a block: bytes, lanes, start and length of each word, and the piece it stands in."""
    buffer: np.ndarray
    lanes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    piece: np.ndarray


def lanes_of(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a little-endian number; bytes past the end are 0."""
    padded = np.concatenate([buffer, np.zeros(16, dtype=np.uint8)]).tobytes()
    lanes = np.empty((len(buffer) + 8) // 8 * 8, dtype=np.uint64)
    for r in range(8):
        lanes[r::8] = np.frombuffer(padded, dtype="<u8", offset=r, count=len(lanes) // 8)
    return lanes


def _last_word(text: np.ndarray, end: int, least: int) -> int:
    """Start of the last word that ends before ``end``; ``least`` if there is none after it."""
    step = 1 << 12
    while True:
        low = max(least, end - step)
        word = IS_WORD[text[low:end]]
        inside = np.flatnonzero(word)
        if len(inside):
            before = np.flatnonzero(~word[:inside[-1]])
            if len(before):
                return low + int(before[-1]) + 1
        if low == least:
            return least
        step *= 4


def pieces(text: bytes, limit: int, carry: bool):
    """(part, carried) of a text: cut between words, about ``limit`` bytes each.

    With ``carry`` a later part starts with the last word of the one before it.
    A word longer than ``limit`` stays whole."""
    if len(text) <= limit:
        yield text, False
        return
    whole, start, carried = np.frombuffer(text, dtype=np.uint8), 0, False
    least = 0  # up to here all is done
    while True:
        end, size = 0, limit
        while start + size < len(whole):
            between = np.flatnonzero(~IS_WORD[whole[least + 1:start + size]])
            if len(between):
                end = least + 1 + int(between[-1])
                break
            size *= 2
        if not end or end <= start:
            yield text[start:], carried
            return
        yield text[start:end], carried
        least, start = end, _last_word(whole, end, start) if carry else end
        carried = carry and bool(IS_WORD[whole[start]])
        if carry and not carried:
            start = end


def text_blocks(texts, limit: int = BLOCK_BYTES, carry: bool = False):
    """(parts, owners, carried) of about ``limit`` bytes: parts of texts, the number of the text each is of, and
    whether its first word was the last of the part before. Empty and null texts have no part."""
    held, size = [], 0
    for owner, text in enumerate(texts):
        if not text:
            continue
        for part, carried in pieces(text, limit, carry):
            if held and size + len(part) > limit:
                yield tuple(map(list, zip(*held)))
                held, size = [], 0
            held.append((part, owner, carried))
            size += len(part)
    if held:
        yield tuple(map(list, zip(*held)))


def words_of(parts: list[bytes]) -> Words:
    """The words of the parts in order; no word reaches over the end of its part."""
    raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    word = IS_WORD[raw]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(raw) and word[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    lengths = ends - starts
    low = LOWER[raw]
    low[ends] = 32
    word[ends] = True
    buffer = low[word]
    place = np.cumsum(lengths + 1) - lengths - 1
    last = np.cumsum([len(p) + 1 for p in parts])
    return Words(buffer, lanes_of(buffer), place, lengths, np.searchsorted(last, starts, side="right"))


def by_length(lengths: np.ndarray) -> np.ndarray:
    """Order of descending lengths."""
    if len(lengths) and lengths.max() < 1 << 16:
        return np.argsort((0xFFFF - lengths).astype(np.uint16), kind="stable")  # a radix sort
    return np.argsort(-lengths, kind="stable")


def _rotate(x, r: int):
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _of_length(lanes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """xxHash64 of the spans of one length that start at ``at``."""
    done = 0
    if length >= 32:
        v = [np.full(len(at), int(x) & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64) for x in (int(P1) + int(P2), P2, 0, -int(P1))]
        while done + 32 <= length:
            for k in range(4):
                v[k] = _rotate(v[k] + lanes[at + (done + 8 * k)] * P2, 31) * P1
            done += 32
        h = _rotate(v[0], 1) + _rotate(v[1], 7) + _rotate(v[2], 12) + _rotate(v[3], 18)
        for x in v:
            h = (h ^ (_rotate(x * P2, 31) * P1)) * P1 + P4
    else:
        h = np.full(len(at), P5, dtype=np.uint64)
    h += np.uint64(length)
    while done + 8 <= length:
        h = _rotate(h ^ (_rotate(lanes[at + done] * P2, 31) * P1), 27) * P1 + P4
        done += 8
    if done < length:
        tail = lanes[at + done]
        if length - done >= 4:
            h = _rotate(h ^ ((tail & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
            tail = tail >> np.uint64(32)
            done += 4
        for k in range(length - done):
            h = _rotate(h ^ (((tail >> np.uint64(8 * k)) & np.uint64(0xFF)) * P5), 11) * P1
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    return h ^ (h >> np.uint64(32))


def hashes(buffer: np.ndarray, lanes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of every span; ``lengths`` must descend."""
    import xxhash
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    edges = np.concatenate(([0], np.flatnonzero(lengths[1:] != lengths[:-1]) + 1, [len(lengths)]))
    for a, b in zip(edges[:-1], edges[1:]):
        length = int(lengths[a])
        if length > LONG_SPAN:
            out[a:b] = [xxhash.xxh64_intdigest(buffer[s:s + length].tobytes()) for s in starts[a:b].tolist()]
        else:
            out[a:b] = _of_length(lanes, starts[a:b], length)
    return out


def same_bytes(lanes_a, a, lanes_b, b, lengths) -> np.ndarray:
    """Whether spans of equal, descending lengths hold equal bytes."""
    same = np.ones(len(lengths), dtype=bool)
    k, n = 0, int(np.count_nonzero(lengths > 0))
    while n:
        left = np.minimum(lengths[:n] - 8 * k, 8).astype(np.uint64)
        drop = (np.uint64(8) - left) * np.uint64(8)
        same[:n] &= ((lanes_a[a[:n] + 8 * k] ^ lanes_b[b[:n] + 8 * k]) << drop) == 0
        k += 1
        n = int(np.searchsorted(-lengths, -8 * k, side="left"))
    return same


class Table:
    """Open-addressed table of distinct spans of one buffer.

    A slot holds the span that owns it; spans are looked up by their xxHash64,
    step to the next slot while it belongs to another span, and are compared
    byte by byte with the owner before they share it."""

    def __init__(self, buffer: np.ndarray, lanes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        order = by_length(lengths)
        self.buffer, self.lanes = buffer, lanes
        self.starts, self.lengths = starts[order], lengths[order]
        self.keys = hashes(buffer, lanes, self.starts, self.lengths)
        size = 1 << max(4, int(2 * len(starts)).bit_length())
        self.mask = np.uint64(size - 1)
        self.owner = np.full(size, -1, dtype=np.int64)
        slot = self._place(np.arange(len(starts)))
        taken = np.flatnonzero(self.owner >= 0)
        number = np.empty(size, dtype=np.int64)
        number[taken] = np.arange(len(taken))
        #: Number of the distinct span of each slot, and a span that has it.
        self.number, self.first = number, self.owner[taken]
        #: Distinct span of each span, in the order given.
        self.ids = np.empty(len(starts), dtype=np.int64)
        self.ids[order] = number[slot]
        #: Occurrences of each distinct span.
        self.counts = np.bincount(self.ids, minlength=len(taken))

    def _place(self, left: np.ndarray) -> np.ndarray:
        slot = (self.keys & self.mask).astype(np.int64)
        while len(left):
            at = slot[left]
            free = self.owner[at] < 0
            self.owner[at[free]] = left[free]
            own = self.owner[at]
            same = (self.keys[own] == self.keys[left]) & (self.lengths[own] == self.lengths[left])
            check = np.flatnonzero(same & (own != left))
            same[check] = same_bytes(self.lanes, self.starts[own[check]], self.lanes, self.starts[left[check]], self.lengths[left[check]])
            left = left[~same]
            slot[left] = (slot[left] + 1) & int(self.mask)
        return slot

    def find(self, buffer, lanes, starts, lengths) -> np.ndarray:
        """Number of the distinct span that equals each span of another buffer; -1 if none does."""
        out = np.full(len(starts), -1, dtype=np.int64)
        order = by_length(lengths)
        starts, lengths = starts[order], lengths[order]
        keys = hashes(buffer, lanes, starts, lengths)
        slot = (keys & self.mask).astype(np.int64)
        left = np.arange(len(starts))
        while len(left):
            own = self.owner[slot[left]]
            left, own = left[own >= 0], own[own >= 0]
            same = (self.keys[own] == keys[left]) & (self.lengths[own] == lengths[left])
            check = np.flatnonzero(same)
            same[check] = same_bytes(self.lanes, self.starts[own[check]], lanes, starts[left[check]], lengths[left[check]])
            out[order[left[same]]] = self.number[slot[left[same]]]
            left = left[~same]
            slot[left] = (slot[left] + 1) & int(self.mask)
        return out

    def crc32(self) -> np.ndarray:
        """crc32 of each distinct span's bytes, in the order of their numbers."""
        order = by_length(self.lengths[self.first])
        starts, lengths = self.starts[self.first][order], self.lengths[self.first][order]
        out = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
        j, long = 0, int(np.count_nonzero(lengths > LONG_SPAN))
        n = len(order)
        while n > long:
            low = (out[long:n] ^ self.buffer[starts[long:n] + j]) & np.uint32(0xFF)
            out[long:n] = CRC[low] ^ (out[long:n] >> np.uint32(8))
            j += 1
            n = int(np.searchsorted(-lengths, -j, side="left"))
        out ^= np.uint32(0xFFFFFFFF)
        out[:long] = [zlib.crc32(self.buffer[s:s + length].tobytes()) for s, length in zip(starts[:long].tolist(), lengths[:long].tolist())]
        back = np.empty(len(order), dtype=np.uint32)
        back[order] = out
        return back


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


CRC = _crc_table()
