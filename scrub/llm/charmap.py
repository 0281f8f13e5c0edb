"""Normalisation by a compiled character map, which remembers where each byte came from.

A map is a double-array trie over UTF-8 bytes and the texts that its keys become. At each place of a
text the longest key that matches is replaced; a character without a key stays. All places of an
Arrow batch walk down the trie together, one byte deeper per vector step. Spaces become the space mark,
and each byte of the result knows the byte of the source at which its unit begins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The mark that stands for a space (fixed value of the format).
SPACE_MARK = "▁".encode()
SPACE = 0x20
_HAS_VALUE, _VALUE, _LABEL = np.uint32(1 << 8), np.uint32((1 << 31) - 1), np.uint32(1 << 31 | 0xFF)


def gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``pool[start:start + size]`` of all pairs, one after the other."""
    ends = np.cumsum(sizes)
    index = np.repeat(starts - (ends - sizes), sizes)
    index += np.arange(len(index))
    return pool[index]


def _child(units: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Where the children of nodes begin: an offset that is kept in bytes or in blocks of 256."""
    unit = units[node]
    return node ^ ((unit >> np.uint32(10)) << ((unit & np.uint32(1 << 9)) >> np.uint32(6))).astype(np.int64)


class CharacterMap:
    """A compiled map: the size of the trie, its units, then the replacements, each ended by a zero."""

    def __init__(self, blob: bytes = b""):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4) if blob else np.zeros(0, np.uint32)
        self.pool = np.frombuffer(blob, np.uint8, offset=4 + size) if blob else np.zeros(0, np.uint8)
        self.stops = np.flatnonzero(self.pool == 0)
        self.root = int(_child(self.units, np.zeros(1, np.int64))[0]) if len(self.units) else 0
        self.begins = self._down(np.full(256, self.root), np.arange(256))[1] if len(self.units) else np.zeros(256, bool)

    def __bool__(self) -> bool:
        return len(self.units) > 0

    def _down(self, base: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes one byte deeper, and whether they are there."""
        node = base ^ byte
        there = node < len(self.units)
        node = np.where(there, node, 0)
        return node, there & ((self.units[node] & _LABEL) == byte)

    def longest(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By place: the length of the longest key there (0 for none), and where its replacement begins."""
        length, value = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
        if not self:
            return length, value
        at = np.flatnonzero(self.begins[data])
        end = offsets[np.searchsorted(offsets, at, "right")]
        base, depth = np.full(len(at), self.root), 0
        while len(at):
            node, there = self._down(base, data[at + depth].astype(np.int64))
            at, node, end = at[there], node[there], end[there]
            base, depth = _child(self.units, node), depth + 1
            full = np.flatnonzero(self.units[node] & _HAS_VALUE)
            length[at[full]] = depth
            value[at[full]] = self.units[base[full]] & _VALUE
            more = at + depth < end
            at, base, end = at[more], base[more], end[more]
        return length, value

    def chosen(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, replacement) of the keys that are replaced, from left to right."""
        length, value = self.longest(data, offsets)
        at = np.flatnonzero(length)
        reach = at + length[at]
        if (at[1:] < reach[:-1]).any():  # a key that begins inside another one is not met
            kept, free = [], 0
            for i, (a, b) in enumerate(zip(at.tolist(), reach.tolist())):
                if a >= free:
                    kept.append(i)
                    free = b
            at = at[kept]
        return at, length[at], value[at]


@dataclass
class Normal:
    """Normalised texts: byte i came from the unit of the source at ``source[i]``; ``final`` is where each text ends."""

    data: np.ndarray
    offsets: np.ndarray
    source: np.ndarray
    final: np.ndarray


@dataclass(frozen=True)
class Normalizer:
    """What a model says about its texts."""

    map: CharacterMap
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    def safe_cut(self, data: np.ndarray, low: int, high: int) -> int:
        """A place between ``low`` and ``high`` at which a text may be cut, or ``high``.

        It is a space after a printable ASCII character, with no key across it.
        """
        part = data[low:high]
        spaces = np.flatnonzero((part[1:] == SPACE) & (part[:-1] > SPACE) & (part[:-1] < 0x7F)) + 1
        if not len(spaces):
            return high
        if not self.map:
            return low + int(spaces[-1])
        at, length, _ = self.map.chosen(part, np.array([0, len(part)]))
        # What stands right before a cut must be itself, and no key may run from there over the space.
        inside = np.zeros(len(part) + 1, bool)
        for a, n in zip(at.tolist(), length.tolist()):
            inside[a + 1:a + n + 1] = True
        spaces = spaces[~inside[spaces]]
        return low + int(spaces[-1]) if len(spaces) else high

    def normalize(self, data: np.ndarray, offsets: np.ndarray, head: np.ndarray | None = None, tail: np.ndarray | None = None) -> Normal:
        """Normalise the texts ``data[offsets[i]:offsets[i + 1]]``, which are UTF-8.

        ``head``, ``tail``: whether a text is the beginning, the end of a document (a long document may come in parts).
        """
        n = len(offsets) - 1
        head = np.ones(n, bool) if head is None else head
        tail = np.ones(n, bool) if tail is None else tail
        lead = (data & 0xC0) != 0x80
        source = np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0)) if len(data) else np.zeros(0, np.int64)
        unit_head = lead.copy()
        begins, bounds = offsets[:-1], offsets[1:]
        final = bounds.copy()
        at, length, value = self.map.chosen(data, offsets)
        nothing = np.zeros(0, np.int64)  # units that become nothing
        if len(at):
            sizes = np.ones(len(data), np.int64)
            starts = data.astype(np.int64)
            for step in range(1, int(length.max())):
                sizes[at[length > step] + step] = 0
            sizes[at] = self.map.stops[np.searchsorted(self.map.stops, value)] - value
            starts[at] = 256 + value
            nothing = at[sizes[at] == 0]
            pool = np.append(np.arange(256, dtype=np.uint8), self.map.pool)
            ends = np.append(0, np.cumsum(sizes))
            data, source, offsets = gather(pool, starts, sizes), np.repeat(source, sizes), ends[offsets]
            unit_head = np.ones(len(data), bool)
            unit_head[1:] = source[1:] != source[:-1]
        if self.remove_extra:
            data, source, offsets, final = self._squeezed(data, source, offsets, unit_head, final, head, tail)
        full = head & (begins < bounds if not self.remove_extra else np.diff(offsets) > 0)
        if self.dummy_prefix and full.any():
            first, own = offsets[:-1][full], begins[full]
            if self.remove_extra:
                # The prefix stands where the text begins, after spaces that were taken away.
                hidden = np.append(nothing, np.iinfo(np.int64).max)
                own = np.minimum(source[first], hidden[np.searchsorted(nothing, own)])
            data, source = np.insert(data, first, SPACE), np.insert(source, first, own)
            offsets = offsets + np.append(0, np.cumsum(full))
        if self.escape:
            sizes = np.where(data == SPACE, len(SPACE_MARK), 1)
            pool = np.append(np.arange(256, dtype=np.uint8), np.frombuffer(SPACE_MARK, np.uint8))
            starts = np.where(data == SPACE, 256, data.astype(np.int64))
            ends = np.append(0, np.cumsum(sizes))
            data, source, offsets = gather(pool, starts, sizes), np.repeat(source, sizes), ends[offsets]
        return Normal(data, offsets, source, final)

    def _squeezed(self, data, source, offsets, unit_head, final, head, tail):
        """Without spaces at the beginning and end, and at the head of a unit after a space."""
        blank = data == SPACE
        first = np.zeros(len(data) + 1, bool)
        first[offsets[:-1][head]] = True
        after = np.zeros(len(data), bool)
        after[1:] = blank[:-1]
        after |= first[:-1]
        after[offsets[:-1][~head & (np.diff(offsets) > 0)]] = False
        # Spaces follow the one before them away, as long as they stand at the head of their unit.
        gone = blank & after & unit_head
        inner = np.flatnonzero(blank & ~unit_head)
        for i in inner.tolist():
            gone[i] = gone[i - 1] and blank[i - 1]
        keep = ~gone
        for i in np.flatnonzero(tail).tolist():
            low, b = offsets[i], offsets[i + 1]
            while b > low:
                # A mark that the text itself holds counts as a space at the end.
                size = len(SPACE_MARK) if self.escape and data[max(low, b - 3):b].tobytes() == SPACE_MARK else 1
                if size == 1 and keep[b - 1] and not blank[b - 1]:
                    break
                b -= size
                if keep[b]:
                    final[i], keep[b:b + size] = source[b], False
        ends = np.append(0, np.cumsum(keep))
        return data[keep], source[keep], ends[offsets], final
