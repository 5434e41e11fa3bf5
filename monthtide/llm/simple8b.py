"""Simple-8b: integers packed into 64-bit words, in blocks that are decoded by arrays.

The upper four bits of a word are its selector, the others hold values side by side, the first one lowest.
Selector k from 1 on stands for 60 // WIDTHS[k - 1] values of WIDTHS[k - 1] bits each. Selector 0 is an escape: its
payload is a place in the block's list of values that need more than 60 bits; the list follows the block's words.
Every block but the last holds as many values; the last word of a block may have unused places.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Values in a block.
BLOCK = 4096

#: The widths that selectors 1 to 14 stand for.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
_HELD = np.array([1, *(60 // int(w) for w in WIDTHS)], np.int64)  # values in a word, by selector
_MOST = int(_HELD.max())
_LIMITS = np.uint64(1) << WIDTHS
_ESCAPE = len(WIDTHS)
_LONG = np.append(_HELD[1:], 1)  # values in a word, by index of WIDTHS
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)
_PAYLOAD = np.uint64((1 << 60) - 1)


@dataclass(frozen=True)
class Packed:
    """Consecutive blocks: all words, all escaped values, and per block the numbers of words, escapes and values."""

    words: np.ndarray
    escapes: np.ndarray
    n_words: np.ndarray
    n_escapes: np.ndarray
    n_values: np.ndarray


def _choices(need: np.ndarray) -> np.ndarray:
    """For each place the narrowest width whose full word can start there, as an index of WIDTHS (one more: escape)."""
    spans = {1: need}  # the greatest need of so many places from here on
    size = 1
    while 2 * size <= _MOST:
        spans[2 * size] = _greater(spans[size], size)
        size *= 2
    least = int(need.min(initial=_ESCAPE))  # no word is narrower than the least value
    chosen = np.full(need.shape, _ESCAPE, np.uint8)
    for k in range(_ESCAPE - 1, least - 1, -1):
        held = int(_HELD[k + 1])
        size = 1 << (held.bit_length() - 1)
        most = _greater(spans[size], held - size) if held > size else spans[size]
        np.copyto(chosen, k, where=most <= k)
    return chosen


def _greater(values: np.ndarray, shift: int) -> np.ndarray:
    """The greater of each value and the one so many places on (none beyond the end)."""
    found = values.copy()
    np.maximum(found[:-shift], values[shift:], out=found[:-shift])
    return found


def _needs(values: np.ndarray) -> np.ndarray:
    """Index of the narrowest width that holds each value (one more: none does)."""
    if int(values.max(initial=0)) < len(_SMALL):
        return _SMALL[values]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)


def pack(values: np.ndarray, block: int = BLOCK) -> Packed:
    """values (unsigned, below 2**64) in blocks of so many."""
    blocks = -(-len(values) // block)
    stride = block + _MOST  # so that no word reaches into the next block
    grid = np.zeros((blocks, stride), np.uint64)
    full = len(values) // block
    grid[:full, :block] = values[: full * block].reshape(full, block)
    if full < blocks:
        grid[full, : len(values) - full * block] = values[full * block :]
    sizes = np.minimum(block, len(values) - block * np.arange(blocks))
    flat = grid.ravel()
    chosen = _choices(_needs(flat))
    live, at = np.arange(blocks), np.zeros(blocks, np.int64)
    starts, owners, n_words = [], [], np.zeros(blocks, np.int64)
    while len(live):  # one word of every block that isn't done
        start = live * stride + at
        starts.append(start)
        owners.append(live)
        n_words[live] += 1
        at = at + _LONG[chosen[start]]
        going = at < sizes[live]
        live, at = live[going], at[going]
    # The k-th word of a block was found in round k.
    place = np.concatenate([*((np.cumsum(n_words) - n_words)[o] + k for k, o in enumerate(owners)), np.zeros(0, np.int64)]).astype(np.int64)
    start = np.empty(len(place), np.int64)
    start[place] = np.concatenate([*starts, np.zeros(0, np.int64)])
    selector = chosen[start] + 1
    words = np.zeros(len(start), np.uint64)
    for k in range(1, _ESCAPE + 1):
        mine = np.flatnonzero(selector == k)
        if len(mine):
            first, word = start[mine], np.full(len(mine), np.uint64(k) << np.uint64(60))
            for held in range(int(_HELD[k])):
                word |= flat[first + held] << (np.uint64(held) * WIDTHS[k - 1])
            words[mine] = word
    owner = np.repeat(np.arange(blocks), n_words)
    escaped = np.flatnonzero(selector > _ESCAPE)
    n_escapes = np.bincount(owner[escaped], minlength=blocks)
    firsts = np.cumsum(n_escapes) - n_escapes
    words[escaped] = (np.arange(len(escaped)) - firsts[owner[escaped]]).astype(np.uint64)
    return Packed(words, flat[start[escaped]], n_words, n_escapes, sizes)


def unpack(packed: Packed) -> np.ndarray:
    """All values of consecutive blocks."""
    blocks = len(packed.n_words)
    if not blocks:
        return np.zeros(0, np.uint64)
    stride = int(packed.n_values.max()) + _MOST
    owner = np.repeat(np.arange(blocks), packed.n_words)
    selector = (packed.words >> np.uint64(60)).astype(np.int64)
    held = _HELD[selector]
    ends = np.cumsum(held)
    before = np.append(0, ends)[np.cumsum(packed.n_words) - packed.n_words]  # values in words of earlier blocks
    start = ends - held - before[owner] + owner * stride
    grid = np.zeros(blocks * stride, np.uint64)
    payload = packed.words & _PAYLOAD
    for k in range(1, _ESCAPE + 1):
        mine = np.flatnonzero(selector == k)
        if len(mine):
            places = np.arange(_HELD[k])
            mask = np.uint64((1 << int(WIDTHS[k - 1])) - 1)
            grid[start[mine, None] + places] = (payload[mine, None] >> (places.astype(np.uint64) * WIDTHS[k - 1])) & mask
    escaped = np.flatnonzero(selector == 0)
    firsts = np.cumsum(packed.n_escapes) - packed.n_escapes
    grid[start[escaped]] = packed.escapes[firsts[owner[escaped]] + payload[escaped].astype(np.int64)]
    return grid.reshape(blocks, stride)[np.arange(stride) < packed.n_values[:, None]]
