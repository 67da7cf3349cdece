"""Simple-8b word-aligned coding of ids, vectorised both ways.

A 64-bit word holds a 4-bit selector (top) and 60 bits of payload: selector
``s`` in 1..14 packs ``COUNTS[s]`` ids of ``WIDTHS[s]`` bits, lowest first.
Selector 0 is an escape: its payload is an index into a list of whole 64-bit
ids, for ids over 60 bits.  Ids are coded in blocks of ``BLOCK`` ids, each
starting on a word of its own; the index holds each block's first word, so
blocks decode independently of each other.  Within a block words are chosen
greedily: the most ids that fit.
"""

from __future__ import annotations

import numpy as np

COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
BLOCK = 256
#: A block in work has room for the spare lanes of its last word, so that no lane needs a test.
_ROW = BLOCK + 60
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_SHORT = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    if len(ids) and ids.max() < 1 << 16:
        return _SHORT[ids.astype(np.uint16)]
    return np.searchsorted(_POWERS, ids, side="right").astype(np.uint8)


def _rows(n: int) -> tuple[int, np.ndarray]:
    """Blocks of ``n`` ids, and the place of each id in rows of ``_ROW``."""
    place = np.arange(n)
    return -(-n // BLOCK), place + place // BLOCK * (_ROW - BLOCK)


def _choices(width: np.ndarray) -> np.ndarray:
    """The selector of a word that starts at each place: the most ids that fit.

    ``width`` is padded with zeros behind each block, so a block's last word may
    have spare lanes.  The widest id of the next ``c`` is the wider one of two
    shorter runs, for all places at once.
    """
    def after(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        out[:, :-by] = x[:, by:]
        return out

    widest = {1: width}
    for c in range(2, 9):
        widest[c] = np.maximum(widest[c - 1], after(width, c - 1))
    for c, a in ((10, 8), (12, 8), (15, 8), (20, 10), (30, 15), (60, 30)):
        widest[c] = np.maximum(widest[a], after(widest[c - a], a))
    choice = np.zeros(width.shape, dtype=np.uint8)  # escape, unless something fits
    for s in range(len(COUNTS) - 1, 0, -1):  # from few wide ids to many narrow ones
        choice[widest[int(COUNTS[s])] <= WIDTHS[s]] = s
    return choice


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words uint64, first word of each block uint32, escaped ids uint64)``."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint64)
    blocks, at = _rows(n)
    padded = np.zeros(blocks * _ROW, dtype=np.uint64)
    padded[at] = ids
    width = np.zeros(blocks * _ROW, dtype=np.uint8)
    width[at] = _widths(ids)
    choice = _choices(width.reshape(blocks, _ROW)).ravel()

    place = np.arange(blocks) * _ROW
    end = place + np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    live, steps = np.arange(blocks), []
    step = COUNTS[choice]
    while len(live):  # one word of every block at a time
        now = place[live]
        steps.append((live, now))
        place[live] = now = now + step[now]
        live = live[now < end[live]]
    owner = np.concatenate([s[0] for s in steps])
    start = np.concatenate([s[1] for s in steps])
    order = np.argsort(start, kind="stable")
    owner, start = owner[order], start[order]
    selector = choice[start]

    words = selector.astype(np.uint64) << np.uint64(60)
    escapes = np.flatnonzero(selector == 0)
    words[escapes] |= np.arange(len(escapes), dtype=np.uint64)
    for s in np.unique(selector[selector > 0]):
        which = np.flatnonzero(selector == s)
        first, word = start[which], words[which]
        for lane in range(COUNTS[s]):
            word |= padded[first + lane] << np.uint64(lane * WIDTHS[s])
        words[which] = word
    return words, np.searchsorted(owner, np.arange(blocks)).astype(np.uint32), padded[start[escapes]]


def decode(
    words: np.ndarray, first: np.ndarray, escaped: np.ndarray, n: int
) -> np.ndarray:
    """The ``n`` ids again, uint64."""
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    blocks = len(first)
    padded = np.empty(blocks * _ROW, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    upto = np.cumsum(COUNTS[selector])
    before = upto - COUNTS[selector]
    owner = np.repeat(np.arange(blocks), np.diff(np.append(first, len(words))))
    # a block's last word may have spare lanes, so places count from the block's own start
    start = before - before[first.astype(np.int64)][owner] + owner * _ROW
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(selector):
        which = np.flatnonzero(selector == s)
        if s == 0:
            padded[start[which]] = escaped[payload[which].astype(np.int64)]
            continue
        at, held = start[which], payload[which]
        mask, width = np.uint64((1 << int(WIDTHS[s])) - 1), np.uint64(WIDTHS[s])
        for lane in range(COUNTS[s]):
            padded[at + lane] = held & mask
            held = held >> width
    return padded[_rows(n)[1]]
