"""md5 of many short texts at once: NumPy works on all of them step by step, instead of a call for each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from itertools import groupby
from math import sin

import numpy as np

_START = [np.array([[v]], np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
_SINES = np.array([int(abs(sin(i + 1)) * 2**32) for i in range(64)], np.uint32)
#: The word of a block that each of the 64 steps adds, and the bits by which it turns.
_WORDS = [w % 16 for f, g in ((1, 0), (5, 1), (3, 5), (7, 0)) for w in range(g, g + 16 * f, f)]
_TURNS = [by for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for by in row * 4]
_STEPS = [(i // 16, w, np.array(by, np.uint32), np.array(32 - by, np.uint32)) for i, (w, by) in enumerate(zip(_WORDS, _TURNS))]


def _block(state: list[np.ndarray], same: np.ndarray, columns: dict[int, np.ndarray], rows: dict[int, np.ndarray]) -> list[np.ndarray]:
    """md5's state after a block of all texts, a row for each start, a column for each ending. ``same``: what its
    16 words are everywhere; ``columns`` and ``rows``: what starts and endings add to some of them."""
    a, b, c, d = (x.copy() for x in state)
    t, u = np.empty_like(a), np.empty_like(a)
    invert, add, left, right = np.invert, np.add, np.left_shift, np.right_shift
    xor, either, both = np.bitwise_xor, np.bitwise_or, np.bitwise_and
    known = _SINES + same[_WORDS]
    for i, (turn, word, by, rest) in enumerate(_STEPS):
        if word in rows and a.shape[1] == 1:
            # up to here the endings have no part in it
            a, b, c, d, t, u = (np.repeat(x, len(rows[word]), axis=1) for x in (a, b, c, d, t, u))
        if turn == 0:
            xor(c, d, t), both(b, t, t), xor(d, t, t)
        elif turn == 1:
            xor(b, c, t), both(d, t, t), xor(c, t, t)
        elif turn == 2:
            xor(b, c, t), xor(d, t, t)
        else:
            invert(d, t), either(b, t, t), xor(c, t, t)
        add(a, t, a), add(a, columns[word] + known[i] if word in columns else known[i], a)
        if word in rows:
            add(a, rows[word], a)
        right(a, rest, u), left(a, by, a), either(a, u, a), add(a, b, a)
        a, b, c, d = d, a, b, c
    return [x + y for x, y in zip((a, b, c, d), state)]


@lru_cache(maxsize=32)
def _endings(at: int, k: int, first: int, last: int) -> tuple[list[tuple[np.ndarray, dict[int, np.ndarray]]], np.ndarray]:
    """The blocks with ``draw:slot`` from byte ``at`` on, slots 1 .. k by draws first .. last - 1, and each text's
    last block. Words that all texts share are held once."""
    runs = [[(n, list(g)) for n, g in groupby(texts, len)] for texts in ([b"%d" % s for s in range(1, k + 1)], [b"%d:" % d for d in range(first, last)])]
    blocks = (at % 64 + runs[0][-1][0] + runs[1][-1][0] + 8) // 64 + 1
    data, final = np.zeros((k, last - first, 64 * blocks), np.uint8), np.zeros((k, last - first), np.int8)
    x = 0
    for slot, slots in runs[0]:
        y = 0
        for draw, draws in runs[1]:
            # texts of equal length: a rectangle of slots by draws
            cell = (slice(x, x + len(slots)), slice(y, y + len(draws)))
            one = at % 64 + draw
            two = one + slot
            data[cell][..., at % 64 : one] = np.frombuffer(b"".join(draws), np.uint8).reshape(1, -1, draw)
            data[cell][..., one:two] = np.frombuffer(b"".join(slots), np.uint8).reshape(-1, 1, slot)
            data[cell][..., two] = 0x80
            final[cell] = (two + 8) // 64
            end = 64 * ((two + 8) // 64 + 1)
            data[cell][..., end - 8 : end] = np.frombuffer((8 * (at + draw + slot)).to_bytes(8, "little"), np.uint8)
            y += len(draws)
        x += len(slots)
    words = np.ascontiguousarray(data.reshape(-1, 64 * blocks).view("<u4").T.astype(np.uint32)).reshape(blocks, 16, -1)
    made = []
    for block in words:
        same = (block == block[:, :1]).all(axis=1)
        made.append((np.where(same, block[:, 0], np.uint32(0)), {w: block[w].copy() for w in np.flatnonzero(~same).tolist()}))
    return made, final.reshape(-1)


def heads(starts: Sequence[bytes], k: int, first: int, last: int) -> np.ndarray:
    """The first 48 bits of md5 of each of ``starts``, which are equally long, followed by ``draw:slot``: by start,
    slot 1 .. k and draw first .. last - 1."""
    length = len(starts[0])
    full, begun = length // 64, (length + 63) // 64
    words = np.frombuffer(b"".join(s.ljust(64 * begun, b"\0") for s in starts), "<u4").astype(np.uint32).reshape(len(starts), 16 * begun)
    state = [np.repeat(x, len(starts), axis=0) for x in _START]
    columns = [{w: words[:, 16 * i + w, None] for w in range(16)} for i in range(begun)]
    for block in columns[:full]:
        state = _block(state, np.zeros(16, np.uint32), block, {})
    blocks, final = _endings(length, k, first, last)
    done = state
    for i, (same, rows) in enumerate(blocks):
        mine = {w: columns[full][w] for w in range((length % 64 + 3) // 4)} if i == 0 else {}
        state = _block(state, same, mine, rows)
        done = state if i == 0 else [np.where(final == i, x, y) for x, y in zip(state, done)]
    high, low = (np.broadcast_to(x, (len(starts), len(final))).byteswap().astype(np.uint64) for x in done[:2])
    return ((high << np.uint64(16)) | (low >> np.uint64(16))).reshape(len(starts), k, last - first)
