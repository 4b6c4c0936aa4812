"""Seeded majority votes (small helpers inside ``mapInArrow``).

``Ballots`` draws the k responses of every vote, slot by slot, for prompts that fit in one array.

``votes`` gives votes of the same law from class counts alone. A vote takes k responses with replacement. How often each class is drawn follows a chain of binomials,
class after class; among the classes drawn most often each is equally likely to be the one drawn first,
and the response drawn first in a class is any of its members. So a draw needs one number in [0, 1) per
class, whatever k is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

from tallyspan.functions.digests import heads

#: Numbers in [0, 1) that are taken from one md5 digest, five bytes each.
PER_DIGEST = 3
#: Standard deviations, and counts besides, within which a binomial is tabulated.
REACH, BESIDES = 12.0, 64


def uniforms(name: str, first: int, last: int, many: int) -> np.ndarray:
    """Numbers 0 .. many - 1 of the draws first .. last - 1: ``md5(name:draw:block)``, three a digest."""
    blocks = -(-many // PER_DIGEST)
    start = hashlib.md5(f"{name}:".encode())
    digests = []
    for draw in range(first, last):
        for block in range(blocks):
            h = start.copy()
            h.update(b"%d:%d" % (draw, block))
            digests.append(h.digest()[: 5 * PER_DIGEST])
    data = np.frombuffer(b"".join(digests), np.uint8).reshape(last - first, blocks * PER_DIGEST, 5).astype(np.int64)
    return (data << np.array([32, 24, 16, 8, 0])).sum(axis=2)[:, :many] / float(1 << 40)


@lru_cache(maxsize=4096)
def _binomial(trials: int, hits: int, of: int) -> tuple[int, np.ndarray]:
    """The first count that is tabulated, and the distribution function from there on."""
    p = hits / of
    mean, dev = trials * p, (trials * p * (1 - p)) ** 0.5
    low, high = max(0, int(mean - REACH * dev) - BESIDES), min(trials, int(mean + REACH * dev) + BESIDES)
    j = np.arange(low, high, dtype=float)
    # ratios of neighbours, so that nothing under- or overflows
    steps = np.cumsum(np.log((trials - j) / (j + 1)) + np.log(p / (1 - p))) if len(j) else j
    logs = np.concatenate([[0.0], steps])
    mass = np.exp(logs - logs.max())
    total = np.cumsum(mass)
    return low, total / total[-1]


@lru_cache(maxsize=4096)
def _binomial_rows(most: int, hits: int, of: int) -> np.ndarray:
    """The distribution functions for 0 .. ``most`` trials, a row each."""
    rows = np.full((most + 1, most + 1), 2.0)
    for n in range(most + 1):
        low, total = _binomial(n, hits, of)
        rows[n, :low] = 0.0
        rows[n, low : low + len(total) - 1] = total[:-1]
    return rows


def binomials(trials: np.ndarray, hits: int, of: int, u: np.ndarray) -> np.ndarray:
    """The smallest count whose distribution function exceeds ``u``, for each number of trials."""
    most = int(trials.max(initial=0))
    if most <= BESIDES:  # whole distributions are short: all trials at once
        return (_binomial_rows(most, hits, of)[trials] <= u[:, None]).sum(axis=1)
    out = np.zeros(len(trials), np.int64)
    for n in np.unique(trials).tolist():
        some = trials == n
        low, total = _binomial(n, hits, of)
        out[some] = low + np.minimum(np.searchsorted(total, u[some], side="right"), len(total) - 1)
    return out


def votes(name: str, counts: list[int], k: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Class and member that give the value of each draw. Number 0 settles a tie, and what is left of it the
    member; number 1 + i is for the count of class i."""
    u = uniforms(name, first, last, max(len(counts), 1))
    left, of = np.full(last - first, k, np.int64), sum(counts)
    best, ties = np.full(len(left), -1, np.int64), np.zeros(len(left), np.int64)
    drawn = []
    for i, c in enumerate(counts):
        x = left if i == len(counts) - 1 else binomials(left, c, of, u[:, 1 + i])
        left, of = left - x, of - c
        ties = np.where(x > best, 1, ties + (x == best))
        best = np.maximum(best, x)
        drawn.append(x)
    scaled = u[:, 0] * ties
    nth = np.minimum(scaled.astype(np.int64), ties - 1)
    rest = scaled - nth
    winner = np.zeros(len(left), np.int64)
    for i, x in enumerate(drawn):
        top = x == best
        winner = np.where(top & (nth == 0), i, winner)
        nth = nth - top
    of_winner = np.array(counts)[winner]
    return winner, np.minimum((rest * of_winner).astype(np.int64), of_winner - 1)


def sizes(n: int) -> list[int]:
    """4, 8, ... below n, then n; nothing for two responses and less."""
    return [] if n < 3 else [*(1 << j for j in range(2, n.bit_length()) if 1 << j < n), n]


def classes(codes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The codes of groups that lie one after another, numbered from 0 in each group."""
    place, starts = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths) - lengths
    numbers = np.unique(place * (int(codes.max()) + 1) + codes, return_inverse=True)[1].reshape(-1)
    return np.split(numbers - np.minimum.reduceat(numbers, starts)[place], starts[1:])


class Ballots:
    """Votes over k members of a group, drawn with replacement by the numbers ``md5(seed:text:k:draw:slot)``.

    Groups are taken together by k and the length of their text. A text's numbers serve all its groups, and a
    vote serves those of equal classes."""

    #: Numbers made together.
    TOGETHER = 1 << 14

    def __init__(self, seed: int, draws: int):
        self.seed, self.draws = seed, draws

    def of(self, texts: Sequence[str], codes: Sequence[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
        """For each group and each k: the group's place, k, and how often each member gives the value of the vote.
        ``codes``: the members' classes from 0."""
        wanted: dict[tuple[int, int], dict[bytes, dict[bytes, list[int]]]] = {}
        for at, (text, members) in enumerate(zip(texts, codes)):
            equal = members.tobytes()
            for k in sizes(len(members)):
                start = f"{self.seed}:{text}:{k}:".encode()
                wanted.setdefault((k, len(start)), {}).setdefault(start, {}).setdefault(equal, []).append(at)
        for (k, _), of_start in wanted.items():
            starts, together = list(of_start), max(1, self.TOGETHER // (k * self.draws))
            for x in range(0, len(starts), together):
                some = starts[x : x + together]
                groups = [(i, places, codes[places[0]]) for i, start in enumerate(some) for places in of_start[start].values()]
                for (_, places, _), won in zip(groups, self._votes(some, k, [(i, c) for i, _, c in groups])):
                    for at in places:
                        yield at, k, won

    def _votes(self, starts: list[bytes], k: int, groups: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
        """How often each member of the groups wins; a group is the place of its start and its members' classes."""
        won, step = [np.zeros(len(codes), np.int64) for _, codes in groups], max(1, self.TOGETHER // k)
        for first in range(1, self.draws + 1, step):
            u = heads(starts, k, first, min(first + step, self.draws + 1)) / float(1 << 48)
            for (i, codes), wins in zip(groups, won):
                # the cells of a vote are its classes: fewer votes at a time where they outnumber its slots
                some = max(1, self.TOGETHER // (int(codes.max()) + 1))
                for x in range(0, u.shape[2], some):
                    wins += _winners(u[i, :, x : x + some], codes)
        return won


def _winners(u: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """How often each member wins the votes of ``u``, a row for each slot, a column for each vote.
    The most frequent class wins, among equals the one drawn first; its value is that of its first draw."""
    (k, many), n = u.shape, len(codes)
    drawn, vote = (u * n).astype(np.int64), np.arange(many)
    cell = codes[drawn] * many + vote
    often = np.bincount(cell.reshape(-1), minlength=(int(codes.max()) + 1) * many)[cell]
    # the first slot of a class drawn most often: its count and its distance from the end are the largest
    best = (often * k - np.arange(k)[:, None]).max(axis=0)
    return np.bincount(drawn[-best % k, vote], minlength=n)


def moments(won: Sequence[np.ndarray], begins: np.ndarray, value: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and population std of each vote's known values by how often they won, and whether one did.
    The members of a vote are the rows from its place in ``begins`` on."""
    lengths = np.array([len(w) for w in won])
    starts = np.cumsum(lengths) - lengths
    member = np.arange(lengths.sum()) + np.repeat(begins - starts, lengths)
    w = np.where(known[member], np.concatenate(won), 0)
    some, v = w > 0, value[member]
    total = np.add.reduceat(w, starts)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.add.reduceat(np.where(some, w * v, 0.0), starts) / total
        spread = np.add.reduceat(np.where(some, w * (v - np.repeat(mean, lengths)) ** 2, 0.0), starts) / total
    return mean, np.sqrt(spread), total > 0
