"""ProbMinHash signatures of weighted shingles.

Every element of a weighted set sends out arrivals of a Poisson process whose rate is
its weight; each arrival falls into one of the signature's slots. A slot keeps the
element that arrives first. Two sets share a slot's element with the probability
Jaccard similarity of their weights. An element is done as soon as its next arrival
would come after the latest first arrival of all slots.

The processes of all elements of a batch of sets are run together, one arrival of each
element still active at a time.
"""

from __future__ import annotations

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective hash of 64-bit numbers (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, element) of all runs of ``size`` words, from the word hashes of texts one after another.

    A text with fewer words has one run, of all its words; one without words has none.
    """
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    sets = np.repeat(np.arange(len(lengths)), counts)
    ends = np.cumsum(lengths)
    starts = np.arange(len(sets)) + np.repeat(ends - lengths - (np.cumsum(counts) - counts), counts)
    words, last = words.view(np.uint64), ends[sets] - 1
    out = np.zeros(len(sets), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            at = starts + k
            # What is missing of a short run counts as zero.
            word = np.where(at <= last, words[np.minimum(at, last)], np.uint64(0))
            out = mixed((out + GOLDEN) ^ word)
    return sets, out


def weighted(sets: np.ndarray, elements: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (set, element) pairs in order, and their weights: 1 + ln of the count."""
    # Equal pairs can stand for each other; small set numbers are sorted by their digits.
    order = np.argsort(elements)
    numbers = sets.astype(np.min_scalar_type(sets.max())) if len(sets) else sets
    order = order[np.argsort(numbers[order], kind="stable")]
    sets, elements = sets[order], elements[order]
    first = np.ones(len(sets), dtype=bool)
    first[1:] = (sets[1:] != sets[:-1]) | (elements[1:] != elements[:-1])
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, len(sets)))
    return sets[starts], elements[starts], 1.0 + np.log(counts)


def signatures(n_sets: int, sets: np.ndarray, elements: np.ndarray, weights: np.ndarray, slots: int) -> np.ndarray:
    """One row of ``slots`` element hashes per set; zeros for a set without elements."""
    arrival = np.full(n_sets * slots, np.inf)
    winner = np.zeros(n_sets * slots, dtype=np.uint64)
    time = np.zeros(len(sets))
    seed = mixed(elements.astype(np.uint64) + GOLDEN)
    turn = np.uint64(0)
    while len(sets):
        turn += np.uint64(1)
        with np.errstate(over="ignore"):
            draw = mixed(seed + turn * GOLDEN)
            place = mixed(draw ^ GOLDEN)
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weights
        slot = sets * slots + (place % np.uint64(slots)).astype(np.int64)
        # Of the arrivals that are the first so far, the earliest of each slot stays. Elements
        # are in order, so that a tie ends alike in all sets.
        early = np.flatnonzero(time < arrival[slot])
        np.minimum.at(arrival, slot[early], time[early])
        best = early[time[early] == arrival[slot[early]]]
        winner[slot[best]] = seed[best]
        active = time < arrival.reshape(n_sets, slots).max(axis=1)[sets]
        sets, seed, time, weights = sets[active], seed[active], time[active], weights[active]
    return winner.reshape(n_sets, slots)


def fingerprints(n_sets: int, sets: np.ndarray, elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two 64-bit sums per set over its (element, weight) pairs: equal for equal weighted sets."""
    out = np.zeros((n_sets, 2), dtype=np.uint64)
    with np.errstate(over="ignore"):
        weight = counts.view(np.uint64)
        for k in range(2):
            each = mixed(mixed(elements.astype(np.uint64) + np.uint64(k + 1) * GOLDEN) ^ weight)
            np.add.at(out[:, k], sets, each)
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """Hash each run of ``rows`` slots together with its place, and each run with the next one."""
    n, slots = signature.shape
    grouped = signature.reshape(n, slots // rows, rows)
    with np.errstate(over="ignore"):
        out = np.broadcast_to(np.arange(slots // rows, dtype=np.uint64) * GOLDEN, (n, slots // rows)).copy()
        for r in range(rows):
            out = mixed(out + GOLDEN ^ grouped[:, :, r])
        # Two neighbouring bands together are a band of twice the length.
        double = mixed(mixed(out) + GOLDEN ^ np.roll(out, -1, axis=1))
    return np.concatenate([out, double], axis=1)
