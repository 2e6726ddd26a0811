"""Weighted acyclic automata over words, as arrays.

A transducer reads a phrase word by word and gives a number for each prefix: the weight
of the arc that it takes.  States of a depth whose arcs agree in word, weight and target
are one state, so the tails that phrases share are kept once.

Transducers are made from sorted phrases from the last words to the first: all states
of a depth are looked up in the register of equal states at once, which is the
incremental construction for sorted input done a depth at a time.  Unions and
compositions follow the arcs of all automata at once, a depth at a time too.

``levels`` is the unfolded form: for each depth the arrays (parent, label, weight) of
its nodes in order, ``parent`` counting nodes of the depth before.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from docrel.llm.pair_hash import mixed, narrow, widened

Levels = list[tuple[np.ndarray, np.ndarray, np.ndarray]]
_LOW = (1 << 32) - 1


@dataclass
class Transducer:
    """``words`` in order; the arcs of state s are ``first[s]`` to ``first[s + 1]``, in
    the order of their labels (numbers of words).  State 0 has none, the last is the root."""

    words: list[bytes]
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    def packed(self) -> list[bytes]:
        return [b" ".join(self.words), narrow(np.diff(self.first)), narrow(self.label), narrow(self.weight),
                narrow(self.target)]

    @staticmethod
    def unpacked(words: bytes, sizes: bytes, label: bytes, weight: bytes, target: bytes) -> Transducer:
        first = np.concatenate(([0], np.cumsum(widened(sizes))))
        return Transducer(words.split(b" ") if words else [], first, widened(label), widened(weight), widened(target))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i] to first[i] + size[i] - 1 of all i."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def levels_of(keys: np.ndarray, weights: np.ndarray, bits: int, depth: int) -> Levels:
    """Levels of distinct sorted phrases, each packed into ``depth`` fields of ``bits``
    bits (a word's number plus one, 0 after the last).  A prefix that is no phrase of
    its own gets the weight 0."""
    out: Levels = []
    node = np.zeros(len(keys), np.int64)
    for d in range(depth):
        shift = bits * (depth - 1 - d)
        has = np.flatnonzero((keys >> shift) & ((1 << bits) - 1))
        if not len(has):
            break
        prefix = keys[has] >> shift
        new = np.concatenate(([True], prefix[1:] != prefix[:-1]))
        number = np.cumsum(new) - 1
        weight = np.zeros(int(number[-1]) + 1, np.int64)
        ends = keys[has] & ((1 << shift) - 1) == 0
        weight[number[ends]] = weights[has[ends]]
        out.append((node[has[new]], (prefix[new] & ((1 << bits) - 1)) - 1, weight))
        keys, weights, node = keys[has], weights[has], number
    return out


def _register(size, label, weight, target):
    """Of nodes with ``size`` arcs each: one node for each set of equal ones (those
    without arcs left out), and for every node its place there (-1: no arcs)."""
    node = np.flatnonzero(size)
    first = np.cumsum(size) - size
    place = np.arange(len(label)) - np.repeat(first, size)
    arc = mixed(label.astype(np.uint64) ^ (target.astype(np.uint64) << np.uint64(32)), 1) + mixed(weight, 2)
    arc = mixed(arc + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)
    sums = np.add.reduceat(arc, first[node]) if len(node) else np.zeros(0, np.uint64)
    _, kept, back = np.unique(sums, return_index=True, return_inverse=True)
    like = node[kept][back]
    same = size[like] == size[node]
    if not same.all():  # hashes that fall together: those nodes stay on their own
        like = np.where(same, like, node)
    own, other = _spread(first[node], size[node]), _spread(first[like], size[node])
    differs = (label[own] != label[other]) | (weight[own] != weight[other]) | (target[own] != target[other])
    if differs.any():
        apart = np.unique(np.repeat(np.arange(len(node)), size[node])[differs])
        like[apart] = node[apart]
    chosen, number = np.unique(like, return_inverse=True)
    of = np.full(len(size), -1, np.int64)
    of[node] = number
    return chosen, of


def build(words: Sequence[bytes], levels: Levels) -> Transducer:
    """The transducer of some levels, minimal in each depth; words that do not occur are left out."""
    used = np.unique(np.concatenate([x[1] for x in levels])) if levels else np.zeros(0, np.int64)
    sizes, arcs = [np.zeros(1, np.int64)], []
    n_states = 1
    state = np.zeros(len(levels[-1][0]) if levels else 0, np.int64)
    for d in range(len(levels) - 1, -1, -1):
        parent, label, weight = levels[d]
        label = np.searchsorted(used, label)
        size = np.bincount(parent, minlength=len(levels[d - 1][0]) if d else 1)
        chosen, of = _register(size, label, weight, state)
        at = _spread((np.cumsum(size) - size)[chosen], size[chosen])
        sizes.append(size[chosen])
        arcs.append((label[at], weight[at], state[at]))
        state = np.where(of < 0, 0, n_states + of)
        n_states += len(chosen)
    join = lambda i: np.concatenate([x[i] for x in arcs]) if arcs else np.zeros(0, np.int64)
    return Transducer([words[i] for i in used.tolist()], np.concatenate(([0], np.cumsum(np.concatenate(sizes)))),
                      join(0), join(1), join(2))


def union(parts: list[Transducer], plus=np.add) -> tuple[list[bytes], Levels]:
    """Words and levels of all phrases of some transducers, equal phrases' weights
    added (or combined by another ``plus``)."""
    words = sorted(set().union(*(t.words for t in parts)))
    number = {w: i for i, w in enumerate(words)}
    firsts, labels, targets, at, states = [], [], [], 0, 0
    roots = []
    for t in parts:
        firsts.append(t.first[:-1] + at)
        labels.append(np.fromiter(map(number.__getitem__, t.words), np.int64, len(t.words))[t.label])
        targets.append(np.where(t.target, t.target + states, -1))
        at += len(t.label)
        states += len(t.first) - 1
        roots.append(states - 1)
    first = np.concatenate([*firsts, [at]])
    label, weight, target = map(np.concatenate, (labels, [t.weight for t in parts], targets))
    out: Levels = []
    node, state = np.zeros(len(parts), np.int64), np.array(roots, np.int64)
    while True:
        size = first[state + 1] - first[state]
        arc = _spread(first[state], size)
        if not len(arc):
            return words, out
        key = np.repeat(node, size) << 32 | label[arc]
        order = np.argsort(key, kind="stable")
        key, arc = key[order], arc[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        out.append((key[new] >> 32, key[new] & _LOW, plus.reduceat(weight[arc], np.flatnonzero(new))))
        node, state = np.cumsum(new) - 1, target[arc]
        node, state = node[state >= 0], state[state >= 0]


def pruned(levels: Levels, least: int) -> Levels:
    """Only phrases of a weight of ``least`` or more, and the prefixes of such."""
    out: Levels = []
    below = np.zeros(0, bool)
    keeps = []
    for parent, label, weight in reversed(levels):
        keep = weight >= least
        if keeps:
            keep[np.unique(child_parent[below])] = True
        keeps.append(keep)
        below, child_parent = keep, parent
    number = None
    for (parent, label, weight), keep in zip(levels, reversed(keeps)):
        if not keep.any():
            break
        out.append((parent[keep] if number is None else number[parent[keep]], label[keep], weight[keep]))
        number = np.cumsum(keep) - 1
    return out


def compose(words: list[bytes], levels: Levels, t: Transducer) -> Levels:
    """The levels with the weights that ``t`` gives their phrases (0: not in ``t``)."""
    number = {w: i for i, w in enumerate(t.words)}
    own = np.array([number.get(w, -1) for w in words], np.int64)
    keys = np.repeat(np.arange(len(t.first) - 1), np.diff(t.first)) << 32 | t.label
    out: Levels = []
    state = np.array([len(t.first) - 2], np.int64)
    for parent, label, _ in levels:
        at, to = state[parent], own[label]
        key = at << 32 | to
        arc = np.searchsorted(keys, key)
        arc[arc == len(keys)] = 0
        hit = (to >= 0) & (at > 0) & (keys[arc] == key if len(keys) else False)
        out.append((parent, label, np.where(hit, t.weight[arc] if len(keys) else 0, 0)))
        state = np.where(hit, t.target[arc] if len(keys) else 0, 0)
    return out


def cuts(words: list[bytes], keys: np.ndarray, bounds: Sequence[Sequence[bytes]], bits: int, depth: int) -> np.ndarray:
    """Where the sorted packed phrases reach each of the sorted bounds (tuples of words)."""
    values = []
    for bound in bounds:
        value = 0
        for d, w in enumerate(bound[:depth]):
            i = bisect_left(words, w)
            value |= (i + 1) << (bits * (depth - 1 - d))
            if i == len(words) or words[i] != w:
                break
        else:  # a phrase of ``depth`` words comes before a bound that goes on after it
            value += len(bound) > depth
        values.append(min(value, (1 << 63) - 1))
    return np.searchsorted(keys, np.array(values, np.int64))
