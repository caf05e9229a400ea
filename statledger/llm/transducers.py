"""Weighted transducers over the word classes of a clause, and their composition.

A mapper reads a class and writes one, with a factor for the weight of the word. A reader is the last in a chain: it keeps
one held weight, and each of its arcs moves weight from the word or from what is held to the clause's score. Composing a mapper
with a mapper gives a mapper, with a reader a reader, both with pairs of states, of which only those that can be
reached are made. All are deterministic, so a clause has one path.

Defined cases: no clauses, or clauses without words, score 0. A class without an arc of its own takes the arc of ``NONE``.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np

NONE, INSULT, THREAT, TARGET, NEGATION, REPORT = CLASSES = range(6)


class Write(NamedTuple):
    """Arc of a mapper."""

    to: Hashable
    out: int
    factor: float = 1.0


class Move(NamedTuple):
    """Arc of a reader: shares of the word's and of the held weight that score, are kept and are held."""

    to: Hashable
    emit: float = 0.0
    release: float = 0.0
    keep: float = 1.0
    hold: float = 0.0


@dataclass(frozen=True)
class Mapper:
    start: Hashable
    arc: Callable[[Hashable, int], Write]


@dataclass(frozen=True)
class Reader:
    start: Hashable
    arc: Callable[[Hashable, int], Move]
    final: Callable[[Hashable], float]  # share of what is held that scores at the clause's end


def compose(first: Mapper, then: Mapper | Reader) -> Mapper | Reader:
    """``then`` reading what ``first`` writes."""

    def arc(state, symbol):
        own = first.arc(state[0], symbol)
        other = then.arc(state[1], own.out)
        to = (own.to, other.to)
        if isinstance(then, Mapper):
            return Write(to, other.out, own.factor * other.factor)
        return other._replace(to=to, emit=own.factor * other.emit, hold=own.factor * other.hold)

    start = (first.start, then.start)
    if isinstance(then, Mapper):
        return Mapper(start, arc)
    return Reader(start, arc, lambda state: then.final(state[1]))


def _aged(age: int, near: int) -> int:
    """Words since something, 0 beyond ``near``."""
    return age + 1 if 0 < age < near else 0


def reported_speech(factor: float) -> Mapper:
    """After a word of reporting, what follows in the clause weighs ``factor``."""

    def arc(reported: bool, symbol: int) -> Write:
        if symbol == REPORT:
            return Write(True, NONE)
        return Write(reported, symbol, factor if reported else 1.0)

    return Mapper(False, arc)


def negation(factor: float, near: int) -> Mapper:
    """Up to ``near`` words after a negation weigh ``factor``."""

    def arc(age: int, symbol: int) -> Write:
        if symbol == NEGATION:
            return Write(1, NONE)
        return Write(_aged(age, near), symbol, factor if age else 1.0)

    return Mapper(0, arc)


def insults(aimed: float, bare: float, near: int) -> Reader:
    """Insults and targets at most ``near`` words from the next form chains; with a target in it a chain is aimed.

    States are (0, 0), (1, age) after an aimed word and (2, age) after a held insult.
    """

    def arc(state, symbol: int) -> Move:
        kind, age = state
        if symbol == INSULT:
            return Move((1, 1), emit=aimed) if kind == 1 else Move((2, 1), hold=1.0)
        if symbol == TARGET:
            return Move((1, 1), release=aimed, keep=0.0)
        older = _aged(age, near)
        if older:
            return Move((kind, older))
        return Move((0, 0), release=bare, keep=0.0)

    return Reader((0, 0), arc, lambda state: bare)


def threats(weight: float, near: int) -> Reader:
    """Threats, each near the next, count once a target follows the last of them within ``near`` words."""

    def arc(age: int, symbol: int) -> Move:
        if symbol == THREAT:
            return Move(1, hold=weight)
        if symbol == TARGET:
            return Move(0, release=1.0, keep=0.0)
        older = _aged(age, near)
        return Move(older, keep=1.0 if older else 0.0)

    return Reader(0, arc, lambda age: 0.0)


class Table:
    """A reader as arrays, run over many clauses at once."""

    def __init__(self, reader: Reader):
        numbers, found = {reader.start: 0}, [reader.start]
        arcs = []
        for state in found:  # grows while states are reached
            for symbol in CLASSES:
                move = reader.arc(state, symbol)
                if move.to not in numbers:
                    numbers[move.to] = len(found)
                    found.append(move.to)
                arcs.append((numbers[move.to], *move[1:]))
        self.states = len(found)
        self.to = np.array([a[0] for a in arcs])
        self.emit, self.release, self.keep, self.hold = np.array([a[1:] for a in arcs], float).T
        self.final = np.array([reader.final(s) for s in found], float)

    def run(self, symbols: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The score of each clause; clause k is the words ``first[k]`` to ``first[k + 1]``."""
        lengths = np.diff(first)
        order = np.argsort(-lengths, kind="stable")
        at, lengths = first[:-1][order], lengths[order]
        state = np.zeros(len(order), np.int64)
        score, held = np.zeros(len(order)), np.zeros(len(order))
        active = len(order)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            while lengths[active - 1] <= step:
                active -= 1
            word = at[:active] + step
            arc = state[:active] * len(CLASSES) + symbols[word]
            weight = weights[word]
            score[:active] += self.emit[arc] * weight + self.release[arc] * held[:active]
            held[:active] = self.keep[arc] * held[:active] + self.hold[arc] * weight
            state[:active] = self.to[arc]
        out = np.empty(len(order))
        out[order] = score + self.final[state] * held
        return out
