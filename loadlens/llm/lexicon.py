"""A trie of terms, searched with Levenshtein automata that are made deterministic as words need it."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

#: Characters that stand for letters at no cost. Fixed values.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: Places of terms that the states of a task hold together; about a hundred bytes each.
MOST_PLACES = 300_000


class Term(NamedTuple):
    text: str
    stem: bool  # any ending may follow
    edits: int
    first: bool = False  # the first letter may be edited too


class Lexicon:
    """``match(word)`` gives the index of the closest term and the number of edits, or None.

    A state is a set of (trie node, edits so far, whether one was at the first letter): the
    Levenshtein automata of all terms running side by side on the trie, so a common beginning is
    walked once. Branches die when no term below a node allows so many edits. States and their
    transitions are kept, so a word costs a dictionary look-up a character, and are emptied when they
    hold ``MOST_PLACES`` places.
    """

    def __init__(self, terms: Iterable[Term]):
        self.terms = list(terms)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        # Most edits that a term below the node allows, and one whose first letter may be edited.
        self.allowed, self.loose = [-1], [-1]
        for k, term in enumerate(self.terms):
            node, loose = 0, term.edits if term.first else -1
            self.allowed[0] = max(self.allowed[0], term.edits)
            self.loose[0] = max(self.loose[0], loose)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.allowed.append(-1)
                    self.loose.append(-1)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], term.edits)
                self.loose[node] = max(self.loose[node], loose)
            self.ends[node].append(k)
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.places = 0
        self.start = self._closed([(0, 0, False)] if self.terms else [])

    def _closed(self, todo: list[tuple[int, int, bool]]) -> int:
        """The state of these and of what follows from them by leaving out letters of terms."""
        best: dict[tuple[int, bool], int] = {}
        while todo:
            node, e, first = todo.pop()
            if e <= (self.loose if first else self.allowed)[node] and e < best.get((node, first), 99):
                best[node, first] = e
                todo.extend((child, e + 1, first or not node) for child in self.children[node].values())
        key = frozenset(
            (node, e, first)
            for (node, first), e in best.items()
            if not first or e < best.get((node, False), 99)
        )
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.places += len(key) + 1
            self.sets.append(key)
            self.moves.append({})
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        same = {c, LOOKALIKES.get(c, c)}
        todo = []
        for node, e, first in self.sets[state]:
            edited = first or not node  # the root is where no letter of a term has been read
            for d, child in self.children[node].items():
                todo.append((child, e, first) if d in same else (child, e + 1, edited))
            todo.append((node, e + 1, edited))
        return self._closed(todo)

    def _accepted(self, state: int, stems: bool) -> list[tuple[int, int]]:
        return [
            (e, k)
            for node, e, first in self.sets[state]
            for k in self.ends[node]
            if e <= self.terms[k].edits
            and (self.terms[k].first or not first)
            and (self.terms[k].stem or not stems)
        ]

    def _walk(self, word: str) -> tuple[int, int] | None:
        state, found = self.start, []
        for c in word:
            after = self.moves[state].get(c)
            if after is None:
                after = self.moves[state][c] = self._step(state, c)
            state = after
            if not self.sets[state]:
                break
            found += self._accepted(state, stems=True)
        else:
            found += self._accepted(state, stems=False)
        if not found:
            return None
        e, k = min(found)
        return k, e

    def match(self, word: str) -> tuple[int, int] | None:
        if self.places > MOST_PLACES:
            self._forget()
        return self._walk(word)
