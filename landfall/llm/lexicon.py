"""Misspelt terms of a weighted lexicon: Levenshtein automata intersected with the lexicon's trie.

The automaton of a word accepts what is within a few edits of it. Instead of one automaton for each word of a text, the trie of
all terms is read once with errors: a state is the set of trie nodes that can be reached, each with the fewest edits so
far, and states and their transitions are kept as they are met. So a text's word costs a look-up for each letter,
and most words lead to the empty state after a few.
"""

from __future__ import annotations

from dataclasses import dataclass, field

STATES = 50_000  # kept states; beyond it the automaton starts anew
REMEMBERED = 300_000  # words whose match is kept
LONGEST = 32  # letters of a term


def edits(term: str) -> int:
    """Edits at which a word is still taken for a misspelt term."""
    return 0 if len(term) < 4 else 1 if len(term) < 7 else 2


@dataclass(frozen=True)
class Lexicon:
    """`weights`: term -> chance that a word is meant ill, at 0, 1, 2 edits. `ordinary`: words near a term that are not."""

    weights: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    ordinary: frozenset[str] = frozenset()
    least: float = 0.0


@dataclass(frozen=True)
class Match:
    term: str
    distance: int
    weight: float


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.limit = [0]
        for term in sorted(lexicon.weights):
            node = 0
            for letter in term:
                self.limit[node] = max(self.limit[node], edits(term))
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.limit.append(0)
                node = self.children[node][letter]
            self.limit[node] = max(self.limit[node], edits(term))
            self.term[node] = term
        self.alphabet = frozenset("".join(lexicon.weights))
        self.known: dict[str, Match | None] = {}
        self._restart()

    def _restart(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.dead = self._number(frozenset())
        self.start = self._number(self._closed({0: 0}))

    def _number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return self.numbers[state]

    def _closed(self, reached: dict[int, int]) -> frozenset:
        """With the nodes that leaving out letters of a term leads to, without those of too many edits."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            more = reached[node] + 1
            for child in self.children[node].values():
                if more <= self.limit[child] and more < reached.get(child, 99):
                    reached[child] = more
                    todo.append(child)
        return frozenset((node, n) for node, n in reached.items() if n <= self.limit[node])

    def _move(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, n in self.states[state]:
            reached[node] = min(n + 1, reached.get(node, 99))
            for of_edge, child in self.children[node].items():
                reached[child] = min(n + (of_edge != letter), reached.get(child, 99))
        number = self._number(self._closed({node: n for node, n in reached.items() if n <= self.limit[node]}))
        self.moves[state][letter] = number
        return number

    def near(self, word: str) -> list[tuple[str, int]]:
        """Terms within their edits of the word, with the number of edits."""
        if len(self.states) > STATES:
            self._restart()
        state = self.start
        for letter in word:
            if letter not in self.alphabet:
                letter = ""
            following = self.moves[state].get(letter)
            state = self._move(state, letter) if following is None else following
            if state == self.dead:
                return []
        return [(self.term[node], n) for node, n in self.states[state] if self.term[node] is not None and n <= edits(self.term[node])]

    def match(self, word: str) -> Match | None:
        """The term that the word stands for: fewest edits, then largest weight; None for ordinary words and unlikely ones."""
        if word in self.lexicon.ordinary:
            return None
        found = [Match(term, n, self.lexicon.weights[term][n]) for term, n in self.near(word)]
        best = min(found, key=lambda m: (m.distance, -m.weight, m.term), default=None)
        return best if best and best.weight >= self.lexicon.least else None

    def matches(self, words: set[str]) -> dict[str, Match]:
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, words
        for word in new:
            self.known[word] = self.match(word) if len(word) <= LONGEST + 2 else None
        return {word: found for word in words if (found := self.known[word]) is not None}

