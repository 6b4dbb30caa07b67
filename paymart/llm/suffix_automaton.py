"""A suffix automaton over word sequences, with occurrence counts."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """Recognises every run of words that occurs in its reference sequences.

    Each state stands for a set of runs with the same end positions; ``count``
    is the number of those positions over all sequences (a sequence given with
    ``times`` counts that often).
    """

    def __init__(self, sequences: Iterable[tuple[Sequence[Hashable], int]]):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]
        for words, times in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word, times)
        # a state's end positions are those of its own and of all longer
        # states that link to it
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def _new(self, moves: dict, link: int, length: int, count: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(count)
        return len(self.link) - 1

    def _split(self, state: int, word: Hashable, target: int) -> int:
        """A copy of ``target`` for the runs that are one longer than ``state``."""
        copy = self._new(dict(self.next[target]), self.link[target], self.length[state] + 1, 0)
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def _extend(self, last: int, word: Hashable, times: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # the run is known from an earlier sequence
            if self.length[target] != self.length[last] + 1:
                target = self._split(last, word, target)
            self.count[target] += times
            return target
        new = self._new({}, 0, self.length[last] + 1, times)
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][word]
            if self.length[target] != self.length[state] + 1:
                target = self._split(state, word, target)
            self.link[new] = target
        return new

    def repeated(self, words: Sequence[Hashable], width: int) -> list[int]:
        """Starts of the ``width``-word windows of ``words`` that occur at least
        twice in the reference. Matching statistics: after each word, the state
        of the longest run that ends here and occurs in the reference, cut to
        the state that holds its last ``width`` words."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        found, state, matched = [], 0, 0
        for at, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            target = nxt[state].get(word)
            if target is None:
                continue
            state, matched = target, matched + 1
            while length[link[state]] >= width:
                state = link[state]
                matched = length[state]
            if matched >= width and count[state] > 1:
                found.append(at - width + 1)
        return found
