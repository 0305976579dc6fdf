"""Suffix automaton over words with the smallest document of each state."""

from __future__ import annotations


class SuffixAutomaton:
    """Generalised suffix automaton of several word sequences.

    ``first`` of a state is the smallest document that any string of the state occurs in.
    Sequences must be added in ascending order of their document, so a state's first
    document is known when the state is made, and inherited by clones.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [-1]

    def _state(self, follow: dict[int, int], link: int, length: int, first: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        clone = self._state(dict(self.next[target]), self.link[target], self.length[state] + 1, self.first[target])
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def add(self, words: list[int], document: int) -> None:
        last = 0
        for word in words:
            target = self.next[last].get(word)
            if target is not None:
                last = target if self.length[target] == self.length[last] + 1 else self._split(last, target, word)
                continue
            new = self._state({}, 0, self.length[last] + 1, document)
            state = last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                target = self.next[state][word]
                ok = self.length[target] == self.length[state] + 1
                self.link[new] = target if ok else self._split(state, target, word)
            last = new

    def firsts(self, words: list[int], window: int) -> list[int]:
        """For each window of ``words``, the smallest document it occurs in (-1: none).

        Streams the words once and keeps the matching statistic: the longest suffix of what
        has been read that the automaton knows. Where it reaches the window's length, the
        state of the last ``window`` words tells the document.
        """
        follow, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        out = []
        for read, word in enumerate(words, 1):
            while state and word not in follow[state]:
                state = link[state]
                matched = length[state]
            target = follow[state].get(word)
            if target is not None:
                state, matched = target, matched + 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
            if read >= window:
                out.append(first[state] if matched >= window else -1)
        return out
