"""Probabilistic automata inferred from examples by merging prefix-tree states.

Strings are read as character classes. The prefix tree of the examples counts how
often each state is entered, left by each class, and ended in. States whose counts
are compatible by Hoeffding's bound, and whose successors are too, are merged: first
those of the same depth, so that counts of a format are not spread over all its strings
before its lengths are tested, then any. The result is a deterministic automaton with
a probability for every string.
"""

from dataclasses import dataclass
from math import log, sqrt

#: Probability of a step that the examples never take.
UNSEEN = 1e-4
ALPHA = 0.05


def classes(text: str) -> str:
    """One letter per character: digits, letters in and beyond hexadecimal, others as they are."""
    return text.translate(CLASSES)


CLASSES = str.maketrans(
    {
        **dict.fromkeys("0123456789", "d"),
        **dict.fromkeys("abcdef", "x"),
        **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"),
        **dict.fromkeys("ABCDEF", "X"),
        **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "U"),
    }
)


@dataclass
class Automaton:
    """Steps and ends of each state as logarithms of probabilities; state 0 is the start."""

    steps: list[dict[str, tuple[int, float]]]
    ends: list[float]

    def log_probability(self, symbols: str) -> float:
        """Of a string of classes; a step that no example takes goes back to the start."""
        state, total = 0, 0.0
        for symbol in symbols:
            state, more = self.steps[state].get(symbol, (0, log(UNSEEN)))
            total += more
        return total + self.ends[state]

    def shortest(self) -> int:
        """Symbols in the shortest string that takes only steps and an end that examples take."""
        reached, states, length = {0}, [0], 0
        while states and not any(self.ends[state] > log(UNSEEN) for state in states):
            states = list({to for state in states for to, _ in self.steps[state].values()} - reached)
            reached.update(states)
            length += 1
        return length


def different(n: int, f: int, m: int, g: int, alpha: float) -> bool:
    """Hoeffding's test of two frequencies, f of n and g of m."""
    if not n or not m:
        return False
    return abs(f / n - g / m) > sqrt(0.5 * log(2 / alpha)) * (1 / sqrt(n) + 1 / sqrt(m))


class PrefixTree:
    """Counts of entries, ends and steps of states that can be merged."""

    def __init__(self, examples: list[str]) -> None:
        self.entered, self.ended = [0], [0]
        self.to: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        for example in examples:
            state = 0
            self.entered[0] += 1
            for symbol in example:
                if symbol not in self.to[state]:
                    self.to[state][symbol] = len(self.to)
                    self.entered.append(0)
                    self.ended.append(0)
                    self.to.append({})
                    self.count.append({})
                self.count[state][symbol] = self.count[state].get(symbol, 0) + 1
                state = self.to[state][symbol]
                self.entered[state] += 1
            self.ended[state] += 1
        self.merged = list(range(len(self.to)))

    def find(self, state: int) -> int:
        """The state that ``state`` has been merged into."""
        while self.merged[state] != state:
            self.merged[state] = self.merged[self.merged[state]]
            state = self.merged[state]
        return state

    def after(self, state: int) -> list[int]:
        """The next states, by symbol."""
        return [self.find(self.to[state][symbol]) for symbol in sorted(self.to[state])]

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """True if no test tells the two states apart, nor any two that the same steps lead to."""
        pairs, seen = [(self.find(a), self.find(b))], set()
        while pairs:
            pair = pairs.pop()
            a, b = pair
            if a == b or pair in seen:
                continue
            seen.add(pair)
            n, m = self.entered[a], self.entered[b]
            if different(n, self.ended[a], m, self.ended[b], alpha):
                return False
            for symbol in self.to[a].keys() | self.to[b].keys():
                if different(n, self.count[a].get(symbol, 0), m, self.count[b].get(symbol, 0), alpha):
                    return False
                if symbol in self.to[a] and symbol in self.to[b]:
                    pairs.append((self.find(self.to[a][symbol]), self.find(self.to[b][symbol])))
        return True

    def merge(self, a: int, b: int) -> None:
        """Make one state of two, and of all pairs of states that the same steps lead to."""
        pairs = [(a, b)]
        while pairs:
            a, b = sorted(map(self.find, pairs.pop()))
            if a == b:
                continue
            self.merged[b] = a
            self.entered[a] += self.entered[b]
            self.ended[a] += self.ended[b]
            for symbol, after in self.to[b].items():
                self.count[a][symbol] = self.count[a].get(symbol, 0) + self.count[b][symbol]
                if symbol in self.to[a]:
                    pairs.append((self.to[a][symbol], after))
                else:
                    self.to[a][symbol] = after

    def merge_depths(self, alpha: float) -> None:
        """Merge compatible states of the same depth, from the start down."""
        level = [0]
        while level:
            below: list[int] = []
            for state in dict.fromkeys(after for one in level for after in self.after(one)):
                like = next((old for old in below if self.compatible(old, state, alpha)), None)
                if like is None:
                    below.append(state)
                else:
                    self.merge(like, state)
            level = list(dict.fromkeys(map(self.find, below)))


def infer(examples: list[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of examples given as strings of classes. Examples must not be empty."""
    tree = PrefixTree(examples)
    tree.merge_depths(alpha)
    kept = [0]
    while True:
        known = set(kept)
        state = next((after for old in kept for after in tree.after(old) if after not in known), None)
        if state is None:
            break
        like = next((old for old in kept if tree.compatible(old, state, alpha)), None)
        if like is None:
            kept.append(state)
        else:
            tree.merge(like, state)
            kept = list(dict.fromkeys(map(tree.find, kept)))
    number = {state: i for i, state in enumerate(kept)}
    steps, ends = [], []
    for state in kept:
        total = tree.entered[state]
        steps.append(
            {
                symbol: (number[tree.find(after)], log(tree.count[state][symbol] / total))
                for symbol, after in tree.to[state].items()
            }
        )
        ends.append(log(max(tree.ended[state] / total, UNSEEN)))
    return Automaton(steps, ends)
