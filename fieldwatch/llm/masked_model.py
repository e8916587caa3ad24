"""A bidirectional window network over word classes, in numpy.

Every word falls into one of ``CLASSES * MEMBERS`` buckets by a hash. A bucket is
predicted from the words on both sides of it, never from itself: the neighbours'
vectors add up to a hidden layer, which gives the class, and within the class the
member. Both are normalised, so a document's log-probabilities can be summed. What
part of a bucket a word makes up is not the network's matter.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields
from zlib import crc32

import numpy as np

from fieldwatch.llm.words import words_of

CLASSES = 32
MEMBERS = 32
BUCKETS = CLASSES * MEMBERS
SIDE = 2
WIDTH = 16
LEARNING_RATE = 0.3
BATCH = 4096
#: Logits are kept within this, where they could leave it.
LARGEST = 80.0
#: Words scored at once.
SCORED = 1 << 14


def bucket_of(word: bytes) -> int:
    return crc32(word) % BUCKETS


class Buckets(dict):
    """Bucket of each word, found once."""

    def __missing__(self, word: bytes) -> int:
        bucket = bucket_of(word)
        if len(self) < 500_000:
            self[word] = bucket
        return bucket


def buckets_of(text: bytes | None, known: Buckets) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def contexts(buckets: np.ndarray) -> np.ndarray:
    """Buckets of the ``SIDE`` words on both sides of every word; beyond the ends a bucket of its own."""
    padded = np.concatenate([np.full(SIDE, BUCKETS), buckets, np.full(SIDE, BUCKETS)])
    n = len(buckets)
    return np.stack([padded[i : i + n] for i in range(2 * SIDE + 1) if i != SIDE], axis=1)


@dataclass
class Network:
    """All weights; ``vectors`` has one table for each place around the word."""

    vectors: np.ndarray
    hidden_bias: np.ndarray
    class_weights: np.ndarray
    class_bias: np.ndarray
    member_weights: np.ndarray
    member_bias: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 1) -> "Network":
        """Small random vectors; the biases are the frequencies of the buckets."""
        rng = np.random.default_rng(seed)
        shares = (counts.reshape(CLASSES, MEMBERS) + 1.0) / (counts.sum() + BUCKETS)
        by_class = shares.sum(axis=1)
        arrays = (
            rng.normal(0, 0.1, (2 * SIDE, BUCKETS + 1, WIDTH)),
            np.zeros(WIDTH),
            np.zeros((WIDTH, CLASSES)),
            np.log(by_class),
            np.zeros((CLASSES, WIDTH, MEMBERS)),
            np.log(shares / by_class[:, None]),
        )
        return cls(*(array.astype(np.float32) for array in arrays))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, field.name).ravel() for field in fields(self)])

    @classmethod
    def of(cls, flat: np.ndarray) -> "Network":
        made, place = [], 0
        for like in fields(cls):
            shape = getattr(_SHAPES, like.name).shape
            size = int(np.prod(shape))
            made.append(flat[place : place + size].reshape(shape).astype(np.float32))
            place += size
        return cls(*made)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.hidden_bias + self.vectors[0].take(around[:, 0], axis=0)
        for place in range(1, 2 * SIDE):
            total += self.vectors[place].take(around[:, place], axis=0)
        return np.tanh(total)

    def log_probabilities(self, buckets: np.ndarray, around: np.ndarray | None = None) -> np.ndarray:
        """Of every word, given the words around it."""
        around = contexts(buckets) if around is None else around
        result = np.empty(len(buckets))
        for start in range(0, len(buckets), SCORED):
            part = slice(start, start + SCORED)
            result[part] = self.conditional(buckets[part], around[part])
        return result

    def scores(self, texts: Iterable[np.ndarray]) -> Iterator[float]:
        """Sum of log-probabilities of each text; short texts are taken many at a time."""
        waiting: list[np.ndarray] = []
        pending = 0

        def scored() -> Iterator[float]:
            around = np.concatenate([contexts(buckets) for buckets in waiting])
            each = self.log_probabilities(np.concatenate(waiting), around)
            ends = np.cumsum([len(buckets) for buckets in waiting])
            for buckets, end in zip(waiting, ends, strict=True):
                yield float(each[end - len(buckets) : end].sum())
            waiting.clear()

        for buckets in texts:
            waiting.append(buckets)
            pending += len(buckets)
            if pending >= SCORED:
                yield from scored()
                pending = 0
        if waiting:
            yield from scored()

    def conditional(self, buckets: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Logarithm of the class's probability plus that of the member within the class."""
        hidden = self.hidden(around)
        group, member = np.divmod(buckets, MEMBERS)
        total = chosen_log(self.class_weights, self.class_bias, hidden.T, group)
        order = np.argsort(group.astype(np.uint8), kind="stable")
        sorted_hidden, sorted_member = hidden.take(order, axis=0).T, member[order]
        within = np.empty(len(buckets), dtype=np.float32)
        ends = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
        for number, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if end > start:
                within[start:end] = chosen_log(
                    self.member_weights[number],
                    self.member_bias[number],
                    sorted_hidden[:, start:end],
                    sorted_member[start:end],
                )
        total[order] += within
        return total

    def learn(self, buckets: np.ndarray, around: np.ndarray, rate: float = LEARNING_RATE) -> None:
        """One step of gradient descent on the words' negative log-probability."""
        size = len(buckets)
        order = np.argsort((buckets // MEMBERS).astype(np.uint8), kind="stable")
        around = around.take(order, axis=0)
        group, member = np.divmod(buckets[order], MEMBERS)
        hidden = np.ascontiguousarray(self.hidden(around).T)
        rows = np.arange(size)
        error = probabilities(self.class_weights, self.class_bias, hidden)
        error[group, rows] -= 1
        back = self.class_weights @ error
        self.class_weights -= rate / size * (hidden @ error.T)
        self.class_bias -= rate / size * error.sum(axis=1)
        ends = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
        for number, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if end == start:
                continue
            mine = hidden[:, start:end]
            weights = self.member_weights[number]
            wrong = probabilities(weights, self.member_bias[number], mine)
            wrong[member[start:end], rows[: end - start]] -= 1
            back[:, start:end] += weights @ wrong
            # A class is seen in its share of the rows only: its own mean makes up for it.
            step = rate / max(end - start, size // CLASSES)
            weights -= step * (mine @ wrong.T)
            self.member_bias[number] -= step * wrong.sum(axis=1)
        back *= 1 - hidden**2
        self.hidden_bias -= rate / size * back.sum(axis=1)
        back *= rate / np.sqrt(size)
        back = np.ascontiguousarray(back.T)
        for place in range(2 * SIDE):
            beside = around[:, place].astype(np.uint16)
            order = np.argsort(beside, kind="stable")
            beside = beside[order]
            starts = np.flatnonzero(np.diff(beside, prepend=-1))
            self.vectors[place][beside[starts]] -= np.add.reduceat(back.take(order, axis=0), starts, axis=0)


def chosen_log(weights: np.ndarray, bias: np.ndarray, hidden: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-probability of one output for each column of ``hidden``."""
    logits = weights.T @ hidden
    logits += bias[:, None]
    # Hidden values lie within 1: only large weights could exceed what the exponential can take.
    if np.abs(weights).sum(axis=0).max() + np.abs(bias).max() > LARGEST:
        np.clip(logits, -LARGEST, LARGEST, out=logits)
    return logits[chosen, np.arange(len(chosen))] - np.log(np.exp(logits).sum(axis=0))


def probabilities(weights: np.ndarray, bias: np.ndarray, hidden: np.ndarray) -> np.ndarray:
    """Of all outputs, for each column of ``hidden``."""
    logits = weights.T @ hidden
    logits += bias[:, None]
    if np.abs(weights).sum(axis=0).max() + np.abs(bias).max() > LARGEST:
        logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def train(network: Network, texts: Iterable[np.ndarray], every: int, first: int) -> int:
    """Learn from every ``every``-th word of all texts, in batches; returns how many there were.

    Texts are given as the buckets of their words.
    """
    waiting, pending, seen = [], 0, 0
    phase = first

    def step() -> int:
        words, around = (np.concatenate(part) for part in zip(*waiting, strict=True))
        for start in range(0, len(words), BATCH):
            network.learn(words[start : start + BATCH], around[start : start + BATCH])
        waiting.clear()
        return len(words)

    for buckets in texts:
        chosen = np.arange(phase, len(buckets), every)
        # The next text goes on where this one ends, so short texts are seen alike.
        phase = (phase - len(buckets)) % every
        if not len(chosen):
            continue
        waiting.append((buckets[chosen], contexts(buckets)[chosen]))
        pending += len(chosen)
        if pending >= BATCH:
            seen += step()
            pending = 0
    return seen + (step() if waiting else 0)


_SHAPES = Network.start(np.zeros(BUCKETS))
