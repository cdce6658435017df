"""Encoding of texts chunk by chunk, with a bounded memory of chunks seen before.

Both tokenizers here never join characters across certain white space, so the
ids of a text are those of its chunks laid end to end. A worker keeps the ids
of short chunks; when it holds ``MOST`` it starts over. That changes the time
it takes, never the ids.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

MOST = 400_000
LONG = 64  # longer chunks are rare and large, and are not kept


class ChunkMemory:
    """``encode_all`` maps chunks to tuples; ``lookup`` does so for the chunks of one text."""

    def __init__(self, encode_all: Callable[[list[str]], Sequence[tuple]], most: int = MOST):
        self.encode_all, self.most = encode_all, most
        self.known: dict[str, tuple] = {}

    def learn(self, texts: Sequence[Sequence[str]]) -> Callable[[str], tuple]:
        """Encode what is new among the chunks of some texts; returns the lookup for them."""
        new = set().union(*texts) - self.known.keys()
        found = dict(zip(new, self.encode_all(list(new)))) if new else {}
        if len(self.known) + len(found) > self.most:
            self.known = {}
            missing = list(set().union(*texts) - found.keys())
            found |= dict(zip(missing, self.encode_all(missing)))
        self.known.update((k, v) for k, v in found.items() if len(k) <= LONG)
        if len(found) and any(len(k) > LONG for k in found):
            known = self.known
            return lambda k: known[k] if k in known else found[k]
        return self.known.__getitem__


def flat(look: Callable[[str], tuple], chunks: Sequence[str]) -> np.ndarray:
    """The tuples of all chunks as one ``int32`` array."""
    return np.fromiter(chain.from_iterable(map(look, chunks)), np.int32)


def pieces(texts: Sequence, most_chars: int = 1 << 20):
    """Ranges of ``texts`` of bounded length in characters; a longer text stands alone."""
    begin = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > begin and size + n > most_chars:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)
