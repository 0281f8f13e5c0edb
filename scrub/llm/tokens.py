"""Token ids of whole texts, by a public tokenizer that stays as it is."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np

from . import kernels as K

#: Different words that a task remembers. Beyond this it forgets all and starts anew.
REMEMBERED = 600_000
#: Words that the tokenizer gets in one call.
AT_ONCE = 4_000


#: A mark after a letter at the end of a word: the tokenizer begins a new token there. The mark comes first in the
#: pattern, as a search jumps to one of a set of characters, but tries what looks behind at every place.
MARK = re.compile(rb"[.,!?;:](?<=[a-zA-Z].)(?=[ \n]|$)")


class Encoder:
    """Encodes texts word by word and remembers the ids of words.

    Words are what ASCII white space separates. That gives the ids of the whole text for tokenizers
    that lower all letters, split at white space and between letters and marks, drop white space, and
    look at nothing across it, as ``word_bpe_49k`` does. So words are looked up in lower case, and a mark
    after the last letter of a word is a word of its own.
    """

    def __init__(self, path: str):
        # A task has one core; threads of its own would only take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        # The empty word stands for the end of a text.
        self.known: dict[bytes, int] = {b"": 0}
        self.sizes = np.ones(1 << 16, np.int32)
        self.starts = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 1

    def add(self, words: list[bytes], ids: list[list[int]]) -> None:
        at, n = len(self.known), len(words)
        sizes = np.fromiter(map(len, ids), np.int64, n)
        total = int(sizes.sum())
        while at + n > len(self.sizes):
            self.sizes, self.starts = (np.resize(x, 2 * len(x)) for x in (self.sizes, self.starts))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.sizes[at:at + n] = sizes
        self.starts[at:at + n] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.used += total
        self.known.update(zip(words, range(at, at + n)))

    def learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), AT_ONCE):
            part = words[at:at + AT_ONCE]
            found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
            self.add(part, [e.ids for e in found])

    def encode(self, texts: K.Texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end``, and where each text begins."""
        if len(self.known) > REMEMBERED:
            self.forget()
        self.ids[0] = end
        data = texts.data.tobytes()
        if b"<|" not in data:  # special tokens are known by their case
            data = data.lower()
        at = texts.offsets.tolist()
        words: list[bytes] = []
        counts = np.empty(len(texts), np.int64)
        for i, (a, b) in enumerate(zip(at, at[1:])):
            before = len(words)
            words += MARK.sub(rb" \g<0>", data[a:b]).split()
            words.append(b"")
            counts[i] = len(words) - before
        self.learn(list(set(words).difference(self.known)))
        found = itemgetter(*words, b"")(self.known)
        which = np.fromiter(found, np.int64, len(found))[:-1]
        sizes = self.sizes[which]
        before = np.append(0, np.cumsum(sizes))
        source = np.repeat(self.starts[which] - before[:-1], sizes)
        source += np.arange(len(source))
        return self.ids[source], before[np.append(0, np.cumsum(counts))]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, which serves all its tasks."""
    return Encoder(path)
