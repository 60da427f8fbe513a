"""Token ids of whole texts, with a task-wide memory of words.

The vocabulary's normaliser and pre-tokeniser never look across ASCII white space, so the ids of a text are those of
its words one after the other. Case of A-Z does not matter to it, and it cuts closing punctuation off the letter before it; so words are
remembered without the marks that follow them. Apostrophes and the signs of special tokens stay where they are.
A word of lower-case ASCII letters passes normaliser and pre-tokeniser as it is and goes to the model at once. Other words
not yet known are encoded together in one call and told apart by the closing ids or by their offsets. This holds
for vocabularies of that kind, which `word_bpe_49k.json` is; the tests compare it with the encoding of whole texts.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from touchline.llm.text import ragged

KNOWN_WORDS = 800_000
JOINED_WORDS = 2_000
_MARKS = rb"[.,;:!?#$%&*+=@~()\[\]{}\"/-]"
_CLOSING = re.compile(rb"%b(?<=[a-z]%b)%b*+(?=\s|\Z)" % (_MARKS, _MARKS, _MARKS))
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str | None) -> list[bytes]:
    """Words that are encoded one by one; texts that may hold special tokens keep their case."""
    if not text:
        return []
    raw = text.encode()
    return _CLOSING.sub(rb" \g<0>", raw if b"<|" in raw else raw.translate(_LOWER)).split()


class _Numbered(dict):
    """Numbers words in the order of their first lookup."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at


class WordEncoder:
    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary())
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.word_end = np.zeros(max(vocab.values()) + 1, bool)
        self.word_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.index = _Numbered()
        self.first = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _learn(self, new: list[bytes]) -> None:
        """Encodes the words that were numbered last."""
        base = len(self.index) - len(new)
        while len(self.index) > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        said = [w.decode() for w in new]
        letters = np.fromiter((w.isalpha() and w.islower() for w in new), bool, len(new))
        at = np.flatnonzero(letters)
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(said[i])] for i in at.tolist()]
        self._keep(base + at, np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))
        plain = np.fromiter(map(str.isalpha, said), bool, len(said))
        for one_piece in (True, False):
            places = np.flatnonzero((plain == one_piece) & ~letters)
            for lo in range(0, len(places), JOINED_WORDS):
                at = places[lo:lo + JOINED_WORDS]
                text = [said[i] for i in at.tolist()]
                self._keep(base + at, *self._told_apart(text, one_piece))

    def _told_apart(self, text: list[str], one_piece: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words and how many each has. Every word gives one closing id at least; with as many as words, each has one."""
        joined = "\n".join(text)
        if one_piece:
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.word_end[ids])
            if len(ends) == len(text):
                return ids, np.diff(ends, prepend=-1)
        got = self.tokenizer.encode(joined, add_special_tokens=False)
        starts = np.cumsum([0, *(len(w) + 1 for w in text[:-1])])
        at = np.searchsorted(starts, np.array([a for a, _ in got.offsets], np.int64), side="right") - 1
        return np.array(got.ids, np.uint32), np.bincount(at, minlength=len(text))

    def _keep(self, places: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.first[places] = self.used + np.cumsum(count) - count
        self.count[places] = count
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def encode(self, texts: list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row (uint32), `end_id` after each text if given, and the number of ids of each text."""
        if len(self.index) > KNOWN_WORDS:
            self._clear()
        split = [pieces(t) for t in texts]
        flat = list(chain.from_iterable(split))
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        if self.index.new:
            self._learn(self.index.new)
            self.index.new = []
        per_word = self.count[at]
        ids = self.ids[ragged(self.first[at], per_word)]
        ends = np.concatenate([[0], np.cumsum(per_word)])[np.cumsum([len(ws) for ws in split])]
        n = np.diff(ends, prepend=0)
        if end_id is None:
            return ids, n
        return np.insert(ids, ends, np.uint32(end_id)), n + 1
