"""Byte-level BPE ids of whole texts through a word cache.

The vocabulary is a public tokenizer file of merge ranks; nothing is trained.  Strings of
its special tokens, which that file lacks, become their ids, and the text between
them is tokenised piece by piece, as the public tokenizer does.
The pre-tokenizer never joins text across a space but for the one that leads a
word, so a text without runs of white space at a space is the concatenation of
its words ``" w"``; each distinct word is encoded once per cache.  Other texts
are encoded whole.  The ids are those of the tokenizer in every case."""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import tiktoken

UNSAFE = re.compile(r" (?=\s|\Z)")
#: Fixed values of the public vocabulary: special tokens and their ids.
SPECIAL = {"<|endoftext|>": 50256}
CACHE_WORDS = 300_000


class Encoder:
    def __init__(self, ranks_path: str, pattern: str, cache_words: int = CACHE_WORDS):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ids = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.leads = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.leads[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.cache_words, self.words = cache_words, {}

        self.special = {t: i.to_bytes(4, "little") for t, i in SPECIAL.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, SPECIAL)) + ")")

    def whole(self, text: str) -> bytes:
        return np.array(self.ids(text), dtype="<u4").tobytes()

    def with_special(self, text: str) -> bytes:
        return b"".join(self.special[part] if part in self.special else self.whole(part) for part in self.cut.split(text) if part)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        plain = [None if UNSAFE.search(t) or self.cut.search(t) else t.split(" ") for t in texts]
        seen: set[str] = set()
        for p in plain:
            if p:
                seen.update(p[1:])
        new = [w for w in seen if w not in self.words]
        if len(self.words) + len(new) > self.cache_words:
            self.words, new = {}, list(seen)
        self._learn(new)
        get = self.words.__getitem__
        return [self.with_special(t) if p is None else self.whole(p[0]) + b"".join(map(get, p[1:]))
                for t, p in zip(texts, plain, strict=True)]

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 5000):
            some = words[at:at + 5000]
            ids = np.array(self.ids(" " + " ".join(some)), dtype="<u4")
            starts = np.flatnonzero(self.leads[ids])
            if len(starts) != len(some):  # some word holds a leading-space token of its own
                self.words.update((w, self.whole(" " + w)) for w in some)
                continue
            raw, ends = ids.tobytes(), [*(starts[1:] * 4).tolist(), len(ids) * 4]
            self.words.update((w, raw[a:b]) for w, a, b in zip(some, (starts * 4).tolist(), ends, strict=True))


@functools.lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder for each worker process, so its cache outlives a task."""
    return Encoder(ranks_path, pattern)
