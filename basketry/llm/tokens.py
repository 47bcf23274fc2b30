"""Token ids of whole texts, word by word.

The tokenizer is read from a path and never trained.  Splitting at ASCII white space does not
change the ids (the tokenizer drops white space, and no token spans it), so each Python worker
keeps the ids of the words it met in two generations of bounded size: frequent words stay, rare
ones are encoded again.

Most new words are lower-case Latin letters, with a full stop or comma at the end.  For these the
tokenizer's normaliser and pre-tokenizer have nothing to do but part the two, so the letters go
to its BPE model directly; all other words go through the whole tokenizer.
"""

from __future__ import annotations

import os
import struct
import unicodedata

END_ID = 2
CACHE_WORDS = 500_000
# Fixed by byte-level BPE: printable bytes stand for themselves, the others for the characters
# from 256 on, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_LATIN_END = "\u0250"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Generation(dict):
    """What a function gave for the keys asked so far; a new key asks the older generation first."""

    def __init__(self, find, older: dict | None = None):
        super().__init__()
        self.find, self.older = find, older or {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        self[key] = value
        return value

    def succeeded(self, limit: int) -> Generation:
        """This generation, or a new one whose elder it is once it holds ``limit`` keys."""
        if len(self) <= limit:
            return self
        self.older = {}
        return Generation(self.find, self)


class WordTokenizer:
    """Ids of words as little-endian 32-bit bytes."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.cache_words = cache_words
        self.ids = Generation(self._encode_word)

    def encode(self, body: bytes) -> bytes:
        """Ids of a text."""
        # The tokenizer lower-cases, but finds its special tokens, ``<|...|>``, before it does.
        words = (body if b"<|" in body else body.lower()).split()
        out = b"".join(map(self.ids.__getitem__, words))
        self.ids = self.ids.succeeded(self.cache_words)
        return out

    def _encode_word(self, word: bytes) -> bytes:
        core = word.rstrip(b".,")
        text = core.decode("utf-8", "replace")
        if not (text.isalpha() and (text.isascii() or max(text) < _LATIN_END
                                    and unicodedata.is_normalized("NFC", text))
                and text == text.lower()):
            found = self.tokenizer.encode(word.decode("utf-8", "replace"),
                                          add_special_tokens=False)
            return _packed(found.ids)
        if len(core) < len(word):
            return self.ids[core] + self.ids[word[len(core):]]
        letters = text if text.isascii() else core.decode("latin-1").translate(BYTE_CHARACTERS)
        return _packed([t.id for t in self.model.tokenize(letters)])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_LOADED: dict[str, WordTokenizer] = {}


def worker_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
