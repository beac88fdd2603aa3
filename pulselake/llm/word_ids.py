"""Ids of a word-level BPE vocabulary (lower case, white space dropped, word ends marked).

The text is normalised and split here and whole words are merged by the tokenizer's own model; a
bounded cache keeps the ids of words seen.  The result equals ``Tokenizer.encode`` without special
tokens (a test compares both over code points and the corpus).
"""

from __future__ import annotations

import re
import unicodedata
from array import array

import regex

from .bpe import SAFE_CUT, byte_alphabet
from .runtime import worker_cache

#: The word pattern of the vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: The same over lower-case ASCII.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 \t\n\v\f\r]+")
CHUNK_CHARS = 1 << 16


class WordIds(dict):
    """word -> ids as little-endian bytes; emptied when full."""

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.tokenizer, self.model, self.most = tokenizer, tokenizer.model, most
        self.narrow = tokenizer.get_vocab_size() <= 1 << 16
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        # characters younger than this Python's tables, where case or class may differ: left to the tokenizer
        letters = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
        self.young = frozenset(c for c in letters if unicodedata.category(c) == "Cn")
        self.to_byte_alphabet = {b: c for c, b in byte_alphabet().items()}

    def __missing__(self, word: str) -> bytes:
        plain = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.to_byte_alphabet)
        out = array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        out = []
        for k, part in enumerate(self.special_split.split(text or "") if self.special_split else [text or ""]):
            if k % 2:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            if not part.isascii() and not self.young.isdisjoint(part):
                out.append(array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes())
                continue
            # lower() alone would give a final sigma by context
            part = part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            words = ASCII_WORDS if part.isascii() else self.words
            at = 0
            while at < len(part):
                cut = SAFE_CUT.search(part, at + CHUNK_CHARS) if len(part) - at > 2 * CHUNK_CHARS else None
                end = cut.start() if cut else len(part)
                out.append(b"".join(map(self.__getitem__, words.findall(part, at, end))))
                at = end
        return b"".join(out)


def word_ids_of(path: str) -> WordIds:
    cache = worker_cache()
    if ("words", path) not in cache:
        cache["words", path] = WordIds(path)
    return cache["words", path]
