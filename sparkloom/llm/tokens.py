"""Vocabulary files, and the splitting of texts into pre-tokens as their library does it."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterable

from tokenizers import Tokenizer

from sparkloom.llm.common import BoundedMemory, kept

# Letters, numbers and white space among the first 256 code points.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼½¾"
SPACES = "\t-\r \x85\xa0"
TAILS = "'s|'t|'re|'ve|'m|'ll|'d"
# First characters of the alternatives differ, but for the apostrophe; so words, the most frequent, may come first.
SPACED_WORDS = re.compile(f" ?[{LETTERS}]+| ?[{NUMBERS}]+|{TAILS}| ?[^{LETTERS}{NUMBERS}{SPACES}]+"
                          f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
PLAIN_WORDS = re.compile(f"[{LETTERS}]+|[{NUMBERS}]|{TAILS}|[^{LETTERS}{NUMBERS}{SPACES}]+")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A byte-level BPE file: its tokens, merge ranks, special strings and the way it splits texts.

    Texts within the first 256 code points are split by patterns over those code points, any other text by
    the library's own normaliser and splitter.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.library = Tokenizer.from_file(path)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.lowered = content["normalizer"] is not None
        if self.lowered != bool(self.suffix) or content["pre_tokenizer"]["type"] not in ("ByteLevel", "Sequence"):
            raise ValueError(f"{path}: neither a spaced byte-level vocabulary nor a lower-case one with word ends")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, number in [*ids.items(), *self.special.items()]:
            self.tokens[number] = token
        self.letters = byte_letters()
        self.byte_of = {letter: b for b, letter in enumerate(self.letters)}
        self.first = [ids[letter] for letter in self.letters]
        self.last = [ids[letter + self.suffix] for letter in self.letters]
        self.span = len(self.tokens)
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in
                  (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        self.rank = {a * self.span + b: k for k, (a, b, _) in enumerate(merges)}
        self.merged = [whole for _, _, whole in merges]
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._words = PLAIN_WORDS if self.lowered else SPACED_WORDS

    def symbols(self, word: bytes) -> list[int]:
        """Identifiers of the single bytes of a pre-token; the last one carries the word end, if there is one."""
        out = [self.first[b] for b in word]
        if self.suffix:
            out[-1] = self.last[word[-1]]
        return out

    def pieces(self, text: str) -> Iterable[tuple[int | None, list[str]]]:
        """Special identifiers of the text, and between them the lists of its pre-tokens."""
        if self._cut and "<|" in text:
            for part in self._cut.split(text):
                if part in self.special:
                    yield self.special[part], []
                elif part:
                    yield None, self.words(part)
        elif text:
            yield None, self.words(text)

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.lowered:
                text = self.library.normalizer.normalize_str(text)
            byte_of = self.byte_of
            return [bytes(byte_of[c] for c in word).decode("utf-8", "surrogateescape")
                    for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self._words.findall(text.lower() if self.lowered else text)


def word_bytes(word: str) -> bytes:
    return word.encode("utf-8", "surrogateescape")


MEMORY = 96 << 20  # bytes of pre-tokens that a process remembers


def packed_words(encode: Callable[[bytes], list[int]]) -> BoundedMemory:
    """Pre-token to its identifiers as little-endian unsigned 32-bit integers."""
    def packed(word: str) -> bytes:
        ids = encode(word_bytes(word))
        return struct.pack(f"<{len(ids)}I", *ids)

    return BoundedMemory(packed, MEMORY)


def packed_ids(vocabulary: Vocabulary, words: BoundedMemory, text: str) -> bytes:
    """All identifiers of a text, packed."""
    out = [struct.pack("<I", special) if special is not None else b"".join(map(words.__getitem__, found))
           for special, found in vocabulary.pieces(text)]
    return out[0] if len(out) == 1 else b"".join(out)


def vocabulary_at(path: str) -> Vocabulary:
    """The vocabulary of a file, read once in a Python process while it works with that file."""
    return kept(f"tokens of {path}", "vocabulary", lambda: Vocabulary(path))


def library_words(path: str) -> BoundedMemory:
    """Pre-token memory that asks a public BPE library; for operators whose method is not the merging."""
    return kept(f"tokens of {path}", "library words", lambda: _library_words(vocabulary_at(path)))


def _library_words(vocabulary: Vocabulary) -> BoundedMemory:
    import tiktoken

    if vocabulary.suffix:
        raise ValueError("only vocabularies without word ends")
    special = set(vocabulary.special.values())
    ranks = {bytes(vocabulary.byte_of[c] for c in token): number for number, token in enumerate(vocabulary.tokens)
             if number not in special}
    library = tiktoken.Encoding("own", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    # The whole of a piece is encoded, whatever pattern splits texts; the public way for it is private in some releases.
    single = getattr(getattr(library, "_core_bpe", None), "encode_single_piece", None)
    return packed_words(single or (lambda word: library._encode_single_piece(word)))
