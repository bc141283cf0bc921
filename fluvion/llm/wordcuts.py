"""Cuts of texts where byte-level and piece tokenizers never join, so that the words between are encoded once and kept.

A text may be cut before a single space or newline with no blank on either
side: byte-level patterns let a word begin with one space and take a newline by
itself, and no piece of a vocabulary that ``cuts_safely`` goes on from another
character to a space, or holds a newline.

A word is named by its key: the word itself if a space precedes it, else the
bytes it stands for, which begin with a newline or a space.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable

DOUBLE, CUT = re.compile(r"\s\s"), re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Words of a generation that a worker keeps; longer words than this are not kept.
KEPT, LONG = 300_000, 64
#: Words of ASCII and their parts by the byte-level pattern; and letters of the Latin blocks before ASCII marks, which that pattern cuts from each other.
PLAIN, PARTS = re.compile(r"\n?[!-~]+"), re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\n")
NAME = re.compile("(\n?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\\[-`{-~]*)")
#: Bytes whose byte-level spelling is themselves; the others are spelt from U+0100 on, in order. Fixed values.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTED)}
#: What a tokenizer file has to say of its merges for parts of words to be merged by themselves. Fixed values.
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


#: Packers of few ids.
PACKERS = [struct.Struct(f"<{n}I").pack for n in range(24)]


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return PACKERS[len(ids)](*ids) if len(ids) < 24 else struct.pack(f"<{len(ids)}I", *ids)


def word_keys(text: str) -> list[str]:
    """Keys of a space and ``text``, in order."""
    if text and not text[0].isspace() and not text[-1].isspace() and not DOUBLE.search(text):
        return text.replace("\n", " \n").split(" ")
    first, *rest = CUT.split(text)
    return [first if first[:1].strip() else " " + first, *[c[1:] if c[0] == " " else c for c in rest]]


def spelt(key: str) -> str:
    """The characters that a key stands for."""
    return key if key[0] in " \n" else " " + key


def first_cut(text: str) -> tuple[str, list[str]]:
    """The start of ``text`` up to its first cut, and the keys after it."""
    if not text:
        return "", []
    keys = word_keys(text)
    return spelt(keys[0])[1:], keys[1:]


class Kept(dict):
    """What a function gave for the words of late: when one generation is full, words that come up again are taken over from it into the next."""

    def __init__(self, make: Callable, size: int | None = None):
        super().__init__()
        self.make, self.size, self.before = make, size or KEPT, {}

    def __missing__(self, key: str) -> object:
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > LONG:
                return found
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


class ByteWords:
    """Ids of words by a byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str, plain_specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter = spec.get("pre_tokenizer") or {}
        #: Whether the file cuts and merges as assumed: otherwise texts have to be encoded whole.
        self.cuts_safely = (
            spec.get("normalizer") is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space") and not spec.get("truncation") and not spec.get("padding")
            and all(spec["model"].get(k, v) == v for k, v in MODEL.items()) and all(not (t["lstrip"] or t["rstrip"] or t["normalized"]) and "<|" in t["content"] and not re.search(r"\s", t["content"]) for t in spec.get("added_tokens") or [])
        )
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.merge, self.parts, self.names = self.tokenizer.model.tokenize, Kept(self.part_ids), Kept(self.name_ids)
        self.part = self.parts.__getitem__

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian unsigned 32-bit integers."""
        return [packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def part_ids(self, spelling: str) -> bytes:
        """Ids of one pre-token: the byte alphabet and the merges are all that is left to do."""
        if not spelling.isalpha() or not spelling.isascii():
            spelling = spelling.encode().decode("latin-1").translate(BYTE_ALPHABET)
        return packed([t.id for t in self.merge(spelling)])

    def name_ids(self, letters: str) -> bytes:
        """Ids of a space and letters."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(BYTE_ALPHABET)
        return packed([t.id for t in self.merge("\u0120" + letters)])

    def encode_word(self, key: str) -> bytes:
        """Ids of a word, given by its key.

        Most new words are names: letters and then marks, each one pre-token,
        behind a space or a newline.
        """
        shape = NAME.fullmatch(key)
        if shape:
            head, letters, marks = shape.groups()
            ids = self.part(head) + self.part(letters) if head else self.names[letters]
            return ids + self.part(marks) if marks else ids
        if len(key) <= LONG and PLAIN.fullmatch(key) and "<|" not in key:
            return b"".join(map(self.part, PARTS.findall(spelt(key))))
        return self.encode([spelt(key)])[0]

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id."""
        letters = {chr(b): b for b in PRINTED} | {chr(c): b for b, c in BYTE_ALPHABET.items()}
        return [bytes(letters[c] for c in self.tokenizer.id_to_token(i)) for i in range(self.tokenizer.get_vocab_size())]
