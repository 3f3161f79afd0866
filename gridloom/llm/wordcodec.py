"""Exact encoding with public tokenizers, each distinct word given to the library once.

A byte-pair tokenizer splits a text by a fixed pattern and merges within each part alone.  So the
ids of a text are the ids of its parts, one after another, and a part met before need not be
merged again.  That holds where this module can split just as the library does: for the two known
pairs of normalizer and pre-tokenizer, and texts of the characters in ``PLAIN``, whose classes no
Unicode version has changed, that hold none of the tokenizer's added tokens.  Every other text,
and every text for any other vocabulary file, goes to the library whole.

The store of parts is bounded by bytes: once it is full, new parts are encoded each time they are
met.  It lives as long as the Python worker, which takes task after task.
"""

from __future__ import annotations

import array
import functools
import re
import sys
from collections.abc import Callable

#: Bytes of a store, about; an entry costs its key, its value and what Python needs besides.
STORE, ENTRY = 128 << 20, 170

# The characters whose letters, digits and spaces are written out below, and the
# split patterns of the public vocabularies, restricted to them.
PLAIN = "\\x00-\\xffŒœŠšŸŽž‐-…€"
LETTER = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xffŒœŠšŸŽž"
DIGIT = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
SPACE = "\\x09-\\x0d \\x85\\xa0"
SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"
PATTERNS = {
    "byte": f" ?[{LETTER}]+|{SUFFIX}| ?[{DIGIT}]+| ?[^{SPACE}{LETTER}{DIGIT}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+",
    "word": f"[{LETTER}]+|{SUFFIX}|[{DIGIT}]|[^{SPACE}{LETTER}{DIGIT}]+",
}


#: The normalizers and pre-tokenizers whose parts the patterns above give.
LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
KNOWN = {
    "byte": (None, LEVEL | {"use_regex": True}),
    "word": (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}, LEVEL | {"use_regex": False}]},
    ),
}


class _Store(dict):
    """Values by key, each made once while there is room."""

    def __init__(self, make: Callable, room: int | None = None) -> None:
        self.make, self.room = make, STORE if room is None else room

    def __missing__(self, part):
        value = self.make(part)
        cost = ENTRY + 2 * len(part) + (len(value) if isinstance(value, bytes) else 0)
        if cost <= self.room:
            self.room -= cost
            self[part] = value
        return value


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    found = array.array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


@functools.lru_cache(maxsize=4)
def encoder(path: str, room: int | None = None) -> Callable[[str], bytes]:
    """A function from a text to its ids, as bytes, for a ``.json`` file of the tokenizers library.

    Its store has ``room`` bytes, or ``STORE``.  No begin, end or other special tokens are added; added tokens inside a text are recognised,
    which is the library's default.
    """
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    whole = lambda text: id_bytes(tokenizer.encode(text, add_special_tokens=False).ids)
    kind = next((k for k, pair in KNOWN.items() if pair == (spec["normalizer"], spec["pre_tokenizer"])), None)
    if kind is None or spec["model"]["type"] != "BPE" or spec["model"].get("dropout"):
        return whole
    added = [t["content"] for t in spec["added_tokens"]]
    merge, letters = tokenizer.model.tokenize, "".join(byte_letters())
    # A part is split and normalised already, so it goes straight to the library's merging model.
    known = _Store(lambda part: id_bytes([t.id for t in merge(part.encode().decode("latin-1").translate(letters))]), room).__getitem__
    odd, parts = re.compile(f"[^{PLAIN}]").search, re.compile(PATTERNS[kind]).findall

    def encode(text: str) -> bytes:
        if odd(text) or any(t in text for t in added):
            return whole(text)
        return b"".join(map(known, parts(text if kind == "byte" else text.lower())))

    return encode


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Callable[[str], int]:
    """A function from a text to its number of tokens; ``path`` is a ``.json`` or ``.model`` file."""
    if path.endswith(".json"):
        encode = encoder(path)
        return lambda text: len(encode(text)) // 4
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    mark = "▁"
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    # Parts can be told apart if no piece goes on past a word's end into the mark of the next.
    apart = not any(re.search(f"[^{mark}]{mark}", p) for p in pieces) and model.normalize("a  b\n c ") == f"{mark}a{mark}{mark}b\n{mark}c{mark}"
    known = _Store(lambda part: len(model.encode(part))).__getitem__
    odd, parts = re.compile("[^\\x01-\\x7e\\xa1-\\xff]|^ | $|  |^$|▁").search, str.split

    def count(text: str) -> int:
        if not apart or odd(text):
            return len(model.encode(text))
        return sum(map(known, parts(text, " ")))

    return count
