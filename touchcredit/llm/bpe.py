"""Fast exact encoders for two public ``tokenizers`` vocabularies.

``tokenizers`` splits a text into words before it merges bytes, so a text's
ids are the ids of its space-separated pieces put together.  Plain Latin text is
merged by tiktoken's byte-pair core under ranks read from the same ``.json``
file.  In every other text (other scripts, control characters, special strings)
each distinct piece is encoded by ``tokenizers`` itself, once per Python worker,
and remembered (bounded).  The ids equal ``tokenizers`` on whole texts;
tests/llm compares them.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array

import tiktoken
from tokenizers import Tokenizer

MEMO_ENTRIES = 600_000  # remembered pieces per encoder and Python worker (about 200 bytes each)
MEMO_CHARS = 64  # longer pieces are encoded anew each time

# Fixed value: the word pattern of the byte-level vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PLAIN = re.compile(r"[\n\x20-\x7e\xa1-įı-ɏ]*\Z")
_UNEVEN_SPACE = re.compile(r" (?:\s|\Z)")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?=[ \n\t])")
_SET_OFF = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼-¾]|[^\w\s]+(?:_+[^\w\s]*)*|_+(?:[^\w\s]+_*)*")


@functools.lru_cache(maxsize=1)
def byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(path: str, end: bytes) -> dict[bytes, int]:
    """Ids by bytes; ``end`` stands for the end-of-word mark."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    chars, ranks = byte_of_char(), {}
    for token, i in vocab.items():
        stem = token.removesuffix("</w>")
        if stem and all(c in chars for c in stem):
            ranks[bytes(chars[c] for c in stem) + (end if stem != token else b"")] = i
    return ranks


class ByteBpe:
    """Ids of a byte-level vocabulary (words keep their leading space)."""

    special = "<|endoftext|>"

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.ranks = {k: v for k, v in _ranks(path, b"").items() if k != self.special.encode()}
        self.core = tiktoken.Encoding("byte", pat_str=BYTE_PATTERN, mergeable_ranks=self.ranks,
                                      special_tokens={})._core_bpe
        self.after_space: dict[str, bytes] = {}
        self.alone: dict[str, bytes] = {}

    def ids16(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 16-bit integers."""
        if _PLAIN.match(text) and self.special not in text:
            return _pack(self.core.encode_ordinary(text))
        if _UNEVEN_SPACE.search(text):
            return b"".join([_remember(self.alone, p, p, self._piece) for p in _BEFORE_SPACE.split(text)])
        first, *rest = text.split(" ")
        return _remember(self.alone, first, first, self._piece) + _join(self.after_space, rest, " ", self._piece)

    def _piece(self, piece: str) -> bytes:
        return _pack(self.library.encode(piece, add_special_tokens=False).ids)


class WordBpe:
    """Ids of a lower-cased vocabulary with end-of-word marks (white space dropped).

    In a plain text every word is set off by spaces, so that the space after a
    word can stand for its end mark.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.core = tiktoken.Encoding("word", pat_str=r"[^ ]+ ", mergeable_ranks=_ranks(path, b" "),
                                      special_tokens={})._core_bpe
        self.memo: dict[str, bytes] = {}

    def ids16(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 16-bit integers."""
        if _PLAIN.match(text) and "<|" not in text:
            spaced = _SET_OFF.sub(r" \g<0> ", text.lower()).replace("\n", " ")
            return _pack(self.core.encode_ordinary(f"{spaced} "))
        return _join(self.memo, text.split(" "), "", self._piece)

    def _piece(self, piece: str) -> bytes:
        return _pack(self.library.encode(piece, add_special_tokens=False).ids)


def _pack(ids: list[int]) -> bytes:
    out = array("H", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _remember(memo: dict[str, bytes], key: str, piece: str, encode) -> bytes:
    out = memo.get(key)
    if out is None:
        out = encode(piece)
        if len(key) <= MEMO_CHARS:
            if len(memo) >= MEMO_ENTRIES:
                memo.clear()
            memo[key] = out
    return out


def _join(memo: dict[str, bytes], keys: list[str], before: str, encode) -> bytes:
    """The remembered values of ``keys`` put together; new ones are encoded as ``before + key``."""
    out = list(map(memo.get, keys))
    if None in out:
        for i, v in enumerate(out):
            if v is None:
                out[i] = _remember(memo, keys[i], before + keys[i], encode)
    return b"".join(out)


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@functools.lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
