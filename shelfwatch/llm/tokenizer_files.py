"""Tokenizers inside tasks: loaded once per Python worker from a path that every executor can read."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex

#: Splits text before the merges of the byte-level vocabulary (fixed value, part of that tokenizer).
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
BYTE_LEVEL, BYTE_RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def place(name: str, path: str | None = None) -> str:
    """``path``, or where the installed vocabulary package keeps ``name``."""
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _unassigned() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(p)) == "Cn" for p in range(0x110000)), bool, 0x110000)


def unsure(text: str) -> bool:
    """Whether libraries of different Unicode versions may class a character of ``text`` differently.

    They agree on characters that the oldest of them knows; a text with any other is left to the tokenizer's own library.
    """
    if text.isascii():
        return False
    return bool(_unassigned()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any())


@lru_cache(maxsize=4)
def byte_level(path: str | None = None, special: bool = True):
    """The byte-level tokenizer; ``special`` as in its file, or every special string as ordinary text."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(place(BYTE_LEVEL, path))
    loaded.no_padding()
    loaded.no_truncation()
    loaded.encode_special_tokens = not special
    return loaded


@lru_cache(maxsize=2)
def byte_ranks(path: str | None = None):
    """The same vocabulary as ranks, for a faster library; no special strings."""
    import base64

    import tiktoken

    with open(place(BYTE_RANKS, path), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PRE_TOKEN.pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def pieces(path: str | None = None):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=place(PIECES, path))


@lru_cache(maxsize=2)
def byte_level_entries(path: str | None = None) -> list[bytes]:
    """The bytes of every entry by id; byte-level text writes a byte as one printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
    vocabulary = byte_level(path, special=False).get_vocab(with_added_tokens=False)
    entries = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        entries[number] = bytes(byte_of[c] for c in token)
    return entries


@lru_cache(maxsize=2)
def piece_entries(path: str | None = None) -> list[bytes]:
    """The bytes of every piece by id: a byte piece is its byte, the block sign a space."""
    model = pieces(path)
    out = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode())
    return out
