"""Tokenizers of public vocabulary files, and the bytes of their tokens."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np


def place(vocabulary: str) -> str:
    """A path as it is; else the place of an installed public vocabulary of that name."""
    if os.path.isabs(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


class ByteLevel:
    """Byte-level BPE of a vocabulary file. ``special``: its added tokens are matched in texts, else they are plain text.

    The ids are those of the file's own tokenizer; the merges run in a second, faster library on the same ranks.
    """

    def __init__(self, vocabulary: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(place(vocabulary))
        self.plain.encode_special_tokens = not special
        added = {token.content: n for n, token in self.plain.get_added_tokens_decoder().items()}
        known = self.plain.get_vocab(with_added_tokens=False)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # a byte is its own character, or the next from 256 on
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
        ranks = {bytes(byte[c] for c in token): n for token, n in known.items() if token not in added}
        self.fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added if special else {})
        self.allowed = set(added) if special else set()
        self.bytes = {n: token for token, n in ranks.items()}
        self.lengths = np.zeros(max(known.values()) + 1, np.int64)
        self.lengths[list(self.bytes)] = [len(token) for token in self.bytes.values()]

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            try:
                out.append(self.fast.encode(text, allowed_special=self.allowed, disallowed_special=()) if self.allowed else self.fast.encode_ordinary(text))
            except BaseException as failed:  # the fast library's pattern gives up on some very long runs
                if type(failed).__name__ != "PanicException" and not isinstance(failed, (ValueError, RuntimeError)):
                    raise
                out.append(self.plain.encode(text, add_special_tokens=False).ids)
        return out


class Pieces:
    """SentencePiece model; it puts a space before a text itself."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=place(vocabulary))
        pieces = [(i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]
        self.bytes = {i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces}
        self.lengths = np.array([len(self.bytes[i]) for i, _ in pieces], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(4)
def byte_level(vocabulary: str, special: bool = False) -> ByteLevel:
    return ByteLevel(vocabulary, special)


@lru_cache(2)
def pieces(vocabulary: str) -> Pieces:
    return Pieces(vocabulary)
