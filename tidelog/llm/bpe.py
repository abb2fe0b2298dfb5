"""Byte-pair encoding inside tasks, equal to the tokenizers library's ids.

Texts of Latin letters go to a faster encoder that merges by the rank of the
result instead of the pair.  Both give the same ids for a vocabulary whose
every entry encodes to itself: what the faster one would merge next lies
between places that no earlier merge crossed, so its parts are those the
entry has when it stands alone.  ``tests/llm`` checks that of the vocabulary.
Texts with other letters or special tokens go to the tokenizers library, as
the classes of recently assigned characters may differ between the two.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
#: Characters whose classes never changed: Latin ones, dashes, quotes, the euro sign.
_PLAIN = re.compile("[\x00-\u024f\u2010-\u2027\u20ac]*")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.letters = {b: c for c, b in letters.items()}
        names = {t["content"] for t in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"].items()
        by_id = {i: bytes(letters[c] for c in p) for p, i in vocabulary if p not in names}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.fast = tiktoken.Encoding(
            path,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={p: i for i, p in by_id.items()},
            special_tokens={},
        )
        by_id |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit numbers."""
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [self.encode(t) for t in texts]

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        """Text of the ids, special ones included; bytes that are no UTF-8
        become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def one_piece(self, raw: bytes) -> list[int]:
        """Ids of bytes that the pre-tokenizer doesn't split."""
        return [t.id for t in self.tokenizer.model.tokenize("".join(self.letters[b] for b in raw))]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The worker's codec of a vocabulary file."""
    return Codec(path)
