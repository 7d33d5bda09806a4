"""Token ids of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import functools

import numpy as np

SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Tokens:
    """Ids of texts as bytes of little-endian unsigned 16-bit numbers."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={SPECIAL: SPECIAL_ID})

    def encode(self, text: str) -> bytes:
        return self.bpe.encode_to_numpy(text, allowed_special="all").astype("<u2").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.bpe.decode(ids.tolist())


@functools.cache
def tokens_of(path: str) -> Tokens:
    """One encoder per Python worker."""
    return Tokens(path)
