"""Token ids of whole texts, for use inside tasks.

The vocabulary is the byte-level one of 50,257 entries, read from its rank file, which gives the same
ids as its tokenizer file at several times the speed. Special-token strings are ordinary text.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: Name of the vocabulary's rank file; ``public_tokenizers.path`` finds it.
VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 1


class TextEncoder:
    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.encode = tiktoken.Encoding(
            "documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={}).encode_ordinary

    def ids(self, text: str | None) -> np.ndarray:
        """The text's ids; none for NULL."""
        return np.array(self.encode(text) if text else [], dtype="<u4")

    def closed_ids(self, text: str | None) -> np.ndarray:
        """The text's ids and the end id."""
        return np.array([*(self.encode(text) if text else ()), END_ID], dtype="<u4")


@lru_cache(maxsize=1)
def encoder(vocabulary: str = VOCABULARY) -> TextEncoder:
    """One encoder per worker process."""
    return TextEncoder(vocabulary)
