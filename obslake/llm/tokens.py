"""Token ids of whole texts by a public byte-level tokenizer, inside tasks."""

from __future__ import annotations

import base64

import numpy as np

_ENCODERS: dict[str, "TokenEncoder"] = {}


class TokenEncoder:
    """Ids equal to those of the `tokenizers` file, as unsigned 16-bit numbers.

    The same vocabulary as ranks gives the same ids and is several times faster; only texts that hold the special
    token's string go through `tokenizers`, where it is one id.
    """

    SPECIAL = "<|endoftext|>"

    def __init__(self, tokenizer: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{tokenizer}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self._file = public_tokenizers.path(f"{tokenizer}.json")
        self._ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._exact = None

    def ids(self, text: str) -> np.ndarray:
        if self.SPECIAL in text:
            if self._exact is None:
                from tokenizers import Tokenizer

                self._exact = Tokenizer.from_file(self._file)
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, np.uint16)
        return self._ranks.encode_to_numpy(text, disallowed_special=()).astype(np.uint16)


def encoder(tokenizer: str) -> TokenEncoder:
    """One encoder a worker process."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = TokenEncoder(tokenizer)
    return _ENCODERS[tokenizer]
