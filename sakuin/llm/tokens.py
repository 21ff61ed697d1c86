"""Token ids of whole texts under the public byte-level BPE."""

from __future__ import annotations

import base64
import json
from array import array
from functools import lru_cache

BPE = "byte_bpe_50k"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TextEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    The ids are those of `byte_bpe_50k.json` in the tokenizers library with add_special_tokens=False: a special token's string
    within a text is that token. The same vocabulary's rank file is about eight times faster; tests hold both to the same ids. A
    text that the fast library gives up on (runs of millions of characters without a break) goes through the tokenizers library.
    """

    def __init__(self, folder_path=tokenizer_path, name: str = BPE):
        import public_tokenizers
        import tiktoken

        with open(folder_path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._path = folder_path(f"{name}.json")
        with open(self._path, encoding="utf-8") as file:
            self._special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self._fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self._special)
        self._plain = None

    def ids(self, text: str) -> list[int]:
        try:
            if any(s in text for s in self._special):
                return self._fast.encode(text, allowed_special="all")
            return self._fast.encode_ordinary(text)
        except BaseException as error:  # the Rust side's panics are no Exceptions
            if isinstance(error, (KeyboardInterrupt, SystemExit)):
                raise
        if self._plain is None:
            from tokenizers import Tokenizer

            self._plain = Tokenizer.from_file(self._path)
        return self._plain.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str | None) -> bytes:
        return array("I", self.ids(text)).tobytes() if text else b""


@lru_cache(maxsize=4)
def encoder(name: str = BPE) -> TextEncoder:
    """One encoder per worker and vocabulary."""
    return TextEncoder(name=name)
