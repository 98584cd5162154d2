"""Byte-level BPE ids and the bytes of each id, from public vocabulary files."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

# Texts of these characters only, without the special token's string and without long runs of space, take the faster of two
# encoders of the same vocabulary; the others take the one that reads the tokenizer file itself.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
_LONG_SPACE = re.compile(r"\s{200}")


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as the tokenizer file gives them, without special tokens added."""

    def __init__(self, path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = [b""] * (max(ranks.values()) + 2)
        for token, rank in ranks.items():
            self.pieces[rank] = token
        for added, token in self.exact.get_added_tokens_decoder().items():
            if added < len(self.pieces):
                self.pieces[added] = token.content.encode()

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        if _PLAIN.fullmatch(text) and "<|" not in text and not _LONG_SPACE.search(text):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str | None = None, ranks_path: str | None = None) -> Encoder:
    """The encoder of a worker, loaded once; paths default to the 50k byte-level vocabulary."""
    return Encoder(path or default_path("byte_bpe_50k.json"), ranks_path or default_path("byte_bpe_50k.tiktoken"))
