"""Token ids of texts by a public byte-level BPE vocabulary, inside Spark tasks.

The tokenizer's JSON file gives the ids. Its ranks also exist for a faster library, which returns the same ids
wherever both libraries class characters alike; texts with characters beyond Latin letters go
through the JSON tokenizer itself. Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cache
from pathlib import Path

NAME = "byte_bpe_50k"


def default_path(name: str = f"{NAME}.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_BEYOND = re.compile(r"[^\x00-ɏ‐-‧]")
_ODD = re.compile(r"[\x1c-\x1f\x85]")


class Encoder:
    def __init__(self, json_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path)
        self.slow.encode_special_tokens = True
        self.fast = None
        ranks_path = Path(json_path).with_suffix(".tiktoken")
        if ranks_path.exists():
            import public_tokenizers
            import tiktoken

            lines = ranks_path.read_bytes().split(b"\n")
            ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x)}
            self.fast = tiktoken.Encoding(NAME, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and not _BEYOND.search(text) and not _ODD.search(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


@cache
def encoder(json_path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(json_path)
