"""Byte-level BPE ids of whole texts, equal to those of the tokenizers library."""

from __future__ import annotations

import base64
import re
from functools import cached_property, lru_cache

import numpy as np

from marlstone.llm.common import one_thread

#: Characters whose class (letter, digit, space or other) is the same for both libraries' pattern engines, whatever
#: their Unicode versions. A text with any other character is encoded by the tokenizers library itself.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ‐-‧]")
SPECIAL = "<|endoftext|>"


class ByteBPE:
    """Encoder for a vocabulary in both of its public forms: a rank file, and a tokenizers file that is a tenth as fast and
    is only opened when a text needs it. The special token's id follows the ranks."""

    def __init__(self, path: str, ranks_path: str, pattern: str):
        one_thread()
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.path = path
        #: Bytes of each id's piece.
        self.lengths = np.zeros(len(ranks) + 1, dtype=np.int64)
        self.lengths[list(ranks.values())] = [len(b) for b in ranks]
        self.lengths[len(ranks)] = len(SPECIAL)
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})

    @cached_property
    def own(self):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(self.path)
        own.no_truncation()
        own.no_padding()
        if own.token_to_id(SPECIAL) != len(self.lengths) - 1:
            raise ValueError("the two files are not of one vocabulary")
        return own

    def ids(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit little-endian numbers."""
        if PLAIN.search(text):
            return np.asarray(self.own.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")


@lru_cache(maxsize=2)
def byte_bpe(path: str, ranks_path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, ranks_path, pattern)


def byte_bpe_files() -> tuple[str, str, str]:
    """The public 50k vocabulary: its two files and its pattern."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN
