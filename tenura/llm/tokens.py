"""Token ids of a public byte-level BPE vocabulary, quickly and exactly.

Before merging, the vocabulary's pattern cuts a text into pieces, and a space before a
character that is no white space always opens a piece.  So a text may be cut there first, and
the ids of a part (one space and what follows up to the next space) depend on the part
alone: they are looked up in a dictionary and computed once.  Texts in which a space
meets other white space or the end are encoded whole.  Parts of Latin letters are encoded by the
vocabulary in its rank form, all others by the tokenizer file itself.
"""

from __future__ import annotations

import base64
import os
import re
import sys
from array import array
from collections.abc import Iterable

# A space before white space or the end of the text.
UNSAFE = re.compile(r" (?:\s|\Z)")
# The last letter of the Latin Extended-B block; beyond it the tokenizer file decides.
BEYOND_LATIN = re.compile("[^\x00-ɏ]")
KEPT_PARTS = 400_000  # bounds the dictionary, not the result


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _as_bytes(ids: Iterable[int]) -> bytes:
    found = array("I", ids)  # a part has few ids: cheaper than an array of numpy
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


class ByteBpe(dict):
    """Ids as little-endian uint32 bytes; itself the dictionary from parts to ids."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        ranks_path = os.path.splitext(path)[0] + ".tiktoken"
        self.ranks = None
        if os.path.exists(ranks_path):
            import public_tokenizers

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding(
                "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def direct(self, text: str) -> bytes:
        if self.ranks is None or (not text.isascii() and BEYOND_LATIN.search(text)):
            return _as_bytes(self.whole.encode(text, add_special_tokens=False).ids)
        return _as_bytes(self.ranks.encode_ordinary(text))

    def __missing__(self, part: str) -> bytes:
        if len(self) >= KEPT_PARTS:
            self.clear()
        self[part] = ids = self.direct(" " + part)
        return ids

    def encode(self, text: str) -> bytes:
        if not text or UNSAFE.search(text):
            return self.direct(text)
        first, *parts = text.split(" ")
        return self.direct(first) + b"".join(map(self.__getitem__, parts))


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """One encoder a worker and file; its dictionary lives as long as the worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
