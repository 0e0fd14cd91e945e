"""Ids as bytes: the same as the tokenizer file gives, part by part or whole."""

import random
import struct

from tenura.llm import tokens


def test_ids_of_parts_are_those_of_the_tokenizer_file():
    rng, encoder = random.Random(1), tokens.ByteBpe(tokens.default_path("byte_bpe_50k.json"))
    letters = ["a", "é", "中", " ", "  ", "\n", "\t", "\r\n", "1", ".", "'s", "　", "\xa0", "\x1c", "\x85", "�"]
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(14)))
        ids = encoder.whole.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_bytes_are_little_endian_on_any_machine(monkeypatch):
    plain = tokens._as_bytes([1, 65536])
    assert plain == struct.pack("<2I", 1, 65536) and tokens._as_bytes([]) == b""
    monkeypatch.setattr(tokens.sys, "byteorder", "big")
    assert tokens._as_bytes([1, 65536]) == struct.pack(">2I", 1, 65536)
