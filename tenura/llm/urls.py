"""URL filter: a sorted array of 64-bit digests, memory-mapped, probed by binary search.

A rule is a host and a path prefix, ``org/fr/``.  It fits its host and all subdomains of
it, if the url's path starts with the rule's path; of several fitting rules the longest
wins (host and path together, then the longer host).  A url that no rule fits gets the
default verdict.

The rules are kept as an array of (xxhash64, rule number) sorted by digest and a list of the
full strings.  The driver builds it and sends the bytes as a broadcast, 8 + 4 bytes and the
text for each rule: the size is that of the rule list, never of the pages.  Each executor
writes it once to a file of its own, which only its workers map.  For a batch of urls the
candidates (each host suffix with each path prefix of a length that some rule has) are hashed
and looked up with one vectorised binary search; each hit is confirmed against the stored
string, also past neighbours with an equal digest, so collisions cannot decide.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.  Path:
from there up to ``?``, ``#`` or the end.  Defined results: a null url or one without ``://``
has an empty host and path and no rule; an empty table or rule list works; repeated rows
stay; only page_id and url are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ready

# The rules of the production query (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_array(rules: Sequence[tuple[str, str, str]]) -> tuple[bytes, list[tuple[str, str, str]]]:
    """Little-endian uint64 digests, sorted, and the rules in the same order."""
    keyed = sorted((xxhash.xxh64_intdigest((host + path).encode()), i) for i, (_, host, path) in enumerate(rules))
    return np.array([k for k, _ in keyed], dtype="<u8").tobytes(), [rules[i] for _, i in keyed]


def mapped(data: bytes) -> np.ndarray:
    """The digests as a memory map of a file that the executor's workers share."""
    if not data:
        return np.zeros(0, dtype="<u8")
    path = os.path.join(tempfile.gettempdir(), f"url-digests-{hashlib.sha256(data).hexdigest()[:16]}.bin")
    if not os.path.exists(path):
        handle, own = tempfile.mkstemp(dir=tempfile.gettempdir())
        with os.fdopen(handle, "wb") as f:
            f.write(data)
        os.replace(own, path)
    return np.memmap(path, dtype="<u8", mode="r")


class Probe:
    """Looks up urls in a digest array; candidates are confirmed by their full strings."""

    def __init__(self, digests: np.ndarray, rules: list[tuple[str, str, str]], digest=xxhash.xxh64_intdigest) -> None:
        self.digests, self.rules, self.digest = digests, rules, digest
        self.lengths = sorted({len(path) for _, _, path in rules})

    def candidates(self, host: str, path: str) -> list[tuple[str, str]]:
        labels = host.split(".") if host else []
        hosts = [".".join(labels[i:]) for i in range(len(labels))]
        return [(h, path[:n]) for h in hosts for n in self.lengths if n <= len(path)]

    def best(self, hosts: Sequence[str], paths: Sequence[str]) -> list[tuple[str, str] | None]:
        """The rule (as a string) and its verdict for each url, or None."""
        asked = [self.candidates(h, p) for h, p in zip(hosts, paths, strict=True)]
        flat = [(i, c) for i, cs in enumerate(asked) for c in cs]
        out: list[tuple[str, str] | None] = [None] * len(asked)
        if not flat or not len(self.digests):
            return out
        keys = np.array([self.digest((h + p).encode()) for _, (h, p) in flat], dtype="<u8")
        at = np.searchsorted(self.digests, keys)
        found = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == keys)
        won: dict[int, tuple[int, int]] = {}
        for f in found:
            i, (host, path) = flat[f]
            k = at[f]
            while k < len(self.digests) and self.digests[k] == keys[f]:
                verdict, rule_host, rule_path = self.rules[k]
                rank = (len(rule_host) + len(rule_path), len(rule_host))
                if (rule_host, rule_path) == (host, path) and rank > won.get(i, (-1, -1)):
                    won[i], out[i] = rank, (rule_host + rule_path, verdict)
                k += 1
        return out


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every page."""
    spark = ready(pages.sparkSession)
    data, ordered = digest_array(rules)
    sent = spark.sparkContext.broadcast((data, ordered))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digests, known = sent.value
        probe = Probe(mapped(digests), known)
        for batch in batches:
            best = probe.best(batch["host"].tolist(), batch["path"].tolist())
            yield batch.assign(
                rule=[b and b[0] for b in best], verdict=[b[1] if b else default for b in best]
            )

    part = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    parts = pages.select(
        "page_id",
        F.translate(F.coalesce(F.regexp_extract("url", part, 1), F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce(F.regexp_extract("url", part, 2), F.lit("")).alias("path"),
    )
    kind = dict(pages.dtypes)["page_id"]
    return parts.mapInPandas(look, f"page_id {kind}, host string, path string, rule string, verdict string")
