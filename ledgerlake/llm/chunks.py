"""Tokenizer encoding with a per-worker memo of space-delimited chunks.

A text is cut only at single spaces that stand between two characters of
``SAFE`` (printable ASCII, Latin letters).  No pre-token of the byte-level or
the word-level pattern crosses such a place: a single space before a
non-space always opens the next pre-token (byte level) or is dropped (word
level).  So the concatenation of the chunks' ids is the text's ids.

Chunks that the memo lacks are encoded by the tokenizer, all of a text's in
one call, and told apart by the tokens' offsets.  The memo is bounded and
forgets what hasn't been seen for long, which changes the time taken but no
result.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

SAFE = re.compile("[!-~À-ÖØ-öø-ɏ]")
ENDS = re.compile("[!-~À-ÖØ-öø-ɏ](?:.*[!-~À-ÖØ-öø-ɏ])?", re.DOTALL)


@lru_cache(maxsize=2)
def encoder(path: str) -> "ChunkEncoder":
    """The worker process's encoder of a file: its memo outlives the task."""
    return ChunkEncoder(path)


class ChunkEncoder:
    """Ids of texts as ``tokenizers`` gives them, as little-endian uint32 bytes."""

    def __init__(self, path: str, memo_size: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        #: Chunks without their leading space, in two generations: what is used again moves to the young one.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.memo_size = memo_size

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _together(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that begin with a space and have safe ends, by one call.

        A token's offset lies in its own chunk: leading spaces may be left
        out of it, but a chunk ends in no white space.
        """
        e = self.tokenizer.encode("".join(chunks), add_special_tokens=False)
        at = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
        ends = np.searchsorted(at, np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))).tolist()
        data = array("I", e.ids).tobytes()
        return [data[4 * a:4 * b] for a, b in zip([0, *ends], ends)]

    def _learn(self, missing: set[str]) -> None:
        """Brings chunks (given without their leading space) into the young generation."""
        young, old, new = self.young, self.old, []
        for w in missing:
            ids = old.get(w)
            if ids is None:
                new.append(w)
            else:
                young[w] = ids
        if new:
            young.update(zip(new, self._together([f" {w}" for w in new])))

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        head, *rest = text.split(" ")
        if not rest:
            return self._plain(text)
        young = self.young
        parts = list(map(young.get, rest))
        safe = bool(head) and SAFE.match(head[-1]) is not None
        if None in parts:
            missing = {w for w, p in zip(rest, parts) if p is None}
            safe = safe and all(map(ENDS.fullmatch, missing))
            if safe:
                self._learn(missing)
                parts = list(map(young.__getitem__, rest))
        if not safe:
            return self._merged(head, rest)
        if len(young) > self.memo_size:
            self.old, self.young = young, {}
        return self._plain(head) + b"".join(parts)

    def _merged(self, head: str, rest: list[str]) -> bytes:
        """For texts with unsafe places: pieces are merged over them, and only whole chunks looked up."""
        out, now, plain = [], head, True
        get = self.young.get
        for w in rest:
            if now and w and SAFE.match(now[-1]) and SAFE.match(w[0]):
                out.append((None if plain else get(now)) or self._plain(now if plain else f" {now}"))
                now, plain = w, False
            else:
                now = f"{now} {w}"
        out.append((None if plain else get(now)) or self._plain(now if plain else f" {now}"))
        return b"".join(out)

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4
