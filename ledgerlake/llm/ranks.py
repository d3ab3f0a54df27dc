"""Ids of a byte-level BPE file of ``tokenizers``, by merge ranks for plain texts.

The file's vocabulary numbers its tokens in merge order after the 256 bytes,
so the same ids follow from the tokens' ranks, which ``tiktoken`` applies
several times faster.  That is done only for texts of plain characters (white
space and printable ASCII, Latin letters, no special strings), whose
character classes no version of a pattern library disputes; every other text
is encoded by ``tokenizers`` itself.  Tests compare both on random texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

#: Fixed value: the published byte-level pre-token pattern of this kind of file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ɏ]*")
LONG_WHITE = (" " * 256, "\n" * 256, "\t" * 256)


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in such files, by its rule: printable Latin-1
    characters for themselves, the other bytes from U+0100 on in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """The file's tokens as bytes with their ranks, or None if it isn't of the kind described above."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    special = {t["content"] for t in file.get("added_tokens", [])}
    plain_model = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                 "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain_pre = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    if model.get("type") != "BPE" or not plain_model or not plain_pre or file.get("normalizer"):
        return None
    byte_of = _byte_of()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    in_order = [model["vocab"]["".join(m)] for m in merged]
    if sorted(ranks.values()) != list(range(len(ranks))) or in_order != list(range(256, len(ranks))):
        return None
    return ranks


class RankEncoder:
    """Ids of texts as ``tokenizers`` gives them, as little-endian uint32 bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = ranks_of(path)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if (self.fast and PLAIN.fullmatch(text) and not any(x in text for x in self.special)
                and not any(x in text for x in LONG_WHITE)):
            return array("I", self.fast(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> RankEncoder:
    """The worker process's encoder of a file."""
    return RankEncoder(path)
