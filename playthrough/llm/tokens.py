"""Token ids of whole texts, word by word.

The vocabulary of a word-level BPE drops white space, so a text's ids are those of its runs of other characters,
one after the other. Ids of a run are kept in a bounded table per Python worker. Runs of plain Latin letters
are merged by ``tiktoken``, which takes the same ranks without the cost of an encoding object; all others, and
texts with rare control characters, go through ``tokenizers`` itself. A test compares both over whole tables.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np

#: Runs a worker remembers; beyond, it starts anew.
REMEMBERED = 300_000
#: First character whose lower case or class is left to ``tokenizers``.
PLAIN_BELOW = "İ"
#: White space for str.split() but not for the vocabulary.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Stands for the end of a word; no UTF-8 text holds this byte.
_WORD_END = b"\xff"


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its own Latin-1 character, or from U+0100 on if it has no visible one."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordIds(dict):
    """Run of characters -> its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        suffix, byte_of = spec["model"]["end_of_word_suffix"], _byte_of_character()
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token in special:
                continue
            ends = token.endswith(suffix)
            body = bytes(byte_of[c] for c in token[: -len(suffix) if ends else None])
            ranks[body + _WORD_END * ends] = rank
        plain = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self.merge = plain._core_bpe.encode_single_piece
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall

    def exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, run: str) -> bytes:
        if "<|" in run or max(run) >= PLAIN_BELOW:
            found = self.exact(run)
        else:
            low = (run if run.isascii() else unicodedata.normalize("NFC", run)).lower()
            ids: list[int] = []
            for piece in [low] if low.isalpha() else self.pieces(low):
                ids += self.merge(piece.encode() + _WORD_END)
            found = np.array(ids, dtype="<u4").tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[run] = found
        return found

    def of_text(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self.exact(text)
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One table per worker and vocabulary."""
    return WordIds(path)
