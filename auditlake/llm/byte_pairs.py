"""Fast encoding with a byte-level pair tokenizer read from its JSON file."""

from __future__ import annotations

import json
import re
from array import array
from functools import cached_property, lru_cache

import tiktoken
from tokenizers import Tokenizer

# Words whose ids are remembered in each Python worker; the memory is emptied when full.
REMEMBERED = 200_000
# White space before a space: there a word alone may be cut differently than in its text.
_JOINED = re.compile(r"\s ")
# Runs of white space (by Unicode's property) that the pattern's engine has no stack for.
_LONG = 20_000
_RUN = re.compile(f"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{_LONG},}}")


def _bytes_of_characters() -> dict[str, int]:
    """The visible character that stands for each byte in such files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    table |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return table


class _Words(dict):
    """Ids (little-endian unsigned 32-bit) of words that follow a space."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array("I", self.encode(" " + word)).tobytes()
        return ids


class Encoder:
    """The ids that the library ``tokenizers`` gives for the same file with its default settings: none are
    added, and an added token's text becomes its id.

    Its merges have to be in the order of their ids, as byte-level files are. Texts may be of any length and
    hold white space of any length.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        table = _bytes_of_characters()
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ranks = {
            bytes(table[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in special
        }
        from public_tokenizers import PATTERN

        own = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = own.encode_ordinary
        self.words = _Words(self.encode)
        self.special = {text: i.to_bytes(4, "little") for text, i in special.items()}
        # Of several that begin in one place the longest is meant.
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else None
        self.path = path

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if any(name in text for name in self.special):
            return b"".join(self.special.get(part) or self.plain(part) for part in self.cut(text))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        run = _RUN.search(text) if len(text) >= _LONG else None
        if run:
            return self.around(text, run)
        if _JOINED.search(text):
            return array("I", self.encode(text)).tobytes()
        if len(self.words) > REMEMBERED:
            self.words.clear()
        head, *rest = text.split(" ")
        return array("I", self.encode(head)).tobytes() + b"".join(map(self.words.__getitem__, rest))


    def around(self, text: str, run: re.Match) -> bytes:
        """Ids of a text with long runs of white space: all of a run but its last character is one word of
        the pattern, and the last too where the text ends; what follows begins with the last one."""
        out, at = [], 0
        while run:
            end = run.end() if run.end() == len(text) else run.end() - 1
            blank = self.library.encode(text[run.start() : end], add_special_tokens=False).ids
            out += [self.plain(text[at : run.start()]), array("I", blank).tobytes()]
            at, run = end, _RUN.search(text, run.end())
        return b"".join(out) + self.plain(text[at:])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
