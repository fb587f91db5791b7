"""Encoding with a public byte-level vocabulary, in tasks."""

from __future__ import annotations

import re
from array import array
from functools import cache

#: Words kept with their ids by a Python worker, and the longest word kept.
KEPT_WORDS, KEPT_CHARS = 400_000, 40
BLOCK_CHARS = 1 << 18
#: A single space between two words: no pre-token crosses the place before it.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


class _Unsafe(Exception):
    pass


class Encoder(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes.

    A pre-token of the vocabulary's pattern begins at every single space between two words,
    so a text's ids are those of its words, each with the space before it, one after the
    other; the ids of frequent words are kept.  Blocks with other white space next to a
    space are encoded as they are.
    """

    def __init__(self, ranks: str):
        import base64
        import json
        from pathlib import Path

        import public_tokenizers
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                                        mergeable_ranks=table, special_tokens={}).encode_ordinary
        model = Path(ranks).with_suffix(".json")
        added = json.loads(model.read_text())["added_tokens"] if model.exists() else []
        if any(a[flag] for a in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added tokens of {model} that aren't plain literals")
        #: Ids of the added tokens of the tokenizer's file beside the ranks, longest first.
        self.added = {a["content"]: array("I", [a["id"]]).tobytes()
                      for a in sorted(added, key=lambda a: -len(a["content"]))}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")

    def raw(self, text: str) -> bytes:
        return array("I", self.encode(text)).tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Unsafe
        ids = self.raw(" " + word)
        if len(word) <= KEPT_CHARS and "\n" not in word:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def all_ids(self, text: str) -> bytes:
        """The ids of a whole text, where added tokens are one id each, as in the tokenizer's file."""
        if not any(a in text for a in self.added):
            return self.ids(text)
        parts = self.cut.split(text)         # every second one is an added token
        return b"".join(self.added[x] if k % 2 else self.ids(x) for k, x in enumerate(parts))

    def ids(self, text: str) -> bytes:
        """The ids of a whole text, all of it ordinary."""
        out, at = [], 0
        while at < len(text):
            m = _BETWEEN.search(text, at + BLOCK_CHARS)
            end = m.start() if m else len(text)
            block, at, begun = text[at:end], end, at > 0
            words = block.split(" ")
            first = words.pop(0)            # empty if the block begins with its space
            try:
                if not begun and (not first or first[-1].isspace()):
                    raise _Unsafe
                rest = b"".join(map(self.__getitem__, words))
                out.append(rest if begun else self.raw(first) + rest)
            except _Unsafe:
                out.append(self.raw(block))
        return b"".join(out)


@cache
def encoder(ranks: str | None = None) -> Encoder:
    """One encoder for each worker; ranks: a rank file, by default that of byte_bpe_50k."""
    import public_tokenizers
    return Encoder(ranks or str(public_tokenizers.path("byte_bpe_50k.tiktoken")))
