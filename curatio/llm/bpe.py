"""Byte-level BPE ids and counts from a tokenizer file's own text.

The tokenizer's JSON (a megabyte or two, whatever the corpus) is what travels to the executors.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pre-token pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Stretches with other code points than these go to the library: its pattern engine may class them by another Unicode version.
_PLAIN = regex.compile(r"[\x00-\x1b\x20-\x84\x86-ͯЀ-ҁ‐-‧€™]*")

#: Where a pre-token begins whatever stands around: before a blank and an ASCII letter or digit, after a visible ASCII sign.
_SEAM = regex.compile(r"(?<=[!-~])(?= [A-Za-z0-9])")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """One tokenizer, with what can be known of it before any text is seen."""

    def __init__(self, definition: str) -> None:
        self.library = Tokenizer.from_str(definition)
        model = json.loads(definition)
        self.special = [x["content"] for x in model.get("added_tokens", [])]
        letters = byte_letters()
        self.vocabulary = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in self.special and all(c in letters for c in token)}
        self._find = regex.compile(PATTERN).findall
        self._costs: dict[str, int] = {}
        self._whole: dict[str, int] | None = None
        self._fast = None

    def whole_tokens(self) -> dict[str, int]:
        """The vocabulary strings proved, by encoding each alone, to come out as one token; each costs 1."""
        if self._whole is None:
            texts = []
            for token in self.vocabulary:
                try:
                    texts.append(token.decode())
                except UnicodeDecodeError:
                    continue
            found = self.library.encode_batch(texts, add_special_tokens=False)
            self._whole = {t: 1 for t, x in zip(texts, found, strict=True) if len(x.ids) == 1}
        return self._whole

    def plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def stretches(self, text: str) -> list[tuple[bool, str]]:
        """The text in stretches that encode on their own, each plain or for the library; cut only where a pre-token begins."""
        if self.plain(text):
            return [(True, text)]
        if any(_SEAM.search(s) for s in self.special if s in text):
            return [(False, text)]
        out: list[list] = []
        at = 0
        for cut in [*(m.start() for m in _SEAM.finditer(text)), len(text)]:
            plain = self.plain(text[at:cut])
            if out and out[-1][0] and plain:
                out[-1][2] = cut
            else:
                out.append([plain, at, cut])
            at = cut
        return [(p, text[a:b]) for p, a, b in out]

    def counts(self, texts: list[str], keep: int = 400_000) -> list[int]:
        """Tokens of each text.  Pre-tokens that are whole tokens count at once; only the others are merged, each
        once while it is among the last ``keep`` (memory only: an entry that goes is merged again when it returns)."""
        whole, costs, find = self.whole_tokens(), self._costs, self._find
        if len(costs) > keep or not costs:
            costs.clear()
            costs.update(whole)
        out = [0] * len(texts)
        odd, cut = [], []
        for i, t in enumerate(texts):
            for plain, part in self.stretches(t):
                if plain:
                    cut.append((i, find(part)))
                else:
                    odd.append((i, part))
        for (i, _), x in zip(odd, self.library.encode_batch([t for _, t in odd], add_special_tokens=False), strict=True):
            out[i] += len(x.ids)
        rest = list(set().union(*(c for _, c in cut)).difference(costs)) if cut else []
        for t, x in zip(rest, self.library.encode_batch(rest, add_special_tokens=False), strict=True):
            costs[t] = len(x.ids)
        price = costs.__getitem__
        for i, pieces in cut:
            out[i] += sum(map(price, pieces))
        return out

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text as the library gives them."""
        if self._fast is None:
            self._fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.vocabulary, special_tokens={})
        parts = [
            self._fast.encode_to_numpy(part, disallowed_special=()) if plain else self.library.encode(part, add_special_tokens=False).ids
            for plain, part in self.stretches(text)
        ]
        return np.concatenate([np.zeros(0, np.uint32), *(np.asarray(p, dtype=np.uint32) for p in parts)])


@lru_cache(maxsize=4)
def loaded(definition: str) -> ByteBpe:
    return ByteBpe(definition)
