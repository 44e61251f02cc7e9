"""Two kinds of public tokenizer files as one thing: texts to ids, and the bytes of every id.

A file is read where the job is started and sent along, so executors need no copy of it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import sentencepiece
import tiktoken
import tokenizers

from .subwords import PATTERN


# The characters of the Unicode property White_Space, without the space.
WHITE = "\t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_NOT_PLAIN = re.compile(f"(?:^|[ {WHITE}]) ")
_UNIT_ENDS = re.compile(f"(?<=[^ {WHITE}])(?= )")


class Vocabulary:
    """`encode` gives the ids of a text with a space before it; `tokens[id]` are the bytes of an id.

    If `splits`, no token reaches over a space that follows a character other than white space, so what
    lies between such places can be encoded by itself.
    """

    def __init__(self, encode: Callable[[str], Sequence[int]], tokens: dict[int, bytes], splits: bool):
        self.encode, self.splits = encode, splits
        self.tokens = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        self.size = np.array([len(t) for t in self.tokens], np.int64)

    def __len__(self):
        return len(self.tokens)


def units(text: str) -> list[str]:
    """A text cut at each space that follows a character other than white space; these spaces are left out."""
    if _NOT_PLAIN.search(text):
        return [u[1:] for u in _UNIT_ENDS.split(" " + text)]
    return text.split(" ")


class Pair:
    """Two vocabularies over the same texts. The ids of units are kept, since words return; their size is bounded."""

    MOST_KEPT = 64 << 20  # characters, with sixty-four more for each unit
    TOGETHER = 256

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.sides = a, b
        self.cut = units if a.splits and b.splits else lambda text: [text]
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.wrong: set[int] = set()  # units that a side does not spell
        self.weight = 0
        self.ids = [np.zeros(0, np.int64)] * 2
        self.ends = [np.zeros(1, np.int64)] * 2

    def _together(self, new: list[str]):
        """Ids and the bounds of each unit, for both sides, from texts of many; None unless every unit is spelled."""
        texts = [" ".join(new[k : k + self.TOGETHER]) for k in range(0, len(new), self.TOGETHER)]
        spelled = "".join([" " + t for t in texts]).encode()
        last = np.cumsum([len(u.encode()) + 1 for u in new])
        out = []
        for v in self.sides:
            ids = np.array([i for t in texts for i in v.encode(t)], np.int64)
            if b"".join(map(v.tokens.__getitem__, ids.tolist())) != spelled:
                return None
            ends = np.cumsum(v.size[ids])
            at = np.searchsorted(ends, last)
            if not np.array_equal(ends[at], last):
                return None
            out.append((ids, at + 1))
        return out

    def _learn(self, new: list[str]):
        """Keep the ids of units not met yet. A unit with an open end is encoded alone, the others in one text."""
        open_ended = " " + WHITE
        alone = [u for u in new if not u or u[-1] in open_ended] if self.cut is units else list(new)
        joined = [u for u in new if u and u[-1] not in open_ended] if self.cut is units else []
        found = self._together(joined) if joined else None
        if joined and found is None:
            alone, joined = new, []
        count = len(self.known)
        self.known.update(zip(joined + alone, range(count, count + len(new))))
        self.weight += sum(map(len, new)) + 64 * len(new)
        each = [[v.encode(u) for u in alone] for v in self.sides]
        for k, unit in enumerate(alone, count + len(joined)):
            own = [ids[k - count - len(joined)] for ids in each]
            if any(b"".join(map(v.tokens.__getitem__, x)) != (" " + unit).encode() for v, x in zip(self.sides, own)):
                self.wrong.add(k)
        for side in (0, 1):
            ids, ends = found[side] if joined else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            more = np.fromiter(chain.from_iterable(each[side]), np.int64)
            more_ends = len(ids) + np.cumsum([len(x) for x in each[side]], dtype=np.int64)
            start = self.ends[side][-1]
            self.ids[side] = np.concatenate([self.ids[side], ids, more])
            self.ends[side] = np.concatenate([self.ends[side], start + ends, start + more_ends])

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """`ids_a, bounds_a, ids_b, bounds_b`: ids of all texts after one another.

        An empty text, and one whose tokens' bytes joined are not a space and the text, has none.
        """
        if self.weight > self.MOST_KEPT:
            self._forget()
        cut = [self.cut(text) if text else [] for text in texts]
        new = list(dict.fromkeys(u for own in cut for u in own if u not in self.known))
        if new:
            self._learn(new)
        numbers, sizes = [], []
        for own in cut:
            own = list(map(self.known.__getitem__, own))
            if not self.wrong.isdisjoint(own):
                own = []
            numbers += own
            sizes.append(len(own))
        numbers = np.array(numbers, np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        out = []
        for ids, ends in zip(self.ids, self.ends):
            begin = ends[numbers]
            end = np.concatenate([[0], np.cumsum(ends[numbers + 1] - begin)])
            out += [ids[np.repeat(begin - end[:-1], np.diff(end)) + np.arange(end[-1])], end[bounds]]
        return out


def _letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level files: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(file: bytes) -> Vocabulary:
    """A byte-level BPE in the tokenizers library's JSON.

    Where ids follow the order of the merges, as they do in the public files, the quicker tiktoken runs the same merges.
    """
    told = json.loads(file)
    letters, model = _letters(), told["model"]
    special = {t["id"] for t in told.get("added_tokens", ())}
    tokens = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if i not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    rule = told.get("pre_tokenizer") or {}
    ordered = all(model["vocab"].get("".join(m)) == 256 + k for k, m in enumerate(merges)) and len(tokens) == 256 + len(merges)
    plain = not told.get("normalizer") and rule.get("type") == "ByteLevel" and rule.get("use_regex") and not rule.get("add_prefix_space")
    if ordered and plain:
        quick = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={t: i for i, t in tokens.items()}, special_tokens={})
        return Vocabulary(lambda text: quick.encode_ordinary(" " + text), tokens, True)
    slow = tokenizers.Tokenizer.from_buffer(file)
    slow.encode_special_tokens = True
    return Vocabulary(lambda text: slow.encode(" " + text, add_special_tokens=False).ids, tokens, False)


def pieces(file: bytes) -> Vocabulary:
    """A sentencepiece model, which puts the space before a text by itself; U+2581 is a space, <0xHH> a byte."""
    model = sentencepiece.SentencePieceProcessor(model_proto=file)
    names = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size())]
    tokens = {i: bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in names}
    space = [i for i, p in names if p == "▁"]
    splits = bool(space) and not any(re.search("[^▁]▁", p) for _, p in names)
    # The library gives nothing for nothing, but the space before a text stands there too.
    return Vocabulary(lambda text: model.encode(text) if text else space, tokens, splits)


@lru_cache(4)
def load(file: bytes) -> Vocabulary:
    return byte_level(file) if file.lstrip()[:1] == b"{" else pieces(file)


@lru_cache(1)
def pair(a: bytes, b: bytes) -> Pair:
    """Built once per worker process, with the units it has met."""
    return Pair(load(a), load(b))
