"""Ids of whole texts by the tokenizers library, with each distinct chunk encoded once.

A byte-level pre-tokenizer always ends a pre-token before a space that a non-blank follows, before a comma or
full stop that a letter or digit precedes, and before a line feed that a non-blank precedes. The text may be
cut there and the chunks encoded apart; frequent chunks then come from a bounded dictionary.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks already use every core

import numpy as np
from tokenizers import Tokenizer

from terraops.llm.common import cached

#: Longest text that is cut at one go; longer ones are taken in parts of this many characters.
PART_CHARS = 1_000_000
#: Chunks kept by a worker, and the longest that it keeps.
ROOM, KEPT_CHARS = 1_200_000, 48

#: Marks a chunk that has no leading space; texts that hold it are cut at spaces only.
BARE = "\x01"
_CUT = re.compile(r" (?=\S)")
_BLANK = re.compile(r"[^\S \n]")
_RUN = re.compile(r"(?s)[,.](?<![^\W_].)")


def cuttable(path: str) -> bool:
    """Whether the tokenizer file is of the kind whose texts may be cut before a space and a non-blank."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
    )


def plain(text: str) -> bool:
    """Whether every space, comma, full stop and line feed of the text stands where it may be cut."""
    return not ("  " in text or " \n" in text or "\n\n" in text or text[:1] == "\n" or text[-1:] == " " or BARE in text or _odd_blank(text) or _RUN.search(text))


def _odd_blank(text: str) -> bool:
    """Whether the text has white space other than spaces and line feeds; most texts pass the quicker test."""
    return not text.replace("\n", " ").isprintable() and _BLANK.search(text) is not None


def chunks(text: str) -> list[str]:
    """Keys of text's chunks but for a mark on the first: BARE + chunk, or the chunk without its leading space."""
    if plain(text):
        return text.replace(",", " \x01,").replace(".", " \x01.").replace("\n", " \x01\n").split(" ")
    out = _CUT.split(text)
    return out if BARE not in text else out[:1] + ["".join((BARE, " ", x)) if x[:1] == BARE else x for x in out[1:]]


def chunk_of(key: str) -> str:
    return key[1:] if key[:1] == BARE else " " + key


def parts(text: str) -> list[str]:
    """A long text in parts that end before a cut; every part but the first has lost its leading space."""
    out, begin = [], 0
    while len(text) - begin > PART_CHARS and (cut := _CUT.search(text, begin + PART_CHARS)):
        out.append(text[begin : cut.start()])
        begin = cut.end()
    out.append(text[begin:])
    return out


class _Codes(dict):
    """Codes by key; a key that is asked for first gets the next code and is noted in new."""

    def __init__(self):
        super().__init__()
        self.base, self.new = 0, []

    def __missing__(self, key: str) -> int:
        code = self[key] = self.base + len(self.new)
        self.new.append(key)
        return code


class Memo:
    """Ragged integer arrays by chunk: code -> values[starts[code]:starts[code] + sizes[code]]."""

    def __init__(self, encode, dtype, room: int = ROOM):
        self.encode, self.dtype, self.room = encode, dtype, room
        self.clear()

    def clear(self) -> None:
        self.code = _Codes()
        self.values = np.empty(1 << 16, self.dtype)
        self.sizes = np.empty(1 << 14, np.int64)
        self.starts = np.empty(1 << 14, np.int64)
        self.count = self.filled = 0

    def add(self, rows: list) -> None:
        """Appends rows under the next codes."""
        n, sizes = len(rows), np.fromiter(map(len, rows), np.int64, len(rows))
        total = int(sizes.sum())
        while self.count + n > len(self.sizes):
            self.sizes, self.starts = (np.concatenate([x, np.empty_like(x)]) for x in (self.sizes, self.starts))
        while self.filled + total > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        self.sizes[self.count : self.count + n] = sizes
        self.starts[self.count : self.count + n] = self.filled + np.cumsum(sizes) - sizes
        self.values[self.filled : self.filled + total] = np.fromiter(chain.from_iterable(rows), self.dtype, total)
        self.count, self.filled = self.count + n, self.filled + total

    def codes(self, keys: list[str]) -> np.ndarray:
        """Codes of keys. Those of long keys hold until the next call of fresh()."""
        self.code.base, self.code.new = self.count, []
        found = np.fromiter(map(self.code.__getitem__, keys), np.int64, len(keys))
        if new := self.code.new:
            try:
                self.add(self.encode(new))
            except BaseException:
                self.clear()  # else the new codes would stand for nothing
                raise
            for key in new:
                if len(key) > KEPT_CHARS:
                    del self.code[key]
        return found

    def fresh(self) -> None:
        """Empties the dictionary once it is full, so that a worker's memory stays bounded."""
        if self.count > self.room or self.filled > 8 * self.room:
            self.clear()

    def gather(self, codes: np.ndarray) -> np.ndarray:
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[codes] - ends + sizes, sizes)
        return self.values[at]


class ChunkEncoder:
    def __init__(self, path: str, room: int = ROOM):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.cuttable = cuttable(path)
        self.memo = Memo(self._encode, self.dtype, room)

    def _encode(self, keys: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(list(map(chunk_of, keys)), add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and how many each text has."""
        if not self.cuttable:
            rows = self._encode([BARE + x for x in texts])
            return np.array([i for r in rows for i in r], self.dtype), np.array([len(r) for r in rows], np.int64)
        self.memo.fresh()
        codes, sizes = keyed(self.memo, texts)
        per = np.add.reduceat(np.append(self.memo.sizes[codes], 0), np.append(0, np.cumsum(sizes)[:-1])) * (sizes > 0) if len(sizes) else np.empty(0, np.int64)
        return self.memo.gather(codes), per


def keyed(memo: Memo, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all chunks of the texts, and how many chunks each text has."""
    keys: list[str] = []
    sizes = []
    for text in texts:
        before = len(keys)
        for k, part in enumerate(parts(text) if len(text) > PART_CHARS else (text,)):
            own = chunks(part)
            if k == 0:
                own[0] = BARE + own[0]
            keys += own
        sizes.append(len(keys) - before)
    return memo.codes(keys), np.array(sizes, np.int64)


@cached(4)
def encoder(path: str, room: int = ROOM) -> ChunkEncoder:
    """One a worker and file."""
    return ChunkEncoder(path, room)
