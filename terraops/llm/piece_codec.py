"""Encoding and decoding with a merge-type (BPE) SentencePiece model, by backtracking.

A segmentation is the one that merging gives exactly if every two neighbours survive when their joined text
is merged again. So the encoder takes the longest piece that an Aho-Corasick pass has found at a position,
falls back to shorter ones while a neighbour does not fit, and never revisits a position that has failed.
Runs between places that no piece spans are encoded apart and kept in a bounded dictionary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import cached, texts_of

SPACE = "▁"
BARE = "\x01"
#: Runs kept by a worker, the longest that it keeps, and the pairs of pieces whose check it keeps.
ROOM, KEPT_CHARS, PAIR_ROOM = 400_000, 48, 1_000_000


class PieceCodec:
    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        if library.normalize("Ａ  b ") != f"{SPACE}Ａ{SPACE}{SPACE}b{SPACE}":
            raise ValueError(f"{path}: a model that keeps the text as it is, with a leading space, is asked for")
        n = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(n)]
        self.control = {i for i in range(n) if library.is_control(i)}
        self.unknown = library.unk_id()
        plain = [i for i in range(n) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: library.get_score(i) for i in plain}
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(library.is_byte(i) for i in range(n)) else None
        self.bytes = {i: b for b, i in enumerate(self.byte_ids or [])}
        usable = [i for i in plain if self.merge(self.pieces[i]) == [self.pieces[i]]]
        self.size = {i: len(self.pieces[i]) for i in usable}
        made = {self.pieces[i]: i for i in usable}
        self.shorter = {i: next((made[p] for k in range(len(self.pieces[i]) - 1, 0, -1) if (p := self.pieces[i][:k]) in made), -1) for i in usable}
        self.matcher = ahocorasick.Automaton()
        for i in usable:
            self.matcher.add_word(self.pieces[i], i)
        self.matcher.make_automaton()
        single = {p for p in made if len(p) == 1}
        self.strange = re.compile("[^" + "".join(map(re.escape, sorted(single))) + "]")
        self._places(made)
        self.fits: dict[int, bool] = {}
        self.kept: dict[str, tuple[str, str]] = {}

    def _places(self, made: dict[str, int]) -> None:
        """Where a text may be cut: before a space after another character, and before these marks."""
        inner = {p[k - 1 : k + 1] for p in made for k in range(1, len(p))}
        if any(pair[1] == SPACE != pair[0] for pair in inner):
            raise ValueError("a piece spans two words")
        before = {mark: {pair[0].replace(SPACE, " ") for pair in inner if pair[1] == mark} for mark in ",.\n"}
        self.marks = [m for m, seen in before.items() if not any(c.isalpha() for c in seen)]
        risky = "|".join(f"[{''.join(map(re.escape, sorted(before[m])))}]{re.escape(m)}" for m in self.marks if before[m])
        behind = "".join(map(re.escape, self.marks))
        self.risky = re.compile(f"[{behind}](?<={risky.replace('|', ')|(?<=')})") if risky else None

    def merge(self, text: str) -> list[str]:
        """text merged pair by pair: the best score first, the leftmost among equals."""
        parts = list(text)
        scores = self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, left: int, right: int) -> bool:
        key = left << 24 | right
        found = self.fits.get(key)
        if found is None:
            a, b = self.pieces[left], self.pieces[right]
            if len(self.fits) >= PAIR_ROOM:
                self.fits.clear()
            found = self.fits[key] = self.merge(a + b) == [a, b]
        return found

    def _known(self, run: str) -> list[int]:
        """Ids of a run whose characters are all pieces."""
        longest = [0] * len(run)
        for end, i in self.matcher.iter(run):
            longest[end - self.size[i] + 1] = i  # matches come by their end: the last of a start is its longest
        out: list[int] = []
        failed = bytearray(len(run) // 8 + 1)
        at, piece = 0, longest[0]
        while True:
            end = at + self.size[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and (not out or self._fit(out[-1], piece)):
                out.append(piece)
                if end == len(run):
                    return out
                at, piece = end, longest[end]
            elif self.shorter[piece] >= 0:
                piece = self.shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= self.size[piece]

    def encode_run(self, run: str) -> list[int]:
        """Ids of a text whose spaces are already marks and that gets no leading one."""
        out: list[int] = []
        at = 0
        for strange in self.strange.finditer(run):
            if strange.start() > at:
                out += self._known(run[at : strange.start()])
            out += [self.byte_ids[b] for b in strange[0].encode()] if self.byte_ids else [self.unknown]
            at = strange.end()
        return out + (self._known(run[at:]) if at < len(run) else [])

    def runs(self, text: str) -> list[str]:
        """Keys of the parts of the text: BARE + run, or the run without its one leading space."""
        if not text:
            return []
        if "  " in text or text[0] in " ,.\n" or text[-1] == " " or SPACE in text or BARE in text or self.risky and self.risky.search(text):
            marked = SPACE + text.replace(" ", SPACE)
            return [BARE + x for x in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)]
        for mark in self.marks:
            text = text.replace(mark, f" {BARE}{mark}")
        return text.split(" ")

    def _row(self, key: str) -> tuple[str, str]:
        ids = self.encode_run(key[1:] if key[:1] == BARE else SPACE + key)
        row = (" ".join(map(str, ids)), self._text(ids))
        if len(key) <= KEPT_CHARS:
            self.kept[key] = row
        return row

    def _text(self, ids: list[int]) -> str:
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append("" if i in self.control else " ⁇ " if i == self.unknown else self.pieces[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def digest(self, text: str, end_id: int) -> tuple[str, str]:
        """The ids as decimal numbers joined by spaces, and the text decoded from them."""
        if len(self.kept) > ROOM:
            self.kept.clear()
        keys = self.runs(text)
        rows = list(map(self.kept.get, keys))
        if None in rows:
            rows = [self.kept.get(k) or self._row(k) if r is None else r for k, r in zip(keys, rows, strict=True)]
        return " ".join([*[r[0] for r in rows], str(end_id)]), "".join([r[1] for r in rows])[1:]

    def encode(self, text: str) -> list[int]:
        return self.encode_run(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        text = self._text(ids)
        return text[1:] if text[:1] == " " else text


@cached(2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def piece_digests(docs: DataFrame, model: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each whole text's ids, end_id appended.

    A null text counts as empty: the end id alone, decoded to the empty text. Repeated rows give repeated
    results, a null doc_id is kept, other columns are ignored.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(model)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch in batches:
            rows = []
            for text in batch:
                ids, decoded = own.digest(text, end_id)
                rows.append((ids.count(" ") + 1, sha(ids), sha(decoded)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    out = texts_of(docs).select("doc_id", digest("text").alias("d"))
    return out.select("doc_id", "d.*")


def piece_ids(docs: DataFrame, model: str, end_id: int) -> DataFrame:
    """(doc_id, ids) of each whole text, end_id appended."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model)
        for batch in batches:
            yield pd.Series([list(map(int, own.digest(text, end_id)[0].split(" "))) for text in batch])

    return texts_of(docs).select("doc_id", encode("text").alias("ids"))


def piece_texts(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) decoded from rows of (doc_id, ids)."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model)
        for batch in batches:
            yield pd.Series([None if ids is None else own.decode([int(i) for i in ids]) for ids in batch])

    return rows.select("doc_id", decode("ids").alias("text"))
