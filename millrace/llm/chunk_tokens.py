"""Token ids of whole texts, running the merges once per distinct piece.

Both tokenizers split a text into pieces before they merge, and merges never
cross pieces. So a text is split here by the tokenizer's own rule, the library
merges each distinct piece once, and a text's ids are its pieces' ids in order.
Texts with characters beyond Latin, other white space than blanks and line
feeds, or marks of special tokens go to the library whole.
"""

from __future__ import annotations

import array
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

# Characters on which every version of Unicode agrees, and whose lower case and
# composed form depend on nothing around them; no mark of a special token.
UNSURE = re.compile("[^\n\x20-\x7e\xa1-ɏ]|<\\|")
# Letters and digits among those characters, how the tokenizers
# split (with and without blanks kept), and the letters that stand for bytes in
# their vocabularies.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGITS = "0-9²³¹¼½¾"
PIECES = {
    True: rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+",
    False: rf"[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{DIGITS}]|[^\s{LETTERS}{DIGITS}]+",
}
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTES = {b: chr(b) for b in PRINTED} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(PRINTED))}
# What each character of the texts handled here is written as: one letter per byte.
BYTE_LETTERS = {c: "".join(BYTES[b] for b in chr(c).encode()) for c in range(0x400)}
# A place where a text can be cut: no piece crosses it.
CUT = re.compile(r"(?<=\S) (?=\S)")
SEGMENT_CHARS = 500_000
CACHED_PIECES = 400_000


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[str]:
    """The text in parts of about `size` characters, each later one starting with a blank."""
    begin = 0
    while len(text) - begin > size and (cut := CUT.search(text, begin + size)):
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


class Pieces(dict):
    """Number of each known piece; an unknown one is merged by the library when first looked up."""

    def __init__(self, merges):
        super().__init__()
        self.merges = merges
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.starts, self.lengths, self.ids = array.array("q"), array.array("q"), array.array("I")

    def __missing__(self, piece: str) -> int:
        ids = [t.id for t in self.merges.tokenize(piece.translate(BYTE_LETTERS))]
        number = self[piece] = len(self.starts)
        self.starts.append(len(self.ids))
        self.lengths.append(len(ids))
        self.ids.extend(ids)
        return number

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count of ids of each piece) of pieces by number."""
        lengths = np.frombuffer(self.lengths, np.int64)[numbers]
        before = np.cumsum(lengths) - lengths
        at = np.repeat(np.frombuffer(self.starts, np.int64)[numbers] - before, lengths) + np.arange(int(lengths.sum()))
        return np.frombuffer(self.ids, np.uint32)[at], lengths


class ChunkEncoder:
    """`keeps_blanks`: the tokenizer encodes a word together with the blank before it; else it drops
    white space and lower-cases."""

    def __init__(self, path: str, keeps_blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.keeps_blanks = Tokenizer.from_file(path), keeps_blanks
        self.split, self.known = re.compile(PIECES[keeps_blanks]).findall, Pieces(self.library.model)

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that the library need not see whole."""
        if len(self.known) > CACHED_PIECES:
            self.known.forget()
        pieces = [self.split(t if self.keeps_blanks else t.lower()) for t in texts]
        ends = np.cumsum([len(p) for p in pieces])
        if not ends[-1]:
            return [np.zeros(0, np.uint32) for _ in texts]
        numbers = np.fromiter((n for p in pieces for n in map(self.known.__getitem__, p)), np.int64, int(ends[-1]))
        ids, lengths = self.known.gathered(numbers)
        return np.split(ids, np.concatenate([[0], np.cumsum(lengths)])[ends[:-1]])

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text as the library gives them, without added special tokens."""
        if UNSURE.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate([self._group([part])[0] for part in segments(text)])

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order; a null text counts as empty."""
        group: list[str] = []
        held = 0
        for text in texts:
            text = text or ""
            if len(text) > SEGMENT_CHARS or UNSURE.search(text):
                if group:
                    yield from self._group(group)
                    group, held = [], 0
                yield self.encode(text)
                continue
            group.append(text)
            held += len(text)
            if held > SEGMENT_CHARS:
                yield from self._group(group)
                group, held = [], 0
        if group:
            yield from self._group(group)
