"""Whole texts as chunks between ASCII white space, interned once per Python worker.

Neither the normalisation nor the pre-tokenisation of the word-level tokenizer reaches across
space and 0x09-0x0D, so a text's ids are its chunks' ids in order.  A-Z is lower-cased first
(the tokenizer lower-cases anyway) unless the text holds the start of a special token, which
is matched with its case.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from vinculum.llm.common import SLICE_BYTES
from vinculum.llm.shingles import text_buffer

_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: The tokenizer's pre-tokenization of lower-case printable ASCII.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\x09-\x0d\x20]+")
#: Distinct chunks a worker holds at most; beyond, and when a task ends, it keeps those it has
#: met often (results don't depend on it).
KEPT_CHUNKS = 400_000
#: Times a chunk was met that make it worth keeping.
OFTEN = 3


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def chunks(text: bytes) -> list[bytes]:
    return (text if b"<|" in text else text.lower()).split()


def parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about SLICE_BYTES, cut at white space."""
    lo = 0
    while lo < len(text):
        gap = _GAP.search(text, lo + SLICE_BYTES)
        hi = gap.end() if gap else len(text)
        yield text[lo:hi]
        lo = hi


class Interned(dict):
    """chunk -> position; chunks not met before are gathered in `new`."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = at = len(self)
        self.new.append(chunk)
        return at


class ChunkIds:
    """Ids of chunks, kept as flat arrays; a subclass says how new chunks get theirs."""

    def __init__(self) -> None:
        self.reset()

    def found(self, chunks: list[bytes]) -> tuple[list[int], list[int]]:
        """Ids of all the chunks in one list, and how many each has."""
        raise NotImplementedError

    def reset(self) -> None:
        self.at = Interned()
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.empty(0, np.int64)
        self.lens = np.empty(0, np.int64)
        self.met = np.empty(0, np.int64)

    def shrink(self) -> None:
        """Forget the chunks that were met less than OFTEN times since the last call, or still
        less than makes half of KEPT_CHUNKS."""
        least = OFTEN
        while (keep := np.flatnonzero(self.met >= least)).size > KEPT_CHUNKS // 2:
            least *= 2
        chunks, lens = list(self.at), self.lens[keep]
        ends = np.concatenate([[0], np.cumsum(lens)])
        flat = self.flat[np.repeat(self.starts[keep] - ends[:-1], lens) + np.arange(ends[-1])]
        self.reset()
        for at, i in enumerate(keep.tolist()):
            self.at[chunks[i]] = at
        self.flat = np.concatenate([flat, self.flat])
        self.used, self.starts, self.lens, self.met = len(flat), ends[:-1], lens, np.zeros(len(lens), np.int64)

    def _learn(self) -> None:
        new, self.at.new = self.at.new, []
        if not new:
            return
        found, counts = self.found(new)
        lens = np.array(counts, np.int64)
        end = self.used + len(found)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(max(end, 2 * len(self.flat)) - self.used, np.uint32)])
        self.flat[self.used : end] = found
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.met = np.concatenate([self.met, np.zeros(len(lens), np.int64)])
        self.used = end

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in order, and the n + 1 offsets of each chunk's ids."""
        if len(self.at) > KEPT_CHUNKS:
            self.shrink()
        at = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        self._learn()
        self.met += np.bincount(at, minlength=len(self.met))
        lens = self.lens[at]
        ends = np.concatenate([[0], np.cumsum(lens)])
        return self.flat[np.repeat(self.starts[at] - ends[:-1], lens) + np.arange(ends[-1])], ends


class LibraryIds(ChunkIds):
    """Ids by the tokenizers library."""

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer(path)
        self.normalise = self.tokenizer.normalizer.normalize_str
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.tokenize = self.tokenizer.model.tokenize
        self.marks: dict[str, list[int]] = {}
        super().__init__()

    def found(self, chunks: list[bytes]) -> tuple[list[int], list[int]]:
        ids: list[int] = []
        counts = []
        for chunk in chunks:
            of = self.of(chunk)
            ids += of
            counts.append(len(of))
        return ids, counts

    def of(self, chunk: bytes) -> list[int]:
        """Ids of one chunk.  Without special tokens the library's model takes the pre-tokenized
        pieces, which for printable ASCII a pattern finds; that spares an encoding per chunk."""
        text = chunk.decode()
        if "<|" in text:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if text.isascii() and text.isprintable():
            pieces = (text,) if text.isalpha() and text.islower() else PIECE.findall(text.lower())
        else:
            pieces = [p for p, _ in self.split(self.normalise(text))]
        out: list[int] = []
        for piece in pieces:
            if piece.isalpha():
                out += [t.id for t in self.tokenize(piece)]
            else:  # marks and digits repeat
                if piece not in self.marks:
                    if len(self.marks) > 4096:
                        self.marks.clear()
                    self.marks[piece] = [t.id for t in self.tokenize(piece)]
                out += self.marks[piece]
        return out


@functools.lru_cache(maxsize=2)
def chunk_ids(path: str) -> LibraryIds:
    return LibraryIds(path)


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text (nulls empty)."""
    buf, offsets = text_buffer(column)
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield buf[lo:hi].tobytes()


def text_ids(column: pa.Array, table: ChunkIds) -> Iterator[np.ndarray]:
    """The ids of each text of a slice (see common.slices); a very long text goes in parts."""
    texts = list(texts_of(column))
    if len(texts) == 1 and len(texts[0]) > 2 * SLICE_BYTES:
        yield np.concatenate([table.ids(chunks(p))[0] for p in parts(texts[0])])
        return
    words: list[bytes] = []
    ends = [0]
    for text in texts:
        words += chunks(text)
        ends.append(len(words))
    ids, offsets = table.ids(words)
    borders = offsets[ends].tolist()
    for lo, hi in zip(borders[:-1], borders[1:]):
        yield ids[lo:hi]
