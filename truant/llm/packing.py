"""Packing of documents into token sequences: bounded-space online best fit.

A task reads its documents once and keeps at most ``windows`` open sequences.
Whole lengths of ``length`` tokens leave at once; the rest of a document goes
into the open window that it fills best.  If it fits nowhere, the fullest
window is emitted, filled up first with a cut of the piece if its gap is worth
one.  The windows still open at the end of a task are leftovers: they are
merged, ``fan_in`` tasks at a time, by best fit of the pieces in decreasing
order, until one group is left.  A merge passes on ``windows`` open windows at
most, so no task holds more than ``fan_in * windows`` of them at any size of
the input.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truant.llm._common import written

LENGTH = 2048
WINDOWS = 64
FAN_IN = 16
MIN_CUT = 8
CACHE = 400_000
END_ID = 1

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, "
          "sequence_id long, offset long, open boolean")

#: A run of white space that a cut before each single space would divide otherwise than the tokenizer does.
_UNEVEN = re.compile(r"\s (?:\s|$)")


class _Words(dict):
    """Little-endian ids by word, for the first CACHE words met."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(word), "<u4").tobytes()
        if len(self) < CACHE:
            self[word] = ids
        return ids


def encoder(tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None) -> Callable[[str], bytes]:
    """text -> ids of the tokenizer at ``tokenizer_path``, as little-endian unsigned 32-bit numbers.

    With ``ranks_path`` (the same byte-level vocabulary as ranks) and its split
    ``pattern``, single words are encoded by the faster library, to the same ids.
    As the pattern begins a token at a space, words are encoded one by one and
    remembered.  Texts that hold a special token's string, or uneven white
    space, are encoded whole.
    """
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def slow(text: str) -> list[int]:
        return whole.encode(text, add_special_tokens=False).ids

    quick = slow
    if ranks_path:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        quick = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    words = _Words(quick)

    def encode(text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in special):
            return np.array(slow(text), "<u4").tobytes()
        if _UNEVEN.search(text):
            return np.array(quick(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return words[first] + b"".join(map(words.__getitem__, [" " + x for x in rest])) if first else b"".join(map(words.__getitem__, [" " + x for x in rest]))

    return encode


class Packer:
    """Open windows of one task, ordered by their free space."""

    def __init__(self, length: int, windows: int, first_id: int, min_cut: int = MIN_CUT):
        self.length, self.windows, self.next_id, self.min_cut = length, windows, first_id, min_cut
        self.free: list[tuple[int, int]] = []  # (free tokens, sequence id) of the open windows, ascending

    def new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _put(self, at: int, size: int) -> tuple[int, int]:
        free, seq = self.free.pop(at)
        if free > size:
            insort(self.free, (free - size, seq))
        return seq, self.length - free

    def place(self, size: int) -> list[tuple[int, int, int]]:
        """(size, sequence, offset) of the parts that ``size`` < length tokens go to."""
        out = []
        at = bisect_left(self.free, (size, -1))
        if at == len(self.free) and len(self.free) >= self.windows:  # it fits nowhere: emit the fullest
            gap = self.free[0][0]
            if gap >= self.min_cut and size - gap >= self.min_cut:
                out.append((gap, *self._put(0, gap)))
                size -= gap
                at = bisect_left(self.free, (size, -1))
            else:
                self.free.pop(0)
                at = len(self.free)
        if at == len(self.free):
            insort(self.free, (self.length, self.new()))
            at = len(self.free) - 1
        out.append((size, *self._put(at, size)))
        return out


def _pack_task(load: Callable[[], Callable[[str], bytes]], length: int, windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = load(), TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        packer = Packer(length, windows, part << 32)
        still: dict[int, list[tuple]] = {}  # pieces in the open windows

        def out(rows: list[tuple], is_open: bool) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            cols = [*cols[:5], [part] * len(rows), *cols[5:7]]
            arrays = [pa.array(c, pa.int64()) for c in cols] + [pa.array([is_open] * len(rows), pa.bool_())]
            return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in PIECES.split(", ")])

        for b in batches:
            done = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(t.as_py() or "") + end
                n, start = len(ids) // 4, 0

                def piece(size, seq, offset, doc=doc, ids=ids, n=n):
                    return doc, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), n, seq, offset

                while n - start >= length:
                    done.append(piece(length, packer.new(), 0))
                    start += length
                if n > start:
                    for size, seq, offset in packer.place(n - start):
                        still.setdefault(seq, []).append(piece(size, seq, offset))
                        start += size
            stays = {seq for _, seq in packer.free}
            for seq in [s for s in still if s not in stays]:
                done += still.pop(seq)
            yield out(done, False)
        yield out([x for rows in still.values() for x in rows], True)

    return run


def _merge(length: int, windows: int, fan_in: int, level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "sequence_id", "offset"], ascending=False, ignore_index=True)
        packer = Packer(length, len(rows) + 1, (level << 56) + (key[0] << 32))
        places = [packer.place(n)[0][1:] for n in rows["length"].tolist()]
        rows["sequence_id"], rows["offset"] = zip(*places, strict=True)
        carried = {seq for _, seq in packer.free[-windows:]}
        rows["open"] = rows["sequence_id"].isin(carried)
        rows["part"] = key[0]
        return rows[[x.split()[0] for x in PIECES.split(", ")]]

    return run


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, windows: int = WINDOWS, fan_in: int = FAN_IN) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all rows of ``docs``.

    A document's tokens are its ids and then END_ID, so a null or empty text is
    one token.  A null id stays null; repeated rows are packed as often as they
    come.  An empty table gives no piece.  Other columns are not read.
    """
    def load() -> Callable[[str], bytes]:
        return encoder(tokenizer_path, ranks_path, pattern)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    level = written(rows.mapInArrow(_pack_task(load, length, windows), PIECES), "pack-0")
    out, k = level.filter("not open"), 0
    while True:
        left = level.filter("open")
        last = left.agg(F.max("part")).first()[0]
        if last is None or (k and last == 0):
            break
        k += 1
        group = F.floor(F.col("part") / fan_in).cast("long")
        level = written(left.groupBy(group.alias("g")).applyInPandas(_merge(length, windows, fan_in, k), PIECES), f"pack-{k}")
        out = out.union(level.filter("not open"))
    return out.union(level.filter("open")).drop("part", "open")
