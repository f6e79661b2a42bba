"""A cuckoo filter whose inserts, lookups and deletes work on whole numpy arrays."""

from __future__ import annotations

import io

import numpy as np

SLOTS = 4
#: A table takes keys up to this share of its slots; then a second, larger one is opened.
LOAD = 0.8


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Table:
    def __init__(self, buckets: int, cells: np.ndarray | None = None):
        self.cells = np.zeros((buckets, SLOTS), np.uint16) if cells is None else cells
        self.mask = np.uint64(buckets - 1)

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tag = (keys >> np.uint64(48)).astype(np.uint16)
        return np.where(tag == 0, np.uint16(1), tag), (_mix(keys) & self.mask).astype(np.int64)

    def _other(self, tag: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return ((bucket.astype(np.uint64) ^ _mix(tag.astype(np.uint64))) & self.mask).astype(np.int64)

    def free(self) -> int:
        return int(self.cells.size * LOAD) - int(np.count_nonzero(self.cells))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        tag, b = self._place(keys)
        return (self.cells[b] == tag[:, None]).any(axis=1) | (self.cells[self._other(tag, b)] == tag[:, None]).any(axis=1)

    def _fill(self, tag: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Put tags into free slots of their buckets; returns which found one."""
        order = np.argsort(b, kind="stable")
        at = b[order]
        nth = np.arange(len(at)) - np.searchsorted(at, at)
        empty = self.cells[at] == 0
        took = nth < empty.sum(axis=1)
        slot = np.argmax(np.cumsum(empty, axis=1) > nth[:, None], axis=1)
        self.cells[at[took], slot[took]] = tag[order[took]]
        done = np.zeros(len(b), bool)
        done[order[took]] = True
        return done

    def insert(self, keys: np.ndarray) -> bool:
        """False, with the table as before, if the keys can't all be placed."""
        tag, b = self._place(keys)
        before, rng = self.cells.copy(), np.random.default_rng(0)
        for _ in range(500):
            for _side in range(2):
                done = self._fill(tag, b)
                tag, b = tag[~done], b[~done]
                b = self._other(tag, b)
            if not len(tag):
                return True
            _, first = np.unique(b, return_index=True)  # in each full bucket one tag takes another's place
            slot = rng.integers(0, SLOTS, len(first))
            out = self.cells[b[first], slot]
            self.cells[b[first], slot] = tag[first]
            tag[first] = out
            b[first] = self._other(out, b[first])
            filled = tag != 0
            tag, b = tag[filled], b[filled]
        self.cells = before
        return False

    def delete(self, keys: np.ndarray) -> np.ndarray:
        """Remove one copy of each key's tag; returns for which keys there was one."""
        tag, b = self._place(keys)
        gone = np.zeros(len(keys), bool)
        for _side in range(2):
            order = np.lexsort((tag, b))
            cell = b[order] * 65536 + tag[order]
            nth = np.arange(len(cell)) - np.searchsorted(cell, cell)
            same = self.cells[b[order]] == tag[order][:, None]
            hit = (nth < same.sum(axis=1)) & ~gone[order]
            slot = np.argmax(np.cumsum(same, axis=1) > nth[:, None], axis=1)
            self.cells[b[order][hit], slot[hit]] = 0
            gone[order[hit]] = True
            b = self._other(tag, b)
        return gone


class CuckooFilter:
    """Approximate set of 64-bit keys: no false negatives; a false positive rate of about 2 * SLOTS / 65536 a table."""

    def __init__(self, capacity: int = 1024):
        self.tables = [_Table(self._buckets(capacity))]

    @staticmethod
    def _buckets(capacity: int) -> int:
        return 1 << max(2, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * LOAD)))))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        for t in self.tables:
            out |= t.contains(keys)
        return out

    def insert(self, keys: np.ndarray) -> None:
        """Add keys that the caller knows to be new."""
        take = max(0, self.tables[-1].free())
        now, later = keys[:take], keys[take:]
        if len(now) and not self.tables[-1].insert(now):
            later = keys
        if len(later):
            self.tables.append(_Table(self._buckets(max(len(later) * 2, 2 * SLOTS * len(self.tables[-1].cells)))))
            self.insert(later)

    def delete(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted before."""
        for t in self.tables:
            keys = keys[~t.delete(keys)]

    def dumps(self) -> bytes:
        f = io.BytesIO()
        np.savez_compressed(f, *[t.cells for t in self.tables])
        return f.getvalue()

    @classmethod
    def loads(cls, blob: bytes) -> CuckooFilter:
        out = cls()
        with np.load(io.BytesIO(blob)) as f:
            out.tables = [_Table(len(f[k]), f[k]) for k in f.files]
        return out
