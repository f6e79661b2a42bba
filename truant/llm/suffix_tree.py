"""Language model scoring with a probabilistic suffix tree over words.

A state of the tree is a context, the last words before the next symbol.
Contexts of length d that occur MIN_CONTEXT times in the training texts are
counted over the whole corpus, d = 1 .. DEPTH.  A context is retained if its
next-symbol distribution diverges from that of its longest proper suffix by more
than the number of its entries justifies (likelihood gain over half the
logarithm of the tokens an entry).  A retained state keeps the next symbols that
occur with it MIN_ENTRY times; what they leave, and MU tokens more, goes to the
suffix's distribution:

    P(x | s) = (n(s, x) + (n(s) - kept(s) + MU) * P(x | suffix(s))) / (n(s) + MU)

with n(s, x) = 0 for symbols that aren't kept.  At the root stands the smoothed
unigram distribution of all words.  A token is scored in the longest retained
suffix of its history.

The limits are counts, not shares, so the tree grows with the corpus and is
never in one place.  Texts lie in chunks of about CHUNK tokens; the counts of a
level in buckets by context, each for about BUCKET tokens.  Per level, a chunk
asks each bucket for its distinct pairs (context, next symbol) with the number
of times they occur in its training texts and P(next symbol | suffix).  Symbols
that the suffix does not keep cannot be entries: a context's are one pair.  The
bucket adds them up, judges its contexts and answers with the pair's count and
the context's sums, from which the chunk has P(next symbol | context) and knows
which of its contexts are long enough for the next level.  Pairs of contexts
that occur more than HOT times are dealt to the buckets in SPREAD parts, which
the buckets add up; these contexts, n / HOT at most, are judged by the sums.

Words and contexts go by 64-bit hashes: among 1e9 pairs two share one with a
probability of 3 %.  A context's symbols go to the buckets by 48 bits: two of a
million share them with a probability of 0.2 %.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truant.llm._common import written

DEPTH = 3
MIN_CONTEXT = 16
MIN_ENTRY = 2
MU = 5.0
ADD = 0.1
#: Bits of a symbol in a key (state << BITS | symbol) of a SuffixTree.
BITS = 24
ANY = (1 << BITS) - 1
#: Tokens of a chunk, and those that a bucket is for.
CHUNK = 1_000_000
BUCKET = 2_000_000
MIN_BUCKETS = 8
#: Contexts that occur more often are dealt to many buckets,
HOT = 200_000
#: in so many parts.
SPREAD = np.uint64(1024)
#: Questions are asked of so many parts of the buckets, one after the other, and answers told to so many parts of
#: the chunks: a part's shuffle files go before the next part's are written, and a part's old states after its new ones.
ASKED_IN = 4
TOLD_IN = 4
#: The symbol after a text's last word; no word's hash is 0.
END = np.uint64(0)
#: What all symbols are that cannot be entries of a context; as good as no word's hash is this.
REST = np.uint64(0xFFFFFFFFFFFFFFFF)


def tokens(text: bytes) -> list[bytes]:
    """Words of [^\x20\x09-\x0D], A-Z lower-cased."""
    return text.lower().split()


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key, -1 where it is missing."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _keys(state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Keys of pairs; -1 where either is missing."""
    return np.where((state >= 0) & (symbol >= 0), state << BITS | symbol, -1)


def _judge(own: np.ndarray, kept: np.ndarray, left: np.ndarray, gain: np.ndarray, entries: np.ndarray, n: int) -> np.ndarray:
    """Which contexts are retained.

    ``own``: times the context occurs; ``kept``, ``left``, ``gain`` and
    ``entries``: sums of c, low, c * log(c / low) and 1 over its entries.
    """
    rest = own - kept
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gain - np.where(kept > 0, kept * np.log(own), 0)
        gain = gain + np.where(rest > 0, rest * np.log(rest / own / np.maximum(1 - left, 1e-12)), 0)
    return gain > 0.5 * np.log(max(n, 2)) * entries


@dataclass
class Level:
    """Contexts of one length, in the order of their keys (state of all but the last word, last word)."""

    contexts: np.ndarray
    suffix: np.ndarray
    retained: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    backoff: np.ndarray = field(default_factory=lambda: np.zeros(0))
    entries: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    p: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass
class SuffixTree:
    """A tree in memory, to check the rule by. ``root``: probability of each symbol; ``levels``: the states by length."""

    root: np.ndarray
    end: int
    levels: list[Level] = field(default_factory=list)

    def probability(self, depth: int, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """P(symbol | state) of states of one length."""
        if not depth or not len(state):
            return self.root[symbol]
        level = self.levels[depth - 1]
        low = self.probability(depth - 1, level.suffix[state], symbol)
        at = _find(level.entries, _keys(state, symbol))
        kept = level.p[at] if len(level.p) else np.zeros(len(at))
        high = np.where(at >= 0, kept, level.backoff[state] * low)
        return np.where(level.retained[state], high, low)

    def add_level(self, counts: dict[str, np.ndarray], n: int) -> None:
        """Retain the states of the last level whose distribution diverges; counts: key and n, ANY for a state's own count."""
        level, depth = self.levels[-1], len(self.levels)
        size = len(level.contexts)
        state, symbol = counts["key"] >> BITS, counts["key"] & ANY
        own = np.zeros(size)
        own[state[symbol == ANY]] = counts["n"][symbol == ANY]
        pairs = symbol != ANY
        order = np.argsort(counts["key"][pairs], kind="stable")
        key, state, symbol, c = (a[pairs][order] for a in (counts["key"], state, symbol, counts["n"]))
        low = self.probability(depth - 1, level.suffix[state], symbol)
        kept, left = np.bincount(state, c, size), np.bincount(state, low, size)
        rest = own - kept
        level.retained = _judge(own, kept, left, np.bincount(state, c * np.log(c / low), size), np.bincount(state, minlength=size), n)
        level.backoff = np.where(own > 0, (rest + MU) / (own + MU), 1.0)
        stay = level.retained[state]
        level.entries = key[stay]
        level.p = (c[stay] + (rest[state[stay]] + MU) * low[stay]) / (own[state[stay]] + MU)

    def grow(self, key: np.ndarray) -> None:
        """A level of contexts, given by sorted keys over the last level's states (0 at the root)."""
        if not self.levels:
            suffix = np.zeros(len(key), np.int64)
        else:
            last = self.levels[-1]
            above = self.levels[-2].contexts if len(self.levels) > 1 else None
            state, symbol = key >> BITS, key & ANY
            shorter = last.suffix[state]
            suffix = _find(last.contexts, _keys(shorter if above is not None else np.zeros_like(state), symbol))
        self.levels.append(Level(key, suffix))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _longer(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hash of a context with a symbol after it; different symbols of one context never share one."""
    return _mix(_mix(context) * np.uint64(0x9E3779B97F4A7C15) + symbol)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, a place of each, and which of them each key is; faster than np.unique."""
    order = np.argsort(keys)
    ordered = keys[order]
    begins = np.ones(len(keys), bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(begins) - 1
    return ordered[begins], order[begins], which


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays, compressed; integers by their bytes' places, as most are small."""
    def raw(a: np.ndarray) -> bytes:
        # copied by numpy first: tobytes of a transposed array goes byte by byte
        return (np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T) if a.dtype.kind == "i" and len(a) else a).tobytes()

    data = pickle.dumps({k: (a.dtype.str, raw(a)) for k, a in arrays.items()}, 5)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    data = pickle.loads(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True))
    out = {}
    for k, (kind, raw) in data.items():
        kind = np.dtype(kind)
        if kind.kind == "i":
            raw = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T)
        out[k] = np.frombuffer(raw, kind)
    return out


@dataclass(frozen=True)
class Limits:
    """Training tokens ``n``, ``buckets``, and the counts a frequent word, a context and an entry need."""

    n: int
    buckets: int
    word: float
    context: float
    entry: float
    hot: int


class _Places(dict):
    """Words to their numbers, in the order in which they are asked for; 0 is the end's."""

    def __init__(self):
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def encode(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk, tokens, state) of all rows, ``tokens`` the number of those to learn from.

    A state holds the documents (doc_id, null, held, size), the distinct words
    and the place x among them of each token.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                       F.coalesce(held_out, F.lit(True)).alias("held_out"))
    limit = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids, held, texts, size, places = [], [], [], 0, _Places()

        def out() -> pa.RecordBatch:
            sizes = np.array([len(t) for t in texts], np.int64)
            learned = int(sizes[~np.array(held, bool)].sum())
            words = [int(END), *(int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") or 1 for w in list(places)[1:])]
            state = _pack(doc_id=np.array([i or 0 for i in ids], np.int64), null=np.array([i is None for i in ids], bool),
                          held=np.array(held, bool), size=sizes, words=np.array(words, np.uint64), x=np.concatenate(texts))
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([learned], pa.int64()), pa.array([state], pa.binary())],
                                              ["chunk", "tokens", "state"])

        for b in batches:
            for i, text, h in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                words = tokens(text.as_py() or b"")
                x = np.zeros(len(words) + 1, np.int32)
                x[:-1] = list(map(places.__getitem__, words))
                ids.append(i)
                held.append(h)
                texts.append(x)
                size += len(x)
                if size >= limit:
                    yield out()
                    chunk, ids, held, texts, size, places = chunk + 1, [], [], [], 0, _Places()
        if texts:
            yield out()

    return rows.mapInArrow(run, "chunk long, tokens long, state binary")


@dataclass
class _Asked:
    """What a chunk asks a part of the buckets on a level, in their order: of each pair its first place, bucket and context.

    A place is a live position's number, on level 0 a word's.  ``places``: those
    that ask; ``which``: the pair of each.  ``cuts``, ``runs``: where a bucket,
    and a context in a bucket, begins.
    """

    places: np.ndarray
    contexts: np.ndarray
    first: np.ndarray
    bucket: np.ndarray
    which: np.ndarray
    pair: np.ndarray

    @classmethod
    def each(cls, s: dict[str, np.ndarray], depth: int, limits: Limits, these, parts: int) -> Iterator[tuple[int, _Asked]]:
        """Of ``these`` of ``parts`` parts, each with its number."""
        words, x = s["words"], s["x"]

        def pairs(places: np.ndarray) -> np.ndarray:
            return _longer(contexts[places], np.where(s["can"][places], words[x[at[places]]], REST))

        if depth == 0:
            contexts = by = words
        else:
            at = np.flatnonzero(s["live"])
            contexts = _mix(words)[x[at - depth]]
            for d in range(depth - 1, 0, -1):
                contexts = _longer(contexts, words[x[at - d]])
            by, hot = contexts, np.flatnonzero(s["hot"])
            if len(hot):
                by = by.copy()
                by[hot] = _longer(by[hot], pairs(hot) % SPREAD)
        by = _mix(by)
        bucket = ((by >> np.uint64(32)) * np.uint64(limits.buckets) >> np.uint64(32)).astype(np.int64)
        turn = bucket % parts
        for part in these:
            places = np.flatnonzero(turn == part)
            pair, first, which = _distinct(pairs(places) if depth else words[places])
            first = places[first]
            order = np.argsort(by[first])
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            first = first[order]
            yield part, cls(places, contexts[first], first, bucket[first], place[which], pair[order])

    @property
    def cuts(self) -> np.ndarray:
        return np.flatnonzero(np.diff(self.bucket, prepend=-1))

    @property
    def runs(self) -> np.ndarray:
        """True where a context begins."""
        out = np.diff(self.bucket, prepend=-1) != 0
        out[1:] |= self.contexts[1:] != self.contexts[:-1]
        return out


def _often(s: dict[str, np.ndarray], limits: Limits) -> np.ndarray:
    """Which of a chunk's words can be entries."""
    often = s["c"] >= limits.word
    often[0] = True  # the end
    return often


def _root(c: np.ndarray, limits: Limits, v: int) -> np.ndarray:
    """The unigram probability of words met ``c`` times; ``v``: words met in training."""
    return (c + ADD) / (limits.n + ADD * (v + 1))


def _low(s: dict[str, np.ndarray], depth: int, limits: Limits, v: int) -> np.ndarray:
    """P(symbol | suffix) at each live position."""
    return s["p"] if depth > 1 else _root(s["c"], limits, v)[s["x"][s["live"]]]


def _questions(depth: int, limits: Limits, part: int, parts: int, v: int):
    """States to (bucket, chunk, question), of one part of the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, state in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = _unpack(state.as_py())
                _, q = next(_Asked.each(s, depth, limits, [part], parts))
                learned = np.repeat(~s["held"], s["size"])
                if depth == 0:
                    n = np.bincount(s["x"][learned], minlength=len(s["words"]))[q.first]
                else:
                    n = np.bincount(q.which[learned[s["live"]][q.places]], minlength=len(q.first))
                rows = {"n": n.astype(np.int32), "pair": q.pair}
                if depth:
                    can = s["can"][q.first]
                    rows |= {"can": can, "pair": (q.pair >> np.uint64(16)).view(np.int64)}  # its two highest bytes are packed to nothing
                    if depth == 1:  # P(symbol) follows from the word's count
                        rows["count"] = np.where(can, s["c"][s["x"][s["live"]][q.first]], 0)
                    else:
                        rows["low"] = np.where(can, s["p"][q.first], 1.0)
                    begins, hot = q.runs, s["hot"][q.first]
                cuts, blobs = q.cuts, []
                for i, j in zip(cuts, np.append(cuts, len(q.bucket))[1:], strict=True):
                    asked = {k: a[i:j] for k, a in rows.items()}
                    if depth:
                        r = np.flatnonzero(begins[i:j])
                        asked |= {"context": q.contexts[i:j][r], "hot": hot[i:j][r], "run": np.diff(r, append=j - i).astype(np.int32)}
                    blobs.append(_pack(**asked))
                yield pa.RecordBatch.from_arrays([pa.array(q.bucket[cuts].astype(np.int32)), pa.array([chunk] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())],
                                                 ["bucket", "chunk", "question"])

    return run


ANSWER = "chunk long, bucket int, answer binary, context long, own double, kept double, left double, gain double, entries double"


def _answers(depth: int, limits: Limits, v: int):
    """All questions to a bucket, to its answers and, with a null chunk, the sums of hot contexts (on level 0 ``own``: words met)."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked = [_unpack(q) for q in rows["question"]]
        cuts = np.cumsum([len(q["n"]) for q in asked])[:-1]
        q = {k: np.concatenate([a[k] for a in asked]) for k in asked[0]}
        context_cuts = np.cumsum([len(a["run"]) for a in asked])[:-1] if depth else None
        asked.clear()
        pair = _longer(np.repeat(q["context"], q["run"]), q["pair"].view(np.uint64)) if depth else q["pair"]
        _, first, which = _distinct(pair)
        c = np.bincount(which, q["n"], len(first))
        answer = {"c": (c.astype(np.int64)[which], cuts)}
        sums = pd.DataFrame({"context": [0], "own": [float((c > 0).sum())]})
        if depth:
            contexts, _, of = _distinct(q["context"])
            low = _root(q["count"][first], limits, v) if depth == 1 else q["low"][first]
            state, size = np.repeat(of, q["run"])[first], len(contexts)
            entry = q["can"][first] & (c >= limits.entry)
            own, entries = np.bincount(state, c, size), np.bincount(state, entry, size)
            kept, left = np.bincount(state, c * entry, size), np.bincount(state, low * entry, size)
            gain = np.bincount(state, np.where(entry, c * np.log(np.where(entry, c / low, 1.0)), 0.0), size)
            retained = _judge(own, kept, left, gain, entries, limits.n)
            answer |= {"own": (own.astype(np.int64)[of], context_cuts), "kept": (kept.astype(np.int64)[of], context_cuts), "retained": (retained[of], context_cuts)}
            shared = np.bincount(of, q["hot"], size) > 0
            sums = pd.DataFrame({"context": contexts.view(np.int64), "own": own, "kept": kept, "left": left, "gain": gain, "entries": entries})[shared]
        parts = {k: np.split(v, at) for k, (v, at) in answer.items()}
        blobs = [_pack(**{k: v[i] for k, v in parts.items()}) for i in range(len(rows))]
        out = pd.DataFrame({"chunk": rows["chunk"], "bucket": key[0], "answer": blobs})
        names = [x.split()[0] for x in ANSWER.split(", ")]
        return pd.concat([out.reindex(columns=names).astype(object), sums.reindex(columns=names).astype(object)], ignore_index=True)

    return run


def _told(depth: int, last: bool, limits: Limits, v: int, hot, parts: int):
    """A state and its answers, to the state of the next level.

    It has the documents' sums of log10 P over the positions that are done.  Of
    those whose longer context is ``live`` it has p (on level 0 it follows from
    the words' counts), whether the pair ``can`` be an entry with the longer
    context, which it was with this one, and the words up to there.
    """

    def run(key: tuple, states: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        s = _unpack(states["state"].iloc[0])
        answers = answers.sort_values("bucket")
        starts, size = np.cumsum(s["size"]) - s["size"], len(s["x"])
        names = ("c", "own", "kept", "retained") if depth else ("c",)
        at = np.flatnonzero(s["live"]) if depth else np.arange(size)
        known = {k: np.zeros(len(at) if depth else len(s["words"]), np.int64) for k in names}
        for part, q in _Asked.each(s, depth, limits, range(parts), parts):
            if not len(q.places):
                continue
            told = [_unpack(a) for a in answers["answer"][answers["bucket"] % parts == part]]
            told = {k: np.concatenate([a[k] for a in told]) for k in names}
            known["c"][q.places] = told["c"][q.which]
            if depth:
                of = (np.cumsum(q.runs) - 1)[q.which]
                sums, shared = [told[k][of] for k in names[1:]], s["hot"][q.places]
                if shared.any():
                    contexts, *whole = hot.value
                    h = _find(contexts, q.contexts[q.which][shared].view(np.int64))
                    for mine, a in zip(sums, whole, strict=True):
                        mine[shared] = a[h]
                for k, a in zip(names[1:], sums, strict=True):
                    known[k][q.places] = a
        if depth == 0:
            s["c"] = known["c"]
            c, p = s["c"][s["x"]], _root(s["c"], limits, v)[s["x"]]
            s["base"], s["known"] = np.add.reduceat(np.log10(p), starts), np.add.reduceat((c > 0).astype(np.int64), starts)
            s["total"], entry, many = np.zeros(len(starts)), _often(s, limits)[s["x"]] & (c >= limits.entry), c >= limits.context
        else:
            low, c, own, kept = _low(s, depth, limits, v), *(known[k] for k in names[:3])
            entry = s["can"] & (c >= limits.entry)
            p = np.where(known["retained"] > 0, (np.where(entry, c, 0) + (own - kept + MU) * low) / (own + MU), low)
            many = s["can"] & (c >= max(limits.context, limits.entry))
        goes_on = many & (s["x"][at] != 0) & _often(s, limits)[s["x"][at]] & (not last)
        live, can, whole, counts = np.zeros(size, bool), np.zeros(size, bool), np.ones(size), np.zeros(size, np.int64)
        live[at[goes_on] + 1] = True
        counts[at[goes_on] + 1] = c[goes_on]
        whole[at], can[at] = p, entry
        s["total"] = s["total"] + np.add.reduceat(np.where(live, 0.0, np.log10(whole)), starts)
        if last:
            s = {k: s[k] for k in ("doc_id", "null", "held", "size", "base", "known", "total")}
        else:
            s |= {"live": live, "can": can[live], "hot": counts[live] > limits.hot}
            if depth:
                s["p"] = whole[live]
            _forget(s, depth + 1, limits)
        return pd.DataFrame({"chunk": [key[0]], "state": [_pack(**s)]})

    return run


def _forget(s: dict[str, np.ndarray], depth: int, limits: Limits) -> None:
    """Blank the words that neither are at a live position nor in its context; those too rare for an entry are one for each count."""
    rare = s["c"] < limits.entry
    rare[0] = False
    instead = np.arange(len(rare), dtype=np.int32)
    _, first, which = np.unique(s["c"][rare], return_index=True, return_inverse=True)
    instead[rare] = np.flatnonzero(rare)[first][which]
    asked = s["live"].copy()
    for d in range(1, depth + 1):
        asked[:-d] |= s["live"][d:]
    s["x"] = np.where(asked, instead[s["x"]], np.int32(0))
    used = np.zeros(len(s["words"]), bool)
    used[s["x"]] = True
    s["words"], s["c"] = np.where(used & ~rare, s["words"], END), np.where(used, s["c"], 0)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Within, a query's shuffle files go as soon as it has ended; every frame made within must be run once only."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _discard(df: DataFrame, part: int | None = None) -> None:
    """Delete the files of a written table, or of a part of one, that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if part is not None and not folder.endswith(f"/part={part}"):
            continue
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def levels(docs: DataFrame, held_out, id_col: str, text_col: str, depth: int, p_word: float, p_context: float, p_entry: float) -> tuple[DataFrame, int]:
    """(chunk, state) after the last level, and the training tokens."""
    with _shuffles_removed(docs.sparkSession):
        return _levels(docs, held_out, id_col, text_col, depth, p_word, p_context, p_entry)


def _levels(docs: DataFrame, held_out, id_col: str, text_col: str, depth: int, p_word: float, p_context: float, p_entry: float) -> tuple[DataFrame, int]:
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64("chunk"), F.lit(TOLD_IN)).cast("int").alias("part")
    tables = [written(encode(docs, held_out, id_col, text_col).select("*", part), "lm-encoded", "part", "none")]
    n = tables[0].agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    states = [tables[0].where(F.col("part") == p).select("chunk", "state") for p in range(TOLD_IN)]
    limits = Limits(n, max(MIN_BUCKETS, -(-n // BUCKET)), p_word * n, max(MIN_CONTEXT, p_context * n), max(MIN_ENTRY, p_entry * n), HOT)
    v, hot = 0, None
    for d in range(depth + 1):
        replies = []
        for a in range(ASKED_IN):
            questions = reduce(DataFrame.union, states).mapInArrow(_questions(d, limits, a, ASKED_IN, v), "bucket int, chunk long, question binary")
            replies.append(written(questions.groupBy("bucket").applyInPandas(_answers(d, limits, v), ANSWER).select("*", part), f"lm-answers-{d}", "part", "none"))
        answers = reduce(DataFrame.union, replies)
        sums = answers.filter("chunk is null").groupBy("context").agg(*[F.sum(c).alias(c) for c in ("own", "kept", "left", "gain", "entries")])
        sums = sums.orderBy("context").toPandas()  # n / HOT at most
        if d == 0:
            v = int(sums["own"].sum())
        else:
            a = {k: sums[k].to_numpy() for k in sums}
            retained = _judge(a["own"], a["kept"], a["left"], a["gain"], a["entries"], n)
            hot = spark.sparkContext.broadcast((a["context"], a["own"].astype(np.int64), a["kept"].astype(np.int64), retained))
        before, tables = tables, []
        for p, mine in enumerate(states):
            own = answers.where(F.col("part") == p).filter("chunk is not null").select("chunk", "bucket", "answer")
            told = mine.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInPandas(
                _told(d, d == depth, limits, v, hot, ASKED_IN), "chunk long, state binary")
            tables.append(written(told, f"lm-states-{d}", compression="none"))
            for table in [*replies, *([before[0]] if d == 0 else [])]:
                _discard(table, p)
            if d:
                _discard(before[p])
        states = tables
    return reduce(DataFrame.union, states), n


def score(states: DataFrame, n: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for state in b.column(0):
                s = _unpack(state.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["doc_id"], mask=s["null"]), pa.array(s["held"]), pa.array(s["size"]), pa.array(s["known"]),
                     pa.array(np.full(len(s["size"]), n, np.int64)), pa.array(s["base"]), pa.array(s["total"])],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return states.select("state").mapInArrow(run, schema)


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                    p_word: float = 0.0, p_context: float = 0.0, p_entry: float = 0.0) -> DataFrame:
    """Score every row of ``docs`` with a tree of the rows for which the column ``held_out`` is false.

    ``p_word``, ``p_context`` and ``p_entry`` ask further for these shares of the
    training tokens.  A null text is an empty one, whose only token is END; a row
    for which ``held_out`` is null (a null id) isn't learned from and counts as
    held out; repeated rows are learned and scored as often as they come.  An
    empty table gives an empty result.  Other columns are not read.
    """
    return score(*levels(docs, held_out, id_col, text_col, depth, p_word, p_context, p_entry))
