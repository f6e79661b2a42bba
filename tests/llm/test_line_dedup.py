import hashlib
from collections import defaultdict

import numpy as np

from truant.llm import line_dedup
from truant.llm.cuckoo import CuckooFilter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows):
    """[(doc_id, kept text, lines, dropped)] by the rule itself."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


ROWS = [
    (5, "a shared line here\nown line of five\nshort"), (3, "  A Shared LINE here\t\nshort"), (9, "a shared line here\na shared line here"),
    (1, None), (2, ""), (4, "\n\n"), (6, "short\nshort"), (7, "twice inside\ntwice inside"), (8, "ééééééééé1\nü"), (10, "ééééééééé1"),
    (11, "exactly 10\n123456789"), (12, "exactly 10\n123456789"), (None, "a shared line here"), (5, "a shared line here\nown line of five\nshort"),
    (13, "x" * 200_000), (14, "x" * 200_000 + "\r"),
]


def got(index, df):
    return sorted((r.doc_id or -1, r.kept.text, r.kept.n_lines, r.kept.n_dropped) for r in index.apply(df).collect())


def want(rows):
    return sorted((i or -1, *x) for i, *x in slow(rows))


def test_against_brute_force(docs_of):
    df = docs_of(ROWS)
    assert got(line_dedup.dedup(df, shards=4), df) == want(ROWS)
    cleaned = line_dedup.clean(df, shards=4)
    assert cleaned.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in cleaned.collect()) == [x[:2] for x in want(ROWS)]


def test_empty_table(docs_of):
    df = docs_of([])
    assert got(line_dedup.dedup(df, shards=2), df) == []


def test_inserts_and_deletes_are_reversible(llm_spark, docs_of):
    rng = np.random.default_rng(0)
    lines = [f"a line with number {i}" for i in range(60)]
    rows = [(i, "\n".join(lines[j] for j in rng.integers(0, 60, 6))) for i in range(40)]
    first, second = docs_of(rows[:25]), docs_of(rows[25:])
    one = line_dedup.LineIndex.empty(llm_spark, shards=3).insert(first)
    both = one.insert(second)
    assert got(both, docs_of(rows)) == want(rows)
    back = both.delete(docs_of(rows[25:]).select("doc_id"))
    assert got(back, first) == want(rows[:25]) == got(one, first)
    gone = [0, 3, 7, 30]
    rest = [r for r in rows if r[0] not in gone]
    some = both.delete(llm_spark.createDataFrame([(i,) for i in [*gone, 999, None]], "doc_id long"))
    assert got(some, docs_of(rest)) == want(rest)
    assert got(some.insert(docs_of([r for r in rows if r[0] in gone])), docs_of(rows)) == want(rows)


def colliding_lines():
    """Two lines with one tag and one bucket in a filter of the least size."""
    seen = {}
    table = CuckooFilter(2).tables[0]
    for i in range(200_000):
        line = f"line number {i}"
        key = np.frombuffer(line_dedup.line_digest(line)[:8], "<u8")
        tag, bucket = table._place(key)
        pair = int(tag[0]), min(int(bucket[0]), int(table._other(tag, bucket)[0]))
        if pair in seen:
            return seen[pair], line
        seen[pair] = line


def test_insert_delete_insert_with_equal_tags(llm_spark, docs_of):
    a, b = colliding_lines()
    one = line_dedup.LineIndex.empty(llm_spark, shards=1).insert(docs_of([(1, a)]))
    two = one.insert(docs_of([(2, b)]))  # b is a false positive
    left = two.delete(docs_of([(1, a)]).select("doc_id"))
    back = left.insert(docs_of([(3, b), (4, a)]))
    assert [(r.refs, r.owner) for r in back.repeated().collect()] == [(2, 2)]
    rows = [(2, b), (3, b), (4, a)]
    assert got(back, docs_of(rows)) == want(rows)


def test_filter_knows_what_it_holds():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 60_000).astype(np.uint64)
    f = CuckooFilter(500)  # grows by further tables
    for part in np.array_split(keys, 7):
        f.insert(part[~f.contains(part)])
    assert f.contains(keys).all()
    others = rng.integers(0, 1 << 63, 60_000).astype(np.uint64)
    assert f.contains(others).mean() < 0.005
    f = CuckooFilter.loads(f.dumps())
    assert f.contains(keys).all()


def test_filter_deletes():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 63, 5_000).astype(np.uint64)
    f = CuckooFilter(5_000)
    f.insert(keys)
    f.delete(keys[:3_000])
    assert f.contains(keys[3_000:]).all()
    assert f.contains(keys[:3_000]).mean() < 0.01
    f.delete(keys[3_000:])
    assert not any(t.cells.any() for t in f.tables)


def test_digest_is_of_the_key():
    assert line_dedup.line_digest(" \tTen Chars 1\r") == hashlib.sha256(b"ten chars 1").digest()[:16]
    assert line_dedup.line_digest(" 123456789 ") is None
