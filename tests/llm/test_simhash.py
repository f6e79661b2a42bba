import re

import numpy as np
import pytest
import xxhash

from truant.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, bits=2):
    """{id: least id reachable} of (id, fingerprint) pairs."""
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    ids = {}
    for (i, _), r in zip(fps, root, strict=True):
        ids.setdefault(r, []).append(i)
    return {i: min((x for x in ids[r] if x is not None), default=None) for (i, _), r in zip(fps, root, strict=True)}


TEXTS = ["", None, "One", "two words", "A b\tC d\x0be", "a B c\nd e", "x " * 20_000, "Ünï Écõ Ñ 漢字 a", "\x1f odd \x85 spaces\xa0here"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_the_majority_of_the_hashes(text):
    assert simhash.fingerprint((text or "").encode()) == slow_fingerprint(text)


def test_documents_against_brute_force(docs_of):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(words[:k] + ["zz"] + words[k + 1 :])) for i, k in enumerate(range(0, 300, 6))]  # near copies
    rows += [(200 + i, " ".join(words[i : i + 30])) for i in range(20)]
    rows += [(5, "a B c\nd e"), (None, "a b c d e")]  # a repeated row, and a copy without an id
    got = simhash.near_duplicates(docs_of(rows)).collect()
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    want = slow_components(fps)
    assert sorted((r.doc_id or -1, int(r.fingerprint, 16)) for r in got) == sorted((i or -1, f) for i, f in fps)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {i: c for i, c in want.items() if i is not None}
    assert len({c for c in want.values()}) < len(want) - 10


@pytest.mark.parametrize("max_block", [512, 8])
def test_a_chain_and_a_dense_block(llm_spark, max_block):
    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    near = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (60, 2))}
    chain = [base ^ ((1 << 40) - 1)]
    for bit in range(0, 40, 2):
        chain.append(chain[-1] ^ (3 << bit))
    fps = sorted(near | set(chain) | {int(x) for x in rng.integers(0, 1 << 63, 50)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    forest = simhash.links(llm_spark.createDataFrame([(x,) for x in signed], "fp long"), 2, max_block).collect()
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 2 for r in forest)
    root = {x: x for x in signed}

    def find(x):
        return x if root[x] == x else find(root[x])

    for r in forest:
        root[find(r.a)] = find(r.b)
    want = slow_components(list(zip(signed, fps, strict=True)))
    assert len({find(x) for x in signed}) == len(set(want.values()))
    assert all(find(a) == find(want[a]) for a in signed)


def test_coordinate_difference_never_discards_a_link():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    fp = np.concatenate([fp, fp ^ np.uint64(5)])
    table = np.bitwise_count(fp[:, None] ^ np.array(simhash.pivots(), np.int64).view(np.uint64)[None, :]).astype(np.uint8)
    assert len(simhash.block_forest(np.zeros(600, np.int64), fp, table, 2)) >= 300


def test_empty_table_and_keep_one(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    rows = [(3, "same text of four"), (1, "same text of four"), (1, "same text of four"), (2, ""), (4, None), (None, "same text of four")]
    kept = simhash.keep_one(docs_of(rows))
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "same text of four"), (1, "same text of four"), (2, "")]
    assert kept.columns == docs_of(rows).columns
    assert simhash.keep_one(docs_of([])).count() == 0
