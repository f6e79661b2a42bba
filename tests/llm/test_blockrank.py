import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from truant.llm import blockrank
from truant.llm.blockrank import Queries, cut_list, terms_of


def terms(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def slow(docs, items, k=20):
    held = [(d, Counter(terms(t))) for d, t in docs if d is not None and t is not None and terms(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for i, text in sorted({x for x in items if None not in x}):
        scored = []
        for d, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def some(n, seed=3):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "naïve", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(d, " ".join(pick.choices(vocabulary, weights, k=pick.randint(1, 60)))) for d in range(n)]


EDGES = [(1000, None), (1001, ""), (1002, "--- !!"), (None, "w250 w251"), (1003, "ÉTÉ w299 w299"), (1004, " ".join(["w1"] * 60_000) + " w299"), (1003, "other w299")]
ITEMS = [(1, "W0, w1 w250; w250 été"), (2, "w299"), (3, ""), (4, None), (None, "w1"), (5, "unknown terms only"), (1, "W0, w1 w250; w250 été"),
         (6, "w0 " * 400 + "w299"), (7, "w0")]


@pytest.mark.parametrize("block, segment, group", [(128, 2048, 50_000), (3, 16, 50_000), (5, 40, 8)])
def test_against_brute_force(docs_of, llm_spark, block, segment, group):
    rows = some(400) + EDGES + [(2000 + i, "w250 w1 same text") for i in range(40)]  # ties beyond k
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as rank", "3 as score", "4 as q")
    assert rows_of(blockrank.ranked(docs_of(rows), items, block=block, segment=segment, terms_a_group=group)) == slow(rows, ITEMS)


def test_empty_tables(docs_of, llm_spark):
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string")
    none = llm_spark.createDataFrame([], "item_id long, text string")
    assert blockrank.ranked(docs_of([]), items).count() == 0
    assert blockrank.ranked(docs_of(some(5)), none).count() == 0
    assert blockrank.ranked(docs_of([(1, None), (2, "")]), items).count() == 0


def test_bounds_hold_and_blocks_are_skipped(docs_of, llm_spark):
    """Every block's bound is no less than its documents' scores; a query for a rare theme leaves most blocks out."""
    themes = [(1000 * k + i, " ".join(f"t{k}x{j}" for j in random.Random(1000 * k + i).choices(range(20), k=15)) + " common") for k in range(8) for i in range(100)]
    queries = Queries([(1, "t3x1 t3x2 t3x3 t3x4 common")])
    sc = llm_spark.sparkContext
    bq = sc.broadcast(queries)
    rows = blockrank.vectors(docs_of(themes), bq)
    bstats = sc.broadcast(blockrank.statistics(rows, len(queries.vocabulary)))
    index = blockrank.build_index(blockrank.signatures(rows, bq, bstats), bq, bstats, block=10, segment=400).collect()
    weights = queries.weights(bstats.value.weights)
    blocks = reached = 0
    best = sorted((r[3] for r in slow(themes, [(1, "t3x1 t3x2 t3x3 t3x4 common")])), reverse=True)[-1]
    for row in index:
        seg = blockrank.Segment({k: np.array(v) for k, v in row.asDict().items()}, queries, weights)
        found, score = seg.scores(0, np.ones(len(seg.ids), bool))
        whole = dict(zip(found.tolist(), score.tolist(), strict=True))
        for bounds, first in seg.blocks[0]:
            for i, bound in enumerate(bounds.tolist()):
                assert bound >= max(whole.get(d, 0) for d in seg.members[first + i].tolist())
                blocks, reached = blocks + 1, reached + (bound >= best)
    assert reached < 0.6 * blocks


def test_sparse_summaries_are_the_dense_ones():
    doc, terms_, impact = np.array([0, 0, 1, 2, 2, 2]), np.array([1, 5, 5, 0, 1, 7]), np.array([10, 3, 9, 4, 12, 6], np.int32)
    assert blockrank._maxima(np.array([0, 2]), doc, terms_, impact, np.array([0, 1, 5, 6])).tolist() == [4, 12, 3, 0]


def test_blocks_hold_each_posting_once():
    sig = np.random.default_rng(2).integers(0, 1 << 63, 1000).astype(np.uint64)
    sig[:500] = 7  # a large group of copies
    docs = np.arange(0, 1000, 1)
    parts = cut_list(docs, sig, 64)
    assert sorted(np.concatenate(parts).tolist()) == docs.tolist() and max(map(len, parts)) <= 64


def test_terms():
    text = "Ab-c9_é\x7fÀÉ\x00z　q"
    assert [t.decode() for t in terms_of(text.encode())] == terms(text)
