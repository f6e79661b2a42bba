import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from truant.llm import iblt


def digests(text):
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in re.findall(r"[^\r\n]{1,120}[^.!?\r\n]*[.!?]*", text)}


def likeness(a, b):
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


def slow(rows):
    ring = sorted(((d, t or "") for d, t in rows if d is not None), key=lambda x: (-x[0], x[1].encode()))
    nexts = [(d, t, ring[(i + 1) % len(ring)][1]) for i, (d, t) in enumerate(ring)] + [(None, t or "", "") for d, t in rows if d is None]
    out = []
    for d, t, n in nexts:
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        own = digests(t)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), likeness(own, digests(edited)), likeness(own, digests(n)), len(own)))
    return out


def rows_of(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.paragraphs) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def prose(n, seed=1):
    pick = random.Random(seed)
    return " ".join(" ".join(pick.choices(["alpha", "beta", "gamma", "δελτα", "epsilon"], k=4)) + f" {pick.randint(0, 10**6)}." for _ in range(n))


ROWS = ([(i * 7, prose(i % 30, i)) for i in range(60)] + [(-5, None), (3, ""), (4, "."), (5, "one line"), (6, "a\n\na\r\nb.  c! "), (10**12, prose(40, 9)), (None, prose(3)), (None, None)]
        + [(420, "the same text. twice"), (420, "the same text. twice"), (420, "other text. twice"), (8, prose(1500, 8)), (9, prose(1499, 8) + " Last.")])


def test_against_brute_force(docs_of):
    assert order(rows_of(iblt.fingerprints(docs_of(ROWS)))) == order(slow(ROWS))


def test_one_row_and_none(docs_of):
    assert rows_of(iblt.fingerprints(docs_of([(7, "ab. cd. ef")]))) == slow([(7, "ab. cd. ef")])
    assert iblt.fingerprints(docs_of([])).count() == 0
    assert rows_of(iblt.fingerprints(docs_of([(None, "x")]))) == slow([(None, "x")])


def test_fingerprints_are_equal_where_the_paragraphs_are(docs_of):
    rows = {r.doc_id: r.fingerprint for r in iblt.fingerprints(docs_of([(1, prose(20)), (2, prose(20)), (3, prose(20, 2)), (4, None), (5, "")])).collect()}
    assert rows[1] == rows[2] != rows[3] and rows[4] == rows[5]


@pytest.mark.parametrize("shared, own", [(0, 0), (50, 0), (50, 3), (10, 40), (0, 700), (2000, 5)])
def test_recovered_digests(llm_spark, shared, own):
    """What peeling recovers is the set difference, on either side."""
    common = prose(shared, 1)
    a, b = common + " " + prose(own, 2), common + " " + prose(own, 3) + " More."
    df = llm_spark.createDataFrame([(1, a, b)], "n int, a string, b string")
    r = iblt.compare(df, "a", "b", "x_").first()
    assert set(r.x_removed) == digests(a) - digests(b) and set(r.x_added) == digests(b) - digests(a)
    assert len(r.x_removed) == len(set(r.x_removed))


def test_all_differences_come_from_sketches(llm_spark):
    """The direct comparison of arrays is not what answers: the sketches alone recover all of 300 pairs."""
    pairs = [(prose(2 * (i % 60), i), prose(2 * (i % 60), i + 1000 * (i % 3))) for i in range(300)]
    df = llm_spark.createDataFrame(pairs, "a string, b string").select(iblt.digests(F.col("a")).alias("a"), iblt.digests(F.col("b")).alias("b"))
    found = df.select("a", "b", iblt._in_parts(F.col("a"), F.col("b")).alias("d"), iblt.peel(iblt.subtract(iblt.sketch(iblt.signed(F.col("a"))), iblt.sketch(iblt.signed(F.col("b"))))).alias("base")).collect()
    for r in found:
        true = {(k, 1) for k in set(r.a) - set(r.b)} | {(k, -1) for k in set(r.b) - set(r.a)}
        assert {(x.key, x.n) for x in r.d} == true
        assert r.base is None or {(x.key, x.n) for x in r.base} == true
    assert any(r.base is None for r in found) and any(r.base for r in found)


def test_no_python_on_the_way(docs_of):
    plan = iblt.fingerprints(docs_of(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
