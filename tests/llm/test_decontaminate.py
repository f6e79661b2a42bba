import re

from truant.llm import decontaminate

ITEM = "the quick brown fox jumps over the lazy dog and runs into the dark forest at night without any sound"
WORDS = ITEM.split()


def slow(docs, items, threshold=0.8):
    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    def shingles(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    own, by_id = {}, {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            own.setdefault(i, set()).update(shingles(w, min(5, len(w))))
    for d, t in docs:
        if d is not None:
            by_id.setdefault(d, []).append(words(t))
    out = []
    for d, texts in by_id.items():
        for i, s in own.items():
            found = sum(any(x in shingles(w, len(x)) for w in texts) for x in s)
            if found >= threshold * len(s) - 1e-9:
                out.append((d, i, len(s), found))
    return sorted(out)


FILLER = " ".join(f"word{i % 977}" for i in range(20_000))
DOCS = [
    (1, f"{FILLER} {ITEM.upper().replace(' ', ', ')}! {FILLER}"),  # inside a very long text, other case and signs
    (2, " ".join(WORDS[:17])), (3, " ".join(WORDS[:12])), (4, ITEM.replace("lazy", "idle")),
    (5, ITEM.replace("sound", "noise")), (6, None), (7, ""), (8, "a b"), (9, "so it is yes no indeed"), (None, ITEM), (10, ITEM), (10, "nothing else"),
    (11, " ".join(WORDS[5:])), (11, " ".join(WORDS[:9])), (12, "yes"), (13, ITEM), (14, FILLER),
]
ITEMS = [(1, ITEM), (2, "yes no"), (3, ""), (4, None), (None, ITEM), (5, "--"), (6, "one two three four five six seven"), (7, "yes"), (1, ITEM)]


def test_against_brute_force(docs_of, llm_spark):
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as n", "'h' as hash")
    got = decontaminate.contained(docs_of(DOCS), items)
    assert sorted((r.doc_id, r.item_id, r.item_shingles, r.found) for r in got.collect()) == slow(DOCS, ITEMS)
    assert {r[0] for r in slow(DOCS, ITEMS)} >= {1, 2, 5, 9, 10, 11, 12, 13}


def test_clean_keeps_the_rest(docs_of, llm_spark):
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string")
    df = docs_of(DOCS)
    kept = decontaminate.clean(df, items)
    hit = {r[0] for r in slow(DOCS, ITEMS)}
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((d or -1) for d, _ in DOCS if d not in hit)


def test_empty_tables(docs_of, llm_spark):
    none = llm_spark.createDataFrame([], "item_id long, text string")
    some = llm_spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contained(docs_of(DOCS), none).count() == 0
    assert decontaminate.contained(docs_of([]), some).count() == 0
    assert decontaminate.clean(docs_of(DOCS), none).count() == len(DOCS)


def test_sketch_grows_by_size_class_and_loses_nothing(llm_spark):
    items = llm_spark.createDataFrame([(n, " ".join(f"i{n}w{k}" for k in range(n + 4))) for n in range(1, 60)], "item_id long, text string")
    rows = decontaminate.sketches(decontaminate.item_shingles(items, "item_id", "text", 5)).groupBy("item_id", "size_class", "need").count().collect()
    for r in rows:
        misses = r.item_id - -(-8 * r.item_id // 10)
        assert r["count"] - misses >= r.need >= 1 or r["count"] == r.item_id
    assert len({r.size_class for r in rows}) > 5
