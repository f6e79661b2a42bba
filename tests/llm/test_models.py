import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from truant.llm import langid, quality, suffix_tree
from truant.llm._common import id_crc_mod
from truant.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# quality


def noisy(rng, n, bad):
    words = rng.choice([f"{a}{b}{c}" for a in ("th", "er", "on") for b in ("a", "e", "ing") for c in ("nd", "st", "")], n)
    return " ".join(w.upper() + "!!" if bad else w for w in words)


def test_quality_on_held_out_rows(llm_spark):
    rows = QUERIES["op4_quality_classifier"](llm_spark, SF).join(table(llm_spark, "labels"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) / len(good) > 0.97
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.8
    better = sum((g.score > b.score) + (g.score == b.score) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert better > 0.97


def test_quality_edges(llm_spark, docs_of):
    rng = np.random.default_rng(0)
    rows = [(i, noisy(rng, 80, i % 3 == 0)) for i in range(200)] + [(500, None), (501, ""), (None, "a b"), (502, "漢字 " * 30_000), (3, noisy(rng, 80, True))]
    labels = llm_spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(150)] + [(None, 1), (7, None), (8, 5), (9, 1), (9, 0), (9999, 1)], "doc_id long, quality int")
    docs = docs_of(rows)
    model = quality.fit(docs, labels, dict_rows=40, fit_rows=100)
    assert model == quality.fit(docs.repartition(5), labels.repartition(3), dict_rows=40, fit_rows=100)
    got = [(r.doc_id, r.s) for r in docs.select("doc_id", model.score(F.col("text")).alias("s")).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    at = dict(got)
    assert at[500] == at[501]  # null is empty
    unseen = [(at[i], i % 3 != 0) for i in range(150, 200)]
    assert min(s for s, y in unseen if y) > max(s for s, y in unseen if not y)


def test_quality_without_one_label_or_rows(llm_spark, docs_of):
    docs = docs_of([(i, f"text number {i}") for i in range(9)])
    one = quality.fit(docs, llm_spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int"))
    scores = {r.s for r in docs.select(one.score(F.col("text")).alias("s")).collect()}
    assert len(scores) == 1 and 0.5 < scores.pop() < 1
    none = quality.fit(docs_of([]), llm_spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.s for r in docs.select(none.score(F.col("text")).alias("s")).collect()} == {0.5}


# languages


def test_language_on_held_out_rows(llm_spark):
    rows = QUERIES["op8_language_id"](llm_spark, SF).join(table(llm_spark, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert {zlib.crc32(str(r.doc_id).encode()) % 4 for r in rows} == {2}
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.99


LANGS = {"aa": "the and of in to that is was for it with as his on be at by", "bb": "der die und in den von zu das mit sich des auf",
         "cc": "и в не на я быть он с что а по это она"}


def test_language_edges(llm_spark, docs_of):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(LANGS[k].split(), 60)), k) for i, k in enumerate(list(LANGS) * 20)]
    rows += [(100, None, "aa"), (101, "", "aa"), (102, "12 3!", "aa"), (None, "the and", "aa"), (103, "the", None), (104, "qqqq", None),
             (105, LANGS["bb"] + " " + "der und die von " * 60_000, None), (106, "Ü", None)]
    docs = docs_of(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == ["aa", "bb", "cc"]
    got = {r.doc_id: r.language for r in langid.predict(docs, model, F.col("text")).collect()}
    assert all(got[i].lang == k for i, _, k in rows[:60])
    assert [(got[i].lang, got[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[105].lang == "bb" and got[104].score == 0.0 and got[104].lang in model.languages and got[106].lang in model.languages
    assert all(0 <= x.score <= 1 for x in got.values())
    assert langid.predict(docs_of([], "doc_id long, text string, lang string"), model, F.col("text")).count() == 0
    empty = langid.fit(docs_of([], "doc_id long, text string, lang string"))
    assert {r.language.lang for r in langid.predict(docs, empty, F.col("text")).collect()} == {"und"}


def test_filter_masks_and_counts():
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(0, 1 << 63, 5_000).astype(np.uint64))
    masks = rng.integers(1, 7, len(grams)).astype(np.uint64)
    model = langid.LanguageModel.build(["x", "y", "z"], grams, masks)
    found = model.lookup(grams)
    assert ((found & masks.astype(found.dtype)) == masks).all()  # no false negatives
    other = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    rate = [((model.lookup(other) >> np.uint8(i)) & 1).mean() for i in range(3)]
    assert np.allclose(rate, model.false_positives(), atol=0.01)


def test_long_texts_are_counted_like_short_ones(monkeypatch):
    model = langid.LanguageModel.build(["x", "y"], np.arange(50, dtype=np.uint64), np.ones(50, np.uint64))
    text = " ".join(f"word{chr(97 + i % 26)}é{chr(97 + i // 26 % 26)}" for i in range(3_000))
    whole = model.counts([text, "", "ab"])
    monkeypatch.setattr(langid, "CHUNK", 1_000)
    parts = model.counts([text, "", "ab"])
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True)) and whole[0][0] > 10_000 and whole[0][1] == 0


def test_the_filter_holds_all_grams(docs_of, monkeypatch):
    monkeypatch.setattr(langid, "MAX_GRAMS", 5, raising=False)  # a former cut
    long, short = "abcdefghij " * 200, "klmnopqrst " * 5
    model = langid.fit(docs_of([(1, long, "a"), (2, short, "b")], "doc_id long, text string, lang string"))
    langs, scores = model.predict(["klmnopqrst", "abcdefghij"])
    assert list(langs) == ["b", "a"] and min(scores) > 0


# suffix tree


def slow_scores(train, texts, depth, p_word, p_context, p_entry):
    """{text: (tokens, known, base, score)}, straight from the definitions on lists and dicts."""
    def split(t):
        return [w.decode() for w in (t or "").encode().lower().split()] + ["\n"]

    seqs = [split(t) for t in train]
    uni = Counter(w for s in seqs for w in s)
    n, v = sum(uni.values()), len(uni)

    def root(w):
        return (uni[w] + 0.1) / (n + 0.1 * (v + 1))

    frequent = {w for w, c in uni.items() if c >= p_word * n} | {"\n"}
    nexts = defaultdict(Counter)  # context to next words; a context is made of frequent words
    for s in seqs:
        for i in range(1, len(s)):
            for d in range(1, min(depth, i) + 1):
                context = tuple(s[i - d : i])
                if all(w in frequent for w in context):
                    nexts[context][s[i]] += 1
    live = {(w,) for w in frequent if w != "\n" and uni[w] >= p_context * n and uni[w]}
    states, all_live = {}, set()

    def p(context, w):
        while context and context not in states:
            context = context[1:]
        if not context:
            return root(w)
        own, kept, back = states[context]
        low = p(context[1:], w)
        return (kept[w] + back * low) / (own + suffix_tree.MU) if w in kept else back / (own + suffix_tree.MU) * low

    for _ in range(depth):
        all_live |= live
        made = {}
        for context in live:
            c = nexts[context]
            own = sum(c.values())
            kept = {w: k for w, k in c.items() if w in frequent and k >= p_entry * n}
            rest = own - sum(kept.values())
            low = {w: p(context[1:], w) for w in kept}
            gain = sum(k * math.log(k / own / low[w]) for w, k in kept.items())
            gain += rest * math.log(rest / own / max(1 - sum(low.values()), 1e-12)) if rest > 0 else 0
            if gain > 0.5 * math.log(max(n, 2)) * len(kept):
                made[context] = own, kept, rest + suffix_tree.MU
        states |= made
        live = {(*c, w) for c in live for w, k in nexts[c].items() if w in frequent and w != "\n" and k >= p_entry * n and k >= p_context * n}
    out = {}
    for t in texts:
        s = split(t)
        score = 0.0
        for i, w in enumerate(s):
            best = ()
            for d in range(1, min(depth, i) + 1):
                if tuple(s[i - d : i]) in all_live:
                    best = tuple(s[i - d : i])
            score += math.log10(p(best, w))
        out[t] = len(s), sum(uni[w] > 0 for w in s), sum(math.log10(root(w)) for w in s), score
    return n, out, states


def texts_of(rng, n):
    rare = [f"rare{i}" for i in range(300)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.integers(0, 12)):
            words += ["The", "quick", "brown", "fox"] if rng.random() < 0.4 else list(rng.choice(["a", "of", "to", "fox", "the", *rng.choice(rare, 2)], 3))
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("depth", [1, 3])
def test_scores_against_brute_force(docs_of, depth, monkeypatch):
    monkeypatch.setattr(suffix_tree, "CHUNK", 500)
    rng = np.random.default_rng(3)
    rows = list(enumerate(texts_of(rng, 300))) + [(400, None), (401, ""), (402, "unseen words only"), (403, "the quick " * 5_000), (None, "the quick brown fox")]
    rows += [(1, rows[1][1])]
    options = {"p_word": 0.004, "p_context": 0.01, "p_entry": 0.004}
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    n, want, states = slow_scores([t for (_, t), h in zip(rows, held, strict=True) if not h], [t for _, t in rows], depth, **options)
    got = suffix_tree.score_documents(docs_of(rows), id_crc_mod(F.col("doc_id"), 10) == 0, depth=depth, **options).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    assert len(states) > 3 and (depth == 1 or max(map(len, states)) > 1)
    text = dict(rows)
    for r in got:
        tokens, known, base, score = want[text[r.doc_id]]
        assert (r.n_tokens, r.n_known) == (tokens, known)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9) and r.score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_next_symbol_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    c = np.array([50.0, 30, 15, 5])
    tree = suffix_tree.SuffixTree((c + 0.1) / (100 + 0.5), end=3)
    tree.grow(np.array([0, 1, 2]))
    pairs = [(s, x, int(rng.integers(5, 60))) for s in range(3) for x in range(4) if (s, x) != (1, 2)]
    own = {s: sum(k for a, _, k in pairs if a == s) + 7 for s in range(3)}
    key = [s << suffix_tree.BITS | x for s, x, _ in pairs] + [s << suffix_tree.BITS | suffix_tree.ANY for s in own]
    tree.add_level({"key": np.array(key), "n": np.array([k for *_, k in pairs] + list(own.values()))}, 10)
    assert tree.levels[0].retained.any()
    unknown = 0.1 / 100.5  # the share of all other words at the root
    for s in np.flatnonzero(tree.levels[0].retained):
        total = sum(tree.probability(1, np.array([s]), np.array([x]))[0] for x in range(4))
        assert total + tree.levels[0].backoff[s] * unknown == pytest.approx(1.0)


def test_without_training_rows(docs_of):
    got = suffix_tree.score_documents(docs_of([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert suffix_tree.score_documents(docs_of([]), F.lit(False)).count() == 0


def test_a_context_counts_as_much_in_a_large_corpus(docs_of, monkeypatch):
    """Limits are counts: other texts, however many, don't take a context's state away; nor does a context dealt to all buckets change."""
    own = [(i, "some rare pair of words") for i in range(40)]
    asked = [(1000, "some rare pair of words")]
    held = F.col("doc_id") == 1000
    small = [(2000 + i, f"filler number {i % 7}") for i in range(50)]
    large = [(2000 + i, "filler number " * 1_000 + str(i)) for i in range(2_000)]

    def gain(rows):
        r = suffix_tree.score_documents(docs_of(rows), held).filter("doc_id = 1000").first()
        return r.score - r.base_score, r.score

    few, many = gain(own + asked + small), gain(own + asked + large)
    assert many[0] > few[0] > 3  # 40 of 4,000,000 tokens are 1e-5
    monkeypatch.setattr(suffix_tree, "HOT", 20)
    assert gain(own + asked + large) == pytest.approx(many, rel=1e-9)
