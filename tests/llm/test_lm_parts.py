import os
import random

import numpy as np
from pyspark.sql import functions as F

from truant.llm import suffix_tree


def test_parts_of_buckets_and_chunks_change_no_score(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)

    def scores(asked, told):
        monkeypatch.setattr(suffix_tree, "ASKED_IN", asked)
        monkeypatch.setattr(suffix_tree, "TOLD_IN", told)
        got = suffix_tree.score_documents(docs, F.col("doc_id") % 5 == 0, depth=1).collect()
        return {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), round(r.score, 9)) for r in got}

    whole = scores(1, 1)
    assert len(whole) == 60 and scores(3, 2) == whole
    assert spark.conf.get(name, None) == before


def test_old_states_go_part_by_part(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b a c " * 20) for i in range(60)], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(suffix_tree, "TOLD_IN", 2)
    monkeypatch.setattr(suffix_tree, "CHUNK", 200)
    write, folders, left = suffix_tree.written, [], []

    def spy(df, name, by=None, compression="zstd"):
        if name == "lm-states-1":
            left.append(sum(os.path.isdir(f) for f in folders))
        out = write(df, name, by, compression)
        if name == "lm-states-0":
            folders.append(os.path.dirname(out.inputFiles()[0]).removeprefix("file:").replace("//", "/"))
        return out

    monkeypatch.setattr(suffix_tree, "written", spy)
    assert suffix_tree.score_documents(docs, F.lit(False), depth=1).count() == 60
    assert len(folders) == 2 and left == [2, 1]


def test_symbols_that_cannot_be_entries_are_asked_as_one_pair():
    words = np.array([0, *(suffix_tree._mix(np.arange(1, 7, dtype=np.uint64)))], np.uint64)
    x = np.array([1, 2, 1, 3, 1, 4, 1, 2, 5, 0], np.int32)  # contexts: 1, four times
    live = np.array([False, True] * 4 + [False, False])
    s = {"words": words, "x": x, "live": live, "hot": np.zeros(4, bool), "can": np.array([True, False, False, True])}
    limits = suffix_tree.Limits(10, 8, 0, 1, 2, 1000)
    asked = [q for part, q in suffix_tree._Asked.each(s, 1, limits, range(3), 3) if len(q.places)]
    assert len(asked) == 1 and sorted(np.bincount(asked[0].which)) == [2, 2]  # word 2, and words 3 and 4
    s["can"][:] = True
    asked = [q for part, q in suffix_tree._Asked.each(s, 1, limits, range(3), 3) if len(q.places)]
    assert sorted(np.bincount(asked[0].which)) == [1, 1, 2]


def test_packed_arrays_come_back():
    arrays = {"a": np.array([1, -2, 300], np.int64), "b": np.zeros(0, np.int32), "c": np.array([True, False]), "d": np.array([0.5]), "e": np.array([7], np.uint64)}
    got = suffix_tree._unpack(suffix_tree._pack(**arrays))
    assert all(got[k].dtype == a.dtype and (got[k] == a).all() and got[k].shape == a.shape for k, a in arrays.items())


def test_words_too_rare_for_an_entry_are_one_for_each_count():
    words = np.array([0, 11, 12, 13, 14, 15], np.uint64)
    s = {"words": words, "c": np.array([9, 20, 1, 1, 0, 5]), "x": np.array([1, 2, 1, 3, 1, 4, 1, 5, 0], np.int32),
         "live": np.array([False, True, False, True, False, True, False, False, False])}
    suffix_tree._forget(s, 1, suffix_tree.Limits(10, 8, 0, 1, 2, 1000))
    assert s["x"].tolist() == [1, 2, 1, 2, 1, 4, 0, 0, 0]
    assert s["words"].tolist() == [0, 11, 0, 0, 0, 0] and s["c"][s["x"]].tolist() == [20, 1, 20, 1, 20, 0, 9, 9, 9]
