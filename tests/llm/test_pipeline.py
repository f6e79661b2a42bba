import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontaminate, test_line_dedup, test_packing, test_simhash
from truant.llm import quality
from truant.llm._common import id_crc_mod

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(llm_spark, tmp_path_factory):
    """A small corpus: good and bad texts, shared lines, exact and near copies, benchmark passages, empty texts."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in ("th", "er", "on", "re") for b in ("a", "e", "ing", "ou") for c in ("nd", "st", "", "ly")]
    shared = "this line stands in a great many of the documents here"
    rows = []
    for i in range(160):
        lines = [" ".join(rng.choice(words, 40)) for _ in range(4)]
        if i % 5 == 0:
            lines = [" ".join(w.upper() + "!!" for w in line.split()) for line in lines]
        if i % 4 == 1:
            lines.insert(2, shared)
        if i % 11 == 1:
            lines.append("before " + test_decontaminate.ITEM + " after")
        rows.append((i, "\n".join(lines)))
    rows += [(200 + k, rows[k][1]) for k in (1, 2, 3)] + [(210, ""), (211, None), (212, "one word")]
    rows += [(220 + k, rows[7][1].replace("\n", " ") + f" end{k}") for k in range(4)]  # near copies in one line each
    d = str(tmp_path_factory.mktemp("corpus"))
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    llm_spark.createDataFrame(full, SCHEMA).write.parquet(f"{d}/documents.parquet")
    llm_spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    llm_spark.createDataFrame([(1, test_decontaminate.ITEM)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_each_stage_against_brute_force(llm_spark, folder, tmp_path):
    docs = llm_spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    learn = F.coalesce(id_crc_mod(F.col("doc_id"), 5) != 0, F.lit(True))
    model = quality.fit(docs.filter(learn), llm_spark.read.parquet(f"{folder}/labels.parquet").filter(learn))
    good, bad = quality._compressor(model.good), quality._compressor(model.bad)
    x = {i: model.logit(quality.size_difference(t, good, bad), len((t or "").encode())) for i, t in rows.items()}
    for (name, stage), k in zip(corpus_pipeline.STAGES, range(5), strict=True):
        out = stage(llm_spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        now = llm_spark.read.parquet(f"{tmp_path}/{k}")
        if name == "quality_classifier":
            rows = {i: t for i, t in rows.items() if 1 / (1 + np.exp(-x[i])) >= corpus_pipeline.MIN_QUALITY}
            assert len(rows) < 160 and all(i in rows for i in range(160) if i % 5)
        elif name == "line_dedup":
            rows = {i: t for i, t, _, _ in test_line_dedup.slow(sorted(rows.items()))}
        elif name == "simhash_near_dedup":
            least = test_simhash.slow_components([(i, test_simhash.slow_fingerprint(t)) for i, t in rows.items()])
            rows = {i: t for i, t in rows.items() if least[i] == i}
        elif name == "benchmark_decontamination":
            hit = {r[0] for r in test_decontaminate.slow(list(rows.items()), [(1, test_decontaminate.ITEM)])}
            assert hit
            rows = {i: t for i, t in rows.items() if i not in hit}
        else:
            tokenizer = Tokenizer.from_file(test_packing.PATHS[0])
            assert test_packing.check(list(rows.items()), now.collect(), tokenizer, 2048) > 0.9
            break
        assert now.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        got = now.collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted(rows.items(), key=lambda r: r[0])
        assert all(r.n_chars == len(r.text or "") for r in got)
        docs = now
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.run(llm_spark, folder).count() == now.count()


def test_empty_corpus(llm_spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        llm_spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(llm_spark, str(tmp_path)).count() == 0
