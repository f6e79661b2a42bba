from types import SimpleNamespace

from truant.plans import catalog_io


def test_files_of_the_scored_stream_grow_in_number_with_the_rows(spark, monkeypatch):
    cores, written = spark.sparkContext.defaultParallelism, []

    def files_of(rows):
        trained = SimpleNamespace(predictions=spark.range(rows), prepared=SimpleNamespace(state=None), model=None)
        monkeypatch.setattr(catalog_io, "_quick", lambda spark, sf: trained)
        catalog_io.q_score_stream(spark, "")
        return written.pop()

    monkeypatch.setattr(catalog_io, "_unlabelled", lambda spark, sf: spark.range(10))
    monkeypatch.setattr(catalog_io.tables, "write_csv", lambda df, path: written.append(df.rdd.getNumPartitions()))
    monkeypatch.setattr(catalog_io.stream, "score_stream", lambda spark, src, state, model, out, ck: spark.range(1).write.parquet(out))
    monkeypatch.setattr(catalog_io, "_checked", lambda rows: rows)
    assert files_of(1_000) == cores
    assert files_of(500_000 * cores + 1) == 2 * cores
