import math

import duckdb
import numpy as np
import pytest

from truant.llm import topk, url_filter
from truant.llm.catalog import ORACLE, QUERIES, RULES

SF = "/root/testdata/sf0.001"


def slow_top(rows, k, step=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(1024 * x) for x in v]
            good[i] = min(good.get(i, ints), ints)
    out = []
    for q in good:
        if q % step == 0:
            scores = [(-sum(a * b for a, b in zip(good[q], v, strict=False)), i) for i, v in good.items() if i != q]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def got_top(spark, rows, k, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as grp", "2 as score", "3 as q")
    return sorted(tuple(r) for r in topk.search(df, "vec_id % 5 = 0", k=k, **options).collect())


def test_top_k_against_brute_force(llm_spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(120, 10)).astype(np.float32)
    rows = [(i, base[i].tolist()) for i in range(120)]
    rows += [(200 + i, base[7].tolist()) for i in range(40)]  # a group of copies larger than k
    rows += [(300 + i, np.sign(base[i]).tolist()) for i in range(20)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 10), (405, [float("inf")] * 10), (None, base[1].tolist()), (410, []), (415, [1.0, 2.0])]
    rows += [(5, base[5].tolist()), (6, base[9].tolist())]  # a repeated row, and another vector under a used id
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = slow_top(rows, 7)
    assert got_top(llm_spark, rows, 7) == want
    assert got_top(llm_spark, rows, 7, block=10, slices=3) == want


@pytest.mark.parametrize("rows", [[], [(5, [1.0])], [(5, [1.0]), (10, [1.0]), (7, [-1.0])]])
def test_top_k_of_few_rows(llm_spark, rows):
    assert got_top(llm_spark, rows, 10) == slow_top(rows, 10)


@pytest.mark.parametrize("url,host,path", [
    ("https://A.Example.ORG/En/1?x#y", "a.example.org", "/En/1"), ("x://h", "h", ""), ("x://h?q=/a", "h", ""), ("x://h#/a", "h", ""),
    ("no scheme/a", "", ""), (None, "", ""), ("", "", ""), ("x:///p", "", "/p"), ("a://b://c/d", "b:", "//c/d"), ("x://É.org/é", "É.org", "/é"),
])
def test_host_and_path(llm_spark, url, host, path):
    from pyspark.sql import functions as F

    df = llm_spark.createDataFrame([(url,)], "url string")
    assert tuple(df.select(*url_filter.host_and_path(F.col("url"))).first()) == (host, path)


def pages(spark, urls):
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").selectExpr("*", "1 as n", "'t' as template", "2 as bad")


def test_longest_rule_wins(llm_spark):
    urls = ["http://example.org/", "http://example.org/es/1", "http://a.example.org/en/12", "http://badexample.org/es/", "http://x.com/fr/1", "http://com/de/1",
            "http://x.com/en/1", "http://example.org", "http://example.net/es/1", "http://ORG/es"]
    rows = {r.page_id: (r.rule, r.verdict) for r in url_filter.verdicts(pages(llm_spark, urls), RULES).collect()}
    assert [rows[i][0] for i in range(10)] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, None, "org/"]
    assert [rows[i][1] for i in range(6)] == ["allow", "block", "block", "allow", "allow", "block"]


def test_templates_generalise_and_reject(llm_spark):
    good = [f"http://h.com/news/{i}.html" for i in range(60)]
    bad = [f"http://h.com/ads/{i}/buy" for i in range(60)]
    deep = ["http://h.com/" + "/".join("abcdefghij")]
    frame = pages(llm_spark, [*good, *bad, *deep, None, "http://other.net/ads/5/buy"]).drop("bad")
    labelled = frame.selectExpr("*", "case when page_id % 2 = 0 and page_id < 120 then int(url like '%/ads/%') end as bad")
    rows = {r.page_id: r for r in url_filter.verdicts(labelled, [], bad_col="bad").collect()}
    assert len(rows) == 123
    assert rows[0].template == "/news/*.html" and rows[60].template == "/ads/*/buy"
    assert {rows[i].verdict for i in range(60)} == {"allow"} and {rows[i].verdict for i in range(60, 120)} == {"block"}
    assert rows[120].template == "/*" * url_filter.DEPTH + "/**" and (rows[121].host, rows[121].template) == ("", "")
    assert url_filter.verdicts(pages(llm_spark, []), RULES).count() == 0


def test_sections_of_a_large_host_stay_apart(llm_spark):
    urls = [f"http://h.com/section{i % 100}/{i}" for i in range(3_000)]  # 1 % of the host each
    labelled = pages(llm_spark, urls).drop("bad").selectExpr("*", "case when page_id < 1500 then int(url like '%/section7/%') end as bad")
    rows = url_filter.verdicts(labelled, [], bad_col="bad").collect()
    assert {r.verdict for r in rows if "/section7/" in r.path} == {"block"}
    assert {r.verdict for r in rows if "/section7/" not in r.path} == {"allow"}


def test_sections_with_all_shares_are_not_one_branch(llm_spark):
    """60 sections, 200 labels each, with 0 to 200 bad ones: the clean ones stay allowed, the bad ones are blocked, like ones are merged."""
    rows = [(i, f"http://h.com/section{s}?{j}", int(j < 200 * s / 59)) for s in range(60) for j in range(200) for i in [200 * s + j]]
    df = llm_spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = url_filter.verdicts(df, [], bad_col="bad").groupBy("template").agg({"purity": "max", "verdict": "max"}).collect()
    purity = {int(r.template.split("/")[1].removeprefix("section")): r["max(purity)"] for r in got}
    verdict = {int(r.template.split("/")[1].removeprefix("section")): r["max(verdict)"] for r in got}
    assert all(abs(purity[s] - s / 59) < 0.12 for s in range(60))
    assert all(verdict[s] == "allow" for s in range(26)) and all(verdict[s] == "block" for s in range(34, 60))
    assert len({round(p, 9) for p in purity.values()}) < 40


def test_like_siblings_share_their_labels(llm_spark):
    rows = [(20 * s + j, f"http://h.com/s{s}?{j}", int(j < 2)) for s in range(30) for j in range(20)]
    df = llm_spark.createDataFrame(rows, "page_id long, url string, bad int")
    assert url_filter.verdicts(df, [], bad_col="bad").select("purity").distinct().count() == 1


def test_deep_paths_differ_below_any_depth(llm_spark):
    deep = "/".join("abcdefghij")
    urls = [f"http://h.com/{deep}/{kind}/{i}" for kind in ("good", "bad") for i in range(60)] + ["http://h.com/" + "x/" * 3000]
    labelled = pages(llm_spark, urls).drop("bad").selectExpr("*", "case when page_id % 3 <> 0 and page_id < 120 then int(url like '%/bad/%') end as bad")
    rows = url_filter.verdicts(labelled, [], bad_col="bad").collect()
    assert {r.verdict for r in rows if "/good/" in r.path} == {"allow"} and {r.verdict for r in rows if "/bad/" in r.path} == {"block"}
    assert {r.template for r in rows if "/good/" in r.path} == {f"/{deep}/good/*"}
    assert [r.template for r in rows if "/x/" in r.path] == ["/*" * url_filter.DEPTH + "/**"]


@pytest.mark.parametrize("name", ["op2_url_filter", "op5_warc_archive", "op9_exact_top_k", "op1_benchmark_decontamination", "op7_line_dedup"])
def test_query_equals_its_sql(llm_spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, want = QUERIES[name](llm_spark, SF), con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = [tuple(r) for r in df.select(*want.columns).collect()]

    def order(rows):
        return sorted([tuple(f"{x:.9g}" if isinstance(x, float) else x for x in r) for r in rows], key=repr)

    assert order(got) == order(want.fetchall())
