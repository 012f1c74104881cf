import math
import re
from collections import Counter

import pytest

from starloom.llm import urls
from tests.conftest import SF_ORACLE

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(url, rules=urls.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = host.translate(UPPER)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit) if fit else (0, None, None)
    return host, path, best[1], best[2]


URLS = [None, "", "no scheme/net/", "http://", "http://net", "http://net/", "http://A.NET/x", "http://example.net/en/", "http://sub.example.net/en/a?b#c",
        "http://example.net/enx", "http://badexample.net/en/", "https://example.com/de/1", "http://example.com/de", "http://x.org/fr/", "http://x.org/fr?/fr/",
        "http://u@h.net:80/p", "http://a://b.net/x", "ftp://É.Org/fr/é", "http://h.net?q=/x", "http://h.net#f/x", "http://.net/", "http://x..net/",
        "http://h/\nx", "http://a.net\n/x", "http://" + "a." * 200 + "net/" + "p/" * 5000]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS label", "'z' AS features")


def test_host_path_and_rule(spark):
    got = urls.judge_urls(frame(spark, [(i, u, None) for i, u in enumerate(URLS)] * 2)).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, rule, verdict = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
        assert (r.score is None) == (rule is not None)


def test_trees_learn_lexical_differences(spark):
    """Rules label hosts under two suffixes; the trees carry what their URLs look like to a third."""
    rows = [(i, f"http://site{'abcdefgh'[i % 8]}.good/articles/story-{'xyz'[i % 3]}", None) for i in range(300)]
    rows += [(1000 + i, f"http://x{i * 7919 % 9973}q{i}.bad/{i * 31}/{i * 17}?id={i}&s={i * 3}&t=1", None) for i in range(300)]
    rows += [(5000 + i, f"http://sitek{'abc'[i % 3]}.other/articles/news-{'pq'[i % 2]}", None) for i in range(50)]
    rows += [(6000 + i, f"http://x{i * 6007 % 9973}z{i}.other/{i * 37}/{i * 13}?id={i}&s={i}&t=9", None) for i in range(50)]
    rules = (("good", "/", "allow"), ("bad", "/", "block"))
    got = {r.page_id: r for r in urls.judge_urls(frame(spark, rows), rules).collect()}
    assert all(got[5000 + i].verdict == "allow" and got[6000 + i].verdict == "block" for i in range(50))


@pytest.mark.parametrize(("rules", "want"), [((), "allow"), ((("net", "/", "block"),), "block")])
def test_one_kind_of_label_or_none(spark, rules, want):
    assert {r.verdict for r in urls.judge_urls(frame(spark, [(1, "http://a.com/", None), (2, "http://a.net/", None), (None, None, None)]), rules).collect()} == {want}


def test_query_on_the_table(spark):
    raw = spark.read.parquet(f"{SF_ORACLE}/pages.parquet").toPandas().set_index("page_id").url
    got = urls.op8_url_gbt(spark, SF_ORACLE).collect()
    assert len(got) == len(raw)
    for r in got:
        host, path, rule, verdict = plain(raw[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or verdict == r.verdict)


def test_empty_table(spark):
    assert urls.judge_urls(frame(spark, [])).count() == 0


def test_entropy_of_whole_paths(spark):
    """Tens of thousands of characters, the end unlike the beginning."""
    paths = ["/", "", "/aab", "/é日本é", "/" + "a" * 30_000 + "bcdefgh" * 4_000, "/" + "ab" * 20_000]
    rows = [(i, f"http://h.net{p}", None) for i, p in enumerate(paths)]
    got = urls.with_host_and_path(frame(spark, rows)).withColumn("bits", urls._features()["path_entropy"]).collect()
    for r in got:
        path, n = paths[r.page_id], len(paths[r.page_id])
        want = -sum(k / n * math.log2(k / n) for k in Counter(path).values())
        assert abs(r.bits - want) < 1e-6, r.page_id


def test_a_rare_verdict_is_in_the_sample(spark):
    """Thousands of copies of one blocked URL against few allowed ones, with a bound below either number."""
    rows = [(1, "http://bad.net/x")] * 3_000 + [(i, f"http://w{i}.org/fr/{i}") for i in range(40)] + [(9_000 + i, f"http://z.com/{i}") for i in range(9)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string").repartition(3), train_rows=20)
    assert got.count() == len(rows) and got.where("score IS NOT NULL").count() == 9
