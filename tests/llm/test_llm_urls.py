"""URL filter: rules, segmentation against exhaustive search, verdicts on the pages table."""

import itertools
import math

from pyspark.sql import functions as F

from rosterline.llm import queries, url_filter


def test_best_words_match_exhaustive_search():
    counts, total = {"the": 50, "then": 9, "e": 3, "net": 20, "t": 2, "hen": 6, "cheap": 4, "pills": 4}, 98
    for part in ("thenet", "cheappills", "xthen", "t", "eeee"):
        known = {(i, n): counts[part[i : i + n]] for i in range(len(part)) for n in range(1, len(part) - i + 1) if part[i : i + n] in counts}

        def chance(words):
            return sum(math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10) for w in words)

        splits = [[part[a:b] for a, b in zip((0, *c), (*c, len(part)))] for n in range(len(part)) for c in itertools.combinations(range(1, len(part)), n)]
        got = url_filter.best_words(part, known, total)
        assert "".join(got) == part and math.isclose(chance(got), max(map(chance, splits)))


def test_rules_and_edge_cases(spark):
    rows = [(1, None, None), (2, "nothing", ""), (None, "HTTP://X.Example.ORG/ES/?a", "<TITLE>a b"), (3, "http://example.org/en/12#", None), (3, "a://b://c", None),
            (4, "http://com/de/", None), (5, "http://acom/de/é/" + "x" * 5000, ""), (6, "http://" + "cheappills" * 30 + ".com/fr/x?y", ""), (7, "http://a.org", "")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    got = {(r["page_id"], r["host"][:12], r["path"][:6], r["rule"], r["verdict"]) for r in url_filter.judged(pages, queries.URL_RULES).collect()}
    assert got == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (None, "x.example.or", "/ES/", "org/", "allow"), (3, "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "b:", "//c", None, "allow"), (4, "com", "/de/", "com/de/", "block"), (5, "acom", "/de/é/", None, "allow"), (6, "cheappillsch", "/fr/x", "com/fr/", "allow"), (7, "a.org", "", None, "allow"),
    }
    assert url_filter.judged(pages.limit(0), queries.URL_RULES).count() == 0


def test_top_level_domain_counts(spark):
    hosts = ["best-offers.casino", "name.xxx", "two.labels.sex:8080", "root.porn.", "casino", "a.comporn", "plain.org", "10.0.0.7", "10.0.0.7:80", "", "x."]
    pages = spark.createDataFrame([(k, f"http://{h}/a") for k, h in enumerate(hosts * 3)], "page_id long, url string").withColumn("html", F.lit(None).cast("string"))
    got = {r["host"]: (r["verdict"], r["host_words"]) for r in url_filter.judged(pages, []).collect()}
    assert {h: v for h, (v, _) in got.items()} == {h: "block" if k < 5 else "allow" for k, h in enumerate(hosts)}
    last = {h: w[-1:] for h, (_, w) in got.items()}
    assert last == dict(zip(hosts, [["casino"], ["xxx"], ["sex"], ["porn"], ["casino"], ["comporn"], ["org"], [], [], [], ["x"]], strict=True))


def test_verdicts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    bad = F.col("host").rlike("spam-farm|cheap-pills|casino-win|free-bets|adult-x|ads-track")
    got = url_filter.judged(pages, []).groupBy(bad.alias("bad"), "verdict").count().collect()
    assert {(r["bad"], r["verdict"]) for r in got} == {(True, "block"), (False, "allow")}


def test_words_that_hyphens_set_apart(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r["host"]: r["host_words"] for r in url_filter.judged(pages, []).select("host", "host_words").distinct().collect()}
    marked = {h: w for h, w in got.items() if "-" in h}
    assert marked
    for h, words in marked.items():
        assert words == [p for p in h.replace("-", ".").split(".") if p]
    hosts = [(k, f"http://{h}.net/a") for k, h in enumerate(["free-win", "big-win.shop", "freewin", "bigfree", "w-1-x"] * 4)]
    joined = spark.createDataFrame(hosts, "page_id long, url string").selectExpr("*", "cast(null as string) as html")
    words = {r["host"]: r["host_words"][:2] for r in url_filter.judged(joined, []).collect()}
    assert words["freewin.net"] == ["free", "win"] and words["bigfree.net"] == ["big", "free"] and words["w-1-x.net"] == ["w", "x"]


def test_long_paths_are_joined_by_sorting(spark, monkeypatch):
    """The verdicts are the same without any broadcast of paths and hosts."""
    rows = [(k, f"http://big-sex{k % 3}.com/{'p' * 3000}{k}/x") for k in range(40)] + [(99, None), (100, "http://a.org/b")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "cast(null as string) as html")
    want = sorted(map(str, url_filter.judged(pages, []).collect()))
    monkeypatch.setattr(url_filter, "SMALL_BYTES", 0)
    assert sorted(map(str, url_filter.judged(pages, []).collect())) == want
