from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL
from relearn.llm.url_filters import filter_urls, intervals, url_keys


def test_keys(spark):
    urls = [("http://u@A.b.Com:80/x//y?q#f",), ("ftp://h",), ("not a url",), (None,), ("http://h.",)]
    got = [r[0] for r in spark.createDataFrame(urls, "u string").select(url_keys(F.col("u"))).collect()]
    assert got[0] == ["domain:a.b.com", "domain:b.com", "domain:com", "prefix:a.b.com/x", "prefix:a.b.com/x/y"]
    assert got[1] == ["domain:h"] and got[2] == [] and not got[3] and got[4] == ["domain:h"]


def test_intervals(spark):
    log = [("a", 5, "add"), ("a", 7, "add"), ("a", 9, "remove"), ("a", 9, "remove"), ("a", 12, "remove"), ("a", 20, "add"), ("a", 20, "remove"),
           ("b", 1, "remove"), ("c", None, "add"), ("d", 1, "other"), (None, 1, "add"), ("e", 3, None)]
    got = {tuple(r) for r in intervals(spark.createDataFrame(log, "entry string, at long, action string")).collect()}
    assert got == {("a", 5, 9), ("a", 20, None)}


def test_captures_as_of_their_time(spark):
    log = spark.createDataFrame([("domain:b.com", 10, "add"), ("domain:b.com", 20, "remove"), ("prefix:a.b.com/x", 15, "add")], "entry string, at long, action string")
    rows = [(1, "http://a.b.com/x", t) for t in (9, 10, 15, 20, None)] + [(1, "http://a.b.com/x", 10), (2, None, 15), (None, "http://b.com", 12), (3, "junk", 12)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at long").withColumn("entry", F.lit("clash"))
    got = [(r.page_id, r.fetched_at, tuple(r.entries)) for r in filter_urls(captures, log).collect()]
    b, x = "domain:b.com", "prefix:a.b.com/x"
    assert sorted(got, key=str) == sorted([(1, 9, ()), (1, 10, (b,)), (1, 10, (b,)), (1, 15, (b, x)), (1, 20, (x,)), (1, None, ()), (2, 15, ()),
                                           (None, 12, (b,)), (3, 12, ())], key=str)
    assert filter_urls(captures.limit(0), log).count() == 0 and filter_urls(captures, log.limit(0)).where("blocked").count() == 0


def test_entries_that_are_toggled_often(spark):
    """Many toggles and captures, times beyond the list's on both sides: against a search of the log line by line."""
    import random
    rng = random.Random(2)
    lines = [(f"domain:h{rng.randrange(4)}.x", rng.randrange(5000), rng.choice(["add", "remove"])) for _ in range(3000)] + [("domain:h0.x", 2500, "add")]
    rows = [(i, f"http://h{rng.choice([0, 0, 0, 1, 2, 3, 4])}.x/p", rng.randrange(-200, 5600)) for i in range(4000)]
    state = {}
    for entry, at, action in lines:
        state.setdefault(entry, {})[at] = state.get(entry, {}).get(at, False) or action == "add"

    def listed(entry, at):
        before = [t for t in state.get(entry, {}) if t <= at]
        return bool(before) and state[entry][max(before)]
    log = spark.createDataFrame(lines, "entry string, at long, action string")
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at long")
    got = {r.page_id: r.entries for r in filter_urls(captures, log).collect()}
    want = {i: [e] if listed(e := "domain:" + u[7:11], t) else [] for i, u, t in rows}
    assert got == want and 1000 < sum(map(bool, want.values())) < 3000


def test_query_matches_sql(spark):
    from tools.oracle_check import compare
    assert compare(spark, SF_SMALL, ["op3_url_filters"])["op3_url_filters"].startswith("OK")
