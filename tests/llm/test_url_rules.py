import random

from hirelens.llm.url_rules import RULES, general_rules, judge, mine, url_rules


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def fitting(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_random_urls_against_plain_search(spark):
    pick = random.Random(4)
    parts = ["http://", "https://", "x", "WWW.", "example", ".COM", ".com", ".net", "/en/", "/en", "/es/", "/fr/", "/", "?a=/en/", "#t",
             "://", "É", ":80", "\n"]
    urls = ["".join(pick.choices(parts, k=pick.randrange(8))) for _ in range(600)] + [None, "", "http://example.com", "http://com/",
            "http://www.example.com/en/1", "http://a.example.com/en/1", "http://notcom/"]
    pages = spark.createDataFrame([(k, u, "c", "r") for k, u in enumerate(urls)], "page_id long, url string, confidence string, rule string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.page_id: r for r in judge(pages, labels).collect()}
    for k, u in enumerate(urls):
        host, path = host_path(u)
        rule, verdict = fitting(host, path)
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, rule, verdict or "allow"), u


def rows(n):
    pick = random.Random(8)
    for k in range(n):
        bad = pick.random() < 0.3
        host = pick.choice(["spam-shop", "good"]) if bad and pick.random() < 0.9 else pick.choice(["good", "fine", "other"])
        yield k, f"http://{host}.example.org/{pick.choice(['a', 'b'])}/{k}", 0 if bad else 1


def test_mined_rules_against_counting(spark):
    data = list(rows(800))
    pages = spark.createDataFrame([(k, u) for k, u, _ in data], "page_id long, url string")
    labels = spark.createDataFrame([(k, q) for k, _, q in data] + [(3, None)], "doc_id long, quality int")
    got = {r.page_id: r for r in judge(pages, labels, support=0.02, confidence=0.8).collect()}
    for k, u, _ in data:
        assert got[k].verdict == ("block" if "spam-shop" in u else "allow"), u
    learnt = mine(pages.join(labels.withColumnRenamed("doc_id", "page_id"), "page_id").selectExpr("url", "quality = 0 bad"), "url", "bad", 0.02, 0.8)
    assert [r.needs for r in learnt.collect()] == [["h:spam-shop"]]


def test_general_rules_cover_longer_ones(spark):
    found = spark.createDataFrame([(1, ["a"], 0.9), (2, ["a", "b"], 0.9), (3, ["b", "c"], 0.95), (4, ["a", "c"], 0.99)],
                                  "rule_id long, needs array<string>, confidence double")
    assert sorted(r.rule_id for r in general_rules(found).collect()) == [1, 3, 4]


def test_repeats_and_nulls(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 0)], "doc_id long, quality int")
    assert sorted((r.page_id or 0, r.host) for r in judge(pages, labels).collect()) == [(0, ""), (1, "a.org"), (1, "a.org")]
    assert judge(pages.limit(0), labels).count() == 0


def test_pages(spark):
    folder = "/root/testdata/sf0.001"
    got = url_rules(spark, folder).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        host, path = host_path(pages[r.page_id])
        rule, verdict = fitting(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


def test_noise_gives_no_rules(spark):
    pick = random.Random(9)
    words = [f"w{k}" for k in range(12)]
    data = [(f"http://{pick.choice(words)}.{pick.choice(words)}.org/{pick.choice(words)}/{pick.choice(words)}?{pick.choice(words)}=1", pick.random() < 0.15)
            for _ in range(3000)]
    labelled = spark.createDataFrame(data, "url string, bad boolean")
    assert mine(labelled, "url", "bad", 0.002, 0.2).count() == 0
    told = spark.createDataFrame([(u.replace("w3.", "spam.") if b and k % 2 else u, b) for k, (u, b) in enumerate(data)], "url string, bad boolean")
    assert [r.needs for r in mine(told, "url", "bad", 0.002, 0.2).collect()] == [["h:spam"]]
    few = spark.createDataFrame([("http://a.org/x", True)] * 19 + [("http://b.org/y", False)] * 50, "url string, bad boolean")
    assert mine(few, "url", "bad", 0.002, 0.2).count() == 0 and mine(few.where("bad"), "url", "bad", 0.002, 0.2).count() == 0
