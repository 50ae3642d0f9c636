import random
import re

from fragstat.llm.queries import URL_RULES
from fragstat.llm.url_filters import judge_urls, rule_index, rules_frame, url_host, url_path


def parts(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]


def brute(rows, rules):
    out = []
    for page, url in rows:
        host, path = parts(url)
        best = max(((len(h + p), h + p, v) for v, h, p in rules
                    if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, "allow"))
        out.append((page, url, host, path, best[1], best[2]))
    return sorted(out, key=repr)


URLS = [None, "", "no scheme", "http://", "http://com", "http://com/", "https://a.com/x?y#z", "HTTP://WWW.Example.COM/en/1",
        "http://example.com/en/", "http://example.com/en", "http://notexample.com/en/1", "http://x.net/es/a", "http://net/fr/",
        "http://net/fr", "ftp://a.b.net/es/?q", "http://com:80/", "http://u@a.com/", "x://y://com/", "http://a.com?x://net/es/",
        "http://É.com/É", "http://a\n.com/\n/en/", "http://.com/", "http://a..com//en/"]


def judged(spark, rows, rules):
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    return sorted(map(tuple, judge_urls(pages, rules_frame(spark, rules)).collect()), key=repr)


def test_the_registered_rules(spark):
    rows = list(enumerate(URLS)) + [(None, "http://a.com/"), (0, None), (3, "http://"), (3, "http://")]
    assert judged(spark, rows, URL_RULES) == brute(rows, URL_RULES)


def test_random_rules(spark):
    draw = random.Random(2)
    hosts = ["com", "b.com", "a.b.com", "net", "x.net", "b.x.net", "c+.net", "a-b.com"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a.b/", "/en(", "/$/"]
    rules = list({(h, p): (draw.choice(["allow", "block"]), h, p) for h in hosts for p in paths if draw.random() < 0.7}.values())
    rows = [(i, f"http://{draw.choice(['', 'w.', 'x'])}{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', 'b', '/c', '?q'])}")
            for i in range(400)]
    got, want = judged(spark, rows, rules), brute(rows, rules)
    assert [(r[0], r[4] and len(r[4]), r[4] is None) for r in got] == [(r[0], r[4] and len(r[4]), r[4] is None) for r in want]
    assert got == want


def test_rules_lie_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("http://a.com/x/",)] * 3 + [("http://b.net/en/",)], "url string").select(
        url_host("url").alias("host"), url_path("url").alias("path"))
    index = {r.rule: r.token for r in rule_index(rules_frame(spark, [("block", "com", "/en/"), ("block", "net", "/x/"),
                                                                     ("allow", "com", "/x"), ("allow", "", "")]), urls).collect()}
    assert index == {"com/en/": "/en", "net/x/": ".net", "com/x": ".com", "": ""}


def test_empty_tables_and_extra_columns(spark):
    none = spark.createDataFrame([], "page_id long, url string, token string, rule string")
    assert judge_urls(none, rules_frame(spark, URL_RULES)).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/", "t", "r"), (None, None, None, None)], none.schema)
    got = sorted(map(tuple, judge_urls(one, rules_frame(spark, [])).collect()), key=repr)
    assert got == [(1, "http://a.com/", "a.com", "/", None, "allow"), (None, None, "", "", None, "allow")]


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = judge_urls(pages, rules_frame(spark, URL_RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
