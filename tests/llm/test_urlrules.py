import random
import re

import pytest

from intactly.llm import urlrules

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.example.net", "", "allow"), ("b.a.example.net", "/en/x", "block"), ("example.net", "/en/", "block"))


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = min(fits, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("buckets", [1, 5])
def test_against_brute_force(spark, buckets):
    rng = random.Random(4)
    hosts = ["net", "example.net", "a.example.net", "B.A.Example.NET", "c.b.a.example.net", "xnet", "anexample.net", "org",
             "x.org", "example.com", "m.example.com", "example.com.", ".net", "", "net:80", "u@example.net", "a..net", "é.net"]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/de/1", "/fr/", "/EN/", "/en/\nx", "//", "?/en/", "#/en/", "/en/?q://x/"]
    urls = [rng.choice(["http", "HTTPS", ""]) + "://" + rng.choice(hosts) + rng.choice(paths) for _ in range(400)]
    urls += [None, "", "no scheme", "a://", "http://example.net/en/://b.org/fr/"]
    urls += ["http://example.net/en/"] * 50
    pages = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(urls)],
                                  "page_id long, url string, key string, stack string, bucket string")
    rules = urlrules.rule_table(spark, RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, rules, buckets=buckets).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}
    assert urlrules.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urlrules.judge(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_no_python_in_the_plan(spark):
    plan = urlrules.op3_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
