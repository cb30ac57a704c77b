import random
import re

from keysieve.llm import url_filter as U


def ascii_lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(urls, rules):
    out = []
    clean = {}
    for v, h, p in rules:
        if v is not None and h and p is not None:
            key = (ascii_lower(h), p)
            clean[key] = "block" if "block" in (v, clean.get(key)) else "allow"
    for i, u in urls:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host = ascii_lower(m[1]) if m else ""
        path = m[2] if m else ""
        fit = [(len(h + p), len(h), h + p, v) for (h, p), v in clean.items()
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)
        out.append((i, host, path, best and best[2], best[3] if best else "allow"))
    return sorted(out, key=str)


def run(spark, urls, rules, **kw):
    pages = spark.createDataFrame(urls, "page_id long, url string").selectExpr(
        "*", "'x' as host", "'y' as rule", "1 as top", "null as html")
    out = U.filter_urls(pages, U.rules_frame(spark, rules), **kw)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_random_rules(spark):
    r = random.Random(11)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "xample.org", "com", "example.com", "net", "exämple.net"]
    paths = ["", "/", "/e", "/es/", "/es", "/es/1", "/en/1", "/en/", "/É/", "/\U0010ffff"]
    rules = [(r.choice(["allow", "block"]), r.choice(hosts), r.choice(paths)) for _ in range(40)]
    urls = [(i, f"{r.choice(['http', 'https'])}://{r.choice(['', 'www.', 'WWW.', 'a.'])}{r.choice(hosts)}"
                f"{r.choice(paths)}{r.choice(['', '2', '/x', '?q=/es/', '#es'])}") for i in range(400)]
    for n in (0, 1, 5, 40):
        assert run(spark, urls, rules[:n], salts=4) == brute(urls, rules[:n])
    # More sweeps than the least number: the number follows the table.
    assert run(spark, urls, rules, per_salt=3) == brute(urls, rules)


def test_odd_urls(spark):
    rules = [("allow", "org", "/"), ("block", "org", "/"), ("block", "example.org", "/es/"), (None, "net", "/"),
             ("block", "", "/"), ("allow", "x.org", None)]
    urls = [(1, None), (2, ""), (3, "no scheme.org/"), (4, "://org/"), (5, "a://b://org/"), (None, "http://org/"),
            (6, "http://org"), (6, "http://org"), (7, "HTTP://EXAMPLE.ORG/es/x?y"), (8, "http://.org/"),
            (9, "http://org./"), (10, "http://org:80/"), (11, "http://x.org/" + "y" * 50_000), (12, "http://a\nb.org/\n")]
    assert run(spark, urls, rules) == brute(urls, rules)
    assert run(spark, [], rules) == []


def test_hot_host_is_spread(spark):
    urls = [(i, f"http://www.example.org/en/{i}") for i in range(5000)]
    rules = [("allow", "org", "/"), ("block", "example.org", "/en/1")]
    assert run(spark, urls, rules) == brute(urls, rules)
