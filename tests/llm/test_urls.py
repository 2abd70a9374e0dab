"""The wildcard automaton against regular expressions."""
import random
import re

from ripplet.llm import queries, urls


def regex(rule):
    def glob(t):
        return "".join("(?s:.*)" if c == "*" else re.escape(c) for c in t)
    return re.compile(glob(rule.path) if rule.glob else r"(?:[^/]*\.)?" + glob(rule.host + rule.path) + "(?s:.*)")


def brute(rules, text):
    fits = [i for i, r in enumerate(rules) if regex(r).fullmatch(text)]
    return max(fits, key=lambda i: (len(rules[i].name), -i), default=-1)


def test_random_globs_over_several_words():
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab/.é*") for _ in range(rng.randint(0, n)))
    for _ in range(60):
        rules = [urls.Rule("", word(9), True, True) if rng.random() < .6 else urls.Rule(word(4).replace("/", ""), "/" + word(4), False) for _ in range(30)]
        texts = ["".join(rng.choice("ab/.é*") for _ in range(rng.randint(0, 14))) for _ in range(40)]
        m = urls.ShiftAnd(rules)
        assert m.words > 1
        assert m.match([t.encode() for t in texts]).tolist() == [brute(rules, t) for t in texts]


def test_contract_cases(spark):
    cases = {"http://Example.COM/en/x?q=/es/": ("example.com", "/en/x", "example.com/en/", "block"), "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
             "http://com": ("com", "", None, "allow"), "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "ftp://x.net/fr/#a": ("x.net", "/fr/", "net/fr/", "block"),
             "http://x.org/a.com/": ("x.org", "/a.com/", None, "allow"), "http://spam-farm.example.org/": ("spam-farm.example.org", "/", None, "block"),
             "http://x.net?a=/es/": ("x.net", "", None, "allow"), "no scheme/": ("", "", None, "allow"), "://": ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"),
             "http://x.com:80/en/": ("x.com:80", "/en/", None, "allow"), "http://ÄB.com/É\n?x": ("Äb.com", "/É\n", "com/", "allow"), "http://x.com/" + "y" * 50_000: ("x.com", "/" + "y" * 50_000, "com/", "allow"),
             None: ("", "", None, "allow"), "": ("", "", None, "allow")}
    rows = [(i, u, "h", "r") for i, u in enumerate(cases)]
    df = spark.createDataFrame(rows + rows[:1] + [(None, "http://x.com/", "h", "r")], "page_id long, url string, host string, rule string")
    out = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, queries.URL_RULES, queries.URL_GLOBS).where("page_id IS NOT NULL").collect()}
    assert out == cases
    assert urls.judge_urls(df, queries.URL_RULES, []).count() == len(rows) + 2
    assert urls.judge_urls(df.limit(0), [], []).count() == 0
