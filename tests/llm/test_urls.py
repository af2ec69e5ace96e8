"""Url verdicts against every rule tried on every url, and the awkward rows."""

import random

from tillgrain.llm import urls
from tillgrain.llm.urls import ALLOW, BLOCK, Rule

PIECES = ["net", "example", "com", "org", "en", "de", "fr", "ads", "login", "page=2", "page=1", "wiki", "EN", "é", "x1"]


def slow(url, rules):
    """What the docstring says, without an index."""
    url = url or ""
    if "://" not in url:
        return "", "", None, ALLOW
    after = url.split("://", 1)[1]
    cut = min([i for i in (after.find(c) for c in "/?#") if i >= 0], default=len(after))
    host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in after[:cut]), after[cut:]
    path = rest.split("?")[0].split("#")[0]
    hits = [r for r in rules if r.regex().search(host + rest)]
    best = min(hits, key=Rule.order, default=None)
    return host, path, best and best.name, best.verdict if best else ALLOW


def made_urls(n, seed=5):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        host = ".".join(rng.choices(PIECES, k=rng.randint(0, 4)))
        rest = "".join(rng.choice("/?#&.") + rng.choice(PIECES) for _ in range(rng.randint(0, 4)))
        out.append(rng.choice(["http", "HTTPS", ""]) + rng.choice(["://", "://", "://", ":"]) + host + rest)
    return out


AWKWARD = [
    None, "", "://", "http://", "http:///en/", "no scheme/en/", "http://a.NET", "http://a.NET/", "http://net/",
    "http://xnet/", "http://example.net/en/x", "http://example.net/EN/x", "http://a.example.com/de/",
    "http://badexample.com/de/", "http://x.com?y.net/", "http://x.org/fr/?q#f", "http://x.com#://a.net/",
    "http://x.com/a://b.net/", "http://u@x.net:80/", "http://x.com/" + "a/" * 100_000 + "login",
    "http://x.com/login", "http://x.com/logins", "http://x.com/help/login", "http://x.com/a\nb/login/",
    "http://x.com/l?page=1", "http://x.com/l?page=12", "http://x.com/l?page=1&b", "http://docs.x.com/login",
]


def judged(spark, table, rules=urls.RULES):
    df = spark.createDataFrame(list(enumerate(table)), "page_id long, url string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, rules).collect()}


def test_verdicts_equal_those_of_all_rules_tried(spark):
    table = AWKWARD + made_urls(3000) + AWKWARD
    found = judged(spark, table)
    assert [found[i] for i in range(len(table))] == [slow(u, urls.RULES) for u in table]
    assert {v[3] for v in found.values()} == {ALLOW, BLOCK} and len({v[2] for v in found.values()}) == 5


def test_stated_cases(spark):
    found = judged(spark, AWKWARD)
    verdict = {u: found[i][2:] for i, u in enumerate(AWKWARD)}
    assert verdict["http://a.NET"] == (None, ALLOW) and verdict["http://a.NET/"] == ("net/", BLOCK)
    assert verdict["http://example.net/en/x"] == ("example.net/en/", ALLOW)
    assert verdict["http://example.net/EN/x"] == ("net/", BLOCK)
    assert verdict["http://badexample.com/de/"] == (None, ALLOW)
    assert verdict["http://x.com?y.net/"] == (None, ALLOW)
    assert verdict["http://x.com/login"] == (None, BLOCK) and verdict["http://x.com/logins"] == (None, ALLOW)
    assert verdict["http://x.com/l?page=1"] == (None, ALLOW) and verdict["http://x.com/l?page=12"] == (None, BLOCK)
    assert found[0] == ("", "", None, ALLOW)


def test_rules_of_many_shapes_and_rules_without_a_token(spark):
    rng = random.Random(8)
    rules = [
        Rule(rng.choice([ALLOW, BLOCK]),
             rng.choice(["", "|", "||"])
             + "".join(rng.choice(["/", "^", "*", "."]) + rng.choice(PIECES) for _ in range(rng.randint(1, 3)))
             + rng.choice(["", "|", "^", "*", "/"]))
        for _ in range(200)
    ]
    assert any(not r.tokens() for r in rules)
    table = made_urls(1500, seed=9)
    found = judged(spark, table, rules)
    assert [found[i] for i in range(len(table))] == [slow(u, rules) for u in table]


def test_a_rule_is_filed_by_its_rarest_token_and_others_are_not_tried(spark):
    table = ["http://a.com/common/x"] * 50 + ["http://a.com/common/rare/x"]
    df = spark.createDataFrame([(u,) for u in table], "url string")
    rules = [Rule(BLOCK, "/common/rare/"), Rule(BLOCK, "/common/*")]
    counts = urls.token_counts(df, rules)
    assert counts == {"common": 51, "rare": 1}
    index = urls.RuleIndex(rules, counts)
    assert set(index.filed) == {"rare", "common"}
    assert [index.rules[i].pattern for i in index.candidates("a.com/common/x")] == ["/common/*"]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(empty).count() == 0
    df = spark.createDataFrame([(1, "http://a.net/", "mine", "old")], "page_id long, url string, token string, Host string")
    row = urls.judge(df).first().asDict()
    assert row == {"page_id": 1, "url": "http://a.net/", "token": "mine", "host": "a.net", "path": "/", "rule": "net/", "verdict": BLOCK}
