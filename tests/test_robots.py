"""robots.txt rules against a loop over all rules of a host."""

import re

import pytest

from harborline.operators import forest, robots

FILE = """﻿# comment
User-agent: *
Disallow: /private
Allow: /private/open   # longer wins
Disallow: /*.pdf$
Disallow: /tie
Allow: /tie
Disallow:

User-Agent : OtherBot
User-agent: harbor
Disallow: /harbor*x/
Allow: /harbor
Disallow: /a*b*c
Sitemap: http://x/y
Crawl-delay: 5
Disallow: /q?id=*&x
Disallow: /end$
User-agent: harborbot
Allow: /only$
Disallow: /
"""
HOSTS = {"one.test": FILE, "two.test": "User-agent: nobody\r\nDisallow: /\r\n", "three.test": "disallow: /x\nuser-agent:*\ndisallow:/*\nallow: /*/ok**",
         "four.test": "User-agent: *\nDisallow: /harbor*x/\nUser-agent: *\nDisallow: /a*b*c\nAllow: /harbor", "five.test": None}
PATHS = ["/", "", "/private", "/private/open/1", "/privateer", "/f.pdf", "/f.pdf?x", "/tie/1", "/harbor", "/harbor1x/", "/harbor/x", "/abc",
         "/axbxcx", "/acb", "/q?id=7&x", "/qid=7&x", "/end", "/end/", "/only", "/only/1", "/robots.txt", "/x/ok/1", "?a=b", "/a/ok#private"]
URLS = [f"http://{h}{p}" for h in [*HOSTS, "u:p@ONE.test", "six.test"] for p in PATHS]


def chosen(body, agent):
    groups, names, rules = [], None, None
    for line in re.split(r"\r\n|\r|\n", (body or "").removeprefix("﻿")):
        m = re.match(r"\s*([A-Za-z-]+)\s*:\s*(.*?)\s*$", re.sub("#.*$", "", line))
        if not m or m[1].lower() not in ("user-agent", "allow", "disallow"):
            continue
        if m[1].lower() == "user-agent":
            if names is None or rules:
                names, rules = [], []
                groups.append((names, rules))
            names.append(m[2].lower())
        elif names is not None and m[2]:
            rules.append((m[1].lower() == "allow", m[2]))
        elif names is not None:
            rules.append((True, ""))
    fit = lambda n: 0 if n == "*" else len(n) if n and n in agent else -1
    best = max((fit(n) for names, _ in groups for n in names), default=-1)
    return [r for names, rules in groups if best >= 0 and any(fit(n) == best for n in names) for r in rules if r[1]]


def verdict(url, agent):
    bare = re.sub("#.*$", "", url)
    host = re.match(r"[a-z]+://([^/?]*)", bare)[1].lower().split("@")[-1]
    path = re.sub(r"^[a-z]+://[^/?]*", "", bare)
    path = path if path.startswith("/") else "/" + path
    if path == "/robots.txt":
        return True, None
    hits = []
    for allow, pattern in chosen(HOSTS.get(host), agent):
        pattern = re.sub(r"\*+", "*", pattern)
        body = pattern.removesuffix("$")
        if re.match(".*".join(map(re.escape, body.split("*"))) + (r"\Z" if pattern.endswith("$") else ""), path, re.S):
            hits.append((len(pattern), allow, pattern))
    if not hits:
        return True, None
    _, allow, pattern = max(hits)
    return allow, ("Allow: " if allow else "Disallow: ") + pattern


@pytest.mark.parametrize("agent, few", [("harbor", forest.FEW), ("harborbot/2.1", 0), ("nothing", forest.FEW)])
def test_verdicts(spark, monkeypatch, agent, few):
    monkeypatch.setattr(forest, "FEW", few)
    files = spark.createDataFrame(list(HOSTS.items()), "host string, body string")
    urls = spark.createDataFrame([(i, u) for i, u in enumerate([*URLS, URLS[3], None])], "n long, url string")
    got = {r.n: (r.allowed, r.rule) for r in robots.allowed(urls, robots.rules(files, agent)).collect()}
    want = {i: verdict(u, agent) for i, u in enumerate([*URLS, URLS[3]])} | {len(URLS) + 1: (False, None)}
    assert got == want and len({w[1] for w in want.values()}) > 3
    assert robots.allowed(urls.limit(0), robots.rules(files.limit(0), agent)).count() == 0
