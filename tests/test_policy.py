"""Policies against a loop over all of them, and object versions against a scan."""

import random
import re

import pytest

from pyspark.sql import functions as F

from harborline.operators import forest, policy
from harborline.operators.envelope import envelope
from harborline.sources import objects


def documents(spark, rows):
    df = spark.createDataFrame(rows, "n long, connector string, uri string, kind string, tags array<string>, size int, ws string")
    docs = envelope(df, connector_id=F.col("connector"), instance_id=F.lit("i"), uri=F.col("uri"),
                    content=F.repeat(F.lit("x"), F.col("size")), content_type=F.col("kind"), seq=F.col("n"), workspace_id=F.col("ws"))
    return docs.drop("tags").join(df.select(F.col("n").alias("seq"), "tags"), "seq")


def holds(p, d):
    n, connector, uri, kind, tags, size, ws = d
    _, scope, field, op, value, _, _ = p
    if value is None or scope is None or (scope != "*" and scope != connector):
        return False
    host = re.sub(r"^[^@]*@|:[0-9]+$", "", re.match(r"[a-z]+://([^/?#]*)", uri or "")[1].lower()) if uri else None
    path = re.sub(r"[?#].*$", "", re.sub(r"^[a-z]+://[^/]*", "", uri)) if uri else None
    ext = "." + path.rsplit(".", 1)[1].lower() if path and "." in path else "" if path is not None else None
    have = {"content_type": [kind], "connector_id": [connector], "workspace_id": [ws], "uri": [uri], "domain": [host],
            "extension": [ext], "tag": tags or [], "size_bytes": [size], "instance_id": ["i"]}[field]
    value = value.lower() if field == "domain" else value
    test = {"eq": lambda x: str(x) == value, "in": lambda x: str(x) in [v.strip() for v in value.split(",")],
            "suffix": lambda x: ("." + x).endswith("." + value.lstrip(".")) if field == "domain" else x.endswith(value),
            "prefix": lambda x: x.startswith(value), "contains": lambda x: value in x,
            "regex": lambda x: re.search(value, x) is not None, "gt": lambda x: x > int(value), "lt": lambda x: x < int(value)}[op]
    return any(x is not None and test(x) for x in have)


@pytest.mark.parametrize("few", [forest.FEW, 0])
def test_decisions(spark, monkeypatch, few):
    monkeypatch.setattr(forest, "FEW", few)
    r = random.Random(7)
    hosts = ["a.b.com", "x.a.b.com", "B.com:80", "b.org", "notb.com", "u@b.com"]
    docs = [(i, r.choice(["c1", "c2"]), None if i == 3 else f"http://{r.choice(hosts)}/{r.choice('pq')}/f{i}.{r.choice(['md', 'EXE', 'tar.gz'])}?v=1.x",
             r.choice(["text/html", "text/plain"]), r.choice([None, [], ["t1"], ["t1", "t2", "t1"]]), r.randrange(1, 50),
             r.choice([None, "w1", "w2"])) for i in range(120)]
    kinds = [("domain", "eq", hosts), ("domain", "suffix", ["b.com", ".B.com", "com", "org"]), ("content_type", "eq", ["text/html"]),
             ("tag", "eq", ["t1", "t2"]), ("tag", "prefix", ["t2"]), ("workspace_id", "in", ["w1, w9", "w2"]),
             ("extension", "in", [".exe,.gz"]), ("size_bytes", "gt", ["40"]), ("size_bytes", "lt", ["9"]), ("size_bytes", "eq", ["7"]),
             ("uri", "contains", ["/p/"]), ("uri", "regex", ["f[0-9]*7[.]"]), ("uri", "suffix", ["md?v=1.x"]), ("connector_id", "eq", ["c2"])]
    policies = []
    for i in range(90):
        field, op, values = r.choice(kinds)
        policies.append((i, r.choice(["*", "*", "c1"]), field, op, r.choice(values), r.choice(["reject", "allow"]), r.randrange(9)))
    policies += [(900, "*", "tag", "eq", None, "reject", 99), (901, None, "tag", "eq", "t1", "reject", 99)]
    want = {}
    for d in docs:
        won = min(((-p[6], p[0], p[5]) for p in policies if holds(p, d)), default=None)
        if won:
            want[d[0]] = (won[1], won[2], -won[0], "ContentPolicyError" if won[2] == "reject" else None)
    got = policy.decisions(documents(spark, docs), spark.createDataFrame(policies, policy.POLICY))
    assert {x.seq: (x.policy_id, x.action, x.priority, x.error and x.error.error_type) for x in got.collect()} == want
    assert len({w[0] for w in want.values()}) > 3
    thin = spark.createDataFrame([(0, None), (1, ("Other", None, "m"))], "seq long, error struct<error_type:string,error_field:string,message:string>")
    errors = {x.seq: x.error and x.error.error_type for x in policy.enforced(thin, got).collect()}
    assert errors == {0: want.get(0, (None,) * 4)[3], 1: "Other"}


def test_bad_policies_are_refused(spark):
    docs = documents(spark, [(1, "c", "http://a/b", "t", [], 1, "w")])
    for bad in ((1, "*", "size_bytes", "gt", "many", "reject", 1), (1, "*", "colour", "eq", "red", "reject", 1),
                (1, "*", "uri", "gt", "5", "reject", 1), (1, "*", "uri", "eq", "5", "shred", 1)):
        with pytest.raises(ValueError):
            policy.decisions(docs, spark.createDataFrame([bad], policy.POLICY))
    assert policy.decisions(docs, spark.createDataFrame([], policy.POLICY)).count() == 0


def test_versions(spark):
    r = random.Random(2)
    rows = [(r.choice(["hot", "hot", "b", None]), r.randrange(0, 400_000), i, r.random() < 0.2, 1, f"e{i}") for i in range(150)]
    versions = spark.createDataFrame(rows, "key string, s long, seq long, deleted boolean, size long, etag string").select(
        "key", F.timestamp_seconds("s").alias("at"), "seq", "deleted", "size", "etag")
    chains = {x.seq: (x.until and int(x.until.timestamp()), x.latest) for x in objects.version_chains(versions).collect()}
    for key in ("hot", "b", None):
        own = sorted((s, i) for k, s, i, *_ in rows if k == key)
        for (s, i), nxt in zip(own, [*own[1:], None]):
            assert chains[i] == (nxt and nxt[0], nxt is None)
    times = sorted({x[1] for x in rows})
    asked = [(k, t + d, n) for n, (k, t, d) in enumerate((k, r.choice(times), r.choice((-1, 0, 1))) for k in ("hot", "b", None, "none") * 40)]
    df = spark.createDataFrame(asked, "key string, s long, n long").select("key", F.timestamp_seconds("s").alias("at"), "n")
    for bucket in (3600, 10 ** 7):
        got = {x.n: x.found and x.found.etag for x in objects.versions_as_of(df, versions, bucket).collect()}
        want = {}
        for k, t, n in asked:
            last = max(((s, i, gone, e) for key, s, i, gone, _, e in rows if key == k and s <= t), default=None)
            want[n] = None if last is None or last[2] else last[3]
        assert got == want


def test_policies_do_not_become_expressions(spark, monkeypatch):
    """Policies on sizes and parts of texts are looked up: none comes to the driver, and the
    plan doesn't grow with them."""
    r = random.Random(11)
    docs = [(i, r.choice(["c1", "c2", "*", None]), r.choice([None, f"http://h{i % 7}.org/p{i}/ü{i % 13}.md"]), "t", [f"t{i % 5}é"],
             r.choice([0, 1, 2, 3, 7, 8, 255, 256, 257, 1000]), "w") for i in range(80)]
    values = {"gt": [str(x) for x in (-5, 0, 1, 2, 6, 7, 8, 254, 255, 256, 999, 1000, 10 ** 30)] + [" +0_7 ", "-0"],
              "lt": [str(x) for x in (-5, 0, 1, 2, 3, 8, 256, 257, 1001, 10 ** 30)]}
    policies = []
    for i in range(400):
        op = r.choice(["gt", "lt", "prefix", "suffix", "contains", "regex"])
        field = "size_bytes" if op in values else r.choice(["uri", "tag"])
        value = r.choice(values.get(op) or ["", "t1", "t", "http://h", f"/p{i}/", "/ü", "é", "md", "p1", f"{i % 9}.md", "zz"])
        policies.append((i, r.choice(["*", "c1", "c2"]), field, op, value, r.choice(["reject", "allow"]), r.randrange(300)))
    want = {}
    for d in docs:
        won = min(((-p[6], p[0], p[5]) for p in policies if holds(p, d)), default=None)
        if won:
            want[d[0]] = (won[1], won[2], -won[0])
    sizes = []
    for some in (policies, policies[::8]):
        got = policy.decisions(documents(spark, docs), spark.createDataFrame(some, policy.POLICY))
        sizes.append(len(got._jdf.queryExecution().optimizedPlan().toString()))
        if some is policies:
            assert {x.seq: (x.policy_id, x.action, x.priority) for x in got.collect()} == want
    assert len({w[0] for w in want.values()}) > 3 and sizes[0] < 1.5 * sizes[1]
