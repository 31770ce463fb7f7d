import random

import pytest
from cases import documents, words

from tabloom.llm import mixing, urls


def reshared(sizes, weights, share, most):
    """Targets by resharing the excess again and again."""
    targets = {s: 0.0 for s in sizes}
    rest, open_ = share * sum(sizes.values()), {s for s in sizes if sizes[s]}
    while rest > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        given = {s: rest * weights[s] / total for s in open_}
        rest = 0.0
        for s, g in given.items():
            targets[s] += g
            if targets[s] >= most * sizes[s]:
                rest += targets[s] - most * sizes[s]
                targets[s] = most * sizes[s]
        open_ = {s for s in open_ if targets[s] < most * sizes[s]}
    return targets


def test_targets_and_copies(spark):
    r = random.Random(3)
    rows = [(i, "w " * r.randint(0, 40), r.choice(["a", "b", "B", "é", None])) for i in range(3000)]
    rows += [(5000 + i, "w " * 20, "hot") for i in range(1500)]
    planned = mixing.plan_mix(documents(spark, rows)).collect()
    sizes, taken = {}, {}
    for p in planned:
        assert p["size"] == len(words(p["text"])) and 0 <= p["copies"] <= 2
        sizes[p["source"]] = sizes.get(p["source"], 0) + p["size"]
        taken[p["source"]] = taken.get(p["source"], 0) + p["size"] * p["copies"]
    order = sorted(s for s in sizes if s is not None) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = reshared(sizes, weights, 1.5, 2.0)
    for p in planned:
        assert p["target"] == pytest.approx(want[p["source"]]) and p["source_size"] == sizes[p["source"]]
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.1)
    again = mixing.plan_mix(documents(spark, rows).repartition(7)).collect()
    assert {(p["doc_id"], p["copies"]) for p in again} == {(p["doc_id"], p["copies"]) for p in planned}


def test_awkward_documents(spark):
    docs = documents(spark)
    planned = mixing.plan_mix(docs).collect()
    assert len(planned) == docs.count()
    assert all(p["copies"] * p["size"] <= 2 * p["size"] for p in planned)
    assert {p["target"] for p in planned if p["source"] is None} == {0.0}
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(p["copies"] for p in planned)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.plan_mix(documents(spark, [(1, None, "a"), (2, "", None)])).where("copies > 0").count() == 0


HOSTS = ["example.com", "www.example.com", "a.b.example.com", "notexample.com", "com", "example.net", "x.net", "", "a..com", "EXAMPLE.com:80"]
PATHS = ["", "/", "/en", "/en/", "/en/x?y=/z", "/es/1#t", "//", "/é/ü", "/en/\nx"]
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/e", "block"), ("net", "/es/", "allow"), ("b.example.com", "", "block"), ("com", "/é", "block"), ("com", "/", "block"),
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
    fit = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=None)
    return (host, path, best[2] if best else None, best[3] if best else "allow")


@pytest.mark.parametrize("buckets", [1, 3, 300])
def test_urls_against_all_rules(spark, buckets):
    found = [f"{s}{h}{p}" for s in ("https://", "x://", "") for h in HOSTS for p in PATHS] + [None, "", "://", "a://b://c", "http://" + "a." * 5000 + "com/en/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(found * 2)], "page_id long, url string")
    pages = pages.selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS bucket", "'k' AS key")
    rows = urls.judge(pages, urls.rule_table(spark, RULES), buckets=buckets).collect()
    assert len(rows) == 2 * len(found)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(r["url"], RULES), r["url"]
        assert (r["bucket"], r["key"]) == ("z", "k")


def test_random_nested_rules(spark):
    r = random.Random(5)
    host = lambda: ".".join(r.choice("abc") for _ in range(r.randint(1, 3)))
    path = lambda: "/" + "".join(r.choice("xy/") for _ in range(r.randint(0, 4)))
    rules = list({(host(), path()): None for _ in range(150)})
    rules = [(h, p, r.choice(["allow", "block"])) for h, p in rules]
    found = [f"http://{host()}.{host()}{path()}{path()}" for _ in range(600)]
    pages = spark.createDataFrame([(u,) for u in found], "url string")
    for row in urls.judge(pages, urls.rule_table(spark, rules), buckets=16).collect():
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == judged(row["url"], rules), row["url"]


def test_no_rules_and_no_urls(spark):
    pages = spark.createDataFrame([("http://a.com/x",), (None,)], "url string")
    none = urls.rule_table(spark, RULES).limit(0)
    assert {r["verdict"] for r in urls.judge(pages, none, default="block").collect()} == {"block"}
    assert urls.judge(pages.limit(0), urls.rule_table(spark, RULES)).count() == 0


def test_the_sweep_runs_no_python(spark):
    pages = spark.createDataFrame([("http://a.com/x",)], "url string")
    plan = urls.judge(pages, urls.rule_table(spark, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
