"""The host graph: both plans, and hosts of very many labels."""

from tomeloom.llm import url_filter


def test_both_plans_give_the_same(spark, monkeypatch):
    links = "".join(f'<a href="http://h{i}.com/">' for i in range(6))
    rows = [(i, f"http://h{i}.com/a", f'<a href="http://h{(i * 7) % 10}.com/"><a href="https://bad.net/x">' + links * (i == 3)) for i in range(10)] + [(20, "http://bad.net/", links), (21, "http://good.org/fr/", links)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    get = lambda: sorted(map(tuple, url_filter.judge(df).collect()))
    small = get()
    monkeypatch.setattr(url_filter, "FEW_EDGES", 0)
    assert get() == small and any(r[5] for r in small) and any(r[6] for r in small)


def test_hosts_of_many_labels_keep_them_all(spark):
    deep = ".".join(f"l{i}" for i in range(150)) + ".com"
    df = spark.createDataFrame([(1, f"http://{deep}/", None), (2, "http://one/", None), (3, "http://a..b.com/", "x")], "page_id long, url string, html string")
    edges = {(r.src, r.dst) for r in url_filter.host_edges(url_filter.with_rule(df)).collect()}
    up = deep.split(".")
    chain = [".".join(up[i:]) for i in range(len(up) - 1)]
    assert {(a, b) for a, b in zip(chain, chain[1:], strict=False)} <= edges and {x for e in edges for x in e if "l149" in x} <= set(chain)
    assert not any("one" == x for e in edges for x in e)
