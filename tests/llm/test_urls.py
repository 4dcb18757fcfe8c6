import re

import duckdb
import pytest
from pyspark.sql import functions as F

from crewlens.llm import queries, urls
from crewlens.llm.common import table
from crewlens.llm.oracles import ORACLES

SCHEMA = "page_id long, url string, html string"


def plain(url):
    """host, path, rule, verdict of the rule."""
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [
        (len(rule), rule, verdict)
        for verdict, rule in urls.RULES
        if (host == (h := rule.split("/")[0]) or host.endswith("." + h)) and path.startswith(rule[len(h) :])
    ]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def compare(rows, df):
    got = urls.judge(df).collect()
    assert len(got) == len(rows)
    url = {r[0]: r[1] for r in rows}
    for r in got:
        host, path, rule, verdict = plain(url[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.distrust > 0.5 * (r.trust + r.distrust) else "allow"))


URLS = [
    None, "", "no scheme", "http://", "://", "http://Example.COM", "http://example.com/", "https://example.com/en/", "https://example.com/en",
    "https://example.com/EN/", "https://www.Example.com/en/x?q#f", "http://a.www.example.com/en/1", "http://notexample.com/en/1",
    "http://b.net/es/1", "http://net/fr/", "http://b.net/frx", "http://b.net?x=/es/", "http://c.org/en/://d.com/", "ftp://u@h.com:80/p",
    "http://b.net#/es/", "http://com/", "http://x.com.", "a://b://c", "http://example.com/en/\nx", "http://ÄÖ.com/É",
]


def test_rules_and_parsing(make):
    rows = [(i, u, None if i % 2 else "") for i, u in enumerate(URLS)]
    compare(rows, make(SCHEMA, rows).repartition(3))


def test_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "pages")
    compare([tuple(r) for r in df.select("page_id", "url", "html").collect()], df)


def link(*hosts):
    return "".join(f'<a class="x" href="http://{h}/p">t</a> <A HREF=//{h}/q>u</A>' for h in hosts)


def test_trust_and_distrust_spread_over_links(make):
    rows = [
        (1, "http://good.com/", link("a.org", "b.org")),
        (2, "http://bad.net/es/", link("c.org")),
        (3, "http://spam.org/x", link("bad.net")),
        (4, "http://a.org/", link("b.org")),
        (5, "http://far.org/", link("spam.org")),
        (6, "http://b.org/", None),
        (7, "http://c.org/", ""),
        (8, "http://lone.org/", "<a href='/en/x'>self</a>"),
    ]
    got = {r.page_id: r for r in urls.judge(make(SCHEMA, rows)).collect()}
    assert {p: r.verdict for p, r in got.items()} == {
        1: "allow", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow", 7: "allow", 8: "allow"
    }
    # The same iteration written out.
    edges = {"good.com": {"a.org": 0.5, "b.org": 0.5}, "bad.net": {"c.org": 1}, "spam.org": {"bad.net": 1}, "a.org": {"b.org": 1}, "far.org": {"spam.org": 1}}
    trust = {"good.com": 0.15}
    for _ in range(50):
        new = {"good.com": 0.15}
        for s, out in edges.items():
            for d, part in out.items():
                new[d] = new.get(d, 0) + 0.85 * part * trust.get(s, 0)
        trust = new
    for r in got.values():
        assert r.trust == pytest.approx(trust.get(r.host, 0))


def far_hosts():
    """A chain of 24 hosts to a blocked one, a late flip at its tenth, and a cycle that is trusted."""
    out = {f"h{i}.org": [f"h{i - 1}.org" if i > 1 else "bad.net"] for i in range(1, 25)}
    out |= {"good.com": ["h10.org", "ring0.org", *[f"x{i}.org" for i in range(8)]]}
    out |= {f"ring{i}.org": [f"ring{(i + 1) % 3}.org"] for i in range(3)}
    return out, [(i, f"http://{h}/", link(*to)) for i, (h, to) in enumerate(out.items())] + [(99, "http://bad.net/es/", None)]


def test_the_sql_goes_as_far_as_the_operator(make, tmp_path):
    _, rows = far_hosts()
    make(SCHEMA, rows).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(f"select page_id, host, path, rule, verdict, trust, distrust from ({ORACLES['op6_url_filters']})").fetchall()
    got = queries.op6_url_filters(make(SCHEMA, []).sparkSession, str(tmp_path)).select(
        "page_id", "host", "path", "rule", "verdict", "trust", "distrust"
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert sum(r[5] > 0 for r in want) > 12 and sum(r[6] > 0 for r in want) > 24


def test_far_hosts_and_cycles_get_their_whole_score(make):
    out, rows = far_hosts()
    got = {r.host: r for r in urls.judge(make(SCHEMA, rows).repartition(4)).collect()}
    edges = [(s, d, 1 / len(to)) for s, to in out.items() for d in to]
    back = [(d, s, 1 / sum(d in to for to in out.values())) for s, to in out.items() for d in to]

    def whole(edges, seed):
        score = {seed: 0.15}
        for _ in range(400):
            new = {seed: 0.15}
            for s, d, part in edges:
                new[d] = new.get(d, 0) + 0.85 * part * score.get(s, 0)
            score = new
        return score

    trust, distrust = whole(edges, "good.com"), whole(back, "bad.net")
    for h, r in got.items():
        assert r.trust == pytest.approx(trust.get(h, 0), rel=1e-7) and r.distrust == pytest.approx(distrust.get(h, 0), rel=1e-7)
    assert all(got[f"h{i}.org"].verdict == "block" for i in range(10, 25))
    assert got["h24.org"].distrust > 0 and got["ring1.org"].verdict == "allow"


def test_empty_repeated_and_clashing(make):
    assert urls.judge(make(SCHEMA, [])).collect() == []
    rows = [(1, "http://x.org/", link("y.org"))] * 3
    df = make(SCHEMA, rows).withColumn("host", F.lit("zz")).withColumn("verdict", F.lit(0)).withColumn("rule", F.lit(0))
    assert [r.verdict for r in urls.judge(df).collect()] == ["allow"] * 3
