import random
import re

import pytest
from pyspark.sql import functions as F

from civica.llm import url_templates as U
from civica.llm.queries import URL_RULES

S = U.TemplateSettings(min_support=3)


def split_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def shape(seg):
    m = re.search(U.ENDING, seg)
    stem, end = (seg[: m.start()], m[0]) if m else (seg, "")
    if not stem:
        return end
    if re.fullmatch("[0-9]+", stem):
        return "{num}" + end
    if re.fullmatch("[0-9a-f-]{8,}", stem) and re.search("[0-9]", stem):
        return "{hex}" + end
    return ("{word}" if re.fullmatch("[A-Za-z]+", stem) else "{str}") + end


def brute_templates(urls, s):
    """The template of each url, level by level."""
    rows = []
    for u in urls:
        host, path = split_url(u)
        rows.append([host, path.removeprefix("/").split("/") if path else [], ""])
    for level in range(max(len(r[1]) for r in rows)):
        count = {}
        for host, parts, t in rows:
            if len(parts) > level:
                count[host, t, parts[level]] = count.get((host, t, parts[level]), 0) + 1
        for r in rows:
            host, parts, t = r
            if len(parts) > level:
                keep = count[host, t, parts[level]] >= s.min_support
                r[2] = t + "/" + (parts[level] if keep else shape(parts[level]))
    return [(h, t) for h, _, t in rows]


@pytest.fixture(scope="module")
def urls():
    rng = random.Random(2)
    out = [None, "", "no scheme", "http://", "HTTP://A.Example.NET", "http://x.net/", "http://net/a?b#c", "http://example.net/en/1",
           "ftp://a.example.com/de/x", "http://a.org/fr/", "http://borg/fr/", "a://b://c/d", "http://h.com/" + "a/" * 50,
           "http://É.com/É", "http://x.com:80/en/1", "http://u@x.net/p", "//x.net/a", "http://x.com?q=/y", "http://y.com#/z"]
    for i in range(400):
        host = rng.choice(["hot.com"] * 5 + ["b.com", "c.net"])
        kind = rng.choice(["news", "blog", "user"])
        out.append(f"https://{host}/{kind}/" + rng.choice([f"{i}", f"{i}.html", f"item-{i}", f"{i:08x}ab"]) + rng.choice(["", "/", "?a=1"]))
    return out + ["https://hot.com/news/1"] * 30


@pytest.fixture(scope="module")
def judged(llm, urls):
    rows = [(i, u, None if i % 3 else int("user" in (u or "")), "x", 7) for i, u in enumerate(urls)]
    df = llm.createDataFrame(rows, "page_id long, url string, bad int, host string, labelled int")
    return U.judge_urls(df, URL_RULES, settings=S).collect()


def test_host_path_and_rule(urls, judged):
    assert sorted(r["page_id"] for r in judged) == list(range(len(urls)))
    for r in judged:
        host, path = split_url(urls[r["page_id"]])
        rule, verdict = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def test_bad_branch_is_rejected(urls, judged):
    for r in judged:
        if r["host"] == "hot.com":
            assert r["verdict"] == ("block" if "/user/" in r["path"] else "allow"), r


def test_templates_match_brute_force(llm, urls):
    df = U.with_host_and_path(llm.createDataFrame(list(enumerate(urls)), "_row long, url string"), "url")
    rows = U.path_templates(df, S).collect()
    want = brute_templates(urls, S)
    assert {r["_row"]: (r["host"], r["template"]) for r in rows} == dict(enumerate(want))


def test_similar_branches_are_merged(judged):
    branches = {r["branch"] for r in judged if r["host"] == "hot.com"}
    assert any("blog|news" in b for b in branches) and not any("user" in b and "news" in b for b in branches)


def test_smoothed_share(llm):
    rows = [("h", "/a/{num}", 1)] * 8 + [("h", "/b/{num}", 0)] * 8 + [("h", "/b/{num}", None)] * 4
    df = llm.createDataFrame(rows, "host string, template string, bad long").withColumn("path", F.col("template"))
    got = {r["template"]: r for r in U.template_verdicts(df, U.TemplateSettings(strength=2.0)).collect()}
    overall = (8 + 2 * 0.1) / (16 + 2)
    host = (8 + 2 * overall) / (16 + 2)
    a, b = (8 + 2 * host) / 10, 2 * host / 10  # the branches
    assert got["/a/{num}"]["bad_share"] == pytest.approx((8 + 2 * a) / 10) and got["/a/{num}"]["rejected"]
    assert got["/b/{num}"]["bad_share"] == pytest.approx(2 * b / 10) and got["/b/{num}"]["labelled"] == 8


def test_no_labels_and_empty_table(llm, urls):
    df = llm.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(None, "http://x.com/a", None)], "page_id long, url string, bad int")
    got = U.judge_urls(df, (), settings=S).collect()
    assert len(got) == len(urls) + 1 and {r["verdict"] for r in got} == {"allow"}
    assert U.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_no_python_in_the_plan(llm):
    import __spark_entry__ as e
    df = e.queries()["op1_url_templates"](llm, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_one_bad_section_of_many(llm):
    rows = [(40 * k + i, f"https://hot.com/section{chr(97 + k // 26)}{chr(97 + k % 26)}/{40 * k + i}", int(k == 17)) for k in range(50) for i in range(40)]
    got = U.judge_urls(llm.createDataFrame(rows, "page_id long, url string, bad int"), ()).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == {x[0] for x in rows if x[2]}
    assert any(r["branch"].endswith("|+41/{num}") for r in got)  # 49 alike branches, eight of them named


def test_one_bad_section_deep_down(llm):
    rows = [(40 * k + i, f"https://h.com/a/b/c/d/e/f/{'abcdefghij'[k] * 3}/{40 * k + i}/" + "x/" * (300 if i == 0 else 1), int(k == 4))
            for k in range(10) for i in range(40)]
    got = U.judge_urls(llm.createDataFrame(rows, "page_id long, url string, bad int"), ()).collect()
    blocked = {r["page_id"] for r in got if r["verdict"] == "block"}
    assert blocked >= {x[0] for x in rows if x[2] and x[0] % 40} and not blocked - {x[0] for x in rows if x[2]}
