"""SimHash, components, URL filters, decontamination and chat against brute force."""
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from simrec.llm import chat, decontaminate, simhash, url_filter
from simrec.llm.components import connected_components
from simrec.llm.queries import LLM_ORACLE, URL_RULES

from .conftest import leaks, words


def _roots(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 300)]
    edges += [(rng.randint(400, 900), rng.randint(400, 900)) for _ in range(300)] + [(1000, 1000)]
    rng.shuffle(edges)
    df = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges] + [(1, None)],
                               "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == _roots(edges)
    assert connected_components(df.limit(0)).count() == 0


def _fp(text):
    w = (text or "").encode().lower().split()
    k = min(4, len(w))
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(len(w) - k + 1)] if w else []
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64)) if hs else 0


def _docs_with_copies(rng, n=120):
    rows = []
    for i in range(n):
        w = words(rng, rng.randint(1, 150), 3000)
        if rows and rng.random() < 0.5:
            w = rng.choice(rows)[1].split()
            if w and rng.random() < 0.7:
                w[rng.randrange(len(w))] = "changed"
        rows.append((n - i, " ".join(w)))
    return rows


@pytest.mark.parametrize("groups,tile", [(16, 1024), (3, 4)])
def test_simhash_classes(make_docs, odd_rows, clash, monkeypatch, groups, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rows = [r for r in odd_rows] + [(1000 + d, t) for d, t in _docs_with_copies(random.Random(6))]
    fps = [_fp(t) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i + 1)
             if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = _roots(edges)
    named = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            named[root[i]] = min(d, named.get(root[i], d))
    want = Counter((d, f"{fps[i]:016x}", named.get(root[i])) for i, (d, _) in enumerate(rows))
    got = simhash.simhash_classes(make_docs(rows, clash), groups=groups)
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    assert Counter(map(tuple, got.select("doc_id", hexed, "component_id").collect())) == want
    kept = simhash.simhash_dedup(make_docs(rows, clash), groups=groups)
    assert kept.columns == make_docs(rows, clash).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        named.get(r) for r in set(root.values()))


def test_simhash_links_at_the_radius(spark):
    rng = np.random.default_rng(7)
    fps = [int(x) for x in rng.integers(-2**63, 2**63, 300)]
    fps += [x ^ 0b1111 for x in fps[:50]] + [x ^ 0b11111 for x in fps[50:100]]
    got = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in set(fps)], "fp long"), 4, 4)
    near = _roots([(a, b) for a in fps for b in fps if ((a ^ b) % 2**64).bit_count() <= 4])
    classes = {}
    for r in connected_components(got).collect():
        classes.setdefault(r.component, set()).add(r.node)
    want = {}
    for x, r in near.items():
        want.setdefault(r, set()).add(x)
    assert sorted(map(sorted, classes.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
    assert simhash.simhash_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


RULES = (url_filter.UrlRule("allow", "org", "/"), url_filter.UrlRule("block", "example.org", "/es/"),
         url_filter.UrlRule("block", "com", "/de/"), url_filter.UrlRule("allow", "good.com", "/de/ok"))


def test_url_rules_and_aliases(spark):
    link = '<html><LINK href="{}" rel="canonical"></html>'
    fresh = "<meta http-equiv='refresh' content='0; URL={}'>"
    rows = [(1, "http://A.example.org/es/x", None), (2, "http://notexample.org/es/x", ""),
            (3, "http://x.com/de/1", ""), (4, "http://good.com/de/ok1", ""), (5, "http://x.net/p?q=1#f", ""),
            (6, "http://r.net/a", link.format("http://x.com/de/1")),          # alias of a block
            (7, "https://s.net/b", fresh.format("/c")), (8, "http://s.net/c", link.format("//r.net/a")),
            (9, "http://t.net/", link.format("http://x.com/de/2")),           # block and allow: allow
            (10, "http://u.net/", link.format("http://t.net/")),
            (11, "http://t.net/", fresh.format("http://good.com/de/ok2")),
            (12, None, link.format("http://x.com/de/1")), (13, "no scheme", None), (14, "http://org/", None),
            (14, "http://org/", None), (15, "http://org?x", None), (None, "http://x.com/de/", None),
            (16, "http://v.net/d/e", link.format("f")), (17, "http://v.net/d/f", link.format("http://x.com/de/1"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("Host", F.lit(1))
    got = {}
    for r in url_filter.judge_pages(df, RULES).collect():
        got.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    assert got[1] == [("a.example.org", "/es/x", "example.org/es/", "block")]
    assert got[2][0][2:] == ("org/", "allow")
    assert got[3][0][2:] == ("com/de/", "block") and got[4][0][2:] == ("good.com/de/ok", "allow")
    assert got[5] == [("x.net", "/p", None, "allow")]
    assert [got[i][0][3] for i in (6, 7, 8, 16, 17)] == ["block"] * 5
    assert [got[i][0][3] for i in (9, 10, 11)] == ["allow"] * 3
    assert got[12] == got[13] == [("", "", None, "allow")]
    assert got[14] == [("org", "/", "org/", "allow")] * 2 and got[15][0][1:] == ("", None, "allow")
    assert got[None][0][3] == "block"
    assert url_filter.judge_pages(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_pages(df, ()).collect()} == {"allow"}


ALIASES = [
    ('<link rel=canonical href=http://y.net/1><link rel="canonical" href="http://x.com/de/1">', True),  # every tag
    ('<link rel="stylesheet" href="http://x.com/de/1">', False),
    ('<link href="../../de/./2" rel="canonical">', True),
    ('<link href="./../up/../../de/2/x/.." rel="canonical">', True),
    ('<link href="../../../../de/2/" rel="canonical">', True),
    ('<link href="?a=1&amp;b=/../2" rel="canonical">', True),
    ('<meta http-equiv="refresh" content="5; url=/q?c=1&#38;d=2">', True),
    ('<meta http-equiv="refresh" content="5; url=/q?c=1">', False),
    ('<link href="#top" rel="canonical"><link href="" rel="canonical">', False), ("", False), (None, False)]


def _alias_pages(spark):
    to = '<link rel="canonical" href="http://x.com/de/1">'
    rows = [(k, f"http://h{k}.net/a/b/page", html) for k, (html, _) in enumerate(ALIASES)]
    rows += [(100 + 10 * k + n, f"http://h{k}.net{path}", to) for k in range(len(ALIASES))
             for n, path in enumerate(["/de/2", "/de/2/", "/a/b/page?a=1&b=/../2", "/q?c=1&d=2"])]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_every_tag_entity_and_dot_segment(spark):
    got = {r.page_id: r.verdict for r in url_filter.judge_pages(_alias_pages(spark), RULES).collect()}
    assert [got[k] == "block" for k in range(len(ALIASES))] == [blocked for _, blocked in ALIASES]


def test_aliases_equal_sql(spark):
    """The registered query's SQL over pages that have aliases, by its own rules."""
    pages = _alias_pages(spark)
    got = url_filter.judge_pages(pages, URL_RULES).toPandas()
    con = duckdb.connect().register("pages", pages.toPandas())
    want = con.sql(LLM_ORACLE["op4_url_filter"]).df()
    rows = lambda df: sorted(map(str, df[sorted(want.columns)].convert_dtypes().values.tolist()))
    assert rows(got) == rows(want) and (got.verdict == "block").sum() > 40


@pytest.mark.parametrize("block, passes", [(50_000, 8), (100, 8), (40, 2)])
def test_decontamination(make_docs, spark, odd_rows, clash, monkeypatch, block, passes):
    """One broadcast, several, and the shuffle join of a large benchmark."""
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", block)
    monkeypatch.setattr(decontaminate, "MAX_BLOCKS", passes)
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, rng.randint(8, 40), 2000))) for i in range(12)] + [(90, None), (91, "a b")]
    rows = list(odd_rows)
    for i in range(60):
        w = words(rng, 60, 2000)
        if i % 3:
            leak = rng.choice(items[:12])[1].split()
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                leak[rng.randrange(len(leak))] = "sub"
            at = rng.randint(0, 60)
            w[at:at] = leak
        rows.append((100 + i, " ".join(w)))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("W", F.lit(0))
    got = decontaminate.contamination_report(make_docs(rows, clash), bench).collect()
    want = Counter((d, ",".join(map(str, sorted(leaks(t, items))))) for d, t in rows)
    assert Counter((r.doc_id, r["items"]) for r in got) == want
    assert all(r.contaminated == (r.n_items > 0) for r in got) and any(r.contaminated for r in got)
    kept = decontaminate.decontaminate(make_docs(rows, clash), bench)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, t in rows if not leaks(t, items))
    assert decontaminate.decontaminate(make_docs(rows), bench.limit(0)).count() == len(rows)
    assert decontaminate.contamination_report(make_docs(rows).limit(0), bench).count() == 0


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello é"), (1, 3, "ann", None),
            (2, 0, "system", "alone"), (None, 0, "ann", "x"), (None, 1, None, "y"), (3, 5, "z", "b"),
            (3, 5, "z", "a"), (3, 5, "z", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective): r for r in
           chat.rotate_perspectives(df.withColumn("K", F.lit(0)).withColumn("rn", F.lit(0))).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "ann"), (None, "unknown"), (3, "z")}
    r = got[1, "ann"]
    assert r.dialogue == ("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n"
                          "<|user name=bob|>\nhello é<|end|>\n<|assistant|>\n<|end|>\n")
    assert [r.dialogue[m.begin:m.begin + m.length] for m in r.masks] == ["hi<|end|>", "<|end|>"]
    assert [got[1, "bob"].dialogue[m.begin:m.begin + m.length] for m in got[1, "bob"].masks] == ["hello é<|end|>"]
    assert got[3, "z"].dialogue.count("a<|end|>") == 2 and got[3, "z"].n_turns == 3
    assert chat.rotate_perspectives(df.limit(0)).count() == 0
    parts = chat.rotate_perspectives(df, part_turns=2).where("conv_id = 1 and perspective = 'ann'").orderBy("part")
    assert "".join(p.dialogue for p in parts.collect()) == r.dialogue and parts.count() == 2
