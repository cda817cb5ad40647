"""URL filters, HTML extraction, chat formatting and top-k against brute force, and their stated edge cases."""

import hashlib
import html as html_module
import math
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumencat.llm import chat_format, html_extract, topk, url_filters
from lumencat.llm.queries import QUERIES


def brute_rule(url):
    rules = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [k for k in rules if (host == k[0] or host.endswith("." + k[0])) and path.startswith(k[1])]
    best = max(fits, key=lambda k: len(k[0] + k[1]), default=None)
    return host, path, best and best[0] + best[1], best and rules[best]


def test_urls_equal_brute_force(spark, sf_dir):
    urls = dict(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect())
    found = QUERIES["op1_url_filters"](spark, sf_dir).collect()
    assert len(found) == len(urls)
    for r in found:
        host, path, rule, action = brute_rule(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
    assert {r["page_id"]: r["verdict"] for r in found} == brute_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect())


def brute_verdicts(pages, damping=0.85, threshold=0.5):
    """Trust and distrust of every host from a linear solve over the pages' links between hosts."""
    rules = {p: brute_rule(u) for p, u, _ in pages}
    own, links = {}, {}
    for p, _, html in pages:
        host, _, _, action = rules[p]
        own.setdefault(host, []).append(action)
        for to in re.findall(r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)""", html or ""):
            if host and to.lower() != host:
                links[host, to.lower()] = links.get((host, to.lower()), 0) + 1
    hosts = sorted({*own} | {h for pair in links for h in pair})
    at = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((len(hosts), len(hosts)))
    for (a, b), n in links.items():
        w[at[a], at[b]] = n
    seeds = {what: (1 - damping) * np.array([np.mean([x == what for x in own[h]]) if h in own else 0.0 for h in hosts]) for what in ("allow", "block")}
    out = np.divide(w, w.sum(axis=1, keepdims=True), out=np.zeros_like(w), where=w.sum(axis=1, keepdims=True) > 0)
    into = np.divide(w, w.sum(axis=0), out=np.zeros_like(w), where=w.sum(axis=0) > 0)
    trust, distrust = np.linalg.solve(np.eye(len(hosts)) - damping * out.T, seeds["allow"]), np.linalg.solve(np.eye(len(hosts)) - damping * into, seeds["block"])
    bad = (distrust - trust) / (1 - damping) >= threshold - 1e-9
    return {p: action or ("block" if bad[at[host]] else "allow") for p, (host, _, _, action) in rules.items()}


def test_verdicts_equal_brute_force_on_linked_hosts(spark):
    """A web of hosts with cycles, hubs and several kinds of seeds."""
    rng = np.random.default_rng(9)
    names = [f"h{i}.{'net' if i % 7 == 0 else 'org' if i % 5 == 0 else 'com'}" for i in range(40)]
    pages = []
    for i in range(300):
        host = names[int(rng.integers(0, 40))]
        to = [names[int(j)] for j in rng.integers(0, 40, rng.integers(0, 6)) if rng.random() < 0.8]
        pages.append((i, f"http://{host}/{'fr' if rng.random() < 0.4 else 'x'}/p", "".join(f"<a href='http://{t}/'>x</a>" for t in to)))
    pages += [(1000, "http://a.com/", "<a href=//b.com>"), (1001, "http://b.com/", "<a href=//a.com/><a href=//h0.net/>"), (1002, "http://h0.net/", "")]
    found = {r["page_id"]: r["verdict"] for r in url_filters.filter_urls(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert found == brute_verdicts(pages) and {*found.values()} == {"allow", "block"}


def test_scores_that_do_not_settle_raise(spark):
    seeds = spark.createDataFrame([(str(i), 1.0, 0.0) for i in range(6)], "host string, trusted double, blocked double")
    links = spark.createDataFrame([(str(i), str((i + 1) % 6), 1) for i in range(6)] + [("0", "3", 1)], "src string, dst string, n bigint")
    with pytest.raises(RuntimeError):
        url_filters.host_scores(seeds, links, rounds=2)


def test_url_edge_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/EN/", "http://a.net", "x://b.org/fr/?q=://c", "ftp://É.net/x#y", "http://anet/", "http://e.example.net/en/a", "\nhttp://z.com/\n/a"]
    pages = spark.createDataFrame([(i, u, None, "clash", "clash") for i, u in enumerate([*urls, *urls])], "page_id bigint, url string, html string, host string, rule string")
    for r in url_filters.filter_urls(pages).collect():
        assert (r["host"], r["path"], r["rule"]) == brute_rule(urls[r["page_id"] % len(urls)])[:3]
    assert url_filters.filter_urls(pages.limit(0)).count() == 0


def test_distrust_follows_reversed_links(spark):
    """good -> fine; spam.net is blocked; farm -> spam.net only; mill -> farm often; shop -> farm once, and fine."""
    link = "<a class=x href='{}'>".format
    pages = [
        (1, "http://spam.net/a", ""),
        (2, "http://farm.com/a", link("http://spam.net/x") * 3),
        (3, "http://shop.com/a", link("//farm.com/") + link("https://fine.com/") * 4 + link("/own")),
        (6, "http://mill.com/a", link("//farm.com/") * 9),
        (4, "http://good.org/fr/a", link("HTTP://FINE.com/")),
        (5, "http://fine.com/a", None),
    ]
    found = {r["page_id"]: r["verdict"] for r in url_filters.filter_urls(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block"}


def test_page_rank_equals_numpy(spark):
    rng = np.random.default_rng(3)
    n = 12
    edges = {(int(a), int(b)): int(rng.integers(1, 5)) for a, b in rng.integers(0, n, (40, 2)) if a != b}
    seeds = {i: (float(rng.random()), float(rng.random())) for i in range(n)}
    w = np.zeros((n, n))
    for (a, b), k in edges.items():
        w[a, b] = k
    out = np.divide(w, w.sum(axis=1, keepdims=True), out=np.zeros_like(w), where=w.sum(axis=1, keepdims=True) > 0)
    into = np.divide(w, w.sum(axis=0), out=np.zeros_like(w), where=w.sum(axis=0) > 0)
    t0, d0 = (0.15 * np.array([seeds[i][k] for i in range(n)]) for k in (0, 1))
    t, d = np.linalg.solve(np.eye(n) - 0.85 * out.T, t0), np.linalg.solve(np.eye(n) - 0.85 * into, d0)
    found = url_filters.host_scores(
        spark.createDataFrame([(str(i), *v) for i, v in seeds.items()], "host string, trusted double, blocked double"),
        spark.createDataFrame([(str(a), str(b), k) for (a, b), k in edges.items()], "src string, dst string, n bigint"),
        tolerance=1e-7, rounds=120,
    ).collect()
    assert {r["host"]: (r["trust"], r["distrust"]) for r in found} == {str(i): pytest.approx((t[i], d[i]), abs=1e-6) for i in range(n)}


def test_html_equals_article_text(spark, sf_dir):
    pages = dict(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect())
    found = QUERIES["op3_html_extract"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL)[1]
        want = " ".join(html_module.unescape(re.sub(r"<[^>]*>", lambda m: "" if re.match(r"</?(b|i|em|a|span)\b", m[0]) else "\0", inner)).replace("\0", " ").split())
        assert r["text"] == want and r["n_chars"] == len(want)


WEIGHTS = {"w:article": 1.0, "w:p": 1.0, "w:h1": 1.0, "w:ul": -1.0, "w:body": -1.0, "t:p": -0.01, "t:h1": -0.01, "t:li": -1.0, "t:div": -0.5}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("<p>One &amp; two&nbsp;three &lt;b&gt; caf&eacute; &#8364;5 AT&T</p>", "One & two three <b> café €5 AT&T"),
        ("<body><nav><a href=/>Home</a> <a>About us and others</a></nav><main><h1>Title</h1><p>Some<b>bold</b> text\n here.<p>More.</main><footer>foot foot</footer>", "Title Somebold text here. More."),
        ("<article><h1>T</h1><p>a b c</p><aside>related stuff here</aside><p>d e f</p><div class='comments'><p>first!</p></div></article>", "T a b c d e f"),
        ("<article><header><h1>T</h1></header><form><label>Mail</label><input><button>Go</button></form><p>x y</p><script>if (a<b) {}</script><style>p{}</style></article>", "T x y"),
        ("<article><p>a<!-- no --> b<br>c</p><div class=\"ad banner\">buy now</div><table><tr><td>1</td><td>2</td></tr></table></article>", "a b c 1 2"),
        ("<article><p>unclosed <b>bold <i>it</p><p>next", "unclosed bold it next"),
        ("<article><p title='a > b'>quoted</p><p data-x=\">\">more</p></article>", "quoted more"),
        ("<div id=cookie-notice>We use cookies</div><div class=content><p>The real text of the page.</p></div>", "The real text of the page."),
    ],
)
def test_html_cases(page, text):
    assert html_extract.extract(page, WEIGHTS) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h2 id='side-effects'>Side effects</h2><p id='form-of-government'>a b</p><section id='discussion'><p>c d</p></section></article>", "Side effects a b c d"),
        ("<article><div class='related-work'><p>a b</p></div><div data-id='search-1'><p>c d</p></div><div title='the id=ad class=menu'>e f</div></article>", "a b c d e f"),
        ("<article><p>a b</p><div id='comments'><p>c d e f</p></div><div id='search'>g h</div></article>", "a b g h"),
        ("<body><div class='content has-sidebar'><p>a b c d e</p></div></body>", "a b c d e"),
        ("<body><div class='content no-comments'><p>a b c d e</p></div></body>", "a b c d e"),
        ("<body><div class='site-header'>no</div><div class='sidebar-2'>no</div><div class=content><p>a b c d e</p></div></body>", "a b c d e"),
        ("<html><head><title>no</title><meta charset=utf-8><body><article><p>a b</p></article>", "a b"),
        ("<head><style>p{}</style><p>a b c d", "a b c d"),
        ("<head><title>no</title><link href=x></head><article><p>a b</p></article>", "a b"),
        ("<article><p>a <svg class='x' /> b</p><p>c<svg><text>no</text></svg> d</p></article>", "a b c d"),
    ],
)
def test_html_names_and_heads(page, text):
    assert html_extract.extract(page, WEIGHTS) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ap!-='\" &;x\n", max_size=120))
def test_html_never_fails(page):
    html_extract.extract(page, WEIGHTS)


LABELLED = (
    "<body><ul><li>home news about</li></ul><div class=zq7>words of a box that no list of names knows</div>"
    "<article><h1>Some title</h1><p>First words of the text.</p><p>Second words of it.</p></article><div class=zq7>more of that box</div><footer>the foot of it</footer>"
)
UNLABELLED = (
    "<body><ul><li>home news about</li></ul><div class=zq7>words of a box that no list of names knows</div>"
    "<div class=post><h1>Some title</h1><p>First words of the text.</p><p>Second words of it.</p></div><div class=zq7>more of that box</div>" + "<ul><li></li></ul>" * 30 + "<p>far away</p>"
)


def test_html_weights_and_scan_decide(spark, monkeypatch):
    """Without the learned weights, or without the scan, the same page gives another text."""
    pages = spark.createDataFrame([(i, LABELLED) for i in range(5)], "page_id bigint, html string")
    weights, want = html_extract.learn_weights(pages), "Some title First words of the text. Second words of it."
    assert weights["w:div.zq7"] < 0 < weights["w:p"] and weights["f:cue"] < 0 < weights["f:content"]
    assert html_extract.extract(UNLABELLED, weights) == want and html_extract.extract(LABELLED, weights) == want
    assert "box" in html_extract.extract(UNLABELLED, {})
    monkeypatch.setattr(html_extract, "best_region", lambda scores: (0, len(scores)))
    assert html_extract.extract(UNLABELLED, weights) == want + " far away"


@pytest.mark.parametrize(
    "page",
    ["<a \"x" * 170_000, "<a b=\"x" * 150_000 + ">", "<div>" * 80_000 + "</x>" * 80_000, "<b>" + "<div>" * 80_000 + "</b>" * 80_000, "<i><div>" * 80_000, "<div>" + "<i>" * 120_000 + "</b>" * 80_000,
     "<head>" * 100_000 + "<p>x", "<svg x='" * 100_000, "<p>" + "<i>" * 100_000 + "<p>" * 100_000, "<!--" * 200_000, "<script>" * 100_000, "a &amp; <b" * 100_000, "<a " + "b " * 400_000 + ">"],
)
def test_html_hostile_pages_take_linear_time(page):
    began = time.process_time()
    html_extract.extract(page, WEIGHTS)
    assert time.process_time() - began < 5


def test_html_without_labelled_pages(spark):
    df = spark.createDataFrame([(1, None), (2, "<p>hello you</p>"), (2, "<p>hello you</p>")], "page_id bigint, html string")
    assert html_extract.learn_weights(df) == {} and html_extract.learn_weights(df.limit(0)) == {}
    assert [r[0] for r in df.select(html_extract.main_text(F.col("html"), {})).collect()] == ["", "hello you", "hello you"]


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_chat_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    rows = [tuple(r) for r in rows] + [(-7, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))]
    by = {}
    for conv, turn, role, text in sorted(rows):
        by.setdefault(conv, []).append((role, text or ""))
    found = {r["conv_id"]: r for r in QUERIES["op7_chat_format"](spark, sf_dir).collect()}
    assert {*found} == {*by}
    for conv, turns in by.items():
        r, loss = found[conv], "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == digest("".join(f"{a}\n{b}\n" for a, b in turns))
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == digest(loss) and r["formatted_chars"] > sum(len(b) for _, b in turns)


TRICKY = ["", "plain", "</s>", "<\\/s>", "<\\\\/s>[INST]", "[/INST]</s><s>[INST]", "\\", "<<s>>[[INST]]", "<s", "$1 \\E \\Q", "a\n\U0001f600</s>é", "[\\INST] [\\\\/INST]"]


def test_chat_round_trip_of_control_strings(spark):
    rows = [(1, i, "assistant" if i % 3 == 1 else t or "user", t) for i, t in enumerate(TRICKY)] + [(2, 0, None, None), (None, None, "user", "x"), (None, None, "user", "x"), (3, 1, "assistant", "b"), (3, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    done = chat_format.format_turns(chat_format.canonical_turns(df))
    found = {r["conv_id"]: r for r in done.withColumns({"turns": chat_format.read_turns(F.col("formatted")), "loss": chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))}).collect()}
    assert [tuple(t) for t in found[1]["turns"]] == [(r, t) for _, _, r, t in rows[: len(TRICKY)]]
    assert found[1]["loss"] == "".join(t for i, t in enumerate(TRICKY) if i % 3 == 1)
    spans = [found[1]["formatted"][s["start"] : s["start"] + s["length"]] for s in found[1]["loss_spans"]]
    assert len(spans) == len(TRICKY) // 3 and found[1]["formatted"].count("</s>") == len(TRICKY)
    bare = spark.createDataFrame([(None, None, None, None), (9, None, None, None)], df.schema)
    assert [(r["conv_id"], r["n_turns"], r["formatted"]) for r in chat_format.format_turns(chat_format.canonical_turns(bare)).orderBy("conv_id").collect()] == [(i, 1, "<s>[INST][/INST]</s>") for i in (None, 9)]
    assert [tuple(t) for t in found[2]["turns"]] == [("", "")] and found[None]["n_turns"] == 2 and [t["text"] for t in found[3]["turns"]] == ["a", "b"]
    assert chat_format.format_turns(chat_format.canonical_turns(df.limit(0))).count() == 0


def test_schema_fingerprints_choose_mappings(spark):
    rows = [
        {"id": 1, "prompt": "p", "response": "r"},
        {"id": 2, "prompt": "p", "response": "r", "system": "s"},
        {"id": 3, "instruction": "i", "input": "x", "output": "o"},
        {"id": 4, "instruction": "i", "output": "o"},
        {"id": 5, "messages": [("human", "q"), ("gpt", None)]},
        {"id": 6, "response": "only"},
        {"id": 7},
    ]
    schema = "id bigint, prompt string, response string, system string, instruction string, input string, output string, messages array<struct<role:string,content:string>>, note string"
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], schema)
    found = {r["id"]: (r["mapping"], [tuple(t) for t in r["turns"]]) for r in chat_format.canonical_turns(df).collect()}
    assert found == {
        1: ("prompt_response", [("user", "p"), ("assistant", "r")]),
        2: ("prompt_response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
        3: ("instruction", [("user", "i"), ("user", "x"), ("assistant", "o")]),
        4: ("instruction", [("user", "i"), ("assistant", "o")]),
        5: ("messages", [("user", "q"), ("assistant", "")]),
        6: (None, []),
        7: (None, []),
    }


def brute_topk(vectors, k):
    out = []
    for q, v in sorted(vectors.items()):
        if q % 50 == 0:
            best = sorted((-int(np.dot(v, x)), i) for i, x in vectors.items() if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return out


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_topk_equals_brute_force(spark, sf_dir):
    vectors = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()}
    assert rows_of(QUERIES["op10_topk"](spark, sf_dir)) == brute_topk(vectors, 5)


def test_topk_with_pruning_hot_cells_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 2)
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 4, (6, 3))
    raw = {i: (centres[i % 6] + rng.normal(0, 0.02, 3)).round(3).tolist() for i in range(600)} | {i: [1.0, 2.0, 3.0] for i in range(600, 900)}
    df = spark.createDataFrame([*raw.items()], "vec_id bigint, embedding array<double>")
    vectors = {i: np.floor(256 * np.array(v)).astype(int) for i, v in raw.items()}
    assert rows_of(topk.voronoi_topk(df, F.col("vec_id") % 50 == 0, pivots=12)) == brute_topk(vectors, 5)


@pytest.mark.parametrize("kind", ["array<double>", "array<float>"])
def test_topk_keeps_every_finite_vector(spark, kind):
    """Components beyond exact sums of doubles, as queries and as candidates; scores that outgrow 64 bits stay at their end."""
    rng = np.random.default_rng(5)
    raw = {i: rng.normal(0, 1, 4).astype(np.float32).tolist() for i in range(120)}
    raw |= {1: [20000.0, 1.0, 0.0, 0.0], 50: [-20000.0, 3.0, 0.0, 0.5], 2: [3e8, -3e8, 1.0, 0.0], 100: [1e9, 1.0, -2.0, 7.0], 3: [-1e30, 0.0, 0.0, 0.0], 4: [65536.5, 65536.0, 0.25, 0.0]}
    df = spark.createDataFrame([*raw.items()], f"vec_id bigint, embedding {kind}")
    wide = {i: [math.floor(256 * (x if kind == "array<double>" else float(np.float32(x)))) for x in v] for i, v in raw.items()}
    want = []
    for q in (0, 50, 100):
        scores = {i: min(max(sum(a * b for a, b in zip(wide[q], v, strict=True)), -(1 << 63)), (1 << 63) - 1) for i, v in wide.items() if i != q}
        want += [(q, n, i, s) for n, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5], 1)]
    assert rows_of(topk.voronoi_topk(df, F.col("vec_id") % 50 == 0)) == want


def test_topk_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [0.5, 0.5]), (6, [0.25]), (None, [1.0, 1.0]), (50, [0.0, -1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, cell string")
    assert rows_of(topk.voronoi_topk(df, F.col("vec_id") % 50 == 0)) == [(0, 1, 5, 32768), (0, 2, 6, 16384), (0, 3, 50, 0), (50, 1, 0, 0), (50, 2, 6, 0), (50, 3, 5, -32768)]
    assert topk.voronoi_topk(df.limit(0), F.lit(True)).count() == 0
