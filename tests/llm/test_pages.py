"""Page operators: extraction and URL rules."""

import random

import pytest

from cartwheel.llm import extraction, urls
from cartwheel.llm.dom import blocks, parse

PAGE = "page_id long, url string, html string"


def page(article, extra="", head="<h1>Title</h1>"):
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header>Site name</header><nav><ul><li><a href='/a'>A</a></li>"
            f"</ul></nav><div class=\"cookie-notice\">We use cookies</div><article>{head}{article}</article>{extra}<section class='comments'><p>First!</p></section>"
            f"<aside>More</aside><footer>&copy; x</footer><script>var p='</p><p>no';</script></body></html>")


def extracted(spark, rows):
    df = spark.createDataFrame(rows, PAGE)
    from pyspark.sql import functions as F
    got = extraction.extract_pages(df.withColumn("host", F.lit("x")).withColumn("rule", F.lit("y")).withColumn("of", F.lit(1))).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return sorted(((r.page_id, r.url, r.text) for r in got), key=str)


def test_articles_without_boilerplate(spark):
    rows, want = [], []
    rng = random.Random(2)
    for i in range(30):
        paras = [f"para {i} {k} {rng.random()} &amp; &#233;  two\n spaces" for k in range(rng.randrange(1, 5))]
        share = "<div class='tools'>Share this</div>" if i else ""
        rows.append((i, f"https://A.example.org/{i}", page("".join(f"<p>{p}</p>" for p in paras) + share)))
        text = ["Title"] if i < 0 else []
        want.append("\n".join(text + [" ".join(p.replace("&amp;", "&").replace("&#233;", "é").split()) for p in paras]))
    got = extracted(spark, rows)
    # "Title" and "Share this" are the same on every page: template
    assert [t for _, _, t in got] == [want[int(i)] for i, _, _ in got]


def test_siblings_of_the_longest_part_are_kept(spark):
    rng = random.Random(4)

    def long():
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
    shapes = {  # html, and what must be left of it
        "a": ("<nav>m{0}</nav><h1>T {0}</h1><div class=post>{1}</div><footer>f</footer>", "T {0}\n{1}"),
        "b": ("<div class=top>Site</div><div class=x><div><h2>T {0}</h2><p>{1}</p></div></div>", "T {0}\n{1}"),
        "c": ("<div class=x>lead {0}<div><p>{1}</p><ul><li>end {0}</li></ul></div></div><div>Made by us</div>", "lead {0}\n{1}\nend {0}"),
        "d": ("<div>Made by us</div><h1>T {0}</h1><div>{1}</div>", "Made by us\nT {0}\n{1}"),  # one path, so the constant part stays too
        "e": ("<div class=s{2}>s {0}</div><div class=post>{1}</div>", "s {0}\n{1}"),  # more signatures than a wrapper keeps
    }
    rows, want = [], {}
    for k, (host, (html, left)) in enumerate(shapes.items()):
        for i in range(230 if host == "e" else 8):
            text, slug = long(), "".join(chr(97 + int(c)) for c in str(i))
            rows.append((1000 * k + i, f"http://{host}/{i}", f"<html><head><title>t</title></head><body>{html.format(i, text, slug)}</body></html>"))
            want[1000 * k + i] = left.format(i, text)
    got = {i: t for i, _, t in extracted(spark, rows)}
    assert [i for i in want if got[i] != want[i]] == []


def test_names_are_whole_tokens_and_drop_no_article(spark):
    a = "<article><p>One {0}</p><p class='{1}'>Two</p></article>"
    single = {  # one page each: html, and what must be left of it
        "<body class='no-sidebar menu'>" + a: "One\nTwo", "<div class='content has-sidebar'><h1>One</h1><p>Two</p></div>": "One\nTwo",
        "<article class='post comments-open comments'><p>One</p><p class='related'>Two</p></article>": "One\nTwo",
        "<article><p class=share>One</p><p class='side'>Two</p><p id=search>x</p></article>": "One\nTwo\nx",
        "<div class=modal><nav>m</nav><main class=header><p>One</p>Two</main></div>": "One\nTwo", "<form>t<article>One</article></form>": "One",
        "<div class=sidebar><article>Teaser, which is long</article></div><article>One</article>": "One",
        "<article><div class=header><h1>One</h1></div>Two<div class='ad-'>buy</div><div class='x cookie-notice'>c</div></article>": "One\nTwo",
        "<article>One<div id=comments><article class=comment>First!</article></div><article class='comment'>no</article></article>": "One",
        "<p>One</p><div class='comment-list'>no</div><div class='menu footer'>no</div><div role=navigation>no</div>": "One"}
    rows, want = [], {}
    for i, (html, left) in enumerate(single.items()):
        rows.append((i, f"http://single{i}/", html.format("", "related share side search").replace("One ", "One")))
        want[i] = left
    long = "word " * 40
    shapes = {"m": ("<h1>T {0}</h1><div class='modal'>{1}{0}</div><div class=comments>{1}{1}{1}</div>", "T {0}\n{1}{0}"),
              "f": ("<form id=f><div class='ad'>buy {0}</div><p>{1}{0}</p></form>", "{1}{0}"),
              "s": ("<article><h1>T {0}</h1><div class=promo>{1}{0}</div></article><div class=sidebar>{1}{1}{0}</div>", "T {0}\n{1}{0}")}
    for k, (host, (html, left)) in enumerate(shapes.items()):
        for i in range(8):
            rows.append((100 * (k + 1) + i, f"http://{host}/{i}", f"<body class='no-sidebar'>{html.format(i, long + str(i * i) + ' ')}</body>"))
            want[100 * (k + 1) + i] = left.format(i, long + str(i * i) + " ")
    got = {i: t for i, _, t in extracted(spark, rows)}
    assert got[100].startswith("T 0\nword") and [(i, got[i], want[i]) for i in want if got[i] != want[i]] == []


def test_without_evidence_elements_and_names_decide(spark):
    same = page("<p>One</p><p>Two<br>three</p><form>x</form><!-- c --><div class='ad'>buy</div>")
    rows = [(1, "http://one/1", same), (1, "http://one/1", same), (2, "http://b/", None), (3, None, ""), (4, "x", "plain <b>text"),
            (5, "http://c/", "<p>unclosed <p>next <i>it"), (6, "http://d/", "<main><p>m</p></main><p>other</p>"), (7, "http://e/", "<" * 5_000),
            (8, "http://f/", "<div>" * 3_000 + "deep"), (9, "http://g/", "<p>a</p>" * 20_000)]
    got = {i: t for i, _, t in extracted(spark, rows)}
    assert got[1] == "Title\nOne\nTwo\nthree" and got[2] == got[3] == "" and got[4] == "plain text"
    assert got[5] == "unclosed\nnext it" and got[6] == "m" and got[8] == "deep" and got[9].count("\n") == 19_999
    assert spark.createDataFrame([], PAGE).transform(extraction.extract_pages).count() == 0


def test_wrappers_merge_in_any_order_and_count_pages(spark):
    trees = [extraction.skeleton([parse(page(f"<p>{i}</p>" * (i % 3 + 1), "<div>x</div>" * (i % 2)))]) for i in range(7)]
    whole = trees[0]
    for t in trees[1:]:
        whole = extraction.merge(whole, t)
    left, right = trees[0], trees[3]
    for t in trees[1:3]:
        left = extraction.merge(left, t)
    for t in trees[4:]:
        right = extraction.merge(right, t)
    other = extraction.merge(left, right)
    assert whole[1] == other[1] == 7 and extraction.rule_of(whole) == extraction.rule_of(other)
    assert extraction.rule_of(whole)["slot"] == ["html", "body", "article"]


def test_tree_matching_keeps_order_and_parents():
    def tree(s):
        return extraction.skeleton([parse(s)])
    assert extraction.matching(tree("<a><b></b><i></i></a>"), tree("<a><b></b><u></u><i></i></a>")) == 4
    assert extraction.matching(tree("<a><i></i><b></b></a>"), tree("<a><b></b><i></i></a>")) == 3
    assert extraction.matching(tree("<a></a>"), tree("<b><a></a></b>")) == 1


def test_blocks():
    root = parse("<div>a <b>b</b>\n c<p>d</p>e<script>x</script> f</div>&lt;g&gt;")
    assert blocks(root, lambda child, parent: False) == ["a b c", "d", "e f", "<g>"]


def brute(url, rules, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]

    def fits(key):
        h, p = key[:key.index("/")], key[key.index("/"):]
        return (host == h or host.endswith("." + h)) and path.startswith(p)
    best = max((k for k, _ in rules if fits(k)), key=len, default=None)
    if best:
        return host, path, best, dict(rules)[best]
    return host, path, None, "block" if any(map(fits, listed)) else "allow"


@pytest.mark.parametrize("bound", [200_000, 0])
def test_url_rules_match_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(urls, "BROADCAST_ROWS", bound)
    found = [None, "", "no scheme", "http://", "http://net/", "https://A.b.NET/x", "http://example.net/en/1?q", "http://example.net/en", "http://www.example.com/de/9",
             "http://m.example.org/fr/", "http://xorg/fr/", "http://casino-win.example.com/a", "http://a?u=b://net/x", "http://b.net?x/", "http://c.net#f", "ftp://x.org/fr/a://b",
             "http://é.net/", "http://" + "a." * 3_000 + "net/", "http://net/" + "x" * 20_000] + ["http://w.net/same"] * 300
    rules, listed = urls.default_rules(spark)
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(found)], "page_id long, url string, host string, verdict string")
    got = urls.filter_urls(pages, rules, listed).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == [
        (i, *brute(u, urls.RULES, urls.LISTED)) for i, u in enumerate(found)]
    none = spark.createDataFrame([], "key string, verdict string")
    assert {r.verdict for r in urls.filter_urls(pages, none, none.select("key")).collect()} == {"allow"}
    assert urls.filter_urls(pages.limit(0), rules, listed).count() == 0


@pytest.mark.parametrize("bound", [200_000, 0])
def test_list_and_urls_are_looked_up_in_canonical_form(spark, monkeypatch, bound):
    monkeypatch.setattr(urls, "BROADCAST_ROWS", bound)
    block = ["http://casino-win.example.com?x=1", "http://casino-win.example.com", "https://CASINO-win.example.com:443/en", "http://casino-win.example.com:8080/",
             "http://casino-win.example.com./a", "http://me:pw@www.casino-win.example.com/a", "http://casino-win.example.com:#f", "http://a@b@casino-win.example.com.:080?q"]
    allow = ["http://casino-win.example.com@fine.example/", "http://casino-win.example.community/", "http://xcasino-win.example.com/", "https://fine.example:8443/a", "http://"]
    rules, listed = urls.default_rules(spark)
    pages = spark.createDataFrame(list(enumerate([*block, *allow])), "page_id long, url string")
    got = {r.url: r for r in urls.filter_urls(pages, rules.limit(0), listed).collect()}
    assert {u for u, r in got.items() if r.verdict == "block"} == set(block)
    assert {got[u].listed for u in block} == {"casino-win.example.com/"} and {got[u].host for u in block[3:4]} == {"casino-win.example.com:8080"}
    # a table of any form of keys; rules stay by host and path as they stand
    own = spark.createDataFrame([("HTTPS://u@Fine.Example.:443",), ("odd.example:8443/x?q",), ("bare.example",), (None,), ("",)], "key string")
    found = ["http://www.fine.example?y", "https://odd.example:8443/xy", "https://odd.example/xy", "https://a.odd.example:8443/xy", "http://bare.example:1/p", "http://net./x"]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    got = {r.url: (r.rule, r.verdict, r.listed) for r in urls.filter_urls(pages, rules, own).collect()}
    assert [got[u] for u in found] == [(None, "block", "fine.example/"), (None, "block", "odd.example:8443/x"), (None, "allow", None),
                                       (None, "block", "odd.example:8443/x"), (None, "block", "bare.example/"), (None, "allow", None)]


def test_bloom_filter_has_no_false_negatives(spark):
    from pyspark.sql import functions as F
    keys = spark.range(3_000).select(F.concat(F.lit("host"), F.col("id").cast("string"), F.lit("/")).alias("key"))
    blocks_ = 3_000 * urls.BITS_PER_KEY // 512
    probe = spark.range(6_000).select("id", F.concat(F.lit("host"), F.col("id").cast("string"), F.lit("/")).alias("key"))
    passed = probe.withColumn("block", urls._block(F.col("key"), blocks_)).join(urls.bloom(keys, blocks_), "block").where(urls.may_hold(F.col("key")))
    ids = {r.id for r in passed.collect()}
    assert ids >= set(range(3_000)) and len(ids) < 3_000 + 150
