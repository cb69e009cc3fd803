import random

import pytest
from llm_fixtures import prose

from tabwatch.llm import extraction

PAGES = {
    "<html><head><title>t</title><style>p{}</style></head><body><nav><a>Home</a></nav><article><h1>Top  it</h1><p>One &amp; <b>t</b>wo<br>three"
    "<script>x('</p>')</script><p>four</article><footer>f</footer></body></html>": "Top it One & two three four",
    "<body><header>site</header><main><div class='post-body'>A&nbsp;b</div><aside>side</aside><section id='comments'><p>rant</p></section>"
    "</main></body>": "A b",
    "<div class='cookie-notice'>we use</div><div class='content'>Text <i>here</i><form>q<input></form></div><div class='siteFooter footer'>x</div>": "Text here",
    "<article><p class='ad'>buy<p>real</article>": "real",
    "<article><ul><li>one<li class=promo>no<li>two</ul></article>": "one two",
    "<p>plain<p hidden>no</p><p style='display: none'>no</p><noscript>no</noscript>": "plain",
    "just text &lt;b&gt; &#233;": "just text <b> é",
    "<article><header><h1>Title</h1></header>Body<footer>share</footer></article>": "Title Body",
    "<article>a<article class='comment'>c</article>b</article>": "a b",
    "<!-- <p>no</p> --><p>yes</p><iframe>no</iframe>": "yes",
    "": "",
    "<nav>only</nav>": "",
}


@pytest.mark.parametrize("html", list(PAGES))
def test_pages(html):
    assert " ".join(extraction.page_blocks(html)[1]) == PAGES[html]


def test_template_runs_go_and_unique_runs_stay():
    rng = random.Random(1)
    frame = ["Welcome to our site and please log in", "Prices may change at any time without further word"]
    pages = [(k, False, [frame[0], f"story {k} " + prose(rng, "en", 40), frame[1]]) for k in range(12)]
    kept = extraction.keep_unique(pages)
    assert all(len(blocks) == 1 and blocks[0].startswith(f"story {k} ") for k, blocks in enumerate(kept))


def test_articles_may_quote_each_other():
    rng = random.Random(2)
    quote = prose(rng, "en", 60)
    pages = [(k, True, [prose(rng, "en", 30)] + ([quote] if k % 2 else [])) for k in range(12)]
    assert extraction.keep_unique(pages) == [blocks for _, _, blocks in pages]


def test_equal_contents_count_once_and_all_template_stays():
    block = "one two three four five six seven"
    assert extraction.keep_unique([(1, False, [block])] * 5) == [[block]] * 5
    assert extraction.keep_unique([(k, False, [block]) for k in range(5)]) == [[block]] * 5
    assert extraction.keep_unique([(1, False, []), (2, False, [])]) == [[], []]


def brute_force(pages):
    """{page_id: text} by the rule, for pages (page_id, framed, blocks) of one host."""
    key = {p: max(blocks, key=lambda b: (len(b.split()), b), default="") for p, _, blocks in pages}
    n, having, seen = len(set(key.values())), {}, set()
    for p, _, blocks in sorted(pages):
        if key[p] in seen:
            continue
        seen.add(key[p])
        words = " ".join(blocks).split()
        for i in range(len(words) - 4):
            having.setdefault(tuple(words[i : i + 5]), set()).add(key[p])
    out = {}
    for p, framed, blocks in pages:
        least = max(8, 0.9 * n) if framed else max(3, 0.3 * n)
        words, gone, at, kept = " ".join(blocks).split(), set(), 0, []
        for i in range(len(words) - 4):
            if len(having.get(tuple(words[i : i + 5]), ())) >= least:
                gone |= set(range(i, i + 5))
        for block in blocks:
            size = len(block.split())
            if len(gone & set(range(at, at + size))) * 2 < size:
                kept.append(block)
            at += size
        out[p] = " ".join(kept or blocks)
    return out


def _site(rng, n):
    """Pages of one host: a template on all, one on about 30 %, quotes in articles, copies and near copies."""
    notice, offer, quote = (prose(rng, "en", k).replace("\n", " ") for k in (9, 11, 14))
    story = prose(rng, "de", 50).replace("\n", " ")
    pages = []
    for k in range(n):
        framed = k % 3 == 0
        own = [story, f"seen on {k}"] if k % 5 == 1 else [f"story {k} " + " ".join(prose(rng, "fr", 25).split())]
        extra = [offer] if rng.random() < 0.3 else [quote] if framed and rng.random() < 0.6 else []
        pages.append((k, framed, [*extra, *(" ".join(b.split()) for b in own), notice]))
    return [(k, framed, [" ".join(b.split()) for b in blocks]) for k, framed, blocks in pages]


def _html(framed, blocks):
    text = "".join(f"<p>{b}</p>" for b in blocks)
    return f"<article>{text}</article>" if framed else f"<div>{text}</div>"


@pytest.mark.parametrize("broadcast", [True, False])
def test_large_host_against_brute_force(spark, monkeypatch, broadcast):
    """A host of several shards, and one small host: the shards make no difference, however the tables are joined."""
    if not broadcast:
        monkeypatch.setattr(extraction, "BROADCAST_HOSTS", 0)
    monkeypatch.setattr(extraction, "SHARD_PAGES", 40)
    rng = random.Random(4)
    large, small = _site(rng, 330), [(1000 + k, f, b) for k, f, b in _site(rng, 38)]
    rows = [(k, "http://large/x", _html(f, b)) for k, f, b in large] + [(k, "http://small/x", _html(f, b)) for k, f, b in small]
    got = {r["page_id"]: r["text"] for r in extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    wanted = brute_force(large) | brute_force(small)
    assert got == wanted
    assert any(" ".join(b) != wanted[k] for k, _, b in large)


def test_template_goes_on_all_pages_of_a_large_host(spark):
    line = "all prices on this site are subject to change"
    rows = [
        (k, "https://one.example/p", _html(k % 2 == 0, [line, f"entry {k} speaks of {k * 7} things and of {k * 11} others too"])) for k in range(5120)
    ]
    got = extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5))
    assert got.count() == 5120 and got.where(f"text LIKE '%{line}%'").count() == 0
    assert got.where("text LIKE 'entry %'").count() == 5120


@pytest.mark.parametrize("n", [10, 900])
def test_near_copies_keep_their_text(spark, n):
    rng = random.Random(6)
    story = [" ".join(prose(rng, "en", k).split()) for k in (60, 30, 40)]
    rows = [
        (k, "https://one.example/p", _html(False, [*story, f"day {k}"] if k % 5 < 2 else [f"tale {k} " + " ".join(prose(rng, "de", 40).split())])) for k in range(n)
    ]
    texts = {r["page_id"]: r["text"] for r in extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(texts[k] == " ".join([*story, f"day {k}"]) for k in range(n) if k % 5 < 2)


def test_main_text(spark):
    rng = random.Random(3)
    rows, wanted = [], {}
    for k in range(600):
        body = " ".join(prose(rng, "en", 20).split())
        host = "hot.example" if k % 2 else f"h{k % 40}.example"
        rows.append((k, f"https://{host}/p/{k}", f"<div>All rights reserved by the owners of this</div><div>{body}</div>", "x", "y"))
        wanted[k] = body
    rows += [(9000, None, None, "x", "y"), (9001, "no url", "", "x", "y"), (9002, "http://h1.example", "<p>w</p>" * 50_000, "x", "y")]
    pages = spark.createDataFrame(rows + rows[-2:], "page_id long, url string, html string, host string, salt string").repartition(4)
    got = extraction.main_text(pages).collect()
    assert len(got) == len(rows) + 2
    texts = {r["page_id"]: r["text"] for r in got}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert texts[9000] == texts[9001] == "" and texts[9002] == " ".join(["w"] * 50_000)
    assert sum(texts[k] == wanted[k] for k in wanted) == len(wanted)
    assert extraction.main_text(pages.limit(0)).count() == 0
