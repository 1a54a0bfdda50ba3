"""Main text of pages built from known articles, and the parts of the method by brute force."""

import random
import time

import pytest

from accessaudit.llm import wrappers as w

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()


def say(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def page(rng, host, blocks, layout):
    """A page of one of three layouts, with all that is not the article."""
    menu = "".join(f'<li><a href="/{i}">{say(rng, 1)}</a>' for i in range(5))
    junk = f'<script>if (1 < 2) document.write("<p>{say(rng, 3)}</p>")</script><!-- <p>{say(rng, 4)}</p> -->'
    ps = "".join(f"<p>{b}" for b in blocks[1:])
    comments = f'<section id="comments"><article class="comment"><p>{say(rng, 9)}</p></article></section>'
    around = f'<header><h2>{host}</h2></header><nav><ul>{menu}</ul></nav><div class="ad-box">{say(rng, 6)}</div>'
    after = f'<aside>{say(rng, 5)}</aside><form><label>{say(rng, 2)}</label><input value="x"></form><footer>&copy; {host}</footer>'
    if layout == 0:
        body = f"{around}{junk}<article><h1>{blocks[0]}</h1>{ps}</article>{comments}{after}"
    elif layout == 1:
        body = f'{around}<div id="content"><h1>{blocks[0]}</h1>{ps}</div><div class="cookie-notice">{say(rng, 4)}</div><div class="promise">We love news.</div>{junk}{after}'
    else:
        body = f'<table><tr><td class="menu">{menu}<td><h1>{blocks[0]}</h1>{ps}</table><div>About {host}</div>{after}'
    return f"<!DOCTYPE html><html><head><title>{say(rng, 3)}</title><style>p {{x: y}}</style></head><body>{body}</body></html>"


def made(seed=1, n=40):
    rng = random.Random(seed)
    rows, want = [], {}
    for i in range(n):
        layout = i % 3
        blocks = [say(rng, rng.randint(2, 20)) for _ in range(rng.randint(2, 6))]
        host = f"h{layout}.example.com"
        rows.append((i, f"http://{host}/{i}", page(rng, host, blocks, layout)))
        want[i] = " ".join(blocks)
    return rows, want


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")


def test_articles_come_out_whole(spark):
    rows, want = made()
    got = w.main_text(frame(spark, rows)).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert {(r["page_id"], r["url"]) for r in got} == {r[:2] for r in rows}


def test_odd_pages(spark):
    rows = [
        (1, "http://a.org/", None),
        (2, "http://a.org/", ""),
        (3, None, "<p>no url"),
        (None, "b", "plain &amp; text"),
        (5, "http://c.org", "<article>one<p>two<br>three</p> <b>fo</b>ur</article>"),
        (5, "http://c.org", "<article>one<p>two<br>three</p> <b>fo</b>ur</article>"),
        (6, "http://c.org", "<div>" * 400 + "deep" + "</div>" * 399),
        (7, "http://c.org", "<a title='x>y'>1 < 2 & 3</a> <unknown>z</unknown></nothing><p"),
        (8, "http://d.org", "<p>" + "long " * 50_000 + "</p><script>x"),
        (9, "http://d.org", "<p hidden>no</p><p>café &#233; &eacute; x\n\n y</p><![CDATA[z]]>"),
    ]
    got = sorted((r["page_id"] or 0, r["text"]) for r in w.main_text(frame(spark, rows)).collect())
    assert got == [
        (0, "plain & text"),
        (1, ""),
        (2, ""),
        (3, "no url"),
        (5, "one two three four"),
        (5, "one two three four"),
        (6, "deep"),
        (7, "1 < 2 & 3 z <p"),
        (8, ("long " * 50_000).strip()),
        (9, "café é é x y z"),
    ]


def test_copies_of_one_page_are_no_template(spark):
    rng = random.Random(3)
    html = page(rng, "h1.example.com", ["Title.", "Same text."], 1)
    rows = [(i, "http://h1.example.com/", html) for i in range(30)]
    assert {r["text"] for r in w.main_text(frame(spark, rows)).collect()} == {"Title. Same text. We love news."}


def test_empty_table(spark):
    assert w.main_text(frame(spark, [])).collect() == []


def size(tree):
    return 1 + sum(map(size, tree[1]))


def best(a, b):
    """Simple tree matching by trying all ways."""
    if a[0] != b[0]:
        return 0

    def rows(x, y):
        if not x or not y:
            return 0
        return max(rows(x[1:], y), rows(x, y[1:]), best(x[0], y[0]) + rows(x[1:], y[1:]))

    return 1 + rows(a[1], b[1])


def tree(rng, depth):
    return [rng.choice("ab") if depth < 3 else "r", [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []]


def flat(tree):
    signs, parents, todo = [tree[0]], [-1], [(0, tree)]
    for at, (_, children) in todo:
        for child in children:
            todo.append((len(signs), child))
            signs.append(child[0])
            parents.append(at)
    return signs, parents


def nested(tree):
    nodes = [[sign, []] for sign in tree[0]]
    for node, parent in zip(nodes[1:], tree[1][1:], strict=True):
        nodes[parent][1].append(node)
    return nodes[0]


@pytest.mark.parametrize("seed", range(12))
def test_matching_and_merging(seed):
    rng = random.Random(seed)
    a, b = tree(rng, 3), tree(rng, 3)
    assert w.matched(flat(a), flat(b))[0] == best(a, b)
    merged = nested(w.merge(flat(a), flat(b)))
    assert size(merged) <= size(a) + size(b) - best(a, b)
    assert best(merged, a) == size(a)


def test_headers_inside_an_article_stay():
    root = w.parse("<header>site</header><article><header><h1>Title</h1></header><p>x</p><footer>by</footer></article>")
    wrapper = w.Wrapper(w.fold(root))
    wrapper.place(root)
    assert w.extract(root, wrapper) == "Title x"


def test_copies_vote_once(spark):
    rng = random.Random(5)
    plain = lambda text: f"<div><p>{text}</p></div>"
    copy = "<div><p>Copied text.</p></div><blockquote>Quoted in all copies.</blockquote>"
    rows = [(i, "http://q.org/", plain(say(rng, 9))) for i in range(20)] + [(100 + i, "http://q.org/", copy) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in w.main_text(frame(spark, rows)).collect()}
    assert {got[100 + i] for i in range(5)} == {"Copied text. Quoted in all copies."}


def test_template_of_a_host_with_many_copies(spark):
    rng = random.Random(6)
    html = lambda text: f"<p>{text}</p><h6>We love news.</h6>"
    rows = [(i, "http://q.org/", html(say(rng, 9))) for i in range(10)] + [(100 + i, "http://q.org/", html("Copied.")) for i in range(10)]
    got = [r["text"] for r in w.main_text(frame(spark, rows)).collect()]
    assert not any("news" in t for t in got) and got.count("Copied.") == 10


def test_heading_of_few_pages_stays(spark):
    rng = random.Random(7)
    rows = [(i, "http://q.org/", f"<p>{say(rng, 9)}</p>" + "<h2>Summary</h2>" * (i < 8)) for i in range(20)]
    got = {r["page_id"]: r["text"] for r in w.main_text(frame(spark, rows)).collect()}
    assert all(got[i].endswith(" Summary") for i in range(8))


def test_constant_siblings_of_one_sign(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(12):
        text = say(rng, 9)
        if i % 2:
            html = f"<table><tr><td>menu<td>{text}</table>"
            url = "http://t.org/"
        else:
            html = f"<div>notice</div><div>{text}</div>"
            url = "http://d.org/"
        rows.append((i, url, html))
        want[i] = text
    assert {r["page_id"]: r["text"] for r in w.main_text(frame(spark, rows)).collect()} == want


def test_deep_pages(spark):
    rows = [
        (1, "http://a.org/", "<div>" * 5_000 + "deep" + "</div>" * 4_999),
        (2, "http://a.org/", "".join(f"<div class=c{'ab'[i % 2]}>" for i in range(6_000)) + "deeper"),
        (3, "http://a.org/", "<ul><li>" * 3_000 + "list"),
    ]
    assert {r["page_id"]: r["text"] for r in w.main_text(frame(spark, rows)).collect()} == {1: "deep", 2: "deeper", 3: "list"}


@pytest.mark.parametrize(
    "start, end",
    [
        ('<div class="content has-sidebar">', "</div>"),
        ('<main class="post comments-open">', "</main>"),
        ('<article class="social-science">', "</article>"),
        ('<article><section id="share-price-analysis">', "</section></article>"),
        ('<form id="aspnet">', "</form>"),
        ('<div class="widget">', "</div>"),
    ],
)
def test_names_hide_no_article(spark, start, end):
    rng = random.Random(11)
    rows, want = [], {}
    for i in range(3):
        blocks = [say(rng, 12) for _ in range(4)]
        rows.append((i, f"http://h{i}.org/", f'<nav><a href="/">home</a></nav>{start}{"".join(f"<p>{b}</p>" for b in blocks)}{end}<div class="ad-box">Buy.</div>'))
        want[i] = " ".join(blocks)
    assert {r["page_id"]: r["text"] for r in w.main_text(frame(spark, rows)).collect()} == want


def test_article_of_single_pages_by_votes_alone(spark):
    """One page a host: the layout's evidence comes from all hosts, without lists and article elements."""
    rng = random.Random(12)
    rows, want = [], {}
    for i in range(20):
        blocks = [say(rng, rng.randint(8, 30)) for _ in range(4)]
        menu = "".join(f'<li><a href="/{n}">{say(rng, 1)}</a>' for n in range(6))
        body = f'<div class="x"><ul>{menu}</ul></div><div class="y"><h1>{blocks[0]}</h1>{"".join(f"<p>{b}" for b in blocks[1:])}</div><div class="z">{say(rng, 4)}</div>'
        rows.append((i, f"http://h{i}.org/", f"<html><body>{body}</body></html>"))
        want[i] = " ".join(blocks)
    got = w.main_text(frame(spark, rows), lists=False, articles=False).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_marks_inside_words_and_empty_comments():
    root = w.parse("<p>Donau<wbr>dampf<!-->schiff<!---> fahrt<!-- x --!>en")
    wrapper = w.Wrapper(w.fold(root))
    wrapper.place(root)
    assert w.extract(root, wrapper) == "Donaudampfschiff fahrten"


def test_open_tags_take_linear_time():
    begun = time.process_time()
    for page in ("<a " * 100_000, "<p>x" + "</i>" * 100_000, "<div>" * 20_000 + "</b>" * 20_000, "<p " * 50_000 + "<!-- x"):
        w.parse(page)
    assert time.process_time() - begun < 5
