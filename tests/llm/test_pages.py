import html
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from stagetally.llm import pages, queries


def text_of(source):
    return pages.main_text(pages.parse(source), set())


def page(host, n, rng, article=True, menu=None):
    words = lambda k: " ".join(f"w{rng.randrange(9999)}" for _ in range(k))
    paras = [words(rng.randrange(5, 40)) + " &amp; x" for _ in range(rng.randrange(1, 6))]
    body = f"<h1>{paras[0][:20]}</h1>" + "".join(f"<p>{p}" for p in paras)
    content = f"<article>{body}</article>" if article else f"<div>{body}</div>"
    markup = (
        f"<html><head><title>t</title><script>var a='</p>';</script></head><body><!-- c --><p>Read more on {host} every day</p>"
        f"<nav><a href='/x'>{words(3)}</a></nav><div class='ad'>{words(4)}</div>{content}"
        f"<div>Fixed words below on {host}</div><footer>{words(5)}</footer></body></html>"
    )
    want = [paras[0][:20], *paras]
    return (n, f"https://{host}/p/{n}", markup), "\n\n".join(html.unescape(w) for w in want)


def test_surroundings_go_and_the_article_stays():
    source = """<!DOCTYPE html><body><header>Site</header><nav>Menu</nav><main><article class="post">
      <header><h1>Title &eacute;</h1></header><p>One <b>two<br>three</b>&nbsp;four<p>Five &lt;six&gt; <a href="#">seven</a>
      <ul><li>Item one<li>Item <i>two</i></ul><aside>Side</aside><div class="ad-box"><p>Buy</p></div>
      <figure><img src=x><figcaption>Caption</figcaption></figure><form><p>Mail</p><button>Go</button></form>
      <div id="comments"><p>First!</p></div><script>x("</article>")</script><pre>a
        b</pre></article><div class="cookie-notice">Cookies</div></main><footer>Foot</footer></body>"""
    assert text_of(source) == "Title é\n\nOne two three four\n\nFive <six> seven\n\nItem one\n\nItem two\n\nCaption\n\na b"


def test_no_landmarks():
    source = "<ul><li><a href=a>Home</a><li><a href=b>News</a></ul><div>Text one<div>Text two</div>tail</div><p class=sidebar>No"
    assert text_of(source) == "Text one\n\nText two\n\ntail"


def test_a_frame_around_the_page_may_carry_a_loose_mark():
    text = "Long enough to hold most of the words of this page, as articles do."
    article = f'<div class="layout with-sidebar"><article><p>{text}</article><div class=sidebar>Side</div></div>'
    assert text_of(article) == text
    plain = f'<div id="page" class="has-menu"><ul class=menu><li>One</ul><p>{text}</p><div class="comments">{text * 9}</div></div>'
    assert text_of(plain) == text_of(f'<p>{text}</p><div class="share">Tell others</div>') == text


def test_broken_markup():
    assert text_of("<p>a<p>b</div></p>c<") == "a\n\nb\n\nc<"
    assert text_of("<article>open <b>bold") == "open bold"
    assert text_of("<div " + "x" * 50) == ""
    assert text_of("") == "" and text_of("plain &am; &amp") == "plain &am; &"
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert text_of(deep) == "x"


@given(st.text(alphabet="<>/ap=\"'! -divb&;", max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_is_read(source):
    root = pages.parse(source)
    assert isinstance(pages.main_text(root, set()), str)
    top, _ = pages.shape_of(root)
    assert len(pages.alignment(top, top)) == pages.Matching(top, top).size() == top.size


def slow_matching(a, b):
    """Simple tree matching by its recursion alone."""
    if a.symbol != b.symbol:
        return 0

    def best(i, j):
        if not i or not j:
            return 0
        return max(best(i - 1, j), best(i, j - 1), best(i - 1, j - 1) + slow_matching(a.children[i - 1], b.children[j - 1]))

    return best(len(a.children), len(b.children)) + 1


def test_matching_against_its_recursion():
    rng = random.Random(1)

    def tree(depth):
        tag = rng.choice(["div", "b", "i"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(4) if depth else 0)) + f"x</{tag}>"

    for _ in range(60):
        (a, _), (b, _) = (pages.shape_of(pages.parse(tree(3))) for _ in range(2))
        found = pages.Matching(a, b)
        assert found.size() == slow_matching(a, b) == len(found.pairs())


def test_matching_prefers_equal_content():
    """Of the alignments with most pairs, one with most equal nodes, by trying all of a list's."""
    from itertools import combinations

    rng = random.Random(5)
    for _ in range(80):
        one, two = ([rng.choice("uvwxyz") for _ in range(rng.randrange(1, 6))] for _ in range(2))
        a, b = (pages.shape_of(pages.parse("".join(f"<p>{t}</p>" for t in own)))[0] for own in (one, two))
        n = min(len(one), len(two))
        best = max(sum(x == y for x, y in zip(c, d)) for c in combinations(one, n) for d in combinations(two, n))
        pairs = pages.alignment(a, b)[1:]
        assert (len(pairs), sum(x.key == y.key for x, y in pairs)) == (n, best) or one == two


def test_anchors_give_an_alignment_when_tables_are_spent():
    rng = random.Random(6)
    for _ in range(60):
        a, b = (
            pages.shape_of(pages.parse("".join(f"<{t}>{rng.randrange(9)}</{t}>" for t in rng.choices(["b", "i", "u"], k=rng.randrange(12)))))[0]
            for _ in range(2)
        )
        found = pages.Matching(a, b, cells=0)
        pairs = found.pairs()[1:]
        at = sorted((x.number, y.number) for x, y in pairs)
        assert all(x.symbol == y.symbol for x, y in pairs) and len(at) == found.size() - 1
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(at, at[1:]))
        once = [[c.key for c in s.children] for s in (a, b)]
        if once[0] and once[0] == once[1]:
            assert len(pairs) == len(once[0])


def test_the_size_of_a_list_does_not_change_its_alignment():
    rng = random.Random(8)

    def tree(depth, most):
        tag = rng.choice(["div", "b", "i"])
        return f"<{tag}>" + "".join(tree(depth - 1, 4) for _ in range(rng.randrange(most) if depth else 0)) + f"{rng.randrange(3)}</{tag}>"

    for k in range(80):
        trees = [pages.shape_of(pages.parse("<div>" + "".join(tree(2, 4) for _ in range(rng.randrange(12))) + "</div>"))[0] for _ in range(2)]
        small, large = pages.Matching(*trees, cells=10**9), pages.Matching(*trees, cells=0)
        assert small.size() == large.size()
        assert small._known(*small.top) == large._known(*large.top)
        assert sorted((x.number, y.number) for x, y in small.pairs()) == sorted((x.number, y.number) for x, y in large.pairs())
    # Lists with more cells than were once allowed for a page, and no child that a side has once.
    lists = ["".join(f"<{t}>{rng.randrange(9)}</{t}>" for t in rng.choices(["b", "i", "u"], k=n)) for n in (520, 500)]
    trees = [pages.shape_of(pages.parse(f"<div>{x}</div>"))[0] for x in lists]
    found = [sorted((x.number, y.number) for x, y in m.pairs()) for m in (pages.Matching(*trees), pages.Matching(*trees, cells=10**9))]
    assert found[0] == found[1]


def test_long_lists_of_different_lengths_take_seconds():
    started = time.time()
    rows = ["".join(f"<tr><td>{i * k % 977}</td><td><a>{i}</a>{'<b>x</b>' * (i % 500 == k)}</td></tr>" for i in range(n)) for k, n in ((3, 3_000), (5, 2_990))]
    a, b = (pages.shape_of(pages.parse(f"<table>{r}</table>"))[0] for r in rows)
    found = pages.Matching(a, b)
    assert found.size() == len(found.pairs()) and found.size() >= b.size - 12
    assert time.time() - started < 30


def test_large_and_deep_pages_take_seconds():
    started = time.time()
    rows = ["".join(f"<tr><td>{i * k % 977}</td><td><a>{i}</a></td></tr>" for i in range(20_000)) for k in (3, 5)]
    a, b = (pages.shape_of(pages.parse(f"<table>{r}</table>"))[0] for r in rows)
    assert pages.Matching(a, b).size() == a.size
    assert text_of("<div>" * 100_000 + "x" + "</div>" * 100_000) == "x"
    assert text_of("<p><button>" + "<div>" * 50_000 + "x</button></p>y") == "y"
    deep = [pages.shape_of(pages.parse("<div>" * 20_000 + t))[0] for t in "xy"]
    assert pages.Matching(*deep).size() == 20_001
    assert pages.layout_of(pages.parse("<div>" * 20_000 + "x"))
    assert time.time() - started < 30


def test_an_article_far_down_is_found():
    assert text_of("<div>" * 250 + "<p>outside</p><article><p>" + "inside " * 9 + "</article>") == ("inside " * 9).strip()


def test_cards_marked_as_articles_beside_a_story():
    story = "".join(f"<p>{'long words of the story ' * 5}{i}</p>" for i in range(4))
    cards = "<div><article>card one</article><article>card two</article></div>"
    got = text_of(f"<body><main><h1>T</h1>{story}</main>{cards}</body>")
    assert got.startswith("T\n\nlong words") and got.endswith("3") and "card" not in got
    assert text_of(f"<body><div><h1>T</h1>{story}</div><main><p>one</p></main></body>").startswith("T\n\nlong words")


def test_a_page_within_one_form_or_marked_frame():
    assert text_of("<body><form id=f><div><p>All of it.</p><input value=x><button>Go</button></div></form></body>") == "All of it."
    assert text_of('<body><div class="notice page"><p>All of it.</p></div></body>') == "All of it."
    assert text_of('<body><div class="notice page"><h1>T</h1><p>Much of it.</p></div><p>or</p></body>') == "T\n\nMuch of it.\n\nor"
    assert text_of("<body><p>Text that stays.</p><form><p>Mail</p></form></body>") == "Text that stays."


def test_lists_of_links():
    menu = "<ul>" + "".join(f"<li><a href=x>Page {i}</a>" for i in range(9)) + "</ul>"
    own = "<ul>" + "".join(f"<li><a href=x>A work that the text names, part {i}</a>" for i in range(2)) + "</ul>"
    assert text_of(f"<body>{menu}<div><p>Text</p>{own}</div></body>").count("A work") == 2
    assert "Page" not in text_of(f"<body>{menu}<div><p>Text</p>{own}</div></body>")


def host_pages(rng, host, n, layout, at):
    words = lambda k: " ".join(f"w{rng.randrange(9999)}" for _ in range(k))
    out = []
    for i in range(n):
        paras = [words(rng.randrange(8, 30)) for _ in range(rng.randrange(2, 7))]
        body = "".join(f"<p>{p}</p>" for p in paras)
        if layout:
            markup = f"<body><div class=a><p>Fixed words of layout one</p>{body}<p>Sign up for our letter today</p></div></body>"
        else:
            markup = f"<body><section><div>Other fixed words</div><div class=b>{body}<p>First published in the other paper</p></div></section></body>"
        out.append(((at + i, f"https://{host}/{i}", markup), "\n\n".join(paras)))
    return out


def test_constant_paragraphs_and_two_layouts_on_one_host(spark, folder):
    rng = random.Random(9)
    made = host_pages(rng, "x.example.com", 18, 1, 0) + host_pages(rng, "x.example.com", 12, 0, 100)
    df = spark.createDataFrame([r for r, _ in made], "page_id long, url string, html string")
    for limit in (64_000_000, 0):
        found = {r["page"]: r["text"] for r in pages.main_texts(df, "page_id", "url", "html", limit=limit).collect()}
        assert found == {r[0]: want for r, want in made}


def test_constant_nodes_against_counting_by_hand(spark):
    """A node of the reference is constant if nine of ten different pages hold a block of its text at all."""
    rng = random.Random(10)
    made = host_pages(rng, "y.example.com", 30, 1, 0)
    df = spark.createDataFrame([r for r, _ in made], "page_id long, url string, html string").withColumnRenamed("page_id", "page")
    df = df.withColumn("host", pages.host_of(df["url"]))
    refs = pages.references(df)
    top, shapes = pages.shape_of(pages.parse(refs.collect()[0]["html"]))
    (row,) = pages.constants(df, refs, 8, 0.9, 1 << 20).collect()
    texts = {n: pages.main_text(shapes[n].node, set()) for n in range(len(shapes))}
    want = [n for n, t in texts.items() if t and shapes[n].symbol == "p" and sum(f">{t}<" in r[2] for r, _ in made) >= 27]
    assert row["constant"] == want and len(want) == 2


def test_what_all_pages_of_a_host_share_is_template(spark, folder):
    rng = random.Random(2)
    made = [page("a.example.com", i, rng, article=False) for i in range(30)]
    few = [page("b.example.com", 100 + i, rng, article=False) for i in range(3)]
    marked = [page("c.example.com", 200 + i, rng) for i in range(3)]
    odd = [(900, None, None), (901, "https://a.example.com/", ""), (None, "nonsense", "<p>x"), (902, None, "<p>x"), (902, None, "<p>x")]
    copies = [(300 + i, *made[0][0][1:]) for i in range(40)]
    rows = [r for r, _ in made + few + marked] + odd + copies
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = queries.op3_pages(spark, folder(pages=df)).collect()
    assert len(got) == len(rows)
    found = {r["page_id"]: r["text"] for r in got}
    for (n, _, _), want in made + marked:
        assert found[n] == want
    assert all(found[300 + i] == made[0][1] for i in range(40))
    for (n, _, _), want in few:
        assert found[n].startswith("Read more on") and want in found[n]
    assert found[900] == found[901] == "" and found[902] == found[None] == "x"
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_join_instead_of_broadcast_gives_the_same(spark):
    rng = random.Random(3)
    rows = [page(f"h{i % 2}.example.com", i, rng, article=False)[0] for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    by_join = {tuple(r) for r in pages.main_texts(df, "page_id", "url", "html", limit=0).collect()}
    assert by_join == {tuple(r) for r in pages.main_texts(df, "page_id", "url", "html").collect()}
    assert not any(re.search("Fixed words|Read more", t) for _, _, t in by_join)


def test_empty_table(spark, folder):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert queries.op3_pages(spark, folder(pages=df)).count() == 0
