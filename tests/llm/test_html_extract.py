import html
import itertools
import math
import re

from conftest import SMALL

from starloom.llm import html_extract as H


def article(source):
    """Plain reading of pages whose main text is one ``article`` of h1 and p."""
    found = re.search(r"<article>(.*?)(</article>|$)", source or "", re.S)
    if not found:
        return ""
    body = re.sub(r"<[^>]*$", "", re.sub(r"<br>", " ", found[1]))
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_matches_plain_reading_on_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    rows = H.extract(pages).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_marginals_equal_enumeration(spark):
    model = H.train(spark.read.parquet(f"{SMALL}/pages.parquet"))
    page = H.Page("<body><div class='ad'><p>Buy, now.</p></div><div><p>Some words, and more of them here.</p><ul><li><a>x</a></li></ul></div>")
    n = len(page.tag)
    own = [model._own(page, i) for i in range(n)]
    total, on = 0.0, [0.0] * n
    for states in itertools.product((0, 1), repeat=n):
        weight = 1.0
        for i, y in enumerate(states):
            weight *= own[i] if y else 1.0
            if i:
                one = model.child.get(f"c:{page.tag[i]}", model.child["c:"]) if states[page.parent[i]] else 0.0
                weight *= one if y else 1 - one
        total += weight
        for i, y in enumerate(states):
            on[i] += weight * y
    assert all(abs(a - b / total) < 1e-9 for a, b in zip(model.marginals(page), on))


def test_parts_without_landmarks_and_broken_pages(spark):
    model = H.train(spark.read.parquet(f"{SMALL}/pages.parquet"))
    text = "This is a long paragraph, with many words. It has sentences, and goes on for a while."
    page = (f"<html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><div class='cookieNotice'>We use cookies.</div>"
            f"<div id='content'><h2>Head</h2><p>{text}<span class=ad>Buy!</span><p>Two &lt;b&gt;\n &amp; <a href='a>b'>link</a> inside,  of it.</p>"
            f"<form><p>{text}</p></form><div class='comments'><p>{text}</p></div></div><aside><p>{text}</p></aside><footer>x</footer><script>if(a<b){{}}</script>")
    want = f"Head\n\n{text}\n\nTwo <b> & link inside, of it."
    cases = [(page, want), (None, ""), ("", ""), ("<article><p>a &am", "a &am"), ("<article>x<p", "x"), ("<!-- <article>no</article>", ""),
             ("<article><p>a<br>b</p>c</article>", "a b\n\nc"), ("<article class='with-sidebar'><p>kept</p></article>", "kept")]
    df = spark.createDataFrame([(i, None, s, 1) for i, (s, _) in enumerate(cases)], "page_id long, url string, html string, text int")
    assert [r.text for r in sorted(H.extract(df, model).collect(), key=lambda r: r.page_id)] == [w for _, w in cases]
    assert H.extract(df.limit(0)).collect() == []
    deep = "<div>" * 20_000 + "<p>" + text + "</p>"
    assert model.extract("<article>" + deep + "<p>" * 20_000) == text


def test_topics_in_an_article_stay(spark):
    model = H.train(spark.read.parquet(f"{SMALL}/pages.parquet"))
    text = "This is a long paragraph, with many words. It has sentences, and goes on for a while."
    named = [f"<h2 id='related-work'>Head</h2><p>{text}</p>", f"<section id='search-algorithms'><h2>Head</h2><p>{text}</p></section>",
             f"<div id='social-impact'><h2>Head</h2><p>{text}</p></div>", f"<h2>Head</h2><p class='notice'>{text}</p>", f"<h2 id='privacy'>Head</h2><p>{text}</p>"]
    for body in named:
        assert model.extract(f"<article><p>{text}</p>{body}</article>") == f"{text}\n\nHead\n\n{text}", body
    assert model.extract(f"<article><p>{text}</p><div class='ads'><p>{text}</p></div><nav>{text}</nav></article>") == text
    assert model.extract(f"<div class='notice'><p>{text}</p></div><article><p>{text}</p></article>") == text
    assert model.extract(f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be so. {text}</p></article>") == f"Let x=2 be so. {text}"
    for tag in ("button", "select", "svg", "object"):
        assert model.extract(f"<article><div><p>{text}</p><div><{tag}>no<div>no</div></div><p>{text}</p></div></article>") == f"{text}\n\n{text}", tag
        assert model.extract(f"<article><p>{text}</p><{tag}><p>no</p></{tag}><p>{text}</p></article>") == f"{text}\n\n{text}", tag


def test_names_that_say_nothing_else_go_and_topics_stay(spark):
    model = H.train(spark.read.parquet(f"{SMALL}/pages.parquet"))
    text = "This is a long paragraph, with many words. It has sentences, and goes on for a while."
    for name in ("cookie-consent", "newsletter-signup", "share-buttons", "promoBox", "comment_list"):
        assert model.extract(f"<main><p>{text}</p><div class='{name}'><p>{text}</p></div></main>") == text, name
    assert model.extract(f"<body><div class='social-science'><p>{text}</p><p>{text}</p></div></body>") == f"{text}\n\n{text}"
    for name in ("social", "social-links", "site-search", "main-nav", "acme-sidebar"):
        assert model.extract(f"<body><div id='content'><p>{text}</p></div><div class='{name}'><p>{text}</p></div></body>") == text, name
    title = f"<div class='entry-header'><h1>Head</h1></div><p>{text}</p>"
    assert model.extract(f"<article>{title}</article>") == f"Head\n\n{text}"


def test_pages_without_the_landmark_element_extract_alike(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model, rows = H.train(pages), pages.collect()
    assert all(model.extract(re.sub(r"<(/?)article>", r"<\1div>", r.html or "")) == article(r.html) for r in rows)


def test_training_depends_on_landmark_pages_only(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html")
    plain = spark.range(3000).selectExpr("cast(null as long) page_id", "cast(null as string) url", "concat('<p>text ', id, '</p>') html")
    a, b = H.train(pages), H.train(pages.unionByName(plain))
    assert a.odds == b.odds and a.child == b.child
    nulls = plain.selectExpr("page_id", "url", "concat('<article>', html, '</article>') html")
    assert 0 < H.train(nulls, max_pages=300).child["c:p"] < 1
