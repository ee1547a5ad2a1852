import numpy as np

from tickwise.llm import extract as X

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this site better for all of our readers.</div><div class="ad">Buy it now.</div>
<article><h1>Head &amp; line</h1><p><b>First  one<br><p>Second <i>in</i><a href=x>line</a> &lt;ok&gt; &copy</p><p>Er.</p>
<aside>More to read on the other page of ours, here.</aside></article>
<div id="comments"><p>I think this is a long reader comment that has many words in it.</p></div>
<form><p>Your mail</p><input name=q></form><footer>&copy; example</footer></body></html>"""


def test_article_only():
    assert X.main_text(PAGE) == "Head & line\n\nFirst one\n\nSecond inline <ok> ©\n\nEr."


def test_tree_learns_its_table():
    x, y = X.labelled()
    assert all(X.decide(X.tree(), r) == c for r, c in zip(x, y))


def test_page_without_article_element():
    long = "word " * 40
    page = f"<body><div><a href=a>Home</a> <a href=b>About</a></div><div><h1>Some heading here</h1><p>{long}</p><p>{long}</p></div></body>"
    assert X.main_text(page) == "\n\n".join(["Some heading here", long.strip(), long.strip()])


def test_cut_and_odd_markup():
    assert X.main_text(None) == X.main_text("") == ""
    assert X.main_text("<article><p>1 < 2 and <p class='x") == "1 < 2 and"
    assert X.main_text("<article><p>a<!-- b --><script>x</p>") == "a"
    deep = "<div>" * 20000 + "<p>x</p>"
    assert X.main_text(deep) in ("", "x")
    assert len(X.main_text("<article><p>" + "long text " * 200_000)) == 10 * 200_000 - 1


def test_table(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 5, "k"), (2, None, None, None, None), (1, "u", PAGE, 5, "k")],
                               "page_id long, url string, html string, n int, key string")
    got = X.extract(df).collect()
    assert sorted(len(r.text) for r in got) == [0] + [len("Head & line\n\nFirst one\n\nSecond inline <ok> ©\n\nEr.")] * 2 and got[0].key == "k"
    assert X.extract(df.limit(0)).count() == 0


def test_query_equals_the_article_of_every_given_page(spark):
    import html
    import re
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in X.op9_extract(spark, sf).collect():
        body = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_names_of_boxes_decide_nothing():
    body = "<h1>A heading</h1><p>The first paragraph has a few words.</p><p>So has the second one here.</p>"
    want = "A heading\n\nThe first paragraph has a few words.\n\nSo has the second one here."
    for attrs in ('class="post related"', 'id="comments"', 'data-x="hidden gem"', "title='display:none'"):
        assert X.main_text(f"<nav><a href=a>Home</a></nav><article {attrs}>{body}</article>") == want
    assert X.main_text(f"<article>{body}<p data-x='hidden gem'>Seen.</p></article>") == want + "\n\nSeen."
    for attrs in ("hidden", 'aria-hidden="true"', 'style="color:red; display: none"', "role=navigation"):
        assert X.main_text(f"<article>{body}<div {attrs}><p>Not to be seen by any reader.</p></div></article>") == want


def test_short_list_items_stay():
    items = ["Apples from the garden", "Pears", "Plums that are ripe in autumn", "Figs"]
    page = "<article><h1>Fruit</h1><p>What there is to eat in the house today:</p><ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul></article>"
    assert X.main_text(page).split("\n\n")[2:] == items


def test_tree_learns_from_a_bounded_sample(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = X.fit(pages)
    assert model == X.fit(pages.repartition(3)) and model != X.tree()
    x, y = X.labelled()
    assert np.mean([X.decide(model, r) == c for r, c in zip(x, y)]) > 0.85
    # without the place of the blocks most of them are still told apart
    whole = {r.page_id: r.text for r in X.extract(pages, model).collect()}
    blind = {r.page_id: r.text for r in X.extract(pages, model, placed=False).collect()}
    kept = [set(whole[i].split("\n\n")) & set(blind[i].split("\n\n")) for i in whole]
    assert sum(map(len, kept)) > 0.9 * sum(len(whole[i].split("\n\n")) for i in whole)
    assert X.fit(pages.where("false")) == X.tree()
