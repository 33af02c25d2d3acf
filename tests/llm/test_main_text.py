import os
import random
import time
from collections import Counter

import numpy as np
import pytest

from loomstat.llm import boosting, dom, layouts
from loomstat.llm import main_text as M


@pytest.fixture(scope="module")
def model():
    return M.fit([])


def leaves(page):
    trees = dom.Trees()
    trees.add(page)
    return list(trees.texts.values())


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []),
        ("just text &amp; a&nbsp;reference", ["just text & a reference"]),
        ("<p>one<p>two</div><b>three</p>", ["one", "two", "three"]),
        ("<p><b>open<br><p>next", ["open", "next"]),
        ("<script>var t='</p><p>no'</script>a<style>b{}</style><!-- c --><!-- d", ["a"]),
        ("<script>never closed <p>x", []),
        ('<div title="a > b" class=x>in</div><a href=\'>\'>link</a>', ["in", "link"]),
        ("1 < 2 and <3", ["1 < 2 and <3"]),
        ("a<br>b<wbr>c \n\t d", ["a bc d"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
        ("<head><title>no</title><p>yes", ["yes"]),
        ("x</body></html>y", ["x", "y"]),
        ("text <div class='cut", ["text"]),
        ("&lt;p&gt; stays", ["<p> stays"]),
    ],
)
def test_tag_soup(page, texts):
    assert leaves(page) == texts


def test_rows_of_tables_and_items_of_lists_are_siblings():
    trees = dom.Trees()
    trees.add("<table><tr><td>a<td>b<tr><td>c</table><ul><li><div>x<li>y</ul>")
    tags = list(zip(trees.tag, [trees.tag[p] if p >= 0 else None for p in trees.parent], strict=True))
    assert tags.count(("tr", "table")) == 2 and tags.count(("td", "tr")) == 3 and tags.count(("li", "ul")) == 2


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "x", "<p>" * 50_000, "<a \"" * 30_000, "<a x='" * 30_000, "</div>" * 50_000, "<" * 100_000, "<li>" * 20_000 + "</ul>" * 20_000, "<!--" * 50_000])
def test_hostile_pages_end(page, model):
    began = time.time()
    assert len(model.texts([page])) == 1
    assert time.time() - began < 30


def test_made_pages_are_read_as_they_were_made():
    for seed in range(300):
        page, truth = layouts.made_page(seed)
        trees = dom.Trees()
        trees.add(page)
        assert sum(M.labelled(trees, truth, 0).values()) == len(truth), seed


def test_held_out_layouts(model):
    hit = said = there = 0
    for seed in range(50_000, 50_300):
        page, truth = layouts.made_page(seed)
        got, want = Counter(filter(None, model.texts([page])[0].split("\n"))), Counter(truth)
        hit, said, there = hit + (got & want).total(), said + got.total(), there + want.total()
    assert hit / said > 0.95 and hit / there > 0.95


def test_boilerplate_goes_and_the_article_stays(model):
    story = ["A headline of the day", "The first paragraph tells what happened, and where. It has two sentences.", "Fish & chips cost more. Nobody knows why, they say.", "The end came soon after that, as all had hoped."]
    inside = f"<h1>{story[0]}</h1><p>{story[1]}</p><div class='advert'>Buy now.</div><p>{story[2].replace('&', '&amp;')}</p><p>{story[3]}</p>"
    around = (
        "<html><head><title>T</title><script>x()</script></head><body><div class='cookie-notice'><p>We use cookies. You know it.</p><button>Fine</button></div>"
        "<header><div>The Site</div></header><nav><ul><li><a href=/>Home</a></li><li><a href=/a>News</a></li><li><a href=/b>Sport</a></li></ul></nav>{}"
        "<aside class='sidebar'><h3>More</h3><ul><li><a href=/1>Something else happened today</a></li><li><a href=/2>And another thing</a></li></ul></aside>"
        "<section id='comments'><h3>Comments</h3><div class='comment'><b>Ann</b><p>I liked this. Thank you for it, all of you.</p></div></section>"
        "<form><label>Mail</label><input name=m><button>Send</button></form><footer><p>&copy; 2024 The Site. All rights reserved.</p></footer></body></html>"
    )
    for shape in ("<article>{}</article>", "<div class='post-content'>{}</div>", "<main><div id='story'>{}</div></main>"):
        assert model.texts([around.format(shape.format(inside))]) == ["\n".join(story)], shape


STORY = [
    "The council met on Monday, and voted to close the old bridge. Nobody objected.", "Traffic will be led over the new road, which opened in May.",
    '"We are glad," said the mayor, "that it is done at last."', "Work begins next week and should end in autumn, the council said in a statement on Tuesday.",
]
ARTICLE = "<h1>Old bridge closes</h1>" + "".join(f"<p>{p}</p>" for p in STORY)
LAYOUTS = {
    "blog": "<body class='home'><div id='page'><div id='masthead' class='site-header'><a href=/>My Blog</a><p>Just another blog</p></div><div id='site-navigation'><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></div>"
    "<div id='content'><div class='entry'><div class='entry-content'>{}</div><div class='share'><ul><li><a href=x>Tweet</a><li><a href=y>Share</a></ul></div></div><div id='comments'><h2>2 thoughts</h2><ol class='commentlist'>"
    "<li><p>I used that bridge every day for ten years. What a pity.</p><a href=r>Reply</a></ol></div></div><div class='widget-area'><h3>Recent posts</h3><ul><li><a href=1>The new school is open at last</a></ul></div></div><div class='site-footer'>&copy; 2024</div>",
    "main": "<body><div class='cookie-banner'>We use cookies to improve your visit. Read more in our policy. <button>OK</button></div><header><nav><a href=/>Home</a> <a href=/n>News</a></nav></header><main>{}"
    "<form action=/s><label>Subscribe</label><input><button>Go</button></form><aside><h4>Related</h4><ul><li><a href=1>Another story about roads and rivers</a></ul></aside></main><footer>Contact us. All rights reserved.</footer>",
    "bare": "<body><div><a href=/>Home</a> | <a href=/b>Blog</a> | <a href=/c>Contact</a></div><div>{}</div><div><a href=/imprint>Imprint</a></div>",
    "nothing else": "{}",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_by_hand(model, layout):
    assert model.texts([LAYOUTS[layout].format(ARTICLE)]) == ["\n".join(["Old bridge closes", *STORY])]


def test_a_page_of_links_has_no_main_text(model):
    assert model.texts(["<body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>Blog</a></li></ul></nav><footer>&copy; x</footer>"]) == [""]


def test_decoding_is_the_likeliest_without_contradictions():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 8)
        trees = dom.Trees()
        trees.roots.append(0)
        for k in range(n):
            trees._node(rng.randrange(k) if k else -1, "div")
        odds = np.array([rng.uniform(-3, 3) for _ in range(n)])
        inner = {p for p in trees.parent if p >= 0}

        def worth(states, odds=odds, trees=trees, inner=inner):
            total = 0.0
            for k, s in enumerate(states):
                above = states[trees.parent[k]] if trees.parent[k] >= 0 else M.MIX
                if above != M.MIX and s != above or s == M.MIX and k not in inner:
                    return -np.inf
                total += {M.KEPT: -np.logaddexp(0, -odds[k]), M.DROPPED: -np.logaddexp(0, odds[k]), M.MIX: M.MIXED + M.AGAINST * min(odds[k], 0)}[s]
            return total

        every = [[k // 3**i % 3 for i in range(n)] for k in range(3**n)]
        best = max(every, key=worth)
        assert [s == M.KEPT for s in best] == M.decoded(trees, odds)


def test_boosting_learns_what_no_single_split_can():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (2000, 5)).astype(np.float32)
    label = ((x[:, 0] > 0) ^ (x[:, 3] > 0.2)).astype(float)
    made = boosting.fit(x[:1500], label[:1500], np.ones(1500), trees=30, depth=3)
    assert ((made.log_odds(x[1500:]) > 0) == label[1500:]).mean() > 0.95
    assert len(boosting.fit(x[:0], label[:0], np.ones(0)).log_odds(x)) == 2000


def test_extracted_of_odd_rows(spark, model):
    long = "<article>" + "".join(f"<p>Sentence {k} of a long page, which goes on.</p>" for k in range(40_000)) + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>Some text, to be kept. It goes on.</p></article>", "x"), (3, "u", long, "x"), (3, "u", long, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, key string")
    made = {r["page_id"]: r for r in M.extracted(frame, model).collect()}
    assert made[1]["text"] == made[2]["text"] == "" and made[1]["n_chars"] == 0
    assert made[None]["text"] == "Some text, to be kept. It goes on."
    assert made[3]["text"].count("\n") == 39_999 and made[3]["n_chars"] == len(made[3]["text"])
    assert M.extracted(frame.limit(0), M.train(frame.limit(0), made=20)).count() == 0
    with pytest.raises(ValueError):
        M.extracted(frame.withColumnRenamed("key", "Text"), model)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_pages_of_the_tables(spark):
    import duckdb

    from loomstat.llm import queries

    made = queries.QUERIES["op11_html_extraction"](spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.sql("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet/*.parquet'" if os.path.isdir("/root/testdata/sf0.001/pages.parquet") else "CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    assert made.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(tuple(r) for r in made.collect()) == sorted(con.sql(M.ORACLE_SQL).fetchall())
