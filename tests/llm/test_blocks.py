import numpy as np
import pytest

from stratalake.llm import blocks


def texts(page):
    return [b.text for b in blocks.cut(page)]


def test_cuts_as_browsers_do():
    assert texts("<p>a <b>b</b>c<br>d&nbsp;&amp;&lt;\n e<p>f<script>var t='</p>';</script>g") == ["a bc d &< e", "fg"]
    assert texts("<ul><li>a<li>b</ul>c<!-- x <p> -->d<style>p{}</style><div>e") == ["a", "b", "cd", "e"]
    assert texts("x<!-- open") == ["x"] and texts("x<p class='a>b'>y") == ["x", "y"] and texts("a < b &am") == ["a < b &am"]
    assert texts("a<scr") == ["a"] and texts("<script>never closed <p>x") == [] and texts("") == [] and texts("<p> \n </p>") == []
    assert texts("<P CLASS=ad>q</P><td>r<td>s") == ["q", "r", "s"]
    paths = [b.path for b in blocks.cut("<div class='Ad box' id=x><p>a</p></div></p><p>b")]
    assert paths == ["div c:ad c:box i:x/p", "p"]


def test_elements_without_text_hide_only_themselves():
    for empty in ("<svg/>", "<svg width=1 />", "<object/>", "<video>", "<VIDEO src='a'>", "<canvas>", "<svg><path/></svg>", "<object data=x>no</object>"):
        assert texts(f"<p>one</p>{empty}<p>two</p>") == ["one", "two"], empty
        assert texts(f"<p>one{empty}</p>{empty}<p>two</p>") == ["one", "two"], empty
    assert texts("<p>let <math><semantics><mi>x</mi><annotation>$x$</annotation></semantics></math> be</p>") == ["let x be"]
    many = "<video>" * 20_000 + "<p>end</p>"
    assert texts(many) == ["end"]


def test_quotes_count_after_an_equals_sign():
    assert texts("<p title=it's>a</p><p>b's</p>") == ["a", "b's"]
    assert texts("<p it's>a</p>") == ["a"] and texts("<p a = 'x>y' b=\"c>'d\">z") == ["z"]
    assert texts('<p title="open>a</p>') == ["a"]
    assert [b.path for b in blocks.cut("<p class=it's>a</p>")] == ["p c:it c:s"]


def test_headings_are_labelled_as_article():
    page = "<head><title>t</title></head><article><h1 class=title>h</h1><div class='head'>s</div><p>x</p><div class=share>y</div></article>"
    assert [b.text for b in blocks.cut(page)] == ["t", "h", "s", "x", "y"]
    assert blocks.teacher(blocks.cut(page)).tolist() == [False, True, True, True, False]


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    model = blocks.Labeller.fresh()
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    size = np.array([3, 5, 1])
    x = rng.normal(0, 1, (5, 3, blocks.PATH + blocks.WORDS + blocks.RATES))
    truth = rng.integers(0, 2, (5, 3)).astype(float)
    mask = np.arange(5)[:, None] < size

    def loss():
        p = model.scores(x, size)
        return -(mask * (truth * np.log(p) + (1 - truth) * np.log(1 - p))).sum() / mask.sum()

    grads = model._gradients(x, size, truth, mask)
    for name in ("xf", "hb", "cf", "out", "hf", "xb"):
        at = tuple(int(rng.integers(n)) for n in model.w[name].shape)
        old = model.w[name][at]
        model.w[name][at] = old + 1e-2
        up = loss()
        model.w[name][at] = old - 1e-2
        down = loss()
        model.w[name][at] = old
        assert abs((up - down) / 2e-2 - grads[name][at]) < 2e-4 + 0.05 * abs(grads[name][at])


def test_padding_does_not_matter():
    model = blocks.Labeller.fresh()
    pages = [blocks.cut(f"<p>{'a b ' * n}</p>" * n) for n in (1, 7, 2, 30, 0, 3)]
    alone = [model.label([p])[0].tolist() for p in pages]
    assert [x.tolist() for x in model.label(pages)] == alone


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def weights(pages):
    return blocks.fit(pages)


def test_articles_of_the_pages(pages, weights):
    rows = blocks.extract(pages, weights).collect()
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == len(sources)
    right = 0
    for r in rows:
        cut = blocks.cut(sources[r["page_id"]])
        want = "\n".join(b.text for b, y in zip(cut, blocks.teacher(cut), strict=True) if y)
        right += r["text"] == want and r["n_chars"] == len(want)
    assert right / len(rows) > 0.98


def test_other_layouts(pages, weights):
    rng = np.random.default_rng(77)
    cuts = [blocks.cut(r["html"]) for r in pages.orderBy("page_id").limit(150).collect()]
    bodies = [[b.text for b, y in zip(c, blocks.teacher(c), strict=True) if y] for c in cuts]
    spare = [x for body in bodies for x in body]
    model = blocks.Labeller(dict(weights))
    wrong = total = 0
    for body in bodies:
        made = blocks.cut(blocks.variant(body, spare, rng))
        truth = np.array(["\x01" in b.text for b in made])
        for b in made:
            b.text = b.text.replace("\x01", "")
        wrong += int((model.label([made])[0] != truth).sum())
        total += len(made)
    assert wrong / total < 0.02


def test_rows_of_all_kinds(spark, weights):
    long = "<article>" + "<p>one two three four.</p>" * 3000 + "</article>"
    rows = [(1, None), (2, ""), (None, "<article><p>Some words of an article, here.</p></article>"), (3, long), (3, long)]
    table = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'clash' AS text", "'clash' AS n_chars", "'kept' AS name")
    got = blocks.extract(table, weights).collect()
    assert len(got) == 5 and got[0]["text"] == "" and got[1]["n_chars"] == 0 and got[0]["name"] == "kept"
    assert got[3]["text"] == got[4]["text"] and got[3]["text"].count("one two three four.") > 2900
    assert blocks.extract(table.limit(0), weights).count() == 0
    none = blocks.fit(table.limit(0))
    ruled = blocks.extract(spark.createDataFrame([(1, "<nav>menu</nav><p>words</p>")], "page_id long, html string"), none)
    assert ruled.first()["text"] == "words"


def test_query_joins_blocks_by_two_line_feeds(spark, sf_dir):
    from stratalake.llm.queries import QUERIES

    sources = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op10_block_labeller"](spark, sf_dir).collect()
    wants = {}
    for key, page in sources.items():
        cut = blocks.cut(page)
        wants[key] = "\n\n".join(b.text for b, y in zip(cut, blocks.teacher(cut), strict=True) if y)
    assert len(rows) == len(sources) and any("\n\n" in w for w in wants.values())
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert sum(r["text"] == wants[r["page_id"]] for r in rows) / len(rows) > 0.98
