import random

import pytest

from telemsg.llm.html_extract import DomModel, Forest, blocks, extract, html_extract, inherited, labelled_page, parse, train


@pytest.fixture(scope="module")
def model():
    return train()


def test_held_out_layouts(model):
    rng = random.Random(12345)
    same = 0
    for _ in range(200):
        tree = parse(labelled_page(rng))
        want = blocks(tree, inherited(tree).astype(bool))
        same += want == blocks(tree, model.marginals(Forest([tree])) >= 0.5)
    assert same >= 190


def test_page(model):
    page = (
        '<html><head><title>T</title><script>var t="</p><article>x";</script></head><body><nav><ul><li><a href=/x>menu</a>'
        "</ul></nav><!-- <article> --><div class=ad>Buy now.</div><article><h1>A &amp; B</h1><p><b>First\n par</b>agraph"
        " &lt;here&gt;.<br><p>Second one, unclosed. &nbsp;x<p>Third.</p><aside>See also this.</aside></article>"
        '<section class="comments"><p>Nice post, really.</p></section><form><label>Mail</label></form>'
        "<footer>&copy; us</footer></body></html>"
    )
    assert extract([page, "", "<p>"], model)[0] == "A & B First paragraph <here>. Second one, unclosed. \xa0x Third."


def test_marginals_are_those_of_the_tree(model):
    """Messages against the sum over all labellings."""
    import itertools

    import numpy as np

    tree = parse("<body><div class=ad>x</div><article><p>Some text here.</p><nav><a>y</a></nav></article></body>")
    f = Forest([tree])
    n = len(f.parent)
    node = sum(model.node[k][:, getattr(f, k)].T for k in ("tag", "group", "size", "link"))
    node[0, 1] = -50.0
    total, on = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        s = sum(node[i, y[i]] for i in range(n))
        s += sum(model.edge[f.kind[i], y[f.parent[i]], y[i]] for i in range(1, n))
        total += np.exp(s)
        on += np.exp(s) * np.array(y)
    assert np.allclose(model.marginals(f), on / total)


def test_rows(spark):
    html = "<body><article><p>The text of it, in full.</p></article><footer>f</footer>"
    rows = [(1, "u", html, "c"), (1, "u", html, "c"), (2, None, None, "c"), (None, "u", "", "c"), (3, "u", "<" * 50, "c"),
            (4, "u", "<div>" * 3000 + "deep", "c"), (5, "u", html.replace("in full", "very long " * 20000), "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == "The text of it, in full." and by[1].n_chars == 24 and by[2].text == "" and by[None].text == ""
    assert by[5].n_chars > 190_000
    assert html_extract(pages.limit(0)).count() == 0


def test_model_is_the_same_every_time():
    a, b = train(n_made=50), train(n_made=50)
    assert all((a.node[k] == b.node[k]).all() for k in a.node) and (a.edge == b.edge).all()
    assert isinstance(a, DomModel)
