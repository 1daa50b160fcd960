"""Block labeller: parsing of broken markup, layouts it has not seen, the pages of the test tables."""

from __future__ import annotations

import random
import re
from html import unescape

import numpy as np
import pytest
from frames import clashing

from featurekit.llm import html as h
from featurekit.llm.common import table


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return h.learn(table(spark, sf_dir, "pages"))


def text(model, page):
    return h.main_texts(model, [page])[0][0]


def test_blocks_of_broken_markup():
    page = "<p>one <b>two<p>three&nbsp;&amp;  four<br>five</b><li>six<li>seven<div hidden>no</div><script>x<p></script><style>p{}</style><!-- c --><noscript>n</noscript>end"
    assert [b.text for b in h.page_blocks(page)] == ["one two", "three & four five", "six", "seven", "end"]
    assert h.page_blocks(None) == h.page_blocks("") == [] and [b.text for b in h.page_blocks("just text &lt;")] == ["just text <"]
    assert h.page_blocks("<article><p>a</article></p></div>tail")[-1].path == ()


def test_parts_of_a_page(model):
    sentence = "A sentence of the article with quite a few words in it, as articles have them. "
    page = (
        "<html><head><title>T</title></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></ul></nav>"
        "<div class=cookie-notice><p>We use cookies, please accept.</p></div>"
        f"<article><h1>Heading</h1><p>{sentence}</p><div class=advert><p>Buy this now</p></div><p>{sentence}</p></article>"
        "<aside class=sidebar><p>Other things to read</p></aside><form class=newsletter><label>Mail</label><button>Go</button></form>"
        "<section class=comments><div class=comment><p>I do not agree with this article at all.</p></div></section><footer>&copy; us</footer>"
    )
    assert text(model, page) == "\n".join(["Heading", sentence.strip(), sentence.strip()])


def test_made_layouts_not_seen_in_training(model):
    rng, right, total = random.Random(1234), 0, 0
    texts = [" ".join(rng.choices(["lorem", "ipsum", "dolor", "sit", "amet"], k=rng.randint(3, 60))) + "." for _ in range(80)]
    for _ in range(120):
        blocks = h.page_blocks(h.made_page(rng, texts))
        truth = np.array([b.text[:1] == h._MAIN_MARK for b in blocks])
        plain = [h.Block(b.text[1:].strip() or "x", b.path, b.linked) for b in blocks]
        right += (truth == (model.predict([h.vectors(plain)])[0] >= h.MAIN)).sum()
        total += len(blocks)
    assert right / total >= 0.98


def test_pages_of_the_table(spark, sf_dir, model):
    def plain(page):
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL).group(1)
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:h1|p)[^>]*>", inner)]
        return "\n".join(p for p in parts if p)

    rows = h.extract(table(spark, sf_dir, "pages"), model).join(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").collect()
    assert len(rows) == 250
    assert [r.page_id for r in rows if r.text != plain(r.html)] == []
    assert all(r.n_chars == len(r.text) for r in rows)


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    m = h.Labeller.start()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, mask = h._padded([rng.normal(size=(n, h.PATH_CELLS + h.WORD_CELLS + h.FIGURES)).astype(np.float32) for n in (5, 3)])
    y = (rng.random(mask.shape) < 0.5).astype(np.float32)

    def loss():
        both = np.concatenate([m._run(x, mask, d) for d in "fb"], axis=2).astype(np.float64)
        p = h._sigmoid(both @ m.p["o"] + m.p["c"])
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    g = m.gradients(x, mask, y)
    for name in ("xf", "hb", "bf", "o", "c"):
        at = tuple(0 if s == 1 else s // 2 for s in m.p[name].shape)
        keep, step = m.p[name][at], 1e-2
        m.p[name][at] = keep + step
        up = loss()
        m.p[name][at] = keep - step
        down = loss()
        m.p[name][at] = keep
        assert g[name][at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4)


def test_awkward_rows(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "u", "<article>" + "<p>Many words stand here, again and again.</p>" * 3000 + "</article>"),
            (3, "u", "<p" ), (4, "u", "<nav>only a menu</nav>"), (4, "u", "<nav>only a menu</nav>")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string")).selectExpr("*", "'x' AS text", "'y' AS blocks")
    got = h.extract(pages, model).collect()
    assert len(got) == len(rows)
    assert [r.text for r in got if r.page_id in (1, 2, 4)] == ["", "", "", ""]
    assert [r.main_blocks for r in got if r.page_id == 3 and r.n_chars > 10] == [3000]
    assert h.extract(pages.limit(0), model).count() == 0
    h.learn(pages.limit(0))
