"""Text that pages show and that must reach the labeller, and deep nesting."""

import random
import re
import tracemalloc
from time import process_time
from zlib import crc32

import numpy as np
import pytest

from basketspark.llm import html_blocks, html_extract
from basketspark.llm.html_training import labelled_pages


def texts(html):
    return [b.text for b in html_blocks.blocks(html)]


def test_custom_and_self_closed_elements():
    assert texts("<p>a <svg-icon name=x></svg-icon> b</p><p>c</p>") == ["a b", "c"]
    assert texts("<title-bar>t</title-bar><p>c") == ["t", "c"]
    assert texts('<p>a<svg width="1"/> b</p><p>c</p>') == ["a b", "c"]
    assert texts("<p>a<svg><text>no</text></svg> b</p><object>unclosed<p>c") == ["a b", "unclosed", "c"]
    assert texts("<p>a<script>no") == ["a"]


def test_attributes_by_name():
    """Hidden elements are left to the labeller, which their paths tell."""
    found = html_blocks.blocks('<p title="a hidden gem">x</p><p hidden>no</p><p data-x=\'style="display:none"\'>y</p><p HIDDEN="">no<p style="display: none">no')
    assert [b.text for b in found if b.path.names != "hidden"] == ["x", "y"] and len(found) == 5


def test_no_text_is_dropped_before_the_labeller():
    assert texts("<article><p>a<object>b</object><noscript><p>c</p></noscript><iframe>no</iframe></article>") == ["ab", "c"]


def test_math_is_text():
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds") == ["so x=2 holds"]


def test_outer_elements_are_read():
    a, b = (html_blocks.blocks(f"<{t} class={n}>" + "<div>" * 20 + "<p>some text here") for t, n in (("aside", "comments"), ("main", "content")))
    assert (html_extract.vectors(a) != html_extract.vectors(b)).any()


def plain_path_vector(block):
    """Over the whole path, written out."""
    path, e = [], block.path
    while e is not None:
        path.append((e.tag, e.names))
        e = e.outer
    out, inner = np.zeros(html_extract.PATH), True
    for depth, (tag, names) in enumerate(path[:12]):
        h = crc32(tag.encode())
        out[h % 48] += (1 if h >> 16 & 1 else -1) * (1.0 if depth < 2 else 0.6)
        for n in re.findall("[a-z]+", names):
            h = crc32(n.encode())
            out[48 + h % 112 if inner else 160 + h % 64] += 1 if h >> 16 & 1 else -1
        inner = inner and not names
    for tag, names in set(path[12:]):
        h = crc32(tag.encode())
        out[h % 48] += (1 if h >> 16 & 1 else -1) * 0.6
        for n in re.findall("[a-z]+", names):
            h = crc32(n.encode())
            out[160 + h % 64] += 1 if h >> 16 & 1 else -1
    return np.clip(out, -3, 3)


def test_path_vectors_against_a_plain_version():
    r = random.Random(8)
    for _ in range(40):
        html = "".join(r.choice(("<div>", '<div class="row x">', "<section id=main>", "</div>", "<p>", "<aside>", "</section>", "<ul><li>", "<b>", "</b>", "text ", "<a href=x class=y>", "</a>")) for _ in range(120))
        found = html_blocks.blocks(html)
        assert np.allclose(html_extract.vectors(found)[:, : html_extract.PATH], [plain_path_vector(b) for b in found], atol=1e-5)


def plain_scores(p, x):
    """One page, a step at a time."""
    sig, h, out = lambda a: 1 / (1 + np.exp(-a)), html_extract.HIDDEN, {}
    for d in "fb":
        state, cell, seen = np.zeros(h), np.zeros(h), []
        for row in x if d == "f" else x[::-1]:
            a = row @ p[f"w{d}"] + p[f"b{d}"] + state @ p[f"u{d}"]
            cell = sig(a[h : 2 * h]) * cell + sig(a[:h]) * np.tanh(a[3 * h :])
            state = sig(a[2 * h : 3 * h]) * np.tanh(cell)
            seen.append(state)
        out[d] = seen if d == "f" else seen[::-1]
    return np.array([f @ p["o"][:h] + b @ p["o"][h:] + row @ p["x"] + p["c"][0] for f, b, row in zip(out["f"], out["b"], x, strict=True)])


def test_padded_passes_against_a_plain_loop():
    r = np.random.default_rng(3)
    net = html_extract.BlockLabeller.fresh(5)
    net.p["x"] = r.normal(0, 0.3, html_extract.WIDTH).astype(np.float32)
    pages = [r.normal(0, 1, (n, html_extract.WIDTH)).astype(np.float32) for n in (1, 9, 4, 2)]
    got = net.scores(*html_extract.padded(pages))
    for k, page in enumerate(pages):
        assert np.allclose(got[: len(page), k], plain_scores(net.p, page), atol=1e-3)


def test_gradients_against_differences():
    r = np.random.default_rng(6)
    net = html_extract.BlockLabeller({k: v.astype(np.float64) for k, v in html_extract.BlockLabeller.fresh(2).p.items()})
    x, there = html_extract.padded([r.normal(0, 1, (n, html_extract.WIDTH)) for n in (3, 1, 5)])
    x, y = x.astype(np.float64), r.integers(0, 2, x.shape[:2]).astype(np.float64)

    def loss():
        s = net.scores(x, there)
        return float((np.where(there[..., 0], np.log1p(np.exp(-np.abs(s))) + np.maximum(s, 0) - s * y, 0)).sum() / there.sum())

    g = net.gradients(x, there, y)
    for name, v in net.p.items():
        for at in r.choice(v.size, min(5, v.size), replace=False):
            v.flat[at] += 1e-3
            up = loss()
            v.flat[at] -= 2e-3
            down = loss()
            v.flat[at] += 1e-3
            assert abs((up - down) / 2e-3 - g[name].flat[at]) < 2e-4 + 0.02 * abs(g[name].flat[at]), name


STORY = ["A headline of the day", "The first paragraph tells at some length what has happened, and where, and to whom.", "The second one adds what is known and what is not, in two sentences. It is short.", "A third paragraph brings the story to its end, with a few more words."]


def test_depth_changes_nothing():
    page = "<header class=site-header><h2>Site name</h2><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav></header>{}<footer>&copy; 2024 Example. All rights reserved</footer>"
    body = "<article><h1>" + "".join((STORY[0], "</h1>", *(f"<p>{t}</p>" for t in STORY[1:]))) + '</article><aside class="sidebar"><h3>Popular posts</h3><ul><li><a href="/1">Another story of this week</a></ul></aside><section id="comments"><h3>2 comments</h3><div class="comment"><b>Anna</b> 2 hours ago<p>Thank you for this long and careful piece of writing.</p></div></section>'
    labeller = html_extract.trained()
    for n in (0, 1, 3, 6, 10, 14, 20, 30, 40):
        for name in ("", ' class="row"'):
            assert html_extract.main_texts([page.format(f"<div{name}>" * n + body + "</div>" * n)], labeller) == ["\n".join(STORY)], n


def test_whole_pages_it_has_not_seen():
    labeller, pages = html_extract.trained(), labelled_pages(400, 99)
    got = labeller.labels([html_extract.vectors(b) for b, _ in pages])
    right = [(g == np.array(y, bool)).mean() for g, (_, y) in zip(got, pages, strict=True)]
    print("blocks", np.mean(right), "pages", np.mean([x == 1 for x in right]))
    assert np.mean(right) > 0.98 and np.mean([x == 1 for x in right]) > 0.8


@pytest.mark.parametrize("html", ["<div>x " * 100_000, "<b>" * 50_000 + "x" + "</i>" * 50_000, ("<b>x" + "</i>") * 50_000, "<li>x<ul>" * 40_000, "<p>" * 200_000 + "x", "<a>x " * 50_000, "<td>x" * 50_000, "<div class=c>x</span>" * 50_000])
def test_deep_markup_is_linear(html):
    began = process_time()
    tracemalloc.start()
    html_blocks.blocks(html)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert process_time() - began < 15 and most < 200e6


def test_vectors_of_deep_markup():
    found = html_blocks.blocks("<div>x " * 30_000)
    assert len(html_extract.vectors(found)) == 30_000


@pytest.mark.parametrize("part", ["<a ", "<template>", "<svg>", "<annotation>x", "<div '", "<a \"'>", "<a<", "</a ", "<!x", "<b '\"", "<title", "<svg '>", "<div>x ", "<!--", "<script"])
def test_time_is_linear_in_broken_pages(part):
    """Each search to the page's end is made once: 100,000 repeats take seconds, where one search a repeat would take hours."""
    began = process_time()
    html_blocks.blocks(part * 100_000)
    assert process_time() - began < 10


@pytest.mark.parametrize(
    "html, texts",
    [
        ("<p title='a > b'>x</p>", ["x"]),
        ('<p title="a \' > b">x</p>', ["x"]),
        ("<p '>x</p> y", ["x", "y"]),
        ("a <template>b<p>c</template> d <template>e", ["a d e"]),
        ("a <svg/>b <svg x='>'>c</svg> d <svg>e", ["a b d e"]),
        ("a <script>b</script > c <STYLE>d</style>e <script>f", ["a c e"]),
        ("a <!-- b > --> c <!-- d", ["a c"]),
        ("a < b > c <", ["a < b > c <"]),
        ("<!doctype html><?x y?></ z>a", ["a"]),
    ],
)
def test_scanner(html, texts):
    assert [b.text for b in html_blocks.blocks(html)] == texts


def test_a_page_without_markup_is_kept():
    labeller = html_extract.BlockLabeller.fresh(1)
    assert html_extract.main_texts(["just text &amp; more", "", None, "5 < 6"], labeller) == ["just text & more", "", "", "5 < 6"]
