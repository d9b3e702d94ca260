"""HTML, chat, secrets, language, quality, media and toxicity: round trips, brute force, held-out accuracy, edge cases."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketspark.llm import chat_format, html_blocks, html_extract, html_training, language_id, media_columns, quality_rules, secret_scan, toxicity

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, " \n"), (None, "abc def"), (4, "abc def"), (4, "abc def"), (5, "wort " * 40_000), (6, "x" * 200_000)]


@pytest.fixture
def odd(spark):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], DOCS)
    return df.selectExpr("*", *(f"doc_id AS {c}" for c in ("score", "spans", "kept", "media", "predicted", "lang_pred", "n_words")))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


# HTML


@pytest.fixture(scope="module")
def labeller():
    return html_extract.trained()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
<header class="site-header"><h2>Site name</h2><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav></header>
<div class="cookie-banner"><p>We use cookies to improve your experience.</p><button>Accept all</button></div>
{0}
<aside class="sidebar"><h3>Popular posts</h3><ul><li><a href="/1">Another story of this week</a></li></ul></aside>
<section id="comments"><h3>2 comments</h3><div class="comment"><b>Anna</b> 2 hours ago<p>Thank you for this long and careful piece of writing.</p></div></section>
<form class="newsletter"><label>Your email</label><input><button>Subscribe</button></form>
<footer>&copy; 2024 Example. All rights reserved</footer></body></html>"""
STORY = ["A headline of the day", "The first paragraph tells at some length what has happened, and where, and to whom.", "The second one adds what is known &amp; what isn't, in two sentences. It is not short either.", "A third paragraph brings the story to its end, with a few more words."]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", '<div class="post-content">{}</div>', "<main><div>{}</div></main>", '<div id="content"><div class="entry">{}</div></div>'])
def test_main_text(labeller, wrap):
    body = f"<h1>{STORY[0]}</h1>" + "".join(f"<p>{t}" for t in STORY[1:]) + '<div class="ad">Advertisement <a href="/x">Buy now</a></div>'
    got = html_extract.main_texts([PAGE.format(wrap.format(body))], labeller)[0]
    assert got == "\n".join(STORY).replace("&amp;", "&")


def test_labeller_on_pages_it_has_not_seen(labeller):
    pages = html_training.labelled_pages(120, 4711)
    got = labeller.labels([html_extract.vectors(b) for b, _ in pages])
    assert np.mean([np.mean(g == np.array(y, bool)) for g, (_, y) in zip(got, pages, strict=True)]) > 0.97


def test_article_of_each_page(spark, labeller):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    got = html_extract.main_texts([r.html for r in rows], labeller)
    want = ["\n".join(b.text for b in html_blocks.blocks(r.html[r.html.index("<article>") : r.html.index("</article>")])) for r in rows]
    assert np.mean([a == b for a, b in zip(got, want, strict=True)]) > 0.98


def test_blocks():
    b = html_blocks.blocks('<div hidden>no</div><p title="a>b">x &amp;\n y<p>z<!-- <p>c --><ul><li>1<li>2</ul>tail < 3<script>if (a<b) "</p>"</script> end')
    assert [x.text for x in b] == ["no", "x & y", "z", "1", "2", "tail < 3 end"] and b[0].path.names == "hidden"
    assert html_blocks.blocks(None) == html_blocks.blocks("") == html_blocks.blocks("<p> </p>") == []
    assert [x.text for x in html_blocks.blocks("<p>" * 3000 + "deep")] == ["deep"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/!-\"'= ap&;x\n", max_size=200))
def test_blocks_never_fail(html):
    html_blocks.blocks(html)


def test_page_rows(spark, labeller):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain"), (3, "u", PAGE.format("<article></article>")), (3, "u", PAGE.format("<article></article>")), (4, "u", "<article>" + "<p>word word</p>" * 8000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    got = html_extract.extract(df, labeller).collect()
    assert [r.page_id for r in got] == [1, 2, None, 3, 3, 4] and got[0].text == got[1].text == "" and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(df.limit(0), labeller).count() == 0


# Chat


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>|\\[]/snINSTYend\n", max_size=60))
def test_escape_round_trip(text):
    import re

    # The same rule in Python, against which the Spark one is held below.
    out = re.sub(rf"([<\[])(\\*)({chat_format.CONTROL})", r"\1\\\2\3", text)
    assert not re.search(rf"[<\[]({chat_format.CONTROL})", out)
    assert re.sub(rf"([<\[])\\(\\*)({chat_format.CONTROL})", r"\1\2\3", out) == text


def test_spark_escape(spark):
    r = random.Random(5)
    texts = ["".join(r.choice(["<|", "</s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "<", "[", "|", "a", "\n", "<|end|>", "$1"]) for _ in range(r.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", chat_format.escape(F.col("t")).alias("e")).select("t", "e", chat_format.unescape(F.col("e")).alias("b")).collect()
    assert all(x.t == x.b and "<|" not in x.e and "[INST]" not in x.e and "</s>" not in x.e for x in got)


def test_layouts(spark):
    import json

    records = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo <|end|> \\"}]},
        {"prompt": "p", "completion": "c"},
        {"prompt": "p", "response": "r", "system": "s"},
        {"instruction": "i", "input": "x", "output": "o"},
        {"instruction": "i", "output": "o"},
        {"question": "q"},
        {"conversations": [{"from": "human", "value": "<\\|turn|>"}, {"from": "gpt", "value": None}]},
        {"foo": 1},
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(r | {"conv_id": i, "layout_": "x"}) for i, r in enumerate(records)]))
    got = {r.conv_id: (r.layout, [(t.role, t.text) for t in r.turns]) for r in chat_format.canonical(df).collect()}
    assert got[0] == ("messages", [("user", "hi"), ("assistant", "yo <|end|> \\")])
    assert got[1] == ("prompt_completion", [("user", "p"), ("assistant", "c")])
    assert got[2] == ("prompt_response", [("system", "s"), ("user", "p"), ("assistant", "r")])
    assert got[3] == ("instruction", [("user", "i\nx"), ("assistant", "o")]) and got[4][1] == [("user", "i"), ("assistant", "o")]
    assert got[5] == ("question_answer", [("user", "q")])
    assert got[6] == ("share", [("user", "<\\|turn|>"), ("assistant", "")])
    assert got[7] == (None, [])
    back = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.learnt) for r in chat_format.read_back(chat_format.formatted(df)).collect()}
    assert all(back[i] == (t, [x for role, x in t if role == "assistant"]) for i, (_, t) in got.items())


def test_conversation_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b\n<|end|>"), (1, 1, "assistant", "b\n<|end|>"), (2, None, None, None), (2, 0, "od\nd", ""), (None, 0, "assistant", "é" * 90_000), (3, 5, "system", "[/INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"prompt": F.lit("x"), "messages": F.lit(1), "turns": F.lit(2), "loss": F.lit(0)})
    got = {r.conv_id: r for r in chat_format.query(df).collect()}
    assert set(got) == {1, 2, 3, None, -7}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\na\n" + "assistant\nb\n<|end|>\n" * 2) and got[1].loss_sha256 == sha("b\n<|end|>" * 2) and got[1].n_turns == 3
    assert got[2].turns_sha256 == sha("\n\nod\nd\n\n") and got[2].loss_chars == 0 and got[2].n_turns == 2
    assert got[None].loss_chars == 90_000 and got[-7].loss_sha256 == sha("</s>[INST] ok [/INST]")
    assert chat_format.query(df.limit(0)).count() == 1


# Secrets


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["password", "PASSWD", "token", "api_key", "apiKey", "secret", "=", ":", " ", '"', "'", "a1b2c3", "AKIA", "ABCDEFGHIJKLMNOPQRST", "0123456789abcdef", "é", "\n", "x", "/", "ſecret", "toKen"]), max_size=14))
def test_base_spans(parts):
    text = "".join(parts)
    base = ",".join(f"{k}:{a}:{b}" for a, b, k in secret_scan.spans(text) if k != "novel")
    assert hashlib.sha256(base.encode()).hexdigest() == secret_scan.brute_base(text)


def test_novel_strings():
    r = random.Random(6)
    key = "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(40))
    kinds = lambda t: [k for *_, k in secret_scan.spans(t)]
    assert kinds(f"the bearer {key} was sent") == ["novel"] and kinds(f"private key\n{key}") == ["novel"]
    assert kinds(f"nothing to hide {key}") == [] and kinds("bearer zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1") == []
    assert kinds("auth 0123456789abcdefghijklmnopqrstuvwxyz") == []
    assert secret_scan.redact(f"bearer {key} token={key} end") == "bearer [SECRET] [SECRET] end" and secret_scan.redact(None) is None
    assert kinds(f"bearer {key} {key}") == ["novel", "novel"]  # its own copy doesn't make it known
    assert kinds("abcSession1Handler2Factory abcSession1Handler2Fact the key abcSession1Handler2Factory9") == []  # the text does


def test_secret_rows(spark, odd, documents):
    assert secret_scan.query(odd.select("doc_id", "text", "spans")).count() == len(ODD)
    assert [r.text for r in secret_scan.redacted(odd).collect()] == [t for _, t in ODD]
    got = {r.doc_id: r.base_sha256 for r in secret_scan.query(documents).collect()}
    assert got == {r.doc_id: secret_scan.brute_base(r.text) for r in documents.collect()}
    assert secret_scan.query(odd.limit(0)).count() == 0


# Language


def test_cross_parsing_against_plain_search():
    r = random.Random(7)
    learnt = {"a": "".join(r.choice("abc  ") for _ in range(300)), "b": "".join(r.choice("bcdé ") for _ in range(500))}
    parser = language_id.CrossParser(learnt)
    texts = ["".join(r.choice("abcdé x") for _ in range(r.randint(1, 3000))) for _ in range(30)] + ["b", "zz"]
    want = plain_figures(learnt, texts)
    assert np.allclose(parser.figures(texts), want)


def plain_figures(learnt, texts):
    """Each phrase the longest match from where the last one ended, found by search; an unknown letter is a phrase."""
    want = []
    for t in texts:
        s, row = "".join(map(chr, language_id.symbols(t))), []
        for n in sorted(learnt):
            train, phrases, i = "".join(map(chr, language_id.symbols(learnt[n]))), 0, 0
            while i < len(s):
                j = i + 1
                while j <= len(s) and s[i:j] in train:
                    j += 1
                i, phrases = max(j - 1, i + 1), phrases + 1
            row.append(phrases * np.log2(len(train)) / len(s))
        want.append(row)
    return want


@pytest.mark.parametrize("piece", [1, 2, 7, 50, 1024])
@pytest.mark.parametrize("together", [1, 5, 4096])
def test_pieces_change_nothing(monkeypatch, piece, together):
    """Phrases over the borders of pieces; the labelled text holds long parts of some texts."""
    monkeypatch.setattr(language_id, "PIECE", piece)
    monkeypatch.setattr(language_id, "SIDE_BY_SIDE", together)
    r = random.Random(piece)
    long = "".join(r.choice("ab c") for _ in range(400))
    learnt = {"x": long + " zzz", "y": "aaaa bbbb cccc" * 9}
    texts = [long[20:300], long[:90] + "q" + long[90:200], "a" * 150, "", "ab", "zz" + long[5:60] * 3] + ["".join(r.choice("abcq ") for _ in range(r.randint(1, 130))) for _ in range(8)]
    assert np.allclose(language_id.CrossParser(learnt).figures(texts), plain_figures(learnt, texts))


def test_long_runs():
    """Phrases as long as pieces, which begin nowhere else in two parses: plain figures, and time that is linear and short."""
    r = random.Random(9)
    learnt = {"a": "the cat sat " * 20 + "a" * 700 + " dog", "b": "ababab" * 150 + "der hund", "c": "".join(chr(0x4E00 + r.randrange(300)) for _ in range(400)) + "\u4e00" * 900}
    parts = ["a" * 900, "ab" * 300, "\u4e00" * 500, "the cat", "b"]
    texts = ["a" * 4000, "ab" * 1500, "\u4e00" * 3000, "a" * 3000 + "the cat " * 9, "".join(r.choice(parts) for _ in range(9))]
    parser = language_id.CrossParser(learnt)
    assert np.allclose(parser.figures(texts), plain_figures(learnt, texts))
    began = time.process_time()
    parser.figures(["a" * 400_000, "\u4e00" * 400_000])
    assert time.process_time() - began < 5


def test_large_alphabets():
    """Thousands of letters, each its own; some are in both texts."""
    r = random.Random(8)
    learnt = {k: "".join(chr(base + r.randrange(n)) for _ in range(3000)) for k, base, n in (("ko", 0xAC00, 2000), ("mixed", 0x4E00, 40), ("zh", 0x4E00, 3000))}
    parser = language_id.CrossParser(learnt)
    assert parser.size > 3000 and parser.width == language_id.COLUMNS + 1
    texts = [learnt["zh"][5:300], learnt["ko"][5:300], learnt["mixed"][9:80] + learnt["zh"][700:760], "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(2500)), "abc"]
    assert np.allclose(parser.figures(texts), plain_figures(learnt, texts))
    assert [p for p, _ in parser.predict([*texts[:2], "123", None])] == ["zh", "ko", "und", "und"]


def test_dirty_languages(spark):
    """Values that one document has don't crowd out the others."""
    rows = [(i, f"the word of the {i} river and town", "en", None, 0) for i in range(200)] + [(1000 + i, "ein wort und der fluss", f"x{i}", None, 0) for i in range(400)]
    learnt = dict(language_id.learn(spark.createDataFrame(rows, DOCS)))
    assert len(learnt) <= language_id.MOST_LANGS and len(learnt["en"]) > 1000


def test_language_held_out(documents):
    rows = {r.doc_id: r.lang for r in documents.collect()}
    got = language_id.query(documents).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows) and {r.doc_id for r in held} == {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == rows[r.doc_id] for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_rows(spark, odd):
    got = language_id.query(odd.select("doc_id", "text", "lang", "score")).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)} and len(got) == len(ODD)
    learnt = (("xx", "abc def wort " * 50), ("yy", "lmn opq " * 50))
    assert [r.lang_pred for r in language_id.identify(odd, learnt).collect()] == ["und", "und", "und", "xx", "xx", "xx", "xx", "yy"]  # neither knows the last: the cheaper phrases win
    assert language_id.query(odd.limit(0)).count() == 0


# Quality


def plain_rules(text):
    words = (text or "").encode().split()
    lines, seen, dup = (text or "").split("\n"), Counter(), 0
    for x in lines:
        if x.encode().split():
            dup += seen[x] > 0
            seen[x] += 1
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    return n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cc", " ", "\n", "\t", "#", "|", "é", "\xa0", "\x0b"]), max_size=80))
def test_base_rules(parts):
    text = "".join(parts)
    assert quality_rules.base_rules(text) == plain_rules(text)


def test_viterbi_against_all_labellings():
    from itertools import product

    rng = np.random.default_rng(9)
    for n in (1, 2, 5, 8):
        field = quality_rules.LineField(rng.normal(size=(2, quality_rules.N_FEATURES)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, quality_rules.N_FEATURES))
        score = x @ field.emit.T
        total = lambda y: sum(score[i, y[i]] for i in range(n)) + sum(field.move[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: E731, B023
        assert tuple(field.labels(x)) == max(product((0, 1), repeat=n), key=total)


def test_line_field_gradient():
    """Against differences of the likelihood, for runs of several lengths."""
    r = np.random.default_rng(4)
    samples = [(r.normal(size=(n, quality_rules.N_FEATURES)), r.integers(0, 2, n)) for n in (1, 3, 7)]
    batch, p = quality_rules._batch(samples), r.normal(size=2 * quality_rules.N_FEATURES + 4)
    _, g = quality_rules.likelihood(p, *batch)
    for k in range(len(p)):
        step = np.zeros_like(p)
        step[k] = 1e-5
        near = (quality_rules.likelihood(p + step, *batch)[0] - quality_rules.likelihood(p - step, *batch)[0]) / 2e-5
        assert abs(near - g[k]) < 1e-6


@pytest.fixture(scope="module")
def quality_folds(documents, labels):
    truth = {r.doc_id: r.quality for r in labels.collect()}
    known = [(r.doc_id, r.text, truth[r.doc_id]) for r in documents.collect() if truth.get(r.doc_id) is not None and r.text]
    return [(t, y) for i, t, y in known if i % 2], [(t, y) for i, t, y in known if not i % 2]


def test_quality_on_held_out_labels(quality_folds):
    train, held = quality_folds
    field = quality_rules.learn(train)
    good = [quality_rules.content_share(field, t) >= 0.5 for t, y in held if y and not quality_rules.base_rules(t)[-1]]
    junk = [quality_rules.content_share(field, t) >= 0.5 for t, y in held if not y]
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.1
    assert field.move[0, 0] + field.move[1, 1] > field.move[0, 1] + field.move[1, 0] and np.abs(field.move).max() < 5


def test_lines_of_held_out_mixtures(quality_folds):
    """Good texts with lines of low texts put between theirs: the field marks lines, not texts."""
    train, held = quality_folds
    field = quality_rules.learn(train)
    mixed = quality_rules.mixtures(held, quality_rules.line_labels(held), seed=1)
    found = [field.labels(quality_rules.features(t)[0]) for t, _ in mixed]
    want, got = np.concatenate([y for _, y in mixed]), np.concatenate(found)
    assert (got[want == 1] == 1).mean() > 0.95 and (got[want == 0] == 0).mean() > 0.9
    assert np.mean([len(set(y.tolist())) == 2 for y in found]) > 0.8
    # Whole low texts after good ones, their clean lines counted as boilerplate too.
    r = random.Random(2)
    low, right, n = [quality_rules._lines(t) for t, y in held if not y], [0, 0], [0, 0]
    for text in [t for t, y in held if y]:
        lines, more = quality_rules._lines(text), r.choice(low)
        y = field.labels(quality_rules.features("\n".join(lines + more))[0])
        for k, part in ((1, y[: len(lines)]), (0, y[len(lines) :])):
            right[k] += (part == k).sum()
            n[k] += len(part)
    assert right[1] > 0.95 * n[1] and right[0] > 0.85 * n[0]


def test_quality_rows(spark, odd, documents, labels):
    none = labels.limit(0)
    got = quality_rules.query(odd.select("doc_id", "text", "kept"), none).collect()
    assert [(r.n_words, r.kept) for r in got[:3]] == [(0, False)] * 3 and len(got) == len(ODD) and got[6].n_repeat_words == 40_000
    got = {r.doc_id: r for r in quality_rules.query(documents, labels).collect()}
    for r in documents.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == plain_rules(r.text) and not (g.kept and g.base_failed)
    assert quality_rules.query(odd.limit(0), none).count() == 0


# Media


@settings(max_examples=30, deadline=None)
@given(st.binary(min_size=1, max_size=900), st.sampled_from(["none", "least"]))
def test_png_round_trip(data, filters):
    payload = data + b" " * (-len(data) % 192)
    assert media_columns.decode(media_columns.encode(payload, filters)).tobytes() == payload


@pytest.mark.parametrize("kind", [0, 1, 2, 3, 4])
def test_row_filters(kind):
    raw = np.random.default_rng(kind).integers(0, 256, (9, 192), dtype=np.uint8)
    lines = np.zeros_like(raw)
    for y in range(9):
        for x in range(192):
            a, b, c = (int(raw[y, x - 3]) if x >= 3 else 0, int(raw[y - 1, x]) if y else 0, int(raw[y - 1, x - 3]) if y and x >= 3 else 0)
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            lines[y, x] = (int(raw[y, x]) - (0, a, b, (a + b) // 2, near)[kind]) % 256
    assert (media_columns.unfilter(np.full(9, kind, np.uint8), lines, 3) == raw).all()


def plain_filters(raw):
    """By row: the first filter of the least sum of signed differences, pixel by pixel."""
    kinds = []
    for y in range(len(raw)):
        best = None
        for kind in range(5):
            total = 0
            for x in range(raw.shape[1]):
                a, b, c = (int(raw[y, x - 3]) if x >= 3 else 0, int(raw[y - 1, x]) if y else 0, int(raw[y - 1, x - 3]) if y and x >= 3 else 0)
                p = a + b - c
                near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                d = (int(raw[y, x]) - (0, a, b, (a + b) // 2, near)[kind]) % 256
                total += min(d, 256 - d)
            best = min(best or (total, kind), (total, kind))
        kinds.append(best[1])
    return kinds


def test_files_of_many_sizes_together():
    r = np.random.default_rng(5)
    made = r.integers(0, 256, (30, 192), dtype=np.uint8)
    for y in range(1, 30):
        for x in range(3, 192):  # rows like the one above, and like the mean of left and above
            made[y, x] = (int(made[y - 1, x]) if y % 2 else (int(made[y, x - 3]) + int(made[y - 1, x])) // 2) + r.integers(0, 2) & 255
    walk = lambda n: np.cumsum(r.integers(-9, 9, n * 192)).astype(np.uint8)
    text = np.frombuffer(b"some words of text " * 900, np.uint8)
    shapes = [walk(1), text[: 3 * 192], walk(70), text[: 2 * 192], walk(1), made.ravel(), text[: 80 * 192]]
    files = media_columns.encode_all([s.tobytes() for s in shapes])
    assert files == [media_columns.encode(s.tobytes()) for s in shapes]
    used = set()
    for s, f, back in zip(shapes, files, media_columns.decode_all(files), strict=True):
        assert back.tobytes() == s.tobytes() == media_columns.decode(f).tobytes()
        lines = np.frombuffer(zlib.decompress(f[41 : 41 + int.from_bytes(f[33:37], "big")]), np.uint8).reshape(-1, 193)
        assert lines[:, 0].tolist() == plain_filters(s.reshape(-1, 192))
        used |= set(lines[:, 0].tolist())
    assert {1, 2, 3, 4} <= used


def test_documents_are_filtered(documents):
    """Reading back undoes filters on the documents, Average and Paeth among them."""
    texts = [r.text for r in documents.select("text").limit(60).collect()]
    kinds = np.concatenate([media_columns.filtered(np.frombuffer(p, np.uint8).reshape(-1, 192), [len(p) // 192])[0] for p in (media_columns.payload(t)[1] for t in texts)])
    assert (kinds > 0).mean() > 0.9 and {1, 2, 3, 4} <= set(kinds.tolist())


def test_broken_files():
    file = media_columns.encode(b"ab" * 96)
    for bad in (b"x" + file, file[:40], file[:-5], file[:45] + bytes([file[45] ^ 1]) + file[46:], file[:60]):
        with pytest.raises(ValueError):
            media_columns.decode(bad)


def test_media_rows(spark, odd):
    got = media_columns.query(odd.select("doc_id", "text", "media")).collect()
    for r, (i, t) in zip(got, ODD, strict=True):
        data = (t or "").encode()
        payload = data + b" " * (max(1, -(-len(data) // 192)) * 192 - len(data))
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (i, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert len(r.feature) == 16
    assert got[0].media_sha256 == got[1].media_sha256 and got[3][1:] == got[4][1:]
    assert media_columns.query(odd.limit(0)).count() == 0


def test_feature_is_perceptual():
    a = np.random.default_rng(1).integers(60, 200, (8, 8, 1)).repeat(8, 0).repeat(8, 1).repeat(3, 2).astype(np.uint8)
    bits = lambda x: int(media_columns.feature(x), 16)
    assert bin(bits(a) ^ bits(np.clip(a.astype(int) + 9, 0, 255).astype(np.uint8))).count("1") <= 4
    assert bin(bits(a) ^ bits(255 - a)).count("1") > 30


# Toxicity


@pytest.fixture(scope="module")
def scorer(documents, labels):
    weights, words, fitted = toxicity.fit(documents, labels)
    return toxicity.Scorer(dict(weights), toxicity.CharModel(Counter(dict(words))), fitted)


@pytest.mark.parametrize("token, word", [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("!d!ot", "idiot"), ("m0r0n", "moron"), ("cl0wn", "clown"), ("i d i o t", "idiot")])
def test_restored_words(scorer, token, word):
    assert word in toxicity.decode(token, scorer.model).split()


def test_plain_tokens_stay(scorer):
    for token, word in (("word", "word"), ("don't", "don't"), ("the!!", "the"), ("of$$$", "of"), ("3", "3"), ("well-known", "well-known"), ("boot", "boot"), ("(so)", "so")):
        assert set(toxicity.readings(token, scorer.model)) == {word}
    assert toxicity.decode("plain", scorer.model) == "plain"


def test_toxic_held_out(documents, labels, scorer):
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.query(documents, labels).collect()
    assert len(got) == documents.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert {r.doc_id for r in got if r.held_out} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert np.mean([p for y, p in held if not y]) < 0.02 and np.mean([p for y, p in held if y]) >= 0.5
    clean = [r.text for r in documents.collect() if truth.get(r.doc_id) == 0][:40]
    for hidden in ("you 1d10t and m0r0n", "you i d i o t", "you cl.o.w.n idiooot"):
        assert np.mean([scorer.score(f"{t} {hidden}") >= 0.5 for t in clean]) > 0.9
    assert not any(scorer.score(t) >= 0.5 for t in clean)


def test_toxic_rows(spark, odd, labels):
    got = toxicity.query(odd.select("doc_id", "text", "score"), labels.limit(0)).collect()
    assert len(got) == len(ODD) and all(r.score < 1e-9 and r.predicted == 0 for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
    learnt = ((("abc", 9.0),), (("abc", 1),), (-3.0, 1.0, 0.0, 0.0))
    assert [r.score >= 0.5 for r in toxicity.score(odd, learnt).collect()] == [False] * 3 + [True] * 3 + [False] * 2
    assert toxicity.kept(odd, learnt).columns == odd.columns and toxicity.kept(odd, learnt).count() == 5
    assert toxicity.query(odd.limit(0), labels.limit(0)).count() == 0
