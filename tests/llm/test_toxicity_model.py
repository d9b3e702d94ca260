"""The decoder's character model is of all documents, labelled or not."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import duckdb
import numpy as np
import pytest

from basketspark.llm import toxicity


def plain(texts):
    out = Counter()
    for t in texts:
        for w in (t or "").lower().split():
            if (w := w.strip(toxicity.TRIM)).isalpha():
                s = f"  {w} "
                out.update(s[i : i + 3] for i in range(len(s) - 2))
    return out


def test_trigrams_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert Counter(dict(toxicity.trigrams(docs))) == plain(r.text for r in docs.select("text").collect())


def test_unlabelled_and_long_texts_count(spark):
    rows = [(i, "plain words here" if i % 2 else "vileword vileword", i % 2 == 0) for i in range(200)] + [(1000, "žluťoučký " * 3000, None), (1001, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bad boolean").repartition(2)
    labels = df.filter("bad IS NOT NULL").selectExpr("doc_id", "int(bad) AS toxic")
    weights, grams, _ = toxicity.fit(df, labels)
    assert weights and dict(grams)["žlu"] == 3000


def every_path(token, model):
    """(cost, letters) of each path through a token's lattice, one by one."""
    for path in product(*toxicity.lattice(token)):
        cost, a, b = sum(c for _, c in path), " ", " "
        for c in "".join(x for x, _ in path) + " ":
            if not (c == " " and b == " "):
                cost += model.cost(a, b, c)
                a, b = (" ", " ") if c == " " else (b, c)
        yield cost, "".join(x for x, _ in path).strip()


@pytest.mark.parametrize("token", ["1d10t", "i.d.i.o.t", "idiooot", "f0000l", "a_b-c", "$t00p!d", "m|n|m", "heeello", "0", "b4.d", "x.y.z.", "i d i o t", "a  b\tc d"])
def test_decoding_against_all_paths(token):
    model = toxicity.CharModel(plain(["the idiot fool said hello to a bad stupid minimum of idiots", "fool fool idiot bad"]))
    costs = sorted(every_path(token, model))
    found = toxicity.decode(token, model)
    assert min(c for c, w in costs if w == found) <= costs[0][0] + 1e-9


def test_wide_gaps():
    assert toxicity.SPACED.findall("you i  d  i\to\u00a0t there") == ["i  d  i\to\u00a0t"]


DISGUISES = {
    "clear": lambda w: w,
    "signs": lambda w: w.translate(str.maketrans("oieas", "0134$")),
    "dots": lambda w: ".".join(w),
    "blanks": lambda w: " ".join(w),
    "runs": lambda w: "".join(c * (4 if c in "aeiou" else 1) for c in w),
}


def test_held_out_recall_of_clear_and_disguised_words():
    """Learnt on four folds; toxic texts of the fifth, and clean ones into which learnt words are put, plain and in disguise."""
    data = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT d.doc_id, d.text, l.toxic FROM '{data}/documents.parquet' d JOIN '{data}/labels.parquet' l USING (doc_id) WHERE l.toxic IN (0, 1) AND d.text IS NOT NULL").fetchall()
    folds = defaultdict(list)
    for i, text, y in rows:
        folds[zlib.crc32(str(i).encode()) % 5 == 0].append((text, y))
    weights, figures = toxicity.fitted([(t, y) for t, y in folds[False] if len(t) <= toxicity.TRAIN_CHARS])
    weights, model = sorted(weights.items()), toxicity.CharModel(dict(plain(t for _, t, _ in rows)))
    scorer = toxicity.Scorer(dict(weights), model, figures)
    toxic, clean = [t for t, y in folds[True] if y], [t for t, y in folds[True] if not y]
    found = np.mean([scorer.score(t) >= 0.5 for t in toxic]), np.mean([scorer.score(t) < 0.5 for t in clean])
    words = [w for w, x in sorted(weights, key=lambda v: -v[1]) if w.isalpha() and w.isascii() and len(w) >= 5][:8]
    short = [" ".join(t.split()[:120]) for t in clean[:100]]
    recall = {}
    for name, hide in DISGUISES.items():
        recall[name] = np.mean([scorer.score(f"{t} {hide(w)} and {hide(v)}.") >= 0.5 for t, w, v in zip(short, words * 20, words[3:] * 30, strict=False)])
    print(len(toxic), len(clean), found, recall)
    assert found[0] > 0.9 and found[1] > 0.97 and all(x >= 0.8 for x in recall.values())


def test_alphabet_is_bounded(spark):
    """20,000 different letters: those of other words are one symbol, and nothing is left out of the counts."""
    letters = [chr(0x4E00 + i) for i in range(20_000)]
    rows = [(i, "".join(letters[i * 10 : i * 10 + 10]) + " idiot fool") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    grams = dict(toxicity.trigrams(df, first=["ž"]))
    known = set("".join(grams))
    assert len(known - {" ", toxicity.OTHER}) <= toxicity.ALPHABET and set("idtfl") <= known
    assert grams["idi"] == 2000 and sum(grams.values()) == sum(plain(t for _, t in rows).values())
    model = toxicity.CharModel(grams)
    assert model.cost(*letters[-3:]) == model.cost(toxicity.OTHER, toxicity.OTHER, toxicity.OTHER) and toxicity.decode("1d10t", model) == "idiot"


def test_tasks_hand_trigrams_on(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "WORDS", 5)
    texts = ["one two three four five six seven", None, "eight nine ten one two"] * 3
    got = Counter()
    for b in toxicity._grams([pa.RecordBatch.from_arrays([pa.array(texts[:4])], names=["t"]), pa.RecordBatch.from_arrays([pa.array(texts[4:])], names=["t"])]):
        for g, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            got[g] += n
    assert got == plain(texts)
