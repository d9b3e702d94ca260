"""The pipeline's stages against plain programs, each on its own input."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from basketspark.llm import common, mixing, near_copies, packing, secret_scan, toxicity

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = common.table(spark, DATA, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = common.stored(stage(spark, docs, DATA))
        out.append((name, docs, made))
        docs = made
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "simhash_near_duplicates", "secret_scan", "mixing", "best_fit_packing"]
    assert all(made.columns == COLUMNS for _, _, made in stages[:-1])


def test_toxic_documents_go(spark, stages):
    _, before, after = stages[0]
    weights, words, fitted = toxicity.fit(before, common.table(spark, DATA, "labels"))
    scorer = toxicity.Scorer(dict(weights), toxicity.CharModel(Counter(dict(words))), fitted)
    assert sorted(rows(after)) == sorted(r for r in rows(before) if scorer.score(r[1]) < 0.5)


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    every = rows(before)
    sets = [set(near_copies.shingles(r[1]).tolist()) for r in every]
    root = list(range(len(every)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    left = rows(after)
    assert len(left) == len({find(i) for i in range(len(every))}) and set(left) <= set(every)
    assert {find(every.index(r)) for r in left} == {find(i) for i in range(len(every))}


def test_secrets_are_replaced(stages):
    _, before, after = stages[2]
    want = sorted((i, secret_scan.redact(t), lang, source, len(secret_scan.redact(t))) for i, t, lang, source, _ in rows(before))
    assert sorted(rows(after)) == want and not any(secret_scan.spans(r[1]) for r in rows(after))


def test_the_mix_is_the_operators(stages):
    _, before, after = stages[3]
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.query(before).collect()}
    copies = Counter(r[0] for r in rows(after))
    assert all(copies[i] * n == t for i, (t, n) in taken.items()) and set(rows(after)) <= set(rows(before))


def test_all_tokens_are_packed(stages):
    _, before, after = stages[4]
    encoder = packing.Encoder(packing.tokenizer_path())
    tokens = Counter((i, len(encoder.texts([t])[0]) // 4 + 1) for i, t, *_ in rows(before))
    got, places = defaultdict(int), defaultdict(list)
    for r in after.collect():
        got[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(int)
    for (i, n), k in tokens.items():
        want[i] += n * k
    assert got == want
    for held in places.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:], strict=False)) and sum(n for _, n in held) <= 4096
    assert len(places) <= -(-sum(want.values()) // 4096) + 2


def test_run_is_the_stages(spark, stages):
    assert sorted(rows(corpus_pipeline.run(spark, DATA))) == sorted(rows(stages[-1][2]))


def test_nulls_and_empty_tables(spark, tmp_path):
    odd = [(None, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (3, "token = abcdef0123456789", "en", None, 5), (3, "token = abcdef0123456789", "en", None, 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("odd", odd), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(got) == bool(data)
