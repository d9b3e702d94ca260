"""SimHash groups, source mixing and packing: brute force, edge cases."""

import random
import time
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from basketspark.llm import mixing, packing, simhash_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD_DOCS = [
    (1, "a b c d e f g h", "en", "s", 1),
    (1, "a b c d e f g h", "en", "s", 1),
    (2, None, None, None, None),
    (3, "", "en", "s", 0),
    (4, " \t\n", "en", "s", 3),
    (None, "A B C D E F G H", None, "s", 1),
    (5, "one two", "en", None, 7),
    (6, "wort " * 30_000, "de", "long", 1),
    (7, "x" * 200_000, "de", "long", 1),
]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def odd(spark):
    """Rows with nulls, blanks, repeats and long texts, and columns that clash with internal names."""
    df = docs(spark, ODD_DOCS)
    for c in ("fp", "key", "copies", "size", "piece", "component_id", "_key", "n", "part"):
        df = df.selectExpr("*", f"doc_id AS {c}")
    return df


def plain_simhash(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(fps):
    """Smallest id that can be reached, by all pairs."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in fps}


@pytest.mark.parametrize("text", ["", " ", None, "One", "one TWO", "a b c", "ÀÉ b\x0bc d", "a\xa0b c d e", "x y " * 40_000])
def test_simhash(text):
    assert simhash_dedup.simhash(text) & (1 << 64) - 1 == plain_simhash(text)


def test_links_against_all_pairs(spark):
    r = random.Random(1)
    fps = {r.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:  # a cloud of close values, chains, and pairs over all segment borders
        for _ in range(4):
            f ^= (1 << r.randrange(64)) ^ (1 << r.randrange(64))
            fps.add(f)
    middle = r.getrandbits(64)
    fps |= {middle ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a, 64, 5)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = plain_groups({i: f & (1 << 64) - 1 for i, f in enumerate(signed)})
    for bucket in (1, 2, 64, 10_000):
        edges = simhash_dedup.links(df, pair_bucket=bucket)
        assert all(bin((e.a ^ e.b) & (1 << 64) - 1).count("1") <= 2 for e in edges.collect())
        got = {n.node: n.root for n in simhash_dedup.components(edges).collect()}
        label = [got.get(f, f) for f in signed]
        same = defaultdict(set)
        for i, x in enumerate(label):
            same[x].add(want[i])
        assert all(len(v) == 1 for v in same.values()) and len(same) == len(set(want.values()))


@pytest.mark.parametrize(("bits", "bucket"), [(1, 4), (2, 4), (3, 4), (4, 8), (5, 8), (6, 16), (8, 64), (8, 10_000)])
def test_links_of_other_radii(spark, bits, bucket):
    """All pairs within the radius, large buckets and small."""
    r = random.Random(bits)
    fps = {r.getrandbits(64) for _ in range(100)}
    for f in list(fps)[:25]:
        for _ in range(6):
            for _ in range(r.randrange(1, bits + 2)):
                f ^= 1 << r.randrange(64)
            fps.add(f)
    signed = np.array([f - (1 << 64) if f >> 63 else f for f in fps], np.int64)
    far = np.bitwise_count(signed.view(np.uint64)[:, None] ^ signed.view(np.uint64))
    want = {(int(signed[i]), int(signed[j])) for i, j in zip(*np.nonzero(far <= bits), strict=True) if signed[i] > signed[j]}
    got = simhash_dedup.links(spark.createDataFrame([(int(f),) for f in signed], "fp long"), bits, pair_bucket=bucket)
    assert {(e.a, e.b) for e in got.collect()} == want


def test_links_of_one_large_bucket(spark):
    """10,000 fingerprints that agree in 34 bits: links are found through longer chains."""
    r = random.Random(2)
    fps = {r.getrandbits(30) for _ in range(9000)}
    fps |= {f ^ 1 << r.randrange(30) ^ 1 << r.randrange(30) for f in list(fps)[:1000]}
    every = sorted(fps)
    want = set()
    for x in every:
        for m in (0, *(1 << i for i in range(64))):
            for k in range(64):
                if (y := x ^ m ^ 1 << k) < x and y in fps:
                    want.add((x, y))
    got = simhash_dedup.links(spark.createDataFrame([(f,) for f in every], "fp long"))
    assert {(e.a, e.b) for e in got.collect()} == want


@pytest.mark.parametrize("task", [3, 40, 100_000])
def test_components_of_chains_stars_and_chance(spark, task):
    r = random.Random(task)
    edges = [(i + 1, i) for i in range(60)] + [(1000 + i, 1000) for i in range(1, 50)] + [(max(x), min(x)) for x in (r.sample(range(2000, 2100), 2) for _ in range(70))]
    root = {n: n for e in edges for n in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = simhash_dedup.components(spark.createDataFrame(edges, "a long, b long"), task=task).collect()
    assert sorted((x.node, x.root) for x in got) == sorted((n, find(n)) for n in root if find(n) != n)
    assert simhash_dedup.components(spark.createDataFrame([], "a long, b long"), task=task).count() == 0


def test_near_duplicate_rows(spark, odd):
    got = simhash_dedup.query(odd.select("doc_id", "text", "fp")).collect()
    assert len(got) == len(ODD_DOCS)
    of = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert of[2, "0" * 16] == of[3, "0" * 16] == of[4, "0" * 16] == 2
    assert {c for (i, _), c in of.items() if i in (None, 1)} == {1}
    kept = simhash_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "5", "6", "7", "None"]


def test_near_duplicates_on_the_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_groups({r.doc_id: plain_simhash(r.text) for r in df.collect()})
    assert {r.doc_id: r.component_id for r in simhash_dedup.query(df).collect()} == want


def test_empty_tables(spark):
    none = docs(spark, [])
    assert simhash_dedup.query(none).count() == mixing.query(none).count() == packing.query(none).count() == 0
    assert simhash_dedup.deduplicate(none).count() == mixing.mix(none).count() == 0


def plain_targets(sizes):
    """Water-filling, by hand: (source, words) to target."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, total = set(), Fraction(3 * sum(sizes.values()), 2)
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        of = {s: left * weight[s] / sum(weight[x] for x in order if x not in full) for s in order if s not in full}
        over = {s for s, t in of.items() if t > 2 * sizes[s]}
        if not over:
            return {s: float(2 * sizes[s] if s in full else of[s]) for s in order}
        full |= over


def test_targets(spark):
    r = random.Random(3)
    many = [{"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 0, None: 5}, {}, {None: 7}, {"a": 0, "b": 0}, {f"s{i}": r.choice((0, 1, 5, 50, 3000)) for i in range(40)}]
    for sizes in many:
        got = {x.source: x.target for x in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, n long")).collect()}
        assert got == pytest.approx(plain_targets(sizes)) and set(got) == set(sizes)
    assert got["s0"] is not None and mixing.targets(spark.createDataFrame([("a", 100), ("b", 100), ("c", 100)], "source string, n long")).collect()[0].target == 200.0


def test_many_sources(spark):
    """50,000 sources, and as many overlapping patterns for the flow alone."""
    df = spark.range(100_000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 13 AS int)) AS text", "concat('s', id % 50000) AS source", "'en' AS lang", "0L AS n_chars")
    began = time.time()
    got = mixing.query(df).agg({"taken": "sum", "size": "sum"}).first()
    assert time.time() - began < 240 and 1.3 < got["sum(taken)"] / got["sum(size)"] < 1.6
    r, began = random.Random(6), time.process_time()
    capacity = {frozenset(r.sample(range(300), r.randint(2, 4))): r.randint(1, 900) for _ in range(50_000)}
    flow = mixing.min_cost_flow(capacity, {s: sum(capacity.values()) // 200 for s in range(300)})
    assert time.process_time() - began < 120 and sum(map(sum, flow.values())) == 300 * (sum(capacity.values()) // 200)
    assert all(0 <= b and a <= capacity[p] >= b for p, (a, b) in flow.items())


def test_flow_of_overlapping_sources():
    ab, a, b = frozenset("ab"), frozenset("a"), frozenset("b")
    flow = mixing.min_cost_flow({ab: 100, a: 50, b: 50}, {"a": 120, "b": 80})
    assert sum(map(sum, flow.values())) == 200 and all(x[1] == 0 for x in flow.values())
    flow = mixing.min_cost_flow({ab: 100, a: 50}, {"a": 150, "b": 60})
    assert {p: sum(x) for p, x in flow.items()} == {ab: 110, a: 100} or sum(map(sum, flow.values())) == 210
    assert all(x[0] == n or x[1] == 0 for x, n in ((flow[ab], 100), (flow[a], 50)))
    assert sum(map(sum, mixing.min_cost_flow({a: 10}, {"a": 50}).values())) == 20


def test_flow_costs_least():
    """Against all integer flows of a small network."""
    r = random.Random(4)
    for _ in range(20):
        capacity = {frozenset("a"): r.randint(0, 3), frozenset("b"): r.randint(0, 3), frozenset("ab"): r.randint(0, 3)}
        quota = {"a": r.randint(0, 6), "b": r.randint(0, 6)}
        best = None
        na, nb, nab = (capacity[frozenset(k)] for k in ("a", "b", "ab"))
        for x in range(min(2 * na, quota["a"]) + 1):
            for y in range(min(2 * nb, quota["b"]) + 1):
                for z in range(min(2 * nab, quota["a"] - x + quota["b"] - y) + 1):
                    cost = max(0, x - na) + max(0, y - nb) + max(0, z - nab)
                    best = min(best or (0, 0), (-(x + y + z), cost)) if best else (-(x + y + z), cost)
        flow = mixing.min_cost_flow(capacity, quota)
        assert (-sum(map(sum, flow.values())), sum(v[1] for v in flow.values())) == best


def test_mix(spark, odd):
    got = mixing.query(odd.select("doc_id", "text", "source", "size")).collect()
    assert len(got) == len(ODD_DOCS) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert sum(r.taken for r in got if r.doc_id in (2, 5)) == 2 * 2  # the null source holds 2 words and takes twice that
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    again = mixing.mix(odd).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {r.doc_id: r["count"] for r in again}


def test_documents_without_ids_spread(spark):
    df = docs(spark, [(None, f"text number {i}", None, "s", 0) for i in range(300)])
    keys = {r.key for r in df.select(mixing.seeded("doc_id", "text").alias("key")).collect()}
    assert len(keys) == 300 and sum(r.taken for r in mixing.query(df).collect()) == pytest.approx(1350, abs=3)


def test_mix_comes_near_its_targets(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(1, 60), "en", r.choice("aaaaaabbc"), 0) for i in range(3000)]
    got = mixing.query(docs(spark, rows)).collect()
    taken = defaultdict(int)
    for x in got:
        taken[x.source_size, x.target] += x.taken
    assert all(abs(t - n) <= 60 for (_, t), n in taken.items())


def test_mix_of_overlapping_sources(spark):
    rows = [(i, f"{'w ' * (i % 7 + 1)}", [["a"], ["b", "a"], ["b"], None][i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    sized = df.select("doc_id", "sources", mixing.n_words("text").alias("size"), mixing.seeded("doc_id", "text").alias("key"))
    goals, levels = mixing.plan(sized, "sources", "size", member_of=True)
    flow = defaultdict(dict)
    for x in levels.collect():
        flow[frozenset(x.pattern)][x.level] = x.flow
    flow = {p: list(x.values()) for p, x in flow.items()}
    assert {g.source for g in goals.collect()} == {"a", "b", None} and sum(map(sum, flow.values())) > 0
    assert set(flow) == {frozenset("a"), frozenset("ab"), frozenset("b"), frozenset([None])}
    edges = mixing.edges_of(sized, levels, "sources", "size", "key", member_of=True)
    taken = mixing.with_copies(sized, edges, "sources", "key", sized["size"], ["doc_id"], ["doc_id", "sources", "size"], member_of=True).collect()
    assert len(taken) == 400
    by = defaultdict(int)
    for x in taken:
        by[frozenset(x.sources or [None])] += x.copies * x["size"]
    assert all(abs(by[p] - sum(f)) <= 14 for p, f in flow.items())


@pytest.mark.parametrize("text", ["", " ", "Hello, World! it's", "ΑΣ straße İ ŉ ½ 日本語 don't 've", "a\tb\r\nc  d", "<|endoftext|> x<|startoftext|>y", "x" * 50_000, "1234 5a6b ...!!! __ --"])
def test_encoder_is_the_tokenizer(text):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    assert np.frombuffer(packing.Encoder(path).texts([text])[0], "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_pack_is_whole_and_tight():
    r = random.Random(3)
    for lengths in ([r.randint(1, 4096) for _ in range(3000)], [1400] * 900 + [1300] * 600, [4096, 4096, 1], [1] * 5000, []):
        bins = packing.pack(list(lengths))
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 4096 for b in bins)
        assert len(bins) <= 1.02 * sum(lengths) / 4096 + 12 or lengths[0] == 1400
    # Greedy fills 6 + 4 of 11; the two 3s and 2 ... fit the gap of the smallest one better.
    assert {tuple(sorted([6, 4, 3, 2][i] for i in b)) for b in packing.pack([6, 4, 3, 2], 11)} == {(2, 3, 6), (4,)}


def plain_best_two_fit(lengths, size):
    """Bins of lengths: greedy filling, then the best pair for the smallest piece, found by trying all."""
    free, bins = sorted(lengths), []
    while free:
        held = []
        while fits := [n for n in free if n <= size - sum(held)]:
            held.append(fits[-1])
            free.remove(fits[-1])
        least, gap = min(held), size - sum(held)
        pairs = [(free[i] + free[j], free[i], free[j]) for i in range(len(free)) for j in range(i + 1, len(free)) if least < free[i] + free[j] <= least + gap]
        if gap and pairs:
            total, a, b = max(pairs)
            held.remove(least)
            held += [a, b]
            free.remove(a)
            free.remove(b)
            free = sorted([*free, least])
        bins.append(sorted(held))
    return bins


def test_pack_against_trying_all_pairs():
    r = random.Random(9)
    for _ in range(300):
        size = r.choice((9, 20, 60))
        lengths = [r.randint(1, size) for _ in range(r.randint(0, 25))]
        got = [sorted(lengths[i] for i in b) for b in packing.pack(list(lengths), size)]
        assert got == plain_best_two_fit(lengths, size)
    assert sorted(sorted([6, 4, 4][i] for i in b) for b in packing.pack([6, 4, 4], 9)) == [[4, 4], [6]]


def test_repeated_rows_spread_over_groups(spark):
    df = docs(spark, [(1, "same words here", None, None, 0)] * 900).repartition(3)
    found = packing.checkpointed(packing.pieces(df))
    got = packing.packed(found, group=100).groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()
    assert len(got) == 9 and max(g["count"] for g in got) < 150


def test_pieces_and_places(spark, odd):
    got = packing.query(odd.select("doc_id", "text", "piece")).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    six = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 6)
    assert six[0] == (0, 0, 4096) and [s for _, s, _ in six] == [4096 * i for i in range(len(six))] and sum(n for *_, n in six) == 30_001
    assert [(r.length, r.ids_crc32) for r in got if r.doc_id == 2] == [(1, zlib.crc32(np.array([1], "<u4").tobytes()))]
    assert len([r for r in got if r.doc_id == 1]) == 2


def test_flow_by_components(spark):
    """Two tangles and sources of their own, each solved in a task, against one flow over all; plans and actions tell where."""
    r, names = random.Random(8), [[f"a{i}" for i in range(6)], [f"b{i}" for i in range(5)], ["c"], [None]]
    rows = [(i, sorted(r.sample(of, min(len(of), r.randint(1, 3))), key=str), r.randint(0, 40)) for i in range(600) for of in [r.choice(names)]]
    df = spark.createDataFrame([(i, "w " * n, s) for i, s, n in rows], "doc_id long, text string, sources array<string>").select("doc_id", "sources", mixing.n_words("text").alias("size"))
    goals, levels = mixing.plan(df, "sources", "size", member_of=True)
    assert "FlatMapGroupsInArrow" in (plan := levels._jdf.queryExecution().toString()) and "MapInArrow" in plan
    capacity = defaultdict(int)
    for _, s, n in rows:
        capacity[frozenset(s)] += n
    quota = {g.source: int(g.target + 0.5) for g in goals.collect()}
    whole, parts = mixing.min_cost_flow(dict(capacity), quota), defaultdict(list)
    for x in levels.orderBy("level").collect():
        parts[frozenset(x.pattern)].append(x.flow)
    assert set(parts) == set(capacity)
    assert [sum(f[k] for f in parts.values()) for k in (0, 1)] == [sum(f[k] for f in whole.values()) for k in (0, 1)]
    again = mixing.plan(df.repartition(7), "sources", "size", member_of=True)[1]
    assert sorted(map(repr, levels.collect())) == sorted(map(repr, again.collect()))


def test_query_runs_the_flow(spark):
    df = docs(spark, [(i, "w " * (i % 9), "en", "abc"[i % 3], 0) for i in range(90)])
    sized = df.select("source", mixing.n_words("text").alias("size"))
    goals, levels = mixing.plan(sized)
    assert "MapInArrow" in levels._jdf.queryExecution().toString()
    want = {g.source: [min(g.n, int(g.target + 0.5)), min(g.n, int(g.target + 0.5) - min(g.n, int(g.target + 0.5)))] for g in goals.collect()}
    got = defaultdict(list)
    for x in levels.orderBy("level").collect():
        got[x.pattern].append(x.flow)
    assert got == want


def test_pack_where_no_two_pieces_fit():
    began = time.process_time()
    bins = packing.pack([2049] * 20_000)
    assert len(bins) == 20_000 and time.process_time() - began < 2
    assert sorted(map(len, packing.pack([2049] * 10 + [2047, 1, 1]))) == [1] * 8 + [2, 3]
