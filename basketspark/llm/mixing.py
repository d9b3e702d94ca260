"""Mixing sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources they belong to). A flow over patterns and sources routes word
capacity to source quotas; the n-th repetition of a pattern's words costs (n-1)^2 a word, so words are repeated only where fresh
ones run out. Each pattern and repetition then takes its flow from its documents in a seeded order: running sums over 4096 hash
buckets find the bucket in which the flow ends, and only the documents of that bucket are ranked.

Targets are worked out over a table with a row for each source, by two-level sums over ranges of the order in which sources stop.
Patterns and the sources they tie together fall into components, found in Spark; a component is a flow network of its own and is
solved in a task of its own, a source that shares no document with others being a network of one pattern. Neither patterns nor
documents reach the driver. A component is solved whole in its task, which holds a few hundred bytes a pattern: 50,000 random
patterns that all hang together take some 17 seconds.

Edge cases: a null text has size 0; null is a source of its own, last in order; a document of size 0 takes nothing; repeated rows
are rows of their own; a document without an id is seeded by its text; equal seeded keys are ordered by id and size; an empty table gives no rows. Column names of the input don't
matter beyond the named ones.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from ..operators.ranks import ranked
from .common import checkpointed, few
from .simhash_dedup import components

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)
COPIES = 2
SEED = 42
BUCKET_DIGITS = 3
#: Tables of patterns are broadcast up to this checked number of rows.
BROADCAST_PATTERNS = 100_000


def n_words(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded(id_col: str, text_col: str, seed: int = SEED) -> F.Column:
    """The key by which documents are ordered; those without an id by their text."""
    own = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    return F.md5(F.concat(own, F.lit(f":{seed}")).cast("binary"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: tuple = SHARE, most: int = COPIES) -> DataFrame:
    """(source, n, target, place) of (source, n): share[0]/share[1] of all words, by weights in code point order (null last); a
    target stops at ``most`` times its source's size and what it can't hold goes to the others by weight. ``place`` numbers the
    sources in the order in which they stop, in which they are filled; the first that doesn't stop has the level of all that follow.
    """
    named = ranked(sizes.select("source", "n"), [F.col("source").asc_nulls_last()], "by_name")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("by_name") - 1) % len(weights) + 1).cast("int"))
    weighted = named.select("source", "n", weight.alias("w"))
    placed = ranked(weighted, [most * F.col("n") / F.col("w"), F.col("source").asc_nulls_last()], "place", {"held": "n", "shut": "w"})
    total, open_ = placed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    room = (F.lit(share[0] * total).cast("long") - share[1] * most * F.col("held")).cast("double")
    levels = placed.withColumn("level", room / (share[1] * (F.lit(open_).cast("long") - F.col("shut"))).cast("double"))
    stop = levels.filter(F.col("level") * F.col("w") <= most * F.col("n")).agg(F.min(F.struct("place", "level")).alias("stop")).first().stop
    full = (most * F.col("n")).cast("double")
    target = full if stop is None else F.when(F.col("place") < stop.place, full).otherwise(F.lit(stop.level) * F.col("w"))
    return levels.select("source", "n", target.alias("target"), "place")


def min_cost_flow(capacity: dict, quota: dict, copies: int = COPIES) -> dict:
    """{pattern: [words of the first copy, the second, ...]} for patterns {frozenset of sources: words} and quotas by source.

    As many words as can be are routed, at the least cost of repetition. Only a pattern's own words cost, the more the more often
    they are repeated, so the cheapest paths are those of the least copy that is left: a greatest flow of fresh words (by level
    graphs), which one of second copies goes on with, and so on.
    """
    names = ["from", "to", *(("p", p) for p in capacity), *(("s", s) for s in quota)]
    number = {x: i for i, x in enumerate(names)}
    graph: list[list[int]] = [[] for _ in names]
    ends, room = [], []

    def edge(a: int, b: int, n: int) -> int:
        for x, y, r in ((a, b, n), (b, a, 0)):
            graph[x].append(len(ends))
            ends.append(y)
            room.append(r)
        return len(ends) - 2

    entry = {p: edge(0, number["p", p], 0) for p in capacity}
    for p in capacity:
        for s in p:
            edge(number["p", p], number["s", s], sum(quota.values()))
    for s, n in quota.items():
        edge(number["s", s], 1, n)

    def levels() -> list[int]:
        found, queue = [-1] * len(names), deque([0])
        found[0] = 0
        while queue:
            x = queue.popleft()
            for k in graph[x]:
                if room[k] and found[ends[k]] < 0:
                    found[ends[k]] = found[x] + 1
                    queue.append(ends[k])
        return found

    for _ in range(copies):
        for p, n in capacity.items():
            room[entry[p]] += n
        while (level := levels())[1] >= 0:
            at, path = [0] * len(names), []
            while True:
                x = ends[path[-1]] if path else 0
                if x == 1:
                    n = min(room[k] for k in path)
                    for k in path:
                        room[k] -= n
                        room[k ^ 1] += n
                    del path[next(i for i, k in enumerate(path) if not room[k]) :]
                    continue
                while at[x] < len(graph[x]) and not (room[graph[x][at[x]]] and level[ends[graph[x][at[x]]]] == level[x] + 1):
                    at[x] += 1
                if at[x] < len(graph[x]):
                    path.append(graph[x][at[x]])
                elif path:
                    path.pop()
                    at[ends[path[-1]] if path else 0] += 1
                else:
                    break
    taken = {p: room[k + 1] for p, k in entry.items()}
    return {p: [min(n, max(0, taken[p] - k * n)) for k in range(copies)] for p, n in capacity.items()}


def _pattern(source: str, kind: str, member_of: bool) -> F.Column:
    """The sources of a document, sorted; a document of none is one of the null source."""
    if not member_of:
        return F.col(source)
    some = F.when(F.size(source) > 0, F.col(source)).otherwise(F.array(F.lit(None).cast(kind[6:-1])))
    return F.array_sort(F.array_distinct(some))


def _rows(kind: DataType, rows: list[tuple]) -> pa.RecordBatch:
    pattern, level, flow = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(pattern, to_arrow_type(kind)), pa.array(level, pa.int32()), pa.array(flow, pa.int64())], names=["pattern", "level", "flow"])


def flows(nets: DataFrame, most: int = COPIES) -> DataFrame:
    """(pattern, level, flow) of nets (net, pattern, n, members): what ``min_cost_flow`` takes of each copy of a pattern's n words.

    members are (place, quota) of the pattern's sources. Patterns of one net are solved together, in one task; a row without a net is
    a network of its own and is solved where it stands. Rows of a net are sorted first, so that reruns agree."""
    kind = nets.schema["pattern"].dataType
    out = StructType([StructField("pattern", kind), StructField("level", IntegerType()), StructField("flow", LongType())])

    def solve(rows: list[tuple]) -> list[tuple]:
        places = [tuple(m["place"] for m in members) for _, _, members in rows]
        quota = {m["place"]: m["quota"] for _, _, members in rows for m in members}
        taken = min_cost_flow({p: n for p, (_, n, _) in zip(places, rows, strict=True)}, quota, most)
        return [(pattern, k, x) for p, (pattern, _, _) in zip(places, rows, strict=True) for k, x in enumerate(taken[p])]

    def alone(batches):
        for batch in batches:
            yield _rows(kind, [x for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in solve([row])])

    def together(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table[c].to_pylist() for c in ("pattern", "n", "members")), strict=True))
        return pa.Table.from_batches([_rows(kind, solve(sorted(rows, key=lambda r: [m["place"] for m in r[2]])))])

    own = nets.filter("net IS NULL").select("pattern", "n", "members").mapInArrow(alone, out)
    return own.unionByName(nets.filter("net IS NOT NULL").groupBy("net").applyInArrow(together, out))


def plan(sized: DataFrame, source: str = "source", size: str = "size", member_of: bool = False, **rules) -> tuple[DataFrame, DataFrame]:
    """(source, n, target, place) and (pattern, level, flow): the words of each copy. member_of: ``source`` is an array of sources."""
    most, kind = rules.get("most", COPIES), sized.schema[source].dataType.simpleString()
    patterns = checkpointed(sized.groupBy(_pattern(source, kind, member_of).alias("pattern")).agg(F.sum(size).alias("n")))
    sizes = patterns.select(F.explode("pattern").alias("source"), "n").groupBy("source").agg(F.sum("n").alias("n")) if member_of else patterns.withColumnRenamed("pattern", "source")
    goals = checkpointed(targets(sizes, **rules))
    member = F.struct("place", F.floor(F.col("target") + 0.5).cast("long").alias("quota"))
    if not member_of:
        return goals, flows(goals.select(F.lit(None).cast("long").alias("net"), F.col("source").alias("pattern"), "n", F.array(member).alias("members")), most)
    of = few(goals.select(F.col("source").alias("_of"), member.alias("member")), BROADCAST_PATTERNS)
    members = patterns.select("pattern", "n", F.explode("pattern").alias("_source")).join(of, F.expr("_source <=> _of"))
    nets = checkpointed(members.groupBy("pattern").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("member")).alias("members")))
    first = F.col("members")[0]["place"]
    ties = nets.select(first.alias("b"), F.explode(F.slice("members", 2, F.greatest(F.size("members") - 1, F.lit(0)))).alias("m"))
    roots = components(ties.select(F.col("m.place").alias("a"), "b").distinct())
    tied = checkpointed(roots.union(roots.select("root", "root")).toDF("_place", "net").distinct())
    return goals, flows(checkpointed(nets.join(few(tied, BROADCAST_PATTERNS), first == F.col("_place"), "left").select("net", "pattern", "n", "members")), most)


def edges_of(sized: DataFrame, levels: DataFrame, source: str, size: str, key: str, member_of: bool = False) -> DataFrame:
    """(pattern, levels): for each copy the words it takes and the bucket in which they end, with the words before that bucket."""
    pattern = _pattern(source, sized.schema[source].dataType.simpleString(), member_of)
    sums = sized.groupBy(pattern.alias("pattern"), F.substring(key, 1, BUCKET_DIGITS).alias("bucket")).agg(F.sum(size).alias("n"))
    before = F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("before", F.coalesce(before, F.lit(0))).alias("s")
    at = sums.join(levels.alias("l"), F.expr("s.pattern <=> l.pattern AND s.before < l.flow AND l.flow <= s.before + s.n"))
    return at.groupBy("l.pattern").agg(F.sort_array(F.collect_list(F.struct("l.level", "l.flow", "s.bucket", "s.before"))).alias("levels"))


def with_copies(docs: DataFrame, edges: DataFrame, source: str, key: str, size: F.Column, order: list[str], out: list[str], member_of: bool = False) -> DataFrame:
    """``out`` columns and ``copies`` of each document. edges has a row for each pattern at most; it is broadcast if they are few."""
    pattern = _pattern(source, docs.schema[source].dataType.simpleString(), member_of)
    marked = docs.withColumns({"_pattern": pattern, "_bucket": F.substring(key, 1, BUCKET_DIGITS)})
    marked = marked.join(few(edges.withColumnsRenamed({"pattern": "_of", "levels": "_levels"}), BROADCAST_PATTERNS), F.expr("_pattern <=> _of"), "left")
    is_edge = F.coalesce(F.exists("_levels", lambda x: x.bucket == F.col("_bucket")), F.lit(False))
    whole = F.coalesce(F.aggregate("_levels", F.lit(0), lambda n, x: n + (F.col("_bucket") < x.bucket).cast("int")), F.lit(0))
    inside = marked.filter(is_edge).withColumn("_size", size)
    inside = inside.withColumn("_before", F.coalesce(F.sum("_size").over(Window.partitionBy("_pattern", "_bucket").orderBy(key, *order, "_size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    part = F.aggregate("_levels", F.lit(0), lambda n, x: n + ((F.col("_bucket") < x.bucket) | ((F.col("_bucket") == x.bucket) & (2 * (x.flow - x.before - F.col("_before")) >= F.col("_size")))).cast("int"))
    return marked.filter(~is_edge).select(*out, whole.alias("copies")).unionByName(inside.select(*out, part.alias("copies")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    full = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source).alias("_source"), seeded(id_col, text_col, seed).alias("_key"))
    slim = checkpointed(full.select("_source", n_words("_text").alias("_size"), "_key"))
    edges = checkpointed(edges_of(slim, plan(slim, "_source", "_size")[1], "_source", "_size", "_key"))
    taken = with_copies(full, edges, "_source", "_key", n_words("_text"), ["_id"], ["_row"])
    return taken.filter("copies > 0").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")).select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    sized = checkpointed(docs.select("doc_id", "source", n_words("text").alias("size"), seeded("doc_id", "text").alias("key")))
    goals, levels = plan(sized)
    edges = checkpointed(edges_of(sized, levels, "source", "size", "key"))
    taken = with_copies(sized, edges, "source", "key", F.col("size"), ["doc_id"], ["doc_id", "source", "size"])
    goals = goals.select(F.col("source").alias("of"), F.col("n").alias("source_size"), "target")
    return taken.join(few(goals, BROADCAST_PATTERNS), F.expr("source <=> of")).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':42') AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS n,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, sum(n) OVER () AS total,
         coalesce(sum(n) OVER (ORDER BY 2 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY 2 * n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         row_number() OVER (ORDER BY 2 * n / w, source NULLS LAST) AS place
  FROM sources),
levels AS (SELECT *, (3 * total - 4 * held)::DOUBLE / (2 * open)::DOUBLE AS level FROM ranked),
goals AS (
  SELECT source, n, CASE WHEN place < (SELECT min(place) FROM levels WHERE level * w <= 2 * n) THEN (2 * n)::DOUBLE
                         ELSE (SELECT arg_min(level, place) FROM levels WHERE level * w <= 2 * n) * w END AS target
  FROM levels),
flows AS (
  SELECT *, least(floor(target + 0.5), n)::BIGINT AS f1, floor(target + 0.5)::BIGINT - least(floor(target + 0.5), n)::BIGINT AS f2 FROM goals),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized)
SELECT doc_id, size, n AS source_size, target,
       (size * ((f1 > 0 AND 2 * (f1 - before) >= size)::BIGINT + (f2 > 0 AND 2 * (f2 - before) >= size)::BIGINT))::BIGINT AS taken
FROM placed JOIN flows ON placed.source IS NOT DISTINCT FROM flows.source
"""
