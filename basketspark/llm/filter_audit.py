"""Filter interaction audit: what each filter of a chain removes, in every order, and its Shapley value from potentials.

Each document has a set of filters that it fails; documents are counted by part and set, so all that follows works on at most 2^k
counts a part (k filters). v(S), the removal game, is the number of documents that fail a filter of the coalition S. The potential of
Hart and Mas-Colell is worked out recursively over the coalitions: P(empty) = 0 and P(S) = (v(S) + sum of P(S - i)) / |S|. A filter's
Shapley value is P(all) - P(all but it). Multiplied by the number of orders, k!, all of these are whole numbers. A step of an order
is a difference of coalitions: what i removes after S is v(S + i) - v(S), and the same for labelled documents.

Documents' texts never travel: they are turned into failures and a SHA-256 digest where they are read. Copies are told by digest:
rows are summed by (digest, part, labels), so that thousands of copies are one row each for a part before the least id of a digest is
looked up. An id, a text, a part or a missing id may hold a third of all rows.

Edge cases: a null text is empty (and fails A, as it has no words); a null source is the part ``''``; a row without an id has no
labels, never fails E and makes no other row fail it; repeated rows count each, and rows of equal id and text don't make each other
fail E; labels of one id are united (toxic or good if any row says so); an empty table gives no rows; only the named columns are
read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"
#: The last filter: copies of a text with a smaller id.
FILTERS = "ABCDE"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Counts by part and set of failed filters.
COUNTS = ("n", "good", "toxic")


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, digest, failed): ``failed`` has bit 0 for A to bit 3 for D."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = texts.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    upper = F.length("text") - F.length(F.translate("text", UPPER, ""))
    fails = [F.size("words") < 50, 100 * F.size(F.array_distinct("words")) < 65 * F.size("words"), 100 * upper.cast("long") > 5 * F.length("text").cast("long"), F.col("text").rlike(r"[#$%&*|]")]
    return words.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).alias("failed"))


def with_labels(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, part, digest, failed, good, toxic, n): equal rows summed. Rows without an id are spread by digest; they meet no label."""
    rows = failed.groupBy("id", "part", "digest", "failed").agg(F.count("*").alias("n"))
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("of")).agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    known = known.filter("good OR toxic").withColumn("away", F.lit(None).cast("binary"))
    joined = rows.withColumn("apart", F.when(F.col("id").isNull(), F.col("digest"))).join(known, (F.col("id").eqNullSafe(F.col("of"))) & (F.col("apart").eqNullSafe(F.col("away"))), "left")
    return joined.select("id", "part", "digest", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")


def by_failures(rows: DataFrame, bit: int = 1 << 4) -> DataFrame:
    """(part, failed, n, good, toxic): documents by the set of filters that they fail, copies of smaller ids included as ``bit``."""
    named = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    # An id may stand in several rows of a text (in several parts); equal ids within a group are one row already.
    same = rows.groupBy("digest", "part", "failed", "good", "toxic").agg(F.sum("n").alias("n"), F.min(named).alias("first"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    least = F.min("first.id").over(Window.partitionBy("digest"))
    kept = F.col("nameless") + F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0)
    split = same.withColumn("kept", kept).select("part", "good", "toxic", F.explode(F.array(F.struct("failed", F.col("kept").alias("n")), F.struct((F.col("failed") + bit).alias("failed"), (F.col("n") - F.col("kept")).alias("n")))).alias("x"))
    return split.groupBy("part", "x.failed").agg(F.sum("x.n").alias("n"), *(F.sum(F.when(F.col(c), F.col("x.n")).otherwise(0)).alias(c) for c in COUNTS[1:]))


def _removed(count: str, coalitions: int) -> Column:
    """Array of v(S) by coalition: documents that fail a filter of S."""
    return F.transform(F.sequence(F.lit(0), F.lit(coalitions - 1)), lambda s: F.aggregate("sets", F.lit(0).cast("long"), lambda n, x: n + F.when(x.failed.bitwiseAND(s) != 0, x[count]).otherwise(0)))


def potentials(v: str, filters: int) -> Column:
    """Array of k! * P(S) by coalition. A coalition without a filter has a smaller number, so it is there when it is needed."""
    orders = factorial(filters)

    def add(p: Column, s: Column) -> Column:
        smaller = sum((F.when(s.bitwiseAND(1 << i) != 0, F.get(p, s.bitwiseXOR(F.lit(1 << i)))).otherwise(0) for i in range(filters)), F.lit(0).cast("long"))
        whole = orders * F.get(v, s) + smaller
        return F.concat(p, F.array(F.call_function("div", whole, F.bit_count(s))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")), add)


def audit(sets: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order of the filters and step, from (part, failed, n, good, toxic)."""
    k = len(filters)
    every, bit = (1 << k) - 1, {f: 1 << i for i, f in enumerate(filters)}
    parts = sets.groupBy("part").agg(F.collect_list(F.struct("failed", *COUNTS)).alias("sets"), F.sum("n").alias("total"))
    games = parts.select("part", "total", "sets", *(_removed(c, 1 << k).alias(f"v_{c}") for c in COUNTS)).withColumn("p", potentials("v_n", k))
    steps = [(order, i + 1, sum(bit[f] for f in order[:i]), bit[order[i]]) for order in map("".join, permutations(filters)) for i in range(k)]
    steps = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","k":{n},"s":{s},"i":{i}}}' for o, n, s, i in steps) + "]"), "array<struct<o:string,k:int,s:int,i:int>>")
    rows = games.select("*", F.explode(steps).alias("x"))
    before, own = F.col("x.s"), F.col("x.i")
    both = before.bitwiseOR(own)
    gain = lambda c: F.get(f"v_{c}", both) - F.get(f"v_{c}", before)
    return rows.select(
        "part",
        F.col("x.o").alias("filter_order"),
        F.col("x.k").alias("step"),
        (F.col("total") - F.get("v_n", both)).alias("kept"),
        gain("n").alias("removed"),
        (F.get("v_n", own) - gain("n")).alias("redundant"),
        (F.get("v_n", F.lit(every)) - F.get("v_n", own.bitwiseXOR(F.lit(every)))).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        (F.get("p", F.lit(every)) - F.get("p", own.bitwiseXOR(F.lit(every)))).alias("shapley"),
    )


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(by_failures(with_labels(failures(docs), labels)))


ORACLE_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(words) < 50 AS A, 100 * len(list_distinct(words)) < 65 * len(words) AS B,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS C, regexp_matches(text, '[#$%&*|]') AS D,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS E
  FROM texts LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f) AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)),
sets AS (
  SELECT part, (CASE WHEN A THEN 'A' ELSE '' END || CASE WHEN B THEN 'B' ELSE '' END || CASE WHEN C THEN 'C' ELSE '' END || CASE WHEN D THEN 'D' ELSE '' END || CASE WHEN E THEN 'E' ELSE '' END) AS failed,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL),
steps AS (SELECT filter_order, k.step, filter_order[k.step] AS f, filter_order[1:k.step - 1] AS earlier FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) k),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(failed, f) AS fails, failed = f AS alone,
         len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) > 0 AND earlier <> '' AND failed <> '' AS gone
  FROM sets, steps),
counted AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (NOT gone AND fails) AS removed, sum(n) FILTER (gone AND fails) AS redundant,
         sum(n) FILTER (alone) AS unique_fails, sum(good) FILTER (NOT gone AND fails) AS good_lost, sum(toxic) FILTER (NOT gone AND fails) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
