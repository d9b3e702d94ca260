r"""Chat formatting by schema fingerprints, in DataFrame expressions only.

A record's layout is the set of nested field paths that hold a value in it. The paths that any layout uses are hashed in a fixed
order; the hash picks a declarative mapping from ``LAYOUTS``, whose expression makes the record's canonical turns (place, role,
text). Layouts may be mixed row by row in one wide table. Fields that no layout names are left out of the fingerprint, so extra
columns change nothing; a record whose fingerprint is unknown gets no turns, an empty text and a null layout.

The template writes each turn as ``<|turn|>role\ntext<|end|>``. Control strings inside roles and texts (``<|``, ``<s>``,
``</s>``, ``[INST]``, ``<<SYS>>`` and the like) get a backslash after their first character, one more if they have some
already, so that the text can be had back exactly and never holds a control string.

Edge cases: a null text or role is empty; equal turn numbers are ordered by role and text; repeated rows are turns of their own;
rows without a conversation id form one conversation; an empty table gives no rows. One conversation's turns meet in one row, as
its one text demands.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<place:bigint,role:string,text:string>>"
#: Control strings of common chat templates, after their first character.
CONTROL = r"\||/?s>|/?INST\]|</?SYS>>"
START, END, BREAK = "<|turn|>", "<|end|>", "<|nl|>"

#: Field paths by layout: (needed, may be missing, roles and their paths in order | the array, its role and text fields).
LAYOUTS = {
    "turn_rows": (("role",), ("text", "turn"), "row"),
    "turn_rows_without_role": (("turn",), ("text",), "row"),
    "turn_text": (("text",), (), "row"),
    "prompt_completion": (("prompt",), ("completion", "system"), (("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    "prompt_response": (("prompt", "response"), ("system",), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    "instruction": (("instruction",), ("input", "output", "system"), (("system", "system"), ("user", ("instruction", "input")), ("assistant", "output"))),
    "instruction_response": (("instruction", "response"), ("context", "system"), (("system", "system"), ("user", ("instruction", "context")), ("assistant", "response"))),
    "question_answer": (("question",), ("answer", "system"), (("system", "system"), ("user", "question"), ("assistant", "answer"))),
    "messages": (("messages[].content",), ("messages[].role",), ("messages", "role", "content")),
    "share": (("conversations[].value",), ("conversations[].from",), ("conversations", "from", "value")),
}
#: Names of the roles in other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
PATHS = sorted({p for needed, maybe, _ in LAYOUTS.values() for p in (*needed, *maybe)})


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema, arrays marked by []."""
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    if not isinstance(kind, T.StructType):
        return [prefix]
    return [p for f in kind for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]


def _present(path: str) -> Column:
    if "[]." not in path:
        return F.col(f"`{path}`").isNotNull()
    top, field = path.split("[].")
    return F.coalesce(F.exists(f"`{top}`", lambda x: x[field].isNotNull()), F.lit(False))


def _hash_of(paths: set[str]) -> Column:
    return F.xxhash64(F.lit(",".join(p for p in PATHS if p in paths)))


def fingerprint(df: DataFrame) -> Column:
    """Hash of the known field paths that hold a value in the record."""
    there = set(field_paths(df.schema))
    return F.xxhash64(F.concat_ws(",", *(F.when(_present(p), F.lit(p)) for p in PATHS if p in there)))


def _turns(rule, there: set[str]) -> Column:
    read = lambda p: F.col(f"`{p}`").cast("string") if p in there else F.lit(None).cast("string")
    if rule == "row":
        return F.array(F.struct(read("turn").cast("bigint").alias("place"), F.coalesce(read("role"), F.lit("")).alias("role"), F.coalesce(read("text"), F.lit("")).alias("text")))
    if isinstance(rule[0], str):
        top, role, text = rule
        of = lambda x: x[role].cast("string") if f"{top}[].{role}" in there else F.lit("")
        named = lambda r: F.coalesce(*(F.when(r == a, F.lit(b)) for a, b in ROLES.items()), r, F.lit(""))
        return F.transform(top, lambda x, i: F.struct(i.cast("bigint").alias("place"), named(of(x)).alias("role"), F.coalesce(x[text].cast("string"), F.lit("")).alias("text")))
    parts = [(role, [paths] if isinstance(paths, str) else list(paths)) for role, paths in rule]
    return F.filter(F.array(*(F.struct(F.lit(i).cast("bigint").alias("place"), F.lit(role).alias("role"), F.concat_ws("\n", *map(read, paths)).alias("text"), F.coalesce(*map(read, paths)).isNotNull().alias("there")) for i, (role, paths) in enumerate(parts))), lambda x: x.there)


def canonical(df: DataFrame) -> DataFrame:
    """df with ``layout`` and ``turns``."""
    there, hashed, name, turns = set(field_paths(df.schema)), F.col("_fingerprint"), F.lit(None).cast("string"), F.array().cast(TURNS)
    for layout, (needed, maybe, rule) in LAYOUTS.items():
        if set(needed) <= there:
            made = F.transform(_turns(rule, there), lambda x: F.struct(x.place.alias("place"), x.role.alias("role"), x.text.alias("text")))
            is_it = hashed.isin(*(_hash_of({*needed, *some}) for n in range(len(maybe) + 1) for some in combinations(maybe, n) if set(some) <= there)) if there else F.lit(False)
            name, turns = F.when(is_it, F.lit(layout)).otherwise(name), F.when(is_it, made).otherwise(turns)
    return df.withColumn("_fingerprint", fingerprint(df)).withColumns({"layout": name, "turns": turns}).drop("_fingerprint")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")


def written(turn: Column) -> Column:
    return F.concat(F.lit(START), F.replace(escape(turn.role), F.lit("\n"), F.lit(BREAK)), F.lit("\n"), escape(turn.text), F.lit(END))


def formatted(df: DataFrame, id_col: str = "conv_id", loss_role: str = "assistant") -> DataFrame:
    """(id, formatted, loss): a conversation's text, and for each of its turns the characters of the text that are learnt
    (start in code points within the turn's piece, length; null for turns that aren't)."""
    turns = canonical(df).select(id_col, F.explode_outer("turns").alias("t"))
    whole = turns.groupBy(id_col).agg(F.sort_array(F.collect_list("t")).alias("t"))
    learnt = lambda x: F.when(x.role == loss_role, F.struct((F.length(F.lit(START)) + F.length(F.replace(escape(x.role), F.lit("\n"), F.lit(BREAK))) + 1).alias("start"), F.length(escape(x.text)).alias("length")))
    return whole.select(id_col, F.array_join(F.transform("t", written), "").alias("formatted"), F.transform("t", learnt).alias("loss"))


def read_back(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turns, learnt, formatted): turns and the learnt texts, from the formatted text and its loss mask alone."""
    pieces = F.split("formatted", r"<\|end\|>")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    role = lambda x: unescape(F.replace(F.substring(F.substring_index(x, "\n", 1), len(START) + 1, 1 << 30), F.lit(BREAK), F.lit("\n")))
    body = lambda x: unescape(x.substr(F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x)))
    found = df.select(id_col, "formatted", "loss", pieces.alias("pieces"))
    return found.select(
        id_col,
        "formatted",
        F.transform("pieces", lambda x: F.struct(role(x).alias("role"), body(x).alias("text"))).alias("turns"),
        F.transform(F.filter(F.arrays_zip("pieces", "loss"), lambda x: x.loss.isNotNull()), lambda x: unescape(x.pieces.substr(x.loss.start + 1, x.loss.length))).alias("learnt"),
    )


def query(conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = conversations.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).unionByName(more)
    back = read_back(formatted(rows)).select("conv_id", F.size("turns").cast("long").alias("n_turns"), "turns", F.array_join("learnt", "").alias("learnt"), F.length("formatted").cast("long").alias("formatted_chars"))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS r,
         regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS t FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|>') + length(replace(r, chr(10), '<|nl|>')) + 1 + length(t) + length('<|end|>'))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
