"""Secret scans: fixed patterns, and strings in sensitive contexts that zstandard can't predict.

The fixed patterns report assignments, access keys and hex runs. Beyond them, each value that is given to a sensitive name is a
candidate, and each long string after a sensitive word, over line ends too. A compressor primed with a dictionary of identifiers
compresses the text around the candidate without and with it; the bytes it adds are its novelty. Words, identifiers and what the text
says elsewhere cost little; random keys don't, and are reported. The further from the word, the more bytes a candidate must add,
and one of letters alone, as words are, must add more for each. All candidates are measured, those inside a fixed pattern's span
too, and the incompressible ones are reported beside it. Names, values and candidates are each read once, so time is linear.

Edge cases: a null text is empty and has no spans; repeated rows are rows of their own; a null id is carried; whole texts are
searched whatever their length; an empty table gives no rows. Only the two named columns are read. Spans are in code points, the
end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS, map_rows, release, trim

KINDS = ("assign", "access", "hex", "novel")
#: Fixed patterns; letters of the words in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
HEX_ONLY = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))

#: Sensitive words, as words, parts of names joined by _ or -, or parts of camelCase names, but not redact()'s own mark. Each has one of the stems of the quick test.
STEMS = ("pass", "pwd", "secret", "token", "auth", "bearer", "credential", "signature", "key")
STRONG = r"pass(?:word|wd|phrase)?|pwd|secret|token|bearer|credential|(?:api|access|private|client|account|shared|secret)[-_\x20]?key"
SENSITIVE = re.compile(rf"(?!(?-i:(?<=\[)SECRET\]))(?:(?<![A-Za-z])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:(?P<strong>{STRONG})|auth(?:orization)?|signature|key)s?(?:(?![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z])))", re.I | re.A)
#: What follows a name that is given a value, and the value.
NAME = re.compile(r"[\w-]*+", re.A)
GIVEN = re.compile(r"""["'\])]*+[\x20\t]*+(?P<by>=>|:=|[:=])[\x20\t]*+(?:\r?\n[\x20\t]*+)?(?P<quote>["'`]?)(?P<value>[A-Za-z0-9+/_.=~!@#$%^&*?-]*[A-Za-z0-9+/_=~!@#$%^&*?-])(?![\w(\[])""", re.A)
#: A key, and whole lines of key letters after one of a line's length, as in PEM files.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.~-]{16,}(?:(?<=[A-Za-z0-9+/]{40})(?:\r?\n[\x20\t]*[A-Za-z0-9+/]+(?=={0,2}[\x20\t]*(?:\r?\n|\Z)))+)?(?:={1,2}(?![A-Za-z0-9\"']))?")
AROUND = 240
#: Bytes that each character must add: of a quoted value of a name, of letters alone, of other strings; and all of a candidate: the
#: more, the further it is from a sensitive word.
QUOTED, LETTERS, NOVELTY, LEAST, FURTHER = 0.6, 0.9, 0.75, 6, 16
#: Text from which the compressor takes how often letters occur, where there is little around a candidate.
PLAIN = """It was late in the year when the first of them came down to the river, and nobody in the small town knew who they were or
what they wanted there. Some said that they had walked for more than a week; others were sure of having seen a light on the hill. """.encode()
#: What the compressor knows beforehand: identifiers of code and configuration.
IDENTIFIERS = """
password passwd secret token api_key apikey access_key private_key client_secret client_id authorization bearer credential
username user_name email host hostname port database db_name connection_string endpoint region bucket config settings
environment production development staging example placeholder changeme your_token_here null None undefined true false
import from return function const let var class public static void string int self this print format config.yaml
application/json content-type user-agent http https www.example.com localhost 127.0.0.1 abcdefghijklmnopqrstuvwxyz
ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 1234567890
""".encode()


@cache
def _compressor():
    import zstandard

    level = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=False, write_checksum=False, write_dict_id=False)
    known = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=level)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=level)


def novelty(candidate: str, around: str) -> float:
    """Compressed bytes that each character of the candidate adds to the text around it."""
    squeeze, text = _compressor().compress, PLAIN + around.encode() + b" "
    return (len(squeeze(text + candidate.encode())) - len(squeeze(text))) / len(candidate)


def candidates(text: str) -> list[tuple[int, int, int, float]]:
    """(start, end, distance from the sensitive word, bytes that each character must add)."""
    ends, tests, name_end, value_end, given = [], {}, 0, 0, None
    for m in SENSITIVE.finditer(text):
        ends.append(m.end())
        if m.start() < value_end:
            continue
        if m.end() > name_end:  # else another word of the same name
            name_end = NAME.match(text, m.end()).end()
            given = GIVEN.match(text, name_end)
            value_end = given.end("value") if given else 0
        if given and (not m["strong"] or given["by"] != ":" or given["quote"] or not given["value"].isalpha()):
            tests[given.span("value")] = 0, QUOTED if given["quote"] and m["strong"] else NOVELTY
    for c in CANDIDATE.finditer(text, ends[0]) if ends else ():
        if not (c.end() < len(text) and text[c.end()] == "="):  # a name
            tests.setdefault(c.span(), (c.start() - ends[bisect_right(ends, c.start()) - 1], LETTERS if c[0].isalpha() else NOVELTY))
    return [(*span, *rest) for span, rest in sorted(tests.items())]


def measured(text: str) -> list[tuple[int, int, float, bool]]:
    """(start, end, novelty, whether it is a secret) of each candidate."""
    out = []
    for a, b, far, most in candidates(text):
        # A key that is written twice must not be predicted by its own copy.
        s = text[a:b]
        each = novelty(s, (text[max(0, a - AROUND) : a] + " " + text[b : b + AROUND]).replace(s, " "))
        out.append((a, b, each, each >= most and each * len(s) >= LEAST + far / FURTHER))
    return out


def scanned(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, float, bool]]]:
    """((start, end, kind) of all secrets, by start and kind as listed; what was measured)."""
    text = text or ""
    low, found, tests = text.lower(), [], []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    if b"h" * 24 in text.encode().translate(HEX_ONLY):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if any(w in low for w in STEMS):
        tests = measured(text)
        found += [(a, b, "novel") for a, b, _, secret in tests if secret]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]))), tests


def spans(text: str | None) -> list[tuple[int, int, str]]:
    return scanned(text)[0]


def redact(text: str | None, by: str = "[SECRET]") -> str | None:
    """The text with each span, or run of overlapping spans, replaced."""
    found = spans(text)
    if not found:
        return text
    out, at = [], 0
    for a, b, _ in found:
        if a >= at:
            out += [text[at:a], by]
        at = max(at, b)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans: array of start, end, kind; measured: array of start, end, novelty in bytes a character)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def one(_, i, text):
        found, tests = scanned(text)
        return i, [{"start": a, "end": b, "kind": k} for a, b, k in found], [{"start": a, "end": b, "novelty": each} for a, b, each, _ in tests]

    return map_rows(docs, [id_col, text_col], f"`{id_col}` {kind}, spans array<struct<start:long,end:long,kind:string>>, measured array<struct<start:long,end:long,novelty:double>>", one)


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The table with its secrets replaced in the text column."""
    def run(batches):
        import pyarrow as pa

        release()
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            k = batch.schema.get_field_index(text_col)
            yield batch.set_column(k, batch.schema.field(k), pa.array(map(redact, batch.column(k).to_pylist()), batch.schema.field(k).type))
        trim()

    return docs.mapInArrow(run, docs.schema)


def query(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x.kind == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(joined(F.filter("spans", lambda x: x.kind != "novel")), 256).alias("base_sha256"), joined("spans").alias("spans"), count("novel"), F.size("measured").cast("long").alias("n_measured"), F.array_max("measured.novelty").alias("novelty_max"))


def brute_base(text: str | None) -> str:
    """The fixed patterns as they are stated, for tests."""
    found = []
    for k, (kind, pattern, least) in enumerate((("assign", ASSIGN, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 20), ("hex", re.compile("[0-9a-f]+"), 24))):
        found += [(m.start(), k, m.end(), kind) for m in pattern.finditer(text or "") if len(m[2] if kind == "assign" else m[0]) >= least]
    return sha256(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)).encode()).hexdigest()
