"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tracecut.llm.common import check_names, field, map_columns, table

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: What looks random and is no secret, as a whole candidate or from seven characters on a part: identifiers with fixed dashes, alphabets, placeholders.
ALLOW = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|(?i:abcdefghijklmnop|0123456789abcdef|1234567890|example|placeholder|xxxxxxxx)|=+|-+|_+")
WINDOW = 20
#: Bits a character that a window must reach, by the class of its characters.
LIMITS = {"hex": 3.0, "mixed": 3.6, "letters": 4.1}
#: Bits less that suffice for a window beside one that reaches its limit: parts of a random string are less random by chance.
SLACK = 0.5
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def listed(s: str, allow: re.Pattern = ALLOW) -> list[tuple[int, int]]:
    """What the allow-list matches in s with seven characters or more; an alphabet goes on as far as each character follows the last."""
    out = []
    for m in allow.finditer(s):
        if len(m[0]) >= 7:
            end = m.end()
            while end < len(s) and ord(s[end]) == ord(s[end - 1]) + 1:
                end += 1
            out.append((m.start(), end))
    return out


def entropy_spans(s: str, allow: re.Pattern = ALLOW, taken: list[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
    """The random stretches of s that touch neither what is taken nor what the allow-list matches.

    A string that the allow-list matches as a whole has none.
    """
    if len(s) < WINDOW or allow.fullmatch(s):
        return []
    out, at = [], 0
    for a, b in [*sorted((taken or []) + listed(s, allow)), (len(s), len(s))]:
        if a - at >= WINDOW:
            out += [(at + x, at + y) for x, y in random_stretches(s[at:a])]
        at = max(at, b)
    return out


def random_stretches(s: str) -> list[tuple[int, int]]:
    """Unions of overlapping windows of s whose entropy reaches the limit of their class but for SLACK, if one of them reaches it.

    Counts of characters, of digits, and of hexadecimal letters of each case move by one character in
    and one out. A window without digits is `letters`, one of [0-9a-f] or of [0-9A-F] only `hex`, any
    other `mixed`.
    """
    counts: dict[str, int] = {}
    terms, digits, lower, upper, out = 0.0, 0, 0, 0, []
    sure: list[bool] = []
    for i, c in enumerate(s):
        k = counts.get(c, 0)
        terms += _TERM[k + 1] - _TERM[k]
        counts[c] = k + 1
        digits += "0" <= c <= "9"
        lower += "a" <= c <= "f"
        upper += "A" <= c <= "F"
        if i >= WINDOW:
            c = s[i - WINDOW]
            k = counts[c]
            terms += _TERM[k - 1] - _TERM[k]
            counts[c] = k - 1
            digits -= "0" <= c <= "9"
            lower -= "a" <= c <= "f"
            upper -= "A" <= c <= "F"
        if i >= WINDOW - 1:
            over = math.log2(WINDOW) - terms / WINDOW - LIMITS["hex" if digits and digits + max(lower, upper) == WINDOW else "mixed" if digits >= 2 else "letters"]
            if over >= -SLACK:
                start = i - WINDOW + 1
                if out and start < out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                    sure[-1] |= over >= 0
                else:
                    out.append((start, i + 1))
                    sure.append(over >= 0)
    return [span for span, yes in zip(out, sure, strict=True) if yes]


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """All spans of a text as (start, order of the kind, end), sorted. Null and empty texts have none."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    at = 0
    long = []
    for w in text.split():
        if len(w) >= WINDOW:  # what the other patterns match holds no white space
            at = text.find(w, at)
            found += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(w)]
            found += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(w)]
            long.append((at, w))
            at += len(w)
    base: list[tuple[int, int]] = []
    for a, _, b in sorted(found):
        if base and a < base[-1][1]:
            base[-1] = (base[-1][0], max(base[-1][1], b))
        else:
            base.append((a, b))
    ends = [b for _, b in base]
    for at, w in long:
        for m in CANDIDATE.finditer(w):
            start, end = at + m.start(), at + m.end()
            taken = []
            for i in range(bisect_right(ends, start), len(base)):
                if base[i][0] >= end:
                    break
                taken.append((max(base[i][0] - start, 0), min(base[i][1], end) - start))
            found += [(start + a, 3, start + b) for a, b in entropy_spans(m[0], taken=taken)]
    return sorted(found)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: its key, and spans array<struct<kind,start,end>> in code points, end exclusive.

    Null and empty texts have no spans; null keys and repeated rows are kept as they are; an empty
    table gives an empty one. Texts of any length are scanned whole, in linear time.
    """
    check_names(key, ["spans"])
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([field(docs, key), T.StructField("spans", T.ArrayType(span))])

    def make() -> Callable:
        return lambda keys, texts: (keys, [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t)] for t in texts])

    return map_columns(docs.select(key, text), make, schema)


def digests(docs: DataFrame) -> DataFrame:
    """The columns of op6, from the same scan: counts by kind, the base spans' hash, and all spans as text.

    Null and empty texts have no spans, and the hash of nothing; null keys and repeated rows have a row
    each; an empty table gives an empty one.
    """
    schema = T.StructType([field(docs, "doc_id")] + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def make() -> Callable:
        def step(keys, texts):
            all_spans = [scan(t) for t in texts]
            counts = [[sum(k == i for _, k, _ in s) for s in all_spans] for i in range(4)]
            base = [hashlib.sha256(joined([x for x in s if x[1] < 3]).encode()).hexdigest() for s in all_spans]
            return (keys, *counts, base, [joined(s) for s in all_spans])

        return step

    return map_columns(docs.select("doc_id", "text"), make, schema)


def redacted(docs: DataFrame, key_columns: list[str], text: str = "text") -> DataFrame:
    """docs with every span of `text` replaced by [kind]; overlapping spans count as one, under the first's kind. n_chars, if there, is the new length.

    Null and empty texts stay as they are, and so does n_chars of a text without spans; repeated rows and
    null keys are kept; an empty table gives an empty one.
    """

    def make() -> Callable:
        def clean(t):
            spans = scan(t)
            if not spans:
                return t
            out, at = [], 0
            for a, k, b in spans:
                if a >= at:
                    out += [t[at:a], f"[{KINDS[k]}]"]
                at = max(at, b)
            return "".join(out) + t[at:]

        i = key_columns.index(text)
        n = key_columns.index("n_chars") if "n_chars" in key_columns else None

        def step(*columns):
            out = list(columns)
            out[i] = [clean(t) for t in columns[i]]
            if n is not None:
                out[n] = [old if a == b else len(b) for old, a, b in zip(columns[n], columns[i], out[i], strict=True)]
            return tuple(out)

        return step

    picked = docs.select(*key_columns)
    return map_columns(picked, make, T.StructType(picked.schema.fields))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
