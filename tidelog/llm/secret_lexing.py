"""Operator 13: secrets by assignment-aware lexing.

Base spans are the matches of three patterns (``BASE``).  Beyond them the
texts are read as source code and configuration: assignments, keyword
arguments, mapping entries, markup elements and attributes, name and value
given to a call, command flags and credentials in addresses each give a
binding of a name to an expression of literals, names and calls.

Constants are propagated: the value of an expression is the value of its
literals and of the names in it as bound before (or once, later).  A binding
is sensitive if its name (``NAMES``) and its folded value (length, distinct
and mixed characters) score ``THRESHOLD`` together; all literals that flow
into it are then secrets, wherever they stand and whatever they are named.
Place holders never are, nor the first argument of a call that looks a value
up.  A literal within a base span isn't reported again.

A text is read once by patterns that don't go back, and every binding is
visited once, so that time and memory grow with the text.  There is no
shuffle: a hot source or repeated texts are rows like others.

Defined cases: a null or empty text has no spans; repeated rows are each
returned; very long texts are read whole, by one task each; an empty table
gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import table

KINDS = ("assign", "access", "hex", "literal")
SPANS = "array<struct<kind:string,start:long,end:long,name:string>>"

# The base patterns, and the least length of what they match.
#: Read over bytes whose letters A-Z are in lower case.
ASSIGN = re.compile(
    rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Runs of HEX that are long enough; it matches what HEX does where it is that long.
LONG_HEX = re.compile(rb"[0-9a-f]{%d,}" % LEAST["hex"])

# How sensitive a word of a name is, and last words that speak against it.
NAMES = {
    "password": 5, "passwd": 5, "pwd": 5, "passphrase": 5, "passcode": 5, "secret": 5, "apikey": 5,
    "credential": 4, "credentials": 4, "token": 4, "bearer": 4, "privatekey": 5, "accesskey": 5,
    "pass": 3, "auth": 3, "authorization": 3, "cookie": 2, "key": 1, "salt": 2, "signature": 2, "dsn": 2,
}
KEY_BEFORE = {"api", "access", "private", "secret", "signing", "encryption", "master", "auth", "account"}
AGAINST = {
    "file", "path", "dir", "url", "uri", "name", "id", "type", "field", "label", "hint", "prompt", "regex",
    "pattern", "length", "len", "count", "size", "max", "min", "ttl", "expiry", "expires", "policy", "reset",
    "header", "prefix", "suffix", "public", "column", "index", "version", "format", "limit", "enabled",
}
PLACEHOLDER = re.compile(
    rb"(?i)(?:.*(?:change_?me|placeholder|example|your[_-]|dummy|redacted).*|<.*>|\{\{.*\}\}|%\w|(.)\1*"
    rb"|none|null|true|false|undefined|test|todo|string|password|secret|token|x{3,}.*|\*{3,}.*)\Z",
    re.DOTALL,
)
LOOKUPS = {b"get", b"getenv", b"environ", b"env", b"config", b"lookup", b"fetch", b"getproperty", b"getstring"}
THRESHOLD, SHORTEST = 5, 6

OPERATOR = re.compile(rb"(?<![=!<>:*/%&|^~-])(?:=>|:=|\+=|=(?![=>~])|:(?![:/=]))")
NAME = rb"[A-Za-z_$][A-Za-z0-9_$]*(?:(?:\.|->)[A-Za-z_$][A-Za-z0-9_$]*)*"
TOKEN = re.compile(
    rb"""(?P<space>(?:[ \t]|\\\r?\n)+)"""
    rb"""|[rRbBfFuU@]{0,2}(?:\"{3}(?P<long2>[^"\\]*(?:(?:\\.|"(?!""))[^"\\]*)*)\"{3}"""
    rb"""|'{3}(?P<long1>[^'\\]*(?:(?:\\.|'(?!''))[^'\\]*)*)'{3}"""
    rb"""|"(?P<double>[^"\\\n]*(?:\\.[^"\\\n]*)*)"|'(?P<single>[^'\\\n]*(?:\\.[^'\\\n]*)*)'|`(?P<back>[^`\\]*)`)"""
    rb"""|\$\{?(?P<shell>[A-Za-z_]\w*)\}?|(?P<name>""" + NAME + rb""")|(?P<join>\.\.?|\+)"""
    rb"""|(?P<open>[(\[])|(?P<close>[)\]])|(?P<comma>,\s*)""",
    re.DOTALL,
)
BARE = re.compile(rb"""[^\s,;'"`<>(){}\[\]=:#&|$]+={0,2}(?=[\s,;}\])"'<&]|\Z)""")
#: A word without quotes that is all that stands right of an operator, and what may stand left of its name.
WORD = re.compile(rb"[ \t]*([A-Za-z_]*[0-9]\w*)(?=[ \t]*(?:#|\r?\n|\Z))")
LINE_START = re.compile(rb"[ \t]*(?:export[ \t]+|set[ \t]+|-[ \t]+)?[\"']?\Z")
SCHEME = re.compile(rb"(?i)(?:bearer|basic|token)[ \t]+")
INSERTED = re.compile(rb"\$?\{([A-Za-z_][\w.]*)\}")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
QUOTED = rb"""(?:"([^"\\\n]*)"|'([^'\\\n]*)')"""
#: Names and literals in other forms: a pattern, a sign of it that is quicker to look for.
PAIRS = (
    (b"</", re.compile(rb"<([A-Za-z_][\w.:-]*)>([^<>\n]+)</")),
    (b"value", re.compile(rb"\b(?:key|name)\s*=\s*" + QUOTED + rb"\s+value\s*=\s*" + QUOTED)),
    (b"(", re.compile(rb"\(\s*" + QUOTED + rb"\s*,\s*" + QUOTED + rb"\s*\)")),
    (b"--", re.compile(rb"(?<![\w-])--([A-Za-z][\w-]*)[ \t]+([^\s'\"$<>-][^\s'\"]*)")),
    (b"ENV ", re.compile(rb"(?m)^ENV[ \t]+([A-Za-z_]\w*)[ \t]+([^\s=]+)$")),
)
ADDRESS = re.compile(rb"://[^\s:/@\"']+:([^\s/@\"':]+)@")

NAME_BYTES = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")
QUOTES, BLANKS = frozenset(b"\"'`"), frozenset(b" \t")


def _mask(chars: bytes) -> int:
    out = 0
    for c in set(chars):
        out |= 1 << c
    return out


LOWER_MASK, UPPER_MASK = _mask(b"abcdefghijklmnopqrstuvwxyz"), _mask(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT_MASK, BLANK_MASK = _mask(b"0123456789"), _mask(b" \t\r\n")
#: A literal with these is a path, an address or prose rather than a secret.
PATH = re.compile(rb"(?:[a-z]+://|\.{0,2}/)[\w./-]*\Z|[a-z]+(?:[._-][a-z]+)+\Z")


def base_spans(raw: bytes) -> list[tuple[str, int, int]]:
    out = [
        ("assign", m.start(), m.end())
        for m in ASSIGN.finditer(raw.lower())
        if m.end(1) - m.start(1) >= LEAST["assign"]
    ]
    out += [("access", *m.span()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", *m.span()) for m in LONG_HEX.finditer(raw)]
    return out


# ------------------------------------------------------------ bindings


def name_score(name: bytes) -> int:
    words = [w.lower() for w in WORDS.findall(name.decode("ascii", "replace"))]
    if not words:
        return 0
    score = max(NAMES.get(w, 0) for w in words)
    for a, b in zip(words, words[1:]):
        if b == "key" and a in KEY_BEFORE:
            score = 5
    return score - 4 if words[-1] in AGAINST or "public" in words else score


def value_score(length: int, mask: int) -> int:
    """Points for a folded value's length and the set of its bytes."""
    if length < SHORTEST:
        return -10
    distinct = mask.bit_count()
    classes = sum(1 for m in (LOWER_MASK, UPPER_MASK, DIGIT_MASK) if mask & m)
    score = (length >= 8) + (length >= 16) + (distinct >= 8) + (distinct >= 12) + (classes > 1)
    if mask & BLANK_MASK:
        score -= 4
    if not mask & ~LOWER_MASK or not mask & ~DIGIT_MASK:
        score -= 3
    return score


class Binding:
    """A name, where it is bound, and the literals and names it is bound to."""

    __slots__ = ("name", "at", "literals", "names", "word", "length", "mask")

    def __init__(self, name: bytes, at: int):
        self.name, self.at = name, at
        self.literals, self.names, self.word = [], [], None

    def add(self, raw: bytes, start: int, end: int) -> None:
        """A literal, less the names inserted in it."""
        inserted = [m.group(1) for m in INSERTED.finditer(raw, start, end)]
        self.names += inserted
        text = INSERTED.sub(b"", raw[start:end]) if inserted else raw[start:end]
        text = SCHEME.sub(b"", text, count=1)
        if text and not PLACEHOLDER.match(text) and not PATH.match(text):
            self.literals.append((start, end, len(text), _mask(text)))


def name_before(raw: bytes, end: int) -> tuple[bytes, int]:
    """The name that ends before ``end``, past blanks and quotes, and its start."""
    i = end
    while i and raw[i - 1] in BLANKS:
        i -= 1
    if i and raw[i - 1] == 93:  # a["name"]
        i -= 1
    if i and raw[i - 1] in QUOTES:
        i -= 1
    start = i
    while start and raw[start - 1] in NAME_BYTES:
        start -= 1
    return raw[start:i].strip(b".-"), start


def expression(raw: bytes, at: int, into: Binding, bare: bool) -> None:
    """Reads an expression's literals and names from ``at`` on.

    Operands follow each other by joins, or directly if they are literals; a
    call or index after a name is read through, without the first argument
    of a look-up.
    """
    depth, skip, first, operand = 0, set(), True, None
    while m := TOKEN.match(raw, at):
        kind = m.lastgroup
        if kind == "space":
            at = m.end()
            continue
        if kind == "open":
            if operand == "name":
                called = re.split(rb"\.|->", into.names.pop())[-1].lower()
                if called in LOOKUPS:
                    skip.add(depth + 1)
            elif operand is not None:
                return
            depth += 1
            operand = None
        elif kind == "close":
            if not depth:
                return
            skip.discard(depth)
            depth -= 1
            operand = "closed"
        elif kind == "comma":
            if not depth:
                return
            skip.discard(depth)
            operand = None
        elif kind == "join":
            if operand is None:
                return
            operand = None
        elif kind in ("name", "shell"):
            if operand is not None and operand != "closed":
                return
            if operand is None and first and bare and kind == "name":
                word = BARE.match(raw, at)
                if word and word.end() > m.end():
                    into.add(raw, at, word.end())
                    return
            if operand == "closed":
                return
            into.names.append(m.group(kind))
            operand = "name"
        else:
            if operand == "name":
                return
            if depth not in skip:
                into.add(raw, m.start(kind), m.end(kind))
            operand = "literal"
        first = False
        at = m.end()
    if first and bare and (word := BARE.match(raw, at)):
        into.add(raw, at, word.end())


def bindings(raw: bytes) -> list[Binding]:
    out, named = [], set()
    for m in OPERATOR.finditer(raw):
        name, start = name_before(raw, m.start())
        if not name:
            continue
        b = Binding(name, start)
        if m.group() == b"=":  # name: type = value
            i = start
            while i and raw[i - 1] in BLANKS:
                i -= 1
            if i and raw[i - 1] == 58:
                typed, at = name_before(raw, i - 1)
                if typed:
                    b = Binding(typed, at)
        if m.group() == b"+=":
            b.names.append(name)
        expression(raw, m.end(), b, bare=True)
        # a name, or a value of a settings file
        if not b.literals and len(b.names) == 1 and (word := WORD.match(raw, m.end())):
            line = raw.rfind(b"\n", 0, b.at) + 1
            if LINE_START.match(raw, line, b.at):
                b.word = word.span(1)
        out.append(b)
    for sign, pattern in PAIRS:
        if sign in raw:
            for m in pattern.finditer(raw):
                given = [i for i in range(1, pattern.groups + 1) if m.group(i) is not None]
                if len(given) == 2:
                    named.add(m.start(given[0]))
                    b = Binding(m.group(given[0]), m.start())
                    b.add(raw, *m.span(given[1]))
                    out.append(b)
    if b"://" in raw:
        for m in ADDRESS.finditer(raw):
            b = Binding(b"password", m.start())
            b.add(raw, *m.span(1))
            out.append(b)
    for b in out:  # a pair's name is no value
        b.literals = [x for x in b.literals if x[0] not in named]
    out.sort(key=lambda b: b.at)
    return out


def literal_spans(raw: bytes) -> list[tuple[int, int, bytes]]:
    """start, end and target name of the literals that flow into sensitive names."""
    found = bindings(raw)
    places: dict[bytes, list[int]] = {}
    for i, b in enumerate(found):
        places.setdefault(b.name, []).append(i)

    def bound(name: bytes, i: int) -> int | None:
        for key in (name, re.split(rb"\.|->", name)[-1]):
            if key in places:
                before = bisect_left(places[key], i)
                if before:
                    return places[key][before - 1]
                if len(places[key]) == 1 and places[key][0] != i:
                    return places[key][0]
        return None

    # constants folded in the order of the text
    for i, b in enumerate(found):
        if b.word and bound(b.names[0], i) is None:
            b.add(raw, *b.word)
        b.length, b.mask = sum(x[2] for x in b.literals), 0
        for x in b.literals:
            b.mask |= x[3]
        for name in b.names:
            if (j := bound(name, i)) is not None and j < i:
                b.length += found[j].length
                b.mask |= found[j].mask

    def sensitive(i: int) -> bool:
        points = name_score(found[i].name)
        values = [i] + [j for name in found[i].names if (j := bound(name, i)) is not None and j > i]
        return points > 0 and any(
            points + value_score(found[j].length, found[j].mask) >= THRESHOLD for j in values
        )

    out, seen = [], set()
    for i, b in enumerate(found):
        if i in seen or not sensitive(i):
            continue
        ways = [i]
        seen.add(i)
        while ways:
            at = ways.pop()
            out += [(start, end, b.name) for start, end, _, _ in found[at].literals]
            for name in found[at].names:
                j = bound(name, at)
                if j is not None and j not in seen:
                    seen.add(j)
                    ways.append(j)
    return out


# ------------------------------------------------------------ rows


def spans_of(text: str | None) -> list[dict]:
    """All spans of a text, in code points, by start and then kind as listed."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    base = base_spans(raw)
    reach, covered = 0, []
    for _, start, end in sorted(base, key=lambda s: s[1]):
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    starts = [c[0] for c in covered]
    spans = {(start, kind, end): None for kind, start, end in base}
    for start, end, name in literal_spans(raw):
        reach = bisect_left(starts, start + 1) - 1
        if reach < 0 or covered[reach][1] < end:
            spans.setdefault((start, "literal", end), name.decode("ascii", "replace"))
    if spans and len(raw) != len(text):
        heads = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        points = np.concatenate([[0], np.cumsum(heads)])
    else:
        points = None
    place = (lambda i: i) if points is None else (lambda i: int(points[i]))
    return [
        {"kind": kind, "start": place(start), "end": place(end), "name": name}
        for (start, kind, end), name in sorted(spans.items(), key=lambda s: (s[0][0], KINDS.index(s[0][1]), s[0][2]))
    ]


def scan(batches):
    for b in batches:
        spans = [spans_of(t.as_py()) for t in b.column("text")]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string())])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"]
        )


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, target name) of every document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(scan, f"doc_id long, spans {SPANS}")


def query(spark, sf_dir):
    found = secret_spans(table(spark, sf_dir, "documents"))

    def written(spans):
        one = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    base = F.filter("spans", lambda s: s.kind != "literal")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
