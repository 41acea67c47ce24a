"""Secret scanning: fixed patterns, and an assignment-aware lexer.

Fixed patterns (``base_spans``) find what looks like a secret.  The lexer finds what is *named* like one:

1. ``pairs`` reads source and configuration syntax: a name (``db.password``, ``"api-key"``,
   ``cfg["token"]``, ``--secret``, ``-Dsecret``), a type where a literal follows (``key: str = "..."``), an assignment
   (``=``, ``:``, ``:=``, ``=>``, ``<-``) and a value, which is a quoted literal (with a prefix as ``b"..."``, in triple
   quotes or in parentheses), several joined by ``+``, a reference to a name, or bare text up to a blank or delimiter.
   ``calls`` reads names and literals that belong together without an assignment: ``setPassword("...")``,
   ``put("password", "...")`` and ``<password>...</password>``.
2. Constants are propagated in text order: a name given a value stands for that value until it is
   assigned again, so ``K = "..."; password = K`` reports the literal of ``K``.  A value keeps references to the
   values it is made of, not copies, so chained constants take space in proportion to the text.
3. A value is scored as a whole, over all its pieces, by the words of its target name (``NAME_SCORES``; compounds as
   ``dbpassword`` are cut at scored words), lowered for names that talk about a secret rather than hold it and for
   values that are plainly no secret; from ``THRESHOLD`` up every piece is reported with kind ``named``.

Spans are in code points, end exclusive.  Work is local to a row: nothing is shuffled, and a text takes
time and memory in proportion to its own length.

Defined cases: null texts are empty; unclosed quotes end a value at the line's end; overlapping spans of
different kinds are all reported; equal spans of one kind once; repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, tagged, untagged

KINDS = ("assign", "access", "hex", "named")

# The base patterns.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# greedy runs that are long enough; what is shorter would be dropped anyway
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6

NAME_SCORES = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 2, "apikey": 3, "credential": 2,
    "credentials": 2, "auth": 1, "authorization": 2, "key": 1, "private": 1, "access": 1, "api": 1, "signing": 1,
    "encryption": 1, "bearer": 2, "client": 0, "session": 1, "cookie": 1, "salt": 1, "pass": 2, "db": 0,
}
ABOUT = {"name", "file", "path", "url", "uri", "id", "field", "label", "type", "length", "len", "count", "policy", "hint",
         "regex", "pattern", "header", "param", "env", "prompt", "reset", "max", "min", "expiry", "ttl", "public"}
# a whole value that stands for another one, or a word that says so between borders
PLACEHOLDER = re.compile(
    r"(?i:change[_-]?me|none|null|nil|true|false|todo|x{4,}|\*{3,}|\.{3,}|your[_-]\S*)"
    r"|<[^<>]*>|\$\{[^{}]*\}|\$\([^()]*\)|\{\{.*\}\}|%\w+%|%\(\w+\)s|\$[A-Za-z_]\w*",
    re.DOTALL,
)
SAYS_SO = re.compile(r"(?i:(?<![^\W_])(?:change[_-]?me|example|placeholder|dummy|sample|redacted|todo|your)(?![^\W_]))")
THRESHOLD = 3.0
MIN_LITERAL = 6
LARGE = 1e15

# what may stand before a quote: letters of Python, Scala, C++ and Rust (r#"..."#), @ and $ of C#
PREFIX = r"""(?:(?:[bB][rR]?|[rR][bBfF]?|[fF][rR]?|[uULs]|u8|raw|b?r\#{1,4}|[@$]{1,2})(?=["']))?"""
TRIPLE = r"""\"{3}(?:[^"\\]|\\[\s\S]|"(?!""))*+"{3}|'{3}(?:[^'\\]|\\[\s\S]|'(?!''))*+'{3}"""
PAIR = re.compile(
    rf"""(?<![\w.\-])(?:--|-D?(?=[A-Za-z_]))?             # a name begins here, or a flag
        (?P<quote>["']?)(?P<name>[A-Za-z_][\w.\-]*+)(?P=quote)
        (?:\[\s{{0,4}}["'](?P<item>[\w.\-]++)["']\s{{0,4}}\])?   # cfg["token"]
        (?:[ \t]{{0,16}}[?!]?:[ \t]{{0,16}}                    # a type, if a literal is assigned
           (?P<type>(?:&(?:'\w{{1,32}}[ ])?)?[A-Za-z_][\w.]*+(?:\[[^="\n]{{0,64}}\]|<[^="\n]{{0,64}}>)?(?:[ ]?\|[ ]?[A-Za-z_][\w.]{{0,64}}){{0,4}}\??)
           (?=[ \t]{{0,16}}=[ \t]{{0,16}}(?:\(\s{{0,16}}){{0,3}}{PREFIX}["'`]))?
        [ \t]{{0,16}}(?::=|=>|<-|[:=](?![:=]))[ \t]{{0,16}}
        (?P<open>(?:\(\s{{0,16}}){{1,3}}(?={PREFIX}["']))?{PREFIX}
        (?P<value>{TRIPLE}|(?:(?<=@)|(?<=@\$))"(?:[^"\n]|"")*+["\n]?
            |"(?:[^"\\\n]|\\.)*+["\n]?|'(?:[^'\\\n]|\\.)*+['\n]?|`[^`\n]*+`?|[^\s"'`,;#()\[\]{{}}<>=:]++={{0,2}}+)""",
    re.VERBOSE | re.ASCII,
)
QUOTED = rf"""{TRIPLE}|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'"""
JOINED = re.compile(rf"""[ \t]{{0,16}}\+[ \t]{{0,16}}{PREFIX}({QUOTED}|[A-Za-z_][\w.\-]*+)""", re.ASCII)
TIGHT = re.compile(rf"{PREFIX}({QUOTED})")
# in parentheses also over lines, and without a plus
JOINED_OPEN = re.compile(rf"""\s{{0,64}}(?:\+\s{{0,64}})?{PREFIX}({QUOTED}|(?<=\+)[A-Za-z_][\w.\-]*+|(?<=\+[ ])[A-Za-z_][\w.\-]*+)""", re.ASCII)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# words that end or begin a compound whatever the rest of it is; the others need a rest of known words
ALWAYS = ("password", "passwd", "passphrase", "credential", "credentials")
QUALIFIERS = ("db", "user", "my", "app", "admin", "root", "sql", "aws", "git", "smtp", "ftp", "ssh", "mail", "http", "web", "id")
COMPOUND = re.compile("|".join(sorted({*NAME_SCORES, *ABOUT, *QUALIFIERS}, key=lambda w: (-len(w), w))))
# a setter with one literal, a quoted name followed by a literal, an element
CALL = re.compile(
    rf"""(?<![\w.\-])(?P<call>[A-Za-z_][\w.]*+)\(\s{{0,16}}{PREFIX}(?P<argument>{QUOTED})\s{{0,16}}\)
        |(?P<q>["'])(?P<key>[A-Za-z_][\w.\-]*+)(?P=q)\s{{0,16}},\s{{0,16}}{PREFIX}(?P<item>{QUOTED})
        |<(?P<tag>[A-Za-z_][\w.\-]*+)(?:\s[^<>]*+)?>(?P<body>[^<>]++)</(?P=tag)\s{{0,16}}>""",
    re.VERBOSE | re.ASCII,
)
SETTER = re.compile(r"(?:.*\.)?(?:set|with|add|put|use)(?=[A-Z_])", re.ASCII)
Span = tuple[int, int]


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_ASSIGNED:
                yield "assign", *m.span()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", *m.span()
    for m in HEX.finditer(text):
        yield "hex", *m.span()


def name_words(name: str) -> Iterator[str]:
    """Lower-cased words of a name, cut at case and punctuation, and compounds at the words that are scored."""
    for word in (w.lower() for w in NAME_WORD.findall(name)):
        if word in NAME_SCORES or word in ABOUT:
            yield word
            continue
        parts = COMPOUND.findall(word)
        if sum(map(len, parts)) == len(word):
            yield from parts
        else:
            yield from [w for w in ALWAYS if word.startswith(w) or word.endswith(w)][:1]


def name_score(name: str) -> float:
    """How far a name promises a secret: the sum over its words, halved once per word that only talks about one."""
    words = list(name_words(name))
    score = sum(NAME_SCORES.get(w, 0) for w in words)
    if any(w in ("api", "access", "private", "signing", "encryption") for w in words) and "key" in words:
        score += 1
    return score / 2 ** sum(w in ABOUT for w in words)


class Value:
    """What a name stands for: own pieces, values referred to, and what scoring needs of the whole.

    ``counts`` holds characters by code point modulo 256, so that it is bounded; it is the sum over all pieces, as
    often as they occur in the whole.
    """

    __slots__ = ("pieces", "parts", "counts", "kinds", "placeholder", "reported")

    def __init__(self, text: str, pieces: list[Span], parts: list[Value]):
        own = [text[a:b] for a, b in pieces]
        self.pieces, self.parts, self.reported = pieces, parts, False
        self.counts = Counter()
        for piece in own:
            self.counts.update(ord(c) & 255 for c in piece)
        for part in parts:
            self.counts.update(part.counts)
        if (size := self.counts.total()) > LARGE:  # constants that double each other: only the shares matter
            self.counts = Counter({c: n / size * LARGE / 2 for c, n in self.counts.items()})
        self.kinds = {k for piece in own for k, p in KIND_OF if p.search(piece)}.union(*(part.kinds for part in parts))
        stand_ins = [bool(PLACEHOLDER.fullmatch(p) or SAYS_SO.search(p)) for p in own if p] + [part.placeholder for part in parts]
        self.placeholder = bool(stand_ins) and all(stand_ins)

    def score(self) -> float:
        """What the value itself adds: variety adds, plain words and placeholders take away."""
        size = self.counts.total()
        if size < MIN_LITERAL or self.placeholder:
            return -10
        entropy = -sum(n / size * math.log2(n / size) for n in self.counts.values() if n / size > 0)
        if len(self.kinds) == 1 and self.kinds != {"digit"}:
            return -1 if entropy < 3 else 0
        return min(1.0, entropy / 4) + 0.25 * (len(self.kinds) - 1)

    def report(self) -> Iterator[Span]:
        """Pieces of this value and of all it refers to that no value has reported yet."""
        left = [self]
        while left:
            value = left.pop()
            if not value.reported:
                value.reported = True
                yield from value.pieces
                left.extend(value.parts)


KIND_OF = [("lower", re.compile("[a-z]")), ("upper", re.compile("[A-Z]")), ("digit", re.compile("[0-9]")), ("other", re.compile("[^A-Za-z0-9]"))]


def inner(text: str, start: int, end: int) -> Span:
    """A quoted literal's span without its quotes; an unclosed one ends before the line's end."""
    if text[start : start + 3] in ('"""', "\'\'\'") and end - start > 5:
        return start + 3, end - 3
    return start + 1, end - (end - start > 1 and text[end - 1] in f"{text[start]}\n")


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int, bool]]]]:
    """Name, and the pieces of its value: spans without quotes, and whether a piece stands without quotes."""
    at = 0
    while m := PAIR.search(text, at):
        name = f"{m['name']}.{m['item']}" if m["item"] else m["name"]
        pieces = []
        start, end = m.span("value")
        bare = text[start] not in "\"'`"
        # a="..." after a plus without blanks: the bare text ends at the plus
        if bare and end - start > 1 and text[end - 1] == "+" and (more := TIGHT.match(text, end)):
            pieces.append((start, end - 1, True))
            start, end = more.span(1)
        while True:
            bare = text[start] not in "\"'`"
            pieces.append((start, end, True) if bare else (*inner(text, start, end), False))
            more = (JOINED_OPEN if m["open"] else JOINED).match(text, end)
            if not more:
                break
            start, end = more.span(1)
        yield name, pieces
        # the next pair may begin inside a bare value (a=b=c) or at a type (a: b = "c"), but not inside a quoted value
        at = m.start("type") if m["type"] else end if m["value"][0] in "\"'`" else m.start("value")


def calls(text: str) -> Iterator[tuple[str, Span]]:
    """Name and literal of a setter, of a quoted name that a literal follows, and of an element."""
    at = 0
    while m := CALL.search(text, at):
        if m["call"]:
            if SETTER.match(m["call"]):
                yield m["call"], inner(text, *m.span("argument"))
            at = m.end("call")
        elif m["key"]:
            yield m["key"], inner(text, *m.span("item"))
            at = m.start("item")
        else:
            yield m["tag"], m.span("body")
            at = m.end("body")


def named_spans(text: str) -> Iterator[tuple[str, int, int]]:
    constants: dict[str, Value] = {}
    found: set[Span] = set()
    for name, pieces in pairs(text):
        own, parts = [], []
        for start, end, bare in pieces:
            names = text[start:end].split("+") if bare else []
            if names and all(n in constants for n in names):
                parts.extend(constants[n] for n in names)
            else:
                own.append((start, end))
        value = Value(text, own, parts)
        constants[name] = value
        promise = name_score(name)
        if promise > 0 and promise + value.score() >= THRESHOLD:
            found.update(s for s in value.report() if s[0] < s[1])
    for name, span in calls(text):
        promise = name_score(name)
        if promise > 0:
            worth = Value(text, [span], []).score()
            if worth > 0 and promise + worth >= THRESHOLD:
                found.add(span)
    for start, end in sorted(found):
        yield "named", start, end


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then by kind as listed."""
    if not text:
        return []
    found = [*base_spans(text), *(named_spans(text) if re.search("[=:(,<]", text) else ())]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id and its spans, an array of (kind, start, end)."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), s)) for s in spans_of(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], ["doc_id", "spans"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def base_digest(spans) -> Column:
    """SHA-256 over the base spans, kind:start:end joined by commas."""
    return F.sha2(span_text(F.filter(spans, lambda s: s["kind"] != "named")), 256)


def span_text(spans) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in spans_of(text):
        if start > at or not out:
            out += [text[at:start], mark] if start >= at else []
        at = max(at, end)
    return text if not out else "".join(out) + text[at:]


def redacted_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with secrets replaced, all columns kept; ``chars_col`` follows the new text's length."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            clean = pa.array([redact(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], clean], names=batch.schema.names)

    rows, own = tagged(docs, _text=text_col)
    place, dtypes = docs.columns.index(text_col), dict(rows.dtypes)
    rest = [c for c in own if c != own[place]]
    done = rows.select(*rest, "_text").mapInArrow(run, ", ".join(f"{c} {dtypes[c]}" for c in [*rest, "_text"]))
    out = [F.col("_text" if c == own[place] else c) for c in own]
    if chars_col in docs.columns:
        n = docs.columns.index(chars_col)
        changed = F.length("_text").cast(dtypes[own[n]])
        out[n] = F.when(F.col("_text").isNull(), F.col(own[n])).otherwise(changed)
    return done.select(*out).toDF(*docs.columns)


