"""Secrets in texts: fixed patterns and an assignment-aware lexer.

The lexer reads a text as source or configuration: names, literals, operators and line
ends. ``name = "literal"`` (also ``:``, ``:=``, ``=>``, JSON keys, ``export``, typed
declarations, YAML and ini lines with a bare value) gives a name-literal pair. A value
that is made of literals and earlier names joined by ``+`` is put together from them, so
that a secret split over constants, or given a harmless name first, is seen under the
name it ends in; a name that is given something unknown is none of them any more. So are
adjacent strings and sums in parentheses and strings with names put in (``f"{a}{b}"``).
Calls with a name and a literal as their first arguments (``set("password", "..")``), YAML
values behind a tag and XML elements are pairs, too. A pair is scored by how sensitive the words of its name are and how
random its literal looks, and is a finding from ``THRESHOLD`` on.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import texts_of

# The patterns of the base kinds, and how long a match must be.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

# How sensitive a word in the name of a target is.
NAME_WEIGHTS = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "apikey": 3.0,
    "token": 2.5, "credential": 2.5, "credentials": 2.5, "creds": 2.5, "private": 1.5, "access": 1.0,
    "auth": 1.5, "authorization": 2.0, "bearer": 2.0, "api": 1.0, "key": 1.5, "pass": 2.0, "pw": 2.0,
    "signature": 1.0, "signing": 1.5, "salt": 1.5, "session": 0.5, "client": 0.5, "encryption": 1.5,
    "dsn": 1.5, "connection": 0.5, "webhook": 1.0,
}
# Words that say a target holds something else about a secret, not itself.
HARMLESS = {"name", "id", "length", "len", "count", "type", "url", "uri", "path", "file", "hint", "field", "label", "public", "max", "min", "limit", "format", "expires", "expiry"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*|your[-_ ].*|change[-_ ]?me.*|example.*|placeholder|null|none|true|false|todo|undefined)$")
THRESHOLD = 4.0
MIN_LITERAL = 6

# A comment's text is read like any other. An apostrophe within or behind a word opens no string.
LEXEME = re.compile(
    r"""
      (?P<quote>"|`|(?:(?<![^\s=:+(\[{,;!])|(?<=\b[bfruBFRU]))')
    | (?P<name>[A-Za-z_][A-Za-z0-9_]*+(?:[.-][A-Za-z_][A-Za-z0-9_]*+)*+)
    | (?P<op>:=|=>|==|!=|<=|>=|\+=|[=:+])
    | (?P<end>[\n;,{}])
    | (?P<open>\()
    | (?P<comment>\#|//)
    """,
    re.VERBOSE | re.ASCII,
)
# Whole strings from their quotes. One of three quotes may span lines.
STRINGS = {
    '"': re.compile(r'"((?:[^"\\\n]++|\\.)*+)"'),
    "'": re.compile(r"'((?:[^'\\\n]++|\\.)*+)'(?!\w)"),
    "`": re.compile(r"`([^`\n]*+)`"),
    '"""': re.compile(r'"""((?:[^"\\]++|\\.|"(?!""))*+)"""', re.DOTALL),
    "'''": re.compile(r"'''((?:[^'\\]++|\\.|'(?!''))*+)'''", re.DOTALL),
}
# What may stand before a quote, and names that a string puts in.
PREFIX = re.compile(r"(?:[bfruBFRU]|[fFbB][rR]|[rR][fFbB])(?=[\"'])")
PLACED = re.compile(r"\$?\{([A-Za-z_]\w*)\}")
# ``!!str`` and the like before a YAML value.
TAG = re.compile(r"!{1,2}[A-Za-z][\w-]*+[ \t]++")
# ``f("name", `` and ``<name>value</name>``
CALL = re.compile(r"""\(\s*+(["'])([A-Za-z_][\w.-]*+)\1\s*+,\s*+""", re.ASCII)
ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*+)(?:\s[^<>]*+)?>([^<>]*+)</\1\s*>", re.ASCII)
# A value without quotes ends with the line or at white space.
BARE = re.compile(r"""[^\s"'`;,{}\[\]()<>#]+""")
# The last of its line, but for a comment.
LINE_ENDS = re.compile(r"[^\S\n]*+(?:[\n#;,]|\Z)")
BLANKS, SPACE = re.compile(r"[ \t]*+"), re.compile(r"\s*+")
# Characters of a put-together constant that are kept for those it goes into.
LONGEST = 1024
#: A pair needs one of these.
OPERATOR = re.compile(r"[:=(<]")


def words_of(name: str) -> list[str]:
    parts = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name)
    return [w.lower() for w in re.split(r"[^A-Za-z0-9]+", parts) if w]


def name_score(name: str) -> float:
    words = words_of(name)
    if not words or words[-1] in HARMLESS:
        return 0.0
    return sum(NAME_WEIGHTS.get(w, 0.0) for w in set(words))


def literal_score(value: str) -> float:
    """0 to 4: from a plain word or sentence to a long random string."""
    n = len(value)
    if n < MIN_LITERAL or PLACEHOLDER.match(value):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9\s]"))
    spaces = value.count(" ")
    return max(0.0, min(1.5, entropy / 3) + 0.5 * kinds + min(0.5, n / 64) - 0.8 * spaces)


class Lexer:
    """Name-literal pairs of one text, with constants propagated in reading order.

    Its time grows with the text's length: where a quote has no partner on its line, no
    later quote there is looked at again (``remember``), and a bare run is measured once.
    """

    def __init__(self, text: str, remember: bool = True):
        self.text, self.remember = text, remember
        self.constants: dict[str, str] = {}
        self.unclosed: dict[str, tuple[int, int]] = {}  # from where to where a quote has no partner
        self.run = (0, 0, False)  # start and end of the last bare run, and whether it ends its line

    def pairs(self) -> Iterator[tuple[str, str, int, int]]:
        """(name, value, start, end); the span is the value's, from its first part to its last."""
        text, at, previous = self.text, 0, None
        while (found := LEXEME.search(text, at)) is not None:
            kind, at = found.lastgroup, found.end()
            if found[0] == ":" and text.startswith("//", at):
                # A URL: what follows may hold assignments, but is no value of the scheme.
                at, previous = at + 2, None
            elif kind == "op" and found[0] in ("=", ":", ":=", "=>", "+=") and previous is not None:
                value = self.value(at)
                if value is not None:
                    whole, start, end = value
                    if found[0] == "+=":
                        whole = (self.constants.get(previous, "") + whole)[:LONGEST]
                    self.constants[previous] = whole
                    yield previous, whole, start, end
                    # ``a: Type = "x"``: the name goes on to the next operator.
                    at = end
                    previous = None
                elif found[0] != ":":
                    # It is something unknown now.
                    self.constants.pop(previous, None)
                    previous = None
            elif kind == "name":
                # In ``name: Type = value`` the type does not replace the name.
                typed = previous is not None and text.endswith((": ", ":"), 0, found.start())
                previous = previous if typed else found[0]
            elif kind == "quote":
                string = self.string(found.start())
                if string is not None:
                    previous, at = string
            elif kind == "open":
                call = CALL.match(text, found.start())
                value = self.value(call.end(), bare=False) if call else None
                if value is not None:
                    yield call[2], *value
                    at = value[2]
                previous = None
            elif kind in ("end", "comment", "op"):
                previous = None

    def string(self, at: int) -> tuple[str, int] | None:
        """Text and end of the string whose quote is at ``at``."""
        text, quote = self.text, self.text[at]
        if quote != "`" and text.startswith(quote * 3, at):
            whole = self._closed(quote * 3, at, len(text))
            if whole is not None:
                return whole
        return self._closed(quote, at, None)

    def _closed(self, quote: str, at: int, line_end: int | None) -> tuple[str, int] | None:
        since, until = self.unclosed.get(quote, (0, 0))
        if self.remember and since <= at < until:
            return None
        found = STRINGS[quote].match(self.text, at)
        if found is not None:
            return found[1], found.end()
        if quote != "'":
            # What comes before a line's end is read alike from every quote that is passed over.
            if line_end is None:
                line_end = self.text.find("\n", at)
            self.unclosed[quote] = at, len(self.text) if line_end < 0 else line_end
        return None

    def _bare(self, at: int) -> int | None:
        """End of the bare value at ``at``, if it ends its line."""
        start, end, last = self.run
        if not (self.remember and start <= at < end):
            found = BARE.match(self.text, at)
            if found is None:
                return None
            end = found.end()
            last = LINE_ENDS.match(self.text, end) is not None
            self.run = (at, end, last)
        return end if last else None

    def value(self, at: int, bare: bool = True) -> tuple[str, int, int] | None:
        """Literal, constant or sum of them at ``at``, maybe in parentheses; None if it is none of these."""
        text, parts, start, end, depth = self.text, [], None, at, 0
        at = BLANKS.match(text, at).end()
        if tag := TAG.match(text, at):
            at = tag.end()
        while text[at : at + 1] == "(":
            at, depth = SPACE.match(text, at + 1).end(), depth + 1
        while True:
            part = self._part(at)
            if part is not None:
                bare = False
            elif not parts and not depth and bare and (stop := self._bare(at)) is not None:
                part = text[at:stop], stop
            elif parts and depth:
                break
            else:
                return None
            parts.append(part[0])
            start = at if start is None else start
            end = part[1]
            at = (SPACE if depth else BLANKS).match(text, end).end()
            if text[at : at + 1] == "+" and text[at : at + 2] != "+=":
                at = (SPACE if depth else BLANKS).match(text, at + 1).end()
            elif not (depth and text[at : at + 1] in ('"', "'")):
                break
        if depth and text[at : at + 1] != ")":
            return None
        return (parts[0] if len(parts) == 1 else "".join(parts)[:LONGEST]), start, end

    def _part(self, at: int) -> tuple[str, int] | None:
        """A string or a known constant at ``at``."""
        text = self.text
        prefix = PREFIX.match(text, at)
        opens = prefix.end() if prefix else at
        if text[opens : opens + 1] in ('"', "'", "`"):
            string = self.string(opens)
            if string is not None and ((prefix and "f" in prefix[0].lower()) or text[opens] == "`"):
                # Names that are known are put in; others stay as they are written.
                return PLACED.sub(lambda m: self.constants.get(m[1], m[0]), string[0])[:LONGEST], string[1]
            return string
        found = LEXEME.match(text, at)
        if found and found.lastgroup == "name" and found[0] in self.constants:
            return self.constants[found[0]], found.end()
        return None


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return ordered(spans)


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int]]:
    """Spans of literals that the lexer finds under sensitive names, and of XML elements."""
    if not OPERATOR.search(text):
        return []
    spans, worth = set(), {}

    def judge(name: str, value: str, start: int, end: int) -> None:
        sensitive = name_score(name)
        if sensitive:
            if value not in worth:
                worth[value] = literal_score(value)
            if worth[value] and sensitive + worth[value] >= threshold:
                spans.add(("literal", start, end))

    for pair in Lexer(text).pairs():
        judge(*pair)
    if "</" in text:
        for found in ELEMENT.finditer(text):
            judge(found[1], found[2].strip(), *found.span(2))
    return ordered(list(spans))


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
        ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, base, found): spans (kind, start, end) of each text, in code points.

    ``base`` holds the matches of the fixed patterns (kinds ``assign``, ``access`` and
    ``hex``), ``found`` these and the lexer's (kind ``literal``), each by start, then
    kind. NULL and empty texts have none. Every row gives a row, repeated ones, too.
    Other columns are not looked at. The time of a text grows with its length, also on one
    very long line; of a constant that is put together, ``LONGEST`` characters are kept.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for text in texts_of(batch.column("text")):
                own = base_spans(text)
                base.append(own)
                found.append(ordered(own + literal_spans(text, threshold)))
            spans = [
                pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in rows], SPANS.field("base").type)
                for rows in (base, found)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *spans], schema=SPANS)

    span = "array<struct<kind:string,start:int,end:int>>"
    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return named.mapInArrow(scan, f"doc_id long, base {span}, found {span}")
