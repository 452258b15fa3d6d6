"""Secrets in texts: three fixed patterns, and literals assigned to names that promise a secret.

The second part reads a text as source or configuration, whatever the language:

* A lexer gives strings, names, numbers and operators; what is no such thing is skipped, so prose
  does no harm.
* A reader collects pairs of a target name and a value: ``name = "x"``, ``name: x``, ``"name": "x"``,
  ``cfg["name"] = "x"``, ``name: str = "x"``, ``put("name", "x")``, ``setName("x")``, ``--name x``,
  ``<name>x</name>``, ``key="name" value="x"``, ``- name: n`` over ``value: x``, and ``user:x@`` in URLs. A value is a
  literal, another name, a call around one of them, or several of them joined.
* Constants are propagated: a name in a value stands for what was last assigned to it before,
  else for its first assignment behind; cycles end where they began. ``${name}`` is such a name, too.
* A pair's score is what the target's words promise plus what the literal looks like. From
  ``THRESHOLD`` on, the places of the literals it is made of are reported, wherever they stand.

Every text is scanned whole in its own row. A text without any sensitive stem has no sensitive
target and needs no lexing.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.shared import map_batches, without

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 3.0
# The three base patterns; shorter matches are dropped after matching.
ASSIGN = re.compile(
    r"""(?ai:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are greedy, so this is every run of that length
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# What a word of a target name promises.
PROMISES = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 3.0, "secret": 3.0, "token": 2.5, "credential": 2.5,
    "credentials": 2.5, "pass": 2.0, "pw": 2.0, "bearer": 2.0, "apikey": 3.0, "auth": 1.0, "salt": 1.0, "pin": 1.0,
    "key": 0.5, "signature": 1.0, "cookie": 1.0, "dsn": 1.0,
}
# With one of these before it, a key is secret.
KEY_OF = frozenset(
    "api access private secret encryption signing master shared ssh auth client account storage service crypto hmac jwt".split()
)
# A name that ends so holds something about a secret, not the secret.
ABOUT = frozenset(
    "file path dir url uri endpoint name id ids length len size count type field column label hint prompt placeholder policy "
    "expiry expires expiration ttl timeout regex pattern format header param parameter prefix suffix version enabled required "
    "index idx var env arn ref provider manager service store class min max".split()
)
PUBLIC = frozenset("public pub primary foreign sort partition cache map dict row col keyboard".split())
RUN_TOGETHER = ("password", "passwd", "passphrase", "secret", "apikey", "token", "accesskey", "privatekey", "secretkey")
STEMS = ("pass", "pwd", "pw", "secret", "token", "key", "cred", "auth", "bearer", "salt", "pin", "signature", "cookie", "dsn", "://")
PLACEHOLDER = re.compile(
    r"(?i)change.?me|example|your|x{3,}|\*{3,}|\.{3,}|todo|placeholder|dummy|redacted|insert|replace|sample|fixme|undefined"
    r"|^(?:none|null|nil|true|false|empty|default|unknown|string|test|secret|password|token)$|^<.*>$|^\[.*\]$|%s|%\(|\{\d*\}"
)
REFERENCE = re.compile(r"\$\{\{?\s*([\w.-]+)\s*\}?\}|\{\{\s*\.?([\w.-]+)\s*\}\}|\$([A-Za-z_]\w*)|%([A-Za-z_]\w*)%|\$\(([\w.-]+)\)")
FILLED_IN = re.compile(r"[$#]?\{[^{}\n]*\}|\$\([^()\n]*\)")
URL_LOGIN = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@\"'<>]*:([^\s/:@\"'<>]+)@")

_TOKEN = re.compile(
    r'''
    (?P<str>(?<!\w)(?:[rRbBfFuU@$]{0,2})(?:"""(?s:.*?)"""|\'\'\'(?s:.*?)\'\'\'|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`))
    |(?P<name>[^\W\d][\w$]*(?:(?:->|::|[.-])[^\W\d][\w$]*)*)
    |(?P<number>\d[\w.]*)
    |(?P<line>\n)
    |(?P<op>:=|=>|<-|==|!=|<=|>=|\+=|\?=|\?\?|\?:|\|\||&&|//|--|[=:+.,;(){}\[\]<>&|?/-])
    |(?P<other>[^\s])
    ''',
    re.VERBOSE,
)
_BARE = re.compile(r"[^\s\"'`,;<>{}()\[\]]+")
_WORDS = re.compile(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]?[a-z]+|[A-Z]+|\d+")
_ASSIGNS = frozenset({"=", ":", ":=", "=>", "+=", "?=", "<-"})
_JOINS = frozenset({"+", ".", "&", "||", "??", "?:"})


def promise(name: str) -> float:
    """How much a target name promises a secret: 3 for a password, negative for its file name."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in ABOUT:
        return -3.0
    scores = [PROMISES.get(w, 0.0) for w in words]
    if any(w in ("key", "keys") and KEY_OF & set(words[:i]) for i, w in enumerate(words)):
        scores.append(3.0)
    if any(w.endswith(RUN_TOGETHER) for w in words):
        scores.append(2.5)
    return max(scores) - (3.0 if PUBLIC & set(words) else 0.0)


def entropy(literal: str) -> float:
    """Bits a character, by the literal's own characters."""
    n = len(literal)
    return -sum(c / n * log2(c / n) for c in Counter(literal).values())


def plausibility(literal: str, bare: bool = False) -> float:
    """How much a literal looks like a secret, without what is filled in later; bare words need more than quoted ones."""
    literal = FILLED_IN.sub("", literal)
    n = len(literal)
    if n < 6 or len(set(literal)) < 4 or PLACEHOLDER.search(literal):
        return -4.0
    kinds = sum(any(map(test, literal)) for test in (str.islower, str.isupper, str.isdigit))
    kinds += any(not c.isalnum() and not c.isspace() for c in literal)
    bits = entropy(literal)
    score = 0.5 * (kinds - 1) + (1.0 if n * bits >= 40 else 0.5 if n * bits >= 24 else 0.0)
    if any(c.isspace() for c in literal) and not literal.lstrip().startswith("-----BEGIN"):
        score -= 3.0
    if kinds < 2:
        score -= 1.0
    if "://" in literal or literal.startswith(("/", "./", "../", "~/")) or re.fullmatch(r"[\w.-]+\.(?:[a-z]{2,4})", literal):
        score -= 2.0
    if bare and (n < 8 or kinds < 2 or bits < 2.5 or literal.isdigit() or re.fullmatch(r"[^\W\d_]+\W*", literal)):
        score -= 4.0
    return score


@dataclass
class Literal:
    start: int
    end: int
    text: str
    bare: bool = False


@dataclass
class Pair:
    """A target name and the literals and names that its value is made of."""

    at: int
    name: str
    value: list[Literal | str] = field(default_factory=list)


class Reader:
    """Name-value pairs of one text."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [(m.lastgroup, m.start(), m.end(), m.group()) for m in _TOKEN.finditer(text)]
        self.pairs: list[Pair] = []

    def _is(self, i: int, *texts: str) -> bool:
        return i < len(self.tokens) and self.tokens[i][3] in texts and self.tokens[i][0] == "op"

    def _kind(self, i: int) -> str | None:
        return self.tokens[i][0] if 0 <= i < len(self.tokens) else None

    def _string(self, i: int) -> Literal:
        """A string token without prefix and quotes."""
        _, start, end, raw = self.tokens[i]
        body = raw.lstrip("rRbBfFuU@$")
        start += len(raw) - len(body)
        quote = 3 if len(body) >= 6 and body[:3] in ('"""', "'''") else 1
        return Literal(start + quote, end - quote, self.text[start + quote : end - quote])

    def _close(self, i: int) -> int:
        """The place after the bracket that closes the one at ``i``, on at most 64 tokens."""
        depth = 0
        for j in range(i, min(i + 64, len(self.tokens))):
            if self._is(j, "(", "[", "{"):
                depth += 1
            elif self._is(j, ")", "]", "}"):
                depth -= 1
                if depth == 0:
                    return j + 1
        return i + 1

    def _value(self, i: int, config: bool) -> list[Literal | str]:
        """What stands from token ``i`` on: literals and names, joined; ``config``: a bare word is a literal, too."""
        found: list[Literal | str] = []
        while i < len(self.tokens):
            kind, start, _, raw = self.tokens[i]
            if kind == "str":
                literal = self._string(i)
                found += self._parts(literal)
                i += 1
            elif kind == "name" and self._is(i + 1, "("):
                inner = [j for j in range(i + 2, self._close(i + 1)) if self._kind(j) in ("str", "name")]
                if len(inner) == 1 and self._kind(inner[0]) == "str":
                    found += self._parts(self._string(inner[0]))
                elif len(inner) == 1:
                    found.append(self.tokens[inner[0]][3])
                i = self._close(i + 1)
            elif reference := REFERENCE.match(self.text, start):
                found.append(next(filter(None, reference.groups())))
                while i < len(self.tokens) and self.tokens[i][1] < reference.end():
                    i += 1
            else:
                bare = _BARE.match(self.text, start) if kind != "line" else None
                if bare is None:
                    break
                word = bare.group().rstrip(".:")
                whole = kind == "name" and len(raw) >= len(word)
                if config and word and not (whole and raw in self._names()):
                    found += self._parts(Literal(start, start + len(word), word, bare=True))
                    break
                if not whole:
                    break
                found.append(raw)
                i += 1
            if self._is(i, *_JOINS):
                i += 1
                if self._kind(i) == "line":
                    i += 1
            elif self._kind(i) != "str":
                break
        return found

    def _names(self) -> set[str]:
        """Names that something is assigned to, to tell a bare word of a configuration from a constant."""
        if not hasattr(self, "_assigned"):
            self._assigned = {
                t[3]
                for i, t in enumerate(self.tokens[:-1])
                if t[0] == "name" and self.tokens[i + 1][0] == "op" and self.tokens[i + 1][3] in _ASSIGNS
            }
        return self._assigned

    def _parts(self, literal: Literal) -> list[Literal | str]:
        """A literal, or the names that it refers to where it is nothing but references."""
        names = [next(filter(None, m.groups())) for m in REFERENCE.finditer(literal.text)]
        return names if names and not REFERENCE.sub("", literal.text).strip() else [literal]

    def _add(self, i: int, name: str, value: list[Literal | str]) -> None:
        if value:
            self.pairs.append(Pair(self.tokens[i][1], name, value))

    def _operator(self, i: int) -> int | None:
        """Where the assignment of a target that ends before ``i`` is, past subscripts and type annotations."""
        if self._is(i, "[") and self._close(i) - i <= 3 and self._kind(i + 1) != "str":
            i = self._close(i)  # name[] = and name[32] =
        if not (i < len(self.tokens) and self.tokens[i][0] == "op" and self.tokens[i][3] in _ASSIGNS):
            return None
        if self._is(i, ":") and self._kind(i + 1) in ("name", "op"):
            for j in range(i + 2, min(i + 10, len(self.tokens))):  # name: type = value
                if self._is(j, "=") and self._kind(j + 1) in ("str", "name"):
                    return j
                if self._kind(j) in ("line", "str", "other") or self._is(j, ",", ";", ":", "("):
                    break
        return i

    def read(self) -> list[Pair]:
        tokens = self.tokens
        opened: tuple[str, int] | None = None  # the last name of a key attribute or name entry
        for i, (kind, start, end, raw) in enumerate(tokens):
            if kind == "name":
                at = self._operator(i + 1)
                if at is not None:
                    spaced = self._is(at, "=", ":", ":=", "?=")
                    value = self._value(at + 1, config=spaced)
                    last = raw.lower().rsplit(".", 1)[-1]
                    self._add(i, raw, value)
                    if last in ("key", "name") and len(value) == 1:
                        opened = (value[0].text if isinstance(value[0], Literal) else value[0], i)
                    elif last == "value" and opened and i - opened[1] <= 12:
                        self._add(i, opened[0], value)
                        opened = None
                elif self._is(i + 1, "(") and self._kind(i + 2) == "str" and self._is(i + 3, ")"):
                    self._add(i, raw, self._parts(self._string(i + 2)))  # setName("x")
                elif self._is(i - 1, "<") and self._is(i + 1, ">") and i + 2 < len(tokens):
                    begin = tokens[i + 1][2]
                    stop = self.text.find("</", begin, begin + 4096)
                    inner = self.text[begin:stop].strip() if stop > begin else ""
                    if inner and "<" not in inner:
                        place = self.text.index(inner, begin)
                        self._add(i, raw, self._parts(Literal(place, place + len(inner), inner)))
                elif i and self._is(i - 1, "--") and tokens[i - 1][2] == start and self.text[end : end + 1] == " ":
                    self._add(i, raw, self._value(i + 1, config=True))
            elif kind == "str":
                name = self._string(i).text
                if not name or len(name) > 80:
                    continue
                if self._is(i + 1, ":", "=>"):
                    self._add(i, name, self._value(i + 2, config=False))
                elif self._is(i + 1, "]") and self._is(i - 1, "["):
                    at = self._operator(i + 2)
                    if at is not None:
                        self._add(i, name, self._value(at + 1, config=False))
                elif self._is(i - 1, "(") and self._is(i + 1, ",") and self._kind(i + 2) in ("str", "name"):
                    self._add(i, name, self._value(i + 2, config=False))
        return self.pairs


def _literals(pairs: list[Pair]) -> Iterator[tuple[str, list[Literal]]]:
    """Every sensitive target with its value's literals, names replaced by what is assigned to them."""
    places: dict[str, list[int]] = {}
    for number, pair in enumerate(pairs):
        for name in {pair.name, re.split(r"\.|->|::", pair.name)[-1]}:
            places.setdefault(name, []).append(number)
    for number, pair in enumerate(pairs):
        if promise(pair.name) <= 0:
            continue
        out: list[Literal] = []
        waiting = [(part, number) for part in reversed(pair.value)]
        seen = {number}
        while waiting:
            part, user = waiting.pop()
            if isinstance(part, Literal):
                out.append(part)
                continue
            own = places.get(part) or places.get(re.split(r"\.|->|::", part)[-1]) or []
            k = bisect_left(own, user)
            source = own[k - 1] if k else next((n for n in own[k:] if n != user), None)
            if source is not None and source not in seen:
                seen.add(source)
                waiting += [(p, source) for p in reversed(pairs[source].value)]
        yield pair.name, out


def assigned_secrets(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(start, end, target name, score) of the literals that reach the threshold, by place; the best target of each."""
    lower = text.lower()
    if not any(stem in lower for stem in STEMS):
        return []
    best: dict[tuple[int, int], tuple[float, str]] = {}

    def offer(name: str, literals: list[Literal]) -> None:
        whole = "".join(x.text for x in literals)
        if not whole:
            return
        score = promise(name) + plausibility(whole, any(x.bare for x in literals))
        if score >= threshold:
            for x in literals:
                if x.text:
                    best[x.start, x.end] = max(best.get((x.start, x.end), (0.0, "")), (score, name))

    for name, literals in _literals(Reader(text).read()):
        offer(name, literals)
    for login in URL_LOGIN.finditer(text):
        offer("password", [Literal(login.start(1), login.end(1), login.group(1))])
    return [(start, end, name, score) for (start, end), (score, name) in sorted(best.items())]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base patterns: leftmost, without overlaps within a kind."""
    lower = text.lower()
    found = []
    if any(word in lower for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def find_secrets(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int, str | None, float | None]]:
    """(kind, start, end, target, score) in characters, by start, then kind. Base spans have neither target nor score.

    A literal that lies within a base span is that span's and not reported again.
    """
    text = text or ""
    found = [(start, KINDS.index(kind), end, None, None) for start, end, kind in base_spans(text)]
    covered = sorted((start, end) for start, _, end, *_ in found)
    reach, ends = 0, []  # how far the spans that begin so far go
    for _, end in covered:
        reach = max(reach, end)
        ends.append(reach)
    for start, end, name, score in assigned_secrets(text, threshold):
        k = bisect_left(covered, (start + 1,)) - 1
        if k < 0 or ends[k] < end:
            found.append((start, 3, end, name, score))
    return [(KINDS[kind], start, end, name, score) for start, kind, end, name, score in sorted(found, key=lambda s: s[:3])]


_SECRET = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]
)
_SQL_SECRET = "array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>"


def scan_secrets(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secrets``: kind (see ``KINDS``), start and end in characters, target name and score.

    NULL and empty texts have none. Rows are independent of each other, so repeated rows and ids stay; an existing column
    ``secrets`` is replaced; an empty table gives no rows.
    """
    docs = without(docs, "secrets")
    at = docs.columns.index(text)
    result = docs.withColumn("secrets", F.array().cast(_SQL_SECRET)).schema
    names = ("kind", "start", "end", "name", "score")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(names, s, strict=True)) for s in find_secrets(x.as_py(), threshold)] for x in batch.column(at)]
            columns = [*batch.columns, pa.array(spans, pa.list_(_SECRET))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "secrets"])

    return map_batches(docs, scanned, result)
