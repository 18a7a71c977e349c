"""Secrets in texts: fixed patterns, and literals that reach names which tell of secrets."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import trim

# The patterns that always count. Of the first, matches whose second group has fewer than ASSIGN_LEAST characters don't.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS, ASSIGN_LEAST = ("password", "passwd", "secret", "token", "apikey", "api_key"), 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: In the order of spans that begin together; the last one comes from names.
KINDS = ("assign", "access", "hex", "literal")

# How much a word of a name tells of a secret; two words in a row count as one, too.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "privatekey": 1.0, "signingkey": 1.0,
    "encryptionkey": 1.0, "masterkey": 1.0, "sharedkey": 1.0, "accountkey": 1.0, "credential": 0.9, "credentials": 0.9, "authorization": 0.8, "bearer": 0.8, "auth": 0.6, "pin": 0.4, "key": 0.4, "salt": 0.4, "cookie": 0.5, "session": 0.4,
}
# Last words of names that hold something about a secret.
ABOUT = {"file", "path", "url", "uri", "name", "id", "length", "len", "size", "count", "type", "format", "field", "column", "header", "label", "hint", "prompt", "policy", "expiry", "expires", "ttl", "timeout", "endpoint", "algorithm", "prefix", "public", "regex", "pattern", "class", "style", "message", "error", "help"}
# Literals that stand where a secret will be, addresses and paths.
NO_SECRET = re.compile(r"(?i)(?:(?:your|my|the|some|enter|insert|put|add|replace)[\W_].*|.*(?:change_?me|example|placeholder|redacted|dummy|sample|not_?set|to_?do|xxx|\*\*\*|\.\.\.).*|[$%#]?[{<\[(].*[}>\])]|[$%]\w+%?|\w+://[^@]*|[.~]?(?:/[a-z_.-]+)+/?|none|null|nil|true|false|undefined|empty|default)")

_SITE = re.compile(r"[=:]{1,3}")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_WORDY = re.compile(r"[A-Za-z]+(?:[_.-][A-Za-z]+)*")
_NAME_END = re.compile(r"[A-Za-z0-9_.$@-]")
_BARE = re.compile(r"[^\s,;:(){}\[\]<>\"'`#|&=]+=*")
_NAME = re.compile(r"[A-Za-z_$](?:[\w$]|\.(?=\w))*", re.ASCII)
_BLANK = re.compile(r"[ \t]*")
_JOINT = re.compile(r"[ \t]*(?:(?:\+|\.{1,2}|&)[ \t]*(?:\\?\n[ \t]*)?(?=[\"'`A-Za-z_$])|(?:\\\n[ \t]*)?(?=[\"'`]))")
_ASSIGNS = re.compile(r"[ \t]*:?=(?!=)")
_SCHEME = re.compile(r"(?i:bearer|basic|token)\x20+(?=[^\s\"'])")
_ELEMENT = re.compile(r"<([\w.-]+)>([^<>\s]+)</")
# What stands between quotes on a line.
_INSIDE = {q: re.compile(rf"[^{q}\\\n]*(?:\\.[^{q}\\\n]*)*") for q in "\"'`"}
#: Characters of a name at most; a longer run of them is no name.
NAME_MOST = 128
#: The least score of a literal.
LEAST = 0.5


def name_score(name: str) -> float:
    """How much a name tells of a secret, 0 to 1: its most telling word or two words in a row; 0 if its last word says that it is
    about one."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in ABOUT:
        return 0.0
    return max(SENSITIVE.get(w, 0.0) for w in (*words, *map("".join, zip(words, words[1:], strict=False))))


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: its length, and the entropy of its characters against that of random ones."""
    n = len(value)
    if n < 8 or any(c.isspace() for c in value) or NO_SECRET.fullmatch(value) or _WORDY.fullmatch(value) and (value.isupper() or name_score(value)):
        return 0.0
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(bool(re.search(k, value)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if kinds < 2 and not (n >= 16 and entropy > 2.5 and re.fullmatch("[0-9a-f]+|[A-Z2-7]+", value)):
        return 0.0  # a word or a number
    return min(1.0, n / 16 + 0.25) * min(1.0, entropy / min(4.0, math.log2(n)))


class Value:
    """The right side of an assignment: its literals (start, end), in groups that are joined, and the values of the names in it."""

    __slots__ = ("groups", "reached", "refs", "sure")

    def __init__(self) -> None:
        self.groups: list[list[tuple[int, int]]] = [[]]
        self.refs: list[Value] = []
        self.sure, self.reached = True, 0.0  # in quotes; the weight of the most telling name it has reached


class Lexer:
    """The names of a text and what is assigned to them, in the usual syntaxes: `name = "x"`, `name := x`, `"name": "x"`, `name: x`,
    `name => 'x'`, `map["name"] = x`, `name: type = "x"`, `name += "x"`, `name="x"` in tags and calls, `<name>x</name>`.

    It goes from one = or : to the next. The name stands before it, as far back as the last value at most; the value stands
    behind: literals and known names, joined or given to a call. A name means what was last assigned to it. A character is
    looked at a bounded number of times, so any text takes linear time.
    """

    def __init__(self, text: str):
        self.text = text
        self.known: dict[str, Value] = {}
        self.unclosed: dict[str, int] = {}  # up to where no quote of a kind is closed
        self.typed: tuple[int, str] = (-1, "")  # where the last : ends, and the name before it

    def pairs(self) -> Iterator[tuple[str, Value]]:
        text, at, floor = self.text, 0, 0
        while site := _SITE.search(text, at):
            s, at = site.span()
            name, more = self.name_before(s, floor) if site.group() in ("=", ":", ":=") else ("", False)
            names = [name] if name else []
            if site.group() == "=" and text.startswith(">", at):
                at += 1
            if name and self.typed[0] == floor and site.group() == "=":
                names.append(self.typed[1])  # name: type = value
            self.typed = (at, name) if site.group() == ":" and name else (-1, "")
            floor = at
            if not names:
                continue
            value, end = self.value_after(at, site.group() != ":=")
            if value is None:
                continue
            if value.sure or not value.groups[0]:
                at = floor = max(at, end)
                self.typed = (-1, "")
            for n in names:
                if more and n in self.known:
                    value.refs.append(self.known[n])
                self.known[n] = value
                yield n, value
        for m in _ELEMENT.finditer(text):
            value = Value()
            value.groups[0].append(m.span(2))
            yield m.group(1), value

    def name_before(self, end: int, floor: int) -> tuple[str, bool]:
        """The name that ends before `end`, empty if there is none; and whether it is added to."""
        text, i = self.text, end
        more = i > floor and text[i - 1] == "+"
        i -= more
        while i > floor and text[i - 1] in " \t":
            i -= 1
        if i > floor and text[i - 1] == "]":
            start = text.rfind("[", floor, i)
            inside = text[start + 1 : i - 1].strip(" \"'`") if start >= 0 and i - start < NAME_MOST else ""
            if inside or start < 0:
                return inside, more
            i = start
        if i > floor and text[i - 1] in "\"'`":
            start = text.rfind(text[i - 1], floor, i - 1)
            return (text[start + 1 : i - 1] if start >= 0 and i - start < NAME_MOST else ""), more
        s = i
        while s > floor and _NAME_END.match(text[s - 1]):
            s -= 1
        return (text[s:i].lstrip("-.") if i - s < NAME_MOST else ""), more

    def quoted(self, at: int) -> tuple[int, int, int] | None:
        """Start and end of the literal whose quote is at `at`, and where it goes on; none if the quote isn't closed."""
        text, q = self.text, self.text[at]
        if text.startswith(q * 3, at):
            end = text.find(q * 3, at + 3) if at >= self.unclosed.get(q * 3, 0) else -1
            if end < 0:
                self.unclosed[q * 3] = len(text)
                return None
            return at + 3, end, end + 3
        if at < self.unclosed.get(q, 0):
            return None
        end = _INSIDE[q].match(text, at + 1).end()
        if not text.startswith(q, end):
            self.unclosed[q] = end
            return None
        return at + 1, end, end + 1

    def value_after(self, at: int, bare: bool) -> tuple[Value | None, int]:
        text, value, calls = self.text, Value(), 0
        at = _BLANK.match(text, at).end()
        while at < len(text):
            if text[at] in "rbfuRBFU@" and text[at + 1 : at + 2] in ('"', "'"):
                at += 1
            name = _NAME.match(text, at)
            if text[at] in "\"'`":
                found = self.quoted(at)
                if found is None:
                    break
                s, e, at = found
                scheme = _SCHEME.match(text, s, e)
                value.groups[-1].append((scheme.end() if scheme else s, e))
            elif text.startswith("(", end := name.end() if name else at):
                at, calls, bare = _BLANK.match(text, end + 1).end(), calls + 1, False
                continue
            elif name and name.group() in self.known and not _ASSIGNS.match(text, name.end()):
                value.refs.append(self.known[name.group()])
                at = name.end()
            elif bare and (word := _BARE.match(text, scheme.end() if (scheme := _SCHEME.match(text, at)) else at)):
                value.groups[-1].append(word.span())
                value.sure = False
                return value, word.end()
            else:
                break
            bare = False
            while calls and text.startswith(")", at):
                at, calls = at + 1, calls - 1
            if calls and text.startswith(",", at):
                value.groups.append([])
                at = _BLANK.match(text, at + 1).end()
            elif joint := _JOINT.match(text, at):
                at = joint.end()
            else:
                break
        return (value if value.refs or any(value.groups) else None), at


def literals(text: str) -> list[tuple[int, int, str, float]]:
    """The literals of a text that look like secrets and reach a telling name, directly or through other names: start, end, the
    name, the score, which is the product of both scores, less by a fifth for a literal without quotes."""
    found: dict[tuple[int, int], tuple[float, str]] = {}
    for name, value in Lexer(text).pairs():
        weight, todo = name_score(name), [value]
        while todo:
            v = todo.pop()
            if v.reached >= weight:
                continue  # so a value is looked at once for every larger weight, of which there are a few
            v.reached = weight
            todo += v.refs
            for group in v.groups:
                score = weight * (1.0 if v.sure else 0.8) * literal_score("".join(text[s:e] for s, e in group))
                for span in group if score >= LEAST else ():
                    if span[0] < span[1] and score > found.get(span, (0.0, ""))[0]:
                        found[span] = score, name
    return [(s, e, name, score) for (s, e), (score, name) in sorted(found.items())]


def spans(text: str) -> list[tuple[str, int, int, str | None, float]]:
    """All spans of a text: kind, start, end (code points, exclusive), the name, the score (1 for the fixed patterns); by start, then
    kind."""
    out: list[tuple[str, int, int, str | None, float]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span(), m.group(1), 1.0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span(), None, 1.0) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span(), None, 1.0) for m in HEX.finditer(text)]
    out += [("literal", s, e, name, score) for s, e, name, score in literals(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64()), ("value", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for text in b.column("text"):  # one text at a time is a Python string
            text = text.as_py() or ""
            found.append([{"kind": k, "start": s, "end": e, "name": n, "score": p, "value": text[s:e]} for k, s, e, n, p in spans(text)])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, _FOUND)], names=["doc_id", "found"])
    trim()


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id and found, an array of struct<kind, start, end, name, score, value> by start,
    then kind. Places are code points, ends exclusive.

    Kinds assign, access and hex are the fixed patterns: every match without overlaps from the left that is long enough. Kind literal is
    what the lexer finds: a text is read as source or configuration, names are paired with the literals they are assigned, a
    name stands for its last value in later assignments, and a literal counts with the most telling name that it reaches, if
    name_score * literal_score is LEAST or more (four fifths of it without quotes). Literals that an expression joins are scored as one and marked
    each; the span is the literal without its quotes. Spans of unlike kinds may overlap.

    No shuffle; every text is read whole, one at a time, in linear time. Null texts are empty and an empty text has no spans. Rows are read one by one, repeated or
    not; of names that tell as much, the first counts. Other columns are ignored. No rows give no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_scan, f"doc_id {kind}, found array<struct<kind: string, start: long, end: long, name: string, score: double, value: string>>")


def span_list(found: Column) -> Column:
    """kind:start:end of an array of spans, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
