"""Secret scans by assignment-aware lexing.

Lines of source or configuration are lexed into name-literal pairs
(``name = "x"``, ``name: x``, ``name := x``, ``"name" => "x"``, XML-like
``<name>x</name>``, flags ``--name x``); a binding may go on over line breaks.
A name bound to a literal is a constant; an assignment of a constant, or of
literals joined by ``+``, takes the literals over, through any number of names
in any order. A literal is scored by the most sensitive name that any
definition of its name reaches, and by its own shape or that of a value it is
part of; high scores become spans beside the base patterns'.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Taken, key_text, python_stage

#: fixed kinds and patterns of the contract
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

#: parts of names that make an assigned literal a secret, with their weight
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "api_key": 1.0, "private_key": 1.0, "privatekey": 1.0, "access_key": 1.0, "accesskey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "signing_key": 0.9, "encryption_key": 0.9, "client_secret": 1.0,
    "connection_string": 0.7, "session_key": 0.9, "license_key": 0.7,
}
#: values that stand for a secret without being one
PLACEHOLDERS = re.compile(
    r"(?i)^(?:x+|\*+|\.+|-+|(?:your|my|some|the)[_-]?\w*|change[_-]?me|placeholder|example\w*|dummy|none|null|nil|true|"
    r"false|undefined|todo|test|password|secret|token|default|\$\{?.*|%\(.*|<.*|\{\{.*)$")
THRESHOLD = 0.75
MIN_LITERAL = 8

_LEX = re.compile(
    r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')"""
    r"""|(?P<tag><(?P<tagname>[A-Za-z_][\w.-]*)>(?P<tagtext>[^<>\n]+)</(?P=tagname)>)"""
    r"""|(?P<bind>:=|=>|==|!=|<=|>=|=|:)"""
    r"""|(?P<flag>--[A-Za-z][\w-]*)"""
    r"""|(?P<name>[A-Za-z_$][\w$.-]*)"""
    r"""|(?P<plus>\+)"""
    r"""|(?P<bare>[A-Za-z0-9+/_.~!@#%^&*-][^\s"',;<>(){}\[\]]*)"""
    r"""|(?P<end>[;,\n])""")
_LITERAL_END = re.compile(r"""[^\s"',;<>(){}\[\]]+""")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base patterns' spans, failing matches dropped without a retry."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def sensitivity(name: str) -> float:
    """The weight of the most sensitive part of a name, camel case split."""
    flat = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip("-$\"'")).lower()
    parts = [p for p in re.split(r"[^a-z0-9]+", flat) if p]
    joined = {*parts, *("_".join(parts[i:i + 2]) for i in range(len(parts) - 1))}
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


def strength(value: str) -> float:
    """How much a literal looks like key material: length, mixed classes and
    the entropy of its characters; 0 for placeholders and prose."""
    return _strength(len(value), Counter(value), value)


#: of a joined value its length, its characters' counts and this much of its
#: beginning are kept, so that long and doubled values cost no more than others
_HEAD = 64


def _strength(n: int, chars: dict[str, int], head: str) -> float:
    if n < MIN_LITERAL or any(c.isspace() for c in chars):
        return 0.0
    # beyond the head, a placeholder only depends on which characters there are
    if PLACEHOLDERS.match(head if n == len(head) else head + "".join(chars)):
        return 0.0
    entropy = -sum(k / n * math.log2(k / n) for k in chars.values())
    classes = sum((any(c.islower() for c in chars), any(c.isupper() for c in chars),
                   any(c.isdigit() for c in chars), any(not c.isalnum() for c in chars)))
    return min(1.0, 0.35 * entropy / 3 + 0.2 * classes + 0.25 * (min(n, 16) / 16))


def _joined(parts: list[tuple[int, dict[str, int], str]]) -> tuple[int, dict[str, int], str]:
    """Length, counts and head of the values of ``parts`` joined."""
    if len(parts) == 1:
        return parts[0]
    n, chars, head = 0, Counter(), ""
    for m, more, begin in parts:
        if n == len(head):
            head = (head + begin)[:max(_HEAD, n)] if n + m > _HEAD else head + begin
        n += m
        for c, k in more.items():
            chars[c] += k
    if n >> 200:  # doubled over and over: only the shares count
        chars = {c: max(1, k >> 100) for c, k in chars.items()}
        n = sum(chars.values())
    return n, chars, head


def _logical_lines(text: str) -> Iterator[tuple[str, int]]:
    """Lines with their starts; a line goes on where it ends with an operator
    or an open bracket, the next one begins with a plus or, inside a bracket
    opened by a binding, with a string."""
    lines = text.split("\n")
    i = at = 0
    while i < len(lines):
        j, inside = i, False
        while j + 1 < len(lines):
            tail, head = lines[j].rstrip(), lines[j + 1].lstrip()
            inside = inside and ")" not in tail or tail.endswith("(")
            if not (tail.endswith(("+", "=", ":", "=>", "\\", "(")) or head.startswith("+")
                    or inside and head.startswith(("\"", "'")) or j > i and not tail):
                break
            j += 1
        chunk = "\n".join(lines[i:j + 1])
        yield chunk, at
        at += len(chunk) + 1
        i = j + 1


def _over_breaks(tokens: list, j: int, kinds: tuple[str, ...]) -> int:
    """The token after line breaks at ``j`` if a value can go on with it: one
    of ``kinds`` that is not the name of a binding of its own; else ``j``."""
    k = j
    while k < len(tokens) and tokens[k][0] == "end" and tokens[k][1].group() == "\n":
        k += 1
    if k == j or k >= len(tokens) or tokens[k][0] not in kinds:
        return j
    after = k + 1 if tokens[k][0] != "plus" else k + 2
    return j if after < len(tokens) and tokens[after][0] == "bind" else k


def _statements(line: str, at: int) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """``(name, terms)`` of each binding in a line; a term is ``(kind, text,
    start, end)`` with kind ``literal`` or ``name``."""
    tokens = []
    pos = 0
    while pos < len(line):
        m = _LEX.match(line, pos)
        if m is None:
            pos += 1
            continue
        tokens.append((m.lastgroup if m.lastgroup not in ("tagname", "tagtext") else "tag", m))
        pos = m.end()
    i = 0
    while i < len(tokens):
        kind, m = tokens[i]
        if m.group("tag"):
            yield m.group("tagname"), [("literal", m.group("tagtext"), at + m.start("tagtext"), at + m.end("tagtext"))]
        nxt = tokens[i + 1] if i + 1 < len(tokens) else None
        binds = nxt is not None and nxt[0] == "bind" and nxt[1].group() in (":=", "=>", "=", ":")
        if kind in ("name", "string") and binds or kind == "flag":
            name = m.group().strip("\"'")
            j, terms = i + (2 if binds else 1), []
            # ``name: type = value`` binds the name, not the type
            if j + 1 < len(tokens) and tokens[j][0] == "name" and tokens[j + 1][0] == "bind" and tokens[j + 1][1].group() == "=":
                j += 2
            if binds:
                j = _over_breaks(tokens, j, ("string", "name"))
            first = j
            while j < len(tokens):
                k, t = tokens[j]
                start, end = at + t.start(), at + t.end()
                if k == "string":
                    terms.append(("literal", t.group()[1:-1], start + 1, end - 1))
                elif k == "name" and t.group() not in ("new", "const", "str"):
                    rest = _LITERAL_END.match(line, t.start())
                    if rest.end() > t.end():  # a bare value that begins like a name
                        terms.append(("literal", rest.group(), start, at + rest.end()))
                        while j + 1 < len(tokens) and tokens[j + 1][1].start() < rest.end():
                            j += 1
                    else:
                        terms.append(("name", t.group(), start, end))
                elif k == "bare":
                    terms.append(("literal", t.group(), start, end))
                    while j + 1 < len(tokens) and tokens[j + 1][1].start() < t.end():
                        j += 1
                else:
                    break
                j += 1
                n = _over_breaks(tokens, j, ("plus",))
                if n < len(tokens) and tokens[n][0] == "plus":
                    j = _over_breaks(tokens, n + 1, ("string", "name", "bare"))
                    continue
                # strings side by side in a bracket are one value
                n = _over_breaks(tokens, j, ("string",))
                if (k == "string" and binds and n < len(tokens) and tokens[n][0] == "string"
                        and "(" in line[tokens[i + 1][1].end():tokens[first][1].start()]
                        and not line[t.end():tokens[n][1].start()].strip()):
                    j = n
                    continue
                break
            if terms and not (first > i + 2 and len(terms) == 1 and terms[0][0] == "name" and "\n" in line[m.end():terms[0][2] - at]):
                yield name, terms
            elif terms:
                yield name, [("far", *terms[0][1:])]
            i = max(j - 1, i) if kind == "flag" else max(j, i + 1)
            continue
        i += 1


def lexed_spans(text: str) -> list[tuple[str, int, int]]:
    """Literals that reach a sensitive name, as ``assign`` spans."""
    pending: list[tuple[str, list[tuple[str, str, int, int]]]] = []
    for line, at in _logical_lines(text):
        if "=" in line or ":" in line or "--" in line or "</" in line:
            pending += _statements(line, at)
    defs = _definitions(pending)
    # the most sensitive name that each name flows into, through all of its uses
    weights = {name: sensitivity(name) for name, _ in pending}
    feeds: dict[str, set[str]] = defaultdict(set)
    for name, terms in pending:
        feeds[name].update(v for k, v, *_ in terms if k != "literal")
    work = [name for name, w in weights.items() if w]
    while work:
        name = work.pop()
        for v in feeds.get(name, ()):
            if weights.get(v, 0.0) < weights[name]:
                weights[v] = weights[name]
                work.append(v)
    best: dict[tuple[int, int], float] = {}
    scored = []
    for i, (name, terms) in enumerate(pending):
        if not weights[name]:
            continue
        if len(terms) > 1 or terms[0][0] == "literal":
            scored.append(i)
        elif terms[0][0] == "name" and terms[0][1] not in defs and any(c.isdigit() for c in terms[0][1]):
            # a lone word after a sensitive word is prose unless it has digits;
            # definitions of a name are scored themselves
            _, word, s, e = terms[0]
            power = strength(word)
            best[s, e] = max(best.get((s, e), 0.0), sensitivity(name) * (0.4 + 0.6 * power) if power else 0.0)
    order, operands, values = _expanded(pending, defs, scored)
    score = dict.fromkeys(order, 0.0)
    for i in scored:
        power = _strength(*values[i])
        score[i] = weights[pending[i][0]] * (0.4 + 0.6 * power) if power else 0.0
    for i in reversed(order):  # a part scores as the best value that it is in
        for d in operands[i]:
            score[d] = max(score[d], score[i])
        for k, _, s, e in pending[i][1]:
            if k == "literal" and e > s:
                best[s, e] = max(best.get((s, e), 0.0), score[i])
    return [("assign", s, e) for (s, e), x in best.items() if x >= THRESHOLD]


def _definitions(pending: list) -> dict[str, list[int]]:
    """For each name, in order, its bindings that a literal reaches."""
    uses: dict[str, list[int]] = defaultdict(list)
    for i, (_, terms) in enumerate(pending):
        for k, v, *_ in terms:
            if k != "literal":
                uses[v].append(i)
    reached = [any(k == "literal" for k, *_ in terms) for _, terms in pending]
    work, names = [i for i, r in enumerate(reached) if r], set()
    while work:
        name = pending[work.pop()][0]
        if name in names:
            continue
        names.add(name)
        for i in uses.get(name, ()):
            if not reached[i]:
                reached[i] = True
                work.append(i)
    out: dict[str, list[int]] = defaultdict(list)
    for i, (name, _) in enumerate(pending):
        if reached[i]:
            out[name].append(i)
    return dict(out)


def _expanded(pending: list, defs: dict[str, list[int]], roots: list[int]) -> tuple[list[int], dict, dict]:
    """The bindings that the values of ``roots`` are made of, operands first,
    with their operands and values. A name stands for its definition in force
    there, or else for its first one; a definition by itself adds nothing."""
    order: list[int] = []
    operands: dict[int, list[int]] = {}
    values: dict[int, tuple[int, dict[str, int], str]] = {}
    for root in roots:
        stack = [] if root in operands else [root]
        while stack:
            i = stack[-1]
            if i not in operands:
                operands[i] = []
                for k, v, *_ in pending[i][1]:
                    if k != "literal" and v in defs:
                        d = defs[v][max(0, bisect_left(defs[v], i) - 1)]
                        if d not in operands or d in values:
                            operands[i].append(d)
                stack += [d for d in operands[i] if d not in operands]
                continue
            stack.pop()
            if i in values:
                continue
            operands[i] = [d for d in operands[i] if d in values]
            parts, mine = [], set(operands[i])
            for k, v, *_ in pending[i][1]:
                if k == "literal":
                    parts.append((len(v), Counter(v), v))
                elif v in defs and (d := defs[v][max(0, bisect_left(defs[v], i) - 1)]) in mine:
                    parts.append(values[d])
            values[i] = _joined(parts) if parts else (0, {}, "")
            order.append(i)
    return order, operands, values


def find_spans(text: str) -> tuple[list, list]:
    """Base spans and all spans, ordered by start, then kind."""
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    base = sorted(base_spans(text), key=order)
    added = []
    if ("=" in text or ":" in text or "--" in text or "</" in text) and _names_any(text):
        covered = Taken([(s, e) for _, s, e in base])
        # what a base span already holds is not reported twice
        added = [x for x in lexed_spans(text) if not covered.meets(x[1], x[2])]
    return base, sorted(base + added, key=order)


_STEMS = sorted({p.split("_")[0][:4] for p in SENSITIVE})


def _names_any(text: str) -> bool:
    """Whether any sensitive name can occur at all (exact: every sensitive
    name holds one of these stems)."""
    low = text.lower()
    return any(s in low for s in _STEMS)


def _join(spans: list) -> str:
    return ",".join([f"{k}:{s}:{e}" for k, s, e in spans])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` per row; the
    counts and the hash cover the base spans, ``spans`` holds all.

    Defined cases: NULL and empty texts have no spans (empty string, hash of
    the empty string); repeated rows get equal answers; ids may be NULL;
    spans that start together come by kind, then end; a text of any length is
    scanned whole, in time that grows with its length and spans; offsets are
    code points, ends exclusive; an empty table gives an empty result; other
    columns, whatever their names, are ignored.
    """
    source = key_text(docs, id_col, text_col)
    python_stage(docs.sparkSession)
    schema = T.StructType([source.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t.as_py()) for t in batch.column(1)]
            counts = [Counter(k for k, _, _ in base) for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([c[k] for c in counts], pa.int64()) for k in KINDS],
                 pa.array([hashlib.sha256(_join(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([_join(every) for _, every in found], pa.string())], schema.names)

    return source.mapInArrow(run, schema)


def op4_secret_scan(docs: DataFrame) -> DataFrame:
    """The contract's digest: :func:`scan`."""
    return scan(docs)
