"""Personal data: base patterns plus a character tagger's spans.

The tagger (see ``tagger``) learns from labelled spans: texts of the corpus
with their base spans, and generated items in forms that the base patterns do
not know (other separators, no country code, bracketed signs), set into corpus
text. Every part of a text that can hold an item is covered by overlapping
windows; windows more than one window away from any anchor (a digit or an at
sign) are skipped, as a span without an anchor is no span by definition.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Taken, key_text, python_stage
from tidemark.llm.tagger import STRIDE, WINDOW, Stretch, Tagger, cut, encode, window_starts

#: fixed kinds and patterns of the contract
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: a match always begins at the start of a run of digits, hence the lookbehind
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

ANCHOR = re.compile(r"(?i)[0-9@]|[\[({] ?at ?[\])}]")
#: documented bounds of the labelled rows that the tagger learns from: texts,
#: characters of a text (of a longer one a stretch at a hashed place), windows
SAMPLE_DOCS, EXCERPT = 300, 20_000
TRAIN_WINDOWS = 2_800


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def _emails(text: str) -> list[tuple[str, int, int]]:
    """As the pattern finds them, but linear: every match has its own at sign."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns by start, then kind; failing matches are
    dropped without a retry."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return sorted(out, key=_order)


def _order(x: tuple[str, int, int]) -> tuple:
    return x[1], KINDS.index(x[0]), x[2]


_OCTETS = re.compile(r"^[0-9]{1,3}(?:\W{1,3}[0-9]{1,3}){3}$")
_HEXTETS = re.compile(r"^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}$")
_SPELT = re.compile(r"(?i)^[a-z0-9._%+-]+ ?(?:@|[\[({] ?at ?[\])}]) ?[a-z0-9-]+(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[a-z0-9-]+)+$")


def valid(kind: str, s: str) -> bool:
    """What a tagged span must hold to count: the parts of its kind, in any
    separators."""
    if kind == "email":
        return bool(_SPELT.match(s))
    if kind == "ip":
        if _OCTETS.match(s):
            return all(int(x) <= 255 for x in re.findall("[0-9]+", s))
        return bool(_HEXTETS.match(s)) and sum(c.isalnum() for c in s) >= 8
    if not all(c in "0123456789 ()+./-_" for c in s):
        return False
    d = _digits(s)
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return 10 <= len(d) <= 15 and any(c in " ().+-/" for c in s)


_GROUP_BEFORE, _GROUP_AFTER = re.compile(r"[0-9]{3}[ ./_-]?$"), re.compile(r"[ ./_-]?[0-9]{3}")


def _goes_on(text: str, s: int, e: int) -> bool:
    """Whether a group of digits touches the span: it is part of a longer number."""
    return bool(_GROUP_BEFORE.search(text[max(0, s - 4):s]) or _GROUP_AFTER.match(text[e:e + 4]))


# -- labelled spans -----------------------------------------------------------

_FILLER = ("and", "the", "with", "call", "mail", "from", "note", "order", "see", "of", "und", "de", "la", "que", "le")


def _item(kind: str, rng: np.random.Generator, words: list[str] = _FILLER) -> str:
    """An item of the kind in one of many forms; names are random letters or
    made of ``words``."""
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]

    def word(a: int, b: int) -> str:
        known = "".join([c for c in words[int(rng.integers(len(words)))].lower() if "a" <= c <= "z"])[:b + 3]
        if len(known) >= a and rng.random() < 0.5:
            return known
        return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(a, b))))

    if kind == "email":
        user = word(2, 9) + pick("", "." + word(2, 7), "." + n(2), n(2), "_" + word(2, 5))
        host = pick(word(3, 9), word(3, 9), "example", "mail") + pick("", "", n(1), "." + word(3, 8), "-" + word(2, 6))
        top = pick("com", "org", "net", "de", "fr", "es", "io", "co.uk", "edu")
        left, right = pick("[]", "()", "{}", "[]")
        at = left + pick("", "", " ") + pick("at", "at", "AT")
        at += (" " if " " in at else "") + right
        dot = left + pick("dot", "dot", "DOT") + right
        return pick(f"{user}@{host}.{top}", f"{user}@{host}.example.{top}", f"{user}{at}{host}.{top}", f"{user}{at}{host}.example.{top}",
                    f"{user}{at}{host}{dot}{top}", f"{user} @ {host}.{top}", f"{user} {at} {host} {dot} {top}",
                    f"{user} {at} {host}.{top}", f"{user} {at} {host}.example.{top}")
    if kind == "ip":
        parts = [str(int(x)) for x in rng.integers(0, 256, 4)]
        if rng.random() < 0.25:
            return ":".join(f"{int(x):x}" for x in rng.integers(256, 65536, 8))
        return pick(".", ".", ".", "[.]", "(.)").join(parts)
    if kind == "card":
        groups = pick((4, 4, 4, 4), (4, 4, 4, 4), (4, 4, 4, 4), (4, 6, 5))
        d = str(int(rng.integers(1, 10))) + n(sum(groups) - 2)
        d += next(c for c in "0123456789" if luhn(d + c))
        ends = np.cumsum(groups).tolist()
        return pick("", " ", "-", ".", "_", "/", ".", " ").join([d[s:e] for s, e in zip([0, *ends], ends)])
    a, b, c = n(3), n(3), n(4)
    return pick(f"+{pick('1', '44', '49', '33')} ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}",
                f"{a}.{b}.{c}", f"+49 {n(2)} {n(7)}", f"00{pick('1', '44', '49')} {a} {b} {c}", f"({a}) {b} {c}")


def _decoy(rng: np.random.Generator) -> str:
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    hexes = "".join("0123456789abcdef"[int(c)] for c in rng.integers(0, 16, 40))
    return pick(f'token = "{hexes}"', "Version 2.0", "CC BY-NC 4.0", "version 3", f"20{n(2)}-0{1 + int(rng.integers(9))}-1{n(1)}",
                f"{n(2)}:{n(2)}", f"${n(2)}.{n(2)}", n(2), n(4), n(6), f"v{n(1)}.{n(1)}.{n(1)}", f"#{n(5)}", f"{n(1)}.{n(3)},{n(2)}",
                f"{n(2)}/{n(2)}/{n(4)}", f"@{_FILLER[int(rng.integers(len(_FILLER)))]}", f"{n(3)} - {n(3)}", f"AKIA{n(4)}XQ{n(6)}")


def _tags(n: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    y = np.zeros(n, np.int64)
    for kind, s, e in spans:
        k = 1 + 2 * KINDS.index(kind)
        y[s], y[s + 1:e] = k, k + 1
    return y


def labelled_windows(texts: list[str], rng: np.random.Generator, windows: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Training windows with their tags: half around the texts' own digits and
    at signs with their base spans, half with generated items and decoys set
    between words of the texts."""
    x, y = [], []

    def add(text: str, spans: list[tuple[str, int, int]], at: int) -> None:
        start = max(0, min(at, len(text) - WINDOW))
        whole = [(k, max(s, start) - start, min(e, start + WINDOW) - start) for k, s, e in spans if s < start + WINDOW and e > start]
        tags = np.zeros(WINDOW, np.int64)
        part = text[start:start + WINDOW]
        tags[:len(part)] = _tags(len(part), whole)
        for k, s, e in spans:  # a span that begins before the window goes on inside it
            if s < start < e:
                tags[0] = 2 + 2 * KINDS.index(k)
        x.append(cut(encode(part), np.zeros(1, np.int64))[0])
        y.append(tags)

    anchored = [t for t in texts if ANCHOR.search(t)]
    while anchored and len(x) < windows // 2:
        text = anchored[int(rng.integers(len(anchored)))]
        anchors = [m.start() for m in ANCHOR.finditer(text)]
        at = anchors[int(rng.integers(len(anchors)))]
        spans, last = [], -1
        for k, s, e in base_spans(text):  # one kind a character
            if s >= last:
                spans.append((k, s, e))
                last = e
        add(text, spans, at - int(rng.integers(8, WINDOW - 8)))
    words = [w for t in texts[:100] for w in t.split()[:200] if not ANCHOR.search(w)] or list(_FILLER)
    while len(x) < windows:
        pieces, spans, at = [], [], 0
        for _ in range(int(rng.integers(10, 22))):
            r = rng.random()
            kind = KINDS[int(rng.integers(4))]
            piece = _item(kind, rng, words) if r < 0.16 else _decoy(rng) if r < 0.3 else words[int(rng.integers(len(words)))]
            if r < 0.16:
                spans.append((kind, at, at + len(piece)))
                tail = rng.random()
                piece += "," if tail < 0.1 else "." if tail < 0.2 else "###" if tail < 0.24 else ""
            pieces.append(piece)
            at += len(piece) + 1
        add("\n".join([" ".join(pieces)]), spans, int(rng.integers(0, max(1, at - WINDOW))))
    return np.array(x), np.array(y)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger:
    """Learns from at most SAMPLE_DOCS texts that hold an anchor (picked by
    the hash of id and text, a repeated row once) and TRAIN_WINDOWS windows."""
    t = key_text(docs, id_col, text_col)
    n, u = F.length("text"), F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("sample"))
    part = F.substring(F.col("text"), F.pmod(u, F.greatest(n - EXCERPT, F.lit(1))).cast("int") + 1, F.lit(EXCERPT))
    t = t.select(u.alias("u"), F.when(n > EXCERPT, part).otherwise(F.col("text")).alias("text"))
    t = t.where(F.col("text").rlike(ANCHOR.pattern))
    # only about twice the sample leaves the tasks
    share = min(1.0, 2 * SAMPLE_DOCS / max(1, t.agg(F.approx_count_distinct("u")).first()[0]))
    near = t.where(F.pmod(F.col("u"), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["u"])
    picked = near.orderBy("u", "text").limit(SAMPLE_DOCS)
    texts = [r.text for r in picked.collect()]  # at most SAMPLE_DOCS texts of bounded length
    rng = np.random.default_rng(11)
    model = Tagger(KINDS)
    model.fit(*labelled_windows(texts, rng))
    return model


def tagged_spans(model: Tagger, texts: list[str], batch: int = 512, skip: bool = True) -> list[list[tuple[str, int, int]]]:
    """The tagger's spans of whole texts, valid ones with an anchor only.
    ``skip=False`` also decodes the windows that cannot hold one. Windows are
    scored ``batch`` at a time; a longer stretch is decoded as one all the same."""
    jobs: list[tuple[int, np.ndarray, bool, bool]] = []
    for i, text in enumerate(texts):
        starts = window_starts(len(text))
        if skip:
            hot = np.zeros(len(starts) + 4, bool)
            for m in ANCHOR.finditer(text):
                k = m.start() // STRIDE  # in windows k - 1 and k, and their neighbours
                hot[max(0, min(k, len(starts) - 1) - 2):min(k, len(starts) - 1) + 2] = True
            chosen = np.nonzero(hot[:len(starts)])[0]
        else:
            chosen = np.arange(len(starts)) if text else np.zeros(0, np.int64)
        if len(chosen):
            for run in np.split(chosen, np.nonzero(np.diff(chosen) > 1)[0] + 1):
                for at in range(0, len(run), batch):
                    jobs.append((i, starts[run[at:at + batch]], not at, at + batch >= len(run)))
    found: list[dict] = [{} for _ in texts]
    codes: dict[int, np.ndarray] = {}
    stretch = None
    at = 0
    while at < len(jobs):
        end, size = at, 0
        while end < len(jobs) and (end == at or size + len(jobs[end][1]) <= 2 * batch):
            size += len(jobs[end][1])
            end += 1
        part = []
        for i, starts, *_ in jobs[at:end]:
            if i not in codes:
                codes = {i: encode(texts[i])}
            part.append(cut(codes[i], starts))
        scores = model.max_marginals(np.concatenate(part))
        row = 0
        for i, starts, opens, closes in jobs[at:end]:
            if opens:
                stretch = Stretch(model, int(starts[0]), len(texts[i]))
            stretch.feed(starts, scores[row:row + len(starts)], closes)
            row += len(starts)
            for k, s, e in stretch.spans() if closes else ():
                piece = texts[i][s:e]
                while e > s and not (piece[-1].isalnum() or piece[-1] in ")]}"):
                    e -= 1
                    piece = texts[i][s:e]
                if e > s and ANCHOR.search(piece) and valid(k, piece) and not (k == "phone" and _goes_on(texts[i], s, e)):
                    found[i][k, s, e] = None
        at = end
    return [list(f) for f in found]


def find_spans(model: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    """Base spans and all spans of each text; a tagged span is added where it
    meets no base span."""
    out = []
    for text, tagged in zip(texts, tagged_spans(model, texts)):
        base = base_spans(text)
        taken = Taken([(s, e) for _, s, e in base])
        added, last = [], -1
        for k, s, e in sorted(tagged, key=_order):
            if s >= last and not taken.meets(s, e):
                added.append((k, s, e))
                last = e
        out.append((base, sorted(base + added, key=_order)))
    return out


def _join(spans: list) -> str:
    return ",".join([f"{k}:{s}:{e}" for k, s, e in spans])


def scan(docs: DataFrame, model: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row;
    the counts and the hash cover the base spans, ``spans`` holds all.

    Defined cases: NULL and empty texts have no spans (empty string, hash of
    the empty string); repeated rows get equal answers; ids may be NULL;
    spans that start together come by kind, then end, and of tagged spans that
    overlap the first stays; a text of any length is read whole, in time that
    grows with its length and spans; offsets are code points, ends exclusive;
    an empty table gives an empty result (the tagger then learns from
    generated items alone); other columns, whatever their names, are ignored.
    """
    source = key_text(docs, id_col, text_col)
    spark = docs.sparkSession
    python_stage(spark)
    schema = T.StructType([source.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    shared = spark.sparkContext.broadcast(model)  # some ten thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = find_spans(shared.value, part.column(1).to_pylist())
                counts = [Counter(k for k, _, _ in base) for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array([c[k] for c in counts], pa.int64()) for k in KINDS],
                     pa.array([hashlib.sha256(_join(base).encode()).hexdigest() for base, _ in found], pa.string()),
                     pa.array([_join(every) for _, every in found], pa.string())], schema.names)

    return source.mapInArrow(run, schema)


def op2_pii(docs: DataFrame) -> DataFrame:
    """The contract's digest: :func:`scan` with a tagger trained here."""
    return scan(docs, train(docs))
