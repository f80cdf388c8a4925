import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, documents, empty, texts

from tidemark.llm import pii, secrets
from tidemark.llm import token_counts as C
from tidemark.llm.queries import LLM_QUERIES
from tidemark.llm.tagger import WINDOW, Tagger, cut, encode, window_starts


def _luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        c = int(c)
        t += c if i % 2 == 0 else (2 * c if c < 5 else 2 * c - 9)
    return t % 10 == 0


def _plain_pii(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def _plain_secrets(t):
    out = [("assign", *m.span()) for m in re.finditer(
        r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t)
        if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


_PII_TEXT = st.text(alphabet="ab.@+-_% ()0125789\né", max_size=60)
_SECRET_TEXT = st.lists(st.sampled_from(["token", "PASSWORD", "api_key", "apikey", "secret", " ", "=", ":", '"', "'", "AKIA",
                                         "ABCDEF0123456789", "0123456789abcdef", "x", ".", "ſ", "K", "é", "\n"]),
                        max_size=12).map("".join)


@settings(max_examples=600, deadline=None)
@given(_PII_TEXT)
def test_base_pii_is_what_the_patterns_find(t):
    assert pii.base_spans(t) == _plain_pii(t)


@settings(max_examples=600, deadline=None)
@given(_SECRET_TEXT)
def test_base_secrets_are_what_the_patterns_find(t):
    base, every = secrets.find_spans(t)
    assert base == _plain_secrets(t)
    assert set(base) <= set(every)


def _digest(rows, docs, plain, kinds):
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = plain(docs[r.doc_id] or "")
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(b[0] == k for b in base) for k in kinds]
        every = r.spans.split(",") if r.spans else []
        assert set(text.split(",") if text else []) <= set(every)
        order = [(int(x.split(":")[1]), kinds.index(x.split(":")[0])) for x in every]
        assert order == sorted(order)


def test_secret_query(spark):
    _digest(LLM_QUERIES["op4_secret_scan"](spark, SF).collect(), texts(spark), _plain_secrets, secrets.KINDS)


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_pii_query(spark, tagger):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _digest(pii.scan(docs, tagger).collect(), texts(spark), _plain_pii, pii.KINDS)


def test_awkward_documents(spark, tagger):
    for out in (secrets.scan(documents(spark)), pii.scan(documents(spark), tagger)):
        assert out.count() == documents(spark).count()
        blank = out.where("doc_id in (3, 4, 5)").collect()
        assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in blank)
    assert secrets.scan(empty(spark)).count() == 0 and pii.scan(empty(spark), tagger).count() == 0
    row = pii.scan(documents(spark), tagger).where("doc_id = 14").head()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)


def test_tagger_trains_without_documents(spark):
    m = pii.train(empty(spark))
    assert pii.find_spans(m, ["call 212-555-0199 now", "no data here"])[1] == ([], [])


def test_tagger_finds_other_forms(tagger):
    rng, seen, hit = np.random.default_rng(123), 0, 0
    for _ in range(300):
        kind = pii.KINDS[int(rng.integers(4))]
        item = pii._item(kind, rng)
        text = f"and so the men of the town said {item} and then went on"
        if not pii.base_spans(text):
            (_, every), = pii.find_spans(tagger, [text])
            seen += 1
            hit += any(k == kind and s < 31 + len(item) and e > 31 for k, s, e in every)
    assert seen > 80 and hit / seen > 0.75


def _held_out_recall(model, words, n=200):
    """Exact recall per kind on generated items that no base pattern finds,
    at random places in prose."""
    rng, recall = np.random.default_rng(99), {}
    for kind in pii.KINDS:
        hit = seen = 0
        while seen < n:
            item = pii._item(kind, rng, words)
            prose = [words[int(rng.integers(len(words)))] for _ in range(24)]
            cut_at = int(rng.integers(2, 22))
            head = " ".join(prose[:cut_at]) + " "
            text = head + item + " " + " ".join(prose[cut_at:])
            if not pii.base_spans(text):
                seen += 1
                hit += (kind, len(head), len(head) + len(item)) in pii.find_spans(model, [text])[0][1]
        recall[kind] = hit / n
    return recall


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_held_out_recall_of_every_kind(spark, tagger, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    model = tagger if sf == "sf0.001" else pii.train(docs)
    prose = [r.text for r in docs.orderBy(docs.doc_id.desc()).limit(100).collect()]
    words = [w for t in prose for w in (t or "").split()[:200] if not pii.ANCHOR.search(w)]
    recall = _held_out_recall(model, words)
    assert all(r >= 0.95 for r in recall.values()), recall
    lead = "so the men went on to the far side of the town and then "
    for item, kind in (("4111.1111.1111.1111", "card"), ("bob.smith[at]example.org", "email"), ("bob [ at ] example.org", "email"),
                       ("bob (AT) example.org", "email"), ("(212) 555-0147", "phone"), ("10[.]20[.]30[.]123", "ip")):
        found = 0
        for shift in range(48):
            text = "x" * shift + " " + lead * 2 + item + " and so on " * 10
            at = shift + 1 + 2 * len(lead)
            found += (kind, at, at + len(item)) in pii.tagged_spans(model, [text])[0]
        assert found >= 45, (item, found)


def test_models_of_repeated_ids_and_rows(spark):
    """One id, or none, for all rows: the sample still holds many texts; a
    text on most rows is one of them; very long texts take part by a stretch."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    from pyspark.sql import functions as F

    taken = []

    class Kept(Exception):
        pass

    def keep(texts, rng):
        taken.append(sorted(texts))
        raise Kept

    odd = docs.withColumn("doc_id", F.lit(None).cast("bigint"))
    hot = spark.range(2_000).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit("call 212 555 0199 now").alias("text"))
    long = spark.createDataFrame([(77, "word " * 30_000 + "x 1 " * 30_000)], docs.schema)
    old, pii.labelled_windows = pii.labelled_windows, keep
    try:
        for d in (docs, odd, docs.unionByName(hot), docs.unionByName(long)):
            with pytest.raises(Kept):
                pii.train(d)
    finally:
        pii.labelled_windows = old
    base = set(taken[0])
    assert len(base) > 10 and len(set(taken[1])) == len(base)
    assert taken[2].count("call 212 555 0199 now") == 1 and base <= set(taken[2])
    assert max(map(len, taken[3])) <= pii.EXCERPT


@pytest.mark.parametrize("find, line", [
    (lambda t: secrets.find_spans(t), 'token = "Zx91!kkQ22pq"\npassword = abcDEF1234567\n'),
    (lambda t: pii.find_spans(Silent(), [t]), "mail bob@example.org or +1 212 555 0199\n")])
def test_span_dense_texts_take_time_in_proportion(find, line):
    import time

    def seconds(n):
        at = time.perf_counter()
        find(line * n)
        return time.perf_counter() - at

    seconds(500)
    assert seconds(24_000) < 24 * max(seconds(3_000), 0.05)  # eight times the text


class Silent:
    """A tagger that finds nothing, so that only base spans are merged."""

    first, kinds, allowed = np.ones(9, bool), pii.KINDS, np.ones((9, 9), bool)

    def max_marginals(self, x):
        out = np.full((*x.shape, 9), -1.0, np.float32)
        out[:, :, 0] = 0
        return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9))), st.integers(0, 50), st.integers(1, 9))
def test_taken_is_any_overlap(spans, start, size):
    from tidemark.llm.common import Taken

    spans = [(s, s + n) for s, n in spans]
    assert Taken(spans).meets(start, start + size) == any(s < start + size and start < e for s, e in spans)


def test_clean_text_gets_no_span(tagger):
    clean = ["Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "In 1984 he paid $45.10 at 10:30.",
             "the GNU General Public License, version 3.", "meet @bob at 5", "Order 12345 and 67890 came 2024-01-15"]
    assert all(not every for _, every in pii.find_spans(tagger, clean))


def test_skipped_windows_hold_no_span(spark, tagger):
    docs = [t for t in texts(spark).values()][:60]
    docs += ["x " * 200 + "bob@example.org " + "y " * 300 + "call (212) 555-0147 now", "z" * 500]
    assert pii.tagged_spans(tagger, docs) == pii.tagged_spans(tagger, docs, skip=False)


def test_windows_agree_with_one_stretch(tagger):
    """Max-marginals are 0 on each window's path, and a span that crosses the
    edge of a window comes back whole."""
    text = "word " * 17 + "4111 1111 1111 1111" + " word" * 30
    assert pii.base_spans(text) == [("card", 85, 104)]  # the first window ends at 96
    assert pii.tagged_spans(tagger, [text])[0] == [("card", 85, 104)]
    starts = window_starts(len(text))
    scores = tagger.max_marginals(cut(encode(text), starts))
    assert np.allclose(scores.max(2), 0) and scores.shape[:2] == (len(starts), WINDOW)


def test_long_stretch_is_decoded_as_one(tagger):
    """Over 512 windows without a break, with items set over every place near
    window 512 where a part may end or begin: spans are those of one part."""
    words = [f"note {i % 89} of the men went on, " for i in range(2_000)]
    head = "".join(words)
    for item, cut_at in (("mail 10[.]20[.]30[.]123 now", 16 + 5), ("call 0049 212 555 0147 now", 5 + 14)):
        for edge in (512 * 48, 508 * 48, 511 * 48 + 96):
            at = edge - cut_at
            text = head[:at - 1] + " " + item + " " + head[:9_000]
            assert not pii.base_spans(text)
            (got,) = pii.tagged_spans(tagger, [text])
            (one,) = pii.tagged_spans(tagger, [text], batch=10**6)
            assert got == one, (item, edge)
            (_, every), = pii.find_spans(tagger, [text])
            mine = [(s, e) for _, s, e in every if s < at + len(item) and e > at]
            assert mine == [(s, e) for _, s, e in one if s < at + len(item) and e > at]
            if item.startswith("mail"):
                assert mine == [(at + 5, at + 23)], edge
    small = head[:6_000] + "mail 10[.]20[.]30[.]123 now " + head[:3_000]
    assert all(pii.tagged_spans(tagger, [small, head[:500]], batch=b) == pii.tagged_spans(tagger, [small, head[:500]]) for b in (1, 2, 7))


def test_tagger_gradients():
    m = Tagger(("a", "b"))
    rng = np.random.default_rng(0)
    x = rng.integers(0, 90, (3, 12))
    y = np.zeros((3, 12), np.int64)
    y[0, 3:6], y[1, 2:4] = [1, 2, 2], [3, 4]
    _, g = m.gradients(x, y)
    for k, p in m.p.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), p.shape)
        old = p[at]
        p[at] = old + 1e-2
        up = m.gradients(x, y)[0]
        p[at] = old - 1e-2
        down = m.gradients(x, y)[0]
        p[at] = old
        assert abs((up - down) / 2e-2 - g[k][at]) < 0.02 * max(1, abs(g[k][at]))


@pytest.mark.parametrize("text, literal", [
    ('db_password = "Tr0ub4dor&3xyz"', "Tr0ub4dor&3xyz"),
    ('k = "a8F3kd93KQpz1x"\nclient_secret = k', "a8F3kd93KQpz1x"),
    ('a=b\nb="Qw3rTy8822zz"\nprivate_key=a', "Qw3rTy8822zz"),
    ("<auth_token>9fj38DKs83jfkd02</auth_token>", "9fj38DKs83jfkd02"),
    ("run --api-key 8fjK39dks02LQ", "8fjK39dks02LQ"),
    ('my_pwd: str = "hunter2hunter2!"', "hunter2hunter2!"),
    ('accessKey => "Zx81kQ0pLm22"', "Zx81kQ0pLm22"),
])
def test_lexed_secrets(text, literal):
    base, every = secrets.find_spans(text)
    assert not base and literal in [text[s:e] for _, s, e in every]


@pytest.mark.parametrize("text, literals", [
    # a chain of ten names, used before they are defined
    ("password = n9\n" + "".join(f"n{i} = n{i - 1}\n" for i in range(9, 0, -1)) + 'n0 = "Zx91!kkQ22pq"', ["Zx91!kkQ22pq"]),
    # an operand that is resolved later than the other
    ('a = "Qw3rTy"\nt = a + b\nb = c\nc = d\nd = "!!8822zzPq"\nsecret = t', ["Qw3rTy", "!!8822zzPq"]),
    # a name that is used again, on either side
    ('k = "Zx91!kkQ22pq"\npassword = k\nk = ""', ["Zx91!kkQ22pq"]),
    ('k = ""\npassword = k\nk = "Zx91!kkQ22pq"', ["Zx91!kkQ22pq"]),
    ('k = "Zx91!kkQ22pq"\nk = "Other-8Words9"\ntoken = k', ["Zx91!kkQ22pq", "Other-8Words9"]),
    # over line breaks
    ('my_pwd = "Zx91!k" + \\\n    "kQ22pq"', ["Zx91!k", "kQ22pq"]),
    ('my_pwd = (\n    "Zx91!k"\n    "kQ22pq"\n)', ["Zx91!k", "kQ22pq"]),
    ('my_pwd =\n    "Zx91!k"\n    + "kQ22pq"\nx = 1', ["Zx91!k", "kQ22pq"]),
    ('+my_pwd = "Zx91!kkQ22pq"\n+token = "Other-8!Words9"', ["Zx91!kkQ22pq", "Other-8!Words9"]),
])
def test_constants_reach_names_in_any_order(text, literals):
    _, every = secrets.find_spans(text)
    assert [text[s:e] for _, s, e in every] == sorted(literals, key=text.index)


def test_doubled_and_circular_constants_end():
    text = 'a0 = "Zx91!kkQ22pq"\n' + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(60)) + "password = a60\nx = y + 1\ny = x\nsecret = x"
    assert "Zx91!kkQ22pq" in [text[s:e] for _, s, e in secrets.find_spans(text)[1]]
    deep = "password = n5000\n" + "".join(f"n{i} = n{i - 1}\n" for i in range(5000, 0, -1)) + 'n0 = "Zx91!kkQ22pq"'
    assert "Zx91!kkQ22pq" in [deep[s:e] for _, s, e in secrets.find_spans(deep)[1]]


@pytest.mark.parametrize("text", ["password: changeme", "The token: sometimes words", "note: the password is fine",
                                  'title = "Tr0ub4dor&3xyz"', "password = ${DB_PASSWORD}", 'secret = "<your secret>"'])
def test_no_secret(text):
    assert secrets.find_spans(text) == ([], [])


# -- token counts -------------------------------------------------------------

def _greedy(word, first, rest):
    n = i = 0
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in (rest if i else first)), None)
        if j is None:
            return None
        i, n = j, n + 1
    return n


_PIECES = st.sets(st.text(alphabet="ab", min_size=1, max_size=6), max_size=8)


@settings(max_examples=400, deadline=None)
@given(_PIECES, _PIECES, st.lists(st.text(alphabet="abc", max_size=14), max_size=12))
def test_automaton_is_greedy(first, rest, words):
    count = C.Automaton(sorted(first), sorted(rest)).count
    for w in words:
        assert count(w) == _greedy(w, first, rest)


def test_token_count_query(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    from tokenizers.models import WordPiece

    first, rest = C.vocabulary(public_tokenizers.path(C.VOCABULARY))
    names = ["[UNK]", *dict.fromkeys([*first, *[f"##{r}" for r in rest]])]
    model = Tokenizer(WordPiece({w: i for i, w in enumerate(names)}, unk_token="[UNK]", max_input_chars_per_word=10 ** 9))
    docs = texts(spark)
    got = {r.doc_id: r for r in LLM_QUERIES["op6_token_counts"](spark, SF).collect()}
    assert set(got) == set(docs)
    for d in sorted(docs)[:60]:
        words = re.findall(r"\w+|[^\w\s]", docs[d])
        pieces = [model.encode(w).tokens for w in words]
        assert (got[d].n_words, got[d].n_tokens) == (len(words), sum(map(len, pieces)))
        assert got[d].n_unknown == sum(p == ["[UNK]"] for p in pieces)


def test_token_counts_of_awkward_documents(spark):
    out = C.token_counts(documents(spark))
    assert out.count() == documents(spark).count()
    assert all(tuple(r)[1:] == (0, 0, 0) for r in out.where("doc_id in (3, 4, 5, 16)").collect())
    assert C.token_counts(empty(spark)).count() == 0


def test_long_texts_are_counted_in_blocks():
    import public_tokenizers

    c = C.Counter(public_tokenizers.path(C.VOCABULARY))
    line = "some words, and_under " * 1000
    assert len(line) * 120 > 1 << 21
    assert c.totals(line * 120) == tuple(120 * x for x in c.totals(line))
