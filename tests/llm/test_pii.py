import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tablesync.llm import pii
from tablesync.llm.queries import QUERIES

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(text):
    digits = [int(c) for c in text if c in "0123456789"][::-1]
    return sum(digits[0::2] + [sum(divmod(2 * d, 10)) for d in digits[1::2]]) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = sum(c in "0123456789" for c in m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 14 <= digits <= 19 and luhn(m[0])
                    or kind == "phone" and 10 <= digits <= 15):
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PIECES = ["a", "Z9", "@", ".", "-", "_", "+", " ", "  ", "(", ")", "1", "0", "255", "256", "4111111111111111", "12345678901234", "é", "\n", "%", "x@y.z", "1.2.3.4", "+1 (017) 555-7713", "٣"]


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_pattern_matches(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_cost_little():
    for text in ("a" * 300_000, "a" * 300_000 + "@b.c", "1" * 300_000, "1." * 200_000, "@" * 200_000, "+1" * 100_000, "1 " * 200_000, "a@" * 150_000, "a@b" * 100_000):
        pii.base_spans(text)
        pii.PiiModel({"card bias": 1.0}).spans(text)
    assert pii.base_spans("a" * 1000 + "@b.cc") == [("email", 0, 1005)]


CARD, PHONE = "4111 1111 1111 1111", "+1 (487) 555-7209"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        head = number(15)
        return next(head + c for c in "0123456789" if luhn(head + c))

    rows = []
    for i in range(400):
        parts = [rng.choice(["call", "the", "and", "see", "of", "on"]) for _ in range(8)]
        parts.insert(rng.randrange(8), rng.choice([card(), f"+1 ({number(3)}) 555-{number(4)}", f"{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}.7",
                                                   f"ann.{number(2)}@mail.example.com", next(n for n in iter(lambda: number(16), None) if not luhn(n)), number(4), "3.14", "a@b"]))
        rows.append((i, " ".join(parts), "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, base string")


@pytest.fixture(scope="module")
def model(docs):
    return pii.learn_pii(docs)


def test_spans_that_the_patterns_lose(model):
    """Neighbours that run together: the joint choice of boundaries and types takes them apart."""
    cards = "see 4111111111111111 5500005555555559 on"
    assert pii.base_spans(cards) == []
    assert model.spans(cards)[1] == [("card", 4, 20), ("card", 21, 37)]
    mixed = f"see {PHONE} 190.137.223.20 on"
    base, added = model.spans(mixed)
    assert base == [("ip", 22, 36)] and added == [("phone", 4, 21)]
    for clean in ("of 1234567890123456 and", "3.14 of 2718", "the 2024-01-05 10:11:12 on", "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "a @ b", "v1.2.3"):
        assert model.spans(clean) == ([], [])


def test_added_spans_touch_no_pattern_match(docs, model):
    for r in docs.collect():
        base, added = model.spans(r["text"])
        assert base == plain(r["text"]) and added == []


def test_decoding_finds_the_best_labelling():
    rng = random.Random(4)
    text = "12345678901234 1234567890 12.34.56.78 555 12345"
    sort, _, atoms = next(z for z in pii.zones(text))
    segments = list(pii.candidates(text, sort, atoms))
    for _ in range(60):
        model = pii.PiiModel({f: rng.gauss(0, 1) for *_, names in segments for f in names})
        best = 0.0
        for r in range(4):
            for chosen in itertools.combinations(segments, r):
                if all(a[1] <= b[0] or b[1] <= a[0] for a, b in itertools.combinations(chosen, 2)):
                    best = max(best, sum(model.score(names) for *_, names in chosen))
        got = model.decode(text, sort, atoms)
        scores = {(kind, *pii._segment(text, atoms, i, j)): model.score(names) for i, j, kind, names in segments}
        assert sum(scores[s] for s in got) == pytest.approx(best)
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:]))


def test_training_raises_the_likelihood_of_the_labels():
    """Against the likelihood by all labellings, one by one."""
    segments = [(0, 1, ["a"]), (0, 2, ["b"]), (1, 2, ["a", "c"]), (2, 3, ["c"])]

    def likelihood(weights, true):
        total, own = 0.0, None
        for r in range(4):
            for chosen in itertools.combinations(range(4), r):
                if all(segments[p][1] <= segments[q][0] or segments[q][1] <= segments[p][0] for p, q in itertools.combinations(chosen, 2)):
                    score = math.exp(sum(weights[f] for k in chosen for f in segments[k][2]))
                    total += score
                    own = score if set(chosen) == true else own
        return math.log(own / total)

    true = {1, 3}
    start = likelihood(dict.fromkeys("abc", 0.0), true)
    fitted = pii.fit([(3, segments, true)] * 3, rounds=80, decay=0.0).weights
    assert likelihood(fitted, true) > start + 0.5
    # the gradient vanishes only where no small change helps
    step = 1e-3
    ups = [likelihood({**fitted, f: fitted[f] + step}, true) - likelihood(fitted, true) for f in "abc"]
    assert np.abs(ups).max() < 1e-3


def test_defined_results(spark, docs, model):
    odd = [(1, None), (2, ""), (None, f"x {CARD}"), (3, f"x {CARD}"), (3, f"x {CARD}"), (4, f"é日😀 {CARD} " + "long " * 300_000 + PHONE)]
    df = spark.createDataFrame([(*r, "x") for r in odd], "doc_id long, text string, added string")
    rows = pii.find_pii(df, model).collect()
    assert [r["base"] for r in rows[:2]] == [[], []]
    assert [tuple(s) for s in rows[2]["base"]] == [("card", 2, 21)] and rows[3] == rows[4]
    assert [tuple(s) for s in rows[5]["base"]] == [("card", 4, 23), ("phone", 24 + 1_500_000, 24 + 1_500_000 + len(PHONE))]
    assert pii.find_pii(df.limit(0), model).collect() == []
    assert pii.learn_pii(df.limit(0)).spans(f"x {CARD}") == ([("card", 2, 21)], [])


def test_redaction(spark, model):
    assert pii.redact(f"a {CARD}, {PHONE}!", model) == "a [CARD], [PHONE]!"
    assert pii.redact(None, model) is None and pii.redact("", model) == "" and pii.redact("plain", model) == "plain"
    assert pii.redact("+1.2.3.4 5.6.7.8.9", model) == "+[IP] [IP].9"
    assert pii.redact("x 1.2.3.4@b.cc 1.2.3.4", model) == "x [EMAIL] [IP]"  # of overlapping spans the longest at a place counts
    df = spark.createDataFrame([(1, f"to {PHONE}", None), (2, None, 3)], "doc_id long, text string, n_chars long")
    out = pii.redact_texts(df, model)
    assert out.schema == df.schema and [tuple(r) for r in out.collect()] == [(1, "to [PHONE]", None), (2, None, 3)]


def test_runs_of_any_length_are_read_once(model):
    runs = ("+" * 10 ** 6, "(" * 10 ** 6, "(+" * 500_000, "x" * 10 ** 6, "x" * 10 ** 6 + "@")
    with_zones = ("a@" * 500_000, "1" + "(" * 10 ** 6 + "2345678901234 5", "+1 (" * 250_000)  # up to 250,000 zones to decode
    for seconds, texts in ((1, runs), (20, with_zones)):
        for text in texts:
            start = time.perf_counter()
            pii.redact(text, model)
            assert time.perf_counter() - start < seconds, text[:20]


def test_zones_are_those_of_the_plain_patterns():
    rng = random.Random(8)
    for _ in range(2000):
        text = "".join(rng.choice("+((1 2.-)ax@") for _ in range(rng.randint(1, 30)))
        plain_zones = [m.span() for m in re.finditer(r"[+(]*[0-9][0-9 ().+-]*", text)]
        assert [m.span() for m in pii._ZONE.finditer(text)] == plain_zones
        assert [m.span() for m in pii._WORD_AT.finditer(text)] == [m.span() for m in re.finditer(r"[^\s@()]+@[^\s@()]+", text)]


def test_long_addresses_are_redacted_whole(spark):
    model = pii.learn_pii(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    for local, domain in (("ü" * 100, "mail.de"), ("a.b" * 300, "mail.example.com"), ("x" * 20, "d" * 400 + ".com")):
        assert pii.redact(f"to {local}@{domain} now", model) == "to [EMAIL] now"


def test_the_whole_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op6_pii"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))
        assert all(0 <= a < b <= len(texts[r["doc_id"]]) for _, a, b in spans)
