"""Personal data in whole texts: pattern matches, and spans that a semi-Markov conditional random field adds.

Patterns (``base_spans``) are leftmost, do not overlap within a kind, and a match that fails its check is dropped
whole, so two numbers side by side can hide each other. The field looks at zones: runs of number characters, and the
text around an ``@``. A zone is cut into atoms (runs of digits; one atom for an address). Every candidate
segment of at most ``MAX_ATOMS`` atoms gets a score from features of the whole span (digit count, grouping, separators,
Luhn check, octets, neighbours) for each type it can be; all other atoms are outside. Dynamic programming over segment
ends chooses boundaries and types together. Added spans are those of the best labelling that touch no pattern match.

Weights maximise the likelihood of the pattern matches in the zones of a bounded sample (``sample_docs`` documents
with digits or ``@``, first by a hash of the id, at most ``sample_zones`` zones). Zones where a match
was too long are left out of it, as there the patterns say nothing about what is inside, and so are zones of more than ``LONGEST_EXAMPLE``
characters, which would outweigh all others; both are searched like any other.

Defined results: NULL is the empty text, which has no spans. Positions count code points, ends are exclusive. Equal rows
give equal results; an empty table none; without training zones nothing is added.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["KINDS", "PiiModel", "base_spans", "find_pii", "learn_pii", "redact"]

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 8
LONGEST_EXAMPLE = 200

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is taken whole or not at all, so only its beginning is tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _run_before(text: str, low: int, end: int, of: str = _LOCAL) -> int:
    """Where the run of some characters (those of a local part) that ends at ``end`` begins, not before ``low``."""
    size = 64
    while True:
        start = max(low, end - size)
        piece = text[start:end]
        kept = len(piece.rstrip(of))
        if kept or start == low:
            return start + kept
        size *= 4


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _matches(text: str) -> Iterator[tuple[str, int, int, bool, bool]]:
    """Pattern matches as (kind, start, end, passes its check, too long)."""
    if "@" in text:
        low = 0
        for m in _DOMAIN.finditer(text):
            start = _run_before(text, low, m.start())
            if start < m.start():
                yield "email", start, m.end(), True, False
                low = m.end()
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), _octets(m[0].split(".")), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if len(digits) >= 14:
                yield "card", m.start(), m.end(), len(digits) <= 19 and luhn(digits), len(digits) > 19
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = len(_NOT_DIGIT.sub("", m[0]))
            yield "phone", m.start(), m.end(), 10 <= digits <= 15, digits > 15


def _sorted(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_spans(text: str) -> list[Span]:
    return _sorted(m[:3] for m in _matches(text) if m[3])


# runs are taken whole and only from their beginning, so a text of any length is read once
_ZONE = re.compile(r"(?<![+(])[+(]*+[0-9][0-9 ().+-]*+")
_RUN = re.compile(r"[0-9]+")
_PLACE = r"\s@<>,;:\"'()\[\]"
_WORD_AT = re.compile(f"(?<![^{_PLACE}])[^{_PLACE}]++@[^{_PLACE}]++")


def zones(text: str) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """(email or number, start, atoms) of the places where personal data may be."""
    for m in _ZONE.finditer(text):
        if m.end() - m.start() >= 7:
            atoms = [a.span() for a in _RUN.finditer(text, m.start(), m.end())]
            if sum(b - a for a, b in atoms) >= 4:
                yield "number", m.start(), atoms
    if "@" in text:
        for m in _WORD_AT.finditer(text):
            end = m.start() + len(m[0].rstrip(".!?%*&$#-"))
            if end > text.index("@", m.start()) + 1:
                yield "email", m.start(), [(m.start(), end)]


def _edge(c: str) -> str:
    return "none" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() else "blank" if c.isspace() else c


def _segment(text: str, atoms: list[tuple[int, int]], i: int, j: int) -> tuple[int, int]:
    """The span of atoms i to j, with a plus or bracket that opens it."""
    return _run_before(text, atoms[i - 1][1] if i else 0, atoms[i][0], "+("), atoms[j - 1][1]


def features(text: str, atoms: list[tuple[int, int]], i: int, j: int, kind: str) -> list[str] | None:
    """Names of a segment's features as this kind, or None where it cannot be one."""
    start, end = _segment(text, atoms, i, j)
    before, after = _edge(text[start - 1:start]), _edge(text[end:end + 1])
    if kind == "email":
        local, _, domain = text[start:end].partition("@")
        last = domain.rpartition(".")[2]
        return [f"email {x}" for x in (
            "bias", f"dots {min(domain.count('.'), 3)}", f"tld {'none' if last == domain else 'alpha' if last.isalpha() else 'other'}",
            f"plain {domain.isascii() and re.fullmatch(r'[A-Za-z0-9.-]+', domain) is not None}",
            f"local {re.fullmatch(r'[A-Za-z0-9._%+-]+', local) is not None}", f"before {before}", f"after {after}")]
    groups = [text[a:b] for a, b in atoms[i:j]]
    digits = sum(map(len, groups))
    gaps = [text[p[1]:q[0]] for p, q in zip(atoms[i:j], atoms[i + 1:j])]
    if kind == "ip":
        if len(groups) != 4 or any(g != "." for g in gaps) or start != atoms[i][0]:
            return None
        own = [f"octets {_octets(groups)}"]
    else:
        if not (14 <= digits <= 19 if kind == "card" else 10 <= digits <= 15) or max(map(len, gaps), default=0) > 3:
            return None
        seps = "".join(sorted(set("".join(gaps)))) or "none"
        own = [f"digits {digits}", f"groups {'-'.join(str(len(g)) for g in groups)}", f"separators {seps}", f"opens {text[start:atoms[i][0]]}"]
        own.append(f"luhn {luhn(''.join(groups))}" if kind == "card" else f"plus {text[start] == '+'}")
    return [f"{kind} {x}" for x in ("bias", *own, f"before {before}", f"after {after}")]


def candidates(text: str, sort: str, atoms: list[tuple[int, int]]) -> Iterator[tuple[int, int, str, list[str]]]:
    if sort == "email":
        yield 0, 1, "email", features(text, atoms, 0, 1, "email")
        return
    for i in range(len(atoms)):
        digits = 0
        for j in range(i + 1, min(len(atoms), i + MAX_ATOMS) + 1):
            digits += atoms[j - 1][1] - atoms[j - 1][0]
            if digits > 19:
                break
            for kind in ("ip", "card", "phone"):
                found = features(text, atoms, i, j, kind) if digits >= 10 or kind == "ip" and j - i == 4 else None
                if found:
                    yield i, j, kind, found


@dataclass
class PiiModel:
    weights: dict[str, float]

    def score(self, names: list[str]) -> float:
        return sum(self.weights.get(n, -1.0) for n in names)  # what was never seen speaks against a span

    def decode(self, text: str, sort: str, atoms: list[tuple[int, int]]) -> list[Span]:
        """The spans of the best labelling of a zone."""
        by_end: dict[int, list] = {}
        for i, j, kind, names in candidates(text, sort, atoms):
            s = self.score(names)
            if s > 0:
                by_end.setdefault(j, []).append((i, kind, s))
        if not by_end:
            return []
        best, back = [0.0] * (len(atoms) + 1), [None] * (len(atoms) + 1)
        for j in range(1, len(atoms) + 1):
            best[j] = best[j - 1]
            for i, kind, s in by_end.get(j, ()):
                if best[i] + s > best[j]:
                    best[j], back[j] = best[i] + s, (i, kind)
        out, j = [], len(atoms)
        while j:
            if back[j]:
                i, kind = back[j]
                out.append((kind, *_segment(text, atoms, i, j)))
                j = i
            else:
                j -= 1
        return out[::-1]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Pattern matches, and the spans added to them."""
        base = base_spans(text)
        added: list[Span] = []
        if self.weights:
            taken = np.array(sorted((a, b) for _, a, b in base), dtype=np.int64).reshape(-1, 2)
            reach = np.maximum.accumulate(taken[:, 1]) if len(taken) else taken[:, 1]

            def free(a: int, b: int) -> bool:
                k = int(np.searchsorted(taken[:, 0], b, "left"))
                return k == 0 or reach[k - 1] <= a

            for sort, _, atoms in zones(text):
                if len(taken) and not any(free(a, b) for a, b in atoms):
                    continue
                added += [s for s in self.decode(text, sort, atoms) if free(s[1], s[2])]
        return base, _sorted(added)


def _lse(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def fit(examples: list[tuple[int, list[tuple[int, int, list[str]]], set[int]]], rounds: int = 60, rate: float = 0.3, decay: float = 0.002) -> PiiModel:
    """Maximise the likelihood of labelled zones; an example: atoms, candidates (from, to, features), the true ones' numbers."""
    names = sorted({n for _, segments, _ in examples for *_, f in segments for n in f})
    index = {n: k for k, n in enumerate(names)}
    data = [(size, [(i, j, [index[n] for n in f]) for i, j, f in segments], true) for size, segments, true in examples]
    theta, m, v = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
    for step in range(1, rounds + 1):
        grad = np.zeros(len(names))
        for size, segments, true in data:
            scores = [float(theta[f].sum()) for _, _, f in segments]
            ends, begins = [[] for _ in range(size + 1)], [[] for _ in range(size + 1)]
            for k, (i, j, _) in enumerate(segments):
                ends[j].append(k)
                begins[i].append(k)
            ahead, back = [0.0] * (size + 1), [0.0] * (size + 1)
            for j in range(1, size + 1):
                ahead[j] = _lse([ahead[j - 1], *(ahead[segments[k][0]] + scores[k] for k in ends[j])])
            for i in range(size - 1, -1, -1):
                back[i] = _lse([back[i + 1], *(back[segments[k][1]] + scores[k] for k in begins[i])])
            for k, (i, j, f) in enumerate(segments):
                p = math.exp(ahead[i] + scores[k] + back[j] - ahead[size])
                np.add.at(grad, f, (k in true) - p)
        grad = grad / len(data) - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return PiiModel({n: float(t) for n, t in zip(names, theta)})


def _examples(text: str) -> Iterator[tuple[int, list, list[int]]]:
    found = list(_matches(text))
    true = {(k, a, b) for k, a, b, good, _ in found if good}
    long = [(a, b) for _, a, b, _, too_long in found if too_long]
    for sort, start, atoms in zones(text):
        end = atoms[-1][1]
        if end - start > LONGEST_EXAMPLE or any(a < end and start < b for a, b in long):
            continue
        segments = list(candidates(text, sort, atoms))
        if segments:
            hit = [k for k, (i, j, kind, _) in enumerate(segments) if (kind, *_segment(text, atoms, i, j)) in true]
            yield len(atoms), [(i, j, f) for i, j, _, f in segments], hit


def learn_pii(docs: DataFrame, sample_docs: int = 6000, sample_zones: int = 3000) -> PiiModel:
    """Weights from (doc_id, text) rows."""
    schema = "key long, size int, segments array<struct<i:int,j:int,f:array<string>>>, hit array<int>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, size, segments, hit) for key, text in zip(batch["key"], batch["text"]) for size, segments, hit in _examples(text)]
            yield pd.DataFrame(rows, columns=["key", "size", "segments", "hit"])

    keyed = docs.where(F.col("text").rlike("[0-9][0-9 ().+-]{5}|@")).withColumn("key", F.xxhash64(F.lit("pii"), F.col("doc_id")))
    # the rank of the sampled ids, not their texts, goes through one task
    last = keyed.select("key").orderBy("key").limit(sample_docs).agg(F.max("key")).first()[0]
    if last is None:
        return PiiModel({})
    chosen = keyed.where(F.col("key") <= last).select("key", "text").mapInPandas(run, schema)
    rows = chosen.orderBy("key", F.to_json(F.struct("segments", "hit"))).limit(sample_zones).collect()
    examples = [(r["size"], [(s["i"], s["j"], list(s["f"])) for s in r["segments"]], set(r["hit"])) for r in rows]
    return fit(examples) if examples else PiiModel({})


def find_pii(docs: DataFrame, model: PiiModel) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end) for every row of (doc_id, text)."""
    kind = "array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.spans(t or "") for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "base": [f[0] for f in found], "added": [f[1] for f in found]})

    # ids travel as text: pandas makes numbers with a NULL among them floats
    out = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, f"doc_id string, base {kind}, added {kind}")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def redact(text: str | None, model: PiiModel) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first and longest counts."""
    if not text:
        return text
    base, added = model.spans(text)
    out, at = [], 0
    for kind, start, end in sorted((*base, *added), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        elif end > at:
            at = end  # an overlapping span goes as a whole
    return "".join([*out, text[at:]])


def redact_texts(docs: DataFrame, model: PiiModel) -> DataFrame:
    """The rows with their ``text`` redacted, the other columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            clean = pa.array([redact(t, model) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), clean)

    return docs.mapInArrow(run, docs.schema)
