"""Language of whole texts by compression: the language whose dictionary makes the text smallest.

Every language has a raw-content zstandard dictionary of up to ``dictionary_bytes`` of text learned for it, less where
all together would be more than ``total_bytes``: many languages have smaller dictionaries, and none is left out. A
text is lower-cased, everything but letters becomes a space, and pieces of ``piece_bytes`` are compressed apart, so
the dictionary counts for the whole length of a text and not only at its start. The sizes add up. Texts of at
most ``short_bytes`` are compressed harder, as single bytes decide there.

The dictionaries come from a bounded sample: about ``sample_docs`` documents for each language, fewer where its dictionary is
smaller, taken by a hash of the id, and a window of ``sample_chars`` characters at a hashed place of each. A first set
of dictionaries judges the sample, and what it assigns elsewhere is left out of the final set.

Defined results: ``und`` with score 0 for a text that is NULL, has no letter, or where no language was learned. ``rejected``
is true for those and for narrow margins, where the second size is less than ``margin`` larger. Ties go to the
language with more documents. Equal rows get equal results; an empty table none. Further columns are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["LanguageModel", "learn_languages", "predict_language"]

UNKNOWN = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str) -> str:
    return _NO_LETTERS.sub(" ", text.lower())


@dataclass
class LanguageModel:
    dictionaries: dict[str, bytes]
    level: int = 4
    short_level: int = 12
    piece_bytes: int = 4096
    short_bytes: int = 2048
    margin: float = 0.01
    _ready: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_ready": []}

    def compressors(self, short: bool) -> list[tuple[str, zstandard.ZstdCompressor]]:
        if not self._ready:
            for level in (self.level, self.short_level):
                made = []
                for name, content in self.dictionaries.items():
                    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    d.precompute_compress(level=level)
                    made.append((name, zstandard.ZstdCompressor(
                        dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)))
                self._ready.append(made)
        return self._ready[short]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected). The score is the language's share when a byte saved counts one bit."""
        if text is None or not self.dictionaries:
            return UNKNOWN, 0.0, True
        plain = normalise(text)
        if not any(map(str.isalpha, plain)):
            return UNKNOWN, 0.0, True
        data = plain.encode("utf-8", "replace")
        pieces = [data[i:i + self.piece_bytes] for i in range(0, len(data), self.piece_bytes)]
        ready = self.compressors(len(data) <= self.short_bytes)
        sizes = sorted(((sum(len(c.compress(p)) for p in pieces), name) for name, c in ready), key=lambda x: x[0])
        least, name = sizes[0]
        score = 1 / sum(2.0 ** max(-1000, least - size) for size, _ in sizes)
        return name, score, len(sizes) > 1 and sizes[1][0] - least < self.margin * least


def learn_languages(
    docs: DataFrame, sample_docs: int = 800, sample_chars: int = 1500, dictionary_bytes: int = 128 << 10,
    total_bytes: int = 32 << 20, **options,
) -> LanguageModel:
    """Dictionaries from (doc_id, text, lang) rows; rows without text or language are not used."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return LanguageModel({}, **options)
    part = min(1.0, total_bytes / (len(counts) * dictionary_bytes))
    # 20 documents at least: by luck a language would otherwise have none
    dictionary_bytes, sample_docs = max(8, int(dictionary_bytes * part)), max(min(sample_docs, 20), int(sample_docs * part))
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, sample_docs / r["count"])) for r in counts], "lang string, share double")
    luck = F.shiftrightunsigned(F.xxhash64(F.lit("language"), F.col("doc_id")), 11) / F.lit(float(1 << 53))
    # a language has about sample_docs rows in the sample; the limit bounds it where many rows share an id
    places = F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1
    window = F.substring("text", (F.pmod(F.xxhash64(F.lit("window"), "doc_id", "text"), places) + 1).cast("int"), F.lit(sample_chars))
    sample = known.join(F.broadcast(shares), "lang").where(luck < F.col("share")).select("lang", window.alias("text"), F.xxhash64("doc_id").alias("key"))
    rows = sample.orderBy("key", "lang", "text").limit(2 * sample_docs * len(counts)).collect()

    def build(rows) -> LanguageModel:
        parts: dict[str, list[bytes]] = {}
        room: dict[str, int] = {}
        for lang, text in rows:
            part = normalise(text).encode("utf-8", "replace")
            if part.strip() and room.setdefault(lang, dictionary_bytes) > 0:
                parts.setdefault(lang, []).append(part[: room[lang]])
                room[lang] -= len(part)
        joined = {lang: b" ".join(p) for lang, p in parts.items()}
        # a dictionary has 8 bytes at least: shorter content is repeated
        whole = {lang: content if len(content) >= 8 else (content + b" ") * 8 for lang, content in joined.items()}
        return LanguageModel({r["lang"]: whole[r["lang"]] for r in counts if r["lang"] in whole}, **options)

    pairs = [(r["lang"], r["text"]) for r in rows]
    first = build(pairs)
    agreed = [(lang, text) for lang, text in pairs if first.predict(text)[0] == lang]
    final = build(agreed)
    return LanguageModel({k: final.dictionaries.get(k, v) for k, v in first.dictionaries.items()}, **options)


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [model.predict(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "lang_pred": [o[0] for o in out],
                "score": [o[1] for o in out], "rejected": [o[2] for o in out]})

    # ids travel as text: pandas makes numbers with a NULL among them floats
    out = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, "doc_id string, lang_pred string, score double, rejected boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
