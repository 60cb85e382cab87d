import random

import pytest

from tablesync.llm import language

WORDS = {
    "en": "the of and to in a is that it was for on are with as his they at be this from have or by one had not but what all".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split(),
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas sur faire plus dire me on mon lui".split(),
}


def texts(lang, n, seed=0):
    rng = random.Random(f"{lang}{seed}")
    return [" ".join(rng.choices(WORDS[lang], k=rng.randint(15, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang) for lang in WORDS for i, t in enumerate(texts(lang, 60))]
    rows += [(900 + i, t, "de") for i, t in enumerate(texts("fr", 4, 9))]  # wrong labels
    rows += [(1, None, "en"), (2, "no label", None), (3, "", "en"), (4, "1234 !!", "xx")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    return language.learn_languages(df)


def test_texts_not_learned_from(spark, model):
    assert sorted(model.dictionaries) == ["de", "en", "fr"]
    rows = [(i, t, lang) for lang in WORDS for i, t in enumerate(texts(lang, 40, 1))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predict_language(df, model)
    assert got.columns == ["doc_id", "lang_pred", "score", "rejected"]
    found = got.collect()
    right = sum(r["lang_pred"] == lang for r, (_, _, lang) in zip(found, rows))
    assert right >= 118 and all(0 < r["score"] <= 1 for r in found)


def test_sizes_are_those_of_plain_compression(model):
    """The choice again, with every piece compressed by a compressor made for it."""
    import zstandard

    for text in (*texts("en", 5, 2), *texts("fr", 5, 2), "der den dem " * 2000):
        data = language.normalise(text).encode()
        level = model.short_level if len(data) <= model.short_bytes else model.level
        sizes = {}
        for name, d in model.dictionaries.items():
            made = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=level)
            c = zstandard.ZstdCompressor(dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[name] = sum(len(c.compress(data[i:i + model.piece_bytes])) for i in range(0, len(data), model.piece_bytes))
        name, score, rejected = model.predict(text)
        order = sorted(sizes.values())
        assert sizes[name] == order[0] and rejected == (order[1] - order[0] < model.margin * order[0])
        assert score == pytest.approx(1 / sum(2.0 ** (order[0] - s) for s in order))


def test_defined_results(spark, model):
    odd = [(1, None), (2, ""), (3, " 12 !? \n"), (None, "der die das und"), (5, "der die das und"), (5, "der die das und"), (6, "the of and " * 200_000), (7, "\ud800 the of and".encode("utf-8", "replace").decode())]
    rows = language.predict_language(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in rows[:3]] == [("und", 0.0, True)] * 3
    assert len({(r["lang_pred"], r["score"]) for r in rows[3:6]}) == 1 and rows[3]["lang_pred"] == "de" and rows[6]["lang_pred"] == "en"
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.predict_language(empty, model).collect() == []
    none = language.learn_languages(empty)
    assert none.predict("the") == ("und", 0.0, True)


def test_narrow_margins_are_rejected(spark):
    same = [(i, t, lang) for lang in ("aa", "bb") for i, t in enumerate(texts("en", 30))] + [(999, "the of", "aa")]
    model = language.learn_languages(spark.createDataFrame(same, "doc_id long, text string, lang string"))
    name, score, rejected = model.predict(texts("en", 1, 5)[0])
    assert rejected and name in ("aa", "bb")
    assert score == pytest.approx(0.5, abs=0.4)


def test_sample_is_bounded_whatever_the_share_of_a_language(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "concat('word ', cast(id as string), ' text of some length') as text", "if(id % 100 = 0, 'bb', 'aa') as lang")
    model = language.learn_languages(df, sample_docs=50, sample_chars=20)
    assert set(model.dictionaries) == {"aa", "bb"} and all(100 < len(d) < 50 * 2 * 21 for d in model.dictionaries.values())


def test_no_language_is_left_out(spark):
    """Many languages have smaller dictionaries; a rare one is predicted like the others."""
    rows = [(k * 10 + i, " ".join(f"{chr(0x4E00 + 7 * k + j)}{chr(0x4E00 + 7 * k + (i + j) % 7)}" for j in range(7)), f"l{k:03}") for k in range(280) for i in range(4 if k < 270 else 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn_languages(df, total_bytes=280 * 100)
    assert len(model.dictionaries) == 280 and all(8 <= len(d) <= 110 for d in model.dictionaries.values())
    assert [model.predict(t)[0] for _, t, lang in rows[-3:]] == [lang for _, _, lang in rows[-3:]]


def test_a_foreign_beginning_is_not_all_that_is_learned(spark):
    head = "this page is not available in your language please read on below "
    rows = [(i, head + " ".join(random.Random(i).choice(["maan", "kivi", "talo", "vesi", "puu", "yksi"]) for _ in range(60)), "fi") for i in range(30)]
    model = language.learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_chars=len(head))
    assert b"kivi" in model.dictionaries["fi"]


def test_a_language_of_a_few_letters_is_learned(spark):
    rows = [(i, t, "en") for i, t in enumerate(texts("en", 30))] + [(99, "ĝis", "eo"), (100, "12 34", "none")]
    model = language.learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(model.dictionaries) == ["en", "eo"] and len(model.dictionaries["eo"]) >= 8
    # four bytes are the same size with every dictionary: a tie, rejected; more of them are not
    assert model.predict("ĝis")[2] and model.predict("ĝis " * 36)[0] == "eo" and model.predict(texts("en", 1, 3)[0])[0] == "en"
