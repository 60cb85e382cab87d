import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from tablesync.llm import warc
from tablesync.llm.queries import QUERIES

PAGES = [
    (1, "http://www.Example.com:8080/a/b?x=1#frag", "hello"), (2, "https://example.com/a", "hello"), (3, "https://example.com/a", None),
    (4, "https://example.com/a", ""), (5, None, "five\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n"), (6, "no url\nat all", "é日" * 5),
    (None, "http://x.org/", "hello"), (None, "http://x.org/", "only here"), (7, "http://user@x.org/q", "long " * 400_000), (2, "https://example.com/a", "hello"),
    (8, "http://k.org/" + "p" * 5000, "k"), (9, "http://k.org/" + "p" * 5001, "k"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, url string, payload string, key string, at int").withColumn(
        "payload", F.col("payload").cast("binary"))


def want(rows, min_bytes=0):
    first = {}
    for i, _, p in rows:
        p = (p or "").encode()
        if i is not None and len(p) >= min_bytes:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, url, p in rows:
        p = (p or "").encode()
        refers = first.get(p) if first.get(p) != i else None
        if [(r[2] or "").encode() for r in rows].count(p) == 1:
            refers = None
        out.append((i, "revisit" if refers is not None else "response", refers, len(p), warc.payload_digest(p), None if refers is not None else p))
    return sorted(out, key=repr)


def found(index, keys):
    rows = warc.lookup(index, keys).collect()
    return sorted(((r["id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in rows), key=repr)


@pytest.mark.parametrize("min_bytes,file_bytes", [(0, 1 << 28), (3, 100)])
def test_round_trip(spark, min_bytes, file_bytes):
    pages = frame(spark, PAGES)
    index = warc.build_index(*warc.write_archives(pages, min_bytes, file_bytes=file_bytes))
    assert found(index, pages.select(warc.url_key(F.col("url")).alias("key"))) == want(PAGES, min_bytes)


def test_keys(spark):
    urls = {"http://www.Example.com:8080/a/b?x=1#frag": "com,example,www)/a/b?x=1", "https://user:pw@a.b.org": "org,b,a)", None: "", "no url\n": "no url ", "http:///x": ")/x"}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(warc.url_key(F.col("url"))).collect()] == list(urls.values())


def test_lookup_reads_only_the_blocks_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rng = random.Random(2)
    pages = [(i, f"http://h{rng.randint(0, 9)}.org/{rng.randint(0, 30)}", f"payload {i}") for i in range(120)] + [(500 + i, "http://hot.org/x", f"hot {i}") for i in range(40)]
    df = frame(spark, pages)
    index = warc.build_index(*warc.write_archives(df))
    keyed = {r["id"]: r["key"] for r in df.select("id", warc.url_key(F.col("url")).alias("key")).collect()}
    names = sorted(r["block"] for r in index.blocks.read().select("block").collect())
    assert names == index.directory.names and index.directory.separators == sorted(index.directory.separators)
    for key in {*keyed.values(), "", "zzz", "org,h3)/1", "org,hot)/"}:
        rows = found(index, spark.createDataFrame([(key,), (key,), (None,)], "key string"))
        assert {r[0] for r in rows} == {i for i, k in keyed.items() if k == key}
        held = sum(k == key for k in keyed.values())
        assert len(index.directory.candidates(key)) <= held // 4 + 3
    assert len(found(index, df.select(F.lit("org,hot)/x").alias("key")))) == 40


def test_nothing(spark):
    index = warc.build_index(*warc.write_archives(frame(spark, [])))
    assert found(index, spark.createDataFrame([("a",)], "key string")) == [] and index.directory.candidates("a") == []


def test_archives_are_plain_warc(spark, tmp_path):
    root, lines = warc.write_archives(frame(spark, PAGES).coalesce(1))
    store, folder = warc._store(root)
    names = {r["file"] for r in lines.read().collect()}
    kinds = []
    for name in names:
        with store.open_input_file(f"{folder}/{name}") as f:
            stream = io.BytesIO(gzip.decompress(f.read()))
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            head = {}
            while (line := stream.readline()) != b"\r\n":
                k, _, v = line.decode().rstrip("\r\n").partition(": ")
                head[k] = v
            assert len(stream.read(int(head["Content-Length"]))) == int(head["Content-Length"]) and stream.read(4) == b"\r\n\r\n"
            kinds.append(head["WARC-Type"])
    assert len(kinds) == len(PAGES) and kinds.count("revisit") == sum(r[1] == "revisit" for r in want(PAGES))


def test_damage_is_noticed(spark):
    record = warc._record(type("Row", (), {"id": "3", "url": "u", "payload": b"abc", "refers_to": None})(), "1970-01-01T00:00:00Z")
    line = type("Line", (), {"key": "k", "id": "3"})()
    assert warc._capture(line, record)[2:6] == ("response", None, 3, warc.payload_digest(b"abc"))
    line.id = "4"
    with pytest.raises(ValueError):
        warc._capture(line, record)


def test_query(spark):
    rows = QUERIES["op1_warc"](spark, "/root/testdata/sf0.001").collect()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in rows) == [w[:5] for w in sorted(want([tuple(p) for p in pages]))]


def test_separators_tell_blocks_of_long_shared_prefixes_apart():
    import random

    rng = random.Random(6)
    for shared, cut in ((0, 30), (300, 30), (warc.PREFIX + 50, 8)):
        keys = sorted("p" * shared + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 12))) for _ in range(600))
        blocks = [keys[i:i + cut] for i in range(0, len(keys), cut)]
        entries = [{"first": b[0][:warc.PREFIX], "last": b[-1][:warc.PREFIX]} for b in blocks]
        directory = warc.Directory(warc.separators(entries), list(range(len(blocks))))
        asked = 0
        for key in set(keys) | {k + "a" for k in keys[::7]} | {"", "a", "q"}:
            found = directory.candidates(key)
            assert {i for i, b in enumerate(blocks) if key in b} <= set(found)
            asked += len(found)
        if shared < warc.PREFIX:
            assert asked <= 3 * len(set(keys)) + 100 and max(map(len, directory.separators)) <= shared + 13
