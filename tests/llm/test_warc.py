"""Archives: records as the format asks, and an exact round trip."""

import base64
import glob
import hashlib

from pyspark.sql import functions as F

from tabloop.llm import queries, warc


def expected(rows, least=0):
    first = {}
    for name, html in rows:
        data = (html or "").encode()
        if len(data) >= least and name is not None:
            first[data] = min(name, first.get(data, name))
    out = []
    for name, html in rows:
        data = (html or "").encode()
        begin = first.get(data)
        later = begin is not None and (name is None or name > begin) and len(data) >= least
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((name, len(data), digest, "revisit" if later else "response", begin if later else None))
    return sorted(out, key=repr)


def test_given_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{path}/pages.parquet").collect()]
    out = queries.QUERIES["op5_warc_chunks"](spark, path).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=repr) == expected(rows)
    assert all(r.intact for r in out)


def test_chunks_copies_and_odd_rows(spark, tmp_path):
    rows = [(i, f"<p>{i % 4}\r\n\r\nWARC/1.1</p>é" * (i % 4 + 1)) for i in range(20)]
    rows += [(30, None), (31, ""), (32, "x" * 100_001), (33, "x" * 100_001), (32, "x" * 100_001), (None, "n"), (34, "n")]
    urls = ["http://a/ b\n", None, "", "http://e/é"]
    table = [(a, urls[i % 4], b, "z") for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(table, "page_id bigint, url string, html string, sha1 string").repartition(3)
    files = warc.write(df, folder=str(tmp_path / "out"), chunk_bytes=1000)
    chunks = warc.read(files, str(tmp_path / "out"), chunk_bytes=777).cache()
    assert chunks.agg(F.max(F.length("data"))).first()[0] == 777
    number = F.col("record_id").try_cast("bigint")
    last = chunks.where("is_last").select(number.alias("i"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")
    got = [(r.i, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in last.collect()]
    assert sorted(got, key=repr) == expected(rows)
    assert last.where("not intact").count() == 0
    whole = {}
    for r in sorted(chunks.where("record_type = 'response'").collect(), key=lambda r: (r.path, r.record_offset, r.chunk_no)):
        whole.setdefault((r.path, r.record_offset), []).append(bytes(r.data))
    texts = {b"".join(v) for v in whole.values()}
    assert texts == {(t or "").encode() for _, t in rows}
    assert files.agg(F.sum("records")).first()[0] == len(rows)
    raw = b"".join(open(f, "rb").read() for f in glob.glob(str(tmp_path / "out" / "*.warc")))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n") and b"about:blank" in raw


def test_small_payloads_may_stay_responses(spark, tmp_path):
    rows = [(1, "aa"), (2, "aa"), (3, "aaaa"), (4, "aaaa")]
    df = spark.createDataFrame([(a, "u", b) for a, b in rows], "page_id bigint, url string, html string")
    files = warc.write(df, folder=str(tmp_path / "o"), min_revisit_bytes=3)
    kinds = {int(r.record_id): r.record_type for r in warc.read(files, str(tmp_path / "o")).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    files = warc.write(df, folder=str(tmp_path / "o"))
    assert warc.read(files, str(tmp_path / "o")).collect() == []


def test_query_with_null_and_repeated_identifiers(spark, tmp_path):
    rows = [(None, "one"), (None, "two"), (3, "one"), (4, "one"), (4, "three"), (4, "three"), (None, None), (9, "")]
    spark.createDataFrame([(i, "http://a/", h) for i, h in rows], "page_id bigint, url string, html string").write.parquet(
        str(tmp_path / "pages.parquet")
    )
    out = queries.QUERIES["op5_warc_chunks"](spark, str(tmp_path)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=repr) == expected(rows) and all(r.intact for r in out)


def test_text_identifiers_come_back(spark, tmp_path):
    names = ["none", "%", "", "a b", "<x>", "é\r\n", "a+b", None]
    df = spark.createDataFrame([(n, f"page {i % 3}") for i, n in enumerate(names)], "page_id string, html string")
    files = warc.write(df.withColumn("url", F.lit("http://a/")), folder=str(tmp_path / "out"))
    last = warc.read(files, str(tmp_path / "out")).where("is_last").collect()
    assert sorted(map(repr, (r.record_id for r in last))) == sorted(map(repr, names))
    first = {}
    for i, n in enumerate(names):
        if n is not None:
            first[i % 3] = min(n, first.get(i % 3, n))
    want = {(n, None if n == first[i % 3] else first[i % 3]) for i, n in enumerate(names)}
    assert {(r.record_id, r.refers_to) for r in last} == want
