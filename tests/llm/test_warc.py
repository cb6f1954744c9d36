import base64
import gzip
import hashlib

import pyarrow.parquet as pq

from millrace.llm import warc
from millrace.llm.queries import op8_warc
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "http://a.example.com/x", "same"), (2, "https://A.example.com/x#f", "same"), (3, None, "same"), (4, "http://b.example.org:80/?q=1 2%41", ""),
    (5, "no url\r\nInjected: 1", None), (6, "http://u@c.example.net", "é" * 200000), (6, "http://u@c.example.net", "é" * 200000), (None, "http://d.example.net/", "same"),
    (None, "http://d.example.net/", "own"), (9, "http://d.example.net/y", "own text\r\n\r\nWARC/1.1"),
]


def want(rows):
    top = {}
    for i, _, html in rows:
        top[html or ""] = max(top.get(html or "", -(10**9)), i if i is not None else -(10**9))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        best = top[html or ""]
        refers = None if i == best or best == -(10**9) else best
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_op8(spark):
    table = pq.read_table(f"{SF}/pages.parquet")
    rows = list(zip(table["page_id"].to_pylist(), table["url"].to_pylist(), table["html"].to_pylist()))
    assert sorted(map(tuple, op8_warc(spark, SF).collect()), key=repr) == want(rows)


def test_odd_rows(spark, frame):
    pages = frame([(*r, 1, "x") for r in ODD], "page_id bigint, url string, html string, offset int, file string").repartition(3)
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=repr) == want(ODD)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_lookup_and_files(spark, frame, tmp_path):
    rows = [(i, f"http://h{i % 7}.example.com/p{i}", f"page {i % 50}") for i in range(500)]
    captures = warc.write_archives(frame(rows, "page_id bigint, url string, html string").repartition(4), f"{tmp_path}/a")
    directory = warc.write_index(captures, f"file://{tmp_path}/i", block_lines=9)
    assert directory.agg(F.max("n_lines")).first()[0] == 9
    urls = ["http://h3.example.com/p3", "https://H4.example.com/p4#top", "http://nowhere.example.com/"]
    found = warc.lookup(directory, f"{tmp_path}/i", f"{tmp_path}/a", frame([(u,) for u in urls], "url string")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to, r.payload) for r in found) == [(3, "revisit", 453, None), (4, "revisit", 454, None)]
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "a").glob("*.warc.gz")))
    assert whole.count(b"WARC/1.1\r\n") == 500 and not list((tmp_path / "a").glob("_draft*"))
    keys = [r.surt for r in warc.captures_in(directory.orderBy("part", "offset"), f"{tmp_path}/i").collect()]
    assert sorted(keys) == sorted(r.surt for r in captures.collect())


def test_search_finds_every_capture_and_reads_no_other_block(spark, frame, tmp_path):
    rows = [(i, f"http://h{i % 40}.example.com/", f"page {i}") for i in range(600)] + [(600 + i, "http://hot.example.com/", f"hot {i}") for i in range(300)] + [(900, None, "x"), (901, "", "y")]
    captures = warc.write_archives(frame(rows, "page_id bigint, url string, html string").repartition(4), f"{tmp_path}/a")
    directory = warc.write_index(captures, f"{tmp_path}/i", block_lines=7)
    every = frame([(u,) for _, u, _ in rows] * 2, "url string").select(warc.surt(F.col("url")).alias("surt"))
    found = [r.page_id for r in warc.captures_of(directory, f"{tmp_path}/i", every).collect()]
    assert sorted(found) == [i for i, _, _ in rows]
    # With the files of all other blocks gone, a key is still found: only its own blocks are read.
    some = frame([("com,example,h7)/",), ("com,example,nowhere)/",), (None,)], "surt string")
    own = directory.where("first_key <= 'com,example,h7)/' AND last_key >= 'com,example,h7)/'").select("file").distinct().collect()
    for file in (tmp_path / "i").glob("*.cdx"):
        if file.name not in {r.file for r in own}:
            file.unlink()
    assert sorted(r.page_id for r in warc.captures_of(directory, f"{tmp_path}/i", some).collect()) == [i for i, u, _ in rows if u == "http://h7.example.com/"]


def test_surt(spark, frame):
    urls = ["http://www.Example.com", "https://u:p@a.b.c:8080/Path?q#f", "mailto:x", None, "http://x.y?z"]
    got = [r[0] for r in frame([(u,) for u in urls], "url string").select(warc.surt(F.col("url"))).collect()]
    assert got == ["com,example,www)/", "c,b,a:8080)/Path?q", ")mailto:x", ")", "y,x)?z"]
