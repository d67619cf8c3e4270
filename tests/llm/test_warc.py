import hashlib
import zlib

from earlymark.llm import warc


def test_keys():
    assert warc.url_key("https://www.Example.com:80/a?b#c") == "com,example)/a?b"
    assert warc.url_key("http://a.b.org") == "org,b,a)/"
    assert [warc.url_key(x) for x in (None, "", "no host", "http://[bad")] == ["", "", "no host", "http://[bad"]


def test_record_round_trip():
    for payload, target in ((b"", None), (b"a\r\n\r\nb\r\nContent-Length: 7\r\n\r\n", None), (b"x" * 2000, 9)):
        digest = hashlib.sha1(payload).hexdigest()
        data = zlib.decompress(warc.member(warc.record(5, "http://x/\ny", payload, digest, target)), 31)
        assert warc.parsed(data) == (5, len(payload), digest, "response" if target is None else "revisit", target)


def test_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 5)
    big, rows = "<p>" + "é" * 800, []
    for i in range(60):
        rows.append((i, f"http://h{i % 3}.example.com/p", big if i % 4 == 0 else f"page {i}" * 300, i))
    rows += [(100, "http://h0.example.com/p", "small", 0), (101, "http://h0.example.com/p", "small", 0), (102, None, None, 0), (103, "u\tv", "x", 0), (None, "http://n/", big, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, start long")
    out = {r.page_id: r for r in warc.archived(pages, str(tmp_path)).collect()}
    assert len(out) == len(rows)
    for page_id, _, html, _ in rows:
        payload, r = (html or "").encode(), out[page_id]
        twins = [p for p, _, h, _ in rows if h == html and p is not None]
        revisit = len(payload) >= 1000 and page_id != max(twins)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", max(twins) if revisit else None)
    blocks = list((tmp_path / "index").iterdir())
    assert blocks and all(b.suffix == ".z" for b in blocks)


def test_absent_keys_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://e/{i}", "x") for i in range(20)], "page_id long, url string, html string")
    root = str(tmp_path)
    lines = warc.stored(warc.write_archives(pages, root))
    directory = warc.stored(warc.write_index(lines, root, 20))
    keys = spark.createDataFrame([("a",), (warc.line_key("http://e/3", 3),), ("zzz",)], "key string")
    assert warc.look_up(keys, directory, root).count() == 1
    assert warc.archived(pages.limit(0), f"{root}/none").count() == 0


def test_every_row_is_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(None, None, f"null {i}") for i in range(40)] + [(None, "", "empty url"), (-1, None, "minus one")]
    rows += [(7, "http://a/", f"seven {i % 2}") for i in range(11)] + [(8, "http://a/", "eight"), (None, "http://a/", "x"), (None, "http://a/", "y"), (5, "u\tv", "tab"), (5, "u_v", "line")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.archived(pages.repartition(4), str(tmp_path)).collect()
    digest = lambda html: hashlib.sha1(html.encode()).hexdigest()
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_digest) for r in out) == sorted((p is None, p or 0, digest(html)) for p, _, html in rows)
