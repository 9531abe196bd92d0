"""Records read through the directory search."""

import collections
import hashlib

from starbazaar.llm import warc_index


def test_every_record_comes_through_the_directory(spark, tmp_path):
    # One url has a third of all captures, and there are urls that share a key, are empty or null.
    urls = ["http://hot.example/x"] * 400 + [f"http://h{i % 40}.example/p/{i % 97}?q={i}" for i in range(700)]
    urls += ["HTTP://Hot.example/x", None, "", "no scheme", "http://h1.example/ü é"] + [None] * 60
    given = [(i, u, f"<p>{i % 300}</p>" * (1 + i % 5)) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(given, "page_id bigint, url string, html string")
    folder = f"file://{tmp_path}"
    blocks = warc_index.indexed(warc_index.archived(pages, folder), folder, block=16)
    found = warc_index.look_up(pages.select("url"), blocks).collect()
    assert sorted(r.page_id for r in found) == list(range(len(given)))
    for r in found:
        html = given[r.page_id][2].encode()
        assert r.payload_bytes == len(html) and (r.payload == html if r.record_type == "response" else r.refers_to > r.page_id)
    assert len({(r.file, r.offset) for r in warc_index.index_blocks(pages.where("url = 'http://hot.example/x'").select("url"), blocks).collect()}) > 20
    some = warc_index.look_up(pages.where("page_id % 100 = 3").select("url"), blocks, with_payload=False).collect()
    keys = {warc_index.surt(given[i][1] or "") for i in range(len(given)) if i % 100 == 3}
    assert sorted(r.page_id for r in some) == [i for i, u, _ in given if warc_index.surt(u or "") in keys]
    assert all(r.payload is None for r in some)
    counts = collections.Counter(hashlib.sha1(g[2].encode()).digest() for g in given)
    assert sum(r.record_type == "response" for r in found) == len(counts)
