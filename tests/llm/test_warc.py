"""Archives are read back as written, and merged in order."""

import gzip
import hashlib
import io
import random

import pytest

from motorlake.llm import warc

PAGES = "page_id long, url string, html string, refers_to string, run string"
LONG = "<p>" + "ü" * 600 + "</p>"


def pages(spark):
    rows = [
        (3, "http://B.example/x?q=1", LONG, "clash", "r"),
        (9, "https://a.example:8080/", LONG, None, None),
        (9, "https://a.example:8080/", LONG, None, None),
        (4, None, LONG, None, None),
        (None, "http://a.example", LONG, None, None),
        (1, "http://a.example/\r\nEvil: 1", None, None, None),
        (2, "http://a.example/y", "", None, None),
        (5, "not a url [", "short", None, None),
        (6, "http://c.example/", "short", None, None),
        (None, "http://n.example/", "n" * 1000, None, None),
        (None, "http://n.example/", "n" * 1000, None, None),
        (7, "http://c.example/", "line\r\n\r\n" * 200, None, None),
        (8, "http://c.example/", "x" * 3_000_000, None, None),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_archive(spark):
    got = warc.archive(pages(spark)).orderBy("position").collect()
    assert [r.position for r in got] == list(range(13))
    assert [(r.urlkey, r.captured) for r in got] == sorted((r.urlkey, r.captured) for r in got)
    same = [r for r in got if r.payload_bytes == len(LONG.encode())]
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in same) == [
        (0, "revisit", 9), (3, "revisit", 9), (4, "revisit", 9), (9, "response", None), (9, "response", None)]
    assert {r.payload_digest for r in same} == {hashlib.sha1(LONG.encode()).hexdigest()}
    rest = {r.page_id: r for r in got if r not in same}
    assert all(r.record_type == "response" and r.refers_to is None for r in rest.values())
    assert rest[1].payload_digest == rest[2].payload_digest == hashlib.sha1(b"").hexdigest()
    assert rest[1].url == "http://a.example/%0D%0AEvil:%201"
    assert rest[7].payload_bytes == 1600 and rest[8].payload_bytes == 3_000_000
    assert same[0].urlkey.startswith("-") or any(r.urlkey == "example,a:8080)/" for r in same)


def test_archive_of_nothing(spark):
    assert warc.archive(pages(spark).limit(0)).collect() == []


def test_ranges_do_not_change_the_order(spark):
    captures = warc.read_archives(warc.write_archives(warc.with_revisits(pages(spark).repartition(4)), folder(spark)))
    whole = [(r.position, r.page_id, r.start) for r in warc.merge_index(captures).collect()]
    parts = [(r.position, r.page_id, r.start) for r in warc.merge_index(captures, 2).collect()]
    assert sorted(whole, key=str) == sorted(parts, key=str)


def folder(spark):
    from motorlake.session import new_folder

    return new_folder(spark, "warc")


def test_records_are_gzip_members():
    records = [warc.record(i, f"http://x/{i}", "body " * i, None if i % 2 else 1) for i in range(6)]
    found = list(warc.members(io.BytesIO(b"".join(records))))
    assert [content for *_, content in found] == [gzip.decompress(r) for r in records]
    assert [start for start, *_ in found] == [sum(map(len, records[:i])) for i in range(6)]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(records[0][:-5])))


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 16, 33])
def test_loser_tree(runs):
    rng = random.Random(runs)
    lists = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 40))) for _ in range(runs)]
    assert list(warc.LoserTree(lists, lambda x: x)) == sorted(x for run in lists for x in run)
