"""WARC archives read back against the pages that were written, with payloads that look like records."""

import hashlib
import random

import pytest

from terraloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first string, record string, size long"


def fake(n: int, body: str, length: int | None = None) -> str:
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\nContent-Length: {len(body.encode()) if length is None else length}\r\n\r\n{body}"


def make_pages():
    rng = random.Random(4)
    copy = "copy of a page, long enough to be stored once only " * 3
    whole = "\r\n\r\n".join(["<p>archive</p>", fake(901, "x" * 50), fake(902, "y" * 20), "after"])
    odd = [
        None, "", "é" * 60, "short", "short", copy, copy, copy, whole, whole + " ", "\r\n\r\nWARC/1.", "\r\n\r\nWARC/1.WARC/1.1\r\n\r\n", "a\r\n\r\nWARC/1.1\r\nContent-Length: 99999\r\n\r\n",
        fake(903, "z"), "\r\n\r\n" + fake(904, "", 5), "\r\n\r\n" + fake(905, "q" * 400, 400), "\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n" * 30, "WARC/1.1\r\n" * 50, "日本語 " * 200, "x" * 5000,
    ]
    pages = [(i, f"http://h{i % 3}.example/{i}", h) for i, h in enumerate(odd)]
    pages += [(40, None, copy), (None, "http://n.example/WARC/1.1", copy), (None, None, "none " * 30), (None, "x", "none " * 30), (5, "again", copy), (41, "a\r\nWARC-Type: x\r\n\r\nb", "line ends " * 20), (2**60 + 1, "u", "big"), (2**60 + 3, "u", copy)]
    for i in range(50, 110):
        pages.append((i, f"http://r.example/{i}", "\r\n\r\n".join(rng.choice(["text " * rng.randint(1, 60), fake(i, "t" * rng.randint(0, 90), rng.choice([None, 30, 7])), "WARC/1.0", "\r\n"]) for _ in range(rng.randint(1, 6)))))
    return [(*p, "d", "f", "r", 1) for p in pages]


def expected(pages):
    first, times = {}, {}
    for i, _, h, *_ in pages:
        h = h or ""
        times[h] = times.get(h, 0) + 1
        if i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, u, h, *_ in pages:
        h = h or ""
        data = h.encode()
        revisit = len(data) >= 100 and times[h] > 1 and h in first and i != first[h]
        url = u and u.replace("\r", "%0D").replace("\n", "%0A")
        out.append((i, url, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("split", "files", "most"), [("128m", 3, 500_000), ("700b", 1, 500_000), ("3k", 2, 0), ("150b", 1, 500_000)])
def test_archives_hold_the_pages(spark, split, files, most, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", most)
    pages = make_pages()
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.round_trip(spark.createDataFrame(pages, SCHEMA).coalesce(files)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted(map(tuple, got), key=str) == expected(pages)


def test_rows_do_not_depend_on_the_splits(spark, tmp_path):
    """Splits that end inside what stands between rows, in runs of line ends too, lose and repeat nothing."""
    text = "".join(["\r\n\r\n\nWARC/1.1\r\n" * 9, *make_texts()])
    (tmp_path / "a.warc").write_bytes(text.encode())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for n in (60, 61, 67, 73, 97):
            spark.conf.set("spark.sql.files.maxPartitionBytes", f"{n}b")
            rows = [(r.block, i, r.value) for i, r in enumerate(warc.stretches(spark, str(tmp_path)).collect())]
            assert [r[2] for r in sorted(rows)] == text.split("\nWARC/1.")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def make_texts():
    rng = random.Random(9)
    return ["".join(rng.choice(["\n", "\r\n", "\nWARC", "\nWARC/1.", "\n\nWARC/1.1\r\n", "W", "é", "text"]) for _ in range(40)) for _ in range(60)]


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("blocks", [1, 2, 3, 5, 8])
def test_files_of_few_blocks(spark, tmp_path, blocks):
    """A file's last block is reached though no chain leaves it."""
    text = "".join(fake(i, "b" * 90) + "\r\n\r\n" for i in range(64))
    (tmp_path / "one.warc").write_bytes(text.encode())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{-(-len(text) // blocks)}b")
    try:
        assert warc.stretches(spark, str(tmp_path)).select("block").distinct().count() == blocks
        assert sorted(r.page_id for r in warc.read_archive(spark, str(tmp_path)).collect()) == list(range(64))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_a_damaged_archive_is_read_as_far_as_it_holds(spark, tmp_path):
    good = [fake(i, f"body {i} " * 20) for i in range(6)]
    damaged = fake(9, "short", 7)
    text = "\r\n\r\n".join([*good[:3], damaged, *good[3:]]) + "\r\n\r\n"
    (tmp_path / "one.warc").write_bytes(text.encode())
    (tmp_path / "two.warc").write_bytes("\r\n\r\n".join(good)[:-5].encode())  # its last record is cut off
    (tmp_path / "three.warc").write_bytes(b"no archive\r\n\r\n" + good[0].encode())
    got = {(r.file.rsplit("/", 1)[1], r.page_id) for r in warc.read_archive(spark, str(tmp_path)).collect()}
    assert got == {("one.warc", 0), ("one.warc", 1), ("one.warc", 2), *(("two.warc", i) for i in range(5))}


def test_exits_follow_chains_inside_a_block():
    import numpy as np

    at, after = np.array([0, 10, 20, 30, 40]), np.array([20, 30, 40, 99, 55])
    assert warc.exits_of(at, after, 50).tolist() == [55, 99, 55, 99, 55]
    assert warc.exits_of(at, np.array([15, -1, 40, 10, 60]), 50).tolist() == [-1, -1, 60, -1, 60]
