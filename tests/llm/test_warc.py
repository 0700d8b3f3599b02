import base64
import gzip
import hashlib
import random
import tracemalloc
from collections import defaultdict

import pytest

from tenura.llm import warc

PAGES = "page_id long, url string, html string, payload string, refers_to long"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 0) for i, u, h in rows], PAGES)


def plain(rows, min_bytes=0):
    groups = defaultdict(list)
    for i, _, h in rows:
        if i is not None:
            groups[h or ""].append(i)
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        last = max(groups[h or ""], default=None)
        revisit = len(data) >= min_bytes and last is not None and i != last
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                    last if revisit else None, None))
    return sorted(out, key=repr)


ROWS = [(1, "u1", "<p>a</p>"), (2, "u2", "<p>a</p>"), (3, None, None), (4, "u\r\nEvil: x", ""), (5, "u5", "é\r\n\r\nWARC/1.1\r\n"),
        (5, "u5", "é\r\n\r\nWARC/1.1\r\n"), (None, "n", "<p>a</p>"), (6, "big", "x" * 700_000), (7, "big", "".join(map(str, range(300_000))))]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    archives = warc.write_warc(frame(spark, ROWS), min_bytes)
    got = warc.read_warc(archives).collect()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    assert sorted([tuple(r[n] for n in names) for r in got], key=repr) == plain(ROWS, min_bytes)
    text = {(i, hashlib.sha1((h or "").encode()).digest()): h or "" for i, _, h in ROWS}
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() == text[r.page_id, hashlib.sha1(bytes(r.payload)).digest()]
        else:
            assert r.payload is None


def test_empty_table(spark):
    assert warc.read_warc(warc.write_warc(frame(spark, []))).collect() == []


def archive(*records):
    return b"".join(warc.member(r) for r in records)


def test_reader_takes_any_cut():
    data = archive(*(warc.record(i, "u", b"body %d" % i * i, None) for i in range(30)))
    rng = random.Random(1)
    for _ in range(30):
        reader, got, at = warc.RecordReader(), [], 0
        while at < len(data):
            n = rng.randint(1, 400)
            got += [warc._row(h, b)[0] for h, b in reader.feed(data[at:at + n])]
            at += n
        reader.close()
        assert got == list(range(30))


def test_one_member_per_record():
    one = warc.record(1, "u", b"hello", None)
    assert gzip.decompress(warc.member(one)) == one


def test_damage_is_reported():
    good = warc.record(1, "u", b"hello", None)
    reader = warc.RecordReader()
    [(head, block)] = list(reader.feed(warc.member(good.replace(b"hello", b"jello"))))
    assert warc._row(head, block)[7] == "digest"
    with pytest.raises(ValueError):
        reader = warc.RecordReader()
        list(reader.feed(warc.member(good[:-6])))
    with pytest.raises(ValueError):
        reader = warc.RecordReader()
        list(reader.feed(warc.member(good)[:-9]))
        reader.close()


def test_exported_files_are_archives(spark, tmp_path):
    archives = warc.write_warc(frame(spark, ROWS))
    paths = [r.path for r in warc.export_archives(archives, str(tmp_path / "out")).collect()]
    assert sum(gzip.open(p).read().count(b"WARC-Record-ID") for p in paths) == len(ROWS)


def held_beyond(chunk):
    """Bytes at the highest point while a reader takes one chunk and its records are let go."""
    reader = warc.RecordReader()
    tracemalloc.start()
    try:
        sizes = [len(block) for _, block in reader.feed(chunk)]
        reader.close()
        return sizes, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_reader_holds_one_record_of_many_in_a_chunk():
    chunk = archive(*(warc.record(i, "u", b"a" * 200_000, None) for i in range(1000)))
    sizes, peak = held_beyond(chunk)
    assert sizes == [200_000] * 1000
    assert peak < 8 << 20


def test_reader_holds_a_long_page_once():
    chunk = archive(warc.record(1, "u", b"a" * (200 << 20), None), warc.record(2, "u", b"b", None))
    sizes, peak = held_beyond(chunk)
    assert sizes == [200 << 20, 1]
    assert peak - (200 << 20) < 32 << 20


def test_a_full_piece_at_the_end_of_the_bytes_loses_nothing():
    for extra in range(-3, 4):
        whole = len(warc.record(1, "u", b"", None))
        data = archive(warc.record(1, "u", b"a" * (warc.PIECE - whole + extra), None))
        for cut in (len(data) - 9, len(data) - 8, len(data) - 1, len(data)):
            reader = warc.RecordReader()
            got = [b for part in (data[:cut], data[cut:]) for _, b in reader.feed(part)]
            reader.close()
            assert len(got) == 1


def test_archives_roll_over(spark):
    rng = random.Random(3)
    rows = [(i, "u", "".join(chr(rng.randint(33, 1000)) for _ in range(3000))) for i in range(200)]
    pages = frame(spark, rows).coalesce(1)
    archives = warc.write_warc(pages, archive_bytes=50_000).cache()
    sizes = {r.archive: r.n for r in archives.selectExpr("archive", "length(data) n").groupBy("archive").sum("n")
             .withColumnRenamed("sum(n)", "n").collect()}
    assert len(sizes) > 5 and max(sizes.values()) < 60_000
    got = warc.read_warc(archives).collect()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    assert sorted([tuple(r[n] for n in names) for r in got], key=repr) == plain(rows)


def test_a_revisit_with_a_block_is_reported():
    bad = warc.record(1, "u", b"hello", 7).replace(b"Content-Length: 0\r\n\r\n", b"Content-Length: 5\r\n\r\nhello")
    [(head, block)] = list(warc.RecordReader().feed(warc.member(bad)))
    assert warc._row(head, block)[7] == "length"
