"""Damaged archives: what is recovered, and what is reported as lost."""

from __future__ import annotations

import gzip
import random

import pytest

from civicflow.llm import warc
from civicflow.session import scratch_dir


def record(number, size=200, extra=()):
    body = random.Random(number).randbytes(size)
    return warc._record("response", [("X-Page-Id", str(number)), *extra], body)


def member(number, **options):
    return gzip.compress(record(number, **options))


RECORDS = [record(i) for i in range(8)]
MEMBERS = [member(i) for i in range(8)]


def found(data):
    """Numbers of the records and places of the gaps."""
    rows = list(warc.records_in(data))
    assert all((headers is None) == (problem is not None) for _, _, headers, _, problem in rows)
    numbers = [r[2].get("x-page-id", "") for r in rows if r[2]]
    return [int(n) if n.isascii() and n.isdigit() else -1 for n in numbers], [(r[0], r[1]) for r in rows if not r[2]]


def damage(kind, data, chance):
    at = chance.randrange(12, len(data) - 12)
    if kind == "flip":
        return data[:at] + bytes([data[at] ^ 0xFF]) + data[at + 1 :]
    if kind == "cut":
        return data[:at]
    return data[:at] + chance.randbytes(chance.randrange(1, 40)) + data[at:]


@pytest.mark.parametrize("kind", ["flip", "cut", "insert"])
@pytest.mark.parametrize("parts", [MEMBERS, RECORDS], ids=["gzip", "plain"])
def test_records_around_a_damaged_one_are_recovered(parts, kind):
    chance = random.Random(kind)
    for _ in range(60):
        hurt = sorted(chance.sample(range(8), chance.randrange(1, 4)))
        pieces = [damage(kind, part, chance) if i in hurt else part for i, part in enumerate(parts)]
        starts = [sum(map(len, pieces[:i])) for i in range(9)]
        numbers, gaps = found(b"".join(pieces))
        # A header that nothing checks may be hit; such a record is read, under whatever number.
        kept = [i for i in range(8) if i not in hurt]
        assert [i for i in numbers if i in kept] == kept
        lost = [i for i in hurt if not any(start <= starts[i] < end for start, end in gaps)]
        assert len(numbers) == len(kept) + len(lost)
        assert all(start in starts and end in starts for start, end in gaps)


def test_whole_archives_have_no_gaps():
    for data in (b"".join(MEMBERS), b"".join(RECORDS), gzip.compress(b"".join(RECORDS)), gzip.compress(b"") + MEMBERS[0]):
        numbers, gaps = found(data)
        assert numbers == list(range(len(numbers))) and len(numbers) in (1, 8) and gaps == []
    assert found(b"") == ([], [])
    assert found(b"no archive at all") == ([], [(0, 17)])


def test_one_member_with_a_damaged_record_gives_the_others():
    hurt = RECORDS[3].replace(b"Content-Length: 200", b"Content-Length: 999")
    data = gzip.compress(b"".join([*RECORDS[:3], hurt, *RECORDS[4:]]))
    numbers, gaps = found(MEMBERS[0] + data + MEMBERS[1])
    assert numbers == [0, 0, 1, 2, 4, 5, 6, 7, 1]
    assert gaps == [(len(MEMBERS[0]), len(MEMBERS[0]) + len(data))]


@pytest.mark.parametrize("length", ["9" * 5000, "-1", "", "ten", "1_0", "9" * 18])
def test_no_length_ends_the_reading(length):
    bad = RECORDS[1].replace(b"Content-Length: 200", f"Content-Length: {length}".encode())
    for parts in ([RECORDS[0], bad, RECORDS[2]], [MEMBERS[0], gzip.compress(bad), MEMBERS[2]]):
        numbers, gaps = found(b"".join(parts))
        assert numbers == [0, 2] and gaps == [(len(parts[0]), len(parts[0]) + len(parts[1]))]


def test_repeated_headers_keep_all_values():
    data = member(5, extra=[("WARC-Concurrent-To", "<a>"), ("warc-concurrent-to", "<b>")])
    ((_, _, headers, _, _),) = warc.records_in(data)
    assert headers["warc-concurrent-to"] == "<a>, <b>"


def test_odd_pages_come_back(spark):
    long = "x" * 1000 + "é"
    rows = [(1, "u1", None), (2, None, ""), (3, "u\r\n3", long), (4, "u4", long), (4, "u4", "other"), (None, "u5", long)]
    rows += [(5, "u6", "y" * 999), (6, "u7", "y" * 999), (7, "u8", "WARC/1.1\r\n\r\n\0" * 80), (8, "big", "z" * (17 << 20)), (1, "u1", None)]
    schema = "page_id long, url string, html string, digest string, refers_to string, member int"
    path, out = scratch_dir(spark, "pages"), scratch_dir(spark, "archives")
    spark.createDataFrame([(*r, "d", "r", 1) for r in rows], schema).repartition(3).write.parquet(path)
    warc.write_archives(spark.read.parquet(path), out)
    read = warc.read_archives(spark, out)
    assert read.where("problem is not null").isEmpty()
    pages = warc.pages_of(read).collect()
    assert len(pages) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = sorted(((i, len((t or "").encode()), 4 if i == 3 else None) for i, _, t in rows), key=key)
    assert sorted(((r.page_id, r.payload_bytes, r.refers_to) for r in pages), key=key) == expected
    assert {r.page_id for r in pages if r.record_type == "revisit"} == {3}
    none = scratch_dir(spark, "none")
    warc.write_archives(spark.createDataFrame([], schema), none)
    assert warc.read_archives(spark, none).isEmpty()


def test_many_small_partitions_share_archives(spark):
    """One archive for each partition forked three processes for a few records on a local disk."""
    path, out = scratch_dir(spark, "pages"), scratch_dir(spark, "archives")
    rows = [(i, f"u{i}", f"{i % 50} " * 600) for i in range(400)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(path)
    held = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        warc.write_archives(spark.read.parquet(path), out)
        read = warc.read_archives(spark, out)
        assert read.select("file").distinct().count() <= 2 * spark.sparkContext.defaultParallelism
        pages = {r.page_id: r.refers_to for r in warc.pages_of(read).collect()}
        assert read.where("problem is not null").isEmpty()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert pages == {i: None if i >= 350 else 350 + i % 50 for i in range(400)}
