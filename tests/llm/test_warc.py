import base64
import gzip
import hashlib
import io
import random
import time

import pytest
from pyspark.sql import functions as F

from feedloom.llm import warc


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, "https://b/3", None), (4, None, ""),
        (5, "http://a/5\r\nWARC-Type: evil", "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (7, "http://a/7", "y" * 300_000), (6, "https://b/6", "y" * 300_000),
        (8, "http://a/8", "<p>x</p>"), (8, "http://a/8", "<p>x</p>"), (9, "http://a/9", "z" * 10)]


@pytest.fixture
def written(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.archive(pages(spark, ROWS).withColumn("payload", F.lit(1)).withColumn("id", F.lit(2)).withColumn("digest", F.lit("d")), path)
    return path


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in first and first[b] != i
        out.append((i, len(b), sha(b), "revisit" if again else "response", first[b] if again else None))
    return sorted(map(repr, out))


def test_round_trip(spark, written):
    got = warc.archived_pages(spark, written).collect()
    assert sorted(repr(tuple(r)) for r in got) == expected(ROWS)


def test_small_payloads_are_all_responses(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.archive(pages(spark, ROWS), path, min_revisit_bytes=20)
    assert sorted(repr(tuple(r)) for r in warc.archived_pages(spark, path).collect()) == expected(ROWS, 20)


def test_predicates_and_skipped_payloads(spark, written):
    warc.register(spark)
    df = spark.read.format("warc").load(written)
    assert df.where("warc_type = 'revisit'").count() == 5
    assert {r.target_uri for r in df.where("target_uri like 'https%'").collect()} == {"https://b/3", "https://b/6"}
    assert df.where(F.col("warc_type").isin("request", "metadata")).count() == 0
    assert spark.read.format("warc").option("types", "response").load(written).count() == 5
    heads = spark.read.format("warc").schema("record_id string, payload_length long").load(written).collect()
    assert sorted(r.payload_length for r in heads) == sorted(len((h or "").encode()) for _, _, h in ROWS)


def test_unwanted_payloads_are_not_inflated(monkeypatch):
    big = {"warc_type": "response", "record_id": "<a>", "payload": bytes(range(256)) * 40_000}
    data = warc.member(warc.record_bytes(big)) + warc.member(warc.record_bytes({**big, "warc_type": "revisit", "record_id": "<b>"}))
    damaged = bytearray(data)
    damaged[20_000:20_100] = bytes(100)  # within the first payload: reading it would fail
    rows = list(warc.read_records(bytes(damaged), warc.Wanted({"warc_type": frozenset(["revisit"])}, {}), True))
    assert [r["record_id"] for r in rows] == ["<b>"]
    with pytest.raises(Exception):
        list(warc.read_records(bytes(damaged), warc.Wanted({}, {}), True))


def test_members_of_other_writers_and_truncation():
    record = warc.record_bytes({"warc_type": "response", "record_id": "<a>", "payload": b"q" * 5000})
    plain = gzip.compress(record)
    rows = list(warc.read_records(plain + plain, warc.Wanted({}, {}), True))
    assert [len(r["payload"]) for r in rows] == [5000, 5000]
    with pytest.raises(ValueError):
        list(warc.read_records(warc.member(record)[:-9], warc.Wanted({}, {}), True))
    with pytest.raises(ValueError):
        list(warc.read_records(gzip.compress(b"nothing"), warc.Wanted({}, {}), True))


def test_files_roll_and_group_into_partitions(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.register(spark)
    many = spark.range(200).selectExpr("'response' warc_type", "concat('<', id, '>') record_id", "cast(repeat(uuid(), 50) as binary) payload").coalesce(1)
    many.write.format("warc").mode("append").option("path", path).option("filebytes", 5_000).save()
    assert len(list((tmp_path / "w").glob("*.warc.gz"))) > 5 and not list((tmp_path / "w").glob(".*tmp"))
    assert spark.read.format("warc").load(path).rdd.getNumPartitions() == 1
    split = spark.read.format("warc").option("splitbytes", 5_000).load(path)
    assert split.rdd.getNumPartitions() > 5 and split.count() == 200


def test_empty_table_and_null_id(spark, tmp_path):
    warc.archive(pages(spark, []), str(tmp_path / "a"))
    (tmp_path / "a").mkdir(exist_ok=True)
    assert warc.archived_pages(spark, str(tmp_path / "a")).collect() == []
    warc.archive(pages(spark, [(None, "u", "x"), (3, "u", "x"), (None, "u", "y")]), str(tmp_path / "b"))
    got = sorted(repr(tuple(r)[:1] + tuple(r)[3:]) for r in warc.archived_pages(spark, str(tmp_path / "b")).collect())
    assert got == sorted(map(repr, [(3, "response", None), (None, "revisit", 3), (None, "response", None)]))


class Counted(io.BytesIO):
    """A file that tells how much of it was read."""

    total = 0

    def read(self, n=-1):
        got = super().read(n)
        self.total += len(got)
        return got


def foreign(records, size=9000):
    r = random.Random(8)
    rows = [dict(warc_type="response", target_uri=f"http://a/{k}", payload=r.randbytes(size)) for k in range(records)]
    return rows, b"".join(gzip.compress(warc.record_bytes(x), 1) for x in rows)


def test_archives_of_others_are_read_in_linear_time():
    """Members without their length: every byte of the file is read about once."""
    seconds = []
    for n in (250, 1000):
        rows, data = foreign(n)
        file, begin = Counted(data), time.process_time()
        got = [x["payload"] for x in warc.read_records(file, warc.Wanted({}, {}), True)]
        seconds.append(time.process_time() - begin)
        assert got == [x["payload"] for x in rows]
        assert file.total <= 1.1 * len(data) + 2 * warc.BLOCK_BYTES
    assert seconds[1] <= 8 * seconds[0] + 0.2


def test_unwanted_records_of_others_are_dropped_and_own_ones_not_read():
    rows, data = foreign(60, 90_000)
    none = warc.Wanted({"warc_type": frozenset(["revisit"])}, {})
    assert list(warc.read_records(data, none, True)) == []
    own = Counted(b"".join(warc.member(warc.record_bytes(x)) for x in rows))
    assert list(warc.read_records(own, none, True)) == []
    assert own.total <= 60 * 2 * warc.BLOCK_BYTES < len(own.getvalue())
    some = warc.Wanted({"target_uri": frozenset(["http://a/59"])}, {})
    assert [x["payload"] for x in warc.read_records(data, some, True)] == [rows[59]["payload"]]


@pytest.mark.parametrize("size", [0, 1, 2000, 2047, 2048, 2049, 32_767, 32_768, 200_000])
def test_records_at_the_edges_of_blocks(size):
    plain = [warc.record_bytes(dict(warc_type="response", target_uri="http://x", payload=b"p" * size)) for _ in range(3)]
    for pack in (warc.member, gzip.compress):
        data = b"".join(map(pack, plain))
        assert [x["payload"] for x in warc.read_records(data, warc.Wanted({}, {}), True)] == [b"p" * size] * 3
        assert [x["payload_length"] for x in warc.read_records(data, warc.Wanted({}, {}), False)] == [size] * 3
        with pytest.raises(ValueError):
            list(warc.read_records(data[:-3], warc.Wanted({}, {}), True))
