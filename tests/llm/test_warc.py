import gzip
import hashlib
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quizlens.llm import warc
from tests.llm.frames import prose

SCHEMA = "page_id long, url string, html string, record_type string, digest int"


def page_rows(seed=1, n=200):
    r = random.Random(seed)
    body = prose(r, 60)
    texts = [None, "", "x", "y" * 99, "y" * 99, "é" * 50, "é" * 50, "z" * 100, "z" * 100, prose(r, 20_000),
             "a\r\n\r\nWARC/1.1\r\n\r\n\x1f\x8b\x08" * 9] + [body] * 70
    texts += [prose(r, r.randint(0, 400)) for _ in range(n - len(texts))]
    rows = [(i * 3 - 40, r.choice([None, f"http://a/{i}", "http://b/é\r\nX-Bad: 1"]), t, "clash", 7)
            for i, t in enumerate(texts)]
    rows += [rows[9], rows[20], rows[11], (None, None, body, None, None), (None, None, "alone " * 40, None, None),
             (None, None, "alone " * 40, None, None), (None, None, None, None, None)]
    r.shuffle(rows)
    return rows


def expected(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        least = first.get(html)
        again = least is not None and page != least
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
                    least if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in df.collect()), key=str)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_equals_brute_force(spark, many_partitions, threshold):
    rows = page_rows()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got(warc.archived_pages(spark.createDataFrame(rows, SCHEMA).repartition(5))) == expected(rows)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("archive") / "a")
    rows = page_rows(2)
    warc.write_archive(warc.page_records(spark.createDataFrame(rows, SCHEMA).repartition(2)), path, maxFileBytes=20_000)
    return path, rows


def test_files_are_plain_gzip_and_warc(archive):
    path, rows = archive
    names = [n for n in os.listdir(path) if n.endswith(".warc.gz")]
    assert len(names) > 2
    content = b"".join(gzip.open(f"{path}/{n}").read() for n in names)
    assert content.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)
    assert b"\r\nX-Bad" not in content


@pytest.mark.parametrize("step", [701, 5_000, 1 << 26])
def test_any_ranges_give_every_record_once(archive, step):
    """A record belongs to the range it starts in, marks inside payloads do not count."""
    path, rows = archive
    reader = warc.WarcReader(warc.SCHEMA, {"path": path})
    found = []
    for name in os.listdir(path):
        if name.endswith(".gz"):
            with open(f"{path}/{name}", "rb") as f:
                data = f.read()
                file = pa.BufferReader(data)
                for at in range(0, len(data), step):
                    source = warc.Source(file, len(data))
                    found += list(reader.records(source, name, at, min(len(data), at + step)))
    names = [f.name for f in warc.SCHEMA.fields]
    payloads = sorted(dict(zip(names, x))["payload"] or b"" for x in found if x[0] == "response")
    assert len(found) == len(rows)
    assert payloads == sorted((r[2] or "").encode() for r, e in zip(rows, (kind(r, rows) for r in rows)) if e == "response")


def kind(row, rows):
    page, _, html, *_ = row
    same = [x[0] for x in rows if x[2] == html and x[0] is not None]
    return "revisit" if len((html or "").encode()) >= 100 and same and page != min(same) else "response"


def test_predicates_are_pushed_and_agree(spark, archive):
    path, _ = archive
    every = warc.read_archive(spark, path).cache()
    for where in ["record_type = 'revisit'", "record_type <> 'response'", "target_uri LIKE 'http://a/1%'",
                  "target_uri IS NULL", "content_length > 500 AND record_type IN ('response', 'request')",
                  "record_id >= '<urn:page:3' AND NOT record_id LIKE '%9>'", "refers_to <=> NULL",
                  "target_uri LIKE '%é%'", "offset > 0 AND record_type = 'response'", "headers['WARC-Type'] = 'revisit'"]:
        some = warc.read_archive(spark, path).where(where)
        assert sorted(map(str, some.collect())) == sorted(map(str, every.where(where).collect())), where
    plan = warc.read_archive(spark, path).where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan
    every.unpersist()


def test_unwanted_payloads_are_not_inflated(archive, monkeypatch):
    path, _ = archive
    schema = warc.T.StructType([warc.SCHEMA["record_type"], warc.SCHEMA["payload"]])
    reader = warc.WarcReader(schema, {"path": path})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit")])) == []
    inflated = []
    monkeypatch.setattr(warc.WarcReader, "decoded", lambda self, item, value, *_: inflated.append(value("record_type")) or {})
    rows = [b for part in reader.partitions() for b in reader.read(part)]
    assert sum(b.num_rows for b in rows) == len(inflated) and set(inflated) == {"revisit"}
    narrow = warc.WarcReader(warc.T.StructType([warc.SCHEMA["record_id"]]), {"path": path})
    monkeypatch.setattr(warc.Member, "block", lambda *_: pytest.fail("decoded"))
    assert sum(b.num_rows for part in narrow.partitions() for b in narrow.read(part)) > 0


def test_foreign_archives(spark, tmp_path):
    """Plain files, members without sizes, other record types and blocks, folded and repeated headers."""
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <a>\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    two = (b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <b>\r\nX-Long: one\r\n two\r\nX-Long: three\r\n"
           b"Content-Type: application/http;msgtype=response\r\nContent-Length: 32\r\n\r\nHTTP/1.0 200 OK\r\nA: b\r\n\r\npayload\r\n\r\n")
    plain = tmp_path / "in" / "sub"
    plain.mkdir(parents=True)
    (plain / "x.warc").write_bytes(one + two + one)
    (plain / "y.warc.gz").write_bytes(gzip.compress(two) + gzip.compress(one))
    (plain / "notes.txt").write_text("no archive")
    rows = warc.read_archive(spark, str(tmp_path / "in"), "record_id", "payload", "headers", "payload_bytes").collect()
    assert sorted((r.record_id, bytes(r.payload), r.payload_bytes) for r in rows) == [
        ("<a>", b"hello", 5)] * 3 + [("<b>", b"payload", 7)] * 2
    assert {r.headers["X-Long"] for r in rows if r.record_id == "<b>"} == {"one two"}
    (plain / "z.warc").write_bytes(b"nothing of the kind\r\n\r\n")
    with pytest.raises(Exception, match="no WARC record"):
        warc.read_archive(spark, str(tmp_path / "in")).collect()


def test_a_changed_payload_is_told(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archive(warc.page_records(spark.createDataFrame([(1, "u", "hello " * 30, None, 1)], SCHEMA)), path,
                       compression="none")
    name, = [n for n in os.listdir(path) if n.endswith(".warc")]
    data = open(f"{path}/{name}", "rb").read()
    open(f"{path}/{name}", "wb").write(data.replace(b"hello", b"hallo"))
    assert warc.read_archive(spark, path).count() == 1
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, path, "payload_sha256").collect()


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "a")
    pages = spark.createDataFrame([(1, "u", "one", None, 1)], SCHEMA)
    warc.write_archive(warc.page_records(pages), path)
    warc.write_archive(warc.page_records(pages.withColumn("page_id", F.lit(2))), path, mode="append")
    open(f"{path}/part-left-over.warc.gz", "wb").write(b"half a file")      # of a task that did not count
    assert sorted(r.record_id for r in warc.read_archive(spark, path).collect()) == ["<urn:page:1>", "<urn:page:2>"]
    warc.write_archive(warc.page_records(pages), path)
    assert [r.record_id for r in warc.read_archive(spark, path).collect()] == ["<urn:page:1>"]
