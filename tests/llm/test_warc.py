import gzip
import hashlib
import random

import pytest

from docweave.llm import warc
from docweave.llm.common import shared_path
from docweave.llm.queries import op2_warc


def expected(rows):
    big = {}
    for i, html in rows:
        if len(html) >= 1000:
            big[html] = max(big.get(html, -1), i)
    out = {}
    for i, html in rows:
        last = big.get(html, i)
        out[i] = (len(html), hashlib.sha1(html).hexdigest(), "revisit" if last > i else "response", last if last > i else None)
    return out


def write(spark, rows, **options):
    path = shared_path(spark, "warc-test")
    warc.write_warc(warc.page_records(spark.createDataFrame(rows, "page_id long, url string, html string")), path, **options)
    return path


def test_records_read_back(spark):
    rows = [(1, "http://a/", "x" * 2000), (2, "http://b/\r\nX: y", "x" * 2000), (3, None, None), (4, "http://d/", "é" * 700), (5, "http://e/", "small"), (6, "http://f/", "small")]
    path = write(spark, rows, file_mb="0.001")
    got = {r.record_id: r for r in warc.read_warc(spark, path, split_mb="0.001").collect()}
    assert len(got) == 6 and got["urn:page:1"].record_type == "revisit" and got["urn:page:1"].refers_to_id == "urn:page:2"
    assert got["urn:page:1"].payload is None and got["urn:page:1"].http_length == 2000
    assert bytes(got["urn:page:4"].payload).decode() == "é" * 700 and bytes(got["urn:page:3"].payload) == b""
    assert got["urn:page:2"].target_uri == "http://b/ X: y" and got["urn:page:3"].target_uri is None


def test_files_are_gzip_members_that_any_reader_inflates(spark):
    path = write(spark, [(1, "u", "y" * 100), (2, "u", "z" * 100)])
    fs, root = warc.open_fs(path)
    files = [f for f in fs.get_file_info(warc.pafs.FileSelector(root)) if f.base_name.endswith(".warc.gz")]
    whole = b"".join(gzip.decompress(fs.open_input_file(f.path).read()) for f in files)
    assert whole.count(b"WARC/1.1\r\n") == 2 and whole.count(b"Content-Length: 100\r\n\r\n") == 2


def test_filters_reach_the_source(spark):
    path = write(spark, [(i, f"http://h{i}/", "q" * 1500 if i < 3 else str(i)) for i in range(6)])
    df = warc.read_warc(spark, path, payload="false")
    revisits = df.where("record_type = 'revisit'")
    assert "record_type" not in [x for x in revisits._jdf.queryExecution().executedPlan().toString().split("\n") if "Filter" in x and "isnotnull" not in x] and revisits.count() == 2
    assert df.where("target_uri in ('http://h4/', 'http://h5/')").count() == 2
    assert [r.payload for r in df.where("record_id = 'urn:page:4'").collect()] == [None]
    reader = warc.WarcReader({"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("http_length",), 3)]))
    assert len(left) == 1 and reader.tests == [("record_type", "in", ("revisit",))]


def test_plain_foreign_and_damaged_files(spark):
    path = shared_path(spark, "warc-plain")
    fs, root = warc.open_fs(path)
    fs.create_dir(root)
    a, b = (warc.record("response", f"r{i}", "u", "d", None, b"p" * n) for i, n in ((1, 9000), (2, 10)))
    with fs.open_output_stream(f"{root}/x.warc") as f:
        f.write(a + b)
    with fs.open_output_stream(f"{root}/y.warc.gz", compression=None) as f:
        f.write(gzip.compress(a) + gzip.compress(b))
    got = warc.read_warc(spark, path).collect()
    assert sorted(len(r.payload) for r in got) == [10, 10, 9000, 9000]
    with fs.open_output_stream(f"{root}/z.warc.gz", compression=None) as f:
        f.write(warc.member(a)[:-200])
    with pytest.raises(Exception, match="z.warc.gz"):
        warc.read_warc(spark, path).collect()


def test_empty_table(spark):
    path = shared_path(spark, "warc-empty")
    warc.write_warc(warc.page_records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read_warc(spark, path).count() == 0


def test_query(spark, sf):
    rows = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op2_warc(spark, sf).collect()}
    assert got == expected(rows)


def test_a_cut_file_is_an_error_whatever_is_read(spark, tmp_path):
    rows = [(f"r{i}", "response", f"http://x/{i}", "2024-01-01T00:00:00Z", None, bytes(random.Random(i).randbytes(3000))) for i in range(4)]
    path = f"file://{tmp_path}/cut"
    warc.write_warc(spark.createDataFrame(rows, warc.WRITE_SCHEMA).coalesce(1), path)
    (file,) = (tmp_path / "cut").glob("*.warc.gz")
    file.write_bytes(file.read_bytes()[:-500])
    for options, where in (({}, "true"), ({"payload": "false"}, "true"), ({}, "record_type = 'revisit'"), ({"payload": "false"}, "record_id = 'r0'")):
        with pytest.raises(Exception, match="cut off"):
            warc.read_warc(spark, path, **options).where(where).collect()


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_payloads_that_many_pages_share(spark, monkeypatch, share):
    """A third of the pages have one payload, others two; ids are null or repeat. Whether a payload is joined by broadcast makes no difference."""
    monkeypatch.setattr(warc, "HOT_SHARE", share)
    body = lambda i: "x" * 1500 if i % 3 == 0 else f"{i // 2}" * 800 if i % 3 == 1 else f"{i}"
    rows = [(None if i % 10 == 9 else i // 2 if i > 110 else i, f"http://a/{i}", body(i)) for i in range(120)] + [(None, None, None)] * 3
    got = warc.page_records(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    last = {}
    for i, _, text in rows:
        if i is not None and len(text) >= 1000:
            last[text] = max(i, last.get(text, i))
    want = []
    for i, url, text in rows:
        first = last.get(text) if i is not None else None
        refers = f"urn:page:{first}" if first is not None and first > i else None
        want.append((f"urn:page:{'' if i is None else i}", "revisit" if refers else "response", url, refers, (text or "").encode()))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.record_id, r.record_type, r.target_uri, r.refers_to_id, bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)
