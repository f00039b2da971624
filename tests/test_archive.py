import gzip
import zlib
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from streetloom.operators import crawl
from streetloom.plans import extract
from streetloom.sources import archive, runs
from streetloom.streaming import intake

PAGE = (
    '<html><script type="application/ld+json">{"name":"Café","address":{"@type":"PostalAddress",'
    '"streetAddress":"Main St 5"}}</script></html>'
).encode()


def warc(kind, payload, n=0, version="WARC/1.0"):
    head = (
        f"{version}\r\nWARC-Type: {kind}\r\nWARC-Target-URI: http://h/{n}\r\nWARC-Record-ID: <urn:{n}>\r\n"
        f"WARC-Date: 2025-01-0{n + 1}\r\nContent-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode() + payload + b"\r\n\r\n"


def http(body, *headers):
    lines = ["HTTP/1.1 200 OK", *headers]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body


HTML = "Content-Type: text/html; charset=utf-8"
RECORDS = [
    ("warcinfo", b"software: x\r\n"),
    ("request", b"GET / HTTP/1.1\r\n\r\n"),
    ("response", http(PAGE, HTML)),
    ("response", http(b"WARC/1.0\r\nnot a record\r\n\r\n", HTML)),
    ("response", http(b"4\r\nabcd\r\n3\r\nefg\r\n0\r\n\r\n", HTML, "Transfer-Encoding: chunked")),
    ("response", http(gzip.compress(b"packed"), HTML, "Content-Encoding: gzip")),
    ("response", http(zlib.compress(b"deflated"), HTML, "Content-Encoding: deflate")),
    ("response", http(b"plain", HTML, "Content-Encoding: gzip")),
    ("metadata", b"fetchTime: 1\r\n"),
]
BODIES = [
    None, None, PAGE, b"WARC/1.0\r\nnot a record\r\n\r\n", b"abcdefg", b"packed", b"deflated", b"plain", None,
]


@pytest.fixture
def folder(tmp_path):
    parts = [warc(k, p, n) for n, (k, p) in enumerate(RECORDS)]
    (tmp_path / "plain.warc").write_bytes(b"".join(parts))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    return tmp_path


def listed(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "file_id string")


@pytest.mark.parametrize("name", ["plain.warc", "members.warc.gz"])
def test_records_and_bodies(spark, folder, name):
    rows = archive.scan_archives(listed(spark, name), str(folder)).collect()
    rows.sort(key=lambda r: r["ordinal"])
    assert [r["rec_type"] for r in rows] == [k for k, _ in RECORDS]
    assert [r["body"] and bytes(r["body"]) for r in rows] == BODIES
    assert [r["target_uri"] for r in rows] == [f"http://h/{n}" for n in range(len(RECORDS))]
    assert all(r["error"] is None for r in rows)


def test_source_reads_a_folder_and_pushes_the_type_filter(spark, folder):
    archive.register(spark)
    df = spark.read.format("webarchive").load(str(folder))
    assert df.rdd.getNumPartitions() == 2
    assert df.count() == 2 * len(RECORDS)
    assert df.where("rec_type = 'response'").count() == 2 * 6
    assert df.where("rec_type = 'request'").count() == 2


def test_source_reads_small_files_together(spark, tmp_path):
    """A folder of many small archives is no task per archive, and a bad one ends no other."""
    count = 3 * archive.LEAST_TASKS
    for n in range(count):
        (tmp_path / str(n % 7)).mkdir(exist_ok=True)
        text = warc("request", b"GET") + warc("response", http(b"%d" % n, HTML))
        data = gzip.compress(text)
        (tmp_path / str(n % 7) / f"{n}.warc.gz").write_bytes(data[: len(data) // 2] if n == 50 else data)
    archive.register(spark)
    df = spark.read.format("webarchive").load(str(tmp_path))
    assert df.rdd.getNumPartitions() <= archive.LEAST_TASKS
    rows = archive.good_records(df).where("rec_type = 'response'").collect()
    assert sorted(int(bytes(r["body"])) for r in rows) == [n for n in range(count) if n != 50]
    assert [r["file_id"] for r in archive.scan_errors(df).collect()] == [str(tmp_path / "1" / "50.warc.gz")]


def test_source_gives_large_files_tasks_of_their_own():
    mb = 1 << 20
    sizes = {f"big{n}": archive.TASK_BYTES + n for n in range(3)} | {f"small{n:05}": n % mb for n in range(20_000)}
    groups = archive._grouped(sizes)
    assert sorted(p for g in groups for p in g) == sorted(sizes)
    assert [g for g in groups if len(g) == 1] == [["big0"], ["big1"], ["big2"]]
    assert max(sum(sizes[p] for p in g) for g in groups[3:]) <= archive.TASK_BYTES + mb
    assert len(groups) < 700
    assert archive._grouped({"a": 0, "b": 5}) == [["a"], ["b"]] and archive._grouped({}) == []


def test_older_format(spark, tmp_path):
    body = http(b"<html>", "Content-Type: text/html")
    info = b"1 0 org\nURL IP\n"
    text = (
        f"filedesc://x.arc 0.0.0.0 20080430204825 text/plain {len(info)}\n".encode() + info + b"\n"
        + f"http://a/ 1.2.3.4 20080430204826 text/html {len(body)}\n".encode() + body + b"\n"
    )
    (tmp_path / "x.arc").write_bytes(text)
    rows = archive.scan_archives(listed(spark, "x.arc"), str(tmp_path)).collect()
    assert [(r["rec_type"], r["target_uri"], r["warc_date"]) for r in rows] == [
        ("warcinfo", "filedesc://x.arc", "2008-04-30T20:48:25Z"),
        ("response", "http://a/", "2008-04-30T20:48:26Z"),
    ]
    assert rows[1]["http_content_type"] == "text/html"


def test_bad_files_become_error_rows(spark, folder):
    whole = (folder / "members.warc.gz").read_bytes()
    (folder / "cut.warc.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "junk.warc.gz").write_bytes(b"not gzip")
    (folder / "empty.warc").write_bytes(b"")
    names = ["members.warc.gz", "cut.warc.gz", "junk.warc.gz", "gone.warc.gz", "empty.warc"]
    scan = archive.scan_archives(listed(spark, *names), str(folder), 3)
    assert {r["file_id"] for r in archive.scan_errors(scan).collect()} == set(names[1:4])
    assert archive.good_records(scan).where("file_id = 'members.warc.gz'").count() == len(RECORDS)


def whole_rows(scan):
    return sorted((tuple(r) for r in scan.collect()), key=lambda r: (r[0], r[1], r[8] or ""))


def test_parts_of_a_file_give_the_rows_of_the_whole(spark, folder):
    parts = [warc(k, p, n) for n, (k, p) in enumerate(RECORDS)]
    pairs = b"".join(gzip.compress(parts[i] + b"".join(parts[i + 1 : i + 2])) for i in range(0, len(parts), 2))
    whole = (folder / "members.warc.gz").read_bytes()
    odd = {
        "pairs.warc.gz": pairs, "one.warc.gz": gzip.compress(b"".join(parts)), "empty.warc": b"",
        "padded.warc.gz": b"".join(gzip.compress(p) + b"\0" * 20 for p in parts),
        "cut.warc.gz": whole[: len(whole) // 2], "junk.warc.gz": b"not gzip", "tail.warc.gz": whole + b"junk",
        "nested.warc.gz": b"".join(gzip.compress(warc("response", http(whole, HTML)), 0) for _ in range(3)),
        "header.warc": parts[0] + b"WARC/1.0\r\nno length\r\n\r\n",
    }
    for name, data in odd.items():
        (folder / name).write_bytes(data)
    names = ["plain.warc", "members.warc.gz", "gone.warc.gz", *odd]

    def halves(scan):
        """Rows of sound files; the files with an error, one each (rows before it may be read)."""
        rows = whole_rows(scan)
        bad = sorted(r[0] for r in rows if r[8])
        return [r for r in rows if r[0] not in bad], bad

    want = halves(archive.scan_archives(listed(spark, *names), str(folder)))
    assert want[1] == ["cut.warc.gz", "gone.warc.gz", "header.warc", "junk.warc.gz", "tail.warc.gz"]
    counts = {}
    for every in (1, 300, 1 << 30):
        found = archive.archive_ranges(listed(spark, *names), str(folder), every)
        counts[every] = Counter(r["file_id"] for r in found.collect())
        assert halves(archive.scan_ranges(found, str(folder))) == want
        assert halves(archive.scan_ranges(found, str(folder), 3)) == want
    assert counts[1]["plain.warc"] == counts[1]["members.warc.gz"] == counts[1]["padded.warc.gz"] == len(RECORDS)
    assert (counts[1]["pairs.warc.gz"], counts[1]["one.warc.gz"], counts[1]["nested.warc.gz"]) == (5, 1, 3)
    assert 1 < counts[300]["members.warc.gz"] < len(RECORDS)
    assert set(counts[1 << 30].values()) == {1}


def test_large_files_have_tasks_of_their_own(spark, folder, monkeypatch):
    monkeypatch.setattr(archive, "TASK_BYTES", 5_000)
    plain, names = (folder / "plain.warc").read_bytes(), []
    for n in range(40):
        names.append(f"{n}.warc")
        (folder / names[-1]).write_bytes(plain * (12 if n < 9 else 1))
    size = len(plain)
    assert 12 * size > 5_000 > 2 * size
    scan = archive.scan_archives(listed(spark, *names), str(folder))
    tasks = Counter()
    for task, file_id in scan.select(F.spark_partition_id(), "file_id").distinct().collect():
        tasks[task] += 1 + 100 * (int(file_id[:-5]) < 9)
    assert sorted(n for n in tasks.values() if n > 100) == [101] * 9
    assert sum(n for n in tasks.values() if n < 100) == 31
    assert scan.count() == len(RECORDS) * (9 * 12 + 31)


def test_paths_are_found_where_spark_finds_them(spark, folder):
    for root, name in (
        (f"file://{folder}", "plain.warc"), (str(folder), "plain.warc"), ("", str(folder / "plain.warc")),
        ("", f"file://{folder}/plain.warc"), (f"file://{folder.parent}", str(folder / "plain.warc")),
    ):
        assert archive.scan_archives(listed(spark, name), root).where("error is null").count() == len(RECORDS)


def test_record_data_survives_extraction(spark, folder):
    scan = archive.scan_archives(listed(spark, "members.warc.gz"), str(folder))
    rows = extract.extract_records(scan).selectExpr(
        "try_variant_get(data, '$.name', 'string') as name", "crawl_metadata.*"
    ).collect()
    assert [tuple(r) for r in rows] == [("Café", "http://h/2", "<urn:2>", "2025-01-03")]


def segment(n):
    return f"crawl/x/segments/1700.{n}/warc/F-{n:05d}.warc.gz"


def place(folder, n, data):
    path = folder / segment(n)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def four_archives(tmp_path):
    """Archives 1 (three pages), 2 (cut off), 3 (a page that is JSON), 4 (one page)."""
    good = b"".join(gzip.compress(warc("response", http(PAGE, HTML), n)) for n in range(3))
    json_page = gzip.compress(warc("response", http(b'{"x":"PostalAddress"}', HTML)))
    place(tmp_path, 1, good)
    place(tmp_path, 2, good[:-40])
    place(tmp_path, 3, json_page)
    place(tmp_path, 4, gzip.compress(warc("response", http(PAGE, HTML))))
    return good


def job_rows(spark, out):
    """What readers see: records and counters per file, files with errors, finished files."""
    stats = {(r["file_id"], r["key"]): r["value"] for r in extract.read_stats(spark, out).collect()}
    return (
        Counter(r["file_id"] for r in extract.read_records(spark, out).select("file_id").collect()),
        stats,
        Counter(r["file_id"] for r in extract.read_errors(spark, out).collect()),
        Counter(r["file_id"] for r in extract.finished(spark, out).collect()),
    )


def test_job_keeps_failed_files_pending(spark, tmp_path):
    good = four_archives(tmp_path)
    out = str(tmp_path / "out")
    todo = listed(spark, *map(segment, (1, 2, 3, 1)))
    extract.run(spark, todo, out, str(tmp_path), 2)
    records, stats, errors, done = job_rows(spark, out)
    assert (records, errors) == ({segment(1): 3}, {segment(2): 1})
    assert done == {segment(1): 1, segment(3): 1}
    assert stats[segment(1), "warc/html_response"] == 3
    assert stats[segment(3), "error/parsel/not_html"] == 1
    assert not any(f == segment(2) for f, _ in stats)
    row = extract.read_records(spark, out).first()
    assert (row["segment"], row["part"], row["crawl_metadata"]["url"][:9]) == ("1700.1", "00001", "http://h/")
    place(tmp_path, 2, good)
    extract.run(spark, todo, out, str(tmp_path), 2)  # the same list: only the open file is read
    records, stats, errors, done = job_rows(spark, out)
    assert (records, set(done.values())) == ({segment(1): 3, segment(2): 3}, {1})
    assert stats[segment(1), "warc/html_response"] == 3


class Crash(Exception):
    pass


@pytest.mark.parametrize("lost", range(7))
def test_job_that_stops_between_two_writes_adds_no_row_twice(spark, tmp_path, monkeypatch, lost):
    four_archives(tmp_path)
    out, todo = str(tmp_path / "out"), listed(spark, *map(segment, (1, 2, 3)))
    extract.run(spark, listed(spark, segment(4)), out, str(tmp_path), 2, "earlier")
    before = job_rows(spark, out)
    for name in ("parquet", "json"):
        write = getattr(DataFrameWriter, name)

        def counted(self, *args, write=write, **kwargs):
            nonlocal left
            left -= 1
            if left == -1:
                raise Crash  # the write with this number, and all after it, are lost
            return write(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, name, counted)
    left = lost
    with pytest.raises(Crash):
        extract.run(spark, todo, out, str(tmp_path), 2, "later")
    assert job_rows(spark, out) == before
    left = 100
    # under its own name, and under a new one beside what the lost run left
    extract.run(spark, todo, out, str(tmp_path), 2, "later" if lost % 2 else None)
    after = job_rows(spark, out)
    assert after[0] == {segment(1): 3, segment(4): 1}
    assert after[1][segment(1), "warc/record"] == 3
    assert after[2:] == ({segment(2): 1}, {segment(1): 1, segment(3): 1, segment(4): 1})
    gone = runs.sweep(spark, out, extract.TABLES)
    assert gone == ([] if lost % 2 or lost < 3 else ["later"])
    assert job_rows(spark, out) == after


def test_job_reads_archives_in_parts(spark, tmp_path):
    four_archives(tmp_path)
    todo = listed(spark, *map(segment, (1, 2, 3, 4)))
    parts = archive.archive_ranges(listed(spark, *map(segment, (1, 2, 5))), str(tmp_path), 1)
    assert parts.where(F.col("file_id") == segment(1)).count() == 3
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    extract.run(spark, todo, whole, str(tmp_path))
    extract.run(spark, todo, cut, str(tmp_path), parts=parts)
    assert job_rows(spark, cut) == job_rows(spark, whole)


def test_runs_on_the_same_files_count_once(spark, tmp_path, monkeypatch):
    four_archives(tmp_path)
    out, todo = str(tmp_path / "out"), listed(spark, *map(segment, (1, 3)))
    extract.run(spark, todo, out, str(tmp_path), 2, "a")
    # a second run that did not see the first one's commit
    monkeypatch.setattr(extract.manifest, "pending", lambda files, done: files)
    extract.run(spark, todo, out, str(tmp_path), 2, "b")
    assert runs.commits(spark, out).count() == 2
    records, stats, _, done = job_rows(spark, out)
    assert records == {segment(1): 3} and set(done.values()) == {1}
    assert extract.read_stats(spark, out).count() == len(stats)
    assert {r["run"] for r in extract.finished(spark, out).collect()} == {"a"}
    assert extract.run(spark, todo, out, str(tmp_path), 2, "b") == "b"
    assert runs.commits(spark, out).count() == 2


def test_stream_takes_each_manifest_once(spark, tmp_path):
    four_archives(tmp_path)
    lists = tmp_path / "lists"
    lists.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for n, (name, seen) in enumerate([(1, 3), (2, 3), (4, 4)]):
        (lists / f"{name}.paths").write_text(segment(name) + "\n" + segment(1) + "\n")
        intake.start(spark, str(lists), out, checkpoint, str(tmp_path)).awaitTermination()
        records, _, errors, done = job_rows(spark, out)
        assert (sum(records.values()), len(errors), len(done)) == (seen, n > 0, 1 + (n > 1))
    batch = str(tmp_path / "batch")
    extract.run(spark, listed(spark, *map(segment, (1, 2, 4))), batch, str(tmp_path), 2)
    assert job_rows(spark, out) == job_rows(spark, batch)


def test_stream_repeats_a_batch_that_was_lost(spark, tmp_path, monkeypatch):
    four_archives(tmp_path)
    lists = tmp_path / "lists"
    lists.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    (lists / "1.paths").write_text(segment(1) + "\n" + segment(2) + "\n")
    commit = runs.commit

    def start():
        intake.start(spark, str(lists), out, checkpoint, str(tmp_path)).awaitTermination()

    def lost(*args):
        raise Crash

    def late(*args):
        commit(*args)
        raise Crash

    for broken, seen in ((lost, 0), (late, 3)):
        monkeypatch.setattr(runs, "commit", broken)
        with pytest.raises(StreamingQueryException):
            start()
        assert sum(job_rows(spark, out)[0].values()) == seen
        monkeypatch.setattr(runs, "commit", commit)
    start()
    records, _, errors, done = job_rows(spark, out)
    assert (records, errors, done) == ({segment(1): 3}, {segment(2): 1}, {segment(1): 1})
    assert runs.commits(spark, out).count() == 1


def test_older_type_test_ignores_case(spark):
    df = spark.createDataFrame([("response", "TEXT/HTML"), ("response", None)], "rec_type string, http_content_type string")
    assert crawl.html_responses(df).count() == 0
    assert crawl.html_responses(df, ignore_case=True).count() == 1
