import json

from streetloom.streaming import dedup


def put(folder, name, rows):
    """One file of records: (url, data, date)."""
    lines = [
        json.dumps({"file_id": name, "data": data, "crawl_metadata": {"url": url, "warc_rec_id": "r", "warc_date": date}})
        for url, data, date in rows
    ]
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


def take(spark, folder, tmp_path, delay="30 days"):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    dedup.start(spark, str(folder), out, checkpoint, delay, 1).awaitTermination()
    rows = spark.read.parquet(out).collect()
    return sorted((r["file_id"], r["crawl_metadata"]["url"], r["data"], r["crawl_metadata"]["warc_date"]) for r in rows)


def day(n, time="00:00:00Z"):
    return f"2025-01-{n:02d}T{time}"


def test_copies_of_earlier_batches_are_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a", [("u1", '{"x":1}', day(1)), ("u1", '{"x":1}', day(1)), ("u1", '{"x":2}', day(1)), ("u2", '{"x":1}', day(2, "03:04:05.678Z"))])
    first = take(spark, folder, tmp_path)
    assert [r[1:3] for r in first] == [("u1", '{"x":1}'), ("u1", '{"x":2}'), ("u2", '{"x":1}')]
    # the state is kept from run to run
    put(folder, "b", [("u1", '{"x":1}', day(3)), ("u3", '{"x":1}', day(3)), ("u2", '{"x":1}', day(1))])
    assert take(spark, folder, tmp_path) == sorted([*first, ("b", "u3", '{"x":1}', day(3))])
    assert len(take(spark, folder, tmp_path)) == 4


def test_records_without_a_date_are_kept(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a", [("u1", "1", None), ("u1", "1", "soon"), ("u1", "1", day(1)), (None, None, day(1)), (None, None, day(1))])
    rows = dedup.record_stream(spark, str(folder))
    assert rows.isStreaming
    out = str(tmp_path / "out")
    dedup.start(spark, str(folder), out, str(tmp_path / "c")).awaitTermination()
    got = sorted((r["crawl_metadata"]["url"] or "", r["crawl_metadata"]["warc_date"] or "") for r in spark.read.parquet(out).collect())
    assert got == [("", day(1)), ("u1", ""), ("u1", day(1)), ("u1", "soon")]


def test_state_expires_behind_the_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, row in {"a": ("u1", "1", day(1)), "b": ("u9", "1", day(20)), "c": ("u9", "2", day(21)), "d": ("u1", "1", day(22))}.items():
        put(folder, name, [row])
        got = take(spark, folder, tmp_path, "5 days")
    # the first record of u1 is forgotten after five days, so its copy counts again
    assert [r[:2] for r in got] == [("a", "u1"), ("b", "u9"), ("c", "u9"), ("d", "u1")]
    put(folder, "e", [("u1", "1", day(23)), ("u2", "1", day(2))])  # a copy, and a late record
    assert take(spark, folder, tmp_path, "5 days") == got


def test_empty_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("")
    assert take(spark, folder, tmp_path) == []
