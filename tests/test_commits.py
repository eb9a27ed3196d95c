import json

import pytest

from parcelle.sources import commits, tables
from parcelle.streaming import listing_mart
from parcelle.streaming import listings_stream as stream

SCHEMA = "k string, v int, p string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _read(spark, path):
    return sorted((r.k, r.v, r.p) for r in commits.read_committed(spark, path, SCHEMA).collect())


def test_batches_compaction_and_left_overs(spark, tmp_path):
    path = str(tmp_path / "t")
    assert _read(spark, path) == [] and not commits.by_commits(spark, path)
    first = [("a", 1, "x"), ("b", 2, "y/é z")]
    assert commits.append_batch(_rows(spark, first), path, ["p"], 0)
    assert not commits.append_batch(_rows(spark, [("again", 9, "x")]), path, ["p"], 0)  # the same batch once more
    commits._write(_rows(spark, [("lost", 7, "x")]), path, ["p"], 5)  # an attempt that died before its commit
    assert commits.append_batch(_rows(spark, [("c", 3, "x")]), path, ["p"], 1)
    whole = sorted([*first, ("c", 3, "x")])
    assert _read(spark, path) == whole
    assert commits.compact(spark, path, SCHEMA, ["p"]) == 2 and _read(spark, path) == whole
    assert commits.compact(spark, path, SCHEMA, ["p"]) == 0
    assert commits.live_folders(spark, path).count() == 2
    assert commits.vacuum(spark, path) == 2 and _read(spark, path) == whole
    assert commits.append_batch(_rows(spark, []), path, ["p"], 2) and _read(spark, path) == whole
    assert not commits.append_batch(_rows(spark, [("c", 3, "x")]), path, ["p"], 1)  # known even after compaction


def test_a_batch_that_failed_is_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("no space")))
        with pytest.raises(OSError):
            commits.append_batch(_rows(spark, [("a", 1, "x")]), path, ["p"], 3)
    assert _read(spark, path) == []
    assert commits.append_batch(_rows(spark, [("a", 1, "x")]), path, ["p"], 3) and _read(spark, path) == [("a", 1, "x")]


def _stream(spark, folder):
    rows = stream.decode(spark.readStream.schema("value string").text(str(folder)))
    return rows


def _done(handle):
    handle.awaitTermination()
    assert handle.exception() is None


def _message(**fields):
    return json.dumps({"source": "s", "commune_code": "1", "price_m2": 10.0, "scraped_at": "2024-01-01", "rooms": "3"} | fields)


def test_registered_table_over_the_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    path = str(tmp_path / "bronze_listings")
    for k, messages in enumerate([[_message(listing_id="1"), _message(listing_id="2", rooms="T3")], [_message(listing_id="3", source="")]]):
        (inbox / f"{k}.txt").write_text("\n".join(messages))
        _done(stream.start_bronze(_stream(spark, inbox), path, str(tmp_path / "check"), drain=True))
    tables.register_tables(spark, str(tmp_path), ["bronze_listings"], "commits_test")
    name = "commits_test.bronze_listings"
    seen = lambda: sorted((r.listing_id, r.rooms, r.source_name) for r in spark.table(name).collect())
    assert seen() == [("1", 3, "s"), ("2", None, "s"), ("3", 3, "unknown")]
    assert stream.compact_bronze(spark, path, most=0) == 2
    tables.repair(spark, name, path)
    commits.vacuum(spark, path)
    assert seen() == [("1", 3, "s"), ("2", None, "s"), ("3", 3, "unknown")]


def test_mart_takes_older_snapshots_back(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    root, check = str(tmp_path / "mart"), str(tmp_path / "check")
    steps = [
        [_message(listing_id="1", price_m2=1.0), _message(listing_id="2", price_m2=5.0), _message(listing_id="", price_m2=7.0)],
        [_message(listing_id="1", price_m2=3.0, scraped_at="2024-01-03"), _message(listing_id="2", price_m2=5.0)],  # a replay
        [_message(listing_id="1", price_m2=9.0, scraped_at="2024-01-02")],  # late
        [_message(listing_id="2", commune_code="2", price_m2=6.0, scraped_at="2024-02-01")],  # moves
    ]
    want = [
        {"1": (3, 5.0, 1.0, 7.0, "2024-01-01")},
        {"1": (3, 5.0, 3.0, 7.0, "2024-01-03")},
        {"1": (3, 5.0, 3.0, 7.0, "2024-01-03")},
        {"1": (2, 5.0, 3.0, 7.0, "2024-01-03"), "2": (1, 6.0, 6.0, 6.0, "2024-02-01")},
    ]
    for k, (messages, figures) in enumerate(zip(steps, want, strict=True)):
        (inbox / f"{k}.txt").write_text("\n".join(messages))
        rows = _stream(spark, inbox).where("quarantine is null")
        _done(listing_mart.start_mart(rows, root, check, drain=True, most=1))
        got = {
            r.code_commune: (r.listing_count, r.median_listing_price_m2, r.min_listing_price_m2, r.max_listing_price_m2, r.last_updated)
            for r in listing_mart.current_figures(spark, root).collect()
        }
        assert got == figures


def test_newest_row_of_a_frame_by_age():
    """One pass over whole columns gives the row that a comparison of all rows by age gives."""
    import itertools

    import pandas as pd

    times, prices = [None, "2024-01-01", "2024-01-03"], [1.0, 4.0]
    rows = [(str(k), p, t) for k, (t, p) in enumerate(itertools.product(times, prices))]
    for chosen in itertools.permutations(rows, 3):
        frame = pd.DataFrame(chosen, columns=["commune_code", "price_m2", "scraped_at"])
        assert listing_mart._newest(frame) == max(chosen, key=listing_mart._age)


def test_a_commit_runs_no_job_and_appears_whole(spark, tmp_path):
    """The log's file is written and renamed by the driver; one look at the log serves the batch and its version."""
    path, seen = str(tmp_path / "t"), spark.sparkContext.statusTracker()
    assert commits.append_batch(_rows(spark, [("a", 1, "é x")]), path, ["p"], 0)
    spark.sparkContext.setJobGroup("commit", "commit")
    try:
        commits.commit(spark, path, 7, ["p=%C3%A9 x/batch_id=7"], ["p=é/batch_id=0"], last=4)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not seen.getJobIdsForGroup("commit")
    log = {r.version: (r.batch_id, r.writer, r.add, r.remove, r.entries) for r in commits.commits(spark, path).collect()}
    assert log[5] == (7, "stream", ["p=%C3%A9 x/batch_id=7"], ["p=é/batch_id=0"], 0) and set(log) == {1, 5}
    assert not [f.name for f in (tmp_path / "t" / "_commits").iterdir() if f.name.endswith(".tmp")]
    assert commits._known(spark, path, 7, "stream") == (True, 5) and commits._known(spark, path, 7, "other") == (False, 5)
