"""The landing table: contract, entries, replays, packs, reads that skip files."""

import json
import random
from datetime import date, timedelta

import pytest
from build import T0, at, landing, rows_of
from pyspark.sql import functions as F

from touchtrail.operators import reports
from touchtrail.sources import files
from touchtrail.sources import landing as landings
from touchtrail.sources.landing import append_delivery, create_landing, read_landing


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "landing")
    create_landing(spark, path)
    return path


def _rows(spark, *moments, loaded=0, user="u"):
    return landing(
        spark,
        [
            {
                "event_id": f"{user}-{n}-{m}",
                "event_ts": None if m is None else at(minutes=m),
                "user_pseudo_id": user,
                "inserted_at": at(minutes=loaded),
            }
            for n, m in enumerate(moments)
        ],
    )


def _data_files(spark, path):
    stored = spark.read.schema(landings.STORED).parquet(path)
    return {f.split("/feed=")[1] for f in stored.inputFiles()}


# Contract


def test_other_folders_and_other_columns_are_refused(spark, tmp_path, table):
    create_landing(spark, table)
    other = str(tmp_path / "other")
    spark.range(3).write.parquet(other)
    with pytest.raises(landings.ContractError, match="no landing table"):
        create_landing(spark, other)
    with pytest.raises(landings.ContractError, match="create it first"):
        read_landing(spark, str(tmp_path / "missing"))
    contract = json.loads(files.read_text(spark, f"{table}/_contract.json"))
    for field in contract["fields"]:
        if field["name"] == "purchase_revenue":
            field["type"] = "string"
    contract["fields"] = [f for f in contract["fields"] if f["name"] != "campaign"]
    files.write_over(spark, f"{table}/_contract.json", json.dumps(contract))
    told = "campaign: missing instead of string; purchase_revenue: string instead of double"
    for use in (create_landing, read_landing, landings.deliveries, landings.compact):
        with pytest.raises(landings.ContractError, match=told):
            use(spark, table)
    with pytest.raises(landings.ContractError):
        append_delivery(_rows(spark, 1), table, "f", 0)


# Entries and replays


def test_rows_count_once_their_entry_is_complete(spark, table):
    assert read_landing(spark, table).count() == 0
    append_delivery(_rows(spark, 1, 2), table, "f", 0)
    # A writer that ended before its entry, and one that ended within it.
    _rows(spark, 3).withColumn("load_date", F.lit(T0.date())).write.partitionBy("load_date").parquet(
        f"{table}/feed=f/first=1/last=1"
    )
    assert read_landing(spark, table).count() == 2
    whole = files.read_text(spark, f"{table}/_deliveries/f/0-0.json")
    files.write_over(spark, f"{table}/_deliveries/f/1-1.json", whole[: len(whole) // 2])
    assert read_landing(spark, table).count() == 2
    # Taken up again, both are replaced.
    assert append_delivery(_rows(spark, 3, 4, 5), table, "f", 1)
    assert read_landing(spark, table).count() == 5


def test_a_replay_lands_once_also_across_midnight(spark, table):
    first = _rows(spark, 1, 2, loaded=23 * 60 + 59)
    assert append_delivery(first, table, "f", 0)
    assert not append_delivery(_rows(spark, 1, 2, loaded=24 * 60 + 1), table, "f", 0)
    assert append_delivery(_rows(spark, 1, 2, loaded=24 * 60 + 1), table, "g", 0)
    assert read_landing(spark, table).count() == 4
    stored = spark.read.schema(landings.STORED).parquet(table)
    assert rows_of(stored.groupBy("feed", "load_date").count()) == [
        ("f", T0.date(), 2),
        ("g", T0.date() + timedelta(days=1), 2),
    ]


def test_entries_tell_rows_times_and_minutes(spark, table):
    append_delivery(_rows(spark, 5, None, 3, loaded=7), table, "f", 0)
    append_delivery(_rows(spark, loaded=9), table, "f", 1)
    entry, empty = landings.deliveries(spark, table).orderBy("first").collect()
    assert (entry.rows, entry.last_loaded, empty.rows) == (3, int(at(minutes=7).timestamp() * 1e6), 0)
    assert sum(f.rows for f in entry.files) == 3 and sum(f.timed for f in entry.files) == 2
    spans = [(f.first_ts, f.last_ts) for f in entry.files if f.timed]
    assert min(s for s, _ in spans) == int(at(minutes=3).timestamp() * 1e6)
    assert max(e for _, e in spans) == int(at(minutes=5).timestamp() * 1e6)
    assert rows_of(landings.read_delivery(spark, table, "f", 1)) == []
    assert landings.read_delivery(spark, table, "f", 0).count() == 3


# Packs


def test_packs_read_as_before_and_bound_the_files(spark, table):
    for n in range(40):
        append_delivery(_rows(spark, n, n + 1, loaded=60 * n, user=f"u{n}"), table, "f", n)
    append_delivery(_rows(spark, 7), table, "g", 0)
    before = rows_of(read_landing(spark, table))
    assert landings.deliveries(spark, table).count() == 41
    assert landings.compact(spark, table) == 1
    # One pack, the delivery that may still be written, and the other feed.
    assert landings.deliveries(spark, table).count() == 3
    assert rows_of(read_landing(spark, table)) == before
    assert landings.compact(spark, table) == 0
    per_day = (
        landings.deliveries(spark, table)
        .select(F.explode("files.name").alias("name"), F.lit(1).alias("n"))
        .groupBy(F.substring_index("name", "/", 1).alias("day"))
        .agg(F.sum("n").alias("files"))
    )
    assert max(r.files for r in per_day.collect()) <= 4
    # Replays of packed and of unpacked deliveries land nothing.
    for n in (0, 17, 38, 39):
        assert not append_delivery(_rows(spark, n, n + 1, user=f"u{n}"), table, "f", n)
    assert rows_of(read_landing(spark, table)) == before
    # The packed ones stay for a while, then they go, and the table reads the same.
    assert landings.clean(spark, table) == 0
    assert landings.clean(spark, table, timedelta(0)) == 39
    assert landings.clean(spark, table, timedelta(0)) == 0
    assert rows_of(read_landing(spark, table)) == before
    assert {f.split("/load_date")[0] for f in _data_files(spark, table)} == {
        "f/first=0/last=38", "f/first=39/last=39", "g/first=0/last=0",
    }
    # Later deliveries and the pack go into a larger one.
    for n in range(40, 50):
        append_delivery(_rows(spark, n, loaded=60 * n), table, "f", n)
    before = rows_of(read_landing(spark, table))
    assert landings.compact(spark, table) == 1
    assert rows_of(read_landing(spark, table)) == before
    spans = rows_of(landings.deliveries(spark, table).where("feed = 'f'"), "first", "last")
    assert spans == [(0, 48), (49, 49)]


def test_packs_are_bounded_by_bytes_and_a_full_one_is_left_alone():
    class Entry(dict):
        __getattr__ = dict.__getitem__

    def sizes(packs):
        return [[e.bytes for e in pack] for pack in packs]

    small = [Entry(bytes=b) for b in (3, 3, 3, 9, 1, 1, 1, 20, 2, 2)]
    assert sizes(landings._packs(small, 10, 2)) == [[3, 3, 3], [1, 1], [2, 2]]
    assert sizes(landings._packs(small, 10, 3)) == [[3, 3, 3]]
    # What is larger than all the rest is not written again for the sake of the rest.
    assert sizes(landings._packs(small, 1000, 3)) == [[e.bytes for e in small]]
    uneven = [Entry(bytes=b) for b in (90, 1, 1, 1, 60, 2, 2, 2)]
    assert sizes(landings._packs(uneven, 1000, 3)) == [[1, 1, 1], [2, 2, 2]]
    assert sizes(landings._packs([], 10, 2)) == []


def test_a_row_is_packed_as_often_as_its_pack_doubles():
    class Entry(dict):
        __getattr__ = dict.__getitem__

    entries, written = [], 0
    for n in range(2_000):
        entries.append(Entry(bytes=1, n=n))
        if n % 10 == 9:
            for pack in list(landings._packs(entries[:-1], 10**6, 8)):
                place = entries.index(pack[0])
                entries[place : place + len(pack)] = [Entry(bytes=sum(e.bytes for e in pack), n=pack[0].n)]
                written += entries[place].bytes
    assert sum(e.bytes for e in entries) == 2_000
    assert len(entries) < 60 and written < 2_000 * 11


def test_a_pack_that_was_not_finished_changes_nothing(spark, table, monkeypatch):
    for n in range(5):
        append_delivery(_rows(spark, n), table, "f", n)
    before = rows_of(read_landing(spark, table))

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(landings, "_facts", fail)
        with pytest.raises(RuntimeError, match="lost"):
            landings.compact(spark, table, least=2)
    assert rows_of(read_landing(spark, table)) == before
    assert landings.compact(spark, table, least=2) == 1
    assert rows_of(read_landing(spark, table)) == before


# Reads that skip files


def _opened(df):
    return {f.split("/feed=")[1].split("/load_date")[0] for f in df.inputFiles()}


def test_latest_rows_open_only_files_that_can_hold_them(spark, table):
    for n in range(6):
        append_delivery(_rows(spark, *range(100 * n, 100 * n + 30), user=f"u{n}"), table, "f", n)
    # A late delivery of old events, and one that holds an old and a new one.
    append_delivery(_rows(spark, 150, 151, user="late"), table, "f", 6)
    append_delivery(_rows(spark, 10, 515, user="both"), table, "f", 7)
    append_delivery(_rows(spark, None, user="no time"), table, "f", 8)
    everything = reports.live_events(read_landing(spark, table), 10)
    latest = landings.read_latest(spark, table, 10)
    assert rows_of(reports.live_events(latest, 10)) == rows_of(everything)
    assert _opened(latest) <= {"f/first=5/last=5", "f/first=7/last=7"}
    assert latest.count() < 60
    for n in (1, 30, 31, 63, 184, 185, 186, 400):
        got = reports.live_events(landings.read_latest(spark, table, n), n)
        assert rows_of(got) == rows_of(reports.live_events(read_landing(spark, table), n)), n
    # Packed in order of time, a single pack has several files; the early ones stay closed.
    landings.compact(spark, table, least=2, file_bytes=1_000)
    packed = landings.read_latest(spark, table, 10)
    assert rows_of(reports.live_events(packed, 10)) == rows_of(everything)
    assert len(packed.inputFiles()) < len(read_landing(spark, table).inputFiles()) / 2


def test_latest_rows_equal_a_full_sort_on_random_deliveries(spark, tmp_path):
    draw = random.Random(5)
    for case in range(3):
        path = str(tmp_path / f"landing-{case}")
        create_landing(spark, path)
        for n in range(5):
            moments = [draw.choice([None, draw.randrange(40), draw.randrange(900)]) for _ in range(draw.randrange(9))]
            append_delivery(_rows(spark, *moments, user=f"u{n}"), path, "f", n)
        for n in (1, 3, 10, 100):
            got = reports.live_events(landings.read_latest(spark, path, n), n)
            assert rows_of(got) == rows_of(reports.live_events(read_landing(spark, path), n))


def test_days_open_only_files_that_hold_them(spark, table):
    for n in range(4):
        append_delivery(_rows(spark, 1440 * n, 1440 * n + 5), table, "f", n)
    append_delivery(_rows(spark, None, 3), table, "f", 4)
    first, third = T0.date(), T0.date() + timedelta(days=2)
    some = read_landing(spark, table, [first, third])
    assert _opened(some) == {"f/first=0/last=0", "f/first=2/last=2", "f/first=4/last=4"}
    assert some.count() == 5
    assert read_landing(spark, table, [None]).count() == 1
    assert read_landing(spark, table, [date(2030, 1, 1)]).count() == 0
    assert read_landing(spark, table, []).count() == 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(event_ts" in plan


def test_reports_from_entries_read_no_rows(spark, table):
    draw = random.Random(6)
    for n in range(5):
        moments = [draw.randrange(600) for _ in range(20)]
        append_delivery(_rows(spark, *moments, loaded=draw.randrange(600)), table, "f", n)
    no_load_time = landing(spark, [{"event_id": "x", "event_ts": at()}])
    append_delivery(no_load_time, table, "g", 0)
    now = at(days=1)
    rows = read_landing(spark, table)
    fresh = reports.freshness(landings.last_loads(spark, table), now)
    assert rows_of(fresh) == rows_of(reports.freshness(rows, now))
    for width in ("1 hour", "10 minutes"):
        trend = reports.row_count_trend(landings.load_minutes(spark, table), width)
        assert rows_of(trend) == rows_of(reports.row_count_trend(rows, width))
    landings.compact(spark, table, least=2)
    for report in (fresh, reports.row_count_trend(landings.load_minutes(spark, table))):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "parquet" not in plan.lower() and "FileScan json" in plan
    assert rows_of(reports.row_count_trend(landings.load_minutes(spark, table))) == rows_of(
        reports.row_count_trend(rows)
    )


def test_freshness_of_an_empty_table_is_an_error(spark, table):
    assert reports.freshness(landings.last_loads(spark, table), at()).first().status == "error"
    assert reports.row_count_trend(landings.load_minutes(spark, table)).count() == 0
    assert landings.read_latest(spark, table, 5).count() == 0
