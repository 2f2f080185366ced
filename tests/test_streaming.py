import json
from datetime import timedelta

import pytest
from build import at, landing, nested, rows_of

from touchtrail.functions.columns import landing_key_id
from touchtrail.operators import staging
from touchtrail.plans import pipeline, publish
from touchtrail.schemas import FLAT_EVENTS, LANDING_EVENTS, MARTS, NESTED_EVENTS
from touchtrail.sources.batch import read_nested_events
from touchtrail.sources.landing import (
    append_delivery,
    create_landing,
    read_landing,
    streamed_events,
)
from touchtrail.streaming import ingest, refresh


def _drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def _sent(user, ts, **rest):
    return {
        "event_ts": ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
        "event_name": "page_view",
        "user_pseudo_id": user,
        "ga_session_id": 100_001,
        "source": "google",
        "medium": "cpc",
        **rest,
    }


def _run(spark, tmp_path, checkpoint):
    stream = ingest.read_stream(spark, str(tmp_path / "inbox"))
    ingest.ingest_available(stream, str(tmp_path / "landing"), str(tmp_path / checkpoint))
    return read_landing(spark, str(tmp_path / "landing"))


def _staged(spark, raw):
    return staging.stage_events(spark.createDataFrame([], FLAT_EVENTS), streamed_events(raw))


@pytest.fixture
def inbox(spark, tmp_path):
    create_landing(spark, str(tmp_path / "landing"))
    rows = [_sent("stream_user_0", at(seconds=i, milliseconds=250)) for i in range(6)]
    _drop(tmp_path / "inbox", "a.json", rows)
    return tmp_path


def test_create_landing_is_idempotent(spark, inbox):
    assert read_landing(spark, str(inbox / "landing")).count() == 0
    assert _run(spark, inbox, "cp").count() == 6
    create_landing(spark, str(inbox / "landing"))
    raw = read_landing(spark, str(inbox / "landing"))
    assert raw.count() == 6
    assert [(f.name, f.dataType) for f in raw.schema] == [
        (f.name, f.dataType) for f in LANDING_EVENTS
    ]


def test_landing_ids_do_not_depend_on_the_session_zone(spark, in_zone):
    rows = landing(spark, [{"event_ts": at(hours=23, minutes=59, seconds=58)}])
    wanted = rows.select(landing_key_id()).first()[0]
    for zone in ("America/Los_Angeles", "Asia/Kathmandu"):
        in_zone(zone)
        assert rows.select(landing_key_id()).first()[0] == wanted


def test_arriving_rows_are_stamped(spark, inbox):
    raw = _run(spark, inbox, "cp")
    assert raw.where("inserted_at IS NULL OR event_id IS NULL").count() == 0
    assert raw.where("event_ts <> date_trunc('second', event_ts)").count() == 0
    assert raw.where(raw.event_id != landing_key_id()).count() == 0
    import hashlib

    text = "stream_user_0|page_view|2021-01-01 00:00:03"
    assert hashlib.sha256(text.encode()).hexdigest() in {r.event_id for r in raw.collect()}


def test_same_checkpoint_lands_only_what_is_new(spark, inbox):
    assert _run(spark, inbox, "cp").count() == 6
    assert _run(spark, inbox, "cp").count() == 6
    _drop(inbox / "inbox", "b.json", [_sent("stream_user_1", at(hours=1))])
    assert _run(spark, inbox, "cp").count() == 7


def test_fresh_checkpoint_lands_again_and_staging_removes_the_copies(spark, inbox):
    once = rows_of(_staged(spark, _run(spark, inbox, "cp-1")))
    again = _run(spark, inbox, "cp-2")
    assert again.count() == 12
    assert rows_of(_staged(spark, again)) == once and len(once) == 6


def test_a_row_late_by_days_is_kept(spark, inbox):
    _run(spark, inbox, "cp")
    _drop(inbox / "inbox", "late.json", [_sent("stream_user_0", at() - timedelta(days=9))])
    assert _staged(spark, _run(spark, inbox, "cp")).count() == 7


def test_a_replayed_delivery_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "landing")
    create_landing(spark, path)
    rows = landing(spark, [{"event_id": "a", "event_ts": at()}])
    for feed, delivery in (("f", 0), ("f", 0), ("f", 1), ("g", 0)):
        append_delivery(rows, path, feed, delivery)
    assert read_landing(spark, path).count() == 3


def test_pre_filter_drops_copies(spark, inbox):
    rows = [_sent("stream_user_0", at(seconds=i, milliseconds=250)) for i in range(6)]
    _drop(inbox / "inbox", "copy.json", rows)
    stream = ingest.first_deliveries(ingest.read_stream(spark, str(inbox / "inbox")))
    ingest.ingest_available(stream, str(inbox / "landing"), str(inbox / "cp"))
    assert read_landing(spark, str(inbox / "landing")).count() == 6


# Malformed lines


def _text(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def _lines():
    sound = [json.dumps(_sent("stream_user_0", at(seconds=i))) for i in range(4)]
    bad = [
        "{broken",
        json.dumps({**_sent("u", at()), "event_ts": "no time"}),
        json.dumps({**_sent("u", at()), "ga_session_id": "seven"}),
        json.dumps({**_sent("u", at()), "purchase_revenue": {"a": 1}}),
        "[1, 2",
        "plain text",
    ]
    return sound, bad


def _land_lines(spark, tmp_path, rejects, checkpoint="cp"):
    stream = ingest.read_stream(spark, str(tmp_path / "inbox"))
    ingest.ingest_available(
        stream, str(tmp_path / "landing"), str(tmp_path / checkpoint), rejects and str(tmp_path / rejects)
    )
    return read_landing(spark, str(tmp_path / "landing"))


def test_malformed_lines_go_to_the_rejects_with_their_text(spark, tmp_path):
    create_landing(spark, str(tmp_path / "landing"))
    sound, bad = _lines()
    odd = ['{"event_name": "page_view", "unknown": 1}', "{}", ""]
    _text(tmp_path / "inbox", "a.json", [*sound[:2], *bad, *sound[2:], *odd])
    landed = _land_lines(spark, tmp_path, "rejects")
    # Sound lines land whole, unknown keys are left out, missing ones are null.
    assert landed.count() == len(sound) + 2
    assert landed.where("event_ts IS NOT NULL AND event_id IS NOT NULL").count() == len(sound)
    rejects = ingest.read_rejects(spark, str(tmp_path / "rejects"))
    assert sorted(r.line for r in rejects.collect()) == sorted(bad)
    assert {r.sent_file.rsplit("/", 1)[1] for r in rejects.collect()} == {"a.json"}
    assert rejects.where("rejected_at IS NULL OR feed IS NULL OR delivery <> 0").count() == 0
    # A batch of sound lines writes no rejects, and a fresh checkpoint rejects again.
    _text(tmp_path / "inbox", "b.json", sound)
    assert _land_lines(spark, tmp_path, "rejects").count() == 2 * len(sound) + 2
    assert ingest.read_rejects(spark, str(tmp_path / "rejects")).count() == len(bad)
    _land_lines(spark, tmp_path, "rejects", "cp-2")
    assert ingest.read_rejects(spark, str(tmp_path / "rejects")).count() == 2 * len(bad)


def test_without_a_place_for_rejects_nothing_of_the_batch_lands(spark, tmp_path):
    create_landing(spark, str(tmp_path / "landing"))
    sound, bad = _lines()
    _text(tmp_path / "inbox", "a.json", [*sound, bad[1]])
    with pytest.raises(Exception, match="malformed line in .*a.json.*no time"):
        _land_lines(spark, tmp_path, None)
    assert read_landing(spark, str(tmp_path / "landing")).count() == 0
    # The same batch, with a place for them.
    assert _land_lines(spark, tmp_path, "rejects").count() == len(sound)
    assert ingest.read_rejects(spark, str(tmp_path / "rejects")).count() == 1


def test_rejects_of_a_batch_that_ended_between_its_two_writes(spark, tmp_path):
    create_landing(spark, str(tmp_path / "landing"))
    sound, bad = _lines()
    _text(tmp_path / "inbox", "a.json", [*sound, *bad])
    _land_lines(spark, tmp_path, "rejects")
    import shutil

    # As it would be: landed, neither rejected nor committed.
    shutil.rmtree(tmp_path / "rejects")
    for name in ("0", ".0.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    assert _land_lines(spark, tmp_path, "rejects").count() == len(sound)
    assert ingest.read_rejects(spark, str(tmp_path / "rejects")).count() == len(bad)


def test_no_rejects_yet(spark, tmp_path):
    assert ingest.read_rejects(spark, str(tmp_path / "none")).count() == 0


def test_copies_are_dropped_and_malformed_lines_are_kept_by_the_pre_filter(spark, tmp_path):
    create_landing(spark, str(tmp_path / "landing"))
    sound, bad = _lines()
    _text(tmp_path / "inbox", "a.json", [*sound, *sound, *bad])
    stream = ingest.first_deliveries(ingest.read_stream(spark, str(tmp_path / "inbox")))
    ingest.ingest_available(
        stream, str(tmp_path / "landing"), str(tmp_path / "cp"), str(tmp_path / "rejects")
    )
    assert read_landing(spark, str(tmp_path / "landing")).count() == len(sound)
    assert ingest.read_rejects(spark, str(tmp_path / "rejects")).count() == len(bad)
    # The keys seen are kept by the state store on disk, and checkpoints hold its changes.
    state = {p.name for p in (tmp_path / "cp" / "state").rglob("*")}
    assert "1.changelog" in state and not any(name.endswith(".delta") for name in state)


# Landing and publishing in one job


def _publishing(spark, tmp_path, per_batch=1, export=None):
    stream = ingest.read_stream(spark, str(tmp_path / "inbox"), max_files_per_trigger=per_batch)
    refresh.start_refresh(
        stream,
        lambda session: (
            read_nested_events(session, export) if export else session.createDataFrame([], NESTED_EVENTS)
        ),
        str(tmp_path / "landing"),
        str(tmp_path / "out"),
        str(tmp_path / "cp"),
        rejects=str(tmp_path / "rejects"),
    ).awaitTermination()


def _purchase(user, ts, session=1):
    return _sent(user, ts, event_name="purchase", purchase_revenue=5.0, ga_session_id=session)


def test_marts_follow_the_micro_batches_and_replays_publish_once(spark, tmp_path):
    create_landing(spark, str(tmp_path / "landing"))
    out = str(tmp_path / "out")
    for n in range(3):
        rows = [_sent(f"u{n}", at(days=n)), _purchase(f"u{n}", at(days=n, hours=1)), _sent("u0", at(days=n, hours=2))]
        _drop(tmp_path / "inbox", f"{n}.json", rows)
    _publishing(spark, tmp_path)
    assert len(publish.commits(spark, out)) == 3
    batch = pipeline.build(
        spark.createDataFrame([], FLAT_EVENTS), read_landing(spark, str(tmp_path / "landing"))
    )
    assert rows_of(pipeline.current_tables(spark, out).marts) == rows_of(
        batch.marts.select(*MARTS.fieldNames())
    )
    # The last batch ended after its build was published, before Spark took note of it.
    for name in ("2", ".2.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    before = publish.commits(spark, out)
    _publishing(spark, tmp_path)
    assert publish.commits(spark, out) == before
    assert read_landing(spark, str(tmp_path / "landing")).count() == 9
    # A late purchase, a line that is malformed, and a batch of nothing else.
    _text(tmp_path / "inbox", "3.json", [json.dumps(_purchase("u1", at(minutes=1), 7)), "{broken"])
    _text(tmp_path / "inbox", "4.json", ["{broken"])
    _publishing(spark, tmp_path)
    assert len(publish.commits(spark, out)) == 3, "the last three builds stay"
    marts = pipeline.current_tables(spark, out).marts
    assert marts.where("user_pseudo_id = 'u1' AND attribution_model = 'last_click'").count() == 2
    assert ingest.read_rejects(spark, str(tmp_path / "rejects")).count() == 2


def _shard(spark, root, day, *rows):
    events = [
        {"event_date": day, "event_timestamp": int(ts.timestamp() * 1e6), "event_name": name, "user_pseudo_id": user}
        for user, name, ts in rows
    ]
    nested(spark, events).write.mode("overwrite").parquet(f"{root}/events_{day}")


def test_shards_that_are_new_changed_or_gone_reach_the_marts(spark, tmp_path):
    create_landing(spark, str(tmp_path / "landing"))
    out, export = str(tmp_path / "out"), str(tmp_path / "export")
    staged = pipeline.staged_path(out)

    def marts_equal_a_rebuild():
        whole = pipeline.rebuild(
            spark, read_nested_events(spark, export), read_landing(spark, str(tmp_path / "landing")),
            str(tmp_path / "whole"),
        )
        now = pipeline.current_tables(spark, out)
        assert rows_of(now.staged) == rows_of(whole.staged)
        assert rows_of(now.marts) == rows_of(whole.marts)

    # The exporter's day is not the UTC day of the second event.
    _shard(spark, export, "20210101", ("a", "purchase", at(hours=1)), ("a", "view", at(hours=25)))
    _shard(spark, export, "20210104", ("b", "purchase", at(days=3)))
    _drop(tmp_path / "inbox", "0.json", [_sent("u", at(days=5)), _purchase("u", at(days=5, hours=1))])
    _publishing(spark, tmp_path, export=export)
    marts_equal_a_rebuild()
    assert pipeline.export_changes(spark, read_nested_events(spark, export), staged)[0] == []
    # A new shard, one exported again with other events, and one that is gone; a batch of another day.
    _shard(spark, export, "20210107", ("c", "purchase", at(days=6)))
    _shard(spark, export, "20210101", ("a", "purchase", at(hours=2)))
    import shutil

    shutil.rmtree(f"{export}/events_20210104")
    days, _ = pipeline.export_changes(spark, read_nested_events(spark, export), staged)
    assert days == [at(days=n).date() for n in (0, 1, 3, 6)]
    _drop(tmp_path / "inbox", "1.json", [_purchase("u", at(days=8))])
    _publishing(spark, tmp_path, export=export)
    marts_equal_a_rebuild()
    assert len(publish.commits(spark, out)) == 2


def test_a_batch_that_failed_while_it_built_is_taken_up_again(spark, tmp_path, monkeypatch):
    create_landing(spark, str(tmp_path / "landing"))
    out = str(tmp_path / "out")
    _drop(tmp_path / "inbox", "0.json", [_sent("u", at()), _purchase("u", at(hours=1))])
    _publishing(spark, tmp_path)
    _drop(tmp_path / "inbox", "1.json", [_purchase("u", at(days=1))])

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(publish, "commit", fail)
        with pytest.raises(Exception, match="lost"):
            _publishing(spark, tmp_path)
    assert pipeline.current_tables(spark, out).conversions.count() == 1
    _publishing(spark, tmp_path)
    assert pipeline.current_tables(spark, out).conversions.count() == 2
    assert read_landing(spark, str(tmp_path / "landing")).count() == 3


def test_ingest_reads_a_table_that_is_a_folder_of_part_files(spark, tmp_path):
    from touchtrail.plans import catalog

    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert catalog.ingest_stream(spark, str(tmp_path)).count() == 2 * source.count()


def test_batches_of_the_refresh_query_are_read_by_all_cores(spark, tmp_path, monkeypatch):
    from touchtrail.plans import catalog

    given_rows = spark.range(2_000).selectExpr(
        "id AS event_id",
        "CAST(TIMESTAMP_NTZ '2024-01-18 00:00:01' + make_dt_interval(0, 0, 9 * CAST(id AS int)) AS TIMESTAMP_NTZ) AS ts",
        "id % 7 AS user_id",
        "IF(id % 3 = 0, 'purchase', 'click') AS event_type",
        "CAST(id AS double) AS value",
        """'{"k": ' || id || '}' AS props""",
    )
    given_rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(catalog, "scratch_dir", lambda _, label: str(tmp_path / label))
    marts = catalog.stream_rebuild(spark, str(tmp_path))
    entries = [json.loads(f.read_text()) for f in (tmp_path / "stream-rebuild/landing/_deliveries").rglob("*.json")]
    assert len(entries) == catalog.REFRESH_BATCHES
    assert all(len(e["files"]) == spark.sparkContext.defaultParallelism for e in entries)
    once = catalog.rebuild(spark, str(tmp_path))
    assert rows_of(marts.select("conversion_id", "attribution_model")) != []
    assert rows_of(marts) == rows_of(once)
