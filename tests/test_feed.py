import pytest
from pyspark.sql import functions as F

from rainrisk.sources import feed


def payload(spark, rows):
    return spark.createDataFrame(rows, feed.PAYLOAD_SCHEMA)


def test_typed_feed_lenient_numbers_and_nulls(spark):
    p = payload(spark, [
        ("2025-01-01 10:15:00", "E1", "G1",
         '{"chuva": "1.5", "latitude": -8.1, "cidade": "Recife", "nome": "S1", "uf": "PE"}'),
        ("2025-01-01 10:30:00", "E2", "G2", '{"chuva": "abc", "cidade": null}'),
    ])
    rows = feed.typed_feed(p, ingest_ts=F.lit(None).cast("timestamp")).orderBy("codigo_gmmc").collect()
    assert rows[0].chuva == 1.5 and rows[0].latitude == -8.1 and rows[0].uf == "PE"
    assert rows[0].nome_estacao == "S1" and rows[0].longitude is None
    assert rows[1].chuva is None and rows[1].cidade is None  # real NULL, not 'None'
    assert list(feed.typed_feed(p).columns) == feed.FEED_COLUMNS


def test_bad_timestamp_fails_the_batch(spark):
    p = payload(spark, [("not a time", "E", "G", "{}")])
    with pytest.raises(Exception):
        feed.typed_feed(p).collect()


def test_stream_equals_batch_out_of_order(spark, scratch):
    from rainrisk.operators.stations import latest_per_station
    from rainrisk.streaming import feed_stream as S
    base = scratch("feed")
    rows = [
        ("2025-01-01 10:00:00", "E", "G1", '{"chuva": "1", "cidade": " recife", "nome": "a"}'),
        ("2025-01-01 11:00:00", "E", "G1", '{"chuva": "2", "cidade": "Recife", "nome": "b"}'),
        ("2025-01-01 09:00:00", "E", "G2", '{"chuva": "3", "cidade": "Olinda", "nome": "c"}'),
        ("2025-01-01 12:00:00", "E", "G2", '{"chuva": "4", "cidade": null, "nome": "d"}'),
    ]
    # newest reading arrives first, older ones in a later file
    payload(spark, rows[1:2] + rows[3:]).write.json(f"{base}/payload/a1")
    payload(spark, rows[0:1] + rows[2:3]).write.json(f"{base}/payload/a2")
    S.run_available_now(S.land_feed(spark, f"{base}/payload/*/*.json", f"{base}/landed",
                                    f"{base}/cp1", json_array=False, max_files_per_trigger=1))
    landed = feed.read_landed(spark, f"{base}/landed")
    assert landed.count() == 4 and set(landed.columns) >= {"ano", "mes", "dia"}
    assert all(len(r.mes) == 2 for r in landed.select("mes").collect())
    S.run_available_now(S.latest_snapshot_stream(spark, f"{base}/landed", f"{base}/latest",
                                                 f"{base}/cp2"))
    got = {r.codigo_gmmc: (r.chuva, r.municipio_nome)
           for r in spark.read.parquet(f"{base}/latest").collect()}
    assert got == {"G1": (2.0, "RECIFE"), "G2": (3.0, "OLINDA")}
    batch = {r.codigo_gmmc: r.chuva for r in latest_per_station(landed).collect()}
    assert batch == {k: v[0] for k, v in got.items()}
    # a second run with no new files changes nothing
    S.run_available_now(S.land_feed(spark, f"{base}/payload/*/*.json", f"{base}/landed",
                                    f"{base}/cp1", json_array=False))
    assert feed.read_landed(spark, f"{base}/landed").count() == 4


def test_processing_time_trigger_path(spark, scratch):
    from rainrisk.streaming import feed_stream as S
    base = scratch("feed-pt")
    payload(spark, [("2025-01-01 10:00:00", "E", "G9",
                     '{"chuva": "1", "cidade": "Recife", "nome": "a"}')]
            ).write.json(f"{base}/payload/a1")
    q = S.land_feed(spark, f"{base}/payload/*/*.json", f"{base}/landed", f"{base}/cp",
                    json_array=False, available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert feed.read_landed(spark, f"{base}/landed").count() == 1


GOOD = '{"chuva": "1", "cidade": "Recife", "nome": "a"}'


def _text(base, name, text):
    import os
    path = f"{base}/payload".removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "wb") as fh:
        fh.write(text if isinstance(text, bytes) else text.encode())


def _reading(code, ts="2025-01-01 10:00:00", nested=GOOD):
    import json
    return json.dumps({"Data-hora": ts, "Estação": "E", "Codigo_gmmc": code, "Dados_completos": nested})


def test_what_cannot_land_goes_to_the_side_and_the_feed_goes_on(spark, scratch):
    from rainrisk.streaming import feed_stream as S
    base = scratch("feed-bad")
    _text(base, "a", f"[{_reading('G1')}, {_reading('G2', 'not a time')}, {_reading('G3', None)}]")
    _text(base, "b", f"[{_reading('G4')}, {_reading('G5')[:40]}")           # cut off
    _text(base, "c", "<html><body>503 Service Unavailable</body></html>")
    _text(base, "d", b"\xff\xfe\x00garbage")
    _text(base, "e", f"[{_reading('G6', nested='{cut')}, {_reading('G7', nested=None)}, {_reading('G8', nested='[1]')}]")
    _text(base, "f", "[]")
    _text(base, "g", "")
    args = (f"{base}/payload/*.json", f"{base}/landed", f"{base}/cp", f"{base}/bad")
    S.run_available_now(S.land_feed(spark, *args, max_files_per_trigger=2))
    _text(base, "h", f"[{_reading('G9', '2025-01-02 10:00:00')}]")            # a good file after the bad ones
    S.run_available_now(S.land_feed(spark, *args, max_files_per_trigger=2))
    landed = feed.read_landed(spark, f"{base}/landed")
    assert sorted(r.codigo_gmmc for r in landed.collect()) == ["G1", "G9"]
    assert landed.where("data_hora is null").count() == 0
    bad = S.read_rejects(spark, f"{base}/bad").collect()
    assert sorted((r.motivo, r.arquivo[-6]) for r in bad) == sorted(
        [("data_hora", "a"), ("sem_data_hora", "a"), ("json", "b"), ("json", "c"), ("json", "d")] + [("dados_completos", "e")] * 3)
    assert any("503" in r.registro for r in bad) and any('"G2"' in r.registro for r in bad)
    assert all(r.ingestao_ts is not None for r in bad)
    assert S.check_rejects(spark, f"{base}/bad") == 8 and S.check_rejects(spark, f"{base}/none", 0) == 0
    with pytest.raises(ValueError, match="8 readings"):
        S.check_rejects(spark, f"{base}/bad", max_rejects=0)
    S.run_available_now(S.latest_snapshot_stream(spark, f"{base}/landed", f"{base}/latest", f"{base}/cp2", max_files_per_trigger=1))
    assert spark.read.parquet(f"{base}/latest").count() == 2


def test_a_replayed_batch_lands_once(spark, scratch):
    """The commit of the last batch is lost: it runs again and both folders stay as they were."""
    import os

    from rainrisk.streaming import feed_stream as S
    base = scratch("feed-replay")
    _text(base, "a", f"[{_reading('G1')}, {_reading('G2', 'x')}]")
    args = (f"{base}/payload/*.json", f"{base}/landed", f"{base}/cp", f"{base}/bad")
    S.run_available_now(S.land_feed(spark, *args))
    _text(base, "b", f"[{_reading('G3')}, {_reading('G4', 'x')}]")
    S.run_available_now(S.land_feed(spark, *args))

    def state():
        return (sorted(map(tuple, feed.read_landed(spark, f"{base}/landed").collect())),
                sorted(map(tuple, S.read_rejects(spark, f"{base}/bad").collect())))
    before = state()
    assert len(before[0]) == len(before[1]) == 2
    commits = f"{base}/cp/commits".removeprefix("file:")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{f}"):
            os.remove(f"{commits}/{f}")
    S.run_available_now(S.land_feed(spark, *args))
    assert state() == before


def test_a_trigger_rewrites_only_buckets_of_changed_stations(spark, scratch):
    import glob
    import os

    from rainrisk.operators.stations import latest_per_station
    from rainrisk.streaming import feed_stream as S
    base = scratch("feed-buckets")
    _text(base, "a", "[" + ",".join(_reading(f"G{i}") for i in range(40)) + "]")
    land = (f"{base}/payload/*.json", f"{base}/landed", f"{base}/cp")

    def run():
        S.run_available_now(S.land_feed(spark, *land))
        S.run_available_now(S.latest_snapshot_stream(spark, f"{base}/landed", f"{base}/latest", f"{base}/cp2", buckets=8))
        files = glob.glob(f"{base}/latest/balde=*/*.parquet".removeprefix("file:"))
        return {f: os.path.getmtime(f) for f in files}
    first = run()
    assert len({os.path.dirname(f) for f in first}) > 5
    _text(base, "b", f"[{_reading('G7', '2025-02-01 00:00:00')}, {_reading('G7', '2024-01-01 00:00:00')}]")
    second = run()
    new = set(second) - set(first)
    assert len({os.path.dirname(f) for f in new}) == 1 and len(set(first) & set(second)) >= len(first) - 1
    got = {r.codigo_gmmc: r.data_hora for r in spark.read.parquet(f"{base}/latest").collect()}
    assert got == {r.codigo_gmmc: r.data_hora for r in latest_per_station(feed.read_landed(spark, f"{base}/landed")).collect()}
    assert len(got) == 40 and got["G7"].month == 2
    assert run() == second                                    # nothing new: nothing written
