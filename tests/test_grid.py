import datetime as dt

from rainrisk.operators.grid import alerts, gold_grid_risk, latest_per_municipality

D1, D2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)


def silver(spark, rows):
    return spark.createDataFrame(
        rows, "codigo_posto bigint, data date, precipitacao double, municipio_inferido string")


def test_gold_latest_date_wettest_station(spark):
    s = silver(spark, [
        (1, D1, 120.0, "Recife"), (2, D2, 30.0, "Recife"), (3, D2, None, "Recife"),
        (4, D2, 55.0, "Olinda"), (5, D1, 200.0, "Olinda"),
        (6, D2, None, "Ipojuca"), (7, D2, None, "Ipojuca"),
        (8, D2, 101.0, None),
        (9, D2, 100.0, "Abreu"), (10, D2, 100.0, "Abreu"),
    ])
    got = {r.municipio: (r.id, r.nivel_alerta, r.atualizacao) for r in gold_grid_risk(s).collect()}
    assert got == {
        "Abreu": (1, "Alerta 🟠", D2),
        "Ipojuca": (2, "Normal 🟢", D2),
        "Olinda": (3, "Alerta 🟠", D2),
        "Recife": (4, "Atenção 🟡", D2),
    }
    served = alerts(gold_grid_risk(s)).collect()
    assert [r.id for r in served] == [1, 2, 3, 4] and served[0].atualizacao == "2025-03-02"
    latest = {(r.municipio, r.codigo_posto) for r in latest_per_municipality(s).collect()}
    assert latest == {("Recife", 2), ("Recife", 3), ("Olinda", 4), ("Ipojuca", 6),
                      ("Ipojuca", 7), ("Abreu", 9), ("Abreu", 10)}


def test_gold_equals_reference_rule_on_driver_data(spark):
    from rainrisk.plans.catalog import QUERIES
    from tests.conftest import SF_SMALL
    g = QUERIES["gold_grid_risk"](spark, SF_SMALL).collect()
    assert sorted(r.id for r in g) == list(range(1, len(g) + 1))
    assert len({r.municipio for r in g}) == len(g)


def test_gold_from_readings_equals_gold_from_silver(spark):
    from rainrisk.operators.grid import gold_from_readings
    from rainrisk.operators.match import station_municipality_map
    from rainrisk.plans.medallion import silver_rainfall
    from rainrisk.sources import bindings as B
    from tests.conftest import SF_SMALL
    bronze, mun = B.daily_readings(spark, SF_SMALL), B.municipalities(spark, SF_SMALL)
    a = gold_grid_risk(silver_rainfall(bronze, mun)).collect()
    b = gold_from_readings(bronze, station_municipality_map(bronze, mun)).collect()
    assert sorted(a) == sorted(b) and len(a) > 0


def test_latest_from_readings_equals_silver_form(spark):
    from rainrisk.operators.grid import latest_from_readings
    from rainrisk.operators.match import station_municipality_map
    from rainrisk.plans.medallion import silver_rainfall
    from rainrisk.sources import bindings as B
    from tests.conftest import SF_SMALL
    bronze, mun = B.daily_readings(spark, SF_SMALL), B.municipalities(spark, SF_SMALL)
    a = latest_per_municipality(silver_rainfall(bronze, mun), mun).collect()
    b = latest_from_readings(bronze, station_municipality_map(bronze, mun),
                             stations=B.table(spark, SF_SMALL, "supplier")).collect()
    assert sorted(a) == sorted(b) and len(a) > 0
