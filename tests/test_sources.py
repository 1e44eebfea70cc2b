import datetime as dt
import io
import json
import zipfile

from pyspark.sql import functions as F

from airq import schemas
from airq.functions.geo import REGION, add_geohash
from airq.operators.clean import inside
from airq.sources import archives, sensors, tables, weather

ROWS = {
    "sds011": "sensor_id;sensor_type;location;lat;lon;timestamp;P1;durP1;ratioP1;P2;durP2;ratioP2\n"
    "189;SDS011;90;48.78;9.18;2017-02-01T00:05:00;12.5;;;7.1;;\n"
    "189;SDS011;90;48.78;9.18;2017-02-01T00:20:00;;;;8.0;;\n"
    "190;SDS011;91;0;9.18;2017-02-01T00:07:00;3.0;;;1.0;;\n",
    "dht22": "sensor_id;sensor_type;location;lat;lon;timestamp;temperature;humidity\n191;DHT22;90;48.78;9.18;2017-02-01T00:05:00;4.5;80\n",
    "ppd42ns": "sensor_id;sensor_type;location;lat;lon;timestamp;P1;durP1;ratioP1;P2;durP2;ratioP2\n"
    "192;PPD42NS;92;48.7;9.2;2017-02-01T00:05:00;1;2;3;4;5;6\n",
    "bmp180": "sensor_id;sensor_type;location;lat;lon;timestamp;pressure;altitude;pressure_sealevel;temperature\n"
    "193;BMP180;93;48.7;9.2;2017-02-01T00:05:00;98000;;;3.5\n",
    "bme280": "sensor_id;sensor_type;location;lat;lon;timestamp;pressure;altitude;pressure_sealevel;temperature;humidity\n"
    "194;BME280;94;48.7;9.2;2017-02-01T00:05:00;98000;;;3.5;70\n",
}


def test_archive_families(spark, tmp_path):
    for kind, body in ROWS.items():
        folder = tmp_path / "2017-02-01"
        folder.mkdir(exist_ok=True)
        (folder / f"2017-02-01_{kind}_sensor_1.csv").write_text(body)
    df = sensors.read_sensor_archive(spark, str(tmp_path))
    assert df.columns == schemas.OBSERVATION_COLUMNS and df.schema == schemas.OBSERVATION
    rows = {(r.sensor_id, r.timestamp.minute): r for r in df.collect()}
    assert len(rows) == 7
    assert rows[189, 20].P1 is None and rows[189, 20].P2 == 8.0 and rows[189, 5].temperature is None
    assert rows[194, 5].humidity == 70 and rows[193, 5].pressure == 98000
    placed = {r.sensor_id: r.geohash.hash for r in add_geohash(df).select("sensor_id", "geohash").collect()}
    assert placed[190] is None and placed[189].startswith("u0wt8")
    assert 190 not in {r.sensor_id for r in inside(df, REGION).collect()}


def test_snapshot(spark, tmp_path):
    data = [
        {"id": 1, "location": {"id": 2845}, "sensordatavalues": [{"id": 11, "value": "8.2", "value_type": "P1"}, {"id": 12, "value": "4.0", "value_type": "P2"}]},
        {"id": 2, "location": {"id": 2846}, "sensordatavalues": []},
    ]
    (tmp_path / "now.json").write_text(json.dumps(data))
    df = sensors.explode_snapshot(sensors.read_snapshot(spark, str(tmp_path / "now.json")))
    assert df.count() == 2
    assert df.where("location_id = 2845 AND reading_value_type = 'P1'").first().reading_value == "8.2"


def test_metadata(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        '_c0,sensor_id,location,sensor_type,lon,lat\n0,1,10,SDS011,"[9.10, 9.18]",48.7\n1,2,11,DHT22,9.18,[]\n'
    )
    rows = {r.sensor_id: r for r in sensors.read_sensor_metadata(spark, str(tmp_path / "m.csv")).collect()}
    assert (rows[1].lon, rows[1].lat, rows[2].lon, rows[2].lat) == (9.18, 48.7, 9.18, None)


CATALOGUE = """Stations_id von_datum bis_datum Stationshoehe geoBreite geoLaenge Stationsname Bundesland
----------- --------- --------- ------------- --------- --------- ----------------------------------------- ----------
04928 19510101 20181231            314     48.8281    9.2000 Stuttgart (Schnarrenberg)                Baden-Württemberg
00001 19510101 20181231            100     48.3000    9.1000 Köln am Rand                             Baden-Württemberg
broken line
"""


def test_catalogue(spark, tmp_path):
    (tmp_path / "stations.txt").write_bytes(CATALOGUE.encode("ISO-8859-1"))
    df = weather.read_station_catalogue(spark, str(tmp_path / "stations.txt"))
    rows = {r.Stations_id: r for r in df.collect()}
    assert set(rows) == {1, 4928}
    assert rows[1].Stationsname == "Köln am Rand" and rows[4928].Bundesland == "Baden-Württemberg"
    assert [r.Stations_id for r in weather.stations_in_box(df, REGION).collect()] == [4928]


def archive(path, body, member="produkt_tu_stunde.txt"):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("Metadaten.txt", "x")
        z.writestr(member, body)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(buffer.getvalue())


def test_two_tiers(spark, tmp_path):
    head = "STATIONS_ID;MESS_DATUM;QN_9; TT_TU;RF_TU;eor\n"
    archive(tmp_path / "h" / "stundenwerte_TU_04928_hist.zip", head + "  4928;2017020100;3; -999;80;eor\n  4928;2017020101;3;   1.5;81;eor\n")
    archive(tmp_path / "r" / "stundenwerte_TU_04928_akt.zip", head + "  4928;2017020101;3;   2.5;82;eor\n")
    archive(tmp_path / "r" / "stundenwerte_TU_00044_akt.zip", head + "  44;2017020101;3;   9.9;82;eor\n")
    archive(tmp_path / "r" / "stundenwerte_TU_04928_bad.zip", "x", member="other.txt")
    (tmp_path / "r" / "stundenwerte_TU_04928_torn.zip").write_bytes(b"no zip")
    whole = (tmp_path / "h" / "stundenwerte_TU_04928_hist.zip").read_bytes()
    at = whole.index(b"-999")
    (tmp_path / "h" / "stundenwerte_TU_04928_flip.zip").write_bytes(whole[:at] + b"-998" + whole[at + 4 :])
    stations = spark.createDataFrame([(4928,)], "Stations_id int")
    df = weather.read_product(spark, str(tmp_path / "h"), str(tmp_path / "r"), "temperature", stations)
    rows = sorted((r.STATIONS_ID, r.timestamp, r.TT_TU, r.RF_TU) for r in df.collect())
    assert rows == [(4928, dt.datetime(2017, 2, 1, 0), None, 80.0), (4928, dt.datetime(2017, 2, 1, 1), 2.5, 82.0)]
    files = weather.archives_of_stations(weather.read_archives(spark, str(tmp_path / "r")), stations)
    rejected = weather.rejected_archives(weather.unpack_archives(files)).collect()
    assert sorted(r.path.rsplit("_", 1)[1] for r in rejected) == ["bad.zip", "torn.zip"]
    catalogue = spark.createDataFrame([(4928, "Stuttgart"), (4928, "Stuttgart")], "Stations_id int, Stationsname string")
    assert weather.with_station_attributes(df, catalogue).count() == 2


def test_archive_scan(spark, tmp_path, monkeypatch):
    """One partition per archive of a wanted station; what cannot be read is a row with its error."""
    head = "STATIONS_ID;MESS_DATUM;eor\n"
    archive(tmp_path / "a" / "stundenwerte_TU_00001_hist.zip", head + "".join(f"1;{i};eor\n" for i in range(120_000)))
    archive(tmp_path / "b c" / "stundenwerte_TU_00002_hist.zip", head + "2;1;eor\n", member="x/produkt_ä.txt")
    archive(tmp_path / "stundenwerte_TU_00003_hist.zip", head + "3;1;eor\n", member="other.txt")
    archive(tmp_path / "stundenwerte_TU_00004_hist.zip", "")
    (tmp_path / "stundenwerte_XX_akt.zip").write_bytes(b"no zip")
    (tmp_path / "notes_00001_.zip").write_bytes(b"other file")
    lines = archives.scan_archives(spark, str(tmp_path))
    counts = {(r.station, r.bad): r.n for r in lines.groupBy("station", F.col("error").isNotNull().alias("bad")).agg(F.count("*").alias("n")).collect()}
    assert counts == {(1, False): 120_000, (2, False): 1, (3, True): 1, (None, True): 1}
    some = archives.scan_archives(spark, f"file://{tmp_path}", [2, 3, 99])
    assert some.rdd.getNumPartitions() == 2
    assert sorted((r.station, r.line, r.name) for r in some.collect() if r.error is None) == [(2, "2;1;eor", "x/produkt_ä.txt")]
    assert lines.where("station = 2").rdd.getNumPartitions() == 1
    assert archives.scan_archives(spark, str(tmp_path), []).count() == 0
    assert archives.local_path("hdfs://x/y") is None and archives.local_path("file:/a%20b") == "/a b"


def test_archives_of_any_store(spark, tmp_path, monkeypatch):
    """The file reader's name pattern holds the stations; beyond the limit a join finds them."""
    for n in (1, 2, 3):
        archive(tmp_path / f"stundenwerte_TU_{n:05d}_akt.zip", f"STATIONS_ID;MESS_DATUM\n{n};2017020101\n")
    stations = spark.createDataFrame([(2,), (3,), (77,), (None,)], "Stations_id int")
    for limit in (weather.PUSHED, 1):
        monkeypatch.setattr(weather, "PUSHED", limit)
        found = weather.unpack_archives(weather.read_archives(spark, str(tmp_path), stations))
        assert sorted(r.line for r in found.collect()) == ["2;2017020101", "3;2017020101"]
        lines = weather.read_lines(spark, str(tmp_path), stations)
        assert sorted(r.line for r in lines.collect()) == ["2;2017020101", "3;2017020101"]
    assert weather.read_archives(spark, str(tmp_path), stations.where("false")).count() == 0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.5, 2.5])], "id int, lon array<double>")
    path = tables.write_snapshot(df, str(tmp_path), "sensors", dt.date(2018, 1, 31))
    assert path.endswith("sensors.2018-01-31.parquet") and spark.read.parquet(path).first().lon == [1.5, 2.5]
    tables.write_csv_report(df, str(tmp_path / "report"), single_file=True)
    files = list((tmp_path / "report").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().startswith("id,lon")
