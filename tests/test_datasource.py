import os

from acopio.sources import datasource, specs
from acopio.sources.specs import Profile, SourceSpec
from acopio.streaming.ingest import append_once


def put(folder, name, body, at):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(body.encode() if isinstance(body, str) else body)
    os.utime(path, ns=(at, at))


def item(k):
    return '{"items":[{"id":"%s","nombre":"Ana"}]}' % k


def test_files_of_a_folder(spark, tmp_path):
    """Files in folders, of one moment, hidden ones, those still being written, an empty one, one that is no JSON."""
    for k in range(6):
        put(tmp_path, f"d{k % 2}/{k}.json", item(k), 1000)
    for name in (".hidden", "_temporary/0/part-1", "d1/_SUCCESS"):
        put(tmp_path, name, item("no"), 1000)
    put(tmp_path, "empty", "", 2000)
    put(tmp_path, "broken", "{", 2000)
    rows = datasource.read_persons(spark, str(tmp_path), "encuentralos").collect()
    assert sorted((r.id, r.fuente_url) for r in rows) == [(f"encuentralos:{k}", f"file:{tmp_path}/d{k % 2}/{k}.json") for k in range(6)]
    by_uri = spark.read.format("person_files").option("path", f"file://{tmp_path}").option("bytes_per_task", 80)
    assert by_uri.load().count() == 8 and by_uri.load().rdd.getNumPartitions() == 3  # 37 bytes each, then none and one
    assert spark.read.format("person_files").option("path", str(tmp_path / "d0/2.json")).load().first().body == item(2).encode()
    (tmp_path / "nothing").mkdir()
    assert datasource.read_persons(spark, str(tmp_path / "nothing"), "encuentralos").count() == 0


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    """Each run is a restart from the checkpoint: files of the last moment with a later path are new, others are not."""
    files, out = tmp_path / "in", f"{tmp_path}/out"
    files.mkdir()
    seen = []
    for new in ([], [("a", 1000), ("b", 2000)], [], [("c", 2000)], [("a2", 3000), ("d", 3000)]):
        for name, at in new:
            put(files, name, item(name), at)
        append_once(datasource.stream_persons(spark, str(files), "encuentralos"), out, f"{tmp_path}/cp").awaitTermination()
        seen.append(sorted(r.id[13:] for r in spark.read.schema("id string").parquet(out).collect()))
    assert seen == [[], ["a", "b"], ["a", "b"], ["a", "b", "c"], ["a", "a2", "b", "c", "d"]]


def test_csv_table_function(spark):
    datasource.register(spark)
    bodies = [(1, "Lista\n\nNOMBRE,EDAD,\nAna,7,x\nEva\n , \n"), (2, "a,b\n"), (3, b"\xff\xfe"), (4, None), (5, '"NOMBRE DEL PACIENTE"\n"Zoe, hija"\n')]
    spark.createDataFrame([(k, b.encode() if isinstance(b, str) else b) for k, b in bodies], "k int, body binary").createOrReplaceTempView("csv_bodies")
    rows = spark.sql("SELECT k, nth, record FROM csv_bodies, LATERAL csv_people(body, 'NOMBRE')").collect()
    assert sorted((r.k, r.nth, r.record) for r in rows) == [(1, 0, {"NOMBRE": "Ana", "EDAD": "7"}), (1, 1, {"NOMBRE": "Eva", "EDAD": ""}), (5, 0, {"NOMBRE DEL PACIENTE": "Zoe, hija"})]
    spark.catalog.dropTempView("csv_bodies")


def test_a_source_of_ones_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(specs, "SPECS", dict(specs.SPECS))
    specs.register(SourceSpec("propia", Profile(specs.SPECS["tebusco"].pipeline.read, {"nombre": "quien", "edad": "anos"})))
    put(tmp_path, "x", '[{"quien":"Leo","anos":3},{"anos":4}]', 1000)
    assert [(r.nombre, r.edad, r.spider_name) for r in datasource.read_persons(spark, str(tmp_path), "propia").collect()] == [("Leo", "3", "propia")]
