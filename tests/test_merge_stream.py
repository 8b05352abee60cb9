from acopio.operators.store import Kept, Store
from acopio.streaming.ingest import merge_stream
from pyspark.sql.types import StructType


def test_merge_rewrites_what_it_touches(spark, tmp_path):
    """Batches of reports equal the sequence; a batch writes the buckets of its entities only, an entity may be null."""
    kept = Store(spark, str(tmp_path / "kept"), {"states": Kept("e", StructType.fromDDL("e string, state string, name string"))}, buckets=16)
    kind = "e string, kind string, name string, seq long"
    many = [(f"x{k}", "ingresado", f"n{k}", 1) for k in range(60)]
    parts = [[("a", "ingresado", "x", 1), ("b", "fallecido", "y", 1), *many], [("a", "desaparecido", "z", 2), ("b", "ingresado", "q", 2), (None, "desaparecido", None, 2)], [(None, "dado_de_alta", "w", 3)]]
    written = []
    for rows in parts:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        merge_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), kept, "states", str(tmp_path / "cp"), "e", "kind", ["seq"], ["name"]).awaitTermination()
        written.append(len(list((tmp_path / f"kept/states/v={kept.latest()}").glob("_bucket=*"))))
    want = {"a": ("ingresado", "x"), "b": ("fallecido", "y"), None: ("dado_de_alta", "w")} | {e: ("ingresado", n) for e, _, n, _ in many}
    assert {r.e: (r.state, r.name) for r in kept.read("states").collect()} == want
    assert written[0] > 10 and written[1] <= 3 and written[2] == 1 and kept.versions() == [1, 2, 3]
