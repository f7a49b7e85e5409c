import os
import tempfile

from civica.operators.columns import harmonise
from civica.operators.rows import prefix_filter
from civica.streaming.ingest import ingest_stream, layout_name, route_stream


def _csv(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("Code du département,Libellé du département,Inscrits\n" + "\n".join(rows) + "\n")


def test_incremental_ingest_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="civica-landing-")
    landing, target = f"{root}/landing", f"{root}/table"
    os.makedirs(landing)
    _csv(f"{landing}/a.csv", ["13,Bouches,100", "75,Paris,200"])
    tf = lambda df: prefix_filter(harmonise(df), "code_region", "13")
    ckpt = ingest_stream(spark, landing, target, tf)
    assert spark.read.parquet(target).count() == 1
    _csv(f"{landing}/b.csv", ["130,X,5", "13,Y,6"])
    ingest_stream(spark, landing, target, tf, checkpoint=ckpt)          # only the new file
    ingest_stream(spark, landing, target, tf, checkpoint=ckpt)          # nothing new: no duplicates
    df = spark.read.parquet(target)
    assert sorted(r["inscrits"] for r in df.collect()) == ["100", "5", "6"]
    assert {"code_region", "nom_departement", "inscrits", "source_file"} <= set(df.columns)


def test_two_layouts_in_one_folder_land_once(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="civica-route-")
    landing, target = f"{root}/landing", f"{root}/tables"
    os.makedirs(landing)
    headers = {"a": "Code,Nom,Nom", "b": "Code;x,Voix"}
    def put(name, kind, rows):
        with open(f"{landing}/{name}.csv", "w", encoding="utf-8") as f:
            f.write("\n".join([headers[kind], *rows]) + "\n")
    put("a1", "a", ["1,x,y"])
    put("b 1", "b", ["2,3", "4,5"])
    open(f"{landing}/empty.csv", "w").close()
    read = lambda kind: sorted(tuple(r) for r in spark.read.parquet(f"{target}/{layout_name(headers[kind])}").drop("batch", "source_file").collect())
    ckpt = route_stream(spark, landing, target)
    assert read("a") == [("1", "x", "y")] and read("b") == [("2", "3"), ("4", "5")]
    put("a2", "a", ["6,z,"])
    route_stream(spark, landing, target, checkpoint=ckpt)
    route_stream(spark, landing, target, checkpoint=ckpt)       # nothing new
    assert read("a") == [("1", "x", "y"), ("6", "z", None)] and len(read("b")) == 2
    # A batch that was written but not committed runs again under its number.
    last = max(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ckpt}/commits/{f}"):
            os.replace(f"{ckpt}/commits/{f}", f"{root}/undone-{f}")
    route_stream(spark, landing, target, checkpoint=ckpt)
    assert read("a") == [("1", "x", "y"), ("6", "z", None)] and len(read("b")) == 2
