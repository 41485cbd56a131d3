"""Readers and writers: round trips with bad cells, mixed dates, latin-1 text and nested records."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import tags as TG
from sensorloom.sources import io


def test_sensor_csv(spark, tmp_path):
    f = tmp_path / "s.csv"
    f.write_bytes("Fecha;flujo;presión\n01/02/2024 10:00;1.5;7\n31/12/2023 23:50;bad;é\nnot a date;2;3\n;;\n".encode("latin-1"))
    rows = io.read_sensor_csv(spark, str(f), ["flujo", "presión"], sep=";").collect()
    assert [r.Fecha for r in rows] == [datetime(2024, 2, 1, 10), datetime(2023, 12, 31, 23, 50), None, None]
    assert [r.flujo for r in rows] == [1.5, None, 2.0, None]
    assert [r["presión"] for r in rows] == [7.0, None, 3.0, None]


def test_dictionary_csv_feeds_validation(spark, tmp_path):
    f = tmp_path / "td.csv"
    f.write_text("tag,name,tag_type,data_type,unit,range_min,range_max,on_off_dependencies,derived\n"
                 'a,A,input,numeric,t,0,x,"p, q",True\np,P,on_off,boolean,,,,,false\nq,Q,state,numeric,,,,,0\n"b,c",B,odd,numeric,,,,z,1.0\n a,C,input,numeric,,,,,\n')
    td = io.read_tag_dictionary_csv(spark, str(f))
    row = td.where("tag = 'a'").first()
    assert (row.range_min, row.range_max, row.on_off_dependencies, row.derived) == (0.0, None, ["p", "q"], True)
    found = {(r.rule, r.tag, r.detail) for r in TG.validate_td(td).collect()}
    assert {("pattern", "b,c", "contains a comma"), ("known_values", "b,c", "tag_type=odd"), ("dependency_unknown", "b,c", "z"),
            ("dependency_not_on_off", "a", "q")} <= found
    with pytest.raises(TG.TagDictError):
        TG.validate_td(td, raise_on_error=True)
    with pytest.raises(TG.TagDictError):
        TG.validate_td(td.drop("unit"), raise_on_error=True)


def test_dictionary_json(spark, tmp_path):
    f = tmp_path / "td.json"
    f.write_text('{"a": {"unit": "t", "range_min": 1.5},\n "b": {"unit": null}}')
    got = {r.tag: (r.unit, r.range_min) for r in io.read_tag_dictionary_json(spark, str(f), "unit: string, range_min: double").collect()}
    assert got == {"a": ("t", 1.5), "b": (None, None)}


def test_campaign_dates(spark, tmp_path):
    f = tmp_path / "c.csv"
    f.write_text("Campana,m1,m2\nc1,2019-03-04,04-03-2019\nc2,,05/06/2020\nc3,2020/01/02,soon\n")
    rows = {(r.campaign, r.machine): r.start_ts for r in io.read_campaigns(spark, str(f), ["m1", "m2"]).collect()}
    assert rows == {("c1", "m1"): datetime(2019, 3, 4), ("c1", "m2"): datetime(2019, 3, 4), ("c2", "m2"): datetime(2020, 6, 5),
                    ("c3", "m1"): datetime(2020, 1, 2)}


def test_tables_and_records_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None), (3, "a", float("inf"))], "id long, k string, v double")
    for fmt in ("parquet", "json"):
        io.write_table(df, str(tmp_path / fmt), fmt)
        assert sorted(map(tuple, spark.read.schema(df.schema).format(fmt).load(str(tmp_path / fmt)).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    io.write_table(df, str(tmp_path / "part"), partition_by=["k"])
    assert spark.read.parquet(str(tmp_path / "part")).where("k = 'a'").count() == 2
    io.write_table(df, str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "csv")).count() == 3
    rec = df.select("id", F.create_map(F.lit("x"), F.struct("v", "k")).alias("controls"), F.array("k", F.lit("z")).alias("tags"))
    io.write_json_records(rec, str(tmp_path / "rec"))
    back = spark.read.schema(rec.schema).json(str(tmp_path / "rec")).where("id = 1").first()
    assert back.controls["x"].v == 1.5 and back.tags == ["a", "z"]
    flat = io.flatten_two_level(df.select("id", F.struct("k", "v").alias("s")))
    assert flat.columns == ["id", "s__k", "s__v"]


def test_model_round_trip(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from sensorloom.operators import ml as M
    df = spark.createDataFrame([(float(i), float(i % 3), 2.0 * i + 1) for i in range(30)], "a double, b double, y double")
    m = M.fit(df, ["a", "b"], "y", M.load_regressor("linear"))
    io.save_model(m, str(tmp_path / "m"))
    a, b = (M.predict(x, df).select("a", F.round("prediction", 9)).collect() for x in (m, PipelineModel.load(str(tmp_path / "m"))))
    assert sorted(a) == sorted(b)


def test_kept_result(spark):
    df = io.keep(spark.range(5), "kept_five")
    assert spark.table("kept_five").count() == 5 and df.is_cached
    df.unpersist()
