from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fumeline.plans.roads import dissolve, kept_2020, kept_2023, rejected, roads
from fumeline.sinks.features import export, feature_json, labelled, write_json, write_tables
from fumeline.sources.features import (
    PATHS_TYPE, layout_of, list_sources, read_features, read_layouts, read_matching, source_value,
)

ROW_2020 = ("OBJECTID long, State_Code int, F_SYSTEM int, URBAN_CODE int, Route_ID string, "
            f"AADT int, Shape_Length double, paths {PATHS_TYPE}")
NAMED = ("OBJECTID long, StateID string, F_SYSTEM string, URBAN_ID string, RouteID string, "
         f"AADT string, Shape_Length double, paths {PATHS_TYPE}")
POSITIONAL = NAMED.replace("F_SYSTEM", "Field6").replace("URBAN_ID", "Field8")


def line(*points):
    return [[(float(x), float(y)) for x, y in points]]


def row_2020(oid, state, cls, urban, route, aadt, *points):
    return (oid, state, cls, urban, route, aadt, 1.0, line(*points))


def row_2023(oid, state, cls, urban, route, aadt, *points):
    return (oid, state, cls, urban, route, aadt, 1.0, line(*points))


STATE_1 = [
    row_2020(1, 1, 1, None, "A", 10, (0, 0), (1, 0)),
    row_2020(2, 1, 2, 5, "A", 10, (1, 0), (2, 0)),
    row_2020(3, 1, 4, 99999, "A", 10, (2, 0), (3, 0)),
    row_2020(4, 1, 1, 6, "B", 7, (9, 9), (8, 8)),
    row_2020(5, 1, 1, 6, "B", 0, (5, 5), (6, 6)),
]
STATE_2 = [row_2020(1, 2, 3, 7, "A", 10, (1, 0), (2, 0))]


@pytest.fixture
def workspace(spark, tmp_path):
    root = tmp_path / "roads"
    spark.createDataFrame(STATE_1, ROW_2020).write.parquet(str(root / "S1_2020"))
    spark.createDataFrame(STATE_2, ROW_2020).write.parquet(str(root / "S2_2020.parquet"))
    spark.createDataFrame(STATE_2, ROW_2020).write.parquet(str(root / "district" / "S3_2020"))
    spark.createDataFrame(STATE_2, ROW_2020).write.parquet(str(root / "S4_2019"))
    named = [row_2023(1, "1", "1", None, "A", "10", (0, 0), (1, 0)),
             row_2023(2, "1", "4", "5", "A", "10", (1, 0), (2, 0)),
             row_2023(3, "1", "1", "5", "A", "10x", (2, 0), (3, 0)),
             row_2023(4, "1", "1", "5", None, "10", (2, 0), (3, 0)),
             row_2023(5, "1", "1", "5y", "A", "10", (2, 0), (3, 0)),
             row_2023(6, "1", "1", "5y", "A", "0", (2, 0), (3, 0))]
    positional = [row_2023(1, "2", "3", "7", "A", "010", (1, 0), (2, 0))]
    spark.createDataFrame(named, NAMED).write.parquet(str(root / "S1_2023"))
    spark.createDataFrame(positional, POSITIONAL).write.parquet(str(root / "S2_2023"))
    return str(root)


def names(found):
    return [name for _, name in found]


def test_listing_by_pattern(spark, workspace):
    assert names(list_sources(spark, workspace, "*_2020")) == ["S1_2020", "S2_2020"]
    assert names(list_sources(spark, workspace, "*_2020", recursive=True)) == [
        "S1_2020", "S2_2020", "S3_2020"]
    assert list_sources(spark, workspace, "*_1999") == []


def test_matching_sources_are_one_scan(spark, workspace):
    df = read_matching(spark, workspace, "*_2020")
    assert {r["source"]: r["count"] for r in df.groupBy("source").count().collect()} == {
        "S1_2020": 5, "S2_2020": 1}
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_json_features(spark, tmp_path):
    path = str(tmp_path / "S9_2020")
    spark.createDataFrame(STATE_1, ROW_2020).write.json(path)
    df = read_features(spark, path, "json", ROW_2020)
    assert df.count() == 5 and df.first()["source"] == "S9_2020"
    assert df.filter("OBJECTID = 1").first()["paths"][0][1]["x"] == 1.0


def test_source_value_is_the_first_rows(spark, workspace):
    df = read_matching(spark, workspace, "*_2020")
    assert {r["source"]: r["value"] for r in source_value(df, "Route_ID").collect()} == {
        "S1_2020": "A", "S2_2020": "A"}


def test_layouts(spark, workspace):
    assert layout_of(["Field6", "x"]) == "named" and layout_of(["field8", "FIELD6"]) == "positional"
    df = read_layouts(spark, workspace, "*_2023")
    got = {(r["source"], r["OBJECTID"]): (r["F_SYSTEM"], r["URBAN_ID"]) for r in df.collect()}
    assert got["S1_2023", 2] == ("4", "5") and got["S2_2023", 1] == ("3", "7")
    assert "Field6" not in df.columns


def test_rejects_of_2023(spark, workspace):
    good, rejects = kept_2023(read_layouts(spark, workspace, "*_2023"))
    assert sorted((r["source"], r["OBJECTID"]) for r in good.collect()) == [
        ("S1_2023", 1), ("S1_2023", 2), ("S2_2023", 1)]
    assert sorted(r["OBJECTID"] for r in rejects.collect()) == [3, 4, 5]
    assert rejected(spark, workspace).count() == 3


def test_missing_length_is_computed(spark):
    rows = [row_2020(1, 1, 1, 1, "A", 5, (0, 0), (1, 0)), row_2020(2, 1, 1, 1, "A", 5, (2, 2), (2, 2))]
    df = spark.createDataFrame([(*r, "s") for r in rows], ROW_2020 + ", source string")
    assert kept_2020(df).count() == 2
    assert [r["OBJECTID"] for r in kept_2020(df.drop("Shape_Length")).collect()] == [1]


def test_roads_2020(spark, workspace):
    got = roads(spark, workspace, 2020, "State_Code").orderBy("value", "ID").collect()
    assert [(r["value"], r["ID"], r["state_code"], r["urban_code"], r["f_system"], r["aadt"])
            for r in got] == [
        ("1", 1, 1.0, None, "1", 10.0), ("1", 2, 1.0, 6.0, "1", 7.0), ("2", 1, 2.0, 7.0, "3", 10.0)]
    assert [[(p["x"], p["y"]) for p in r["paths"][0]] for r in got] == [
        [(0, 0), (1, 0), (2, 0)], [(8, 8), (9, 9)], [(1, 0), (2, 0)]]


def test_roads_2023(spark, workspace):
    got = roads(spark, workspace, 2023, "StateID").orderBy("value", "ID").collect()
    assert [(r["value"], r["ID"], r["f_system"], r["aadt"], len(r["paths"][0])) for r in got] == [
        ("1", 1, "1", 10.0, 3), ("2", 1, "3", 10.0, 2)]


def test_strict_key_separates_routes(spark):
    rows = [row_2020(1, 1, 1, 1, "1", 23, (0, 0), (1, 0)), row_2020(2, 1, 1, 1, "12", 3, (1, 0), (2, 0))]
    df = spark.createDataFrame([(*r, "s") for r in rows], ROW_2020 + ", source string")
    assert dissolve(kept_2020(df)).count() == 1
    assert dissolve(kept_2020(df, strict_key=True)).count() == 2


def test_a_class_is_told_by_its_folder(spark, tmp_path):
    """Any file names, dots, spaces and escapes in names, equal names in two dataset folders."""
    root = tmp_path / "roads"
    for folder in ("St.A_2020", "St.B_2020", "New York+1%_2020", "d1/S1_2020", "d2/S1_2020"):
        at = root / folder
        spark.createDataFrame(STATE_1[:2], ROW_2020).repartition(2).write.parquet(str(at))
        for k, file in enumerate(sorted(at.glob("part-*"))):
            file.rename(at / f"{k}.snappy.parquet")
        for left in at.glob(".*"):
            left.unlink()
    flat = ["New York+1%_2020", "St.A_2020", "St.B_2020"]
    assert names(list_sources(spark, str(root), "*_2020")) == flat
    assert names(list_sources(spark, str(root), "*_2020", recursive=True)) == [
        flat[0], *flat[1:], "d1/S1_2020", "d2/S1_2020"]
    df = read_matching(spark, str(root), "*_2020", recursive=True)
    assert {r["source"]: r["count"] for r in df.groupBy("source").count().collect()} == dict.fromkeys(
        [*flat, "d1/S1_2020", "d2/S1_2020"], 2)


def test_classes_of_other_types_and_without_length(spark, tmp_path):
    """Whole, broken and text traffic values; one class has no length, one has a missing one."""
    root = str(tmp_path / "roads")
    kinds = {"A": "int", "B": "double", "C": "long"}
    for name, kind in kinds.items():
        df = spark.createDataFrame(STATE_1, ROW_2020).withColumn("AADT", F.col("AADT").cast(kind))
        df = df.withColumn("State_Code", F.lit(ord(name)))
        if name == "A":
            df = df.drop("Shape_Length")
        if name == "B":
            df = df.withColumn("Shape_Length", F.lit(None).cast("double"))
        df.write.parquet(f"{root}/{name}_2020")
    df = read_matching(spark, root, "*_2020")
    assert dict(df.dtypes)["AADT"] == "double"
    got = roads(spark, root, 2020, "State_Code")
    assert {r["value"]: r["count"] for r in got.groupBy("value").count().collect()} == {"65": 2, "66": 2, "67": 2}
    wide = roads(spark, root, 2020, "State_Code", wide_ids=True, tolerance=0.5)
    assert dict(wide.dtypes)["ID"] == "bigint" and wide.count() == 6


def test_a_bad_state_text_is_rejected(spark, tmp_path):
    root = str(tmp_path / "roads")
    rows = [row_2023(1, " 6 ", "1", "5", "A", "10", (0, 0), (1, 0)),
            row_2023(2, "CA", "1", "5", "A", "10", (1, 0), (2, 0))]
    spark.createDataFrame(rows, NAMED).write.parquet(f"{root}/S1_2023")
    good, _ = kept_2023(read_layouts(spark, root, "*_2023"))
    assert [(r["OBJECTID"], r["state_code"]) for r in good.collect()] == [(1, 6.0)]
    assert [r["OBJECTID"] for r in rejected(spark, root).collect()] == [2]


def test_labels_of_text_do_not_sort_the_input(spark, workspace):
    df = read_layouts(spark, workspace, "*_2023")
    plan = source_value(df, "StateID")._jdf.queryExecution().executedPlan().toString()
    firsts = df.groupBy("source").agg(F.min("OBJECTID"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in firsts and plan.count("SortAggregate") <= 2  # only over the rows looked up


def exported(spark, rows):
    kinds = ("first_state_code double, first_urban_code int, first_f_system string, mean_aadt double, "
             "ID long, path array<struct<x:double,y:double>>, value string")
    return export(spark.createDataFrame(rows, kinds))


def one(value, i, text="1", urban=5):
    return (1.0, urban, text, 2.5, i, [(0.0, float(i)), (1.5, float(i))], value)


def test_export_types_and_text_length(spark):
    df = exported(spark, [one("v", 1, "x" * 300)])
    assert dict(df.dtypes) == {
        "state_code": "double", "urban_code": "double", "f_system": "string", "aadt": "double",
        "ID": "int", "paths": PATHS_TYPE, "value": "string"}
    assert len(df.first()["f_system"]) == 255


def test_ids_beyond_32_bits_do_not_wrap(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        exported(spark, [one("v", 1 << 31)]).collect()


def test_feature_json_text(spark):
    got = exported(spark, [one("v", 1, urban=None)]).select(feature_json()).first()[0]
    assert got == ('{"attributes":{"state_code":1.0,"urban_code":null,"f_system":"1","aadt":2.5,'
                   '"ID":1},"geometry":{"paths":[[[0.0,1.0],[1.5,1.0]]]}}')


def documents(out):
    """Each file that is there, parsed."""
    return {file.name: json.loads(file.read_text()) for file in Path(out).glob("*.json")}


def test_json_documents(spark, tmp_path):
    out = str(tmp_path / "json")
    rows = [one("06", i) for i in range(1, 2001)] + [one("07", 1, urban=None), one("", 1), one(None, 1)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_json(exported(spark, rows[::-1]).repartition(5), out, 2020, wkid=4269)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = documents(out)
    assert sorted(found) == ["HPMS2020_06.json", "HPMS2020_07.json"]
    big = found["HPMS2020_06.json"]
    assert [f["attributes"]["ID"] for f in big["features"]] == list(range(1, 2001))
    assert big["geometryType"] == "esriGeometryPolyline"
    assert big["spatialReference"] == {"wkid": 4269}
    assert [f["name"] for f in big["fields"]] == ["state_code", "urban_code", "f_system", "aadt", "ID"]
    # Nothing but the files, though the values lay over several tasks.
    assert sorted(f.name for f in Path(out).iterdir() if not f.name.endswith(".crc")) == sorted(found)
    assert found["HPMS2020_07.json"]["features"][0]["attributes"]["urban_code"] is None


def test_json_of_many_features_becomes_several_documents(spark, tmp_path):
    out = str(tmp_path / "json")
    df = exported(spark, [one("06", i) for i in range(1, 26)] + [one("07", i) for i in range(1, 11)])
    write_json(df.repartition(3), out, 2020, most=10)
    found = {name: [f["attributes"]["ID"] for f in d["features"]] for name, d in documents(out).items()}
    assert found == {"HPMS2020_06.json": list(range(1, 11)), "HPMS2020_06_2.json": list(range(11, 21)),
                     "HPMS2020_06_3.json": list(range(21, 26)), "HPMS2020_07.json": list(range(1, 11))}


def test_documents_are_read_in_slices(spark, tmp_path):
    """No task reads a whole document, and what is missing, misplaced or out of order is seen."""
    import __spark_entry__ as entry

    out = str(tmp_path / "json")
    write_json(exported(spark, [one("06", i) for i in range(1, 200)] + [one("07", 1)]), out, 2020, most=150)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        pieces = entry._document_pieces(spark, out).groupBy("file").count().collect()
        assert max(r["count"] for r in pieces) > 5
        found = {r["name"]: r[1:] for r in entry._documents(spark, out).collect()}
        kind = "esriGeometryPolyline"
        assert found == {"HPMS2020_06.json": (199, kind, True, 497.5), "HPMS2020_07.json": (1, kind, True, 2.5)}
        own = (Path(out) / "HPMS2020_06.json").read_text().splitlines()
        bad = {"swapped": own[:9] + [own[10], own[9]] + own[11:], "lost": own[:70] + own[71:], "open": own[:-1],
               "early": own[:60] + [own[-1]] + own[60:-1], "uncut": own[:50] + [own[50][1:]] + own[51:]}
        for name, lines in bad.items():
            folder = tmp_path / name
            folder.mkdir()
            (folder / "HPMS2020_06.json").write_text("\n".join(lines) + "\n")
            assert [r["in_order"] for r in entry._documents(spark, str(folder)).collect()] == [False], name
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_json_that_fails_leaves_nothing(spark, tmp_path, monkeypatch):
    from fumeline.sinks import features as sink

    out = str(tmp_path / "json")
    df = exported(spark, [one("06", i) for i in range(1, 20)] + [one("07", 1)])
    kept = sink.feature_json
    monkeypatch.setattr(sink, "feature_json", lambda *a: F.when(F.col("ID") == 15, F.raise_error(F.lit("no"))).otherwise(kept(*a)))
    with pytest.raises(Exception, match="no"):
        write_json(df, out, 2020)
    monkeypatch.undo()
    assert not list(Path(out).glob("*"))
    # One of the files is there already when they are moved.
    write_json(exported(spark, [one("06_2", 1)]), out, 2020)
    with pytest.raises(FileExistsError):
        write_json(df, out, 2020, most=10)
    assert list(documents(out)) == ["HPMS2020_06_2.json"]


def test_no_feature_class_matches(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for root in (str(tmp_path / "empty"), str(tmp_path / "nowhere")):
        assert list_sources(spark, root, "*_2020") == []
        for year, field in ((2020, "State_Code"), (2023, "StateID")):
            with pytest.raises(FileNotFoundError, match=rf"\*_{year}.*{root}"):
                roads(spark, root, year, field)


def test_json_refuses_to_overwrite(spark, tmp_path):
    out = str(tmp_path / "json")
    write_json(exported(spark, [one("06", 1)]), out, 2020)
    before = documents(out)
    write_json(exported(spark, [one("07", 1)]), out, 2020)  # another value beside it
    with pytest.raises(FileExistsError, match="HPMS2020_06.json"):
        write_json(exported(spark, [one("06", 1), one("08", 1)]), out, 2020)
    assert sorted(documents(out)) == ["HPMS2020_06.json", "HPMS2020_07.json"]
    assert documents(out)["HPMS2020_06.json"] == before["HPMS2020_06.json"]


def test_json_refuses_a_shared_value(spark, tmp_path):
    with pytest.raises(ValueError, match="share the value"):
        write_json(exported(spark, [one("06", 1), one("06", 1)]), str(tmp_path / "json"), 2020)


def test_tables_per_value(spark, tmp_path):
    out = str(tmp_path / "tables")
    df = exported(spark, [one("06", 1), one("06", 2), one("07", 1), one(None, 1), one("", 1)])
    write_tables(df, out, 2020)
    back = read_matching(spark, out, "HPMS2020_*_forJSON")
    assert {r["source"]: r["count"] for r in back.groupBy("source").count().collect()} == {
        "HPMS2020_06_forJSON": 2, "HPMS2020_07_forJSON": 1}
    with pytest.raises(FileExistsError, match="HPMS2020_06_forJSON"):
        write_tables(df, out, 2020)
    write_tables(exported(spark, [one("08: x", 1)]), out, 2020)
    with pytest.raises(FileExistsError):
        write_tables(exported(spark, [one("08: x", 1)]), out, 2020)
    with pytest.raises(ValueError, match="share the value"):
        write_tables(exported(spark, [one("09", 1), one("09", 1)]), out, 2020)


def test_unlabelled_lines_are_not_exported(spark):
    df = exported(spark, [one("06", 1), one(None, 1), one("", 1)])
    assert [r["value"] for r in labelled(df).collect()] == ["06"]


def test_numbering_shuffles_rows_once(spark):
    """What is numbered is sorted whole: no copy of it is kept to be joined again."""
    from fumeline.operators.numbering import number
    from fumeline.session import stage_root

    root = Path(stage_root(spark))
    before = set(root.iterdir())
    df = spark.range(100).selectExpr("id % 3 as g", "(id * 7) % 100 as o", "repeat('x', 50) as wide").repartition(4)
    numbered = number(df, ["g"], ["o"])
    assert sorted((r["g"], r["ID"]) for r in numbered.collect()) == sorted(
        (g, i) for g, n in ((0, 34), (1, 33), (2, 33)) for i in range(1, n + 1))
    left = sorted(p.name.partition("-")[0] for p in set(root.iterdir()) - before if any(p.glob("*.parquet")))
    assert left == ["shifts", "sorted"]


def test_feature_classes_are_written_unsorted(spark):
    """No task sorts whole segments to deal them to classes: each class keeps the order it is read in."""
    from checks import standins

    root = standins.feature_classes(spark, "/root/testdata/sf0.001", 2020)
    files = spark.read.parquet(root).select(F.col("_metadata.file_path").alias("file"), "OBJECTID", "State_Code")
    mixed = files.groupBy("file").agg(F.count_distinct("State_Code").alias("states"), F.min("State_Code").alias("state"))
    assert mixed.filter("states > 1 or file not like concat('%feature_class=state', state, '_2020/%')").count() == 0
    for year in (2020, 2023):
        # One writing job a class: a success mark in each, none above.
        folder = Path(standins.feature_classes(spark, "/root/testdata/sf0.001", year))
        marks = [p.parent for p in folder.rglob("_SUCCESS")]
        assert len(marks) == 5 and folder not in marks
