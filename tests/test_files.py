import os
import time

import pytest

from conftest import rows
from levain.sources.files import FileIngest, header_columns, parse_age, parse_size


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    time.sleep(0.02)


def make(spark, root, **kw):
    return FileIngest(spark, path=f"{root}/in/*.csv", target=f"{root}/bronze", checkpoint=f"{root}/ckpt",
                      schema_location=f"{root}/schema",
                      options={"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "true",
                               "ignoreTrailingWhiteSpace": "true"}, **kw)


def test_option_parsing():
    assert parse_size("10g") == 10 * 1024 ** 3 and parse_size(512) == 512
    assert parse_age("365 days") == "365d"
    assert header_columns('a,"b,c",d') == ["a", "b,c", "d"]


def test_rescue_edge_rows(spark, workdir):
    root = workdir.replace("file:", "")
    write(f"{root}/in/f1.csv", "id,name,amount\n1,alpha,10\n2,beta,20\n")
    ing = make(spark, root, evolution_mode="rescue")
    ing.run()
    write(f"{root}/in/f2.csv", 'amount,name,id,extra\nbad,"  padded  ",3,EE\n5,"say ""hi""",4,\n,,6,\n')
    write(f"{root}/in/f3.csv", "id,name\n7,only-two\n8,   loose   \n")
    ing.run()
    got = rows(ing.read(), "id", "name", "amount", "_rescued_data")
    assert got == [(1, "alpha", 10, None), (2, "beta", 20, None),
                   # whitespace inside quotes is data; outside quotes it is trimmed
                   (3, "  padded  ", None, '{"amount":"bad","extra":"EE"}'),
                   (4, 'say "hi"', 5, None), (6, None, None, None), (7, "only-two", None, None),
                   (8, "loose", None, None)]
    assert ing.read().select("__batch_id").distinct().count() == 2


def test_evolution_modes(spark, workdir):
    root = workdir.replace("file:", "")
    write(f"{root}/in/f1.csv", "a,b,c\n1,x,2024-01-01 10:00:00\n")
    ing = make(spark, root, evolution_mode="addNewColumns")
    ing.run()
    write(f"{root}/in/f2.csv", "a,b,c,d\n2,y,2024-01-02 10:00:00,true\n")
    ing.run()
    df = ing.read()
    assert dict(df.dtypes)["d"] == "boolean" and dict(df.dtypes)["c"] == "timestamp_ntz"
    assert rows(df, "a", "d") == [(1, None), (2, True)]


def test_throttle_batches(spark, workdir):
    root = workdir.replace("file:", "")
    for i in range(5):
        write(f"{root}/in/f{i}.csv", f"id\n{i}\n")
    seen = []
    make(spark, root, max_files_per_trigger=2).run(on_batch=lambda b, r: seen.append(r.count()))
    assert seen == [2, 2, 1]


def test_restart_reads_nothing_new(spark, workdir):
    root = workdir.replace("file:", "")
    write(f"{root}/in/f1.csv", "id\n1\n2\n")
    ing = make(spark, root)
    ing.run()
    ing.run()
    assert ing.read().count() == 2


def test_header_probes_agree(spark, workdir):
    """Reading first lines through Arrow and by a text scan group files the same way."""
    root = workdir.replace("file:", "")
    write(f"{root}/in/a.csv", "x,y\n1,2\n")
    write(f"{root}/in/b.csv", "y,x\r\n3,4\r\n")
    ing = make(spark, root)
    paths = [f"file:{root}/in/a.csv", f"file:{root}/in/b.csv"]
    want = {"x,y": [paths[0]], "y,x": [paths[1]]}
    assert ing._headers(paths) == want
    scanned = ing._grouped(ing._first_lines_scan(paths, {**ing._opts(), "lineSep": "\n"}))
    assert {h.strip(): [f.replace("file:///", "file:/") for f in files] for h, files in scanned.items()} == want


def test_schema_does_not_depend_on_the_throttle(spark, workdir):
    for n in (1, 1000):
        root = f"{workdir}/{n}".replace("file:", "")
        write(f"{root}/in/f1.csv", "q\n1\n")
        write(f"{root}/in/f2.csv", "q\n2.5\n")
        ing = make(spark, root, max_files_per_trigger=n)
        ing.run()
        write(f"{root}/in/f3.csv", "q,r\n3,1\n")
        write(f"{root}/in/f4.csv", "q,r\n4,x\n")
        ing.run()
        df = ing.read()
        assert dict(df.dtypes)["q"] == "double" and dict(df.dtypes)["r"] == "string", n
        assert rows(df, "q", "r", "_rescued_data") == [(1.0, None, None), (2.5, None, None), (3.0, "1", None), (4.0, "x", None)]


def test_header_case_repeated_and_empty_names(spark, workdir):
    root = workdir.replace("file:", "")
    write(f"{root}/in/f1.csv", "id,name\n1,a\n")
    ing = make(spark, root, evolution_mode="rescue")
    ing.run()
    write(f"{root}/in/f2.csv", "NAME,ID\nb,2\n")
    write(f"{root}/in/f3.csv", "id,,Id,name\n3,p,q,c\n")
    ing.run()
    assert rows(ing.read(), "id", "name", "_rescued_data") == [(1, "a", None), (2, "b", None), (3, "c", '{"_c1":"p","Id_2":"q"}')]


def test_ragged_rows(spark, workdir):
    root = workdir.replace("file:", "")
    write(f"{root}/in/f1.csv", 'id,name\n1,a\n2\n3,"x, ""y""",  more  ,"q,r"\n,,only\n4,b,\n')
    ing = make(spark, root)
    ing.run()
    assert rows(ing.read(), "id", "name", "_rescued_data") == [
        (1, "a", None), (2, None, None), (3, 'x, "y"', '{"_c2":"more","_c3":"q,r"}'), (4, "b", None), (None, None, '{"_c2":"only"}')]


def test_without_a_rescue_column_a_bad_value_fails(spark, workdir):
    root = workdir.replace("file:", "")
    with pytest.raises(ValueError):
        make(spark, root, evolution_mode="rescue", rescued_data_column=None)
    with pytest.raises(ValueError):
        make(spark, root, evolution_mode="none")
    write(f"{root}/in/f1.csv", "q\n1\n")
    ing = make(spark, root, rescued_data_column=None)
    ing.run()
    write(f"{root}/in/f2.csv", "q\nbad\n")
    with pytest.raises(Exception, match="do not fit the schema"):
        ing.run()
    assert rows(ing.read(), "q") == [(1,)]


def test_both_throttles_cut_parts_in_order(spark, workdir):
    root = workdir.replace("file:", "")
    for i, size in enumerate((10, 10, 30, 10, 10)):
        write(f"{root}/in/f{i}.csv", "t\n" + "x" * size + "\n")
    seen = []
    make(spark, root, max_files_per_trigger=4, max_bytes_per_trigger=30).run(on_batch=lambda b, r: seen.append((b, r.count())))
    assert seen == [(0, 2), (0, 1), (0, 1), (1, 1)]


def ingest_json(spark, root, **kw):
    return FileIngest(spark, path=f"{root}/in/*.json", target=f"{root}/bronze", checkpoint=f"{root}/ckpt",
                      schema_location=f"{root}/schema", format="json", **kw)


def test_json_drift_case_and_broken_lines(spark, workdir):
    root = workdir.replace("file:", "")
    write(f"{root}/in/f1.json", '{"q":1,"s":{"a":1}}\n{"q":2}\n')
    ing = ingest_json(spark, root, evolution_mode="rescue", schema_hints="q BIGINT")
    ing.run()
    write(f"{root}/in/f2.json", '{"Q":1.5,"s":{"a":2},"new":[1,2]}\n{"q":3,"Q":4}\nnot json\n\n{}\n{"q":null}\n')
    ing.run()
    df = ing.read()
    assert dict(df.dtypes)["q"] == "bigint" and dict(df.dtypes)["s"] == "struct<a:bigint>"
    assert rows(df, "q", "s.a", "_rescued_data") == [
        (1, 1, None), (2, None, None), (3, None, '{"Q#1":"4"}'), (None, 2, '{"Q":"1.5","new":"[1,2]"}'), (None, None, '{"_corrupt_record":"not json"}'),
        (None, None, None), (None, None, None)]


def test_columnar_drift(spark, workdir):
    for fmt in ("parquet", "orc"):
        root = f"{workdir}/{fmt}"
        spark.createDataFrame([(1, "a")], "id int, v string").coalesce(1).write.format(fmt).save(f"{root}/in/p1")
        ing = FileIngest(spark, path=f"{root}/in/p*/*.{fmt}", target=f"{root}/bronze", checkpoint=f"{root}/ckpt",
                         schema_location=f"{root}/schema", format=fmt, evolution_mode="rescue", schema_hints="id BIGINT")
        ing.run()
        spark.createDataFrame([(2.5, [1], "b"), (3.0, None, "c")], "id double, v array<int>, w string").coalesce(1).write.format(fmt).save(f"{root}/in/p2")
        ing.run()
        assert dict(ing.read().dtypes)["id"] == "bigint"
        assert rows(ing.read(), "id", "v", "_rescued_data") == [(1, "a", None), (None, "[1]", '{"id":"2.5","w":"b"}'), (None, None, '{"id":"3.0","w":"c"}')]


def test_nothing_to_ingest(spark, workdir):
    root = workdir.replace("file:", "")
    os.makedirs(f"{root}/in")
    make(spark, root).run()
    assert not os.path.exists(f"{root}/bronze")


def test_json_arrays_are_a_row_for_each_element(spark, workdir):
    local = workdir.removeprefix("file:")
    with open(f"{local}/a.json", "w") as f:
        f.write('[{"id": 1, "v": "x"},\n {"id": 2, "w": true}]')
    with open(f"{local}/b.json", "w") as f:
        f.write('{"id": 3}')
    with open(f"{local}/c.json", "w") as f:
        f.write("[]")
    with open(f"{local}/d.json", "w") as f:
        f.write('[{"id": 4,')
    ing = FileIngest(spark, path=f"{workdir}/*.json", target=f"{workdir}/b", checkpoint=f"{workdir}/c", schema_location=f"{workdir}/s", format="json", options={"multiLine": "true"})
    ing.run()
    got = sorted(((r["id"], r["v"], r["w"], r["_rescued_data"]) for r in spark.read.parquet(ing.target).collect()), key=str)
    assert [g[:3] for g in got] == [(1, "x", None), (2, None, True), (3, None, None), (None, None, None)] and got[3][3] is not None


def test_json_types_are_read_once_and_files_that_come_later_are_whole(spark, workdir, monkeypatch):
    calls = []
    read = FileIngest._json_schema
    monkeypatch.setattr(FileIngest, "_json_schema", lambda self, paths: calls.append(len(paths)) or read(self, paths))
    for n, text in enumerate(['[{"a": 1, "b": "x"},\n {"a": 2}]', '[{"a": 3}]', '[{"a": 4, "c": true}]']):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{workdir}/in/{n}")

    class Late(FileIngest):
        def _look_ahead(self):
            super()._look_ahead()
            if late:
                spark.createDataFrame([('[{"a": 5, "d": 2.5}]',)], "value string").coalesce(1).write.text(f"{workdir}/in/{late.pop()}")

    late = []
    ing = Late(spark, path=f"{workdir}/in/*/*.txt", target=f"{workdir}/b", checkpoint=f"{workdir}/c", schema_location=f"{workdir}/s", format="json",
               options={"multiLine": "true"}, max_files_per_trigger=1)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    ing.run()
    assert calls == [3] and spark.conf.get(key) == before
    assert rows(ing.read(), "a", "b", "c") == [(1, "x", None), (2, None, None), (3, None, None), (4, None, True)]
    for n in (10, 11):
        spark.createDataFrame([('[{"a": 6, "b": "y", "c": false}]',)], "value string").coalesce(1).write.text(f"{workdir}/in/{n}")
    late.append(5)
    ing.run()
    assert rows(ing.read().filter("a > 4"), "a", "b", "c", "d") == [(5, None, None, 2.5), (6, "y", False, None), (6, "y", False, None)]
