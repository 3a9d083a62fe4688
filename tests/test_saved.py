"""A saved run read again: names of any spelling, ragged widths, folders that are not there."""

import shutil

from ledgerlens.sources import saved

NAMES = [(0, "2011", "a/b"), (1, "2011", "x=1"), (2, "t é", ".hidden"), (3, "", "1e3"), (4, "t/%2F", "_n"), (5, "none", "none")]


def frames(spark):
    index = spark.createDataFrame([(i, t, n, f"doc {n}\n", [float(i), 0.5] if i != 5 else None) for i, t, n in NAMES],
                                  "id long, table_name string, name string, doc string, vec array<double>")
    cells = spark.createDataFrame([(i, t, n, k, [float(k)] * (3 if i == 1 and k else 2)) for i, t, n in NAMES if i not in (4, 5) for k in range(2)],
                                  "id long, table_name string, name string, row_index long, vec array<double>")
    return index, cells


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_round_trip_by_id(spark, tmp_path):
    index, cells = frames(spark)
    path = str(tmp_path / "run")
    saved.save_index(index, path)
    saved.save_cells(cells, path)
    got = rows(saved.merged(spark, path))
    want = [("column", t, n, i, float(i), 0.5, None) for i, t, n in NAMES if i != 5]
    want += [("cell", t, n, k, float(k), float(k), float(k) if i == 1 and k else None) for i, t, n in NAMES if i < 4 for k in range(2)]
    assert got == sorted(want, key=repr)
    assert (tmp_path / "run/cell_embs/table_name=2011/name=x%3D1").is_dir()
    state = {(r.id, r.type): (r.status, r.n, r.width) for r in saved.status(spark, path).collect()}
    assert state[1, "cell"] == ("ragged", 2, 3) and state[4, "cell"] == ("missing", 0, None) and state[5, "column"] == ("missing", 0, None)
    assert state[3, "column"] == ("ok", 1, 2) and len(state) == 12


def test_missing_folders_are_data(spark, tmp_path):
    index, cells = frames(spark)
    path = str(tmp_path / "run")
    saved.save_index(index, path)
    assert {r.type for r in saved.merged(spark, path).collect()} == {"column"}
    saved.save_cells(cells, path)
    shutil.rmtree(tmp_path / "run/col_vecs")
    assert {r.type for r in saved.merged(spark, path).collect()} == {"cell"}
    assert {(r.type, r.status) for r in saved.status(spark, path).where("id = 0").collect()} == {("column", "missing"), ("cell", "ok")}
    shutil.rmtree(tmp_path / "run/meta")
    assert {r.name for r in saved.merged(spark, path).collect()} == {None} and saved.status(spark, path).collect() == []
    assert saved.merged(spark, str(tmp_path / "nothing")).collect() == []
