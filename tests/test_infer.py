"""Types and columns of CSV files without a schema."""

import pytest

from lotwise.sources.infer import found_types, infer_csv, read_text_columns


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def test_types_and_merged_columns(spark, tmp_path):
    write(tmp_path, "a.csv", 'id,price,mixed,flag,empty,"name, full"\n1,2.5,7,True,,"a ""quoted"" x"\n2,NaN,x,False,NA,"two\nlines"\n')
    write(tmp_path, "b.csv", "price,id,late,big\n3,3,True,99999999999999999999\n1e3, 4 ,1,5\n")
    df = infer_csv(spark, str(tmp_path))
    assert dict(df.dtypes) == {"id": "bigint", "price": "double", "mixed": "string", "flag": "boolean", "empty": "double",
                               "name, full": "string", "late": "string", "big": "double"}
    got = {r["id"]: r.asDict() for r in df.collect()}
    assert [got[i]["price"] for i in (1, 2, 3, 4)] == [2.5, None, 3.0, 1000.0]
    assert got[1]["name, full"] == 'a "quoted" x' and got[2]["name, full"] == "two\nlines"
    assert got[1]["flag"] is True and got[2]["flag"] is False and got[3]["flag"] is None
    assert (got[3]["late"], got[4]["late"], got[3]["big"]) == ("True", "1", 1e20) and got[1]["late"] is None


def test_counts(spark, tmp_path):
    write(tmp_path, "a.csv", "a,b,c\n1,,x\nnull,,\n-3,N/A,2\n")
    got = [tuple(r) for r in found_types(read_text_columns(spark, str(tmp_path))).orderBy("place").collect()]
    assert got == [(0, "a", "bigint", 2, 1), (1, "b", "double", 0, 3), (2, "c", "string", 2, 1)]


def test_odd_headers(spark, tmp_path):
    write(tmp_path, "a.csv", "x,,x,x\n1,2,3,4\n")
    assert infer_csv(spark, str(tmp_path)).columns == ["x", "Unnamed: 1", "x.1", "x.2"]
    write(tmp_path, "b.csv", "only\n")
    assert infer_csv(spark, str(tmp_path)).count() == 1
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        infer_csv(spark, str(tmp_path / "none"))
