import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from heliotab.plans import catalog
from heliotab.schemas import PLANETS
from heliotab.sources import csvscan, testbed

SCHEMA = StructType().add("a", "integer").add("b", "double").add("c", "boolean").add("d", "string")


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_columns_go_by_name(spark, tmp_path):
    path = write(tmp_path, x="d, More ,B,a,c\nt,z,1.5,7,true\n,,,,\n")
    assert rows(csvscan.scan(spark, path, SCHEMA), *"abcd") == sorted([(7, 1.5, True, "t"), (None,) * 4], key=str)


def test_swapped_measures_of_a_planet_file(spark, sf_dir, tmp_path):
    """Two columns of one type in another order: only the header tells them apart."""
    names = list(PLANETS.names)
    planets = testbed.planets(spark, sf_dir).select(*names)
    at, to = names.index("gravity_g"), names.index("mass_earth")
    names[at], names[to] = names[to], names[at]
    planets.select(*names).write.option("header", True).csv(f"{tmp_path}/swapped")
    read = catalog.read_planets_csv(spark, f"{tmp_path}/swapped")
    assert read.columns == PLANETS.names and read.schema.simpleString() == PLANETS.simpleString()
    assert rows(read, *PLANETS.names) == rows(planets, *PLANETS.names)


def test_missing_columns_are_an_error_or_a_default(spark, tmp_path):
    path = write(tmp_path, x="a,c\n1,true\n")
    with pytest.raises(csvscan.HeaderError, match=r"columns missing: \['b', 'd'\]"):
        csvscan.scan(spark, path, SCHEMA)
    assert rows(csvscan.scan(spark, path, SCHEMA, {"b": 2, "d": None}), *"abcd") == [(1, 2.0, True, None)]


def test_a_column_named_twice_is_an_error(spark, tmp_path):
    with pytest.raises(csvscan.HeaderError, match="named twice"):
        csvscan.scan(spark, write(tmp_path, x="a,b,a,c,d\n1,2,3,true,x\n"), SCHEMA)


def test_files_of_a_folder_must_agree(spark, tmp_path):
    path = write(tmp_path, x="a,b,c,d\n1,2,true,x\n", y="b,a,c,d\n1,2,true,x\n")
    with pytest.raises(Exception, match="does not conform|header"):
        csvscan.scan(spark, path, SCHEMA).collect()


def test_problems_are_kept_beside_the_rows(spark, tmp_path):
    path = write(tmp_path, x="b,a,c,d\n1,2,true,ok\nword,2,perhaps,x\n1,2\n1,2,true,x,more\n,,,\n1e400,2.5,TRUE,\n")
    scanned = csvscan.scan(spark, path, SCHEMA, problems=True)
    assert rows(scanned, "a", "b", csvscan.PROBLEMS) == sorted(
        [(2, 1.0, []), (2, None, ["b", "c"]), (2, 1.0, ["line"]), (2, 1.0, ["line"]), (None, None, []), (None, float("inf"), ["a"])], key=str
    )
    assert rows(csvscan.rejected_rows(scanned), csvscan.RECORD) == [("1,2",), ("1,2,true,x,more",), (None,), (None,)]
    assert csvscan.clean_rows(scanned).columns == list("abcd") and csvscan.clean_rows(scanned).count() == 2
    assert rows(csvscan.problem_counts(scanned), "problem", "n") == [("a", 1), ("b", 1), ("c", 1), ("line", 2), ("none", 2)]
    # Also where few columns are asked for.
    assert scanned.where(F.array_contains(csvscan.PROBLEMS, "line")).select("a").count() == 2


def test_header_without_rows(spark, tmp_path):
    assert csvscan.scan(spark, write(tmp_path, x="a,b,c,d\n"), SCHEMA, problems=True).count() == 0
