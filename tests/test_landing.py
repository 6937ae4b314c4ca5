import datetime
import io
import uuid

import pyarrow as pa
import pyarrow.csv as arrow_csv
import pytest

from martwright import schemas
from martwright.plans import land_sales, prepare_population
from martwright.sources import land_csv, read_text_csv, typed
from martwright.workload import star

from .conftest import plan_text, sorted_rows

HEADER = ",".join(f"Other {i}" for i in range(24))
GOOD = [
    "INV-1", "1/2/2012", "7", '"STORE ""A"", B"', "", "CITY", "00123", "POINT (1 2)", "77", "POLK",
    "NA", "NULL", "", "VENDOR", "0099", " item ", "12", "750", "4.5", "6.75", "3", "20.25", " 2.25 ", "nan",
]


def write(folder, *lines):
    path = folder / "in.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def columns(schema):
    return [(field.name, field.dataType) for field in schema.fields]


def changed(**fields):
    values = dict(zip(schemas.SALES.names, GOOD)) | fields
    return ",".join(values.values())


def test_sales_row(spark, tmp_path):
    path = write(tmp_path, HEADER, ",".join(GOOD))
    df = land_sales(spark, path)
    assert columns(df.schema) == columns(schemas.SALES)
    assert tuple(df.first()) == (
        "INV-1", datetime.datetime(2012, 1, 2), 7, 'STORE "A", B', "", "CITY", "00123", "POINT (1 2)",
        77, "POLK", None, "NULL", None, "VENDOR", "0099", " item ", 12, 750, 4.5, 6.75, 3, 20.25, 2.25, None,
    )


def test_sales_agree_with_arrow(spark, tmp_path):
    lines = [HEADER, ",".join(GOOD)]
    lines += [changed(pack=token) for token in ("", "#N/A", "1.#IND", "null", "n/a")]
    lines += [changed(sale_dollars=v) for v in ("1e3", ".5", "5.", "-0", "inf", "-NaN", "+1.5")]
    lines += [changed(city=v) for v in ("", '""', "''", '" a "', "NaN", '"x,y"', '"""q"""')]
    lines += [changed(sale_date=v) for v in ("12/31/1999", "1/2/2012", "NA", "")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}
    types = {
        f.name: kinds.get(f.dataType.simpleString(), pa.timestamp("s"))
        for f in schemas.SALES.fields
    }
    expected = arrow_csv.read_csv(
        io.BytesIO("\n".join(lines).encode()),
        read_options=arrow_csv.ReadOptions(column_names=schemas.SALES.names, skip_rows=1),
        convert_options=arrow_csv.ConvertOptions(
            column_types=types, timestamp_parsers=["%m/%d/%Y"]
        ),
    ).to_pylist()
    landed = land_sales(spark, write(tmp_path, *lines)).collect()
    assert [row.asDict() for row in landed] == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "bad",
    [
        changed(pack="1.0"),
        changed(pack="x"),
        changed(sale_dollars="$4.5"),
        changed(sale_dollars='"1,000.5"'),
        changed(sale_dollars="1.5f"),
        changed(sale_date="2012-01-02"),
        changed() + ",one too many",
        ",".join(GOOD[:-1]),
    ],
)
def test_bad_row_fails(spark, conf, tmp_path, ansi, bad):
    conf("spark.sql.ansi.enabled", ansi)
    df = land_sales(spark, write(tmp_path, HEADER, ",".join(GOOD), bad))
    for result in (df, df.select("city")):
        with pytest.raises(Exception):
            result.collect()


def test_many_files_and_header_names(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part-{i}.csv").write_text(f"{HEADER}\n{changed(pack=str(i))}\n")
    assert sorted(r.pack for r in land_sales(spark, str(tmp_path)).collect()) == [0, 1, 2]
    assert read_text_csv(spark, str(tmp_path)).columns[0] == "Other 0"


def test_only_text_columns(spark, tmp_path):
    schema = schemas.as_text(schemas.POPULATION)
    df = land_csv(spark, write(tmp_path, "a,b,c,d,e", "1,,3,4,NULL"), schema)
    assert tuple(df.first()) == ("1", "", "3", "4", "NULL")


def test_landing_converts_once_in_the_jvm(spark, conf, tmp_path):
    conf("spark.sql.debug.maxToStringFields", "1000")
    plan = plan_text(land_sales(spark, write(tmp_path, HEADER, ",".join(GOOD))))
    assert "Python" not in plan
    assert plan.count("cast(store_number") == 1


POPULATION = [
    "FIPS,County,Year,Population,Primary Point",
    "19001,Adair County,July 01 2012,7500,POINT (-94.4 41.3)",
    "19003,Adams County,July 01 2012,7500.9,",
    "19005,NA,July 01 2013,,POINT (1 2)",
    "19007,Two County,July 01 2013,None,NULL",
]


def test_population(spark, tmp_path):
    df = prepare_population(spark, write(tmp_path, *POPULATION))
    assert columns(df.schema) == columns(schemas.POPULATION)
    assert sorted_rows(df) == [
        (19001, "Adair", 2012, 7500, "POINT (-94.4 41.3)"),
        (19003, "Adams", 2012, 7500, ""),
        (19005, "", 2013, 0, "POINT (1 2)"),
        (19007, "Two", 2013, 0, ""),
    ]


def test_population_points(spark, tmp_path):
    df = prepare_population(spark, write(tmp_path, *POPULATION), with_point=True)
    points = {row.fips: row.primary_point and tuple(row.primary_point) for row in df.collect()}
    assert points == {19001: (-94.4, 41.3), 19003: None, 19005: (1.0, 2.0), 19007: None}


@pytest.mark.parametrize("year", ["", "NA", "July", "201x"])
def test_population_needs_a_year(spark, tmp_path, year):
    df = prepare_population(spark, write(tmp_path, POPULATION[0], f"1,A County,{year},5,"))
    with pytest.raises(Exception):
        df.collect()


def test_population_files_with_another_order_of_columns(spark, tmp_path):
    folder = tmp_path / "people"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(POPULATION[:2]) + "\n")
    (folder / "b.csv").write_text(
        "Population,Year,Primary Point,FIPS,County\n20,July 01 2013,,2,Other County\n"
    )
    expected = [(2, "Other", 2013, 20, ""), (19001, "Adair", 2012, 7500, "POINT (-94.4 41.3)")]
    assert sorted_rows(prepare_population(spark, str(folder))) == sorted(expected, key=str)
    (folder / "c.csv").write_text("FIPS,County,Year,People,Primary Point\n3,C County,July 01 2013,5,\n")
    with pytest.raises(ValueError, match="c.csv"):
        prepare_population(spark, str(folder))


def jobs_of(spark, act):
    """Jobs that an action starts."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        act()
    finally:
        context._jsc.sc().clearJobGroup()
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_one_census_of_many_files(spark, tmp_path):
    """Two spellings of the header, blank lines before it, empty files, odd names: a constant number
    of jobs reads all headers."""
    counts = []
    for n in (80, 200):  # from 33 files of a header on, listing them is a job too
        folder = tmp_path / f"{n} files, 100%é"
        folder.mkdir()
        for i in range(n):
            odd = i % 2
            header = "Population,Year,Primary Point,FIPS,County" if odd else POPULATION[0]
            line = f"{i},July 01 2013,,{i},C{i} County" if odd else f"{i},C{i} County,July 01 2013,{i},"
            blank = "\n  \n" if i % 3 == 0 else ""
            (folder / f"part {i:03d}, 50%.csv").write_text(f"{blank}{header}\n{line}\n")
        (folder / "empty.csv").write_text("")
        (folder / "blank.csv").write_text("\n \n")
        found = []
        counts.append(jobs_of(spark, lambda folder=folder, found=found: found.append(prepare_population(spark, str(folder)))))
        expected = [(i, f"C{i}", 2013, i, "") for i in range(n)]
        assert sorted_rows(found[0]) == sorted(expected, key=str)
    assert counts[0] == counts[1] <= 12


def test_a_header_of_a_file_in_many_splits(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "64")
    path = write(tmp_path, *POPULATION)
    assert prepare_population(spark, [path]).count() == 4
    assert prepare_population(spark, path).filter("fips = 19007").first().county == "Two"


def test_population_needs_its_headers(spark, tmp_path):
    with pytest.raises(Exception):
        prepare_population(spark, write(tmp_path, "a,b,c,d,e", "1,A,July 01 2012,5,"))


def test_typed_reports_the_row(spark):
    df = spark.createDataFrame([("1", "x", "2012", "oops", "")], schemas.as_text(schemas.POPULATION))
    with pytest.raises(Exception, match="oops"):
        typed(df, schemas.POPULATION).collect()


def test_raw_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "ROWS_PER_RAW_FILE", 40, raising=False)
    rows = [(f"INV-{i}", "MACHINE  TOWN", 'A, "B"', None if i % 3 else "NA", "") for i in range(100)]
    frame = spark.createDataFrame(rows, "a string, b string, c string, d string, e string").coalesce(1)
    path = str(tmp_path / "raw")
    star.write_csv(frame, path)
    files = sorted((tmp_path / "raw").glob("part-*"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 2000
    read = read_text_csv(spark, path, frame.schema)
    expected = [tuple(v or None for v in row) for row in rows]
    found = [tuple(v or None for v in row) for row in read.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
