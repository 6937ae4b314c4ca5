import json
import time
from pathlib import Path

import pytest

from martwright import schemas
from martwright.plans import TABLES, current_tables, full_refresh, ledger, refresh
from martwright.plans.ledger import Ledger, LostLease, retire
from martwright.sinks import published, publish_views, settle_views, write_parquet
from martwright.sources import read_parquet
from martwright.storage import create_text, listed, names, read_text, replace_text

from .conftest import plan_text, sorted_rows

SALES_HEADER = ",".join(f"Other {i}" for i in range(24))


def sale(date, city, county, category, liters, dollars, store="HY-VEE  FOOD"):
    values = dict.fromkeys(schemas.SALES.names, "")
    values |= {
        "sale_date": date, "city": city, "county": county, "category_name": category,
        "volume_sold_liters": str(liters), "sale_dollars": str(dollars), "store_name": store,
    }
    return ",".join(values.values())


SALES = [
    sale("1/5/2012", "OTUMWA", "WAPELLO", "GIN", 1.5, 10),
    sale("12/31/2021", "OTTUMWA", "WAPELLO", "RUM", 1, 5.25),
    sale("3/1/2011", "OTTUMWA", "WAPELLO", "RUM", 9, 90),  # before the years
    sale("3/1/2013", "DUBUQUE", "IOWA", "RUM", 4, 8),  # pair rule: county Dubuque
    sale("3/1/2013", "X", "O'BRIEN", "", 7, 8),  # no population
    sale("3/1/2013", "", "WAPELLO", "GIN", 100, 100),  # no city
    sale("3/1/2013", "X", "EL PASO", "GIN", 100, 100),  # excluded
]
POPULATION = [
    "FIPS,County,Year,Population,Primary Point",
    "19179,Wapello County,July 01 2012,10,POINT (1 2)",
    "19179,Wapello County,July 01 2013,,POINT (1 2)",
    "19061,Dubuque County,July 01 2012,4,",
]


def refreshes(root):
    return sorted(p.name for p in root.iterdir() if p.is_dir())


def run(spark, tmp_path, name, **options):
    for file, lines in (("sales.csv", [SALES_HEADER, *SALES]), ("people.csv", POPULATION)):
        (tmp_path / file).write_text("\n".join(lines) + "\n")
    return full_refresh(
        spark, str(tmp_path / "sales.csv"), str(tmp_path / "people.csv"), str(tmp_path / name), **options
    )


def test_refresh(spark, tmp_path):
    paths = run(spark, tmp_path, "warehouse")
    assert tuple(paths) == TABLES
    tables = {name: read_parquet(spark, path) for name, path in paths.items()}
    assert sorted_rows(tables["dm_total_county_sale"]) == [
        ("Dubuque", 4.0, 19061, 4.0, 8.0, 1.0, "Rum"),
        ("Wapello", 5.0, 19179, 3.0, 15.0, 0.3, "Rum"),
    ]
    assert sorted_rows(tables["dm_total_year_sale"]) == [(2012, 2.0), (2013, 11.0), (2021, 1.0)]
    assert sorted_rows(tables["dm_total_category_sale"]) == [("", 7.0), ("Gin", 2.0), ("Rum", 5.0)]
    fact = tables["fact_sales"]
    assert fact.columns == [*schemas.SALES.names, "sale_month"]
    assert sorted({(r.city, r.county, r.store_name) for r in fact.collect()}) == [
        ("Dubuque", "Dubuque", "Hy-Vee food"),
        ("Ottumwa", "Wapello", "Hy-Vee food"),
        ("X", "O'Brien", "Hy-Vee food"),
    ]
    assert tables["landed_sales"].count() == len(SALES)
    assert tables["dim_county_population"].count() == 3


def test_refresh_again_keeps_the_last_run_and_switches_names(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS refreshed")
    first = run(spark, tmp_path, "warehouse", database="refreshed")
    second = run(spark, tmp_path, "warehouse", begin=2013, end=2013, database="refreshed")
    assert set(first.values()).isdisjoint(second.values())
    assert spark.table("refreshed.dm_total_year_sale").count() == 1
    assert read_parquet(spark, first["dm_total_year_sale"]).count() == 3
    spark.sql("DROP DATABASE refreshed CASCADE")


def test_a_missing_database_is_noticed_before_any_work(spark, tmp_path):
    with pytest.raises(ValueError, match="nowhere"):
        run(spark, tmp_path, "warehouse", database="nowhere")
    assert not (tmp_path / "warehouse").exists()


def test_old_refreshes_go_on_request(spark, tmp_path):
    first = run(spark, tmp_path, "warehouse")
    second = run(spark, tmp_path, "warehouse")
    with open_ledger(spark, tmp_path / "warehouse", "a neighbour's") as running:
        last = run(spark, tmp_path, "warehouse", keep_refreshes=2)
        folders = {str(Path(paths["fact_sales"]).parent) for paths in (second, last)}
        assert {str(tmp_path / "warehouse" / name) for name in refreshes(tmp_path / "warehouse")} == {*folders, running.folder}
    assert not Path(first["fact_sales"]).exists()
    assert read_parquet(spark, last["dm_total_year_sale"]).count() == 3
    with pytest.raises(ValueError):
        run(spark, tmp_path, "warehouse", keep_refreshes=0)


# Leases, marks, recovery


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a folder" / "file")
    assert read_text(spark, path) is None and names(spark, str(tmp_path / "a folder")) == []
    assert create_text(spark, path, "first é") and not create_text(spark, path, "second")
    assert read_text(spark, path) == "first é"
    for text in ("x" * 100_000, ""):
        replace_text(spark, path, text)
        assert read_text(spark, path) == text
    assert names(spark, str(tmp_path / "a folder")) == [".file.crc", "file"] or names(
        spark, str(tmp_path / "a folder")
    ) == ["file"]
    (tmp_path / "a folder" / "_hidden").write_text("x")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c.csv").write_text("xy")
    found = listed(spark, [str(tmp_path / "*"), str(tmp_path / "nothing")])
    assert [(Path(p).name, n) for p, n, _ in found] == [("file", 0), ("c.csv", 2)]


def open_ledger(spark, root, request="same", seconds=600.0):
    return Ledger.open(spark, str(root), request, seconds)


def test_a_folder_is_taken_over_only_when_its_lease_ran_out(spark, tmp_path):
    first = open_ledger(spark, tmp_path, seconds=1.5)
    with first:
        first.done("a")
        time.sleep(2.5)  # renewed meanwhile
        other = open_ledger(spark, tmp_path)
        assert other.folder != first.folder and not other.is_done("a")
    third = open_ledger(spark, tmp_path)  # given back
    assert third.folder == first.folder and third.is_done("a") and not third.is_done("b")
    with pytest.raises(LostLease):
        first.done("b")
    assert open_ledger(spark, tmp_path, "another").folder not in (first.folder, other.folder)
    third.finish()
    with third:
        pass
    assert open_ledger(spark, tmp_path).folder not in (first.folder, other.folder)


def test_one_of_two_takes_a_folder_over(spark, tmp_path):
    with open_ledger(spark, tmp_path) as left:
        pass
    assert create_text(spark, f"{left.folder}/_lease-2", json.dumps({"until": time.time() + 60}))
    assert open_ledger(spark, tmp_path).folder != left.folder
    # A lease that is created but not written yet counts.
    assert create_text(spark, f"{left.folder}/_lease-3", "")
    assert open_ledger(spark, tmp_path).folder != left.folder


def test_a_running_neighbour_is_neither_counted_nor_deleted(spark, tmp_path):
    root = str(tmp_path)
    finished = []
    for request in "abc":
        with open_ledger(spark, root, request) as ledger_:
            write_parquet(spark.range(3), f"{ledger_.folder}/landed_sales")
            ledger_.finish()
            finished.append(ledger_.folder)
    running, dead = open_ledger(spark, root, "running"), open_ledger(spark, root, "dead")
    with dead:
        write_parquet(spark.range(3), f"{dead.folder}/landed_sales")
    (tmp_path / "refresh-foreign").mkdir()
    with running:
        write_parquet(spark.range(3), f"{running.folder}/landed_sales")
        # What readers are shown stays, however many came later.
        gone = retire(spark, root, 1, {finished[0]})
        assert {f"{root}/{name}" for name in gone} == {finished[1], dead.folder}
        left = {f"{root}/{name}" for name in refreshes(tmp_path)}
        assert left == {finished[0], finished[2], running.folder, f"{root}/refresh-foreign"}
        running.done("landed_sales")
    assert retire(spark, root, 2, set()) == [Path(running.folder).name]


class Killed(Exception):
    pass


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    paths = run(spark, tmp_path_factory.mktemp("clean"), "warehouse")
    return {name: sorted_rows(read_parquet(spark, path)) for name, path in paths.items()}


@pytest.mark.parametrize("dies_at", ["write_by_month", "summarise", "category_mart", "publish_views"])
def test_a_refresh_that_died_is_continued(spark, tmp_path, monkeypatch, expected, dies_at):
    spark.sql("CREATE DATABASE IF NOT EXISTS continued")
    landed = []
    land = refresh.land_sales

    def count_and_land(*args):
        landed.append(args)
        return land(*args)

    def die(*_, **__):
        raise Killed

    monkeypatch.setattr(refresh, "land_sales", count_and_land)
    with monkeypatch.context() as killing:
        killing.setattr(refresh, dies_at, die)
        with pytest.raises(Killed):
            run(spark, tmp_path, "warehouse", database="continued")
    assert len(refreshes(tmp_path / "warehouse")) == 1
    half = tmp_path / "warehouse" / refreshes(tmp_path / "warehouse")[0]
    finished = {p.name: p.stat().st_mtime_ns for p in half.glob("*/part-*")}
    paths = refresh.full_refresh(
        spark, str(tmp_path / "sales.csv"), str(tmp_path / "people.csv"), str(tmp_path / "warehouse"), database="continued"
    )
    assert len(landed) == 1 and refreshes(tmp_path / "warehouse") == [half.name]
    again = {p.name: p.stat().st_mtime_ns for p in half.glob("*/part-*")}
    assert finished.items() <= again.items()
    for name in TABLES:
        assert sorted_rows(read_parquet(spark, paths[name])) == expected[name]
        assert sorted_rows(spark.table(f"continued.{name}")) == expected[name]
    spark.sql("DROP DATABASE continued CASCADE")


def test_requests_tell_inputs_and_arguments_apart(spark, tmp_path):
    sales, people = tmp_path / "sales", tmp_path / "people.csv"
    sales.mkdir()
    (sales / "a.csv").write_text("x")
    people.write_text("y")

    def request(**changed):
        options = {
            "sales_csv": str(sales), "population_csv": [str(people)], "begin": 2012, "end": 2013,
            "rules": [{"A": "B"}, {}, {("A", "B"): "C"}], "excluded_county": "X", "rows_per_file": 10,
        }
        return refresh._request(spark, **(options | changed))

    first = request()
    assert first == request(population_csv=str(people), rules=[{"A": "B"}, {}, {("A", "B"): "C"}])
    others = [request(end=2014), request(rules=[{}, {"A": "B"}, {}]), request(excluded_county="Y"), request(rows_per_file=9)]
    (sales / "b.csv").write_text("")
    others.append(request())
    (sales / "b.csv").unlink()
    assert request() == first
    (sales / "a.csv").write_text("longer")
    others.append(request())
    assert len({first, *others}) == 7


def test_rule_tables_tell_requests_apart(spark):
    rules = [("A", "B"), ("C", "D"), ("E", None)]
    frame = spark.createDataFrame(rules, "a string, b string")
    one = refresh._rule_print(frame)
    assert one == refresh._rule_print(frame.repartition(3)) != refresh._rule_print(frame.limit(2))
    assert refresh._rule_print({"A": "B", "C": "D"}) == refresh._rule_print({"C": "D", "A": "B"})
    assert refresh._rule_print({("A", "B"): "C"}) != refresh._rule_print({("A", "C"): "B"})


# Publication


def state(spark, database):
    counts = " UNION ALL ".join(f"SELECT '{name}', count(*) FROM {database}.{name}" for name in TABLES)
    return dict(map(tuple, spark.sql(counts).collect()))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Seven tables of n rows for each of some n."""
    folder = tmp_path_factory.mktemp("it's")
    made = {}
    for n in (2, 3, 4, 5):
        made[n] = {name: str(folder / f"{n}" / name) for name in TABLES}
        for path in made[n].values():
            write_parquet(spark.range(n).coalesce(1).withColumnRenamed("id", "it's `id`"), path)
    return made


@pytest.mark.parametrize("steps", range(1, 9))
def test_readers_see_all_old_or_all_new_tables(spark, tables, monkeypatch, steps):
    """Die after any number of catalog changes, then publish again."""
    from martwright import sinks

    database = f"switched_{steps}"
    spark.sql(f"CREATE DATABASE {database}")
    old, new = tables[2], tables[5]
    publish_views(spark, database, old)
    assert state(spark, database) == dict.fromkeys(TABLES, 2)
    left = [steps]
    show, point = sinks._show, sinks._point

    def counted(change):
        def run_one(*args):
            if not left[0]:
                raise Killed
            left[0] -= 1
            change(*args)

        return run_one

    with monkeypatch.context() as killing:
        killing.setattr(sinks, "_show", counted(show))
        killing.setattr(sinks, "_point", counted(point))
        if steps < 8:
            with pytest.raises(Killed):
                publish_views(spark, database, new)
        else:
            publish_views(spark, database, new)
    assert state(spark, database) == dict.fromkeys(TABLES, 5 if steps == 8 else 2)
    publish_views(spark, database, new)
    assert state(spark, database) == dict.fromkeys(TABLES, 5)
    settle_views(spark, database)
    assert state(spark, database) == dict.fromkeys(TABLES, 5)
    assert published(spark, database)["paths"] == new
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_published_name_scans_one_set_of_files(spark, tmp_path, tables):
    spark.sql("CREATE DATABASE scanned")
    publish_views(spark, "scanned", tables[2])
    publish_views(spark, "scanned", tables[4])
    plan = plan_text(spark.table("scanned.fact_sales").filter("`it's ``id``` > 1"))
    assert plan.count("Scan parquet") == 1 and "Subquery" not in plan and "Union" not in plan
    assert "PushedFilters: [IsNotNull(`it's ``id```), GreaterThan" in plan
    settle_views(spark, "scanned")
    refused = {**tables[3], "fact_sales": str(tmp_path / "other")}
    write_parquet(spark.range(3), refused["fact_sales"])
    with pytest.raises(ValueError, match="fact_sales"):
        publish_views(spark, "scanned", refused)
    assert state(spark, "scanned") == dict.fromkeys(TABLES, 4)
    # A set without a name leaves that name as it is.
    publish_views(spark, "scanned", {name: path for name, path in tables[3].items() if name != "landed_sales"})
    assert state(spark, "scanned") == {**dict.fromkeys(TABLES, 3), "landed_sales": 4}
    spark.sql("DROP DATABASE scanned CASCADE")


def test_the_current_tables_change_in_one_step(spark, tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        current_tables(spark, str(tmp_path / "warehouse"))
    first = run(spark, tmp_path, "warehouse")
    assert current_tables(spark, str(tmp_path / "warehouse")) == first
    with monkeypatch.context() as killing:
        killing.setattr(refresh, "category_mart", lambda *_: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            run(spark, tmp_path, "warehouse", end=2013)
    assert current_tables(spark, str(tmp_path / "warehouse/")) == first
    second = run(spark, tmp_path, "warehouse", end=2013)
    assert current_tables(spark, str(tmp_path / "warehouse")) == second
    assert ledger.CURRENT in names(spark, str(tmp_path / "warehouse"))
