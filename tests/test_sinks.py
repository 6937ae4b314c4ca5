import datetime
import time
import uuid
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martwright.operators import within_years
from martwright.sinks import _dealt, publish_view, save_table, write_by_month, write_parquet
from martwright.sources import read_parquet, read_table
from martwright.storage import discard, folders, scratch_path

from .conftest import plan_text


def facts(spark, n=20_000):
    """Two years of days; January 2012 holds a third of all rows."""
    i = F.col("id")
    offset = F.when(i % 3 == 0, i % 31).otherwise(i % 731)
    day = F.date_add(F.lit(datetime.date(2012, 1, 1)), offset.cast("int"))
    return spark.range(n).select(
        "id",
        day.cast("timestamp_ntz").alias("sale_date"),
        F.concat(F.lit("county "), i * 7 % 99).alias("county"),
        F.concat(F.lit("city "), i * 13 % 501).alias("city"),
        F.concat(F.lit("kind "), i * 17 % 40).alias("category_name"),
    )


def files(path, month):
    return sorted(Path(path, f"sale_month={month}").glob("*.parquet"))


def test_by_month_layout(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = facts(spark)
    write_by_month(df, path, last_keys=["id"], rows_per_file=1000)
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    assert back.filter(F.col("sale_month") != F.trunc("sale_date", "MM")).count() == 0
    assert back.drop("sale_month").exceptAll(df).count() == 0
    assert len(list(Path(path).glob("sale_month=*"))) == 24
    for file in Path(path).rglob("*.parquet"):
        table = pq.ParquetFile(file).read(["county", "city", "category_name"]).to_pylist()
        keys = [tuple(row.values()) for row in table]
        assert keys == sorted(keys)


def test_small_months_stay_whole_and_a_hot_month_is_split(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_by_month(facts(spark, 60_000).repartition(32), path, last_keys=["id"], rows_per_file=5000)
    assert len(files(path, "2012-01-01")) >= 3
    others = [len(files(path, f"2013-{month:02d}-01")) for month in range(1, 13)]
    assert max(others) <= 2 and others.count(1) >= 6
    assert spark.read.parquet(path).count() == 60_000


def counties_by_file(path, month):
    return [
        pq.ParquetFile(file).read(["county"]).column("county").to_pylist()
        for file in files(path, month)
    ]


def one_month(spark, county, n=64_000):
    day = F.date_add(F.lit(datetime.date(2012, 1, 1)), (F.col("id") % 31).cast("int"))
    return spark.range(n).select(
        "id",
        day.cast("timestamp_ntz").alias("sale_date"),
        county.alias("county"),
        F.concat(F.lit("city "), F.col("id") * 13 % 501).alias("city"),
        F.concat(F.lit("kind "), F.col("id") * 17 % 40).alias("category_name"),
    )


def test_a_county_lies_in_few_files_of_its_month(spark, tmp_path):
    path = str(tmp_path / "fact")
    county = F.format_string("county %03d", F.col("id") * 7 % 100)
    write_by_month(
        one_month(spark, county).repartition(16), path, last_keys=["id"], rows_per_file=3200
    )
    held = counties_by_file(path, "2012-01-01")
    assert len(held) >= 16
    for name in (f"county {i:03d}" for i in range(100)):
        assert sum(name in counties for counties in held) <= 2


def test_a_hot_county_is_several_files_of_similar_size(spark, tmp_path):
    path = str(tmp_path / "fact")
    county = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 70))
    write_by_month(one_month(spark, county), path, last_keys=["id"], rows_per_file=4000)
    sizes = [len(counties) for counties in counties_by_file(path, "2012-01-01") if "hot" in counties]
    assert len(sizes) >= 12
    assert max(sizes) <= 2 * (sum(sizes) / len(sizes))


def writers(path):
    """Tasks that wrote files, by the names the files have."""
    return {file.name.split("-")[1] for file in Path(path).rglob("part-*.parquet")}


def test_tasks_do_not_depend_on_the_size_of_files(spark, tmp_path):
    df = facts(spark, 60_000).repartition(4)
    path = str(tmp_path / "small")
    write_by_month(df, path, last_keys=["id"])
    # One month holds a third of the rows and is one file; the others have the rest of the cores.
    assert len(writers(path)) >= 6
    assert all(len(files(path, folder.name.removeprefix("sale_month="))) == 1 for folder in Path(path).glob("sale_month=*"))
    sizes = {}
    for tasks in (1, 5, 24, 1000):
        path = str(tmp_path / f"{tasks}")
        write_by_month(df, path, last_keys=["id"], rows_per_file=2500, tasks=tasks)
        cut = len(files(path, "2012-01-01"))
        assert 8 <= cut <= 9 and cut < len(writers(path)) <= cut + max(tasks, 4) + 1
        sizes[tasks] = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).rglob("part-*.parquet")]
        assert sum(sizes[tasks]) == 60_000 and max(sizes[tasks]) <= 2501
    assert len(writers(str(tmp_path / "1000"))) == 23 + cut
    assert {len(s) for s in sizes.values()} == {23 + cut}


def test_months_are_cut_by_a_sample_of_their_keys(spark, tmp_path, monkeypatch):
    from martwright import sinks

    monkeypatch.setattr(sinks, "SKETCH_KEYS", 4000)
    path = str(tmp_path / "fact")
    odd = F.when(F.col("id") % 50 != 0, F.format_string("county %03d", F.col("id") * 7 % 100))
    df = one_month(spark, odd).withColumn("sale_date", F.when(F.col("id") % 2 == 0, F.col("sale_date")))
    write_by_month(df.repartition(16), path, last_keys=["id"], rows_per_file=3200)
    back = spark.read.parquet(path)
    assert back.drop("sale_month").exceptAll(df).count() == 0 and back.count() == 64_000
    for month in ("2012-01-01", "__HIVE_DEFAULT_PARTITION__"):
        held = counties_by_file(path, month)
        assert len(held) == 10 and all(2000 <= len(h) <= 4400 for h in held)
        for name in {c for counties in held for c in counties}:
            assert sum(name in counties for counties in held) <= 3


def test_equal_keys_stay_together_and_an_empty_table_is_written(spark, tmp_path):
    df = one_month(spark, F.lit("c"), 5000).select("sale_date", "county", F.lit("x").alias("id"))
    path = str(tmp_path / "equal")
    write_by_month(df, path, cluster_columns=["county"], last_keys=["id"], rows_per_file=1000)
    assert len(writers(path)) == 1 and spark.read.parquet(path).count() == 5000
    write_by_month(df, path, cluster_columns=[], last_keys=[], rows_per_file=1000)
    assert spark.read.parquet(path).count() == 5000
    write_by_month(df.limit(0), path, cluster_columns=["county"], last_keys=["id"])
    assert not list(Path(path).rglob("part-*.parquet")) or spark.read.parquet(path).count() == 0


def test_the_layout_reads_keys_only(spark, tmp_path, monkeypatch):
    """Neither pass before the writing one computes another column."""
    from martwright import sinks

    df = one_month(spark, F.lit("c"), 6000).withColumn(
        "costly", F.when(F.col("id") >= 0, F.raise_error(F.lit("computed"))).cast("string")
    )
    layout = df.withColumn("sale_month", F.trunc("sale_date", "MM"))
    pieces = sinks._pieces(layout, "sale_month", ["county", "id"], 1000)
    assert [len(sizes) for _, _, sizes in pieces] == [6]


def test_missing_dates_are_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, datetime.datetime(2012, 1, 5))], "id int, sale_date timestamp_ntz")
    path = str(tmp_path / "fact")
    write_by_month(df, path, cluster_columns=[], last_keys=["id"])
    assert spark.read.parquet(path).count() == 2
    assert [r.id for r in within_years(spark.read.parquet(path), 2012, 2012, "sale_date", "sale_month").collect()] == [2]


def test_years_prune_folders(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_by_month(facts(spark), path, last_keys=["id"])
    kept = within_years(spark.read.parquet(path), 2013, 2013, "sale_date", "sale_month")
    assert "PartitionFilters: [isnotnull(sale_month" in plan_text(kept)
    read = {Path(f).parent.name[:15] for f in kept.select("id", F.input_file_name()).toPandas().iloc[:, 1]}
    assert read == {"sale_month=2013"}


def test_save_table_replaces(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    save_table(spark.range(5), name, str(tmp_path / "t"))
    save_table(spark.range(3).withColumnRenamed("id", "other"), name, str(tmp_path / "t"))
    table = read_table(spark, name)
    assert (table.columns, table.count()) == (["other"], 3)
    with pytest.raises(Exception):
        save_table(read_table(spark, name).filter("other > 0"), name, str(tmp_path / "t"))
    assert read_table(spark, name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_publish_view_switches(spark, tmp_path):
    name = f"v_{uuid.uuid4().hex}"
    for n in (5, 3):
        write_parquet(spark.range(n), str(tmp_path / f"run {n}"))
        publish_view(spark, f"default.{name}", str(tmp_path / f"run {n}"))
        assert read_table(spark, name).count() == n
    spark.sql(f"DROP VIEW {name}")


def test_declared_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(3).withColumn("x", F.lit("a")), path)
    schema = spark.createDataFrame([], "id long, missing string").schema
    assert read_parquet(spark, path, schema).columns == ["id", "missing"]
    assert read_parquet(spark, [path, path]).count() == 6


def test_scratch_paths(spark, conf):
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert first.startswith(base.rstrip("/") + "/")


def test_scratch_needs_a_shared_folder():
    class Conf:
        def __init__(self, **options):
            self.options = options

        def get(self, name, default=None):
            return self.options.get(name.replace(".", "_"), default)

    class Session:
        def __init__(self, **options):
            self.conf = Conf(**options)

    for master in ("yarn", "local[2]"):
        with pytest.raises(ValueError):
            scratch_path(Session(spark_master=master), "a")
    shared = Session(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/dir/")
    assert scratch_path(shared, "a").startswith("hdfs://shared/dir/martwright/a-")


def test_folders_and_discard(spark, tmp_path):
    root = str(tmp_path / "root")
    assert folders(spark, root) == []
    for name in ("a", "b"):
        write_parquet(spark.range(1), f"{root}/{name}")
    assert sorted(folders(spark, root)) == ["a", "b"]
    discard(spark, f"{root}/a")
    assert folders(spark, root) == ["b"]


def test_months_that_share_a_task_fit_its_memory():
    # Seven years of 430,000 rows a month: with four full files a task, 12 tasks sorted 3 million rows each.
    pieces = [(month, [], [430_000.0]) for month in range(84)]
    dealt, count = _dealt(pieces, 1_000_000, 12)
    of_task = Counter(own[0] for _, _, own in dealt)
    assert sorted(of_task) == list(range(count))
    assert 430_000 * max(of_task.values()) <= 1_500_000


def shuffle_files(spark):
    """Data of shuffles on this machine's disk, by file."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = [file for folder in disk.localDirsString() for file in Path(folder).rglob("shuffle_*.data")]
    return {file: file.stat().st_size for file in found}


def test_rows_travel_to_their_months_in_packs(spark):
    """A third of what the rows would take one by one, at most."""
    from martwright.sinks import _gathered

    i = F.col("id")
    wide = spark.range(0, 200_000, 1, 4).select(
        (i % 24).cast("int").alias("target"),
        *(F.concat(F.lit(f"text {k} "), F.pmod(F.hash(i, F.lit(k)), F.lit(500))).alias(f"t{k}") for k in range(10)),
        *(F.pmod(F.hash(i, F.lit(k)), F.lit(90)).cast("double").alias(f"d{k}") for k in range(10)),
    )
    sizes = []
    for df in (wide.repartitionById(24, F.col("target")), _gathered(wide, "target", 24)):
        before = set(shuffle_files(spark))
        df.write.format("noop").mode("overwrite").save()
        sizes.append(sum(size for file, size in shuffle_files(spark).items() if file not in before))
    assert 0 < 3 * sizes[1] < sizes[0]


def odd_values(spark):
    columns = {
        "id": "id",
        "sale_date": "timestamp_ntz'0001-01-01' + make_interval(0, id * 500)",
        "yes": "id % 2 = 0",
        "byte": "CAST(id - 60 AS tinyint)",
        "short": "CAST(-id AS smallint)",
        "long": "id * 9000000000000000",
        "float": "CAST(id / 7 AS float)",
        "double": "CASE id % 5 WHEN 0 THEN -0.0D WHEN 1 THEN 0.0D WHEN 2 THEN double('NaN') WHEN 3 THEN double('-Infinity') ELSE id / 3 END",
        "text": "CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('\u00e9\n\"', repeat('x', int(id))) WHEN 2 THEN '\U0001f600' END",
        "bytes": "encode(CASE WHEN id % 3 > 0 THEN concat('b', id) END, 'UTF-16')",
        "day": "date'1500-03-01' + int(id * 1000)",
        "at": "timestamp'1890-01-01 00:00:00.000001' + make_dt_interval(int(id) * 400)",
        "amount": "CAST(id / 100 AS decimal(20, 3))",
        "odd `name.": "IF(id = 7, NULL, 'n')",
    }
    df = spark.range(120).selectExpr(*(f"{rule} AS `{name.replace('`', '``')}`" for name, rule in columns.items()))
    # Whole rows without a value, too.
    return df.unionByName(spark.range(2).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema)))


def as_text(df):
    """Rows as text, which keeps the sign of zero."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return sorted(plain.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toPandas().iloc[:, 0])


@pytest.mark.parametrize("packed_bytes", [1, 5000, 64_000_000])
def test_packs_return_every_value(spark, tmp_path, monkeypatch, conf, packed_bytes):
    from martwright import sinks

    monkeypatch.setattr(sinks, "PACKED_BYTES", packed_bytes)
    conf("spark.sql.session.timeZone", "America/Los_Angeles")
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    df = odd_values(spark)
    placed = df.withColumn("target", F.coalesce(F.col("id") % 3, F.lit(0)).cast("int"))
    gathered = sinks._gathered(placed, "target", 3)
    assert "MapInArrow" in plan_text(gathered)
    assert gathered.schema == df.schema and as_text(gathered) == as_text(df)
    at = gathered.withColumn("partition", F.spark_partition_id()).filter("id IS NOT NULL AND id % 3 != partition")
    assert at.count() == 0
    path = str(tmp_path / "fact")
    write_by_month(df, path, cluster_columns=["text"], last_keys=["id"])
    assert as_text(spark.read.parquet(path).drop("sale_month")) == as_text(df)


def test_other_columns_travel_row_by_row(spark, tmp_path):
    df = one_month(spark, F.lit("c"), 500).withColumns(
        {"pairs": F.create_map("county", "id"), "span": F.expr("make_dt_interval(int(id))"), "list": F.array("id", F.lit(None))}
    )
    path = str(tmp_path / "fact")
    write_by_month(df, path, last_keys=["id"], rows_per_file=100)
    assert as_text(spark.read.parquet(path).select(*df.columns)) == as_text(df)
    assert len(files(path, "2012-01-01")) == 5


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    from martwright import sinks
    from martwright.workload import star

    def left(write):
        before = set(shuffle_files(spark))
        write()
        for _ in range(50):
            new = set(shuffle_files(spark)) - before
            if not new:
                break
            time.sleep(0.2)
        return new

    df = one_month(spark, F.lit("c"), 5000)
    sums = df.groupBy("city").count()
    path = str(tmp_path / "t")
    # Kept, so that nothing goes because the driver forgot it.
    assert left(lambda: sums.write.parquet(path))
    assert not left(lambda: write_parquet(sums, path))
    assert not left(lambda: star.write_csv(sums, f"{path}-csv"))
    assert not left(lambda: write_by_month(df, f"{path}-month", last_keys=["id"], rows_per_file=1000))
    setting = spark.conf.get(sinks.SHUFFLE_CLEANUP, None)
    with pytest.raises(ZeroDivisionError), sinks.without_leftovers(spark):
        1 / 0
    assert spark.conf.get(sinks.SHUFFLE_CLEANUP, None) == setting
    assert spark.read.parquet(path).count() == sums.count() == 501
