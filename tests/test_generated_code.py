"""HotSpot does not compile methods above 8000 bytes of bytecode, and Spark's generated code
can pass that unnoticed. The two row-wise jobs over the whole fact table must stay below."""

import re

from martwright import schemas
from martwright.plans import cleanse_sales, land_sales


def largest_method(spark, df):
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    package = getattr(getattr(debug, "package$"), "MODULE$")
    code = package.codegenString(df._jdf.queryExecution().executedPlan())
    return max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code))


def test_cleansing(spark, conf, tmp_path):
    conf("spark.sql.adaptive.enabled", "false")  # shows the code of the whole plan at once
    spark.createDataFrame([], schemas.SALES).write.parquet(str(tmp_path / "t"))
    assert largest_method(spark, cleanse_sales(spark.read.parquet(str(tmp_path / "t")))) < 8000


def test_landing(spark, tmp_path):
    (tmp_path / "t.csv").write_text(",".join(schemas.SALES.names) + "\n")
    assert largest_method(spark, land_sales(spark, str(tmp_path / "t.csv"))) < 8000
