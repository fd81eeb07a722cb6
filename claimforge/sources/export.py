"""Single-file CSV exports in a total order, made by tasks: sorted parts, joined by the file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def rendered(df: DataFrame, name: str, integers: str | None = None) -> Column:
    """The text of a column: True and False, nothing for null, decimals with their places, times with their offset.

    Where the array column ``integers`` names the column, its value is a zero that stands for "no rows", written ``0``.
    """
    x, kind = F.col(f"`{name}`"), df.schema[name].dataType.typeName()
    if kind == "boolean":
        text = F.initcap(x.cast("string"))
    elif kind == "array":
        text = F.to_json(x)
    elif kind == "timestamp":
        micros = F.pmod(F.unix_micros(x), F.lit(1_000_000))
        text = F.concat(F.date_format(x, "yyyy-MM-dd HH:mm:ss"), F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.date_format(x, "xxx"))
    else:
        text = x.cast("string")
    if integers:
        text = F.when(F.array_contains(integers, name), "0").otherwise(text)
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike('[",\r\n]'), quoted).otherwise(text), F.lit(""))


def observed(seen: Observation, written: DataFrame) -> dict[str, int]:
    """What was counted while ``written`` was written; nothing if Spark knew that it has no rows and left the counting out."""
    try:
        return seen.get
    except Py4JJavaError:
        if written.isEmpty():
            return {}
        raise


def export_csv(df: DataFrame, path: str, order: list[str | Column], integers: str | None = None) -> int:
    """Write one CSV file sorted by ``order``, nulls last; the number of rows.

    Tasks sort ranges of the rows and write them as text; the file system then joins the parts in their order, without
    reading them where it can (``concat``), else by copying streams. No row passes through Python. The file appears
    under its name when it is whole.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != integers]
    line = F.concat_ws(",", *(rendered(df, c, integers) for c in columns))
    seen = Observation()
    ordered = df.orderBy(*(F.asc_nulls_last(x) if isinstance(x, str) else x for x in order))
    rows = ordered.observe(seen, F.count(F.lit(1)).alias("rows")).select(line.alias("line"))  # counted after the sort, which reads its input twice
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)
    work = f"{path}-{uuid.uuid4().hex}"
    try:
        rows.write.option("lineSep", "\n").text(work)
        parts = sorted(x.getPath().toString() for x in fs.listStatus(at(work)) if x.getPath().getName().startswith("part-"))
        whole = at(f"{work}/whole")
        out = fs.create(whole, True)
        out.write(bytearray((",".join(columns) + "\n").encode()))
        out.close()
        count = observed(seen, spark.read.text(work)).get("rows", 0)
        join(spark, fs, whole, [at(p) for p in parts])
        fs.delete(at(path), False)
        if not fs.rename(whole, at(path)):
            raise OSError(f"{path} could not be written")
    finally:
        fs.delete(at(work), True)
    return count


def join(spark, fs, whole, parts: list) -> None:
    """Append ``parts`` to the file ``whole``."""
    if not parts:
        return
    try:
        array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, p in enumerate(parts):
            array[i] = p
        fs.concat(whole, array)
        return
    except UnsupportedOperationException:
        pass  # a file system without concat
    merged = spark._jvm.org.apache.hadoop.fs.Path(f"{whole.toString()}-joined")
    out = fs.create(merged, True)
    try:
        for p in [whole, *parts]:
            stream = fs.open(p)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
    finally:
        out.close()
    fs.delete(whole, False)
    fs.rename(merged, whole)
