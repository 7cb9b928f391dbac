"""Named tables: switches, failed writes, buckets, other sessions."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators import dialogues
from cohortloom.sources.catalog import CatalogTable, ConcurrentWriteError, table_in
from cohortloom.sources.tables import DuplicateKeyError
from cohortloom.sources.workspace import new_folder

PAIR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def pairs(spark, **values):
    return spark.createDataFrame(list(values.items()), PAIR)


def content(df):
    rows = df.collect()
    found = {r["k"]: r["v"] for r in rows}
    assert len(found) == len(rows)
    return found


def table(spark, key="k"):
    return table_in(spark, new_folder(spark, "t"), PAIR, key, buckets=4)


def failing(spark):
    return spark.range(100, numPartitions=4).select(
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("int")).otherwise(1).alias("v"))


@pytest.mark.parametrize("key", [None, "k"])
def test_replace_is_one_switch_for_all_sessions(spark, key):
    t, other = table(spark, key), spark.newSession()
    assert t.read().isEmpty() and not t.exists()
    t.replace(pairs(spark, a=1, b=2))
    held = t.read()
    assert content(other.table(t.name)) == {"a": 1, "b": 2}
    t.replace(pairs(spark, c=3))
    assert content(other.table(t.name)) == content(t.read()) == {"c": 3}
    assert content(held) == {"a": 1, "b": 2}  # a reader keeps its version
    t.replace(t.read().withColumn("v", F.col("v") + 1))  # reads itself
    assert content(t.read()) == {"c": 4}


@pytest.mark.parametrize("write", ["replace", "upsert"])
def test_a_write_that_dies_leaves_the_old_rows(spark, write):
    t = table(spark)
    t.replace(pairs(spark, a=1))
    with pytest.raises(Exception, match="lost"):
        getattr(t, write)(failing(spark))
    assert content(t.read()) == {"a": 1}
    assert content(spark.newSession().table(t.name)) == {"a": 1}


def test_a_first_write_that_dies_leaves_no_table(spark):
    t = table(spark)
    with pytest.raises(Exception, match="lost"):
        t.append(failing(spark))
    assert not t.exists() and t.read().isEmpty()


def test_append(spark):
    t = table(spark)
    t.append(pairs(spark, a=1, b=2))
    version = t.version()
    t.append(pairs(spark, c=3))
    assert t.version() == version and content(t.read()) == {"a": 1, "b": 2, "c": 3}
    with pytest.raises(Exception, match="lost"):
        t.append(failing(spark))
    assert content(t.read()) == {"a": 1, "b": 2, "c": 3}


def test_upsert(spark):
    t = table(spark)
    t.upsert(pairs(spark, a=1, b=2))
    t.upsert(pairs(spark, b=20, c=30))
    assert content(t.read()) == {"a": 1, "b": 20, "c": 30}
    t.upsert(pairs(spark, b=20, c=30))  # again, as after a lost answer
    assert content(t.read()) == {"a": 1, "b": 20, "c": 30}
    with pytest.raises(DuplicateKeyError):
        t.upsert(pairs(spark, z=1).unionByName(pairs(spark, z=2)))
    assert content(t.read()) == {"a": 1, "b": 20, "c": 30}
    with pytest.raises(ValueError, match="no key"):
        table(spark, None).upsert(pairs(spark, a=1))


def test_a_second_writer_is_refused(spark):
    t = table(spark)
    t.replace(pairs(spark, a=1))
    again = CatalogTable(spark, t.name, t.folder, PAIR, "k", 4)

    class Slow(CatalogTable):
        def _write(self, df):
            version = super()._write(df)
            again.replace(pairs(spark, b=2))
            return version

    with pytest.raises(ConcurrentWriteError):
        Slow(spark, t.name, t.folder, PAIR, "k", 4).replace(pairs(spark, c=3))
    assert content(t.read()) == {"b": 2}


def plan_of(df):
    shown = io.StringIO()
    with redirect_stdout(shown):
        df.explain()
    return shown.getvalue()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_upsert_and_key_check_need_no_exchange(spark, no_broadcast):
    t, staged = table(spark), table(spark)
    for each in (t, staged):
        each.replace(pairs(spark, a=1, b=2))
    assert "Exchange" not in plan_of(t.merged(staged.read()))
    assert "Exchange" not in plan_of(staged.read().groupBy("k").count().where("count > 1"))


def test_pending_scan_deals_out_the_cases_only(spark, no_broadcast):
    done = dialogues.new_layer1(spark, new_folder(spark, "capa1"))
    done.append(spark.createDataFrame([], done.schema))
    cases = spark.range(50).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("caso_id"))
    plan = plan_of(dialogues.pending_cases(cases, done.read()))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    branch = plan[plan.index("FileScan parquet"):] if plan.index("Range") < plan.index("FileScan") else plan[:plan.index("Range")]
    assert "Exchange" not in branch.split("+- Exchange")[0] or "Bucketed: true" in plan
    assert "Bucketed: true" in plan
