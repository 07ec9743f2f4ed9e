"""Surrogate keys: dense, ordered, independent of partitioning, stable."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators.keys import dense_keys, stable_keys
from salesmart.operators.staging import stage
from salesmart.plans import dims
from tests import edge


def numbered(df, sk, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy(sk).collect()]


def test_keys_are_dense_and_in_order_whatever_the_input_layout(spark):
    ids = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("id"))
    expected = sorted(r.id for r in ids.collect())
    for partitions in (1, 3, 16):
        shuffled = ids.repartition(partitions).orderBy(F.rand(partitions))
        keyed = dense_keys(shuffled, "sk", ["id"])
        assert keyed.columns == ["sk", "id"]
        assert numbered(keyed, "sk", "sk", "id") == list(
            zip(range(1, 5001), expected))


def test_text_and_composite_keys(spark):
    frame = spark.createDataFrame(
        [("b", 2), ("a", None), ("b", 1), ("a", 1), (None, 9)], "t string, n int")
    assert numbered(dense_keys(frame, "sk", ["t", "n"]), "sk", "sk", "t", "n") == [
        (1, None, 9), (2, "a", None), (3, "a", 1), (4, "b", 1), (5, "b", 2)]


def test_empty_input(spark):
    empty = spark.range(0).toDF("id")
    assert dense_keys(empty, "sk", ["id"]).count() == 0
    existing = dense_keys(empty, "sk", ["id"])
    again = stable_keys(spark.range(3).toDF("id"), "sk", ["id"], existing)
    assert numbered(again, "sk", "sk", "id") == [(1, 0), (2, 1), (3, 2)]


def test_rows_of_one_hot_leading_key_are_sorted_by_several_tasks(spark):
    rows = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("person"),
        (F.col("id") * 31 % 30011).alias("code"))
    wide = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, setting in wide.items():
        spark.conf.set(key, setting)
    try:
        placed = stage(
            rows.orderBy("person", "code").withColumn("part", F.spark_partition_id()), "hot")
        keyed = dense_keys(rows, "sk", ["person", "code"])
        tasks = placed.where("person = 7").select("part").distinct().count()
        assert tasks > 1
        got = numbered(keyed, "sk", "sk", "person", "code")
    finally:
        for key in wide:
            spark.conf.unset(key)
    ordered = sorted((r.person, r.code) for r in rows.collect())
    assert got == [(i, *r) for i, r in enumerate(ordered, 1)]


def test_known_rows_keep_their_key_and_new_ones_follow(spark):
    before = dense_keys(spark.createDataFrame([(10,), (30,)], "id long"), "sk", ["id"])
    now = spark.createDataFrame([(5,), (10,), (20,), (30,)], "id long")
    assert numbered(stable_keys(now, "sk", ["id"], before), "id", "id", "sk") == [
        (5, 3), (10, 1), (20, 4), (30, 2)]


def test_changed_attributes_are_taken_from_the_new_rows(spark, edge_source):
    before = dims.dim_cliente(edge_source)
    people = [(i, "Anna" if i == 1 else n, d) for i, n, d in edge.ROWS["geral.pessoa_fisica"]]
    after = dims.dim_cliente(edge.source(spark, pessoa_fisica=people), before)
    assert numbered(after, "sk_cliente", "sk_cliente", "nome")[0] == (1, "Anna")


def test_addresses_without_a_district_keep_their_key(spark, edge_source):
    before = dims.dim_localidade(edge_source)
    addresses = [(9, 1, 3, "10000"), *edge.ROWS["geral.endereco"]]
    after = dims.dim_localidade(edge.source(spark, endereco=addresses), before)
    assert numbered(after, "sk_localidade", "sk_localidade", "id_pessoa", "cep") == [
        (1, 1, "11000"), (2, 2, "12000"), (3, 2, "24000"), (4, 3, "00000"),
        (5, 5, "28000"), (6, 1, "10000")]
