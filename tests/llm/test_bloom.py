import numpy as np
from pyspark.sql import functions as F

from corpusgate.llm import bloom as module
from corpusgate.llm.bloom import _bits, bloom, passes


def _filter(values, words):
    out = np.zeros(words, dtype=np.uint64)
    for bit in _bits(values, words):
        np.bitwise_or.at(out, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def test_a_large_filter_reaches_the_driver_in_little_more_than_its_size(spark):
    conf = spark.sparkContext._jsc.sc().conf()
    conf.set("spark.driver.maxResultSize", "8m")  # the filter has 8 MB
    try:
        got = bloom(spark.range(3_000_000).select(F.col("id").alias("value")))
    finally:
        conf.set("spark.driver.maxResultSize", "1g")
    values = np.arange(3_000_000)
    assert (got == _filter(values, 1 << 20)).all()
    assert passes(got, values).all() and passes(got, values + 3_000_000).mean() < 0.05


def test_filters_of_many_tasks_and_small_ones(spark, monkeypatch):
    monkeypatch.setattr(module, "TASKS", 3)
    values = np.arange(20_000) * 977 - 5_000_000
    df = spark.createDataFrame([(int(v),) for v in values], "value long").repartition(8)
    assert (bloom(df) == _filter(values, 1 << 13)).all()
    assert (bloom(df, bits=128) == _filter(values, 1 << 16)).all()
    empty = bloom(df.where("value is null"))
    assert len(empty) == module.LEAST_WORDS and not empty.any()
