from __future__ import annotations

from pyspark.sql import functions as F

from saleloom.llm import surrogates


def distinct(spark, kind, normal, n):
    entities = spark.range(n).select(F.lit(kind).alias("kind"), normal(F.col("id").cast("string")).alias("normal"))
    found = surrogates.distinct_surrogates(entities, "k")
    same = found.select(F.lower("surrogate").alias("s"))
    assert found.count() == same.distinct().count() == n
    assert same.join(entities, same["s"] == F.lower("normal")).count() == 0


def test_more_names_than_a_third_of_the_first_pool(spark):
    distinct(spark, "name", lambda i: F.concat(F.lit("n"), F.translate(i, "0123456789", "abcdefghij")), 40_000)


def test_formats_with_few_values(spark):
    distinct(spark, "secret", lambda i: F.concat(F.lit("-----"), i), 10)
    distinct(spark, "secret", lambda i: i, 5)  # the five other digits are all that is left
    distinct(spark, "email", lambda i: F.concat(F.translate(i, "0123456789", "abcdefghij"), F.lit("@x.com")), 100)


def test_surrogates_are_no_real_names_in_other_case(spark):
    entities = spark.createDataFrame([("name", "smith")], "kind string, normal string")
    first = surrogates.distinct_surrogates(entities, "k").first().surrogate
    both = entities.union(spark.createDataFrame([("name", first.lower())], entities.schema))
    assert first.lower() not in {r.surrogate.lower() for r in surrogates.distinct_surrogates(both, "k").collect()}
