"""Vectors in single precision link as the same vectors in double precision do."""

from pyspark.sql import functions as F

from creaseline.llm import embeddings
from creaseline.llm.common import read


def test_single_and_double_precision_agree(spark, small):
    given = read(spark, small, "embeddings").select("vec_id", "embedding")
    near = "transform(embedding, (x, i) -> cast(x + if(i = 0, 0.01, 0) as float)) AS embedding"
    # No vectors of the small table link, so each gets a near copy.
    frame = given.unionByName(given.selectExpr("vec_id + 100000 AS vec_id", near))
    assert frame.schema["embedding"].dataType.simpleString() == "array<float>"
    wide = frame.withColumn("embedding", F.col("embedding").cast("array<double>"))
    a, b = (sorted(map(tuple, embeddings.near_duplicate_vectors(x).collect())) for x in (frame, wide))
    assert a == b and sum(row[1] > 0 for row in a) >= 0.98 * len(a)


def test_other_numbers_are_taken_as_doubles(spark):
    rows = [(1, [3, 4]), (2, [6, 8]), (3, [-4, 3]), (4, None), (5, [0, 0])]
    got = embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<int>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5)}
