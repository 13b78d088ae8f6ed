import os
import random

from pyspark.sql import functions as F

from cairn.operators import bitmap


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ids_of_any_sign_come_back(spark):
    rng = random.Random(2)
    data = [(g, rng.choice([rng.randint(-300, 300), rng.randint(-(1 << 62), 1 << 62), 63, 64, 0, -1, -64])) for g in ("a", "b", None) for _ in range(300)]
    made = bitmap.build(spark.createDataFrame([*data, ("c", None)], "g string, id long"), ["g"], "id")
    assert rows(bitmap.ids(made, ["g"])) == sorted(set(data), key=str)
    assert {r["g"]: r["uv"] for r in bitmap.cardinality(made, ["g"]).collect()} == {g: len({i for h, i in data if h == g}) for g in ("a", "b", None)}
    assert bitmap.cardinality(made, []).first()["uv"] == len({i for _, i in data})


def test_bytes_follow_the_ids(spark, tmp_path):
    """2000 ids spread over 2 ** 40 take some bytes each; a million ids without gaps less than three bits each."""
    size = lambda name: sum(os.path.getsize(tmp_path / name / f) for f in os.listdir(tmp_path / name) if f.endswith(".parquet"))
    spread = spark.range(2000).select((F.col("id") * 524_287_001).alias("id"))
    bitmap.build(spread, [], "id").coalesce(1).write.parquet(str(tmp_path / "sparse"))
    bitmap.build(spark.range(1_000_000), [], "id").orderBy("word").coalesce(1).write.parquet(str(tmp_path / "dense"))
    assert size("sparse") < 2000 * 24 and size("dense") < 1_000_000 * 3 / 8
    assert spark.read.parquet(str(tmp_path / "dense")).count() == 15625
    partial = bitmap.build(spread, [], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in partial and "Python" not in partial


def test_merge_and_intersect(spark):
    df = lambda pairs: spark.createDataFrame(pairs, "g string, id long")
    a, b = df([("x", 1), ("x", 70), ("y", 5), (None, 9)]), df([("x", 70), ("x", 2), (None, 9), ("z", 5)])
    made = [bitmap.build(d, ["g"], "id") for d in (a, b)]
    assert rows(bitmap.ids(bitmap.intersect(*made, ["g"]), ["g"])) == sorted([("x", 70), (None, 9)], key=str)
    whole = bitmap.merge(made[0].unionByName(made[1]), ["g"])
    assert rows(bitmap.ids(whole, ["g"])) == rows(a.union(b).distinct())
