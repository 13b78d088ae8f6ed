import os
import random

import pyarrow.parquet as pq
import pytest

from cairn.operators import scan
from cairn.sources.clustered import ClusteredTable


@pytest.fixture
def data(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, rng.randint(0, 40)]), rng.choice([None, "a", "b", "c"]), i) for i in range(400)]
    return spark.createDataFrame(rows, "k int, s string, v long").repartition(4)


def ranges_of(df):
    return {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}


def test_scans_equal_those_of_the_plain_table(data, tmp_path, spark):
    table = ClusteredTable.write(data, str(tmp_path / "t"), ["k:desc", "s"], 30)
    assert len(table.ranges()) > 8 and sum(n for _, n in table.ranges()) == 400
    for equal, between in (({"k": 7}, None), (None, {"k": (10, 13)}), ({"s": "b"}, {"k": (None, 5)}), ({"v": 17}, None), (None, {"k": (100, None)}), (None, None)):
        want = scan.scan(data, equal, between, None, ["k", "s"])
        got = table.scan(equal, between)
        assert [tuple(r)[:2] for r in got.collect()] == [tuple(r)[:2] for r in want.collect()]
        assert sorted(r["v"] for r in got.collect()) == sorted(r["v"] for r in want.collect())


def test_ranges_and_row_groups_read(data, tmp_path):
    table = ClusteredTable.write(data, str(tmp_path / "t"), ["k", "s"], 30)
    one = table.scan({"k": 7}, columns=["v"])
    assert 1 <= len(ranges_of(one)) <= 2 < len(table.ranges())
    groups = lambda df: sum(pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).num_row_groups for f in df.inputFiles())
    assert groups(one) <= 2 < groups(table.read())
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,7)]" in plan and "ReadSchema: struct<k:int,s:string,v:bigint>" in plan or "EqualTo(k,7)" in plan


def test_the_first_rows_stop_early(data, tmp_path):
    table = ClusteredTable.write(data, str(tmp_path / "t"), ["k", "v"], 30)
    first = table.scan(limit=40)
    want = scan.scan(data, sort=["k", "v"], limit=40)
    assert first.collect() == want.collect() and len(ranges_of(first)) <= 3
    some = table.scan({"s": "b"}, limit=12)
    assert some.collect() == scan.scan(data, {"s": "b"}, sort=["k", "v"], limit=12).collect() and len(ranges_of(some)) < len(table.ranges())
    assert table.scan({"s": "zz"}, limit=5).collect() == [] and table.scan(limit=0).collect() == []
    assert table.scan(limit=1000).count() == 400


def test_empty_table(data, tmp_path):
    table = ClusteredTable.write(data.limit(0), str(tmp_path / "t"), ["k"])
    assert table.ranges() == [] and table.scan({"k": 1}).columns == ["k", "s", "v"] and table.scan(limit=3).count() == 0


def test_small_ranges_do_not_ask_for_more_tasks(data, tmp_path, spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("clustered", "")
    table = ClusteredTable.write(data, str(tmp_path / "t"), ["k", "v"], 14)
    stages = {s for j in tracker.getJobIdsForGroup("clustered") for s in tracker.getJobInfo(j).stageIds}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    told = [tracker.getStageInfo(s) for s in stages]
    assert max(i.numTasks for i in told if i) < 20
    assert [n for _, n in table.ranges()] == [14] * 28 + [8]
    assert table.read().count() == 400 and table.scan({"k": 7}).collect() == scan.scan(data, {"k": 7}, sort=["k", "v"]).collect()
