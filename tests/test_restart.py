"""A stage that dies half-way and starts again gives the rows of a whole run, each computed once."""

import pytest
from pyspark.sql import functions as F

from gleanwell.plans import restart


def doubled(df):
    return df.withColumn("y", F.col("x") * 2)


def rows_of(df):
    return sorted(map(tuple, df.select("id", "x", "y").collect()), key=str)


def marking(folder, poison=None):
    """Notes each key that it computes, and fails on the poisoned one."""

    def work(df):
        def run(frames):
            for frame in frames:
                for key in frame["id"]:
                    if key == poison:
                        raise RuntimeError("killed")
                    with open(f"{folder}/{key}", "a") as f:
                        f.write("x")
                yield frame.assign(y=frame["x"] * 2)

        return df.mapInPandas(run, "id long, x long, y long")

    return work


def test_killed_and_started_again(spark, tmp_path):
    df = spark.range(200).withColumn("x", F.col("id") % 7)
    seen, out = tmp_path / "seen", str(tmp_path / "out")
    seen.mkdir()
    place = df.select("id", F.pmod(F.xxhash64("id"), F.lit(8)).alias("r")).collect()
    late = next(r["id"] for r in place if r["r"] == 5)
    with pytest.raises(Exception, match="killed"):
        restart.run_in_ranges(df, "id", marking(seen, late), out, ranges=8, wave=2)
    first = restart.finished_ranges(spark, out)
    assert first == {0, 1, 2, 3}
    again = restart.run_in_ranges(df, "id", marking(seen), out, ranges=8, wave=2)
    assert rows_of(again) == rows_of(doubled(df))
    once = {r["id"] for r in place if r["r"] in first}
    assert all((seen / str(i)).read_text() == "x" for i in once)
    before = sum(len(p.read_text()) for p in seen.iterdir())
    restart.run_in_ranges(df, "id", marking(seen), out, ranges=8, wave=2)
    assert sum(len(p.read_text()) for p in seen.iterdir()) == before


def test_awkward_rows(spark, tmp_path):
    schema = "id long, x long"
    nothing = restart.run_in_ranges(spark.createDataFrame([], schema), "id", doubled, str(tmp_path / "a"), ranges=3)
    assert nothing.count() == 0 and restart.finished_ranges(spark, str(tmp_path / "a")) == {0, 1, 2}
    odd = spark.createDataFrame([(None, 1), (None, 1), (2, None), (2, 4)], schema)
    assert rows_of(restart.run_in_ranges(odd, "id", doubled, str(tmp_path / "b"), ranges=3)) == rows_of(doubled(odd))
    with pytest.raises(ValueError, match="another run"):
        restart.run_in_ranges(odd, "id", doubled, str(tmp_path / "b"), ranges=4)
    with pytest.raises(ValueError, match="key_range"):
        restart.run_in_ranges(odd.withColumn("key_range", F.lit(1)), "id", doubled, str(tmp_path / "c"))
