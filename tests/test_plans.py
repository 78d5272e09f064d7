"""The stages one after another on the smallest tables, through files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwell.plans import authors, discovery, posts
from gleanwell.sources import sinks, tables
from verification.fixtures import LOOSE_REACTIONS, LOOSE_REPLIES, RECENT_FROM, Fixtures
from verification.queries_models import length_encoder, length_judge


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, "/root/testdata/sf0.01")


def test_author_stages(spark, fx, tmp_path):
    out = str(tmp_path)
    casts = fx.casts()
    labels = authors.label_sample(casts, length_judge, out, n_samples=200)
    assert labels.count() == 200
    features = authors.build_features(casts, fx.exact_reactions(), out)
    lines = f"{out}/labeled_users"
    assert tables.read_first_present(spark, [lines], tables.LABELED_USERS).count() == 200
    models = authors.train(spark, [f"{out}/missing", lines], features, out, rounds=5)
    scores = authors.score_all(features, models["regressor"], out)
    assert scores.count() == features.count()
    csv = spark.read.option("header", True).csv(f"{out}/high_quality_users")
    assert csv.columns == ["fid", "quality_score"]
    assert csv.count() == scores.filter("quality_score >= 7").count()


def test_missing_labels_are_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_first_present(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], tables.LABELED_USERS)


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text('[{"fid": 1, "quality_score": 7.5, "category": "High"}, {"fid": 2}]')
    rows = tables.read_first_present(spark, [str(path)], tables.LABELED_USERS).orderBy("fid").collect()
    assert [(r.fid, r.quality_score) for r in rows] == [(1, 7.5), (2, None)]


def test_content_and_topics(spark, fx, tmp_path):
    out = str(tmp_path)
    good = posts.select_posts(fx.casts(), fx.reactions(), fx.scores(), out, recent_from=RECENT_FROM)
    assert good.groupBy("Fid").count().filter("count > 10").count() == 0
    clustered = discovery.cluster_posts(good, out, k=4, components=8, restarts=1)
    assert clustered.count() == good.count()
    assert clustered.filter(~F.col("cluster_id").between(0, 3)).count() == 0
    table = discovery.describe_topics(clustered, out)
    rows = table.collect()
    assert sum(r["size"] for r in rows) == good.count()
    assert all(r["name"] and 1 <= len(r["representatives"]) <= 10 for r in rows)
    answers = fx.feedback().withColumn("cluster_id", F.col("cluster_id") % 4)
    result = discovery.recommend_all(answers, table, ["user_id", "session"], out)
    assert result.count() == answers.select("user_id", "session").distinct().count()
    assert result.filter(F.size("recommendations") > 10).count() == 0


def test_early_generation(spark, fx, tmp_path):
    out = str(tmp_path)
    loose = posts.loose_export(
        fx.casts(), fx.reactions(), out, recent_from=RECENT_FROM,
        reaction_range=LOOSE_REACTIONS, reply_range=LOOSE_REPLIES,
    )
    embedded = discovery.embed_export(loose, length_encoder, out)
    assert embedded.count() == loose.filter("Text <> ''").count()
    assert dict(embedded.dtypes)["embedding"] == "array<float>"
    assert tables.read_embeddings(spark, f"{out}/cast_embeddings", 3).count() == embedded.count()
    with pytest.raises(Exception, match="vector length"):
        tables.read_embeddings(spark, f"{out}/cast_embeddings", 4).collect()
    info = discovery.early_topics(embedded, out, k=3, components=2, restarts=1)
    assert sum(r["size"] for r in info.collect()) == embedded.count()


def test_views_tables_and_id_sets(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(10).selectExpr("cast(id as string) Fid"), path)
    df = tables.read_parquet(spark, path, view="some_posts")
    assert spark.sql("SELECT count(*) FROM some_posts").first()[0] == 10
    ids = spark.createDataFrame([("3",), ("3",), ("99",)], "fid string")
    assert [r.Fid for r in tables.only_of(df, ids, "Fid").collect()] == ["3"]
    assert tables.row_count(df).first()["rows"] == 10


def test_only_a_table_of_clusters_becomes_an_array(spark):
    from gleanwell.operators.bounded import book

    one = spark.range(1)
    with pytest.raises(Exception, match="table of clusters"):
        one.select(book(spark.range(100), "id", max_rows=50)).collect()
    assert len(one.select(book(spark.range(100), "id", max_rows=100).alias("b")).first()["b"]) == 100


def test_json_lines_in_many_files_are_read_whole(spark, tmp_path):
    path = str(tmp_path / "labels")
    sinks.write_json(spark.range(200, numPartitions=4).selectExpr("id AS fid", "id / 20.0 AS quality_score"), path)
    rows = tables.read_first_present(spark, [f"{tmp_path}/none", path], tables.LABELED_USERS)
    assert sorted(r.fid for r in rows.collect()) == list(range(200))
