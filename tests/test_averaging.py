from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concord.operators import averaging as A
from concord.operators import uploads as U
from concord.sources import files, fixtures, tables
from table_paths import SF001

UPD = "version int, client_id long, content_hash string, layer string, pos int, value double"


def updates_from(spark, models):
    rows = [(0, c, f"h{c}", "w", p, float(v)) for c, vec in enumerate(models)
            for p, v in enumerate(vec)]
    return spark.createDataFrame(rows, UPD)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=6),
       st.integers(1, 5))
def test_averaging_identical_models_is_identity(spark, vec, copies):
    up = updates_from(spark, [vec] * copies)
    got = {r.pos: r.value for r in A.uniform_mean(up).collect()}
    for p, v in enumerate(vec):
        assert abs(got[p] - v) <= 1e-9 * max(1.0, abs(v))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.floats(-10, 10, allow_nan=False), min_size=3, max_size=3),
                min_size=1, max_size=5))
def test_weighted_mean_with_equal_sizes_equals_mean(spark, models):
    up = updates_from(spark, models)
    a = {r.pos: r.value for r in A.uniform_mean(up).collect()}
    b = {r.pos: r.value for r in A.weighted_mean(up.withColumn("sample_size", F.lit(7))).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_both_orders_agree(spark):
    up = updates_from(spark, [[1.0, 2.0], [3.0, 5.0], [0.5, 0.25]]).withColumn("n_models", F.lit(3))
    rows = {r.pos: r for r in A.both_orders(up).collect()}
    assert all(r.agree for r in rows.values())
    assert abs(rows[0].divide_then_add - 1.5) < 1e-12 and rows[1].add_then_divide == 7.25 / 3


def test_identical_uploads_count_once(spark):
    """Objects h = 1.0 (uploaded twice) and g = 4.0: every mean is 2.5."""
    ups = spark.createDataFrame(
        [(0, "h", 0, 5, [1.0]), (0, "h", 1, 5, [1.0]), (0, "g", 0, 5, [4.0])],
        "version int, content_hash string, upload_seq int, sample_size int, vec array<double>")
    objects = A.distinct_objects(ups, "vec")
    assert sorted((r.content_hash, r.n_uploads) for r in objects.collect()) == [("g", 1), ("h", 2)]
    params = A.explode_vector(A.with_model_count(objects), "vec", "w",
                              ["version", "content_hash", "n_models"])
    assert A.uniform_mean(params).first().value == 2.5
    both = A.both_orders(params).first()
    assert (both.divide_then_add, both.add_then_divide, both.agree) == (2.5, 2.5, True)
    weighed = A.join_weights(objects, ups)
    assert weighed.count() == 2
    params = A.explode_vector(weighed, "vec", "w", ["version", "sample_size"])
    assert A.weighted_mean(params).first().value == 2.5


def test_weight_of_the_last_record_counts(spark):
    objects = spark.createDataFrame([(0, "a")], "version int, content_hash string")
    weights = spark.createDataFrame([(0, "a", 0, 3), (0, "a", 2, 9), (0, "a", 1, 4)],
                                    "version int, content_hash string, upload_seq int, sample_size int")
    assert [r.sample_size for r in A.join_weights(objects, weights).collect()] == [9]


def test_cohorts_hold_different_objects(spark):
    objs = spark.createDataFrame([(v, f"h{i:02d}", [float(i)]) for v in (0, 1) for i in range(15)],
                                 "version int, content_hash string, vec array<double>")
    dealt = A.cohorts(objs, [4, 3, 4])
    got = {(r.version, r.cohort): r.n for r in dealt.groupBy("version", "cohort")
           .agg(F.countDistinct("content_hash").alias("n")).collect()}
    assert got == {(v, c): n for v in (0, 1) for c, n in enumerate((4, 3, 4, 4))}
    mean = A.uniform_mean(A.explode_vector(dealt, "vec", "w", ["version", "cohort"]),
                          ["version", "cohort"])
    assert {(r.version, r.cohort): r.value for r in mean.collect()}[0, 1] == 5.0


def test_missing_weight_and_missing_object_reported(spark):
    objs = spark.createDataFrame([(0, "a"), (0, "b")], "version int, content_hash string")
    wts = spark.createDataFrame([(0, "b", 0, 3), (0, "c", 0, 4)],
                                "version int, content_hash string, upload_seq int, sample_size int")
    joined = A.join_weights(objs, wts).collect()
    assert [(r.content_hash, r.sample_size) for r in joined] == [("b", 3)]
    gaps = {(r.content_hash, r.gap) for r in A.weight_gaps(objs, wts).collect()}
    assert gaps == {("a", "no_weight"), ("c", "no_object")}


def test_duplicate_uploads_collapse_and_last_write_wins(spark):
    recs = spark.createDataFrame(
        [(1, 0, '{"model": "YWJj", "sample_size": "5"}'),
         (2, 0, '{"model": "YWJj", "sample_size": "9"}'),
         (3, 0, '{"model": "eHl6", "sample_size": "n/a"}'),
         (4, 0, '{"sample_size": "5"}'), (5, 0, '{"model": "***", "sample_size": "5"}'),
         (6, 0, '{"model": "eHl6", "sample_size": "-4"}'), (7, 0, "no json"), (8, 0, None),
         (9, 0, '{"model": "eHl6", "sample_size": "0"}')],
        "doc_id long, version int, body string")
    ing = U.ingest(recs)
    statuses = {r.doc_id: r.status for r in ing.collect()}
    assert statuses == {1: "accepted", 2: "accepted"} | {k: "rejected" for k in range(3, 10)}
    assert all(r.object_name is None for r in ing.filter("doc_id IN (4, 5, 7, 8)").collect())
    acc = ing.filter(F.col("status") == "accepted")
    d = A.distinct_objects(acc, "size").collect()
    assert [(r.n_uploads, r.size) for r in d] == [(2, 3)]
    lw = A.last_write_wins(acc, ["version", "content_hash"], "doc_id", "sample_size").collect()
    assert lw[0].sample_size == 9
    name = ing.filter("doc_id = 1").collect()[0].object_name
    assert name.startswith("local_v0_") and name.endswith(".zip")


def test_shares_sum_to_one(spark):
    w = spark.createDataFrame([(0, "a", 1), (0, "b", 3), (1, "c", 5)],
                              "version int, content_hash string, sample_size int")
    sums = {r.version: r.s for r in A.shares(w).groupBy("version")
            .agg(F.sum("share").alias("s")).collect()}
    assert all(abs(v - 1.0) < 1e-12 for v in sums.values())


def test_object_store_listing_and_mean_size(spark, tmp_dir):
    ups = fixtures.client_updates(tables.embeddings(spark, SF001))
    store = A.distinct_objects(ups, "embedding").withColumn("size", F.size("embedding"))
    files.write_objects(store, f"{tmp_dir}/models")
    files.write_objects(store.filter("version = 3"), f"{tmp_dir}/models")
    listed = files.list_objects(spark, f"{tmp_dir}/models", version=3, size="size")
    keys = sorted(r.content_hash for r in listed.collect())
    assert keys == sorted({r.content_hash for r in ups.filter("version = 3").collect()})
    assert listed.agg(F.avg("size")).first()[0] == 64
    everything = files.list_objects(spark, f"{tmp_dir}/models")
    assert everything.count() == store.count()


def test_params_publish_is_idempotent_per_version(spark, tmp_dir):
    from concord.operators import model as M
    p0 = M.initial_params(spark, 0, n_buckets=8)
    p1 = M.initial_params(spark, 1, n_buckets=8)
    files.write_params(p0, f"{tmp_dir}/params")
    files.write_params(p1, f"{tmp_dir}/params")
    files.write_params(p1, f"{tmp_dir}/params")
    assert files.read_params(spark, f"{tmp_dir}/params", 1).count() == p1.count()
    assert files.read_params(spark, f"{tmp_dir}/params").count() == 2 * p0.count()
