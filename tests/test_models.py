import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_letters, euclidean, key_bucket, last_field, matrix_literal
from tidemark.operators import clusters as C
from tidemark.operators import evaluation as E
from tidemark.operators.parsing import with_features
from tidemark.operators.partition_map import map_with_setup
from tidemark.operators.ratings import fit_als, history_names, latent_factors, normal_equation_gaps, prepare_ratings, recommend, with_item_names
from tidemark.operators.sampling import key_split, random_split
from tidemark.operators.trees import fit_forest, fit_tree, grid_search, labelled_vectors, predict, predict_one
from tidemark.plans.classification import tree_report
from tidemark.plans.linkage_report import linkage_report
from tidemark.plans.outliers import outlier_report


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(300):
        label = int(i % 3)
        data.append((i, label, [float(x) for x in rng.normal(label * 4, 1, 4)]))
    return spark.createDataFrame(data, "id BIGINT, label INT, values ARRAY<DOUBLE>").repartition(3).persist()


def test_split_is_disjoint_whole_and_stable(rows):
    parts = key_split(rows, "id")
    ids = [{r.id for r in p.select("id").collect()} for p in parts]
    assert sum(map(len, ids)) == 300 and len(set.union(*ids)) == 300
    again = [{r.id for r in p.select("id").collect()} for p in key_split(rows.repartition(11), "id")]
    assert ids == again
    assert 200 < len(ids[0]) < 280
    assert sum(p.count() for p in random_split(rows, 3)) == 300


def test_key_bucket_matches_md5(spark):
    import hashlib

    for r in spark.range(20).select("id", key_bucket(F.col("id")).alias("b")).collect():
        assert r.b == int(hashlib.md5(str(r.id).encode()).hexdigest()[:8], 16) % 1000


def test_priors_and_guessing_with_an_absent_class(spark):
    a = spark.createDataFrame([(0.0,), (0.0,), (1.0,), (3.0,)], "label DOUBLE")
    b = spark.createDataFrame([(0.0,), (2.0,)], "label DOUBLE")
    assert [(r.label, r.n, r.share) for r in E.class_priors(a).collect()] == [(0.0, 2, 0.5), (1.0, 1, 0.25), (3.0, 1, 0.25)]
    assert E.random_guess_accuracy(a, b).first().accuracy == pytest.approx(0.25)
    assert E.random_guess_accuracy(a, b.filter("label = 2")).first().accuracy == 0.0


def test_class_metrics_and_confusion(spark):
    pairs = [(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)] * 2 + [(2.0, 0.0)] + [(1.0, 3.0)]
    frame = spark.createDataFrame(pairs, "label DOUBLE, prediction DOUBLE")
    got = {r.label: (r.precision, r.recall) for r in E.class_metrics(frame).collect()}
    assert got == {
        0.0: (pytest.approx(3 / 4), pytest.approx(3 / 4)),
        1.0: (pytest.approx(2 / 3), pytest.approx(2 / 3)),
        2.0: (0.0, 0.0),
        3.0: (0.0, 0.0),
    }
    assert E.accuracy(frame).first().accuracy == pytest.approx(5 / 8)
    wide = E.confusion_matrix(frame, [0.0, 1.0, 2.0, 3.0]).collect()
    assert [list(r)[1:] for r in wide] == [[3, 1, 0, 0], [0, 2, 0, 1], [1, 0, 0, 0]]
    assert {(r.label, r.prediction): r.n for r in E.confusion_cells(frame).collect()}[(0.0, 0.0)] == 3


def test_tree_depth_zero_and_prediction(rows):
    vectors = labelled_vectors(rows, 4, keep=["id"])
    assert predict(fit_tree(vectors, depth=0), vectors).select("prediction").distinct().count() == 1
    model = fit_tree(vectors)
    assert E.accuracy(predict(model, vectors)).first().accuracy > 0.9
    assert predict_one(model, [8.0] * 4) == 2.0 and predict_one(model, [0.0] * 4) == 0.0


def test_categorical_positions_need_enough_bins(spark):
    data = [(float(i % 2), [float(i % 40)]) for i in range(200)]
    frame = spark.createDataFrame(data, "label DOUBLE, values ARRAY<DOUBLE>")
    marked = labelled_vectors(frame, 1, arity={0: 40})
    with pytest.raises(Exception, match="maxBins"):
        fit_tree(marked, bins=10)
    # A category split separates even from odd at once; a threshold cannot.
    assert E.accuracy(predict(fit_tree(marked, depth=1, bins=40), marked)).first().accuracy == 1.0
    assert E.accuracy(predict(fit_tree(labelled_vectors(frame, 1), depth=1), frame.transform(lambda d: labelled_vectors(d, 1)))).first().accuracy < 0.8


def test_fits_at_once_do_not_disturb_each_other(spark):
    """Every job in the pool has local properties of its own; many small grids all finish."""
    from tidemark.sources.threads import own_properties

    data = spark.createDataFrame([(float(k % 2), [float(k % 2), float(k)]) for k in range(12)], "label double, values array<double>")
    train = labelled_vectors(data, 2)
    for _ in range(20):
        assert grid_search(train, train, impurities=("gini",), depths=(1, 2), bins=(4, 8)).count() == 4
    spark.sparkContext.setLocalProperty("tidemark.test", "parent")
    jobs = own_properties(spark, [lambda: spark.sparkContext.getLocalProperty("tidemark.test")] * 3)
    assert [job() for job in jobs] == ["parent"] * 3


def test_grid_search_is_the_whole_grid_in_order(rows):
    train, held_out, _ = key_split(labelled_vectors(rows, 4, keep=["id"]), "id")
    table = grid_search(train, held_out, depths=(1, 3), bins=(4, 32)).collect()
    assert len({(r.impurity, r.depth, r.bins) for r in table}) == 8
    keys = [(-r.accuracy, r.impurity, r.depth, r.bins) for r in table]
    assert keys == sorted(keys)
    best = table[0]
    again = fit_tree(train, best.impurity, best.depth, best.bins)
    assert E.accuracy(predict(again, held_out)).first().accuracy == pytest.approx(best.accuracy)


def test_forest_and_report(rows):
    vectors = labelled_vectors(rows, 4, keep=["id"])
    forest = fit_forest(vectors, trees=5, depth=5, bins=32)
    assert E.accuracy(predict(forest, vectors)).first().accuracy > 0.9
    report = tree_report(vectors, "id", final={"impurity": "entropy", "depth": 5, "bins": 32})
    assert report.test_accuracy.first().accuracy > report.guess_accuracy.first().accuracy
    assert report.confusion.agg(F.sum("n")).first()[0] == key_split(rows, "id")[1].count()


def test_assignment_is_the_nearest_centre(rows):
    centers = [[0.0] * 4, [4.0] * 4, [8.0] * 4, [4.0] * 4]
    for r in C.assign_to_centers(rows, centers).collect():
        distances = [math.dist(r["values"], c) for c in centers]
        assert r.cluster == distances.index(min(distances))
        assert r.distance == pytest.approx(min(distances), rel=1e-12)


def test_near_ties_are_compared_exactly(spark):
    frame = spark.createDataFrame([([1e8, 0.25],), ([1e8, 0.75],), ([1e8, 0.5],)], "values ARRAY<DOUBLE>")
    got = [r.cluster for r in C.assign_to_centers(frame, [[1e8, 0.0], [1e8, 1.0]]).collect()]
    assert got == [0, 1, 0]


def test_model_assignment_agrees_with_its_centres(rows):
    vectors = with_features(rows)
    model = C.fit_kmeans(vectors, 3)
    own = {r.id: (r.cluster, r.distance) for r in C.assign_clusters(vectors, model).collect()}
    near = {r.id: (r.cluster, r.distance) for r in C.assign_to_centers(rows, model.clusterCenters()).collect()}
    assert {k: c for k, (c, _) in own.items()} == {k: c for k, (c, _) in near.items()}
    assert all(own[k][1] == pytest.approx(near[k][1]) for k in own)
    table = C.cluster_centers(rows, model).collect()
    assert [r.cluster for r in table] == [0, 1, 2] and '"center":[' in table[0].json


def test_refinement_is_one_average_per_round(rows):
    start = [r["values"] for r in rows.orderBy("id").limit(3).collect()] + [[1e6] * 4]
    groups = {}
    for r in C.assign_to_centers(rows, start).collect():
        groups.setdefault(r.cluster, []).append(r["values"])
    moved = C.refine_centers(rows, start, 1)
    for c, members in groups.items():
        assert moved[c] == pytest.approx(list(np.mean(members, axis=0)))
    assert moved[3] == [1e6] * 4


def test_fits_from_given_centers_follow_the_rounds(rows):
    start = [r["values"] for r in rows.orderBy("id").limit(4).collect()] + [[1e6] * 4]
    for rounds in (1, 3):
        expected = C.refine_centers(rows, start, rounds)
        found = C.fit_from_centers(rows, start, rounds, 0.0)
        assert np.allclose(found, expected) and found[4] == [1e6] * 4
    table = C.center_rows(rows, found).collect()
    assert [r.center for r in table] == found and [r.cluster for r in table] == list(range(5))
    swept = C.sweep_given_centers(rows, [start[:2], start], 3, 0.0).collect()
    for r, first in zip(swept, (start[:2], start), strict=True):
        near = C.assign_to_centers(rows, C.refine_centers(rows, first, 3))
        assert r.k == len(first) and r.mean_distance == pytest.approx(C.mean_distance(near).first()[0])


@pytest.mark.parametrize("n", [1, 5, 1000])
def test_far_rows_are_strictly_beyond_the_nth(spark, n):
    random.seed(n)
    distances = [random.choice([1.0, 2.0, 3.0, 4.0]) for _ in range(40)]
    frame = spark.createDataFrame([(d,) for d in distances], "distance DOUBLE")
    threshold = sorted(distances, reverse=True)[min(n, 40) - 1]
    assert C.far_rows(frame, n).count() == sum(d > threshold for d in distances)


def test_sweep_and_outlier_report(rows):
    scores = C.sweep_cluster_counts(with_features(rows), (2, 3, 6)).collect()
    assert [r.k for r in scores] == [2, 3, 6]
    assert scores[0].mean_distance > scores[1].mean_distance > scores[2].mean_distance
    report = outlier_report(with_features(rows), 3, 10)
    assert report.outliers.count() == 9
    counts = report.label_counts.collect()
    assert sum(r.n for r in counts) == 300
    assert [r.cluster for r in counts] == sorted((r.cluster for r in counts), reverse=True)
    report.release()


@pytest.fixture(scope="module")
def counts(spark):
    random.seed(9)
    data = {(u, i): float(random.randint(1, 9)) for u in range(30) for i in random.sample(range(20), 8)}
    return spark.createDataFrame([(u, i, r) for (u, i), r in data.items()], "user INT, item INT, rating FLOAT").persist()


def test_ratings_merge_after_aliasing(spark, counts):
    aliases = spark.createDataFrame([(1, 0), (2, 0)], "bad_id INT, good_id INT")
    merged = prepare_ratings(counts, aliases)
    assert merged.filter("item in (1, 2)").count() == 0
    assert merged.count() == merged.select("user", "item").distinct().count()
    total = counts.agg(F.sum("rating")).first()[0]
    assert merged.agg(F.sum("rating")).first()[0] == total
    assert prepare_ratings(counts, aliases, merge=False).count() == counts.count()


def test_recommendations(spark, counts):
    model = fit_als(counts, rank=4)
    users = spark.createDataFrame([(0,), (1,), (1,)], "user INT")
    names = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "item INT, name STRING")
    got = with_item_names(recommend(model, users, 5), names).orderBy("user", "rank").collect()
    assert [(r.user, r["rank"]) for r in got] == [(u, k) for u in (0, 1) for k in range(1, 6)]
    for u in (0, 1):
        scores = [r.score for r in got if r.user == u]
        assert scores == sorted(scores, reverse=True)
    assert all(r.name == (f"n{r.item}" if r.item < 10 else None) for r in got)
    new = recommend(model, users, 5, seen=counts).collect()
    owned = {(r.user, r.item) for r in counts.collect()}
    assert len(new) == 10 and not any((r.user, r.item) in owned for r in new)
    every = {(r.user, r.item): r.score for r in recommend(model, users, 20).collect()}
    best = sorted((s for (u, i), s in every.items() if u == 0 and (u, i) not in owned), reverse=True)[:5]
    assert [r.score for r in sorted(new, key=lambda r: r["rank"]) if r.user == 0] == best
    factors = latent_factors(model).groupBy("side").agg(F.count("id").alias("n"), F.max(F.size("features")).alias("k"))
    assert {r.side: (r.n, r.k) for r in factors.collect()} == {"user": (30, 4), "item": (20, 4)}
    history = {r.item for r in history_names(counts, users, names).collect()}
    assert history == {r.item for r in counts.filter("user in (0, 1) and item < 10").collect()}


def test_normal_equations_against_numpy(spark, counts):
    model = fit_als(counts, rank=3, reg=0.05)
    p, q = ({r.id: np.array(r.features) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    found = {r.user: r.gap for r in normal_equation_gaps(model, counts, 0.05).collect()}
    assert set(found) == set(p)
    wrong = {r.user: r.gap for r in normal_equation_gaps(model, counts, 1.0).collect()}
    for u, gap in found.items():
        mine = [(r.item, r.rating) for r in counts.collect() if r.user == u]
        right = sum(x * q[i] for i, x in mine)
        left = sum(np.outer(q[i], q[i]) for i, _ in mine) @ p[u] + 0.05 * len(mine) * p[u]
        assert gap == pytest.approx(np.linalg.norm(left - right) / np.linalg.norm(right), abs=1e-6)
        assert gap < 1e-3 < wrong[u]


def test_a_user_with_most_items_asks_alone(spark, counts, monkeypatch):
    from tidemark.operators import ratings

    asked = []
    real = ratings._best
    monkeypatch.setattr(ratings, "_best", lambda model, users, n: (asked.append((n, users.count())), real(model, users, n))[1])
    every = counts.select("item").distinct()
    heavy = counts.unionByName(every.select(F.lit(0).alias("user"), "item", F.lit(1.0).cast("float").alias("rating")))
    users = spark.createDataFrame([(0,), (1,), (2,), (999,)], "user INT")
    found = recommend(fit_als(heavy, rank=3), users, 2, seen=heavy).collect()
    assert sorted({r.user for r in found}) == [1, 2] and len(found) == 4
    assert max(n for n, _ in asked) > 20 and [c for n, c in asked if n > 20] == [1]


def test_scalar_expressions(spark):
    frame = spark.createDataFrame([("abc", "a,b,,", [0.0, 3.0]), ("a1", "x", [0.0, 0.0]), ("", "p,q", [1.0, 1.0])], "s STRING, l STRING, v ARRAY<DOUBLE>")
    got = frame.select(
        all_letters(F.col("s")).alias("a"), last_field(F.col("l")).alias("f"),
        euclidean(F.col("v"), F.get(matrix_literal([[4.0, 0.0]]), F.lit(0))).alias("d"),
    ).collect()
    assert [r.a for r in got] == [True, False, True]
    assert [r.f for r in got] == ["b", "x", "q"]
    assert [r.d for r in got] == pytest.approx([5.0, 4.0, math.sqrt(10)])


def test_setup_runs_once_per_task(spark):
    def setup():
        state = {"batches": 0}

        def work(batch):
            state["batches"] += 1
            return batch.assign(batch=state["batches"])

        return work

    out = map_with_setup(spark.range(0, 25_000, 1, 1), setup, "id BIGINT, batch BIGINT").agg(F.max("batch"), F.count("id")).first()
    assert out[0] > 1 and out[1] == 25_000


def test_linkage_report(spark):
    lines = [("id_1,id_2,a,b,c,d,e,f,g,h,i,is_match",)]
    lines += [(f"{i},{i + 1},1,?,1,0.5,1,1,1,1,{i % 2},{'TRUE' if i % 2 else 'FALSE'}",) for i in range(6)]
    report = linkage_report(spark.createDataFrame(lines, "value STRING"), (5.0, 4.0))
    assert {r.matched: r.n for r in report.match_counts.collect()} == {True: 3, False: 3}
    assert [(r.cutoff, r.matches, r.non_matches) for r in report.cutoffs.collect()] == [(5.0, 3, 0), (4.0, 3, 3)]
    assert {r.idx: r.missing for r in report.contrast.collect()}[1] == 6
    assert {r.idx: r.mean_difference for r in report.contrast.collect()}[8] == 1.0
    assert report.match_stats.count() == report.non_match_stats.count() == report.all_stats.count() == 9


def test_part_lines_use_all_cores(spark, tmp_path):
    from bindings.classes import part_lines

    rows = [(k, k % 50 + 1, 900.0, "PROMO", "Brand#11") for k in range(100)]
    parts = spark.createDataFrame(rows, "p_partkey bigint, p_size int, p_retailprice double, p_type string, p_brand string")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    lines = part_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and lines.count() == 100


def test_tree_fits_read_their_rows_once(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.trees import labelled_vectors
    from tidemark.plans.classification import tree_report

    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(k):
        read.add(1)
        return float(k % 2)

    table = spark.range(200).select("id", counted("id").alias("label"), F.array(F.col("id").cast("double")).alias("values"))
    tree_report(labelled_vectors(table, 1, keep=["id"]), "id", final={"impurity": "entropy", "depth": 3, "bins": 10})
    assert read.value == 200


def test_unseen_items_make_the_ratings_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from bindings import ratings as queries

    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(k):
        made.add(1)
        return k // 10

    pairs = spark.range(100).select(counted("id").alias("user"), (F.col("id") % 10).cast("int").alias("item"), F.lit(1.0).cast("float").alias("rating"))
    monkeypatch.setattr(queries, "ratings", lambda spark, folder: pairs.filter("user * 7 % 10 != item"))
    queries.als_unseen(spark, "").collect()
    assert made.value <= 200


def test_blocks_of_users_and_items_grow_in_number_not_in_size(spark, counts, monkeypatch):
    from tidemark.operators import ratings

    asked = []
    for name in ("setNumUserBlocks", "setNumItemBlocks"):
        real = getattr(ratings.ALS, name)
        monkeypatch.setattr(ratings.ALS, name, lambda self, n, real=real: (asked.append(n), real(self, n))[1])
    monkeypatch.setattr(ratings, "RATINGS_PER_BLOCK", 20)
    model = fit_als(counts, rank=3)
    assert asked == [12, 12] and model.userFactors.count() == 30 and model.itemFactors.count() == 20
    gaps = normal_equation_gaps(model, counts, 0.01).collect()
    assert len(gaps) == 30 and all(r.gap < 1e-3 for r in gaps)


@pytest.mark.parametrize("query", ["als_factors", "als_recommend"])
def test_fits_make_the_ratings_once_and_do_not_copy_them(spark, monkeypatch, query):
    from bindings import ratings as queries

    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(k):
        made.add(1)
        return k // 10

    pairs = spark.range(100).select(counted("id").alias("user"), (F.col("id") % 10).cast("int").alias("item"), F.lit(1.0).cast("float").alias("rating"))
    monkeypatch.setattr(queries, "ratings", lambda spark, folder: pairs.filter("user * 7 % 10 != item"))
    monkeypatch.setattr(queries, "name_lines", lambda spark, folder: spark.createDataFrame([("1\tone",)], "value STRING"))
    persisted = []
    real = type(pairs).persist
    monkeypatch.setattr(type(pairs), "persist", lambda self, *a: (persisted.append(self.columns), real(self, *a))[1])
    queries.QUERIES[query](spark, "").collect()
    assert made.value <= 200 and not persisted
