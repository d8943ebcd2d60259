import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from txnlens.operators import ensemble, tuning
from txnlens.operators.tuning import ENSEMBLE_SPACE, Density, Trial


def history(n, seed=1):
    rng = random.Random(seed)
    return [Trial(t, Density(ENSEMBLE_SPACE, []).draw(rng), {0: rng.random()}) for t in range(n)]


def plain_log(space, settings, x):
    """The density by numerical integration of each truncated normal."""
    own = [s for s in settings if s["model"] == x["model"]]
    width = max(0.05, (len(own) + 1) ** -0.8)
    p = (len(own) + 1) / (len(settings) + len(space))
    for number in space[x["model"]]:
        def at(s):
            lo, hi = number.lo - 0.5 * number.whole, number.hi + 0.5 * number.whole
            v = s[number.name]
            return (math.log(v / lo) / math.log(hi / lo)) if number.log else (v - lo) / (hi - lo)
        dens = 1.0
        for s in own:
            def bell(u):
                return math.exp(-0.5 * ((u - at(s)) / width) ** 2)
            dens += bell(at(x)) / (sum(bell((i + 0.5) / 4000) for i in range(4000)) / 4000)
        p *= dens / (len(own) + 1)
    return math.log(p)


def test_density_equals_integration():
    known = history(9)
    d = Density(ENSEMBLE_SPACE, [t.setting for t in known])
    rng = random.Random(2)
    for x in [d.draw(rng) for _ in range(12)] + [{"model": "rf", "n_estimators": 50, "max_depth": 10}, {"model": "lr", "C": 10.0}]:
        assert d.log(x) == pytest.approx(plain_log(ENSEMBLE_SPACE, d.settings, x), abs=1e-4)


def test_proposal_is_the_best_ratio():
    known = history(12)
    known.append(Trial(12, {"model": "lr", "C": 0.5}))  # still running: among the rest
    got = tuning.propose(known, random.Random(5))
    ranked = sorted(known[:12], key=lambda t: -t.values[0])
    good, rest = [t.setting for t in ranked[:3]], [t.setting for t in known if t not in ranked[:3]]
    rng = random.Random(5)
    drawn = [Density(ENSEMBLE_SPACE, good).draw(rng) for _ in range(24)]
    assert got == max(drawn, key=lambda s: plain_log(ENSEMBLE_SPACE, good, s) - plain_log(ENSEMBLE_SPACE, rest, s))


def test_numbers_stay_in_their_range():
    rng = random.Random(3)
    for n in (0, 1, 30):
        d = Density(ENSEMBLE_SPACE, [t.setting for t in history(n)])
        for s in (d.draw(rng) for _ in range(200)):
            assert 0.01 <= s["C"] <= 10 if s["model"] == "lr" else (s["n_estimators"] in range(50, 201) and s["max_depth"] in range(3, 11))


@pytest.mark.parametrize("parallelism", [1, 4])
def test_halving_stops_poor_settings_and_finds_good_ones(parallelism):
    def loss(s, rung):  # best at C = 1
        return 1 - abs(math.log10(s["C"])) / 4 if s["model"] == "lr" else 0.3
    seen = []
    got = tuning.halving_search(lambda s, r: seen.append(r) or loss(s, r), 3, n_trials=27, parallelism=parallelism)
    again = tuning.halving_search(loss, 3, n_trials=27, parallelism=parallelism)
    assert [(t.setting, t.values) for t in got] == [(t.setting, t.values) for t in again] and len(got) == 27
    assert seen.count(0) == 27 and 9 <= seen.count(1) < 27 and 3 <= seen.count(2) < seen.count(1)
    best = min((t for t in got if 2 in t.values), key=lambda t: t.at(2))
    assert best.setting["model"] == "lr" and abs(math.log10(best.setting["C"])) < 0.4
    assert best.values[2] == max(t.values[0] for t in got)  # the best of the samples came through


def test_values_that_are_missing_rank_last():
    t = [Trial(0, {}, {0: math.nan}), Trial(1, {}, {0: 0.1}), Trial(2, {}, {0: 0.1}), Trial(3, {}, {})]
    assert [x.trial for x, _ in tuning.promoted(t, 2)] == [1]


def test_samples_are_nested_and_grow():
    assert tuning.sample_shares(10 ** 6, 3) == [1 / 9, 1 / 3, 1.0]
    assert tuning.sample_shares(180, 3) == [0.5, 1.0] and tuning.sample_shares(0, 3) == [1.0]


def test_search_on_rows(spark):
    d = spark.range(1200).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("Class"))
    d = d.withColumn("a", F.col("Class") + F.pmod(F.xxhash64("id"), F.lit(100)) / 60).withColumn("b", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 100)
    small = d.where(tuning.in_sample("id", 1 / 3, 42)).select("id")
    assert small.exceptAll(d.where(tuning.in_sample("id", 0.5, 42)).select("id")).isEmpty() and 300 < small.count() < 500
    space = {"lr": ENSEMBLE_SPACE["lr"]}
    t = tuning.adaptive_search(d, n_trials=3, features=["a", "b"], space=space, parallelism=3)
    best = ensemble.best_trial(t.where("share = 1.0")).first()
    assert best["auc"] == max(r["auc"] for r in t.where("share = 1.0").collect()) > 0.8 and t.select("trial").distinct().count() == 3
    one = tuning.adaptive_search(d.where("Class = 0"), n_trials=2, features=["a", "b"], space=space)
    assert one.isEmpty() and tuning.adaptive_search(d.where("false"), n_trials=2, features=["a", "b"], space=space).isEmpty()


def labelled(spark, n):
    d = spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("Class"))
    return d.withColumn("a", F.col("Class") + F.pmod(F.xxhash64("id"), F.lit(100)) / 60).withColumn("b", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 100)


@pytest.mark.parametrize("how", [ensemble.search, tuning.adaptive_search])
def test_a_search_fits_each_setting_once_a_fold_on_few_parts(spark, monkeypatch, how):
    fits = []
    for kind in (LogisticRegression, RandomForestClassifier):
        def counted(self, data, whole=kind._fit):
            fits.append((data.rdd.getNumPartitions(), data.count()))
            return whole(self, data)
        monkeypatch.setattr(kind, "_fit", counted)
    drawn = [{"trial": t, "model": "lr", "n_estimators": None, "max_depth": None, "C": c} for t, c in enumerate((0.1, 5.0))]
    monkeypatch.setattr(ensemble, "draw_trials", lambda n, seed: drawn[:n])
    monkeypatch.setattr(tuning, "sample_shares", lambda *_: [1.0])
    more = {"space": {"lr": ENSEMBLE_SPACE["lr"]}} if how is tuning.adaptive_search else {}
    got = how(labelled(spark, 900).repartition(8), n_trials=2, features=["a", "b"], **more).collect()
    assert fits == [(1, 600)] * 6 and [r["trial"] for r in got] == [0, 1] and all(0.8 < r["auc"] < 1 for r in got)


def test_folds_of_a_search(spark):
    d = labelled(spark, 900)
    for wrong in (d.where("fold < 2"), d.withColumn("fold", F.col("fold") + 1), d.withColumn("fold", F.expr("nullif(fold, 1)"))):
        with pytest.raises(ValueError):
            ensemble.search(wrong, n_trials=1, features=["a", "b"])


def test_forest_with_kept_nodes_has_the_same_trees(spark):
    d = labelled(spark, 900).withColumn("Class", F.col("Class").cast("double")).coalesce(1).cache()
    pipe = ensemble.ensemble_pipeline("rf", {"n_estimators": 5, "max_depth": 4}, 900, ["a", "b"])
    forest = pipe.getStages()[1]
    kept, walked = pipe.fit(d), pipe.copy({forest.cacheNodeIds: False}).fit(d)
    assert forest.getCacheNodeIds() and kept.stages[1].toDebugString.split("\n")[1:] == walked.stages[1].toDebugString.split("\n")[1:]


def test_search_gives_the_means_of_a_cross_validator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    d = labelled(spark, 900).withColumn("Class", F.col("Class").cast("double")).repartition(4).cache()
    ev = BinaryClassificationEvaluator(labelCol="Class", rawPredictionCol="probability", numBins=0)
    for t in ({"trial": 0, "model": "rf", "n_estimators": 6, "max_depth": 3, "C": None}, {"trial": 0, "model": "lr", "n_estimators": None, "max_depth": None, "C": 0.5}):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ensemble, "draw_trials", lambda n, seed: [t])
            got = ensemble.search(d, 1, features=["a", "b"]).first()["auc"]
        pipe = ensemble.ensemble_pipeline(t["model"], t, 600, ["a", "b"])
        want = CrossValidator(estimator=pipe, estimatorParamMaps=[{}], evaluator=ev, foldCol="fold").fit(d).avgMetrics[0]
        assert got == pytest.approx(want, abs=1e-9)
