"""Hand fixtures with the reference's exact patterns and word sets."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.functions import scalars, text
from quarry.operators import weak


def test_year_and_suffix_patterns(spark):
    df = spark.createDataFrame([(["1996"],), (["1996."],), (["2004,"],), (["1896"],), (["19961"],),
                                (["Inc"],), (["inc."],), (["Ltd."],), (["Incorporated"],), ([],)], "tokens array<string>")
    L = weak.apply_lfs(df.withColumn("id", F.monotonically_increasing_id()), [weak.lf_years(), weak.lf_org_suffix()])
    got = [(r["lf_years"], r["lf_org_sup"]) for r in L.orderBy("id").collect()]
    assert got == [(1, -1), (1, -1), (1, -1), (-1, -1), (-1, -1),
                   (-1, 0), (-1, 0), (-1, 0), (-1, -1), (-1, -1)]


def test_clean_text_and_exclaim_quirk(spark):
    df = spark.createDataFrame([(1, "Great<br />movie!!! déjà vu, it's <br>best")], "id int, text string")
    row = df.select(text.clean_text("text").alias("c"), text.count_char("text", "!").alias("n")).first()
    assert row["c"] == "great movie déjà vu it's  best"
    assert row["n"] == 3
    L = weak.apply_lfs(df.withColumn("clean", text.clean_text("text")),
                       [weak.lf_positive(), weak.lf_negative(), weak.lf_exclaim("text")]).first()
    assert (L["lf_positive"], L["lf_negative"], L["lf_exclaim"]) == (1, -1, 1)
    # cleaning deletes "!", so the LF never fires on cleaned text
    assert weak.apply_lfs(df.withColumn("text", text.clean_text("text")), [weak.lf_exclaim()]).first()["lf_exclaim"] == -1


def _matrix(spark):
    rows = [(1, -1, -1, 0), (2, 1, -1, 1), (3, 1, 1, 1), (4, 0, 1, 0), (5, 0, -1, None)]
    return spark.createDataFrame(rows, "id int, a int, b int, y int")


def test_majority_vote_ties_abstain(spark):
    L = _matrix(spark).select("id", weak.majority_vote(["a", "b"]).alias("p"))
    assert {r["id"]: r["p"] for r in L.collect()} == {1: -1, 2: 1, 3: 1, 4: -1, 5: 0}


def test_lf_summary_counts(spark):
    s = {r["lf"]: r for r in weak.lf_summary(_matrix(spark), ["a", "b"], truth="y").collect()}
    assert s["a"]["polarity"] == [0, 1]
    assert abs(s["a"]["coverage"] - 0.8) < 1e-12
    assert abs(s["a"]["overlaps"] - 0.4) < 1e-12      # rows 3, 4
    assert abs(s["a"]["conflicts"] - 0.2) < 1e-12     # row 4
    assert (s["a"]["correct"], s["a"]["incorrect"]) == (3, 0)  # row 5 has no truth


def test_voter_quality_tie_counts_as_correct(spark):
    df = spark.createDataFrame([(-1, -1, True), (1, 1, True), (-1, 0, True), (0, 0, False)], "p int, y int, m boolean")
    q = weak.voter_quality(df, "p", "y", F.col("m")).first()
    assert q["accuracy"] == round(2 / 3, 4) and q["accuracy_decided"] == 1.0 and q["coverage"] == 0.75


def test_label_model_recovers_agreeing_votes(spark):
    rows = [(i, 1, 1, -1) for i in range(40)] + [(100 + i, 0, 0, 0) for i in range(40)] + [(200, -1, -1, -1)]
    L = spark.createDataFrame(rows, "id int, a int, b int, c int")
    out = {r["id"]: r for r in weak.label_model(L, ["a", "b", "c"], seed=1).collect()}
    assert out[0]["pred"] == 1 and out[100]["pred"] == 0
    assert abs(sum(out[200]["probs"]) - 1) < 1e-9


def test_python_lf_matches_column_lf(spark):
    df = spark.createDataFrame([(1, "a!!!"), (2, "b!")], "id int, text string")
    py = weak.python_lf("py", lambda s: 1 if s.count("!") > 2 else -1)
    got = {r["id"]: (r["py"], r["lf_exclaim"]) for r in weak.apply_lfs(df, [py, weak.lf_exclaim()]).collect()}
    assert got == {1: (1, 1), 2: (-1, -1)}


def test_scalar_fixtures(spark):
    df = spark.createDataFrame([("10.5",), ("25",), ("abc",), ("",), (" 7 ",), ("1e3",), ("10.7",)], "s string")
    got = [(r["i"], r["f"]) for r in df.select(scalars.is_int("s").alias("i"), scalars.is_float("s").alias("f")).collect()]
    assert got == [(False, True), (True, True), (False, False), (False, False), (True, True), (False, True), (False, True)]
    ns = [None, -1, 0, 1, 5, 20, 21, 33]
    f = spark.createDataFrame([(n,) for n in ns], "n int").select(scalars.factorial("n").alias("f"), scalars.factorial_exact("n").alias("x"))
    want = [None if n is None or n < 0 else math.factorial(n) for n in ns]
    rows = f.collect()
    assert [r["x"] if r["x"] is None else int(r["x"]) for r in rows] == want
    assert [r["f"] for r in rows] == [w if w is None else pytest.approx(w, rel=1e-14) for w in want]
    big = spark.createDataFrame([(50,), (170,), (171,)], "n int")
    assert [r[0] for r in big.select(scalars.factorial("n")).collect()] == [
        pytest.approx(float(math.factorial(50)), rel=1e-13), pytest.approx(float(math.factorial(170)), rel=1e-13), math.inf]
    with pytest.raises(Exception, match="factorial beyond"):
        big.select(scalars.factorial_exact("n")).collect()
    r = spark.createDataFrame([(0.125,)], "x double").select(scalars.round_half_up("x", 2).alias("u"),
                                                             scalars.round_half_even("x", 2).alias("e")).first()
    assert (r["u"], r["e"]) == (0.13, 0.12)


def test_dict_merge_right_wins(spark):
    df = spark.sql("SELECT map('a', '1', 'b', '2') AS m1, map('b', '3', 'c', '4') AS m2")
    got = df.select(scalars.dict_merge("m1", "m2").alias("m")).first()["m"]
    assert got == {"a": "1", "b": "3", "c": "4"}


def test_label_model_weights_reliable_lfs(spark):
    """Three LFs with accuracies 0.95 / 0.65 / 0.6: the EM posterior should
    match the truth at least as often as majority vote on voted rows."""
    import random
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        y = rng.randint(0, 1)
        votes = []
        for acc, cov in [(0.95, 0.7), (0.65, 0.9), (0.6, 0.9)]:
            if rng.random() < cov:
                votes.append(y if rng.random() < acc else 1 - y)
            else:
                votes.append(-1)
        rows.append((i, y, *votes))
    L = spark.createDataFrame(rows, "id int, y int, a int, b int, c int")
    lm = weak.label_model(L, ["a", "b", "c"], seed=3).withColumn("mv", weak.majority_vote(["a", "b", "c"]))
    voted = lm.filter("greatest(a, b, c) > -1")
    acc_lm = voted.agg(F.avg((F.col("pred") == F.col("y")).cast("double"))).first()[0]
    acc_mv = voted.agg(F.avg((F.col("mv") == F.col("y")).cast("double"))).first()[0]
    assert acc_lm >= acc_mv - 0.01 and acc_lm > 0.8


def numpy_em(patterns, counts, k, steps):
    """The same model fitted by plain arrays."""
    import numpy as np
    obs = patterns + 1
    post = np.stack([(patterns == y).sum(axis=1) + 1.0 / k for y in range(k)], axis=1)
    post /= post.sum(axis=1, keepdims=True)
    for _ in range(steps):
        prior = (counts[:, None] * post).sum(axis=0) + 1.0
        prior /= prior.sum()
        logp = np.log(prior)[None, :].repeat(len(patterns), axis=0)
        for j in range(patterns.shape[1]):
            cond = np.array([[1.0 + (counts * post[:, y])[obs[:, j] == o].sum() for o in range(k + 1)] for y in range(k)])
            cond /= cond.sum(axis=1, keepdims=True)
            logp += np.log(cond[:, obs[:, j]].T)
        post = np.exp(logp - logp.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
    return post


def test_label_model_with_many_functions_and_patterns(spark):
    """Twenty LFs over three classes: thousands of patterns, nothing but parameters on the driver."""
    import numpy as np
    import pytest
    rng = np.random.default_rng(4)
    m, k = 20, 3
    truth = rng.integers(0, k, 3000)
    votes = np.where(rng.random((3000, m)) < 0.6, np.where(rng.random((3000, m)) < 0.5, truth[:, None], rng.integers(0, k, (3000, m))), -1)
    cols = [f"v{j}" for j in range(m)]
    L = spark.createDataFrame([(i, *map(int, row)) for i, row in enumerate(votes)], "id int, " + ", ".join(f"{c} int" for c in cols))
    got = {r["id"]: r for r in weak.label_model(L, cols, cardinality=k, n_epochs=6, tolerance=0.0).select("id", "probs", "pred").collect()}
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    want = numpy_em(patterns, counts.astype(float), k, 6)[inverse.ravel()]
    assert len(patterns) > 2900 and all(np.allclose(got[i]["probs"], want[i], atol=1e-9) for i in range(3000))
    assert np.mean([got[i]["pred"] == truth[i] for i in range(3000)]) > 0.9
    with pytest.raises(Exception, match="outside"):
        weak.label_model(spark.createDataFrame([(1, 7)], "id int, a int"), ["a"])
    assert weak.label_model(L.limit(0), cols, cardinality=k).count() == 0
