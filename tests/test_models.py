import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellflow.functions import words
from cellflow.operators.slices import first_value
from cellflow.plans import regression
from cellflow.plans.phases import (
    ALL, RESULTS, Distance, Environment, EvaluateEnvironment, Evaluator, Extractor, Fold, InvalidModel, Model,
    PhaseEnvironment, ScoreEnvironment, Scorer, SideLookup, evaluate_rows, first_value_extractor,
    last_value_extractor, run_model, score_rows, slice_extractor,
)
from cellflow.plans.regression import format_parameters, parse_parameters, predict, train_linear
from cellflow.sources.cell_log import CellColumns, CellLog
from cellflow.sources.cells import CellTable, Version, WideCells
from cellflow.sources.files import ParquetFile, TextFile, text_lines, write_text
from cellflow.sources.requests import ColumnRequest, DataRequest
from tests.helpers import cell_table, cell_view

GROUP = ["column1", "column2"]


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def table(spark, rows):
    return cell_table(cell_view(spark, "family", rows, qualifiers=GROUP))


def scores(frame):
    return sorted(r.score for r in frame.collect())


ONE_COLUMN = [("row1", "column1", 1, "foo"), ("row2", "column1", 1, "bar")]


def test_extract_with_side_data_and_score(spark):  # X31
    side = spark.createDataFrame([(1, "one")], "key int, value string")
    extractor = Extractor(["word", "suffix"], "feature", lambda w, s: F.concat(first_value(w), first_value(w), s),
                          [SideLookup("side_data", 1, "suffix")])
    got = score_rows(table(spark, ONE_COLUMN), {"word": "family:column1"}, Scorer("feature", F.upper), extractor, {"side_data": side})
    assert scores(got) == ["BARBARONE", "FOOFOOONE"] and got.columns == ["entity", "score"]
    with pytest.raises(InvalidModel, match="side_data"):
        score_rows(table(spark, ONE_COLUMN), {"word": "family:column1"}, Scorer("feature", F.upper), extractor)


TWO_COLUMNS = ONE_COLUMN + [("row1", "column2", 1, "baz"), ("row2", "column2", 1, "foo")]


def test_two_features(spark):  # X32
    extractor = Extractor(["a", "b"], ["x1", "x2"], lambda a, b: (F.concat(*[first_value(a)] * 2), F.concat(*[first_value(b)] * 2)))
    scorer = Scorer(["x1", "x2"], lambda a, b: F.concat(F.upper(a), F.upper(b)))
    got = score_rows(table(spark, TWO_COLUMNS), {"a": "family:column1", "b": "family:column2"}, scorer, extractor)
    assert scores(got) == ["BARBARFOOFOO", "FOOFOOBAZBAZ"]


def test_entity_as_input(spark):  # X33
    frame = spark.createDataFrame([("cmpA1", "cmpB1", "v"), ("cmpA2", "cmpB2", "v")], "a string, b string, v string")
    wide = CellTable(["a", "b"], [WideCells(frame, "family", {"a": "a", "b": "b"}, {"column": "v"})])
    extractor = Extractor(["a", "b"], ["c0", "c1"], lambda a, b: (a, b))
    scorer = Scorer(["c0", "c1"], lambda x, y: F.upper(F.concat(x, y)))
    got = score_rows(wide, {"w": "family:column"}, scorer, extractor)
    assert scores(got) == ["CMPA1CMPB1", "CMPA2CMPB2"]


def test_feature_named_like_the_entity(spark):
    extractor = Extractor(["entity", "w"], RESULTS, lambda e, w: (F.concat(e, F.lit("!")), first_value(w)))
    got = score_rows(table(spark, ONE_COLUMN), {"w": "family:column1"}, Scorer(ALL, F.concat), extractor)
    assert sorted(tuple(r) for r in got.collect()) == [("row1", "row1!foo"), ("row2", "row2!bar")]


VERSIONS = [(f"row{i}", "column1", v, f"{w}{v}") for i, w in ((1, "foo"), (2, "bar")) for v in (1, 2)]


def test_selectors(spark):  # X34, X36
    columns = {"word": ColumnRequest("family:column1", max_versions=2)}
    t = table(spark, VERSIONS)
    assert scores(score_rows(t, columns, Scorer(ALL, F.upper), first_value_extractor())) == ["BAR2", "FOO2"]
    assert scores(score_rows(t, columns, Scorer("word", F.upper), last_value_extractor())) == ["BAR1", "FOO1"]
    joined = Scorer(ALL, lambda w: F.array_join(w, "+"))
    assert scores(score_rows(t, columns, joined, slice_extractor())) == ["bar2+bar1", "foo2+foo1"]


def test_no_extractor_and_wildcard(spark):  # X35
    for fields in ("word", ALL):
        got = score_rows(table(spark, ONE_COLUMN), {"word": "family:column1"}, Scorer(fields, first_value))
        assert scores(got) == ["bar", "foo"]


def test_missing_columns_in_score(spark):
    columns = {"a": "family:column1", "b": "family:column2"}
    t = table(spark, TWO_COLUMNS[:-1])
    scorer = Scorer(["a", "b"], lambda a, b: F.concat(first_value(a), first_value(b)))
    assert scores(score_rows(t, columns, scorer, on_missing="skip")) == ["foobaz"]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        score_rows(t, columns, scorer).collect()
    sizes = Scorer(["a", "b"], lambda a, b: F.size(a) * 10 + F.size(b))
    assert scores(score_rows(t, columns, sizes)) == [10, 11]


def test_pandas_function(spark):
    @F.pandas_udf("string")
    def shout(words):
        return words.str.upper() + "!"

    got = score_rows(table(spark, ONE_COLUMN), {"word": "family:column1"}, Scorer("word", shout), first_value_extractor())
    assert scores(got) == ["BAR!", "FOO!"]


def test_arity_and_unknown_fields(spark):
    with pytest.raises(InvalidModel):
        Extractor(["a", "b"], "x", lambda a: a)
    with pytest.raises(InvalidModel):
        Scorer(["a"], lambda a, b: a)
    with pytest.raises(InvalidModel, match="nope"):
        score_rows(table(spark, ONE_COLUMN), {"word": "family:column1"}, Scorer("nope", first_value))
    with pytest.raises(InvalidModel, match="2 values"):
        score_rows(table(spark, ONE_COLUMN), {"word": "family:column1"}, Scorer("word", lambda w: w),
                   Extractor("word", "x", lambda w: (w, w)))


# --- evaluate ---


def test_evaluate(spark):  # X38
    rows = spark.createDataFrame([(1.0, 1.0), (4.0, 1.5)], "c1 double, c2 double")
    distance = Distance(["c1", "c2"], "distance", lambda a, b: F.abs(a - b))
    assert [r.distance for r in evaluate_rows(rows, Evaluator(distance)).collect()] == [0.0, 2.5]
    total = Evaluator(distance, {"total": F.sum("distance")})
    assert evaluate_rows(rows, total).collect() == [(2.5,)]
    fold = Fold(["distance"], lambda: 0.0, lambda s, b: s + b.distance.sum(), lambda a, b: a + b, lambda s: s, "total")
    assert evaluate_rows(rows, Evaluator(distance, fold)).collect() == [(2.5,)]


# --- life cycle ---


def test_phase_rules():
    step, scorer = (lambda inputs, context: None), Scorer("a", lambda a: a)
    evaluator = Evaluator(Distance(["a"], "d", lambda a: a))
    for bad in ({}, {"prepare": step, "scorer": scorer}, {"prepare": step, "evaluator": evaluator},
                {"prepare": step, "train": step, "evaluator": evaluator}, {"train": step, "evaluator": evaluator},
                {"extractor": first_value_extractor(), "train": step}):
        with pytest.raises(InvalidModel):
            Model(**bad)
    for good in ({"prepare": step}, {"prepare": step, "train": step}, {"scorer": scorer}, {"evaluator": evaluator},
                 {"prepare": step, "train": step, "scorer": scorer, "evaluator": evaluator}, {"train": step, "scorer": scorer}):
        Model(**good)


def test_iterative_prepare(spark, path):  # X30
    log = CellLog(spark, path, {"entity": "string"}, {"family:column1": "string", "family:column2": "string"}).create()
    start = spark.createDataFrame([("row1", "foo"), ("row2", "bar")], "entity string, w string")
    log.write(start, {"w": "family:column1"}, version=F.lit(1))

    def prepare(inputs, context):
        twice = inputs["words"].select("entity", F.repeat(first_value("w"), 2).alias("w"))
        again = context.publish("doubled", twice)
        return {"doubled": again.select("entity", F.repeat(first_value("w"), 2).alias("w"))}

    environment = Environment(prepare=PhaseEnvironment({"words": CellColumns(log, {"w": "family:column1"})},
                                                       {"doubled": CellColumns(log, {"w": "family:column2"})}))
    assert run_model(spark, Model(prepare=prepare), environment) == {"prepare": True}
    got = log.scan({"w": "family:column2"}).select("entity", first_value("w").alias("w")).collect()
    assert {r.entity: r.w for r in got}["row1"] == "foofoofoofoo"


def test_life_cycle(spark, path):  # X29, X37
    log = CellLog(spark, f"{path}/words", {"entity": "string"}, {"family:column1": "string"}).create()
    counts = CellLog(spark, f"{path}/counts", {"entity": "string"},
                     {"family:size": "bigint", "family:average": "string", "family:score": "string", "family:truth": "string"}).create()
    log.write(spark.createDataFrame([(f"row{i}", w) for i, w in enumerate(["foo", "bar", "bar"])], "entity string, w string"),
              {"w": "family:column1"})

    def prepare(inputs, context):
        word = first_value("w").alias("entity")
        return {"counts": inputs["words"].groupBy(word).agg(F.count("*").alias("size"))}

    def train(inputs, context):
        mean = inputs["counts"].agg(F.avg(first_value("size")).alias("v"))
        unit = context.arguments["unit"]
        return {"average": mean.select(F.lit("AVERAGE").alias("entity"), F.concat(F.col("v").cast("string"), F.lit(unit)).alias("v"))}

    side = spark.createDataFrame([(1, "one")], "key int, value string")
    extractor = Extractor(["avg", "side"], "x", lambda a, s: F.concat(first_value(a), first_value(a), s), [SideLookup("side", 1, "side")])
    evaluator = Evaluator(Distance(["a", "b"], "d", lambda a, b: F.levenshtein(a, b)), {"worst": F.max("d")})
    model = Model(prepare, train, extractor, Scorer("x", F.upper), evaluator)
    environment = Environment(
        PhaseEnvironment({"words": CellColumns(log, {"w": "family:column1"})}, {"counts": CellColumns(counts, {"size": "family:size"})}),
        PhaseEnvironment({"counts": CellColumns(counts, {"size": "family:size"})}, {"average": CellColumns(counts, {"v": "family:average"})}),
        ScoreEnvironment(counts, {"avg": "family:average"}, CellColumns(counts, {"score": "family:score"}), {"side": side}),
        EvaluateEnvironment(counts, {"a": "family:score", "b": "family:average"}, ParquetFile(f"{path}/eval")),
    )
    outcome = run_model(spark, model, environment, arguments={"unit": " units"})
    assert outcome == dict.fromkeys(["prepare", "train", "score", "evaluate"], True)
    got = counts.scan({"size": "family:size"}).select("entity", first_value("size").alias("n")).collect()
    assert {r.entity: r.n for r in got} == {"foo": 1, "bar": 2}
    got = counts.scan({"s": "family:score"}).select("entity", first_value("s").alias("s")).collect()
    assert [tuple(r) for r in got] == [("AVERAGE", "1.5 UNITS1.5 UNITSONE")]
    assert ParquetFile(f"{path}/eval").read(spark).count() == 1
    assert run_model(spark, model, environment, skip=["prepare", "train", "evaluate"]) == {"score": True}
    with pytest.raises(InvalidModel):
        run_model(spark, model, environment, skip=["nope"])
    with pytest.raises(InvalidModel, match="train"):
        run_model(spark, model, Environment(prepare=environment.prepare, score=environment.score, evaluate=environment.evaluate))


def test_failing_phase_stops_the_run(spark):
    ran = []
    model = Model(prepare=lambda i, c: False, train=lambda i, c: ran.append(1))
    nothing = PhaseEnvironment({}, {})
    assert run_model(spark, model, Environment(nothing, nothing)) == {"prepare": False} and not ran


# --- regression ---

LINE = [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]


def test_one_step(spark):  # X28
    data = spark.createDataFrame(LINE, "x double, y double")
    start = spark.createDataFrame([(1, 0.0, 9.2e18), (0, 0.0, 9.2e18)], "index int, theta double, gradient double")
    for parameters in (None, [0, 0], start):
        got = train_linear(data, ["x"], "y", parameters, max_iterations=1)
        assert [tuple(r)[:3] for r in got.orderBy("index").collect()] == [(0, 0.75, 3.0), (1, 1.25, 5.0)]


def reference_descent(rows, theta, rate, steps, epsilon):
    gradient, n = None, 0
    for _ in range(steps):
        if gradient is not None and sum(g * g for g in gradient) ** 0.5 < epsilon:
            break
        gradient = [0.0] * len(theta)
        for *x, y in rows:
            x = [1.0, *x]
            off = y - sum(a * b for a, b in zip(theta, x))
            gradient = [g + off * v for g, v in zip(gradient, x)]
        theta = [t + rate * g for t, g in zip(theta, gradient)]
        n += 1
    return theta, gradient, n


def test_many_steps_equal_direct_descent(spark):
    rows = [(0.1 * i, (i * 7 % 5) / 5, 1.0 + 0.3 * i - (i * 7 % 5) / 5) for i in range(12)]
    data = spark.createDataFrame(rows, "a double, b double, y double").repartition(3)
    for steps, epsilon in ((7, 0.001), (100, 0.5), (100, 0.001)):
        got = train_linear(data, ["a", "b"], "y", [0.1, 0.2, 0.3], 0.03, steps, epsilon).orderBy("index").collect()
        theta, gradient, n = reference_descent(rows, [0.1, 0.2, 0.3], 0.03, steps, epsilon)
        assert [r.theta for r in got] == pytest.approx(theta) and [r.gradient for r in got] == pytest.approx(gradient, abs=1e-9)
        assert {r.iterations for r in got} == {n}


def test_many_features_equal_direct_descent(spark, monkeypatch):
    n, features = 400, 200
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(n), rng.standard_normal((n, features))])
    y = x @ rng.standard_normal(features + 1) + rng.standard_normal(n)
    data = spark.createDataFrame([(*map(float, r[1:]), float(t)) for r, t in zip(x, y)], ", ".join(f"f{i} double" for i in range(features)) + ", y double")
    data = data.unionByName(data.limit(1).withColumn("f3", F.lit(None).cast("double"))).repartition(5)  # a row without a feature is left out
    names = [f"f{i}" for i in range(features)]
    got = train_linear(data, names, "y", learning_rate=F.lit(0.2) / F.count("*"), max_iterations=30).orderBy("index").collect()
    theta, rate = np.zeros(features + 1), 0.2 / n
    for _ in range(30):
        gradient = x.T @ (y - x @ theta)
        theta = theta + rate * gradient
    assert np.allclose([r.theta for r in got], theta) and np.allclose([r.gradient for r in got], gradient) and {r.iterations for r in got} == {30}
    with pytest.raises(Exception, match="diverged"):
        train_linear(data, names, "y", learning_rate=10.0, max_iterations=500).collect()
    with pytest.raises(ValueError):
        train_linear(data, names, "y", [0.0])
    # the wide way gives what the aggregate gives, also from a start
    few, start = [*names[:3]], spark.createDataFrame([(i, 0.1 * i, 5.0) for i in range(4)], "index int, theta double, gradient double")
    aggregate = [tuple(r) for r in train_linear(data, few, "y", start, 0.001, 20).orderBy("index").collect()]
    monkeypatch.setattr(regression, "WIDE", 1)
    assert np.allclose([tuple(r) for r in train_linear(data, few, "y", start, 0.001, 20).orderBy("index").collect()], aggregate)


def test_converged_start_stays(spark):
    data = spark.createDataFrame(LINE, "x double, y double")
    start = spark.createDataFrame([(0, 0.5, 0.0), (1, 0.5, 1e-6)], "index int, theta double, gradient double")
    got = train_linear(data, ["x"], "y", start).orderBy("index").collect()
    assert [(r.theta, r.iterations) for r in got] == [(0.5, 0), (0.5, 0)]


def test_divergence_is_reported(spark):
    data = spark.createDataFrame([(float(i), 3.0 * i) for i in range(100)], "x double, y double")
    with pytest.raises(Exception, match="diverged"):
        train_linear(data, ["x"], "y", max_iterations=1000).collect()
    with pytest.raises(ValueError):
        train_linear(data, ["x"], "y", [0.0])
    scaled = train_linear(data, [(F.col("x") - 49.5) / 28.9], "y", learning_rate=F.lit(0.5) / F.count("*")).orderBy("index").collect()
    assert scaled[0].theta == pytest.approx(148.5) and scaled[1].theta == pytest.approx(86.7)


def test_parameters_as_text(spark, path):  # M16
    data = spark.createDataFrame(LINE, "x double, y double")
    write_text(format_parameters(train_linear(data, ["x"], "y", max_iterations=1)), path + "/p")
    state = parse_parameters(text_lines(spark, path + "/p"))
    assert sorted(tuple(r) for r in state.collect()) == [(0, 0.75, 3.0), (1, 1.25, 5.0)]
    again = train_linear(data, ["x"], "y", state, max_iterations=1).orderBy("index").collect()
    theta, _, _ = reference_descent(LINE, [0.0, 0.0], 0.25, 2, 0.001)
    assert [r.theta for r in again] == theta
    assert data.select(predict(["x"], [1.0, 2.0]).alias("p")).collect()[2].p == 5.0


def test_versions_in_model_request(spark):
    request = DataRequest({"word": ColumnRequest("family:column1", max_versions=5)})
    got = score_rows(table(spark, VERSIONS), request, Scorer("word", F.size))
    assert scores(got) == [2, 2]
    assert RESULTS != ALL and Version.number("x") is not None and TextFile("x").path == "x" and words("x") is not None
