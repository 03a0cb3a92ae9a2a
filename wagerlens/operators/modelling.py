"""Preprocessing, estimators, grids, cross-validation by person and evaluation."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Estimators by name. Boosted trees are Spark's, on binned features, whatever library the name recalls.
MODELS = ("logistic", "sgd_logloss", "decision_tree", "random_forest", "bagging_tree", "gradient_boosting", "hist_gb", "adaboost", "focal_boosting", "linear_svc", "linear_svc_cal", "mlp")


def feature_columns(df: DataFrame, leave: tuple[str, ...]) -> list[str]:
    """Numeric columns but ids, targets and identities."""
    return [c for c, t in df.dtypes if c not in leave and t in ("double", "float", "int", "bigint", "smallint")]


def expand_grid(spec: dict | list[dict]) -> list[dict]:
    """Every combination of the listed values of each part of a grid, in order."""
    out = []
    for part in spec if isinstance(spec, list) else [spec]:
        names = sorted(part)
        out += [dict(zip(names, values, strict=True)) for values in product(*(part[n] if isinstance(part[n], list) else [part[n]] for n in names))]
    return out


def estimator(model: str, target: str, weight: str | None = None, **params):
    from pyspark.ml import classification as C

    if model == "adaboost":
        return AdaBoost(target, weight=weight, **params)
    if model == "focal_boosting":
        return FocalBoosting(target, **params)
    if model == "linear_svc_cal":
        return CalibratedSvc(target, weight, **params)
    # name: (class, settings that make it what it is called)
    kinds = {
        "logistic": (C.LogisticRegression, {}),
        "sgd_logloss": (C.LogisticRegression, {"elasticNetParam": 0.0, "regParam": 1e-4}),
        "decision_tree": (C.DecisionTreeClassifier, {}),
        "random_forest": (C.RandomForestClassifier, {}),
        "bagging_tree": (C.RandomForestClassifier, {"featureSubsetStrategy": "all"}),
        "gradient_boosting": (C.GBTClassifier, {}),
        "hist_gb": (C.GBTClassifier, {"maxBins": 255}),
        "linear_svc": (C.LinearSVC, {}),
        "mlp": (C.MultilayerPerceptronClassifier, {}),
    }
    kind, own = kinds[model]
    known = {"featuresCol": "features", "labelCol": target} | ({"weightCol": weight} if weight and model != "mlp" else {})
    return kind(**{**known, **own, **params})


def _probability(score: Column) -> Column:
    """The vector (1 - p, p), as classifiers give it."""
    from pyspark.ml.functions import array_to_vector

    p = 1 / (1 + F.exp(-score))
    return array_to_vector(F.array(1 - p, p))


class _Fitted:
    """A fitted model of this module: adds rawPrediction, probability and prediction."""

    def __init__(self, score):
        self._score = score

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        out = self._score(df, "__score")
        out = out.withColumns({"rawPrediction": array_to_vector(F.array(-F.col("__score"), F.col("__score"))), "probability": _probability(F.col("__score"))})
        return out.withColumn("prediction", (F.col("__score") > 0).cast("double")).drop("__score")


class _Staged:
    """An estimator with ``fit``, as the last step of ``fit_steps``."""

    def fit(self, df: DataFrame) -> _Fitted:
        return _Fitted(self._learn(df))


class CalibratedSvc(_Staged):
    """A linear support vector machine whose margin goes through a logistic curve fitted to it."""

    def __init__(self, target: str, weight: str | None = None, **params):
        self.target, self.weight, self.params = target, weight, params

    def _learn(self, df: DataFrame):
        from pyspark.ml import classification as C
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        margin = estimator("linear_svc", self.target, self.weight, **self.params).fit(df)

        def measured(x: DataFrame) -> DataFrame:
            return margin.transform(x).withColumn("__m", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "prediction")

        curve = C.LogisticRegression(featuresCol="__v", labelCol=self.target).fit(VectorAssembler(inputCols=["__m"], outputCol="__v").transform(measured(df)))
        slope, start = float(curve.coefficients[0]), float(curve.intercept)
        return lambda x, name: measured(x).withColumn(name, F.col("__m") * slope + start).drop("__m")


class _Rounds(_Staged):
    """Sums of trees, one a round; each round reads the rows as the last one left them."""

    def _sum(self, df: DataFrame, trees: list, weights: list[float], start: float, name: str) -> DataFrame:
        out = df.withColumn(name, F.lit(start))
        for tree, w in zip(trees, weights, strict=True):
            out = tree.transform(out).withColumn(name, F.col(name) + w * self._vote(F.col("prediction")))
            out = out.drop("prediction", "rawPrediction", "probability")
        return out


class AdaBoost(_Rounds):
    """Discrete boosting of shallow trees: rows that a round gets wrong weigh more in the next."""

    def __init__(self, target: str, weight: str | None = None, rounds: int = 10, depth: int = 1):
        self.target, self.weight, self.rounds, self.depth = target, weight, rounds, depth

    def _vote(self, prediction: Column) -> Column:
        return 2 * prediction - 1

    def _learn(self, df: DataFrame):
        import math

        from pyspark.ml import classification as C

        trees, weights = [], []
        sign = 2 * F.col(self.target) - 1
        base = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        for _ in range(self.rounds):
            now = self._sum(df, trees, weights, 0.0, "__s").withColumn("__w", base * F.exp(-sign * F.col("__s")))
            tree = C.DecisionTreeClassifier(featuresCol="features", labelCol=self.target, weightCol="__w", maxDepth=self.depth).fit(now)
            wrong = tree.transform(now).agg((F.sum(F.when(F.col("prediction") != F.col(self.target), F.col("__w"))) / F.sum("__w")).alias("e")).first()["e"] or 0.0
            if wrong >= 0.5:
                break
            trees.append(tree)
            weights.append(0.5 * math.log((1 - wrong) / max(wrong, 1e-9)))
            if wrong == 0:
                break
        return lambda x, name: self._sum(x, trees, weights, 0.0, name)


def focal_slopes(score: Column, y: Column, gamma: float) -> tuple[Column, Column]:
    """Slope and curvature in the score of the focal loss -(1 - q)^gamma log q, where q is the
    probability of the row's own class."""
    sign = 2 * y - 1
    q = 1 / (1 + F.exp(-sign * score))
    q = F.least(F.greatest(q, F.lit(1e-9)), F.lit(1 - 1e-9))
    miss = 1 - q
    inner = gamma * q * F.log(q) - miss
    slope = sign * F.pow(miss, F.lit(gamma)) * inner
    # d(slope)/d(score), from d q / d score = sign * q * miss
    curve = F.pow(miss, F.lit(gamma)) * q * miss * (gamma * (F.log(q) + 1) + 1 - gamma * inner / miss)
    return slope, F.greatest(curve, F.lit(1e-6))


class FocalBoosting(_Rounds):
    """Boosting by Newton steps on the focal loss: regression trees of slope over curvature, weighted by it."""

    def __init__(self, target: str, gamma: float = 2.0, rounds: int = 10, depth: int = 3, rate: float = 0.3):
        self.target, self.gamma, self.rounds, self.depth, self.rate = target, gamma, rounds, depth, rate

    def _vote(self, prediction: Column) -> Column:
        return prediction

    def _learn(self, df: DataFrame):
        from pyspark.ml.regression import DecisionTreeRegressor

        trees: list = []
        for _ in range(self.rounds):
            now = self._sum(df, trees, [self.rate] * len(trees), 0.0, "__s")
            slope, curve = focal_slopes(F.col("__s"), F.col(self.target).cast("double"), self.gamma)
            now = now.withColumns({"__step": -slope / curve, "__w": curve})
            trees.append(DecisionTreeRegressor(featuresCol="features", labelCol="__step", weightCol="__w", maxDepth=self.depth).fit(now))
        return lambda x, name: self._sum(x, trees, [self.rate] * len(trees), 0.0, name)


class Fitted:
    """Preparation and model, fitted."""

    def __init__(self, before, model):
        self.before, self.model = before, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.before.transform(df))


def fit_steps(df: DataFrame, columns: list[str], model: str, target: str, **params) -> Fitted:
    """Preparation and any model of ``MODELS``, fitted."""
    steps = pipeline(columns, model, target, **params).getStages()
    from pyspark.ml import Pipeline

    before = Pipeline(stages=steps[:-1]).fit(df)
    return Fitted(before, steps[-1].fit(before.transform(df)))


def pipeline(columns: list[str], model: str, target: str, impute: str = "median", scale: bool = True, weight: str | None = None, **params):
    """Imputer, assembler, variance filter, scaler and estimator."""
    from pyspark.ml import Pipeline
    from pyspark.ml import feature as P

    filled = [f"{c}__filled" for c in columns]
    steps = [P.Imputer(strategy=impute, inputCols=columns, outputCols=filled), P.VectorAssembler(inputCols=filled, outputCol="raw", handleInvalid="keep"), P.VarianceThresholdSelector(featuresCol="raw", outputCol="varied" if scale else "features")]
    if scale:
        steps.append(P.StandardScaler(inputCol="varied", outputCol="features", withMean=True))
    return Pipeline(stages=[*steps, estimator(model, target, weight, **params)])


def balanced_weights(df: DataFrame, target: str, name: str = "weight", most: float = 50.0) -> DataFrame:
    """Weights that give both classes the same sum, positives at most ``most``."""
    n = df.agg(F.count(F.when(F.col(target) == 1, 1)).alias("p"), F.count(F.when(F.col(target) == 0, 1)).alias("n")).first()
    return df.withColumn(name, F.when(F.col(target) == 1, min(most, n["n"] / max(1, n["p"]))).otherwise(1.0))


def cross_validate(df: DataFrame, columns: list[str], target: str, grid: list[dict], fold: str = "fold", folds: int = 3) -> list[dict]:
    """Mean and deviation of AUPRC and AUC over folds of people, for each trial of the grid."""
    from statistics import mean, pstdev

    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    out = []
    for trial in grid:
        params = dict(trial)
        model = params.pop("model")
        scores: dict[str, list[float]] = {"areaUnderPR": [], "areaUnderROC": []}
        for k in range(folds):
            fitted = fit_steps(df.filter(F.col(fold) != k), columns, model, target, **params)
            scored = fitted.transform(df.filter(F.col(fold) == k))
            for metric, values in scores.items():
                values.append(BinaryClassificationEvaluator(labelCol=target, metricName=metric).evaluate(scored))
        out.append({**trial, **{f"{m}_{n}": f(v) for m, v in scores.items() for n, f in (("mean", mean), ("std", pstdev))}})
    return sorted(out, key=lambda t: -t["areaUnderPR_mean"])


def threshold_table(scored: DataFrame, score: str, y: str, digits: int = 4) -> DataFrame:
    """Confusion counts, rates, F1, MCC and Youden's J at each score, rounded to ``digits``.

    Rounding bounds the number of thresholds, whatever the rows.
    """
    per = scored.groupBy(F.round(score, digits).alias("threshold")).agg(F.sum(y).alias("p"), F.sum(1 - F.col(y)).alias("n"))
    down = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = per.select("threshold", F.sum("p").over(down).alias("tp"), F.sum("n").over(down).alias("fp"), (F.sum("p").over(every) - F.sum("p").over(down)).alias("fn"), (F.sum("n").over(every) - F.sum("n").over(down)).alias("tn"))
    sens, spec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    mcc = F.try_divide(F.col("tp") * F.col("tn") - F.col("fp") * F.col("fn"), F.sqrt((F.col("tp") + F.col("fp")).cast("double") * (F.col("tp") + F.col("fn")) * (F.col("tn") + F.col("fp")) * (F.col("tn") + F.col("fn"))))
    return t.withColumns({"sensitivity": sens, "specificity": spec, "ppv": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), "npv": F.try_divide(F.col("tn"), F.col("tn") + F.col("fn")), "f1": F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), "mcc": mcc, "youden": sens + spec - 1})


# ------------------------------------------------------------------ search, importances, significance


def search(df: DataFrame, columns: list[str], target: str, trials, fold: str = "fold", folds: int = 3, seconds: float | None = None, metric: str = "areaUnderPR_mean") -> list[dict]:
    """Trials in turn until the time is over; each result is told to ``trials`` if it listens.

    ``trials`` is any iterable of settings, or an object with ``ask`` and ``tell``. A trial
    that fails is kept with its error and doesn't stop the search.
    """
    import time

    began, out = time.monotonic(), []
    asks = trials if not hasattr(trials, "ask") else iter(trials.ask, None)
    for trial in asks:
        if seconds is not None and out and time.monotonic() - began > seconds:
            break
        try:
            done = cross_validate(df, columns, target, [trial], fold, folds)[0]
        except Exception as e:  # noqa: BLE001 - whatever an estimator refuses
            done = {**trial, metric: None, "error": str(e)[:300]}
        out.append(done)
        if hasattr(trials, "tell"):
            trials.tell(trial, done[metric])
    return sorted(out, key=lambda t: -(t[metric] if t[metric] is not None else -1.0))


class ParzenSearch:
    """Settings by the ratio of densities: near the best tried so far, far from the rest.

    ``space`` gives for each model its settings: a list of choices, or (low, high[, "log"])
    for numbers. ``first`` are settings that are tried before any guess.
    """

    def __init__(self, space: dict[str, dict], n: int, first: list[dict] | None = None, seed: int = 42, best: float = 0.25):
        import random

        self.space, self.n, self.waiting, self.best = space, n, list(first or []), best
        self.seen: list[tuple[dict, float]] = []
        self.asked, self.r = 0, random.Random(seed)

    def _draw(self, spec, near):
        import math

        if isinstance(spec, list):
            return near if near in spec and self.r.random() < 0.7 else self.r.choice(spec)
        low, high, log = spec[0], spec[1], len(spec) > 2
        a, b = (math.log(low), math.log(high)) if log else (low, high)
        at = self.r.uniform(a, b) if near is None else min(b, max(a, self.r.gauss(math.log(near) if log else near, (b - a) / 6)))
        value = math.exp(at) if log else at
        return round(value) if isinstance(low, int) and isinstance(high, int) else value

    def _density(self, trial: dict, among: list[dict]) -> float:
        import math

        total = 1e-9
        for other in among:
            if other.get("model") != trial["model"]:
                continue
            p = 1.0
            for k, spec in self.space[trial["model"]].items():
                if isinstance(spec, list):
                    p *= 0.7 if other.get(k) == trial[k] else 0.3 / max(1, len(spec) - 1)
                else:
                    to = math.log if len(spec) > 2 else float
                    p *= math.exp(-0.5 * ((to(trial[k]) - to(other.get(k, trial[k]))) / ((to(spec[1]) - to(spec[0])) / 6 or 1)) ** 2)
            total += p
        return total / max(1, len(among))

    def _guess(self, near: dict | None) -> dict:
        model = near["model"] if near and self.r.random() < 0.8 else self.r.choice(sorted(self.space))
        same = near if near and near["model"] == model else {}
        return {"model": model, **{k: self._draw(spec, same.get(k)) for k, spec in self.space[model].items()}}

    def ask(self) -> dict | None:
        if self.asked >= self.n:
            return None
        self.asked += 1
        if self.waiting:
            return self.waiting.pop(0)
        ranked = [t for t, _ in sorted(self.seen, key=lambda x: -x[1])]
        cut = max(1, int(len(ranked) * self.best))
        good, rest = ranked[:cut], ranked[cut:]
        if len(ranked) < 4:
            return self._guess(None)
        return max((self._guess(self.r.choice(good)) for _ in range(16)), key=lambda t: self._density(t, good) / self._density(t, rest))

    def tell(self, trial: dict, score: float | None) -> None:
        self.seen.append((trial, -1.0 if score is None else score))


def revalidated(df: DataFrame, test: DataFrame, columns: list[str], target: str, trials: list[dict], top: int = 3, fold: str = "fold", folds: int = 5) -> list[dict]:
    """The best trials again over more folds, and each one's scores on the test rows after a fit on all others."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    out = []
    for t in trials[:top]:
        settings = {k: v for k, v in t.items() if k != "error" and not k.startswith("areaUnder")}
        again = cross_validate(df, columns, target, [settings], fold, folds)[0]
        scored = fit_steps(df, columns, settings["model"], target, **{k: v for k, v in settings.items() if k != "model"}).transform(test)
        tested = {f"test_{m}": BinaryClassificationEvaluator(labelCol=target, metricName=m).evaluate(scored) for m in ("areaUnderPR", "areaUnderROC")}
        out.append({**again, **tested})
    return out


def importances(fitted: Fitted, df: DataFrame, columns: list[str], target: str, seed: int = 42) -> list[tuple[str, float]]:
    """Columns by weight: a tree's importances, the size of coefficients, else the loss of area
    under the curve when a column is taken from other rows."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    kept = [columns[i] for i in next((s.selectedFeatures for s in fitted.before.stages if hasattr(s, "selectedFeatures")), range(len(columns)))]
    model = fitted.model
    found = getattr(model, "featureImportances", None)
    if found is None and hasattr(model, "coefficients"):
        found = [abs(x) for x in model.coefficients]
    if found is not None:
        values = list(found.toArray()) if hasattr(found, "toArray") else list(found)
    else:
        judge = BinaryClassificationEvaluator(labelCol=target)
        whole = judge.evaluate(fitted.transform(df))
        values = []
        for c in kept:  # a column's values moved on by one row within hash buckets
            moved = F.lag(c).over(Window.partitionBy(F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(64))).orderBy(F.xxhash64(F.lit(seed + 1), *columns)))
            values.append(whole - judge.evaluate(fitted.transform(df.withColumn(c, F.coalesce(moved, F.col(c))))))
    return sorted(zip(kept, map(float, values), strict=True), key=lambda x: -x[1])


def significance(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """name, means of both classes, Welch's t with its degrees of freedom, and a two-sided p by the normal curve.

    One aggregation over all columns; the p is close from some 30 rows a class on.
    """
    each = []
    for c in columns:
        x = F.col(c).cast("double")
        side = {k: F.when(F.col(target) == k, x) for k in (0, 1)}
        m, v, n = ({k: f(side[k]) for k in side} for f in (F.avg, F.var_samp, F.count))
        a, b = (v[k] / n[k] for k in (0, 1))
        t = F.try_divide(m[1] - m[0], F.sqrt(a + b))
        freedom = F.try_divide(F.pow(a + b, F.lit(2)), F.pow(a, F.lit(2)) / (n[0] - 1) + F.pow(b, F.lit(2)) / (n[1] - 1))
        each.append(F.struct(F.lit(c).alias("name"), m[0].alias("mean_0"), m[1].alias("mean_1"), t.alias("t"), freedom.alias("freedom")))
    rows = df.agg(F.array(*each).alias("r")).select(F.inline("r"))
    # the tail of the normal curve by a rational approximation (error below 2e-7)
    z = F.abs("t") / F.sqrt(F.lit(2.0))
    k = 1 / (1 + 0.3275911 * z)
    tail = k * (0.254829592 + k * (-0.284496736 + k * (1.421413741 + k * (-1.453152027 + k * 1.061405429)))) * F.exp(-z * z)
    return rows.withColumn("p", tail)


def chi_squares(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """name, statistic and degrees of freedom of each column's table of values by class."""
    out = None
    for c in columns:
        cells = df.groupBy(F.col(c).cast("string").alias("v")).pivot(target, [0, 1]).count().na.fill(0)
        every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row per value of a class column
        known = cells.withColumns({"a": F.sum("0").over(every), "b": F.sum("1").over(every)})
        row, n = F.col("0") + F.col("1"), F.col("a") + F.col("b")
        parts = sum((F.try_divide(F.pow(F.col(k) - row * F.col(t) / n, F.lit(2)), row * F.col(t) / n) for k, t in (("0", "a"), ("1", "b"))), F.lit(0.0))
        one = known.agg(F.lit(c).alias("name"), F.sum(parts).alias("statistic"), (F.count("*") - 1).alias("freedom"))
        out = one if out is None else out.union(one)
    return out


def validation_rows(df: DataFrame, key: str, percent: int = 15, name: str = "validation", seed: int = 7) -> DataFrame:
    """Marks people whose rows tell a boosted model when to stop (``validationIndicatorCol``)."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100)) < percent)


def tasks(operators: list[str], models: list[str], variants: list[str], grids: dict[str, list[dict]]) -> list[dict]:
    """Every run that a study asks for, in a fixed order."""
    return [{"operator": o, "model": m, "variant": v, "trial": i, **g} for o, m, v in product(operators, models, variants) for i, g in enumerate(grids.get(m, [{}]))]


def smote(df: DataFrame, columns: list[str], target: str, share: float = 0.2, k: int = 5, seed: int = 42, length: float = 2.0) -> DataFrame:
    """Rows and made-up positives, so that positives are ``share`` of negatives: each lies at random
    between a positive and one of up to ``k`` positives near it.

    Neighbours meet in buckets of random projections; a bucket is dealt into parts of a few
    hundred, so a common bucket isn't compared in pairs. Other columns are null.
    """
    counts = df.agg(F.count(F.when(F.col(target) == 1, 1)).alias("p"), F.count(F.when(F.col(target) == 0, 1)).alias("n")).first()
    lack = int(share * counts["n"]) - counts["p"]
    if lack <= 0 or not counts["p"]:
        return df
    import random

    r = random.Random(seed)
    spread = df.filter(F.col(target) == 1).agg(*(F.stddev_pop(c).alias(c) for c in columns)).first()
    lines = [[r.gauss(0, 1) / (spread[c] or 1.0) for c in columns] for _ in range(2)]
    place = [F.floor(sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * a for c, a in zip(columns, line, strict=True)), F.lit(0.0)) / length) for line in lines]
    x = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns))
    known = df.filter(F.col(target) == 1).select(x.alias("x"), F.xxhash64(*place).alias("b"), F.xxhash64(F.lit(seed), *columns).alias("h"))
    sizes = known.groupBy("b").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / 256)).alias("parts"))
    known = known.join(sizes, "b").withColumn("b", F.xxhash64("b", F.pmod(F.col("h"), F.col("parts")))).drop("parts")
    following = Window.partitionBy("b").orderBy("h")
    near = [F.lead("x", i).over(following) for i in range(1, k + 1)]
    each = -(-lack // counts["p"])
    pairs = known.withColumn("others", F.filter(F.array(*near, F.first("x").over(following)), lambda o: o.isNotNull()))
    made = pairs.select("x", "h", "others", F.explode(F.sequence(F.lit(1), F.lit(each))).alias("i"))
    other = F.element_at("others", (F.pmod(F.xxhash64("h", "i"), F.size("others")) + 1).cast("int"))
    part = F.pmod(F.xxhash64("i", "h", F.lit(seed)), F.lit(10_000)) / 10_000
    made = made.select(F.zip_with("x", other, lambda a, b: a + (b - a) * part).alias("x"))
    new = made.select(F.lit(1).cast(df.schema[target].dataType).alias(target), *(F.col("x")[i].cast(df.schema[c].dataType).alias(c) for i, c in enumerate(columns)))
    return df.unionByName(new, allowMissingColumns=True)
