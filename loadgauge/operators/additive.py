"""Additive model per series: a trend that may bend, daily and weekly seasons, and the feature columns, by ridge regression.

One pass sums the cross products of a row's terms per series and segment of time; a series' fit is a small solve on these sums, done
in tasks. Sums of segments add up to those of any longer training part, so all expanding folds of a validation are fitted from
the same pass. Sums are made in map tasks first and added in two steps: a hot series sends one matrix per task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import FEATURES, SeasonalConfig
from ..functions.timegrid import minute_index
from ..session import stage
from .blocks import attach

#: Matrices a task holds before it sends them on, and the groups partial sums are added in first.
HELD, MERGES = 128, 64
SEGMENT, FOLD, SERIES = "_segment", "fold", "_series"


@dataclass(frozen=True)
class Basis:
    """The terms: days are counted from ``start`` in units of ``span``, and the trend may bend at ``bends``."""

    start: float
    span: float
    bends: tuple[float, ...]
    daily: int
    weekly: int
    features: tuple[str, ...]

    @staticmethod
    def of(train: DataFrame, cfg: SeasonalConfig, features: Sequence[str] = FEATURES) -> Basis:
        """Bends are spread evenly over the first part of the whole table's time."""
        first, last = train.agg(F.min(_day()), F.max(_day())).first()
        start, span = first or 0.0, max((last or 0.0) - (first or 0.0), 1.0)
        bends = tuple(cfg.changepoint_range * i / (cfg.changepoints + 1) for i in range(1, cfg.changepoints + 1))
        return Basis(start, span, bends, cfg.daily_order, cfg.weekly_order, tuple(features))

    def terms(self) -> dict[str, Column]:
        t = (_day() - self.start) / self.span
        made = {"level": F.lit(1.0), "trend": t} | {f"bend{i}": F.greatest(t - b, F.lit(0.0)) for i, b in enumerate(self.bends, 1)}
        for name, period, order in (("daily", 1, self.daily), ("weekly", 7, self.weekly)):
            for i in range(1, order + 1):
                angle = F.pmod(_day(), F.lit(float(period))) * F.lit(2 * 3.141592653589793 * i / period)
                made |= {f"{name}_sin{i}": F.sin(angle), f"{name}_cos{i}": F.cos(angle)}
        return made | {c: F.col(c).cast("double") for c in self.features}

    def penalties(self, cfg: SeasonalConfig) -> list[tuple[float, bool]]:
        """Per term the penalty, and whether it is on the coefficient itself instead of on that of the term brought to unit spread.

        Bends are penalised as they are, in spans: one that few rows follow could otherwise turn the trend anywhere.
        """
        return [(0.0, False) if n == "level" else (cfg.changepoint_ridge, True) if n.startswith("bend") else (cfg.ridge, False) for n in self.terms()]


def _day() -> Column:
    return minute_index(F.col("ds")) / F.lit(1440.0)


def _partial(keys: list[str]):
    """Arrow function: rows (keys, segment, x) -> matrices of cross products per (series, segment)."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        by = [*keys, SEGMENT]

        def flush() -> pa.RecordBatch:
            arrays = [pa.array([k[i] for k in held], schema.field(c).type) for i, c in enumerate(by)]
            made = pa.RecordBatch.from_arrays([*arrays, pa.array([m.tobytes() for m in held.values()], pa.binary())], names=[*by, "sums"])
            held.clear()
            return made

        for batch in batches:
            schema = batch.schema
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            # Codes per column and row, so that null keys are a group like any other.
            codes = [batch.column(c).dictionary_encode(null_encoding="encode") for c in by]
            every = np.stack([c.indices.to_numpy(zero_copy_only=False) for c in codes], axis=1)
            groups, member = np.unique(every, axis=0, return_inverse=True)
            order = np.argsort(member, kind="stable")
            for group, rows in zip(groups.tolist(), np.split(order, np.cumsum(np.bincount(member.ravel()))[:-1])):
                key = tuple(c.dictionary[g].as_py() for c, g in zip(codes, group))
                held[key] = held.get(key, 0.0) + x[rows].T @ x[rows]
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    return run


def cross_products(rows: DataFrame, basis: Basis, keys: Sequence[str], target: str) -> DataFrame:
    """(series, segment, sums): the matrix of products of all terms and the target, summed. Rows with a missing number are left out."""
    import numpy as np

    keys = list(keys)
    x = F.array(*basis.terms().values(), F.col(target).cast("double"))
    vectors = rows.select(*keys, F.col(SEGMENT).cast("int").alias(SEGMENT), x.alias("x")).where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    fields = [f for f in vectors.schema.fields if f.name != "x"]
    schema = T.StructType([*fields, T.StructField("sums", T.BinaryType())])
    parts = vectors.mapInArrow(_partial(keys), schema)

    def add(key, table):
        sums = np.sum([np.frombuffer(b) for b in table["sums"].to_pylist()], axis=0)
        return table.slice(0, 1).select([f.name for f in fields]).append_column("sums", pa.array([sums.tobytes()], pa.binary()))

    salted = parts.withColumn("_part", F.spark_partition_id() % MERGES).groupBy(*keys, SEGMENT, "_part")
    return salted.applyInArrow(add, schema).groupBy(*keys, SEGMENT).applyInArrow(add, schema)


def solve(sums, penalties):
    """(coefficients, rows, standard deviation of the residuals) of one matrix of cross products.

    Terms are brought to unit spread first; those without spread get 0.
    """
    import numpy as np

    p = len(penalties)
    m = sums.reshape(p + 1, p + 1)
    n = m[0, 0]
    mean = m[0] / n
    spread = m / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread)[:p], 0))
    used = np.flatnonzero(scale > 1e-9 * np.sqrt(np.maximum(np.diag(m)[:p] / n, 1e-300)))
    used = used[used > 0]
    coefficients = np.zeros(p)
    if len(used):
        a = spread[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        b = spread[used, p] / scale[used]
        weights = np.array([w / scale[i] ** 2 if itself else w for i, (w, itself) in enumerate(penalties) if i in set(used.tolist())])
        coefficients[used] = np.linalg.solve(a + np.diag(weights), b) / scale[used]
    coefficients[0] = mean[p] - mean[1:p] @ coefficients[1:]
    whole = np.append(coefficients, -1.0)
    return coefficients, int(round(n)), float(np.sqrt(max(whole @ m @ whole / n, 0.0)))


def fit_folds(rows: DataFrame, basis: Basis, cfg: SeasonalConfig, folds: int, keys: Sequence[str] = (), target: str = "intensity") -> DataFrame:
    """(series, fold, n, coefficients, sigma): fold k is fitted on the rows of segments below k. ``rows`` have a SEGMENT."""
    import numpy as np

    given, keys = list(keys), list(keys) or [SERIES]
    if not given:
        rows = rows.withColumn(SERIES, F.lit(0))
    penalties = basis.penalties(cfg)
    sums = cross_products(rows.where(F.col(SEGMENT) < folds), basis, keys, target)
    kinds = [f for f in sums.schema.fields if f.name in keys]
    more = [("n", T.LongType()), ("coefficients", T.ArrayType(T.DoubleType())), ("sigma", T.DoubleType())]
    out = T.StructType([*kinds, T.StructField(FOLD, T.IntegerType()), *[T.StructField(n, k) for n, k in more]])

    def run(key, table):
        segments = dict(zip(table[SEGMENT].to_pylist(), table["sums"].to_pylist()))
        total, made = None, []
        for fold in range(1, folds + 1):
            if (held := segments.get(fold - 1)) is not None:
                total = np.frombuffer(held) + (0.0 if total is None else total)
            if total is not None:
                coefficients, n, sigma = solve(total, penalties)
                made.append((fold, n, coefficients.tolist(), sigma))
        columns = [pa.array([k.as_py()] * len(made), table.schema.field(c).type) for c, k in zip(keys, key)]
        kinds_ = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64())
        return pa.table([*columns, *[pa.array(v, k) for v, k in zip(zip(*made), kinds_)]], names=[f.name for f in out.fields])

    found = sums.groupBy(*keys).applyInArrow(run, out)
    return found if given else found.drop(SERIES)


def fitted_value(basis: Basis, coefficients: str = "coefficients") -> Column:
    terms = list(basis.terms().values())
    total = F.col(coefficients)[0]
    for i, term in enumerate(terms[1:], 1):
        total = total + F.col(coefficients)[i] * term
    return total


@dataclass(frozen=True)
class SeriesModel:
    """The terms, and a table of coefficients per series."""

    basis: Basis
    coefficients: DataFrame
    keys: tuple[str, ...]

    def save(self, path: str) -> None:
        spark = self.coefficients.sparkSession
        self.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
        meta = spark.createDataFrame([(*asdict(self.basis).values(), list(self.keys))], _META)
        meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/basis")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SeriesModel:
        *basis, keys = spark.read.schema(_META).parquet(f"{path}/basis").first()
        basis = Basis(*[tuple(v) if isinstance(v, list) else v for v in basis])
        return SeriesModel(basis, spark.read.parquet(f"{path}/coefficients"), tuple(keys))


_META = "start double, span double, bends array<double>, daily int, weekly int, features array<string>, keys array<string>"


class AdditiveSeasonal:
    """A model of its own for each series; a series that was not in the training part has no forecast."""

    name = "additive_seasonal"

    def __init__(self, cfg: SeasonalConfig = SeasonalConfig(), keys: Sequence[str] = (), target: str = "intensity"):
        self.cfg, self.keys, self.target = cfg, list(keys), target

    def on(self, keys: Sequence[str]) -> AdditiveSeasonal:
        return AdditiveSeasonal(self.cfg, keys, self.target)

    def fit(self, train: DataFrame) -> SeriesModel:
        basis = Basis.of(train, self.cfg)
        made = fit_folds(train.withColumn(SEGMENT, F.lit(0)), basis, self.cfg, 1, self.keys, self.target).drop(FOLD)
        return SeriesModel(basis, stage(made, "additive-model"), tuple(self.keys))

    def predict(self, model: SeriesModel, rows: DataFrame) -> DataFrame:
        known = attach(rows, model.coefficients.select(*model.keys, "coefficients"), model.keys)
        return known.select(*rows.columns, fitted_value(model.basis).alias("yhat"))


def gradients(rows: DataFrame, basis: Basis, cfg: SeasonalConfig, coefficients: DataFrame, keys: Sequence[str], target: str = "intensity") -> DataFrame:
    """(series, term, n, gradient): of the penalised squared error in units of the term's and the target's spread, 0 at the solution.

    Made with sums over the rows themselves, not from the matrices the solution came from.
    """
    known = attach(rows, coefficients.select(*keys, "coefficients"), keys).withColumn("_e", F.col(target) - fitted_value(basis))
    sums = []
    for i, (term, x) in enumerate(basis.terms().items()):
        unit = F.when(F.stddev_pop(x) > 0, F.stddev_pop(x))
        sums.append(F.struct(F.lit(term).alias("term"), F.count(x).alias("n"), (F.covar_pop(x, F.col("_e")) if i else F.avg("_e")).alias("pull"), (unit if i else F.lit(1.0)).alias("unit"), F.first(F.col("coefficients")[i]).alias("c")).alias(term))
    spread = F.stddev_pop(target)
    each = known.groupBy(*keys).agg(F.when(spread > 1e-9 * F.abs(F.avg(target)), spread).alias("_spread"), *sums)
    weights = dict(zip(basis.terms(), basis.penalties(cfg)))
    plain, itself = (F.create_map(*[v for n, (w, i) in weights.items() for v in (F.lit(n), F.lit(w if i is kind else 0.0))]) for kind in (False, True))
    long = each.select(*keys, "_spread", F.explode(F.array(*[F.col(t) for t in basis.terms()])).alias("s"))
    unit, held = F.col("s.unit"), F.col("s.c")
    steep = (F.col("s.pull") / unit - plain[F.col("s.term")] * held * unit - itself[F.col("s.term")] * held / unit) / F.col("_spread")
    return long.select(*keys, F.col("s.term").alias("term"), F.col("s.n").alias("n"), F.coalesce(steep, F.lit(0.0)).alias("gradient"))


def segments(rows: DataFrame, cutoffs: Sequence[str]) -> DataFrame:
    """Add SEGMENT: how many of the cutoffs a row's time has reached."""
    reached = [F.when(F.col("ds") >= F.lit(c).cast("timestamp_ntz"), 1).otherwise(0) for c in sorted(cutoffs)]
    return rows.withColumn(SEGMENT, sum(reached[1:], reached[0]))


def refitted(
    rows: DataFrame, cutoffs: Sequence[str], days: int, keys: Sequence[str] = (), cfg: SeasonalConfig = SeasonalConfig(), target: str = "intensity"
) -> tuple[DataFrame, DataFrame, Basis]:
    """Rolling validation with a fit per fold: long predictions (series, fold, ds, y, yhat) of the buckets [cutoff, cutoff + days), each made by the
    coefficients of the rows before the fold's cutoff, and these coefficients. ``rows`` is a stored table."""
    from .forecast import validation_folds

    basis = Basis.of(rows, cfg)
    fits = stage(fit_folds(segments(rows, cutoffs), basis, cfg, len(cutoffs), keys, target), "fold-fits")
    tested = attach(validation_folds(rows, sorted(cutoffs), days), fits.select(*keys, FOLD, "coefficients"), [*keys, FOLD])
    made = tested.select(*keys, FOLD, "ds", F.col(target).alias("y"), fitted_value(basis).alias("yhat"))
    return made, fits, basis
