"""Linear models on all columns against SQL that solves their normal equations (M).

SQL sweeps the matrix of second moments pivot by pivot, which leaves the
inverse, the coefficients and the residual sum in place.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from larkspur.catalog.checked_models import _logistic_slopes, zoned
from larkspur.catalog.registry import query
from larkspur.models import linear
from larkspur.models.discriminant import Discriminant
from larkspur.models.perceptron import Perceptron
from larkspur.operators import encoding
from larkspur.plans.housing import RAW
from larkspur.sources.tables import Tables

C = F.col
Y = "MedHouseVal"
POLY = ["MedInc", "HouseAge", "AveRooms"]


def _sweep(name: str, start: str, size: int, pivots: int) -> str:
    """CTE ``name`` (k, m, ...): the matrix m of ``start``, a list by rows, after k pivots."""
    at = lambda i, j: f"m[({i}) * {size} + ({j}) + 1]"
    d = at("k", "k")
    cell = f"""case when c // {size} = k and c % {size} = k then 1 / {d} when c // {size} = k then {at('k', f'c % {size}')} / {d}
      when c % {size} = k then -{at(f'c // {size}', 'k')} / {d}
      else {at(f'c // {size}', f'c % {size}')} - {at(f'c // {size}', 'k')} * {at('k', f'c % {size}')} / {d} end"""
    return f"""{name} as (select cast(0 as bigint) as k, * from ({start}) union all
      select k + 1, [{cell} for c in range({size * size})], * exclude (k, m) from {name} where k < {pivots})"""


def _moments(columns: list[str], alpha: str = "0e0", scaled: bool = False) -> str:
    """Second moments about the means of ``columns`` and the label, over n; ``alpha`` / n on the diagonal of the columns."""
    whole = [*columns, Y]
    cells = []
    for i, a in enumerate(whole):
        for j, b in enumerate(whole):
            cell = f"covar_pop({a}, {b})"
            if scaled:
                cell += "".join(f" / stddev_pop({c})" for c in (a, b) if c != Y)
            cells.append(cell + (f" + {alpha} / count(*)" if i == j and a != Y else ""))
    return f"select [{', '.join(cells)}] as m, cast(count(*) as double) as n from "


def _rows(columns: list[str], name: str, source: str, alpha: str = "0e0", scaled: bool = False, names: list[str] | None = None) -> str:
    size = len(columns) + 1
    return f"""(with recursive {_sweep('s', _moments(columns, alpha, scaled) + source, size, size - 1)}
      select unnest({names or columns}) as feature, unnest([m[i * {size} + {size}] for i in range({size - 1})]) as {name} from s where k = {size - 1})"""


_STEPS = 4000


def _ols_sql() -> str:
    """Coefficients on standardised columns and two-sided p-values, the t density summed by Simpson's rule."""
    size = len(RAW) + 1
    last = size * size
    point = f"(t * i / {_STEPS}e0)"
    density = f"exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * pow(1 + {point} * {point} / v, -(v + 1) / 2)"
    return f"""select feature, coefficient, greatest(1 - 2 * area, 0) as p_value from (select feature, coefficient, list_sum([
        (case when i = 0 or i = {_STEPS} then 1 when i % 2 = 1 then 4 else 2 end) * {density}
        for i in range({_STEPS + 1})]) * t / {_STEPS}e0 / 3 as area from (select feature, coefficient, least(abs(coefficient / sqrt(var)), 60e0) as t, v from
      (with recursive {_sweep('s', _moments(RAW, scaled=True) + 'blocks', size, size - 1)}
      select unnest({RAW}) as feature, unnest([m[i * {size} + {size}] for i in range({size - 1})]) as coefficient,
        unnest([m[i * {size} + i + 1] * m[{last}] / (n - {size}) for i in range({size - 1})]) as var, n - {size} as v from s where k = {size - 1})))"""


@query("select * from (" + _ols_sql() + ")", "blocks", doubles="coefficient p_value")
def ols(t: Tables):
    """Coefficients and p-values on all eight columns."""
    scaled = encoding.Scaler.fit(t.blocks, RAW).apply(t.blocks)
    fit = linear.fit_ols(scaled, RAW, Y)
    return linear.report(t.spark, fit.coefficients()).join(linear.report(t.spark, linear.p_values(fit), "p_value"), "feature")


@query("select * from " + _rows(RAW, "coefficient", "blocks", "50e0", True), "blocks", doubles="coefficient")
def ridge(t: Tables):
    scaled = encoding.Scaler.fit(t.blocks, RAW).apply(t.blocks)
    return linear.report(t.spark, linear.fit_ridge(scaled, RAW, Y, alpha=50.0).coefficients())


@query("select * from " + _rows(RAW, "coefficient", "blocks"), "blocks", doubles="coefficient")
def linear_regression_plain(t: Tables):
    return linear.report(t.spark, linear.fit_plain(t.blocks, RAW, Y).coefficients())


_PAIRS = list(combinations_with_replacement(POLY, 2))
_TERMS = POLY + [f"{a}_pow_2" if a == b else f"{a}_x_{b}" for a, b in _PAIRS]


@query("select * from " + _rows(_TERMS, "coefficient", f"""(select {', '.join(POLY)}, {', '.join(f'{a} * {b} as {n}' for (a, b), n in zip(_PAIRS, _TERMS[3:]))},
  {Y} from blocks)""", "3e0"), "blocks", doubles="coefficient", digits=5)
def poly_ridge(t: Tables):
    """All nine terms of degree two of three columns."""
    return linear.report(t.spark, linear.fit_poly_ridge(t.blocks, POLY, Y, alpha=3.0).coefficients())


@query(f"select unnest({RAW}) as feature, 0e0 as slope", doubles="slope", digits=3)
def logistic(t: Tables):
    """The slope of the penalised loss at the fitted weights, for all eight columns: nowhere any."""
    data = encoding.Scaler.fit(t.blocks, RAW).apply(zoned(t))
    slopes = _logistic_slopes(data, linear.fit_logistic(data, RAW, "rich"), RAW, "rich", [1])
    return t.spark.createDataFrame([(f, s) for _, f, s in slopes], "feature string, slope double")


@query(f"select cast(k as int) as k, feature, 0e0 as slope from (select unnest([0, 1, 2, 3]) as k), (select unnest({RAW}) as feature)",
       doubles="slope", digits=3)
def logistic_multiclass(t: Tables):
    data = encoding.Scaler.fit(t.blocks, RAW).apply(zoned(t)).withColumn("k", C("zone") - 1)
    fit = linear.fit_logistic(data, RAW, "k", multiclass=True)
    return t.spark.createDataFrame(_logistic_slopes(data, fit, RAW, "k", [0, 1, 2, 3]), "k int, feature string, slope double")


def _lda_sql() -> str:
    p = len(RAW)
    means = ", ".join(f"avg({c}) as a{i}" for i, c in enumerate(RAW))
    pooled = ", ".join(f"sum(({a} - a{i}) * ({b} - a{j})) / (count(*) - 4)" for i, a in enumerate(RAW) for j, b in enumerate(RAW))
    mu = "[" + ", ".join(f"a{i}" for i in range(p)) + "]"
    own = "[" + ", ".join(RAW) + "]"
    return f"""(with recursive mz as (select zone, cast(count(*) as double) as n, {means} from zoned group by 1),
      {_sweep('s', f'select [{pooled}] as m, cast(count(*) as double) as total from zoned join mz using (zone)', p, p)},
      w as (select zone, n / total as prior, {mu} as mu, [list_sum([m[i * {p} + j + 1] * ({mu})[j + 1] for j in range({p})]) for i in range({p})] as w
        from mz, s where k = {p})
      select block_id, prediction from (select block_id, w.zone as prediction, row_number() over (partition by block_id order by
        list_sum([({own})[i + 1] * w[i + 1] for i in range({p})]) - 0.5e0 * list_sum([mu[i + 1] * w[i + 1] for i in range({p})]) + ln(prior) desc) as place
        from zoned, w) where place = 1)"""


@query("select * from " + _lda_sql(), "zoned")
def lda_classifier(t: Tables):
    """Every block's zone from all eight columns."""
    data = zoned(t)
    return Discriminant.fit(data, RAW, "zone").transform(data).select("block_id", "prediction")


# --- parameter mixing, row by row ----------------------------------------------------
PARTS, EPOCHS = 3, 2
MIXED = ["HouseAge", "RoomBand"]


def _epoch_sql(e: int) -> str:
    """CTEs of one epoch: every part's weights after each of its rows, then their average and the mistake rate."""
    dot = "list_dot_product(p.w, r.x) * r.y"
    return f"""p{e} as (select part, cast(0 as bigint) as pos, w, cast(0 as bigint) as mistakes from (select distinct part from ordered), mixed{e - 1}
      union all select p.part, r.pos, case when {dot} <= 0 then [p.w[i] + r.y * r.x[i] for i in range(1, {len(MIXED) + 2})] else p.w end,
        p.mistakes + cast({dot} <= 0 as bigint) from p{e} p join ordered r on r.part = p.part and r.pos = p.pos + 1),
    mixed{e} as materialized (select [{', '.join(f'sum(w[{i + 1}] * pos) / sum(pos)' for i in range(len(MIXED) + 1))}] as w, sum(mistakes) / sum(pos) as rate
      from p{e} join (select part, max(pos) as pos from ordered group by 1) using (part, pos))"""


@query(f"""select * from (with recursive ordered as materialized (select h, cast('0x' || substr(h, 1, 8) as bigint) % {PARTS} as part,
      row_number() over (partition by cast('0x' || substr(h, 1, 8) as bigint) % {PARTS} order by h) as pos, 2e0 * rich - 1 as y,
      [{', '.join(f'cast({c} as double)' for c in MIXED)}, 1e0] as x from (select *, md5(concat(cast(block_id as varchar), ':42')) as h from banded_blocks)),
    mixed0 as (select [{', '.join(['0e0'] * (len(MIXED) + 1))}] as w, 2e0 as rate), {', '.join(_epoch_sql(e + 1) for e in range(EPOCHS))}
    select unnest({MIXED + ['intercept']}) as feature, unnest(w) as weight from (select w from (select w, rate, 1 as e from mixed1 union all
      select w, rate, 2 from mixed2) order by rate, e limit 1))""", "banded_blocks", doubles="weight")
def perceptron(t: Tables):
    """Weights after two epochs of three parts on a table no line separates."""
    from larkspur.catalog.grown import banded_blocks
    fit = Perceptron.fit(banded_blocks(t), MIXED, "rich", "block_id", PARTS, max_iter=EPOCHS)
    return t.spark.createDataFrame(list(zip(MIXED + ["intercept"], fit.weights[0])), "feature string, weight double")
