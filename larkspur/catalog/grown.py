"""Trees, forests and boosted trees node by node against SQL that finds the same trees (M).

Labels are whole numbers, so sums are exact in both engines and equal scores
are equal to the last bit: the first feature and the least cut win in both.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, view
from larkspur.functions import geo
from larkspur.models import grid, grower, linear, trees
from larkspur.models.bayes import GaussianBayes
from larkspur.sources.tables import Tables

C = F.col
FEATURES = ["HouseAge", "AveBedrms", "IncBand", "RoomBand"]
FEW = ["ZoneBand", "IncBand"]
P = grower.PRIME

view("banded_blocks", """select block_id, HouseAge, AveBedrms, floor(MedInc * 4) as IncBand, floor(AveRooms * 2) as RoomBand,
  cast(case when Latitude < 34 then 1 when Latitude < 36 then 2 when Latitude < 38 then 3 else 4 end as double) as ZoneBand,
  round(MedHouseVal * 1e7) as cents, cast(MedHouseVal > 2 as int) as rich from blocks""", "blocks")


def banded_blocks(t: Tables):
    """Blocks with features of few values, the value in whole cents and a class of value."""
    return t.blocks.select(
        "block_id", "HouseAge", "AveBedrms", F.floor(C("MedInc") * 4).cast("double").alias("IncBand"),
        F.floor(C("AveRooms") * 2).cast("double").alias("RoomBand"), geo.latitude_zone(C("Latitude")).cast("double").alias("ZoneBand"),
        F.round(C("MedHouseVal") * 1e7).alias("cents"), (C("MedHouseVal") > 2).cast("int").alias("rich"))


# --- the same trees in SQL ---------------------------------------------------------------
def _levels(p: str, rows: str, width: int, depth: int, ridge: str = "0e0", least: str = "1e0", subset: int | None = None) -> list[str]:
    """CTEs {p}r0 ... {p}b{depth - 1}: rows with their node, and best cuts, level by level.

    ``rows`` is a query of (tree, id, x0 ..., n, w, g).
    """
    out = [f"{p}r0 as materialized (select *, cast(1 as bigint) as node from ({rows}))"]
    columns = ", ".join(f"x{i}" for i in range(width))
    for level in range(depth):
        may = ""
        if subset is not None and subset < width:
            s = f"((tree + 1) * 48271 + node * 69621) % {P}"
            may = f""" and f in (select f2 from (select f2, row_number() over (order by (({s}) * (({s}) + f2 + 1) % {P}) * 16807 % {P}, f2) as o
              from (select unnest(range({width})) as f2)) where o <= {subset})"""
        out.append(f"""{p}c{level} as (select tree, node, f, v, sum(n) as n, sum(w) as w, sum(g) as g from (select tree, node, n, w, g,
          unnest(range({width})) as f, unnest([{columns}]) as v from {p}r{level}) group by all)""")
        out.append(f"""{p}u{level} as (select *, sum(n) over side as nl, sum(w) over side as wl, sum(g) over side as gl, sum(n) over whole as nt,
          sum(w) over whole as wt, sum(g) over whole as gt from {p}c{level}
          window side as (partition by tree, node, f order by v), whole as (partition by tree, node, f))""")
        out.append(f"""{p}b{level} as materialized (select * from (select *, row_number() over (partition by tree, node order by score desc, f, v) as k
          from (select *, gl * gl / (wl + {ridge}) + (gt - gl) * (gt - gl) / (wt - wl + {ridge}) as score, gt * gt / (wt + {ridge}) as own
          from {p}u{level} where nl < nt and wl >= {least} and wt - wl >= {least}{may}))
          where k = 1 and score > own + 1e-12 * abs(own))""")
        out.append(f"""{p}r{level + 1} as materialized (select r.* exclude (node), 2 * r.node + cast([{columns}][b.f + 1] > b.v as bigint) as node
          from {p}r{level} r join {p}b{level} b on r.tree = b.tree and r.node = b.node)""")
    return out


def _nodes(p: str, depth: int, ridge: str = "0e0", rate: str = "1e0") -> str:
    """All nodes: (tree, node, f, v, n, w, value), f null for leaves."""
    parts = []
    for level in range(depth + 1):
        cut = f"left join {p}b{level} b on r.tree = b.tree and r.node = b.node" if level < depth else ""
        f, v = ("any_value(b.f)", "any_value(b.v)") if level < depth else ("null", "null")
        parts.append(f"select r.tree, r.node, {f} as f, {v} as v, sum(r.n) as n, sum(r.w) as w, {rate} * (sum(r.g) / (sum(r.w) + {ridge})) as value "
                     f"from {p}r{level} r {cut} group by r.tree, r.node")
    return " union all ".join(parts)


def _bootstrap(trees: int, columns: list[str], target: str, weight: str = "1e0") -> str:
    """Rows once per tree with their Poisson draws, as ``grower.bootstrap`` has them."""
    hashed = f"cast('0x' || substr(md5(concat(cast(block_id as varchar), ':42')), 1, 8) as bigint) % {P}"
    a, b = ([pow(k, t + 1, P) for t in range(trees)] for k in (16807, 48271))
    times = " + ".join(f"cast(draw >= {p!r} as int)" for p in grower.POISSON)
    xs = ", ".join(f"{c} as x{i}" for i, c in enumerate(columns))
    return f"""select tree, id, {', '.join(f'x{i}' for i in range(len(columns)))}, n, n * wt as w, n * wt * y as g from (select *, cast({times} as double) as n
      from (select *, ((h * a) + b) % {P} / {P}e0 as draw from (select block_id as id, {hashed} as h, {xs}, {target} as y, {weight} as wt,
      unnest(range({trees})) as tree, unnest({a}) as a, unnest({b}) as b from banded_blocks))) where n > 0"""


def _plain(columns: list[str], target: str) -> str:
    xs = ", ".join(f"{c} as x{i}" for i, c in enumerate(columns))
    return f"select cast(0 as bigint) as tree, block_id as id, {xs}, 1e0 as n, 1e0 as w, cast({target} as double) as g from banded_blocks"


def _mids(columns: list[str]) -> str:
    """Thresholds between neighbouring values of a feature."""
    each = " union all ".join(f"select {i} as f, '{c}' as feature, {c} as v from banded_blocks" for i, c in enumerate(columns))
    return f"mids as (select f, feature, v, (v + lead(v) over (partition by f order by v)) / 2 as threshold from (select distinct * from ({each})))"


def _report_sql(ctes: list[str], nodes: str, columns: list[str]) -> str:
    return f"""(with {', '.join([*ctes, _mids(columns)])} select cast(tree as int) as tree, node, m.feature, m.threshold, cast(n as bigint) as n_rows, w as weight,
      value, m.feature is not null as is_split from ({nodes}) x left join mids m on x.f = m.f and x.v = m.v)"""


def _grown_sql(rows: str, columns: list[str], depth: int, **how) -> str:
    return "select * from " + _report_sql(_levels("t", rows, len(columns), depth, **how), _nodes("t", depth), columns)


REPORT = "threshold weight value"


# --- queries ------------------------------------------------------------------------------
@query(_grown_sql(_plain(FEATURES, "cents"), FEATURES, 10), "banded_blocks", doubles=REPORT)
def tree_regressor(t: Tables):
    """Every node of a regression tree of depth 10."""
    return grower.node_report(grower.fit_forest(banded_blocks(t), FEATURES, "cents", grower.Rule(10), 1, bootstrapped=False))


@query(_grown_sql(_plain(FEATURES, "rich"), FEATURES, 10), "banded_blocks", doubles=REPORT)
def tree_classifier(t: Tables):
    """Every node of a tree of depth 10 for two classes; the value is the share of the second."""
    return grower.node_report(grower.fit_forest(banded_blocks(t), FEATURES, "rich", grower.Rule(10), 1, 2, bootstrapped=False))


@query(_grown_sql(_bootstrap(5, FEATURES, "cents"), FEATURES, 8), "banded_blocks", doubles=REPORT)
def forest_regressor(t: Tables):
    """Every node of five bootstrapped trees; large nodes are split from summed cells, small ones in one task."""
    return grower.node_report(grower.fit_forest(banded_blocks(t), FEATURES, "cents", grower.Rule(8), 5, key="block_id", local=400))


@query(_grown_sql(_bootstrap(5, FEATURES, "rich", "case when rich = 1 then 3e0 else 1e0 end"), FEATURES, 8, subset=2), "banded_blocks", doubles=REPORT)
def forest_classifier(t: Tables):
    """Five trees whose nodes choose between two of four features, a rich block weighing three."""
    weighted = banded_blocks(t).withColumn("weight", F.when(C("rich") == 1, 3.0).otherwise(1.0))
    return grower.node_report(grower.fit_forest(
        weighted, FEATURES, "rich", grower.Rule(8, subset=2), 5, 2, "block_id", "weight", local=400))


def _leaf_values(p: str, depth: int, ridge: str, rate: str) -> str:
    """(id, value): the leaf value of every row."""
    nodes = _nodes(p, depth, ridge, rate)
    rows = " union all ".join(f"select id, tree, node from {p}r{level}" for level in range(depth + 1))
    return f"select r.id, x.value from ({rows}) r join ({nodes}) x on r.tree = x.tree and r.node = x.node where x.f is null"


def _boosted_sql(label: str, weight: str, start: str, slopes: tuple[str, str], rounds: int, depth: int, link: str) -> str:
    """Rounds of second-order boosting: margins m0, m1, ... of every block."""
    xs = ", ".join(f"b.{c} as x{i}" for i, c in enumerate(FEW))
    ctes = [f"m0 as (select block_id as id, {start} as m from banded_blocks)"]
    for r in range(rounds):
        g, h = slopes
        rows = f"""select cast(0 as bigint) as tree, id, {', '.join(f'x{i}' for i in range(len(FEW)))}, 1e0 as n, {h} as w, {g} as g from (select m.id, m.m, {xs},
          cast(b.{label} as double) as y, {weight} as wt from m{r} m join banded_blocks b on m.id = b.block_id)"""
        ctes += _levels(f"t{r}", rows, len(FEW), depth, "1e0")
        ctes.append(f"m{r + 1} as materialized (select m.id, m.m + v.value as m from m{r} m join ({_leaf_values(f't{r}', depth, '1e0', '0.1e0')}) v on m.id = v.id)")
    return f"select * from (with {', '.join(ctes)} select id as block_id, {link} as score from m{rounds})"


@query(_boosted_sql("cents", "1e0", "(select avg(cents) from banded_blocks)", ("wt * (y - m)", "wt"), 3, 2, "m"), "banded_blocks", doubles="score", digits=3)
def boosted_regressor(t: Tables):
    """Three rounds of depth 2: every block's prediction."""
    fit = grower.fit_boosting(banded_blocks(t), FEW, "cents", grower.Rule(2, 1.0, 1.0), 3, 0.1)
    return fit.transform(banded_blocks(t)).select("block_id", C("prediction").alias("score"))


_PROB = "(1 / (1 + exp(-m)))"


@query(_boosted_sql("rich", "case when b.rich = 1 then 10e0 else 1e0 end", "0e0", (f"wt * (y - {_PROB})", f"wt * {_PROB} * (1 - {_PROB})"), 3, 2, _PROB),
       "banded_blocks", doubles="score")
def boosted_classifier(t: Tables):
    """Three rounds of depth 2 on the logistic loss, a rich block weighing ten: every block's probability."""
    weighted = banded_blocks(t).withColumn("weight", F.when(C("rich") == 1, 10.0).otherwise(1.0))
    fit = grower.fit_boosting(weighted, FEW, "rich", grower.Rule(2, 1.0, 1.0), 3, 0.1, 2, "weight")
    return fit.transform(banded_blocks(t)).select("block_id", F.get("probability", F.lit(1)).alias("score"))


def _voted_sql(trees: int, depth: int) -> str:
    """Every block's mean leaf value over all trees: each walks each tree's cuts, in its bootstrap or not."""
    ctes = _levels("t", _bootstrap(trees, FEATURES, "cents"), len(FEATURES), depth)
    xs = ", ".join(f"{c} as x{i}" for i, c in enumerate(FEATURES))
    columns = ", ".join(f"x{i}" for i in range(len(FEATURES)))
    ctes.append(f"w0 as (select block_id as id, {xs}, unnest(range({trees})) as tree, cast(1 as bigint) as node from banded_blocks)")
    for level in range(depth):
        ctes.append(f"""w{level + 1} as (select w.* exclude (node), case when b.node is null then w.node
          else 2 * w.node + cast([{columns}][b.f + 1] > b.v as bigint) end as node from w{level} w left join tb{level} b on w.tree = b.tree and w.node = b.node)""")
    return f"""select * from (with {', '.join(ctes)} select id as block_id, avg(value) as prediction from w{depth} w join ({_nodes('t', depth)}) x
      on w.tree = x.tree and w.node = x.node group by id)"""


@query(_voted_sql(5, 8), "banded_blocks", doubles="prediction", digits=2)
def forest_predictions(t: Tables):
    """Every block's mean over five trees."""
    fit = grower.fit_forest(banded_blocks(t), FEATURES, "cents", grower.Rule(8), 5, key="block_id", local=400)
    return fit.transform(banded_blocks(t)).select("block_id", "prediction")


# --- results tables with every score recomputed ------------------------------------------
SETS = {"base": ["HouseAge", "IncBand"], "rooms": ["AveBedrms", "RoomBand"]}
DEPTH = 4

view("split_blocks", """select *, round(cents / 10000) as y, cast('0x' || substr(md5(concat(cast(block_id as varchar), ':42')), 1, 8) as ubigint)
  % 100 < 20 as is_test from banded_blocks""", "banded_blocks")


def split_blocks(t: Tables):
    from larkspur.operators import sampling
    return sampling.split_by_hash(banded_blocks(t).withColumn("y", F.round(C("cents") / 10000)), "block_id")


def _tree_scores(p: str, columns: list[str], target: str) -> tuple[list[str], str]:
    """CTEs, and a query (id, p) of test blocks' leaf values in a tree grown on the train part."""
    xs = ", ".join(f"{c} as x{i}" for i, c in enumerate(columns))
    rows = f"select cast(0 as bigint) as tree, block_id as id, {xs}, 1e0 as n, 1e0 as w, cast({target} as double) as g from split_blocks where not is_test"
    ctes = _levels(p, rows, len(columns), DEPTH)
    each = " union all ".join(f"select {i} as f, {c} as v from split_blocks where not is_test" for i, c in enumerate(columns))
    ctes.append(f"{p}m as (select f, v, (v + lead(v) over (partition by f order by v)) / 2 as level from (select distinct * from ({each})))")
    ctes.append(f"{p}w0 as (select block_id as id, {xs}, cast(1 as bigint) as node from split_blocks where is_test)")
    values = ", ".join(f"x{i}" for i in range(len(columns)))
    for level in range(DEPTH):
        ctes.append(f"""{p}w{level + 1} as (select w.* exclude (node), case when b.node is null then w.node else 2 * w.node
          + cast([{values}][b.f + 1] > m.level as bigint) end as node from {p}w{level} w left join {p}b{level} b on w.node = b.node
          left join {p}m m on b.f = m.f and b.v = m.v)""")
    return ctes, f"select id, value as p from {p}w{DEPTH} join ({_nodes(p, DEPTH)}) using (node)"


def _line_scores(a: str, b: str, alpha: str | None) -> str:
    """(id, p) of least squares on two columns, ridge on scaled ones if ``alpha`` is given."""
    sa, sb = ("1e0", "1e0") if alpha is None else (f"stddev_pop({a})", f"stddev_pop({b})")
    more = "" if alpha is None else f" + {alpha} / count(*)"
    aa, bb, ab = f"(var_pop({a}) / ({sa} * {sa}){more})", f"(var_pop({b}) / ({sb} * {sb}){more})", f"(covar_pop({a}, {b}) / ({sa} * {sb}))"
    ya, yb = f"(covar_pop(y, {a}) / {sa})", f"(covar_pop(y, {b}) / {sb})"
    det = f"({aa} * {bb} - {ab} * {ab})"
    return f"""select block_id as id, my + wa * ({a} - ma) / sa + wb * ({b} - mb) / sb as p from split_blocks, (select avg(y) as my, avg({a}) as ma, avg({b}) as mb,
      {sa} as sa, {sb} as sb, ({ya} * {bb} - {yb} * {ab}) / {det} as wa, ({yb} * {aa} - {ya} * {ab}) / {det} as wb from split_blocks where not is_test) where is_test"""


def _grid_sql() -> str:
    ctes, parts = [], []
    for name, columns in SETS.items():
        more, tree = _tree_scores(f"{name}_", columns, "y")
        ctes += more
        for model, rows in (("OLS", _line_scores(*columns, None)), ("Ridge", _line_scores(*columns, "1e0")), ("Decision Tree", tree)):
            parts.append(f"""select '{name}' as feature_set, '{model}' as model, cast({len(columns)} as int) as n_features,
              1 - avg((y - p) * (y - p)) / var_pop(y) as r2, avg(abs(y - p)) as mae, avg((y - p) * (y - p)) as mse, sqrt(avg((y - p) * (y - p))) as rmse
              from ({rows}) x join split_blocks s on x.id = s.block_id""")
    return f"select * from (with {', '.join(ctes)} {' union all '.join(parts)})"


@query(_grid_sql(), "split_blocks", doubles="r2 mae mse rmse", digits=5)
def model_grid(t: Tables):
    """Three regressors on two feature sets: fitted on the train part, every score of the test part."""
    models = {"OLS": grid.Model(linear.fit_ols), "Ridge": grid.Model(linear.fit_ridge),
              "Decision Tree": grid.Model(lambda d, f, y: trees.fit_grown_regressor(d, f, y, DEPTH), scaled=False)}
    return grid.run_grid(split_blocks(t), SETS, "y", models, grid.score_regression, grid.REG_METRICS)


def _bayes_scores(a: str, b: str) -> str:
    stats = ", ".join(f"avg({c}) as m{i}, var_pop({c}) as v{i}" for i, c in enumerate((a, b)))
    floor = f"(select 1e-9 * greatest(var_pop({a}), var_pop({b})) from split_blocks where not is_test)"
    score = "ln(prior)" + "".join(f" - 0.5e0 * ln(2 * pi() * (v{i} + eps)) - ({c} - m{i}) * ({c} - m{i}) / (2 * (v{i} + eps))" for i, c in enumerate((a, b)))
    return f"""select id, cls as p from (select s.block_id as id, k.cls, row_number() over (partition by s.block_id order by {score} desc, k.cls) as place
      from split_blocks s, (select rich as cls, count(*) / (select count(*) from split_blocks where not is_test) as prior, {floor} as eps, {stats}
      from split_blocks where not is_test group by 1) k where s.is_test) where place = 1"""


def _class_grid_sql() -> str:
    ctes, parts = [], []
    for name, columns in SETS.items():
        more, tree = _tree_scores(f"{name}_", columns, "rich")
        ctes += more
        for model, rows in (("Naive Bayes", _bayes_scores(*columns)), ("Decision Tree", f"select id, cast(p > 0.5e0 as int) as p from ({tree})")):
            hit = "count(*) filter (p = 1 and rich = 1)"
            parts.append(f"""select '{name}' as feature_set, '{model}' as model, cast({len(columns)} as int) as n_features, avg(cast(p = rich as int)) as accuracy,
              coalesce(2e0 * {hit} / nullif(count(*) filter (p = 1) + count(*) filter (rich = 1), 0), 0) as f1,
              coalesce({hit} / nullif(count(*) filter (p = 1), 0), 0) as precision, coalesce({hit} / nullif(count(*) filter (rich = 1), 0), 0) as recall
              from ({rows}) x join split_blocks s on x.id = s.block_id""")
    return f"select * from (with {', '.join(ctes)} {' union all '.join(parts)})"


@query(_class_grid_sql(), "split_blocks", doubles="accuracy f1 precision recall")
def model_grid_classes(t: Tables):
    """Two classifiers on two feature sets, every score of the test part."""
    models = {"Naive Bayes": grid.Model(GaussianBayes.fit, scaled=False),
              "Decision Tree": grid.Model(lambda d, f, y: trees.fit_grown_classifier(d, f, y, DEPTH), scaled=False)}
    return grid.run_grid(split_blocks(t), SETS, "rich", models, grid.score_binary, grid.CLF_METRICS)
