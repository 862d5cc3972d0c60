"""Block-arrow normal equations: one factor with any number of levels, random intercepts, and all refits.

Unknowns are an effect per level of a *block* factor (Farm), a random effect per year, and few dense terms. Random groups
(location-years) lie inside one block, so once they are resolved the blocks' part of the normal equations is
diagonal: block f has a weight D_f and a row g_f towards years, dense terms and response. Eliminating it leaves the
Schur complement

    Z(t) - sum over f of g_f g_f' / D_f ,

of the size of years + dense terms whatever the number of blocks; log|X'V^-1X| gains the sum of log D_f. As functions of
the log ratio t of the groups' variance all these sums are analytic, so they are taken at Chebyshev nodes
(:mod:`mixed`) and interpolated; the ratio u of the years only adds 1/u to the years' diagonal.

Leaving out one block's rows of one year (a fold) changes one year's sums and one block's row: a downdate of low rank, made
from the block's own sums. A task streams the rows of one block after the other and never holds more than
one block's sums per year, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdcast.operators.mixed import Fit, chebyshev_nodes, independent_columns, interpolation_weights

BLOCK, YEAR = "Farm", "Year"
PART_SALTS = 16                 # tasks that add up partial sums before the driver
CHUNK = 512                     # groups whose outer products are held at once


@dataclass
class Sums:
    """Sums at the nodes, the last entry of the first axis being ratio zero.

    ``z``: arrow without blocks (years, dense, response); ``log_v``: log|V| of the groups; ``log_d``: sum of the blocks'
    log weights; ``raw``: diagonal at ratio zero before blocks are eliminated; ``blocks``: how many of them have rows.
    """
    z: np.ndarray
    log_v: np.ndarray
    log_d: np.ndarray
    raw: np.ndarray
    counts: np.ndarray                  # blocks, rows, sum of log weights

    @staticmethod
    def zero(points: int, size: int) -> Sums:
        return Sums(np.zeros((points, size, size)), np.zeros(points), np.zeros(points), np.zeros(size), np.zeros(3))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.z, self.log_v, self.log_d, self.raw, self.counts

    def copy(self) -> Sums:
        return Sums(*(a.copy() for a in self.parts()))

    def blob(self) -> bytes:
        return np.concatenate([a.ravel() for a in self.parts()]).tobytes()

    @staticmethod
    def read(blob: np.ndarray, points: int, size: int) -> Sums:
        out, at = Sums.zero(points, size), 0
        for a in out.parts():
            a[...] = blob[at:at + a.size].reshape(a.shape)
            at += a.size
        return out


@dataclass(frozen=True)
class Layout:
    """What every task needs to know: nodes, years, number of dense columns with the response, use of blocks."""
    nodes: np.ndarray
    years: tuple
    dense: int
    use_blocks: bool

    @property
    def size(self) -> int:
        return len(self.years) + self.dense

    @property
    def points(self) -> int:
        return len(self.nodes) + 1

    @property
    def ratios(self) -> np.ndarray:
        return np.append(np.exp(self.nodes), 0.0)


class Cell:
    """Sums of one block in one year, from its groups' rows and its Gram matrix."""

    def __init__(self, layout: Layout):
        k, q = layout.points, layout.dense
        self.layout = layout
        self.inner, self.row, self.weight, self.log_v = np.zeros((k, q, q)), np.zeros((k, q)), np.zeros(k), np.zeros(k)
        self.gram = np.zeros(q * q + 2)

    def groups(self, s: np.ndarray, w: np.ndarray) -> None:
        t = self.layout.ratios[:, None]
        for at in range(0, len(w), CHUNK):
            own, ww = s[at:at + CHUNK], w[at:at + CHUNK]
            shrink = 1.0 / (1.0 + t * ww)
            outer = (own[:, :, None] * own[:, None, :]).reshape(len(ww), -1)
            self.inner += ((t * shrink) @ outer).reshape(self.inner.shape)
            self.row += shrink @ own
            self.weight += shrink @ ww
            self.log_v += np.log1p(t * ww).sum(axis=1)

    def add_to(self, total: Sums, year: int, sign: float = 1.0) -> None:
        """Adds its share of the arrow without blocks."""
        y, q = len(self.layout.years), self.layout.dense
        inner = self.gram[:q * q].reshape(q, q) - self.inner
        total.z[:, y:, y:] += sign * inner
        total.z[:, year, y:] += sign * self.row
        total.z[:, y:, year] += sign * self.row
        total.z[:, year, year] += sign * self.weight
        total.log_v += sign * self.log_v
        total.raw[y:] += sign * np.diag(inner[-1])
        total.raw[year] += sign * self.weight[-1]
        total.counts[1:] += sign * self.gram[-2:]


class Block:
    """All years of one block."""

    def __init__(self, layout: Layout, name):
        self.layout, self.name = layout, name
        self.cells: dict[int, Cell] = {}

    def cell(self, year) -> Cell:
        return self.cells.setdefault(self.layout.years.index(year), Cell(self.layout))

    def border(self, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Row g_f and weight D_f at the nodes, one year left out if asked."""
        y = len(self.layout.years)
        row, weight = np.zeros((self.layout.points, self.layout.size)), np.zeros(self.layout.points)
        for i, c in self.cells.items():
            if i != without:
                row[:, i] = c.weight
                row[:, y:] += c.row
                weight += c.weight
        return row, weight

    def add_to(self, total: Sums, sign: float = 1.0, without: int | None = None) -> None:
        """Adds what its elimination changes."""
        row, weight = self.border(without)
        if self.layout.use_blocks and weight[-1] > 0:
            total.z -= sign * row[:, :, None] * row[:, None, :] / weight[:, None, None]
            total.log_d += sign * np.log(weight)
            total.counts[0] += sign


@dataclass
class Solution(Fit):
    years: np.ndarray = None                             # effect of every year of the layout

    def block_effect(self, border: tuple[np.ndarray, np.ndarray], layout: Layout) -> float:
        """A block's effect, from its border at the nodes."""
        at = node_weights(layout, np.array([np.log(self.ratio_group) if self.ratio_group else -np.inf]))[0]
        row, weight = at @ border[0], float(at @ border[1])
        if weight <= 0:
            return np.nan
        return float((row[-1] - row[:-1] @ np.append(self.years, np.nan_to_num(self.beta))) / weight)


def node_weights(layout: Layout, t: np.ndarray) -> np.ndarray:
    """What takes node values to values at log ratios ``t``; the last node is ratio zero itself."""
    zero = np.isneginf(t)
    out = np.zeros((len(t), layout.points))
    out[:, :-1] = interpolation_weights(layout.nodes, np.where(zero, layout.nodes[0], t))
    out[zero] = np.eye(layout.points)[-1]
    return out


class Arrow:
    """REML criterion as a function of both log ratios (-inf is ratio zero)."""

    def __init__(self, sums: Sums, layout: Layout, use_group: bool, use_year: bool):
        self.sums, self.layout, self.use_group, self.use_year = sums, layout, use_group, use_year
        y = len(layout.years)
        self.keep = independent_columns(sums.z[-1][y:-1, y:-1], scale=sums.raw[y:-1])
        self.seen = [i for i in range(y) if sums.raw[i] > 1e-9 * sums.raw[:y].max()] if use_year else []
        self.dense = [y + i for i in self.keep] + [layout.size - 1]
        self.df = sums.counts[1] - sums.counts[0] - len(self.keep)

    def _systems(self, t: np.ndarray, u: np.ndarray):
        """Normal equations (years if any, kept terms, response) on the grid, and the rest of the criterion."""
        at = node_weights(self.layout, t)
        z = np.tensordot(at, self.sums.z, 1)
        rest = at @ (self.sums.log_v + self.sums.log_d) - self.sums.counts[2]
        if np.isneginf(u).all():
            return z[:, None][..., self.dense, :][..., self.dense], rest[:, None]
        ix = [*self.seen, *self.dense]
        mats = np.repeat(z[:, None][..., ix, :][..., ix], len(u), axis=1)
        k = np.arange(len(self.seen))
        mats[:, :, k, k] += np.exp(-u)[None, :, None]
        return mats, rest[:, None] + len(k) * u[None]

    def criterion(self, t: np.ndarray, u: np.ndarray) -> np.ndarray:
        mats, rest = self._systems(t, u)
        xx, xy, yy = mats[..., :-1, :-1], mats[..., :-1, -1], mats[..., -1, -1]
        sign, logdet = np.linalg.slogdet(xx)
        s2 = (yy - (xy * np.linalg.solve(xx, xy[..., None])[..., 0]).sum(-1)) / self.df
        good = (sign > 0) & (s2 > 0)
        return np.where(good, rest + logdet + self.df * np.log(np.where(good, s2, 1.0)), np.inf)

    def optimum(self, near: Fit | None = None) -> Solution:
        """The best ratios; a search around those of ``near`` is enough if it ends inside."""
        zero = np.array([-np.inf])
        lo, hi = self.layout.nodes[-1], self.layout.nodes[0]
        y = len(self.layout.years)
        use_year = self.use_year and len(self.seen) > 0
        wy = max(float(self.sums.raw[:y].mean()), 1e-12)
        t = np.linspace(lo, hi, 25) if self.use_group else zero
        u = np.linspace(np.log(1e-7 / wy), np.log(1e6 / wy), 25) if use_year else zero
        found = None
        if near is not None and (near.ratio_group or not self.use_group) and (near.ratio_year or not use_year):
            box_t = np.log(near.ratio_group) + np.linspace(-1.5, 1.5, 7) if self.use_group else zero
            box_u = np.log(near.ratio_year) + np.linspace(-1.5, 1.5, 7) if use_year else zero
            found = self._search(np.clip(box_t, lo, hi), box_u, 12)
            if any(len(b) > 1 and not b[1] < x < b[-2] for b, x in ((box_t, found[0]), (box_u, found[1]))):
                found = None
        options = [found or self._search(t, u, 14)]
        if self.use_group:
            options.append(self._search(zero, u, 14))
        if use_year:
            options.append(self._search(t, zero, 14))
        if self.use_group and use_year:
            options.append(self._search(zero, zero, 1))
        # a ratio of exactly zero wins ties: that is the singular fit
        options.sort(key=lambda o: (round(o[2], 9), o[0] + o[1]))
        return self.solve(*options[0])

    def _search(self, t: np.ndarray, u: np.ndarray, rounds: int) -> tuple[float, float, float]:
        lo, hi = self.layout.nodes[-1], self.layout.nodes[0]
        step_t, step_u = (x[1] - x[0] if len(x) > 1 else 0.0 for x in (t, u))
        for _ in range(rounds):
            values = self.criterion(t, u)
            i, j = np.unravel_index(np.argmin(values), values.shape)
            best = float(t[i]), float(u[j]), float(values[i, j])
            if step_t:
                t = np.clip(np.linspace(best[0] - step_t, best[0] + step_t, 7), lo, hi)
            if step_u:
                u = np.linspace(best[1] - step_u, best[1] + step_u, 7)
            step_t, step_u = step_t / 3, step_u / 3
        return best

    def solve(self, t: float, u: float, value: float) -> Solution:
        mat = self._systems(np.array([t]), np.array([u]))[0][0, 0]
        kept = np.linalg.solve(mat[:-1, :-1], mat[:-1, -1])
        beta, years = np.full(self.layout.dense - 1, np.nan), np.zeros(len(self.layout.years))
        beta[self.keep] = kept[len(kept) - len(self.keep):]
        if not np.isneginf(u):
            years[self.seen] = kept[:len(self.seen)]
        effects = {y: float(years[i]) for i, y in enumerate(self.layout.years) if i in self.seen}
        return Solution(beta, float((mat[-1, -1] - mat[:-1, -1] @ kept) / self.df), 0.0 if np.isneginf(t) else float(np.exp(t)),
                        0.0 if np.isneginf(u) else float(np.exp(u)), effects, value, years)


# -------------------------------------------------------------------- distributed sums
@dataclass
class Pieces:
    """A row per group (its weighted sums), and these with the Gram sums, in streams of one block after the other."""
    cols: list[str]
    groups: DataFrame
    stream: DataFrame


def pieces(rows: DataFrame, cols: Sequence[str], weight: Column, group: str, salts: int = PART_SALTS) -> Pieces:
    """Both passes over the rows: sums by group inside the JVM, and Gram sums by block and year in salted tasks."""
    from herdcast.operators.mixed import gram_partials
    cols, fold = list(cols), [BLOCK, YEAR]
    rows = rows.withColumn("_w", weight)
    groups = (rows.groupBy(*fold, group).agg(F.sum("_w").alias("_w"), *[F.sum(F.col(c) * F.col("_w")).alias(c) for c in cols])
              .drop(group).persist())
    kinds = dict(rows.dtypes)
    grams = (rows.repartition(*fold, F.pmod(F.xxhash64(group), F.lit(salts))).select(*fold, "_w", *cols)
             .mapInPandas(gram_partials(cols, fold), f"{BLOCK} {kinds[BLOCK]}, {YEAR} {kinds[YEAR]}, blob binary"))
    nothing = F.lit(None).cast("binary")
    both = groups.select(*fold, F.array("_w", *cols).alias("sums"), nothing.alias("gram")).unionByName(
        grams.select(*fold, F.lit(None).cast("array<double>").alias("sums"), F.col("blob").alias("gram")))
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Pieces(cols, groups, both.repartition(width, BLOCK).sortWithinPartitions(*fold).persist())


def _blocks(batches: Iterator[pd.DataFrame], layout: Layout) -> Iterator[Block]:
    current = None
    for pdf in batches:
        for (name, year), part in pdf.groupby([BLOCK, YEAR], sort=False):
            if current is None or name != current.name:
                if current is not None:
                    yield current
                current = Block(layout, name)
            cell = current.cell(year)
            own = [x for x in part["sums"] if x is not None]
            if own:
                own = np.stack(own)
                cell.groups(own[:, 1:], own[:, 0])
            for blob in part["gram"].dropna():
                cell.gram += np.frombuffer(blob)
    if current is not None:
        yield current


def total_sums(p: Pieces, layout: Layout) -> Sums:
    """Sums of all blocks: one matrix of the size of years and terms per node reaches the driver from each of few tasks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Sums.zero(layout.points, layout.size)
        for block in _blocks(batches, layout):
            for year, cell in block.cells.items():
                cell.add_to(total, year)
            block.add_to(total)
        yield pd.DataFrame({"blob": [total.blob()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"blob": [sum(np.frombuffer(b) for b in pdf["blob"]).tobytes()]})

    parts = p.stream.mapInPandas(run, "blob binary").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(PART_SALTS)))
    found = parts.groupBy("salt").applyInPandas(add, "blob binary").collect()
    return Sums.read(sum(np.frombuffer(r["blob"]) for r in found), layout.points, layout.size)


def borders(p: Pieces, layout: Layout, names: Sequence[str]) -> dict:
    """Row and weight at the nodes of a few named blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches, layout):
            row, weight = block.border()
            yield pd.DataFrame({"name": [block.name], "row": [row.tobytes()], "weight": [weight.tobytes()]})

    found = p.stream.where(F.col(BLOCK).isin(list(names))).mapInPandas(run, "name string, row binary, weight binary").collect()
    return {r["name"]: (np.frombuffer(r["row"]).reshape(layout.points, layout.size), np.frombuffer(r["weight"])) for r in found}


def block_effects(p: Pieces, fit: Solution, layout: Layout) -> DataFrame:
    """(Farm, effect) of every block under a fit, from the groups' sums."""
    residual = residual_of(p.cols, F.array(*[F.lit(float(b)) for b in np.nan_to_num(fit.beta)]),
                           F.array(*[F.lit(float(e)) for e in fit.years]), layout)
    shrink = 1.0 / (1.0 + F.lit(fit.ratio_group) * F.col("_w"))
    return p.groups.groupBy(BLOCK).agg((F.sum(shrink * residual) / F.sum(shrink * F.col("_w"))).alias("effect"))


def residual_of(cols: Sequence[str], beta: Column, years: Column, layout: Layout) -> Column:
    """A group's weighted sum of response less dense terms and year."""
    at = F.array_position(F.array(*[F.lit(y) for y in layout.years]), F.col(YEAR)).cast("int")
    total = F.col(cols[-1]) - F.col("_w") * F.element_at(years, at)
    for i, c in enumerate(cols[:-1]):
        total = total - F.col(c) * F.coalesce(beta[i], F.lit(0.0))
    return total


def fit_excluding(p: Pieces, total: Sums, fit: Solution, layout: Layout, use_group: bool, use_year: bool,
                  anchors: Sequence[str]) -> DataFrame:
    """One refit per block and year with its rows left out: Farm, Year, beta, anchor, anchor_effect, own_effect, year_effect, ...

    A task has the whole sums once (broadcast, of the size of years and terms), and makes each refit from them and the
    block's own sums, searching around the whole fit's ratios. ``anchors``: blocks whose effects are wanted; the
    first that still has rows counts. ``own_effect`` is null if the block has no other year.
    """
    spark = p.stream.sparkSession
    shared = spark.sparkContext.broadcast((total, borders(p, layout, anchors) if layout.use_blocks else {}, fit))
    kind = dict(p.stream.dtypes)
    schema = (f"{BLOCK} {kind[BLOCK]}, {YEAR} {kind[YEAR]}, beta array<double>, anchor string, anchor_effect double, own_effect double, "
              "year_effect double, year_effects array<double>, sigma2 double, ratio_group double, ratio_year double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole, ends, start = shared.value
        names = [c.split()[0] for c in schema.split(", ")]
        for block in _blocks(batches, layout):
            rows = []
            for i, cell in block.cells.items():
                rest = whole.copy()
                cell.add_to(rest, i, -1.0)
                block.add_to(rest, -1.0)
                block.add_to(rest, without=i)
                problem = Arrow(rest, layout, use_group, use_year)
                if problem.df <= 0:
                    continue
                f = problem.optimum(near=start)
                anchor, effect, own = None, None, None
                if layout.use_blocks:
                    mine = block.border(without=i)
                    own = f.block_effect(mine, layout)
                    here = {n: own if n == block.name else f.block_effect(b, layout) for n, b in ends.items()}
                    anchor = next(n for n in anchors if n in here and not np.isnan(here[n]))
                    effect, own = here[anchor], None if np.isnan(own) else own
                rows.append([block.name, layout.years[i], [None if np.isnan(b) else float(b) for b in f.beta], anchor, effect, own,
                             float(f.years[i]), f.years.tolist(), f.sigma2, f.ratio_group, f.ratio_year])
            yield pd.DataFrame(rows, columns=names)

    return p.stream.mapInPandas(run, schema)


def every_block_effect(p: Pieces, folds: DataFrame, layout: Layout, levels: Sequence[str]) -> DataFrame:
    """Farm, Year, term, estimate of every block in every refit, relative to the refit's anchor.

    Folds times blocks is the result itself; each fold's blocks are an array expansion and meet their groups by name. The anchor of
    the refit has no term unless it stands in for the first level, whose term is then the missing one.
    """
    pairs = folds.select(F.col(BLOCK).alias("_f"), F.col(YEAR).alias("_y"), "beta", "anchor", "anchor_effect", "year_effects", "ratio_group",
                         F.explode(F.array(*[F.lit(n) for n in levels[1:]])).alias(BLOCK))
    met = pairs.join(p.groups, BLOCK, "left").withColumn("_in", F.col("_w").isNotNull() & ~((F.col(BLOCK) == F.col("_f")) & (F.col(YEAR) == F.col("_y"))))
    shrink = F.when(F.col("_in"), 1.0 / (1.0 + F.col("ratio_group") * F.col("_w")))
    residual = residual_of(p.cols, F.col("beta"), F.col("year_effects"), layout)
    sums = met.groupBy("_f", "_y", BLOCK).agg(F.first("anchor").alias("anchor"), F.first("anchor_effect").alias("_a"),
                                              F.sum(shrink * residual).alias("_r"), F.sum(shrink * F.col("_w")).alias("_d"))
    effect = F.when(F.col(BLOCK) != F.col("anchor"), F.try_divide("_r", "_d") - F.col("_a"))
    return sums.select(F.col("_f").alias(BLOCK), F.col("_y").alias(YEAR), F.concat(F.lit(BLOCK), F.col(BLOCK)).alias("term"), effect.alias("estimate"))
