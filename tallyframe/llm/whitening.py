"""Embedding whitening by FEAST contour integration.

The covariance is gathered in whole numbers, so it is exact and the same on every run. Its eigenvectors are found
interval by interval: a quadrature of complex shifted solves along a circle projects random vectors onto the span
that belongs to the interval, a Rayleigh-Ritz step extracts the components, and inertia counts of shifted LDL'
factors tell how many there must be, so that none is missed. Rows are then centred, projected and scaled.

Defined results: rows whose vector is null, empty, of another length than most, or holds a null or a non-finite
entry are left out; repeated rows count as often as they stand there; ties between eigenvalues give some orthonormal
basis, the same for all rows; components without spread are left out; an empty table gives no row. The operator reads
the key and the vector only, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, written

#: Fixed values of the contract: entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Quadrature points on the upper half of a contour, and rounds of projection.
POINTS, ROUNDS = 8, 12


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and whole-numbered entries of the rows that count."""
    entries = column(df, vector)
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole = F.transform(entries, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT)
    kept = df.where(entries.isNotNull() & (F.size(entries) > 0) & fine).select(column(df, key).alias("id"), whole.alias("x"))
    sizes = kept.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    usual = sizes.agg(F.max(F.struct("n", -F.col("d"), "d"))["d"].alias("d")).scalar()
    return kept.where(F.size("x") == usual)


def moments(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """n, per-dimension sums and the matrix of product sums about a fixed point near the data: all exact.

    A task adds its rows' products in whole numbers and gives back one row per dimension; the sums of these meet in
    Spark. Entries are taken about SHIFT, so that the numbers stay small; pieces of a sum stay under 2^53.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["x"].to_numpy()) - SHIFT
            own = np.concatenate([x.sum(0)[None], _product_sums(x)])
            total = own.astype(object) if total is None else total + own
            n += len(batch)
        if n:
            # whole numbers of any size travel as two parts
            high, low = total >> 40, total & ((1 << 40) - 1)
            yield pd.DataFrame({
                "row": np.arange(len(total)), "n": [n] + [0] * (len(total) - 1),
                "high": [r.astype(np.int64) for r in high], "low": [r.astype(np.int64) for r in low],
            })

    parts = rows.select("x").mapInPandas(run, "row int, n bigint, high array<bigint>, low array<bigint>")
    spread = parts.select("row", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "v"))
    # a cell comes in once a task; the parts are added as decimals, which do not overflow
    wide = "decimal(38,0)"
    cells = spread.groupBy("row", "at").agg(
        F.sum("n").alias("n"), (F.sum(F.col("v.high").cast(wide)) * F.lit(1 << 40).cast("decimal(14,0)") + F.sum(F.col("v.low").cast(wide))).alias("v")
    ).collect()
    if not cells:
        return 0, np.zeros(0, object), np.zeros((0, 0), object)
    d = max(c["at"] for c in cells) + 1
    out = np.zeros((d + 1, d), object)
    for c in cells:
        out[c["row"], c["at"]] = int(c["v"])
    return max(c["n"] for c in cells if c["row"] == 0), out[0], out[1:]


def _product_sums(x: np.ndarray) -> np.ndarray:
    """x' x in whole numbers: blocks of rows whose sums a float holds exactly go through one matrix product."""
    most = int(np.abs(x).max(initial=1)) or 1
    if most > (1 << 26):
        y = x.astype(object)
        return y.T @ y
    step = max(1, (1 << 53) // (most * most))
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for begin in range(0, len(x), step):
        block = x[begin : begin + step].astype(np.float64)
        total += (block.T @ block).astype(np.int64).astype(object)
    return total


def below(matrix: np.ndarray, shift: float) -> int:
    """Inertia: how many eigenvalues lie below the shift, from the signs of an LDL' factor (Sylvester's law)."""
    a = matrix - shift * np.eye(len(matrix))
    count, k, scale = 0, 0, np.abs(matrix).max() + abs(shift)
    bound = (1 + np.sqrt(17)) / 8
    while k < len(a):
        # Bunch-Kaufman's choice between a pivot of one and of two
        off = np.abs(a[k + 1 :, k])
        r = k + 1 + int(off.argmax()) if len(off) else k
        lead = off.max(initial=0.0)
        pair = False
        if lead > 0 and abs(a[k, k]) < bound * lead:
            row = np.abs(a[k:, r])
            row[r - k] = 0
            if abs(a[k, k]) * row.max() < bound * lead * lead:
                if abs(a[r, r]) >= bound * row.max():
                    a[[k, r]] = a[[r, k]]
                    a[:, [k, r]] = a[:, [r, k]]
                else:
                    a[[k + 1, r]] = a[[r, k + 1]]
                    a[:, [k + 1, r]] = a[:, [r, k + 1]]
                    pair = True
        if pair:
            block = a[k : k + 2, k : k + 2].copy()
            count += int((np.linalg.det(block) < 0) or 2 * (np.trace(block) < 0))
            rest = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
        else:
            pivot = a[k, k] if abs(a[k, k]) > 1e-300 * max(scale, 1) else 1e-300 * max(scale, 1)
            count += int(pivot < 0)
            rest = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(rest, rest) / pivot
            k += 1
    return count


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in (low, high): contour solves, Rayleigh-Ritz, again until nothing moves."""
    d = len(matrix)
    width = min(d, max(count + 4, int(1.5 * count)))
    basis = np.random.default_rng(13).standard_normal((d, width))
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    middle, radius = (low + high) / 2, (high - low) / 2
    eye, before = np.eye(d), None
    for _ in range(ROUNDS):
        projected = np.zeros((d, width))
        for x, w in zip(nodes, weights, strict=True):
            angle = -np.pi / 2 * (x - 1)
            z = middle + radius * np.exp(1j * angle)
            solved = np.linalg.solve(z * eye - matrix, basis.astype(complex))
            projected += w / 2 * np.real(radius * np.exp(1j * angle) * solved)
        q, _ = np.linalg.qr(projected)
        small = q.T @ matrix @ q
        values, turn = np.linalg.eigh((small + small.T) / 2)
        basis = q @ turn
        inside = (values > low) & (values < high)
        now = values[inside]
        if before is not None and len(now) == len(before) == count and np.abs(now - before).max(initial=0) <= 1e-14 * np.abs(matrix).max():
            break
        before = now
    return values[inside], basis[:, inside]


def components(matrix: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenpairs (all that have spread if None), falling, by intervals of a few each.

    An interval is halved until the inertia counts at its ends say it holds few, or until it is a hair wide; what
    FEAST then extracts must be as many, or the interval is projected again from the whole space.
    """
    d = len(matrix)
    wanted = d if wanted is None else min(wanted, d)
    top = float(np.abs(matrix).sum(1).max())  # no eigenvalue is larger in size
    if top == 0:
        return np.zeros(0), np.zeros((d, 0))
    floor = top * d * 1e-15  # below this an eigenvalue is rounding
    top *= 1 + 1e-9
    counts = {floor: below(matrix, floor), top: d}
    open_, found = [(floor, top)], []
    while open_ and sum(len(v) for v, _ in found) < wanted:
        low, high = open_.pop()
        inside = counts[high] - counts[low]
        if not inside:
            continue
        if inside > 8 and high - low > 1e-12 * top:
            half = (low * high) ** 0.5 if low > 0 and high > 4 * low else (low + high) / 2
            # a cut through an eigenvalue would leave its vector at the rim of both contours
            for cut in (half, half + (high - half) * 0.1, half - (half - low) * 0.1):
                near = (high - low) * 1e-4
                if below(matrix, cut - near) == below(matrix, cut + near):
                    break
            counts[cut] = below(matrix, cut)
            open_ += [(low, cut), (cut, high)]  # the upper one is next
            continue
        values, vectors = feast(matrix, low, high, inside)
        if len(values) != inside:
            # nothing may be missed: widen the contour, all directions, and keep what counts inside say
            values, vectors = feast(matrix, low - (high - low) * 0.05, high + (high - low) * 0.05, d)
            keep = np.argsort(np.abs(values - (low + high) / 2), kind="stable")[:inside]
            values, vectors = values[np.sort(keep)], vectors[:, np.sort(keep)]
            if len(values) != inside:
                raise ArithmeticError(f"{inside} components between {low} and {high}, but {len(values)} found")
        found.append((values[::-1], vectors[:, ::-1]))
    if not found:
        return np.zeros(0), np.zeros((d, 0))
    values, vectors = np.concatenate([v for v, _ in found]), np.concatenate([w for _, w in found], axis=1)
    # vectors of neighbouring intervals are orthogonal up to rounding; a QR step takes the rest away
    vectors, r = np.linalg.qr(vectors)
    vectors *= np.sign(np.diag(r))
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


def fitted(rows: DataFrame, wanted: int | None = None) -> dict | None:
    """n, sums S, covariance V, eigenvalues and unit eigenvectors of the rows (id, x); None if there are none."""
    n, sums, products = moments(rows)
    if not n:
        return None
    d = len(sums)
    # n^2 V = n * sum(y y') - (sum y)(sum y)' in whole numbers: centred before anything is rounded
    exact = n * products - np.outer(sums, sums)
    covariance = np.array([[int(c) / (n * n) for c in row] for row in exact])
    values, vectors = components(covariance, wanted)
    return {"n": n, "d": d, "sums": sums + n * SHIFT, "covariance": covariance, "values": values, "vectors": vectors}


def whiten(rows: DataFrame, model: dict) -> DataFrame:
    """id, deviation (exact, a decimal), whitened (one number per component) of the rows (id, x)."""
    n, sums = model["n"], [int(s) for s in model["sums"]]
    centre = [divmod(s, n) for s in sums]  # S / n as a whole part and a rest
    whole = np.array([q for q, _ in centre], np.int64)
    rest = np.array([r / n for _, r in centre])
    scaled = model["vectors"] / np.sqrt(model["values"])

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series(list((np.stack(x.to_numpy()) - whole - rest) @ scaled))

    def off(x: Column, s: Column) -> Column:
        return (x * F.lit(n) - s).cast("decimal(19,0)")

    table = F.array(*[F.lit(s) for s in sums])
    deviation = F.aggregate(
        F.zip_with("x", table, off), F.lit(0).cast("decimal(38,0)"), lambda total, o: (total + o * o).cast("decimal(38,0)")
    )
    return rows.select("id", deviation.alias("deviation"), project("x").alias("whitened"))


def identity_error(whitened: DataFrame, width: int, n: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on the rows themselves."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            if len(batch):
                w = np.stack(batch["whitened"].to_numpy())
                total += np.concatenate([w.sum(0)[None], w.T @ w])
        yield pd.DataFrame({"row": np.arange(width + 1), "v": list(total)})

    parts = whitened.select("whitened").mapInPandas(run, "row int, v array<double>")
    cells = parts.select("row", F.posexplode("v")).groupBy("row", "pos").agg(F.sum("col").alias("v")).collect()
    out = np.zeros((width + 1, width))
    for c in cells:
        out[c["row"], c["pos"]] = c["v"]
    mean = out[0] / n
    return float(np.abs(out[1:] / n - np.outer(mean, mean) - np.eye(width)).max())


def report(embeddings: DataFrame, wanted: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per remaining vector and component up to ``wanted``: its whitened coordinate and the fit's figures.

    The exact deviation is a long where it fits, as the contract has it; a larger one raises an error.
    """
    rows = written(usable(embeddings, key, vector), "vectors")
    model = fitted(rows, wanted)
    schema = f"{key} bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model["values"]):
        return embeddings.sparkSession.createDataFrame([], schema)
    done = written(whiten(rows, model), "whitened")
    error = identity_error(done, len(model["values"]), model["n"])
    explained = model["values"] / np.trace(model["covariance"])
    share = F.get(F.array(*[F.lit(float(e)) for e in explained]), F.col("at"))
    return done.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").cast("bigint").alias(key), (F.col("at") + 1).alias("component"), F.lit(model["n"]).cast("bigint").alias("n"),
        F.col("deviation").cast("bigint").alias("deviation"), "whitened", share.alias("explained"), F.lit(error).alias("identity_error"),
    )
