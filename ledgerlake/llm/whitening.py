"""Whitening of embeddings by exact linear algebra on integers.

1. Every entry c becomes the integer x = floor(1024 c) + 100000. Tasks sum the entries and their products exactly
   (20-bit limbs, so that floating-point products are exact), and n * sum(x x') - S S' is the integer scatter, n^2
   times the covariance.
2. The scatter's characteristic polynomial is found modulo many 31-bit primes, each by reduction to Hessenberg form,
   one prime a row of a Spark table, and put together by Chinese remaindering. The number of primes follows from a
   bound on the coefficients (all eigenvalues are at least 0 and add up to the trace).
3. All roots are real, so the number of sign changes of the polynomial shifted by a is exactly the number of roots
   above a. Halving isolates the largest roots and then narrows them to 2^-128 of the trace.
4. Inverse iteration with that shift, in decimals of 90 digits, one root a row, gives the components. A root that is
   m-fold to that width gives m orthonormal vectors.

What reaches the driver depends on the dimension and on the number of primes only, not on the rows.

Defined results: a row is left out when its vector is null or holds a null, a non-finite or a too large entry (2^52 or
more). The dimension is the most common length of those left, the larger one of equally common; rows of another
length are left out. Components of eigenvalue 0 (fewer rows than components, constant or dependent entries) have a
null `whitened` and no part in `identity_error`, which is null where no component has a positive one. `explained` is 0
there. A vector of dimension d < 8 has d components, one of dimension 0 none. `deviation` is a decimal, null beyond 38
digits. Repeated rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import materialize

DIGITS = 90
PRECISION = 128  # bits of a root, relative to the trace
_LIMB, _LIMBS = 40, 4  # sums travel as four 40-bit limbs
_EXACT_ROWS = 4096  # so many products of 20-bit limbs add up exactly in a double


@dataclass(frozen=True)
class Settings:
    factor: int = 1024
    offset: int = 100_000
    components: int = 8


# ---------------------------------------------------------------- exact sums


def usable(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Key and vector (doubles) of the rows that count."""
    values = F.col(vector).cast("array<double>")
    good = F.forall(values, lambda c: F.coalesce(F.abs(c) < F.lit(float(2**52)), F.lit(False)) & ~F.isnan(c))
    found = rows.select(F.col(key).alias("key"), values.alias("vector")).where(F.coalesce(good, F.lit(False)))
    sizes = found.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).select("d").first()
    return found.where(F.size("vector") == (common["d"] if common else -1))


def integers(batch: pa.RecordBatch, d: int, settings: Settings) -> np.ndarray:
    """floor(factor * c) of every entry, one row a vector; the offset changes neither scatter nor deviation."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(settings.factor * flat.reshape(-1, d)).astype(np.int64)


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x as Python integers."""
    limbs, rest = [], x
    while True:
        low = rest & 0xFFFFF
        if (np.abs(rest) < 1 << 20).all():
            limbs.append(rest)
            break
        limbs.append(low)
        rest = (rest - low) >> 20
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T.astype(float) @ b.astype(float)).astype(np.int64).astype(object) << (20 * (i + j))
    return total


def _to_limbs(values: np.ndarray) -> bytes:
    low = (1 << _LIMB) - 1
    parts = [(values >> (_LIMB * k)) & low for k in range(_LIMBS - 1)] + [values >> (_LIMB * (_LIMBS - 1))]
    return np.stack(parts).astype(np.int64).tobytes()


def _from_limbs(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.int64).reshape(_LIMBS, -1).astype(object)
    return functools.reduce(operator.add, (part << (_LIMB * k) for k, part in enumerate(parts)))


def sums(vectors: DataFrame, d: int, settings: Settings) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of vectors, sum by dimension and sum of products, exact."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            x = integers(batch, d, settings)
            n += len(x)
            for at in range(0, len(x), _EXACT_ROWS):
                part = x[at : at + _EXACT_ROWS]
                total += part.astype(object).sum(axis=0) if np.abs(part).max() >= 1 << 50 else part.sum(axis=0).astype(object)
                products += exact_products(part)
        if n:
            lines = [np.array([n], object), total, *products]
            yield pa.RecordBatch.from_arrays([pa.array(range(d + 2), pa.int32()), pa.array([_to_limbs(x) for x in lines], pa.binary())], ["line", "part"])

    def merge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in frames:
            for line, part in zip(batch.column("line").to_pylist(), batch.column("part").to_pylist()):
                held[line] = held.get(line, 0) + np.frombuffer(part, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["line", "part"])

    schema = "line int, part binary"
    merged = vectors.select("vector").mapInArrow(partial, schema).repartition("line").mapInArrow(merge, schema)
    lines = {r.line: _from_limbs(r.part) for r in merged.collect()}
    return int(lines[0][0]), lines[1], np.stack([lines[i + 2] for i in range(d)])


# ---------------------------------------------------------------- characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller-Rabin, exact below 2^32 with these bases."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    return all(
        (x := pow(base, odd, n)) in (1, n - 1) or any((x := x * x % n) == n - 1 for _ in range(twos - 1)) for base in (2, 3, 5, 7)
    )


def primes_for(bound: int) -> list[int]:
    """The largest 31-bit primes whose product exceeds the bound."""
    found, product = [], 1
    for p in (x for x in count((1 << 31) - 1, -2) if is_prime(x)):
        found.append(p)
        product *= p
        if product > bound:
            return found
    raise AssertionError


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix, modulo p, with zeros below the first subdiagonal."""
    a = a.copy()
    for k in range(len(a) - 2):
        pivots = np.flatnonzero(a[k + 1 :, k])
        if not len(pivots):
            continue
        at = k + 1 + int(pivots[0])
        if at != k + 1:
            a[[k + 1, at]] = a[[at, k + 1]]
            a[:, [k + 1, at]] = a[:, [at, k + 1]]
        times = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :, k:] = (a[k + 2 :, k:] - times[:, None] * a[k + 1, k:] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * times % p).sum(axis=1)) % p
    return a


def polynomial_mod(matrix: list[list[int]], p: int) -> np.ndarray:
    """Coefficients of det(t - matrix) modulo p, lowest power first."""
    d = len(matrix)
    h = hessenberg(np.array([[x % p for x in row] for row in matrix], np.int64).reshape(d, d), p)
    polys = np.zeros((d + 1, d + 1), np.int64)  # row k: the leading k by k block's
    polys[0, 0] = 1
    for k in range(1, d + 1):
        weights, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d]


def _spread(spark: SparkSession, rows: list[tuple], kind: str, fn: Callable[..., tuple], out: str, names: tuple[str, ...]) -> list:
    """fn of each row in a task of its own, as far as there are cores."""
    tasks = max(1, min(len(rows), 4 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_pylist([dict(zip(names, fn(*row)))])

    return spark.createDataFrame(rows, kind).repartition(tasks).mapInArrow(run, out).collect()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix) for a positive semi-definite integer matrix, lowest power first."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # elementary symmetric functions of d numbers >= 0 of sum `trace` are below (1 + trace / d)^d
    bound = 2 * (1 + -(-trace // d)) ** d + 1
    fn = lambda p: (p, polynomial_mod(matrix, p).tolist())
    found = _spread(spark, [(p,) for p in primes_for(bound)], "p long", fn, "p long, poly array<long>", ("p", "poly"))
    values, product = [0] * (d + 1), 1
    for row in found:
        inverse = pow(product, -1, row.p)
        values = [v + product * ((c - v) * inverse % row.p) for v, c in zip(values, row.poly)]
        product *= row.p
    return [v - product if 2 * v > product else v for v in values]


# ---------------------------------------------------------------- roots


def shifted(poly: list[int], by: int) -> list[int]:
    """Coefficients of poly(t + by)."""
    out = list(poly)
    for i in range(len(out) - 1):
        for k in range(len(out) - 2, i - 1, -1):
            out[k] += by * out[k + 1]
    return out


def roots_above(poly: list[int], a: int) -> int:
    """Number of roots greater than a, with multiplicity, of a polynomial whose roots are all real."""
    signs = [c > 0 for c in shifted(poly, a) if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(poly: list[int], trace: int, wanted: int) -> list[tuple[int, int, int]]:
    """(numerator, power of two of the denominator, multiplicity) of the largest positive roots, falling.

    At least `wanted` roots with multiplicity, or all positive ones.
    """
    scale = max(0, PRECISION - trace.bit_length())
    d = len(poly) - 1
    poly = [c << (scale * (d - k)) for k, c in enumerate(poly)]
    high = (trace << scale) + 1
    found, have = [], 0
    open_parts = [(0, high, 0, roots_above(poly, 0))]  # roots in (low, high], `above` more than high
    while open_parts and have < wanted:
        low, high, above, n = open_parts.pop()
        if not n:
            continue
        if n == 1:
            while high - low > 1:
                middle = (low + high) // 2
                value = functools.reduce(lambda v, c: v * middle + c, reversed(poly), 0)
                if value == 0:
                    low, high = middle - 1, middle
                elif (value > 0) == (above % 2 == 0):
                    high = middle
                else:
                    low = middle
        if high - low == 1:
            found.append((high, scale, n))
            have += n
            continue
        middle = (low + high) // 2
        upper = roots_above(poly, middle) - above
        open_parts += [(low, middle, above + upper, n - upper), (middle, high, above, upper)]
    return found


# ---------------------------------------------------------------- components


def null_vectors(matrix: list[list[int]], numerator: int, scale: int, n: int) -> list[list[float]]:
    """n orthonormal vectors of the root numerator / 2^scale, by inverse iteration."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        root = Decimal(numerator) / Decimal(1 << scale)
        a = np.array([[Decimal(x) for x in row] for row in matrix], object).reshape(d, d)
        a[np.arange(d), np.arange(d)] -= root
        tiny = root * Decimal(10) ** -(DIGITS - 10)
        order = list(range(d))
        for k in range(d):
            at = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if at != k:
                a[[k, at]] = a[[at, k]]
                order[k], order[at] = order[at], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k : k + 1] * a[k : k + 1, k + 1 :]
        start = np.random.default_rng(12).integers(1, 1000, (n, d))
        basis = [np.array([Decimal(int(x)) for x in row], object) for row in start]
        for _ in range(3):
            done: list[np.ndarray] = []
            for v in basis:
                v = v[order]
                for k in range(1, d):
                    v[k] -= a[k, :k].dot(v[:k])
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - a[k, k + 1 :].dot(v[k + 1 :]) if k + 1 < d else v[k]) / a[k, k]
                v = v / max(abs(x) for x in v)
                for _ in range(2):
                    for u in done:
                        v = v - u * u.dot(v)
                done.append(v / v.dot(v).sqrt())
            basis = done
        vectors = []
        for v in basis:
            largest = max(range(d), key=lambda i: abs(v[i]))
            vectors.append([float(x if v[largest] > 0 else -x) for x in v])
    return vectors


@dataclass(frozen=True)
class Fit:
    """What whitening needs, of a size that the dimension alone decides."""

    n: int
    totals: list[int]  # sums of floor(factor * c)
    values: list[float]  # eigenvalues of the covariance, falling, positive
    explained: list[float]
    vectors: list[list[float]]
    components: int  # that many are reported


def fit(vectors: DataFrame, d: int, settings: Settings = Settings()) -> Fit:
    n, total, products = sums(vectors, d, settings)
    scatter = (n * products - np.outer(total, total)).tolist()
    trace, wanted = sum(scatter[i][i] for i in range(d)), min(settings.components, d)
    found = []
    if trace and wanted:
        spark = vectors.sparkSession
        found = largest_roots(characteristic_polynomial(spark, scatter), trace, wanted)
        fn = lambda place, numerator, scale, m: (place, null_vectors(scatter, int(numerator), scale, m))
        rows = [(i, str(a), s, m) for i, (a, s, m) in enumerate(found)]
        kinds = "place int, numerator string, scale int, m int", "place long, vectors array<array<double>>"
        solved = {r.place: r.vectors for r in _spread(spark, rows, kinds[0], fn, kinds[1], ("place", "vectors"))}
        found = [(a, s, v) for i, (a, s, _) in enumerate(found) for v in solved[i]][:wanted]
    return Fit(
        n,
        total.tolist(),
        [a / ((n * n) << s) for a, s, _ in found],
        [a / (trace << s) for a, s, _ in found],
        [v for _, _, v in found],
        wanted,
    )


def projected(vectors: DataFrame, d: int, model: Fit, settings: Settings = Settings()) -> DataFrame:
    """key, the sums that make up the deviation, and the whitened values of every row."""
    whole = [t // model.n for t in model.totals]
    rest = [t % model.n for t in model.totals]
    weights = (np.array(model.vectors).reshape(-1, d) / np.sqrt(np.array(model.values))[:, None]).T
    most = max(rest, default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch, d, settings)
            z = x - np.array(whole, np.int64)
            white = (z - np.array(rest, float) / model.n) @ weights
            reach = int(np.abs(z).max(initial=0))
            if reach * max(reach, most) * d < 1 << 62:
                squares = pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
                mixed = pa.array((z * np.array(rest, np.int64)).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                big = z.astype(object)
                squares, mixed = (_decimals((big * y).sum(axis=1)) for y in (big, np.array(rest, object)))
            flat = pa.array(white.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("key"), squares, mixed, lists], ["key", "squares", "mixed", "white"])

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(run, f"key {kind}, squares decimal(38,0), mixed decimal(38,0), white array<double>")


def _decimals(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(x)) if abs(x) < 10**38 else None for x in values], pa.decimal128(38, 0))


def _deviation(model: Fit) -> Column:
    """Sum of (n x - S)^2 from the sums over z = x - floor(S / n) and r = S mod n: n^2 z^2 - 2 n z r + r^2."""
    number = lambda x: F.lit(Decimal(x)).cast("decimal(38,0)") if x < 10**38 else F.lit(None).cast("decimal(38,0)")
    n = model.n
    found = F.try_subtract(F.try_multiply(number(n * n), F.col("squares")), F.try_multiply(number(2 * n), F.col("mixed")))
    return F.try_add(found, number(sum((t % n) ** 2 for t in model.totals))).cast("decimal(38,0)")


RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", settings: Settings = Settings()) -> DataFrame:
    """One row for each usable vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    vectors = materialize(usable(rows, vector, key), "vectors")
    first = vectors.select(F.size("vector").alias("d")).first()
    if first is None or not first["d"]:
        kind = rows.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"`{key}` {kind}, {RESULT}")
    d = first["d"]
    model = fit(vectors, d, settings)
    white = materialize(projected(vectors, d, model, settings), "whitened")
    has = range(len(model.values))
    pairs = [(i, j) for i in has for j in has if i <= j]
    error = None
    if pairs:
        found = white.agg(*(F.covar_pop(F.col("white")[i], F.col("white")[j]) for i, j in pairs)).first()
        error = max(abs(x - (i == j)) for x, (i, j) in zip(found, pairs))
    explained = F.array(*(F.lit(x) for x in [*model.explained, *[0.0] * (model.components - len(has))]))
    place = F.explode(F.sequence(F.lit(1), F.lit(model.components)))
    out = white.select(F.col("key").alias(key), _deviation(model).alias("deviation"), "white", place.alias("component"))
    return out.select(
        key,
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.get("white", F.col("component") - 1).alias("whitened"),
        F.get(explained, F.col("component") - 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
