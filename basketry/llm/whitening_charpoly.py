"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

An entry c becomes the integer floor(256 c). Tasks sum the products of the distinct integer vectors,
each exactly; they give n and the integer scatter M = n sum(x x') - S S', which is n^2 times the
covariance. M is reduced to Hessenberg form modulo many primes, one prime a row, and the recurrence
of its leading minors gives the characteristic polynomial modulo each. Chinese remaindering, per
coefficient, makes the integer polynomial; a bound of its coefficients says how many primes do.

All its roots are real, so the sign changes of the polynomial moved to a point count, exactly and
with multiplicity, the roots beyond that point. Bisection on that count isolates each wanted root,
bisection on the sign refines it to ``ROOT_BITS`` bits. Components span the null space of M less the
root: inverse iteration in ``DIGITS`` decimal digits, each orthogonal to those before with an equal
root. A component points so that its largest entry (the first of equals) is positive. Roots of 0 have
no component, as nothing could be divided by their square root.

Rows whose vector is null, empty or holds null, NaN or infinity are left out, as are vectors of
another length than most have (the longer of equals). Repeated rows are kept in the result and count
once in the fit; ids are not looked at and may be null or repeated. An empty table, and one of equal
vectors, gives no rows. ``deviation`` must fit 64 bits, otherwise the query fails rather than wraps.
What leaves the tasks is bounded by the square of the dimension.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import BATCH_ROWS, stage, unstage

SCALE = 256
COMPONENTS = 4
#: Bits of a root relative to the largest possible one; digits of inverse iteration.
ROOT_BITS, DIGITS = 220, 110
#: Primes lie below this, so that products of residues fit 64 bits.
PRIME_LIMIT = 1 << 31
#: Floats add integers exactly up to here.
EXACT = 1 << 53


def integer_vectors(table: DataFrame, vector: str, *keep: str) -> DataFrame:
    """``keep`` and ``x``, the integers of every usable vector of the common length."""
    entry = F.col(vector).cast("array<double>")
    whole = table.select(*keep, entry.alias("_v")).filter(
        F.col("_v").isNotNull() & (F.size("_v") > 0)
        & ~F.exists("_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    lengths = whole.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    wanted = lengths[0]["d"] if lengths else 0
    return whole.filter(F.size("_v") == wanted).select(
        *keep, F.transform("_v", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def exact_products(x: np.ndarray) -> list[list[int]]:
    """Products of columns, summed over rows without rounding."""
    largest = int(np.abs(x).max()) if x.size else 0
    if largest < 1 << 26 and len(x):
        rows = max(1, EXACT // max(1, largest * largest))
        total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
        for at in range(0, len(x), rows):
            part = x[at:at + rows].astype(np.float64)
            total = total + (part.T @ part).astype(np.int64).astype(object)
        return total.tolist()
    wide = x.astype(object)
    return (wide.T @ wide).tolist()


def moments(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """``(n, sums, products)`` over the rows of ``x``; a row per matrix row leaves each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(batch.num_rows, -1)
            part = np.array(exact_products(np.hstack([np.ones((len(x), 1), np.int64), x])), dtype=object)
            total = part if total is None else total + part
        if total is not None:
            size = len(total)
            cells = [(i, j, decimal.Decimal(int(total[i, j]))) for i in range(size) for j in range(i, size)]
            i, j, value = zip(*cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value, pa.decimal128(38, 0))], ["i", "j", "value"])

    rows = fit.select("x").mapInArrow(run, "i int, j int, value decimal(38, 0)").groupBy("i", "j").agg(
        F.sum("value").alias("value")).collect()
    if not rows:
        return 0, [], []
    size = max(r["j"] for r in rows) + 1
    full = [[0] * size for _ in range(size)]
    for r in rows:
        full[r["i"]][r["j"]] = full[r["j"]][r["i"]] = int(r["value"])
    return full[0][0], full[0][1:], [row[1:] for row in full[1:]]


def scatter(n: int, sums: list[int], products: list[list[int]]) -> list[list[int]]:
    return [[n * products[i][j] - sums[i] * sums[j] for j in range(len(sums))] for i in range(len(sums))]


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients modulo ``p``, the leading 1 first, of the characteristic polynomial."""
    h, d = matrix.copy() % p, len(matrix)
    for k in range(1, d - 1):  # to Hessenberg form by similarity
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        at = k + int(below[0])
        if at != k:
            h[[k, at]] = h[[at, k]]
            h[:, [k, at]] = h[:, [at, k]]
        inverse = pow(int(h[k, k - 1]), -1, p)
        factors = h[k + 1:, k - 1] * inverse % p
        h[k + 1:] = (h[k + 1:] - factors[:, None] * h[k] % p) % p
        # Columns k+1.. times factors go to column k; products are reduced before they are added.
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factors % p).sum(axis=1)) % p
    minors = [np.array([1], np.int64)]  # lowest power first
    for k in range(d):
        grown = np.zeros(k + 2, np.int64)
        grown[1:] = minors[k]
        grown[:-1] = (grown[:-1] - int(h[k, k]) * minors[k] % p) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            grown[:i + 1] = (grown[:i + 1] - int(h[i, k]) * chain % p * minors[i] % p) % p
        minors.append(grown % p)
    return [int(c) for c in minors[d][::-1]]


def is_prime(n: int) -> bool:
    """Deterministic Miller-Rabin for 32-bit numbers."""
    if n < 2 or any(n % q == 0 for q in (2, 3, 5, 7) if n != q):
        return False
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if base % n == 0 or x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """Primes below ``PRIME_LIMIT``, downwards, whose product has more than ``bits`` bits."""
    found, have, candidate = [], 0.0, PRIME_LIMIT - 1
    while have <= bits:
        if is_prime(candidate):
            found.append(candidate)
            have += math.log2(candidate)
        candidate -= 2
    return found


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(t - matrix), the leading 1 first, for a matrix without negative roots."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # A coefficient is at most the binomial times (trace / d)^k, which 2^d trace^k exceeds; one more bit for the sign.
    primes = primes_for(d + d * max(1, trace).bit_length() + 2)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wide = np.array(matrix, dtype=object)
        for batch in batches:
            rows = [(k, int(p), c) for p in batch["prime"]
                    for k, c in enumerate(polynomial_mod((wide % int(p)).astype(np.int64), int(p)))]
            yield pd.DataFrame(rows, columns=["power", "prime", "residue"])

    def remainder(rows: pd.DataFrame) -> pd.DataFrame:
        value, product = 0, 1
        for p, c in sorted(zip(rows["prime"], rows["residue"])):
            p, c = int(p), int(c)
            value += product * ((c - value) * pow(product, -1, p) % p)
            product *= p
        signed = value - product if 2 * value > product else value
        return pd.DataFrame({"power": [rows["power"].iloc[0]], "value": [format(signed, "x")]})

    listed = spark.createDataFrame([(p,) for p in primes], "prime long")
    residues = listed.repartition(max(1, min(len(primes), spark.sparkContext.defaultParallelism * 2))).mapInPandas(
        reduce, "power int, prime long, residue long")
    found = residues.groupBy("power").applyInPandas(remainder, "power int, value string").collect()
    return [int(r["value"], 16) for r in sorted(found, key=lambda r: r["power"])]


def _moved(polynomial: list[int], at: int, bits: int) -> list[int]:
    """Coefficients, up to a factor, of the polynomial moved by at / 2^bits, the leading one first."""
    c = [a << (bits * k) for k, a in enumerate(polynomial)]
    for end in range(len(c), 1, -1):
        carry = c[0]
        for i in range(1, end):
            carry = c[i] = c[i] + at * carry
    return c


def roots_beyond(polynomial: list[int], at: int, bits: int) -> int:
    """Roots above at / 2^bits; sign changes count exactly as all roots are real."""
    signs = [c > 0 for c in _moved(polynomial, at, bits) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def nth_root(polynomial: list[int], number: int, top_bits: int) -> tuple[int, int, int, int]:
    """The ``number``-th largest root (from 1) as ``(numerator, bits, first, last)``.

    The last two number the equal roots it is one of. The root lies below 2^top_bits.
    """
    low, high, bits, above, upto = 0, 1 << top_bits, 0, 0, roots_beyond(polynomial, 0, 0)
    last = max(0, ROOT_BITS - top_bits)
    while upto - above > 1 and (bits < last or high - low > 1):
        if high - low == 1:
            low, high, bits = low * 2, high * 2, bits + 1
        middle = (low + high) // 2
        count = roots_beyond(polynomial, middle, bits)
        if count >= number:
            low, upto = middle, count
        else:
            high, above = middle, count
    if upto - above == 1:  # one root in (low, high]: its side shows in the sign alone

        def value(at: int, bits: int) -> int:
            total = 0
            for k, c in enumerate(polynomial):
                total = total * at + (c << (bits * k))
            return total

        positive = above % 2 == 0  # the sign between the root and those above
        while bits < last or high - low > 1:
            if high - low == 1:
                low, high, bits = low * 2, high * 2, bits + 1
            middle = (low + high) // 2
            v = value(middle, bits)
            if v == 0:
                return middle, bits, number, number
            if (v > 0) == positive:
                high = middle
            else:
                low = middle
    return low + high, bits + 1, above + 1, upto


def null_vectors(matrix: list[list[int]], root: decimal.Decimal, count: int) -> list[list[decimal.Decimal]]:
    """``count`` orthonormal vectors that the matrix less the root sends to (nearly) nothing."""
    with decimal.localcontext() as context:
        context.prec = DIGITS
        d = len(matrix)
        lu = np.array([[decimal.Decimal(v) for v in row] for row in matrix], dtype=object)
        for i in range(d):
            lu[i, i] -= root
        tiny = max(abs(v) for v in lu.ravel()) * decimal.Decimal(10) ** (8 - DIGITS) or decimal.Decimal(10) ** (8 - DIGITS)
        order = list(range(d))
        for k in range(d):
            at = k + max(range(d - k), key=lambda i: abs(lu[k + i, k]))
            if at != k:
                lu[[k, at]] = lu[[at, k]]
                order[k], order[at] = order[at], order[k]
            if abs(lu[k, k]) < tiny:
                lu[k, k] = tiny
            for i in range(k + 1, d):
                if lu[i, k]:
                    lu[i, k] /= lu[k, k]
                    lu[i, k + 1:] -= lu[i, k] * lu[k, k + 1:]

        def solve(b: np.ndarray) -> np.ndarray:
            y = b[order]
            for i in range(d):
                y[i] -= sum(lu[i, :i] * y[:i], decimal.Decimal(0))
            for i in range(d - 1, -1, -1):
                y[i] = (y[i] - sum(lu[i, i + 1:] * y[i + 1:], decimal.Decimal(0))) / lu[i, i]
            return y

        def unit(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
            for _ in range(2):
                for other in others:
                    v = v - sum(v * other, decimal.Decimal(0)) * other
            return v / sum(v * v, decimal.Decimal(0)).sqrt()

        found: list[np.ndarray] = []
        for number in range(count):
            # A start whose entries differ, by the fractional parts of multiples of a root.
            v = np.array([decimal.Decimal(1 + (7919 * (i + 1) * (number + 1)) % 1009) for i in range(d)], dtype=object)
            v = unit(v, found)
            for _ in range(12):
                moved = unit(solve(v), found)
                apart = min(max(abs(a - s * b) for a, b in zip(moved, v)) for s in (1, -1))
                v = moved
                if apart < decimal.Decimal(10) ** -40:
                    break
            lead = max(range(d), key=lambda i: (abs(v[i]).quantize(decimal.Decimal(10) ** -30), -i))
            found.append(v if v[lead] > 0 else -v)
        return [list(v) for v in found]


def components(spark, n: int, matrix: list[list[int]], count: int = COMPONENTS) -> list[dict]:
    """Per component: its number, variance, share of all variance and unit vector; a task finds each root."""
    polynomial = characteristic_polynomial(spark, matrix)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    positive = roots_beyond(polynomial, 0, 0)
    wanted = min(count, positive)
    top_bits = max(1, trace).bit_length()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number in map(int, batch["component"]):
                at, bits, first, last = nth_root(polynomial, number, top_bits)
                with decimal.localcontext() as context:
                    context.prec = DIGITS
                    root = decimal.Decimal(at) / (1 << bits)
                    vector = null_vectors(matrix, root, number - first + 1)[-1]
                    out.append({"component": number, "variance": float(root / (n * n)), "explained": float(root / trace),
                                "vector": [float(v) for v in vector]})
            yield pd.DataFrame(out, columns=["component", "variance", "explained", "vector"])

    if not wanted:
        return []
    numbers = spark.range(1, wanted + 1, 1, wanted).select(F.col("id").cast("int").alias("component"))
    rows = numbers.mapInPandas(run, "component int, variance double, explained double, vector array<double>").collect()
    return sorted((r.asDict() for r in rows), key=lambda r: r["component"])


def _project(rows: DataFrame, keep: list[str], n: int, sums: list[int], found: list[dict]) -> DataFrame:
    """Add ``deviation`` and the array ``whitened`` to rows with ``x``."""
    axes = np.array([c["vector"] for c in found]).T / np.sqrt([c["variance"] for c in found])
    spread = 2 ** 63 // max(1, len(sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.array(sums, dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(batch.num_rows, -1)
            centred = n * x.astype(object) - shift
            if max(abs(centred.max()), abs(centred.min())) ** 2 < spread:
                centred = centred.astype(np.int64)
            deviation = (centred * centred).sum(axis=1)
            white = centred.astype(np.float64) / n @ axes
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(deviation.tolist(), pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))],
                [*keep, "deviation", "whitened"])

    kinds = dict(rows.dtypes)
    return rows.select(*keep, "x").mapInArrow(run, ", ".join(
        [*(f"`{c}` {kinds[c]}" for c in keep), "deviation long", "whitened array<double>"]))


def whiten(table: DataFrame, ident: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: ``ident, component, n, deviation, whitened, explained, identity_error``."""
    spark = table.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = integer_vectors(table, vector, ident)
    fit = stage(rows.select("x").distinct(), "whitening-fit")
    n, sums, products = moments(fit)
    found = components(spark, n, scatter(n, sums, products), count) if n else []
    schema = (f"`{ident}` {dict(table.dtypes)[ident]}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if not found:
        return spark.createDataFrame([], schema)
    error = identity_error(_project(fit, [], n, sums, found), n, len(found))
    unstage(fit)
    explained = F.array(*[F.lit(c["explained"]) for c in found])
    return _project(rows, [ident], n, sums, found).select(
        ident, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        ident, (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))


def identity_error(white: DataFrame, n: int, size: int) -> float:
    """Largest absolute entry of the covariance of whitened fit vectors less the identity."""
    means = white.agg(*[F.sum(F.col("whitened")[i]) / n for i in range(size)]).first()
    off = [F.col("whitened")[i] - F.lit(means[i]) for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    entries = white.agg(*[F.sum(off[i] * off[j]) / n for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(entries, pairs))
