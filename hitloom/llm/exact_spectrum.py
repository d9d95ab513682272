"""Eigenvalues and eigenvectors of an integer matrix from its exact characteristic polynomial.

The matrix is symmetric and positive semidefinite, so all roots of the polynomial are real and not negative,
and sign changes of its shifted coefficients count roots exactly.
"""

from __future__ import annotations

import math

import numpy as np

# Binary digits of a root below the leading one of the trace, and of the arithmetic on vectors.
ROOT_BITS, VECTOR_BITS = 256, 352

Matrix = list[list[int]]


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 2^32."""
    if n < 4:
        return n > 1
    if n % 2 == 0:
        return False
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        if base % n == 0:
            continue
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(size: int, trace: int) -> list[int]:
    """Primes below 2^31 whose product exceeds twice every coefficient, and one more for a check.

    By Maclaurin's inequality the k-th coefficient is at most C(size, k) (trace / size)^k.
    """
    mean = max(math.log2(max(trace, 1)) - math.log2(size), 0.0)
    bits = max(math.log2(math.comb(size, k)) + k * mean for k in range(size + 1)) + 3
    out, n = [], (1 << 31) - 1
    while len(out) < bits / 30.9 + 2:
        if _is_prime(n):
            out.append(n)
        n -= 2
    return out


def characteristic_mod(matrix: Matrix, primes: list[int]) -> np.ndarray:
    """Coefficients (primes, size + 1) of det(x - matrix), highest first, modulo each prime.

    A similarity transform modulo the prime makes the matrix upper Hessenberg; the polynomials of its leading
    blocks follow one from the other. All primes are worked on side by side.
    """
    whole = np.array(matrix, dtype=object)
    p = np.array(primes, dtype=np.int64)
    size, count = len(matrix), len(primes)
    h = np.stack([(whole % q).astype(np.int64) for q in primes])
    m, every = p[:, None, None], np.arange(count)
    for k in range(size - 2):
        pivot = k + 1 + np.argmax(h[:, k + 1 :, k] != 0, axis=1)
        row = h[every, pivot].copy()
        h[every, pivot] = h[:, k + 1]
        h[:, k + 1] = row
        column = h[every, :, pivot].copy()
        h[every, :, pivot] = h[:, :, k + 1]
        h[:, :, k + 1] = column
        inverse = np.array([pow(x, -1, q) if x else 0 for x, q in zip(h[:, k + 1, k].tolist(), primes, strict=True)], dtype=np.int64)
        u = h[:, k + 2 :, k] * inverse[:, None] % p[:, None]
        h[:, k + 2 :] = (h[:, k + 2 :] - u[:, :, None] * h[:, None, k + 1] % m) % m
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * u[:, None, :] % m).sum(2)) % p[:, None]
    q = p[:, None]
    poly = [np.zeros((count, size + 1), dtype=np.int64)]  # lowest first
    poly[0][:, 0] = 1
    for k in range(size):
        new = np.zeros_like(poly[0])
        new[:, 1:] = poly[k][:, :-1]
        new = (new - h[:, k, k, None] * poly[k] % q) % q
        below = np.ones(count, dtype=np.int64)
        for i in range(1, k + 1):
            below = below * h[:, k - i + 1, k - i] % p
            if not below.any():
                break
            new = (new - (h[:, k - i, k] * below % p)[:, None] * poly[k - i] % q) % q
        poly.append(new)
    return poly[size][:, ::-1]


def combine(residues: np.ndarray, primes: list[int]) -> list[int]:
    """Integers from their residues by Chinese remaindering; the last prime only checks them."""
    used = primes[:-1]
    product = math.prod(used)
    parts = [(product // q) * pow(product // q, -1, q) for q in used]
    out = []
    for column in residues.T.tolist():
        x = sum(r * part for r, part in zip(column, parts, strict=False)) % product
        x = x - product if 2 * x > product else x
        if x % primes[-1] != column[-1]:
            raise ArithmeticError("too few primes for the coefficients")
        out.append(x)
    return out


def roots_above(poly: list[int], at: int) -> int:
    """How many roots of a polynomial with real roots only (highest coefficient first) are greater than `at`:
    the sign changes of the coefficients of poly(x + at)."""
    c = list(poly)
    n = len(c)
    for end in range(n, 1, -1):
        for i in range(1, end):
            c[i] += at * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], at: int) -> int:
    out = 0
    for c in poly:
        out = out * at + c
    return out


def isolate(poly: list[int], trace: int, k: int) -> tuple[int, int, int, int]:
    """(root, shift, number, multiple): the k-th largest root, from 1, is root / 2^shift to `ROOT_BITS` digits; it
    is the one with that number, from 0, of `multiple` roots that agree in all these digits."""
    shift = max(ROOT_BITS - trace.bit_length(), 0)
    scaled = [c << (shift * i) for i, c in enumerate(poly)]
    low, high = 0, trace << shift
    above_low, above_high = roots_above(scaled, 0), 0
    while high - low > 1:
        middle = (low + high) // 2
        if above_low - above_high == 1:
            # the sign changes at the one root in (low, high]
            value = _value(scaled, middle)
            inside = value != 0 and (value > 0) == (above_low % 2 == 0)
            above = above_low if inside else above_high
        else:
            above = roots_above(scaled, middle)
        if above >= k:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return high, shift, k - 1 - above_high, above_low - above_high


def null_vectors(matrix: Matrix, trace: int, root: int, shift: int, multiple: int) -> np.ndarray:
    """Orthonormal vectors (multiple, size) of the null space of matrix - root / 2^shift, in doubles.

    Fixed-point elimination with full pivoting leaves `multiple` rows that vanish to the last digits. There
    inverse iteration has its limit in one step: these unknowns are set, the others follow by substitution.
    """
    size = len(matrix)
    scale = VECTOR_BITS - trace.bit_length()

    def fixed(x: int, bits: int) -> int:
        return x << bits if bits >= 0 else x >> -bits

    a = np.array([[fixed(x, scale) for x in row] for row in matrix], dtype=object)
    for i in range(size):
        a[i, i] -= fixed(root, scale - shift)
    columns, rank = list(range(size)), size - multiple
    for k in range(rank):
        rest = np.abs(a[k:, k:])
        i, j = divmod(int(np.argmax(rest)), size - k)
        a[[k, k + i]] = a[[k + i, k]]
        a[:, [k, k + j]] = a[:, [k + j, k]]
        columns[k], columns[k + j] = columns[k + j], columns[k]
        pivot = a[k, k]
        if pivot == 0:
            continue
        factor = np.array([(x << VECTOR_BITS) // pivot for x in a[k + 1 :, k]], dtype=object)
        a[k + 1 :, k:] -= (factor[:, None] * a[k, k:][None, :]) >> VECTOR_BITS
    one = 1 << VECTOR_BITS
    found: list[np.ndarray] = []
    for free in range(multiple):
        z = np.zeros(size, dtype=object)
        z[rank + free] = one
        for k in range(rank - 1, -1, -1):
            total = int((a[k, k + 1 :] * z[k + 1 :]).sum()) if k + 1 < size else 0
            z[k] = -total // a[k, k] if a[k, k] else 0
        for other in found:
            z = z - ((int((z * other).sum()) >> VECTOR_BITS) * other >> VECTOR_BITS)
        length = math.isqrt(int((z * z).sum()))
        found.append(np.array([(x << VECTOR_BITS) // length for x in z], dtype=object))
    out = np.zeros((multiple, size))
    for row, z in zip(out, found, strict=True):
        row[columns] = [x / one for x in z]
    # the sign is free: the largest entry is positive
    lead = out[np.arange(multiple), np.abs(out).argmax(1)]
    return out * np.where(lead < 0, -1.0, 1.0)[:, None]
