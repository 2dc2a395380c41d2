"""Gamma-family functions on numpy arrays, as far as the lifetime models need them."""

import itertools

import numpy as np

# Coefficients of the Stirling series of ln(gamma) and of the digamma function.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
DIGAMMA = (1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132, -691 / 32760)
TOLERANCE, NEAR_ONE, STEEP = 1e-16, 0.9, 20
SHIFT = 10  # arguments are raised to at least this before a series is used


def gammaln(x):
    """ln(gamma(x)) for x > 0."""
    x = np.asarray(x, dtype=float)
    raised = np.where(x < SHIFT, x + SHIFT, x)
    product = np.ones_like(x)
    for j in range(SHIFT):
        product = product * np.where(x < SHIFT, x + j, 1.0)
    inverse = 1 / raised
    square = inverse * inverse
    series = sum(c * inverse * square**n for n, c in enumerate(STIRLING))
    main = (raised - 0.5) * np.log(raised) - raised + 0.5 * np.log(2 * np.pi)
    return main + series - np.log(product)


def digamma(x):
    """Derivative of gammaln for x > 0."""
    x = np.asarray(x, dtype=float)
    raised = np.where(x < SHIFT, x + SHIFT, x)
    lowered = sum(np.where(x < SHIFT, 1 / (x + j), 0.0) for j in range(SHIFT))
    square = 1 / (raised * raised)
    series = sum(c * square ** (n + 1) for n, c in enumerate(DIGAMMA))
    return np.log(raised) - 0.5 / raised - series - lowered


def _series(a, b, c, z):
    """Power series of the Gauss hypergeometric function, for z or a + b - c well below 1."""
    total = np.ones(z.shape)
    term = np.ones(z.shape)
    open_rows = np.arange(z.size)
    for n in itertools.count():
        at = open_rows
        term[at] *= (a[at] + n) * (b[at] + n) / ((c[at] + n) * (1 + n)) * z[at]
        total[at] += term[at]
        # Past n, terms fall as powers of z and as n ** (a + b - c - 1): bound the whole tail.
        tail = np.where((c - a - b)[at] > STEEP, np.fmin(1 / (1 - z[at]), n + 1), 1 / (1 - z[at]))
        small = np.abs(term[at]) * tail <= TOLERANCE * np.abs(total[at])
        open_rows = at[~small & np.isfinite(total[at])]
        if not open_rows.size:
            return total


def _step(a, b, c, gap, forward, value, slope):
    """Function and derivative ``forward`` further on, by the Taylor series at 1 - gap.

    The coefficients follow from the hypergeometric differential equation.
    """
    before, now = value, slope * forward  # coefficients k and k + 1, times forward**k
    total, turned = before + now, now.copy()
    calm = 0
    for k in itertools.count():
        rise = (k + a) * (k + b) * before * forward**2
        fall = (k + 1) * ((2 * gap - 1) * k + c - (a + b + 1) * (1 - gap)) * now * forward
        before, now = now, (rise - fall) / (gap * (1 - gap) * (k + 2) * (k + 1))
        total, turned = total + now, turned + (k + 2) * now
        small = np.abs((k + 2) * now) <= TOLERANCE * (np.abs(total) + np.abs(turned))
        calm = calm + 1 if np.all(small | ~np.isfinite(total)) else 0
        if calm == 2:
            return total, turned / forward


def hyp2f1(a, b, c, z, rest=None):
    """Gauss hypergeometric function for c > 0 and 0 <= z < 1; ``rest`` is 1 - z where known exactly.

    The power series up to z = 0.9, and wherever c - a - b makes its terms fall steeply. Elsewhere the
    solution is carried on from 0.9 in Taylor steps that at most halve the way to 1, so the work grows
    with the logarithm of 1 / rest. Steps are short against 1 / c and 1 / (c - a - b), which keeps
    the solutions that are singular at 0 and at 1 out.
    """
    rest = 1 - np.asarray(z, dtype=float) if rest is None else rest
    a, b, c, z, rest = (
        np.array(v, dtype=float).ravel() for v in np.broadcast_arrays(a, b, c, z, rest)
    )
    steep = c - a - b
    start = np.where(steep > STEEP, z, np.minimum(z, NEAR_ONE))
    value = _series(a, b, c, start)
    far = np.flatnonzero((rest < 1 - NEAR_ONE) & ~(steep > STEEP))
    if not far.size:
        return value
    slope = np.zeros(z.shape)
    slope[far] = (a * b / c)[far] * _series(a[far] + 1, b[far] + 1, c[far] + 1, start[far])
    gap = np.full(z.shape, 1 - NEAR_ONE)
    near_zero = 2 / (1 + np.maximum(np.abs(a), c))
    share = np.minimum(0.5, 4 / np.maximum(steep, 1))
    while far.size:
        forward = np.minimum(np.minimum(gap * share, near_zero), gap - rest)[far]
        value[far], slope[far] = _step(
            a[far], b[far], c[far], gap[far], forward, value[far], slope[far]
        )
        gap[far] = np.maximum(gap[far] - forward, rest[far])
        far = far[(gap > rest)[far] & np.isfinite(value[far])]
    return value
