"""Universal hash family for MinHash and for reproducible pseudo-random orders.

h_i(x) = (a_i * x + b_i) mod p. The parameters come from a rule, not a table:
numpy's legacy generator seeded with 11 draws a in [1, p-1) and b in [0, p-1),
128 each, the same draw the similarity study used. They are computed once on
the driver and shipped to the executors as literals in the plan.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Fixed values that results depend on.
PRIME = 1_000_000_007
NUM_HASHES = 128
HASH_SEED = 11


@lru_cache(maxsize=None)
def hash_params(n: int = NUM_HASHES, seed: int = HASH_SEED, prime: int = PRIME):
    """Return ((a_0..a_{n-1}), (b_0..b_{n-1})) as Python ints."""
    rs = np.random.RandomState(seed)
    a = tuple(int(v) for v in rs.randint(1, prime - 1, size=n))
    b = tuple(int(v) for v in rs.randint(0, prime - 1, size=n))
    return a, b


def params_values_sql(n: int = NUM_HASHES, seed: int = HASH_SEED) -> str:
    """The parameters as a SQL ``VALUES`` list of (i, a, b), for oracles."""
    a, b = hash_params(n, seed)
    return ", ".join(f"({i}, {a[i]}, {b[i]})" for i in range(n))
