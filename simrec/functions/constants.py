"""Parameters shared by the Spark jobs and the SQL oracle text."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the reference's for the same results.
#   60 hash functions, grouped into 30 bands of 2 rows (hash h -> band h % 30),
#   band bucket = each row's minimum taken modulo 1000,
#   similarity threshold 0.5 (pairs AT the threshold are kept),
#   2.5 stars for cold-start or zero-weight predictions,
#   predictions clamped to [0, 5],
#   ALS with rank 15, 5 iterations and regularisation 0.15.
# ---------------------------------------------------------------------------
NUM_HASHES = 60
NUM_BANDS = 30
BUCKET_MOD = 1000
THRESHOLD = 0.5
DEFAULT_STARS = 2.5
MIN_STARS = 0.0
MAX_STARS = 5.0
ALS_RANK = 15
ALS_MAX_ITER = 5
ALS_REG = 0.15

# Our own choices (not from the reference).
HASH_SEED = 20240917          # seeds the hash family; the reference is unseeded
ALS_SEED = 42
ALS_TOLERANCE = 1e-5          # relative; factors are 32-bit floats
ALS_BLOCKS = 8                # a half-step sends a factor once to each block that rates it, so
                              # the shuffle grows with the blocks
SIGNED_ZERO_EPS = 1e-12       # |sum of signed weights| below this counts as zero
STARS_TYPE = "decimal(6,3)"   # stars have at most three decimals; products of sums stay exact
LENGTH_EPS = 1e-9             # slack for threshold * size in prefix/length filters
PAIR_BLOCK_SIZE = 4096        # rows per block when a hot group is split for pairing
GATHER_ROWS = 1 << 16         # rows of an item that one task may aggregate; more are cut into blocks
PROFILE_ROWS = 512            # ratings of a user or item whose profile travels with its rows
SKETCH_WORDS = 64             # longs of a set's parity sketch (4,096 bits), and of the
SKETCH_SHORT = SKETCH_WORDS // 4    # shortest fold of it that travels through the pair joins
SKETCH_LOAD = 28              # members per long of a travelling sketch; a larger set's is longer
COPY_ROWS = 1_000_000         # members of copy classes that may be broadcast, two ids each
SKETCH_LONGEST = 4096         # longs of the longest sketch that is made for pairs of large sets
SKETCH_SENT = 64 << 20        # bytes of long sketches that may be broadcast


def _splitmix64(state: int) -> tuple[int, int]:
    """One step of the public SplitMix64 generator: (new_state, output)."""
    mask = (1 << 64) - 1
    state = (state + 0x9E3779B97F4A7C15) & mask
    z = state
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
    return state, z ^ (z >> 31)


def hash_constants(num_hashes: int = NUM_HASHES, seed: int = HASH_SEED) -> list[tuple[int, int]]:
    """Seeded raw constants (A_k, B_k), k = 1..num_hashes, each below 2^31.

    The data-dependent coefficients are derived inside the query from the
    member count n:  a_k = 1 + 2 * (A_k mod max(n div 2, 1))  (odd, in [1, n-1]),
    b_k = B_k mod n.
    """
    state = seed
    out = []
    for _ in range(num_hashes):
        state, x = _splitmix64(state)
        state, y = _splitmix64(state)
        out.append((x >> 33, y >> 33))
    return out


def band_rows(num_hashes: int = NUM_HASHES, num_bands: int = NUM_BANDS) -> list[tuple[int, list[int]]]:
    """Bands as (band label, 1-based hash numbers); hash h belongs to band h % num_bands."""
    bands: dict[int, list[int]] = {}
    for h in range(1, num_hashes + 1):
        bands.setdefault(h % num_bands, []).append(h)
    return sorted(bands.items())
