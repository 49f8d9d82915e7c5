"""Parameters shared by the registered queries and their SQL oracles."""

from __future__ import annotations

from ..functions.hashing import LARGE_PRIME, SketchSpec

# Four starting centres for the 3-D lineitem points.
CENTERS_PTS3 = [
    (0.2, 0.2, 0.2),
    (0.8, 0.2, 0.6),
    (0.3, 0.8, 0.5),
    (0.7, 0.7, 0.1),
]

# Three of them under ids with gaps, out of order.
GAPPED_CENTERS = [(17, CENTERS_PTS3[0]), (3, CENTERS_PTS3[1]), (40, CENTERS_PTS3[2])]

# Eight starts of a sweep, the centres above moved along the unit cube, and the seed of the seeding.
SWEEP_STARTS = {r: [tuple(round((v + r * step) % 1, 2) for v, step in zip(c, (0.11, 0.07, 0.05))) for c in CENTERS_PTS3]
                for r in range(8)}
SEEDING_SEED = 5
# How often the 64 embedding dimensions are repeated in wide points; repetition k is scaled by k.
WIDE_REPEATS = 12

# Fixed value: the cluster whose members are listed.
MEMBERS_OF = 1

# Iterations of the loops without and with cached points, k-means parameters.
LOOP_STEPS = 2
CACHED_LOOP_STEPS = 3
KMEANS_K = 4
KMEANS_ITER = 5
KMEANS_SEED = 16

# Sketch shapes.  Wide: odd depth for the large item domains (part and order
# keys); narrow: even depth (upper median) for the skewed event items and the streams.
SPEC_WIDE = SketchSpec.draw(d=5, w=256, seed=20240501)
SPEC_NARROW = SketchSpec.draw(d=4, w=32, seed=20240502)

# Large: more cells than are broadcast, hashes modulo a prime beyond the key domains.
SPEC_LARGE = SketchSpec.draw(d=5, w=500_000, p=LARGE_PRIME, seed=20240503)

# Fixed value: condition on the batches (years) of a stored sketch that are read.
STORE_YEARS = "batch >= 1995"

# K of the heavy-hitter queries and the stream target length.
TOP_K = 10
TOP_K_USERS = 5
TOP_K_ORDERS = 20
TOP_K_BATCH = 3
STREAM_T = 4321
# Fixed value: the target length of the stream of three tables (at sf0.01 it is reached by the second one).
STREAM_T_TABLES = 12_000

# Digits kept of every double in query results (both sides of the oracle check).
DIGITS = 6
