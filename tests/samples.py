"""Table folders and the labelled points shared by the tests."""

import random

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


def labelled_points(n=400, seed=21):
    """Small mixture of two uneven groups: [(point, label)], coordinates with four digits, some repeated."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        cx, cy = [(40.75, -73.98), (40.65, -73.79), (40.82, -73.93), (40.70, -74.02)][i % 4]
        group = "A" if rng.random() < (0.85 if i % 4 else 0.4) else "B"
        shift = 0.03 if group == "B" else 0.0
        out.append(((round(rng.gauss(cx + shift, 0.03), 4), round(rng.gauss(cy - shift, 0.03), 4)), group))
    return out + out[:20]
