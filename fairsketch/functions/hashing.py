"""Universal hash families for the count-min and count sketches, as column expressions.

A family of ``d`` functions is a visible parameter table (one row per sketch row ``r`` with its
``a`` and ``b``), not a list of closures.  The bucket of item ``x`` in row ``r`` is
``((a*x + b) mod p) mod w`` and its sign is ``2*(((a*x + b) mod p) mod 2) - 1``, with the
non-negative modulo of unbounded integer arithmetic.  On 64-bit columns this is computed as
``pmod(a * pmod(x, p) + b, p)``, which is the same value and cannot overflow while
``(p - 1)**2 + p < 2**63``.
"""

from __future__ import annotations

import hashlib
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: the prime modulus of the hash families.
DEFAULT_PRIME = 8191
# A larger prime for item domains much wider than 8191 (items congruent mod p always collide).
LARGE_PRIME = 2147483647


@dataclass(frozen=True)
class HashFamily:
    """``d`` functions ``x -> (a_r * x + b_r) mod p`` (then reduced to a bucket or a sign)."""

    a: tuple[int, ...]
    b: tuple[int, ...]
    p: int = DEFAULT_PRIME

    def __post_init__(self):
        if len(self.a) != len(self.b) or not self.a:
            raise ValueError("a and b must be non-empty and of equal length")
        if (self.p - 1) ** 2 + self.p >= 2 ** 63:
            raise ValueError("prime too large for 64-bit hash arithmetic")
        if not all(1 <= a < self.p for a in self.a) or not all(0 <= b < self.p for b in self.b):
            raise ValueError("need 1 <= a < p and 0 <= b < p")

    @property
    def d(self) -> int:
        return len(self.a)

    @staticmethod
    def draw(d: int, p: int = DEFAULT_PRIME, rng: random.Random | None = None) -> "HashFamily":
        """``a`` sampled without replacement from 1..p-1 and ``b`` from 0..p-1."""
        if not 1 <= d <= p - 1:
            raise ValueError("need 1 <= d <= p - 1")
        rng = rng or random.Random()
        return HashFamily(tuple(rng.sample(range(1, p), d)), tuple(rng.sample(range(0, p), d)), p)

    def table(self, spark: SparkSession) -> DataFrame:
        """The parameter table ``[r, a, b, p]``."""
        rows = [(r, a, b, self.p) for r, (a, b) in enumerate(zip(self.a, self.b))]
        return spark.createDataFrame(rows, "r int, a bigint, b bigint, p bigint")

    def raw_sql(self, x: str, r: int) -> str:
        """SQL text of ``(a_r * x + b_r) mod p`` for the column named ``x``."""
        p = f"{self.p}L"
        return f"pmod({self.a[r]}L * pmod(CAST(`{x}` AS BIGINT), {p}) + {self.b[r]}L, {p})"

    def bucket_sql(self, x: str, r: int, w: int) -> str:
        return f"CAST(pmod({self.raw_sql(x, r)}, {w}L) AS INT)"

    def sign_sql(self, x: str, r: int) -> str:
        return f"CAST(2 * pmod({self.raw_sql(x, r)}, 2L) - 1 AS INT)"

    def raw(self, x: Column, r: int) -> Column:
        p = F.lit(self.p).cast("bigint")
        return F.pmod(F.lit(self.a[r]).cast("bigint") * F.pmod(x.cast("bigint"), p)
                      + F.lit(self.b[r]).cast("bigint"), p)

    def bucket(self, x: Column, r: int, w: int) -> Column:
        return F.pmod(self.raw(x, r), F.lit(w).cast("bigint")).cast("int")

    def sign(self, x: Column, r: int) -> Column:
        return (F.lit(2) * F.pmod(self.raw(x, r), F.lit(2).cast("bigint")) - F.lit(1)).cast("int")


def bucket(x: Column, a: Column, b: Column, p: Column, w: Column) -> Column:
    """Bucket hash with the parameters as columns (for joins against a parameter table)."""
    return F.pmod(F.pmod(a * F.pmod(x, p) + b, p), w)


def sign(x: Column, a: Column, b: Column, p: Column) -> Column:
    return F.lit(2) * F.pmod(F.pmod(a * F.pmod(x, p) + b, p), F.lit(2)) - F.lit(1)


def sketch_name(kind: str, w: int, *families: HashFamily) -> str:
    """Kind, width, depth and a digest of the hash parameters."""
    text = repr([(f.a, f.b, f.p) for f in families])
    return f"{kind}-{families[0].d}x{w}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


@dataclass(frozen=True)
class SketchSpec:
    """Shape and hash functions of a pair of sketches over the same stream.

    ``cm_h`` indexes the count-min sketch; ``cs_h`` and ``cs_g`` index and sign the count
    sketch.  All three are drawn independently.
    """

    w: int
    cm_h: HashFamily
    cs_h: HashFamily
    cs_g: HashFamily

    def __post_init__(self):
        if self.w < 1:
            raise ValueError("w must be >= 1")
        if not (self.cm_h.d == self.cs_h.d == self.cs_g.d):
            raise ValueError("all families need the same number of rows d")

    @property
    def d(self) -> int:
        return self.cm_h.d

    def fingerprint(self, kind: str) -> str:
        """Names everything that cells of one kind depend on: two sketches can be added only if these are equal."""
        if kind == "cm":
            return sketch_name("cm", self.w, self.cm_h)
        if kind == "cs":
            return sketch_name("cs", self.w, self.cs_h, self.cs_g)
        raise ValueError("kind is 'cm' or 'cs'")

    @staticmethod
    def draw(d: int, w: int, p: int = DEFAULT_PRIME, seed: int | None = None) -> "SketchSpec":
        rng = random.Random(seed)
        return SketchSpec(w, HashFamily.draw(d, p, rng), HashFamily.draw(d, p, rng),
                          HashFamily.draw(d, p, rng))
