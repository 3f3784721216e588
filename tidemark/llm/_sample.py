"""A bounded sample of ids for learning, evenly over a few strata, without gathering a stratum in a task."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts of the range of the hash.
PARTS = 1 << 20


def sample_ids(rows: DataFrame, most: Callable[[object], int], total: int | None = None) -> list[tuple[object, object]]:
    """(id, stratum) of at most most(stratum) rows of each stratum of rows (id, stratum), by the least hashes of ids. Every
    stratum has its share; with a total, one of at most total by the number of strata, but of one row at least.

    Strata are counted first; then only ids whose hash is in the share that is needed, and a margin, are fetched."""
    counts = {r.stratum: r.n for r in rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    top = {s: min(most(s), max(1, total // len(counts))) if total else most(s) for s in counts}
    place = F.pmod(F.xxhash64("id"), F.lit(PARTS))
    wanted = {s: top[s] + 8 * math.isqrt(top[s]) for s in counts}
    shares = F.create_map(*[F.lit(x) for s, n in counts.items() for x in (s, math.ceil(PARTS * min(1.0, wanted[s] / n)))])
    found = rows.filter(place < shares[F.col("stratum")]).select("id", "stratum", place.alias("place")).limit(2 * sum(wanted.values())).collect()
    taken: Counter = Counter()
    out = []
    for r in sorted(found, key=lambda r: (r.place, r.id, str(r.stratum))):
        taken[r.stratum] += 1
        if taken[r.stratum] <= top[r.stratum]:
            out.append((r.id, r.stratum))
    return out
