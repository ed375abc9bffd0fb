"""Reproducible draws of an exact size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionweave.operators.filters import EDGE_KEY, require_balanced
from ionweave.operators.ordering import with_row_index

DRAWS_PER_CLASS = 25_000  # fixed value: default size of the training set per class
_BROADCAST_DRAWS = 1_000_000


def draw_per_class(
    edges: DataFrame,
    k: int = DRAWS_PER_CLASS,
    seed: int = 0,
    label: str = "Y",
    order_by: Sequence[str] = EDGE_KEY,
    balanced: bool = True,
) -> DataFrame:
    """Exactly ``k`` draws with replacement from each class; repeated draws stay repeated.

    Draw ``i`` of a class takes the row whose index in the class, ordered by ``order_by``,
    is a hash of (seed, class, i) modulo the class size.  ``balanced=True`` demands classes 0
    and 1 of equal size and draws from no other label.  Only the drawn positions travel: ``k`` rows a
    class.  The result is sorted by ``order_by``, then the label.
    """
    if balanced:
        require_balanced(edges, label)
        edges = edges.where(F.col(label).isin(0, 1))
    indexed = with_row_index(edges, order_by, by=[label], name="_at", size_name="_rows")
    sizes = indexed.groupBy(label).agg(F.first("_rows").alias("_rows"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(label).cast("string"), F.col("_draw").cast("string")))
    draws = sizes.withColumn("_draw", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).select(
        label,
        "_draw",
        (F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % F.col("_rows")).alias("_at"),
    )
    if balanced and 2 * k <= _BROADCAST_DRAWS:  # two classes, so 2 k rows
        draws = F.broadcast(draws)
    return indexed.join(draws, [label, "_at"]).select(*edges.columns).orderBy(*order_by, label)
