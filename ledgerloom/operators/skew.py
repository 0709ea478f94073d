"""Equi-join that stays balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on the rows of the broadcast load table, whatever the size of the data.
BUCKETS = 65_536


def heavy_buckets(df: DataFrame, key: str, spread_rows: int, buckets: int = BUCKETS) -> DataFrame:
    """Hash buckets of ``key`` that hold too many rows, with the pieces to cut each into.

    The load table has one row per bucket, so it is at most ``buckets`` rows for any input and
    its partial counts are combined before the shuffle. A piece is ``spread_rows`` rows, or
    twice the mean bucket where the data is so large that an ordinary bucket exceeds that.
    """
    load = df.groupBy(F.expr(f"{_bucket_of(key, buckets)} AS _bucket")).agg(
        F.expr("count(1) AS _rows"))
    whole = load.agg(F.expr("sum(_rows) AS _total"),
                     F.expr("collect_list(struct(_bucket, _rows)) AS _load"))
    return (
        whole.selectExpr(f"greatest(double({spread_rows}), _total * {2 / buckets}D) AS _piece",
                         "inline(_load)")
        .where("_rows > _piece")
        .selectExpr("_bucket", "int(ceil(_rows / _piece)) AS _pieces")
    )


def _bucket_of(key: str, buckets: int) -> str:
    return f"pmod(xxhash64(`{key}`), {buckets})"


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str, *,
                spread_by: Sequence[str], spread_rows: int, load_from: DataFrame | None = None,
                buckets: int = BUCKETS) -> DataFrame:
    """Join ``left`` to ``right``, which has one row per ``key``, for ``how`` inner or left.

    Rows of an overloaded bucket are split by a hash of ``spread_by`` into pieces, and the
    matching right rows are repeated once per piece; other rows are joined as usual. The salt
    comes from the row itself, so a recomputed task sends each row to the same place.

    ``load_from`` is a cheaper frame with the same key distribution as ``left``, such as the
    unjoined scan, from which to measure the load.
    """
    heavy = F.broadcast(heavy_buckets(load_from if load_from is not None else left,
                                      key, spread_rows, buckets))
    bucket = f"{_bucket_of(key, buckets)} AS _bucket"
    row_hash = f"xxhash64({', '.join(f'`{c}`' for c in spread_by)})"
    salted_left = (
        left.selectExpr("*", bucket).join(heavy, "_bucket", "left")
        .selectExpr("* EXCEPT (_bucket, _pieces)",
                    f"int(coalesce(pmod({row_hash}, _pieces), 0)) AS _salt")
    )
    salted_right = (
        right.selectExpr("*", bucket).join(heavy, "_bucket", "left")
        .selectExpr("* EXCEPT (_bucket, _pieces)",
                    "explode(sequence(0, coalesce(_pieces, 1) - 1)) AS _salt")
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
