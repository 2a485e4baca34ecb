"""Joins of a huge table with one that is expected, not known, to be small.

Nothing is broadcast on a guess: the small side is computed once, its rows and
bytes are measured, and only then is the join strategy picked. Beyond the bound
the join is a shuffle join in which frequent keys are salted, each by its share of
all rows. Side tables are written while the plan is built, and the result is
bound to what they held then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.session import new_folder

MAX_ROWS_CONF = "spark.tracelake.broadcast.maxRows"
MAX_BYTES_CONF = "spark.tracelake.broadcast.maxBytes"
SALTS_CONF = "spark.tracelake.join.salts"
# A key is cut into pieces of at most one part in SALTS_CONF of all rows. At most
# so many keys hold more than that, so the list of frequent keys is bounded.
_DEFAULTS = {MAX_ROWS_CONF: 500_000, MAX_BYTES_CONF: 128 * 1024 * 1024, SALTS_CONF: 10_000}


def setting(df: DataFrame, name: str) -> int:
    return int(df.sparkSession.conf.get(name, str(_DEFAULTS[name])))


@dataclass(frozen=True)
class Settled:
    """A table stored in the shared folder, with its size checked."""

    df: DataFrame
    broadcastable: bool


def written(df: DataFrame) -> DataFrame:
    """The table computed once and stored in the shared folder.

    A stored table survives lost executors, is read by column, and has known
    statistics.
    """
    spark = df.sparkSession
    path = new_folder(spark, "side")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame) -> Settled:
    """Compute a side table once and measure it.

    The rows are counted first; bytes are an aggregate over the stored table, and
    are measured only where the rows are few enough.
    """
    kept = written(df)
    if kept.count() > setting(df, MAX_ROWS_CONF):
        return Settled(kept, False)
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in kept.columns]))
    size = kept.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return Settled(kept, size <= setting(df, MAX_BYTES_CONF))


def lookup_join(
    big: DataFrame,
    small: DataFrame | Settled,
    on: Sequence[str],
    how: str = "inner",
    *,
    spread_by: str = "seq",
    residual: Callable[[DataFrame, DataFrame], Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Join ``big`` to ``small`` on equal columns plus an optional extra condition.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti`` with ``big``
    on the left. The salted form is exact for all of them: every big row meets
    one full copy of the small rows of its key. ``spread_by`` is a column of
    ``big`` that differs between rows of one key. ``unique`` says that no key of
    ``big`` is frequent, so that none has to be looked for.
    """
    side = small if isinstance(small, Settled) else settle(small)
    keep_right = how in ("inner", "left")
    on = list(on)
    if side.broadcastable:
        left, right, keys = big, F.broadcast(side.df), on
    elif unique:
        left, right, keys = big, side.df, on
    else:
        left, right = _salted(big, side.df, on, spread_by)
        keys = [*on, "_salt"]
    # rename the right keys so that the condition is unambiguous
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"_r_{c}" if c in keys else c) for c in right.columns]
    )
    condition = F.lit(True)
    for key in keys:
        condition = condition & (left[key] == renamed[f"_r_{key}"])
    if residual is not None:
        condition = condition & residual(left, renamed)
    joined = left.join(renamed, condition, how)
    if keep_right:
        joined = joined.drop(*[f"_r_{c}" for c in keys])
    return joined.drop("_salt")


def _salted(
    big: DataFrame, small: DataFrame, on: list[str], spread_by: str
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt``: the frequent keys of ``big`` are spread out.

    Which keys are picked changes only the layout, never the result. The list
    is stored first so that both sides always see the same one.
    """
    share = setting(big, SALTS_CONF)
    counts = written(big.groupBy(*on).count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = written(
        counts.where(F.col("count") * share > total).select(
            *on, F.ceil(F.col("count") * share / F.lit(max(total, 1))).cast("int").alias("_frequent")
        )
    )
    spread = F.pmod(F.xxhash64(F.col(spread_by)), F.col("_frequent")).cast("int")
    left = big.join(F.broadcast(frequent), on, "left").withColumn(
        "_salt", F.coalesce(spread, F.lit(0))
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_frequent"), F.lit(1)) - 1)
    right = small.join(F.broadcast(frequent), on, "left").withColumn("_salt", F.explode(copies))
    return left.drop("_frequent"), right.drop("_frequent")
