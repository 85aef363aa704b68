"""Ordered operators that hold for any key size.

A window over a whole key puts that key in one task. That is the right plan while every key
is small, and the wrong one when a single key holds a large share of the rows. ``ordered``
checks the sizes first (one narrow, map-side combined count):

* every key within ``page_rows``: plain windows per key, one shuffle;
* otherwise the rows of the hot keys are range-partitioned by (key, order), which splits a hot key
  evenly, written to the shared folder, and numbered per key by adding each partition's running
  offset; the rest is numbered as above. Later steps then work on (key, page) groups of at most
  ``page_rows`` rows: neighbours across a page edge are copied in (``Ordered.near``), totals of
  earlier pages are carried in (``Ordered.carried``).

Both forms give the same rows. ``order`` must be unique within a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickloom.session import stage

PAGE_ROWS = 4_000_000
_SPAN_ROWS = 250_000  # rows sorted by one task, where pages are smaller
_BROADCAST_KEYS, _BROADCAST_BYTES = 100_000, 8 << 20
_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


@dataclass(frozen=True)
class Ordered:
    """Rows numbered 1..n per key in ``_pos``, grouped in ``_page``.

    ``_hot`` marks the keys that were cut into pages; only they need anything from other pages.
    """

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    page_rows: int
    paged: bool

    @property
    def group(self) -> tuple[str, ...]:
        return (*self.keys, "_page") if self.paged else self.keys

    def window(self) -> WindowSpec:
        # Unpaged rows keep their original order columns: the sort of `_pos` serves them too.
        return Window.partitionBy(*self.group).orderBy(*(("_pos",) if self.paged else self.order))

    def near(self, before: int, after: int, build: Callable[[WindowSpec], dict[str, Column]]) -> DataFrame:
        """Add columns whose frames reach at most ``before`` rows back and ``after`` rows on."""
        if not self.paged:
            return self.df.withColumns(build(self.window()))
        # A frame may span several pages: a row is copied to every page whose frames reach it.
        first = f"greatest((_pos - 1 - {after}) div {self.page_rows}, 0L)"
        last = f"(_pos - 1 + {before}) div {self.page_rows}"
        copies = self.df.withColumnRenamed("_page", "_home").withColumn(
            "_page", F.explode(F.expr(f"sequence({first}, {last})"))
        )
        built = copies.withColumns(build(self.window()))
        return built.where("_page = _home").drop("_home")

    def carried(self, name: str, running: Column, summary: Column, fold: Callable[[Column], Column],
                merge: Callable[[Column, Column], Column]) -> DataFrame:
        """Add a running value over all earlier rows and this one.

        ``running`` is the aggregate inside a page, ``summary`` the same over a whole page,
        ``fold`` combines page summaries and ``merge`` a carry with a running value.
        """
        frame = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = self.df.withColumn(name, running.over(frame))
        if not self.paged:
            return local
        earlier = (
            Window.partitionBy(*self.keys).orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
        )
        pages = self.df.where("_hot").groupBy(*self.group).agg(summary.alias("_summary"))
        carries = pages.select(*self.group, fold(F.col("_summary")).over(earlier).alias("_carry"))
        joined = null_safe_join(local, carries, self.group, "left")
        return joined.withColumn(name, merge(F.col("_carry"), F.col(name))).drop("_carry")


def ordered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], page_rows: int | None = None, large: bool | None = None
) -> Ordered:
    """``large``: whether a key has more than ``page_rows`` rows, if the caller knows; else it is looked up."""
    keys, order, page_rows = tuple(keys), tuple(order), page_rows or PAGE_ROWS
    if not (has_large_keys(df, keys, page_rows) if large is None else large):
        return Ordered(_number_by_key(df, keys, order), keys, order, page_rows, paged=False)
    hot, hot_rows, listed = hot_groups(df, keys, page_rows)
    listed = listed.drop("_n")
    if not hot_rows:
        return Ordered(_number_by_key(df, keys, order), keys, order, page_rows, paged=False)
    numbered = _number_by_range(null_safe_join(df, listed, keys, "left_semi"), keys, order, hot_rows, page_rows)
    others = _number_by_key(null_safe_join(df, listed, keys, "left_anti"), keys, order)
    return Ordered(numbered.unionByName(others), keys, order, page_rows, paged=True)


def _number_by_key(df: DataFrame, keys, order) -> DataFrame:
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    return df.withColumns({"_pos": pos, "_page": F.lit(0).cast("bigint"), "_hot": F.lit(False)})


def largest_key(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest key."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0


def hot_groups(df: DataFrame, keys: Sequence[str], page_rows: int) -> tuple[DataFrame, int, DataFrame]:
    """Keys with more than ``page_rows`` rows: (stored keys and ``_n``, their rows, the same to be joined).

    There are at most rows / page_rows of them; they are broadcast while they are few and short.
    """
    hot = stage(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > page_rows))
    size = F.sum(F.octet_length(F.concat_ws("", *[F.col(k).cast("string") for k in keys]))) if keys else F.lit(0)
    n, rows, width = hot.agg(F.count("*"), F.sum("_n"), size).first()
    few = n <= _BROADCAST_KEYS and (width or 0) <= _BROADCAST_BYTES
    return hot, rows or 0, F.broadcast(hot) if few else hot


def has_large_keys(df: DataFrame, keys: Sequence[str], page_rows: int | None = None) -> bool:
    return largest_key(df, keys) > (page_rows or PAGE_ROWS)


def span_count(df: DataFrame, rows: int, page_rows: int) -> int:
    """Tasks that number ``rows`` rows: no more than there are pages, nor than cores or spans of `_SPAN_ROWS` ask for."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(2, min(ceil(rows / page_rows), max(cores, ceil(rows / _SPAN_ROWS))))


def _number_by_range(df: DataFrame, keys, order, rows: int, page_rows: int) -> DataFrame:
    # Sampled range bounds differ between runs, hence the written copy: every later step sees
    # the same partition numbers, also after a lost executor. Pages are cut from positions, so a span may hold many.
    spans = stage(
        df.repartitionByRange(span_count(df, rows, page_rows), *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_span", F.shiftright("_row", _LOCAL_BITS))
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spans.groupBy(*keys, "_span")
        .agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
        .select(*keys, "_span", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        null_safe_join(spans, offsets, [*keys, "_span"])
        .withColumn("_pos", F.col("_row") - F.col("_first") + F.col("_offset") + 1)
        .withColumn("_page", F.expr(f"(_pos - 1) div {page_rows}"))
        .withColumn("_hot", F.lit(True))
        .drop("_row", "_span", "_first", "_offset")
    )


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match NULL keys, keeping the left copy of the keys."""
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(renamed, match, how).drop(*[f"__{c}" for c in on])


def with_group_value(
    df: DataFrame, keys: Sequence[str], values: dict[str, Column], large: bool, page_rows: int | None = None
) -> DataFrame:
    """Add aggregates of its whole group to every row.

    Small groups: one window. With ``large`` groups the aggregates (one row per group) are joined
    back, and a group of more than ``page_rows`` rows gets a salt of as many values as it has pages, so
    that it meets its row in many tasks. The salt is taken from the whole row: the same on a repeated
    task, and different for rows that differ anywhere.
    """
    if not large:
        w = Window.partitionBy(*keys)
        return df.withColumns({name: column.over(w) for name, column in values.items()})
    page_rows = page_rows or PAGE_ROWS
    pages = F.ceil(F.col("_n") / page_rows)
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[c.alias(name) for name, c in values.items()])
    salts = F.when(F.col("_n") > page_rows, pages).otherwise(F.lit(1))
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("_n")
    _, _, listed = hot_groups(df, keys, page_rows)
    known = null_safe_join(df, listed, keys, "left")
    salted = known.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.coalesce(pages, F.lit(1)))).drop("_n")
    return null_safe_join(salted, copies, [*keys, "_salt"]).drop("_salt")


# --- operators on ordered rows ---------------------------------------------------------------


def offsets(o: Ordered, columns: dict[str, tuple[str | Column, int]]) -> DataFrame:
    """Values of other rows of the same key: {new name: (column, rows on, negative for back)}."""
    before = max([0] + [-n for _, n in columns.values()])
    after = max([0] + [n for _, n in columns.values()])
    return o.near(before, after, lambda w: {
        name: F.lead(c, n).over(w) if n >= 0 else F.lag(c, -n).over(w) for name, (c, n) in columns.items()
    })


def forward_fill(o: Ordered, columns: Sequence[str]) -> DataFrame:
    """Replace NULL by the last value before it, per key."""
    frame = o.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = o.df.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in columns})
    if not o.paged:
        return local
    # One carry row per page holds all columns, so there is one join, not one per column.
    pages = o.df.where("_hot").groupBy(*o.group).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    earlier = Window.partitionBy(*o.keys).orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    carries = pages.select(
        *o.group, *[F.last(f"_c{i}", ignorenulls=True).over(earlier).alias(f"_c{i}") for i in range(len(columns))]
    )
    filled = null_safe_join(local, carries, o.group, "left").withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_c{i}")) for i, c in enumerate(columns)}
    )
    return filled.drop(*[f"_c{i}" for i in range(len(columns))])


def running_sum(o: Ordered, name: str, value: Column) -> DataFrame:
    return o.carried(
        name, F.sum(value), F.sum(value), F.sum,
        lambda carry, local: F.coalesce(carry, F.lit(0)) + local,
    )


def running_product(o: Ordered, name: str, value: Column) -> DataFrame:
    return o.carried(
        name, F.product(value), F.product(value), F.product,
        lambda carry, local: F.coalesce(carry, F.lit(1.0)) * local,
    )


def position_slice(o: Ordered, first: int, last: int) -> DataFrame:
    """Rows ``first``..``last`` of each key, 0-based, both included."""
    return plain(o.df.where(F.col("_pos").between(first + 1, last + 1)))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def plain(df: DataFrame) -> DataFrame:
    """Without the helper columns."""
    return df.drop("_pos", "_page", "_hot")
