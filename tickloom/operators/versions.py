"""The history of a book in as many rows as it had updates: single updates, and whole books now and then.

`book_versions` stores every update with its position, and the whole book before each run of ``every``
positions. `books_at` rebuilds any position from the whole book before it and the updates since. With ``every`` about
the depth of the books, both kinds are as many rows as there are updates, where a book after every update takes depth
times as many. All of it is joins and aggregations; nothing is replayed.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.operators.ordered import null_safe_join, ordered
from tickloom.operators.replay import EMPTY_QUANTITY
from tickloom.schemas import EVENT_ORDER

EVERY = 1000
_TASK_ROWS = 100_000  # versions whose books one task rebuilds


def book_versions(
    updates: DataFrame, keys: Sequence[str], order: Sequence[str] = EVENT_ORDER, every: int = EVERY, page_rows: int | None = None
) -> DataFrame:
    """``keys, _run, at, side, price, quantity``: the writes of a run of positions.

    ``at`` is the position of an update, counted as in `replay_book`; the first position less one, for what was in the
    book before the run. A quantity of 0 is a delete.
    """
    o = ordered(updates.select(*keys, *order, "side", "price", "quantity"), keys, (*order, "side", "price", "quantity"), page_rows)
    placed = F.col("side").isin("ask", "bid") & F.col("price").isNotNull() & ~F.isnan("price")
    writes = o.df.select(*keys, "_pos", "side", "price", "quantity").withColumn("_run", F.expr(f"(_pos - 1) div {every}"))
    last_run = writes.groupBy(*keys).agg(F.max("_run").alias("_last"))
    writes = writes.where(placed)
    last = writes.groupBy(*keys, "_run", "side", "price").agg(F.max_by("quantity", "_pos").alias("quantity"))
    following = F.lead("_run").over(Window.partitionBy(*keys, "side", "price").orderBy("_run"))
    whole = (
        null_safe_join(last.withColumn("_next", following), last_run, keys)
        .where(F.col("quantity") >= EMPTY_QUANTITY)
        # In the book before each later run, up to the next one that writes this price.
        .withColumn("_until", F.coalesce("_next", "_last")).where("_until > _run")
        .withColumn("_run", F.explode(F.expr("sequence(_run + 1, _until)")))
    )
    columns = [*keys, "_run", "at", "side", "price", "quantity"]
    return writes.withColumn("at", F.col("_pos")).select(*columns).unionByName(
        whole.withColumn("at", F.expr(f"_run * {every}")).select(*columns))


def books_at(versions: DataFrame, positions: DataFrame, keys: Sequence[str], every: int = EVERY) -> DataFrame:
    """``keys, pos, side, level, price, quantity``: the book after each wanted (keys, ``pos``), level 0 the best.

    A position reads its own run alone, and of each price the last write.
    """
    run = F.expr(f"(pos - 1) div {every}")
    # One non-null key of both sides, in which NULLs match: all steps below work in the tasks that it is dealt to. By
    # number, as a position gives a whole book: the few bytes that arrive would have the tasks packed together.
    book = F.struct(*keys, "_run")
    tasks = max(versions.sparkSession.sparkContext.defaultParallelism, ceil(versions.count() / _TASK_ROWS))
    wanted = positions.select(*keys, "pos").withColumn("_run", run).select(book.alias("_book"), "pos")
    wanted = wanted.repartition(tasks, "_book").distinct()
    written = versions.select(book.alias("_book"), "at", "side", "price", "quantity").repartition(tasks, "_book")
    live = (
        written.join(wanted, "_book").where("at <= pos")
        .groupBy("_book", "pos", "side", "price").agg(F.max_by("quantity", "at").alias("quantity"))
        .where(F.col("quantity") >= EMPTY_QUANTITY)
    )
    best = Window.partitionBy("_book", "pos", "side").orderBy(F.when(F.col("side") == "ask", F.col("price")).otherwise(-F.col("price")))
    return live.withColumn("level", F.row_number().over(best) - 1).select(
        *[F.col("_book")[k].alias(k) for k in keys], "pos", "side", "level", "price", "quantity")
