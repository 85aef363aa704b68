"""Order book: the top levels of both sides after every update.

The book of one (key, window) is rebuilt by a sequential replay that streams over sorted Arrow
batches and holds only the live levels, so its cost is one step per update whatever the depth of
the book. Spark does the rest: it shuffles the updates by group and sorts them once.

A group too large for one task is cut into pages. The book a page starts from is known without
replaying the pages before it: it is the last write of each price in any earlier page. Those
writes are found by an ordinary aggregation and put in front of the page as opening rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickloom.operators import replay
from tickloom.operators.ordered import Ordered, null_safe_join, ordered
from tickloom.operators.replay import EMIT, EMPTY_QUANTITY, OPENING, SILENT
from tickloom.schemas import DEFAULT_LEVELS, EVENT_ORDER

# The helper travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(replay)

_WHOLE_BOOK_TASKS = 8  # for each core

_BOOK = T.ArrayType(T.StructType([
    T.StructField("ask", T.BooleanType()), T.StructField("level", T.IntegerType()),
    T.StructField("price", T.DoubleType()), T.StructField("quantity", T.DoubleType()),
]))


def replay_book(
    updates: DataFrame,
    keys: Sequence[str],
    levels: int | None = DEFAULT_LEVELS,
    order: Sequence[str] = EVENT_ORDER,
    last_of: Sequence[str] | None = None,
    page_rows: int | None = None,
    shown: Callable[[Column], Column] | None = None,
    flat: Sequence[str] | None = None,
) -> DataFrame:
    """Apply each key's updates in ``order``; after every update give both sides, best first.

    ``levels`` limits the sides (None: all live levels). With ``last_of`` the book is given only
    where the next update differs in those columns (say, at the end of a message). A side other
    than ask and bid changes no book but still counts as an update. Result: the update's other
    columns, ``pos`` (1..n per key) and ``book``: (ask, level, price, quantity), asks then bids.
    ``shown``: what is given out in place of a price or quantity. ``flat``: rather than ``book`` one row for each level, with
    these of the columns, ``side``, ``level``, ``price`` and ``quantity``: sides travel as plain arrays.
    """
    if levels is None:
        # Whole books are many times their updates: by number, else the few bytes of updates are packed into few tasks.
        context = updates.sparkSession.sparkContext
        updates = updates.repartition(_WHOLE_BOOK_TASKS * context.defaultParallelism, *keys)
    # Updates that share time and arrival are put in one fixed order all the same.
    o = ordered(updates, keys, (*order, "side", "price", "quantity"), page_rows)
    carried = [c for c in updates.columns if c not in ("price", "quantity", "side")]
    if last_of is None:
        rows = o.df.withColumn("_role", F.lit(EMIT))
    else:
        unit = F.struct(*last_of)
        rows = o.near(0, 1, lambda w: {
            "_role": F.when(F.lead(unit).over(w).eqNullSafe(unit), SILENT).otherwise(EMIT)
        })
    side = F.when(F.col("side") == "ask", 1).when(F.col("side") == "bid", -1).otherwise(0)
    # A price that is no number has no place in a sorted book.
    rows = rows.withColumn("_write", F.when(F.isnan("price") | F.col("price").isNull(), 0).otherwise(side))
    if o.paged:
        rows = rows.unionByName(_openings(rows, o), allowMissingColumns=True)
        # Opening rows have no position, so they sort in front of their page.
        sequence = Window.partitionBy(*o.group).orderBy(F.col("_pos").asc_nulls_first())
        rows = rows.withColumn("_starts", F.row_number().over(sequence) == 1)
        rows = rows.sortWithinPartitions(*o.group, F.col("_pos").asc_nulls_first())
    else:
        # The same sort as the numbering above; Spark keeps only one of them.
        rows = rows.withColumn("_starts", F.col("_pos") == 1).sortWithinPartitions(*o.keys, *o.order)
    carried = carried if flat is None else [c for c in carried if c in flat]
    show = [] if shown is None else [shown(F.col(c)).alias(f"_shown_{c}") for c in ("price", "quantity")]
    needed = rows.select(*carried, "price", "quantity", "_write", "_role", "_starts", "_pos", *show)
    fields = [*[updates.schema[c] for c in carried], T.StructField("pos", T.LongType())]
    if flat is None:
        schema = T.StructType([*fields, T.StructField("book", _BOOK)])
        return needed.mapInArrow(replay.replay(levels, carried, shown is not None), schema)
    schema = T.StructType([*fields, T.StructField("side", T.StringType()), *[
        T.StructField(c, T.ArrayType(T.DoubleType(), False)) for c in ("prices", "quantities")]])
    sides = needed.mapInArrow(replay.replay(levels, carried, shown is not None, flat=True), schema)
    # Both arrays are read where they lie: nothing is zipped or copied for a level.
    opened = sides.select(*carried, "pos", "side", "quantities", F.posexplode("prices").alias("level", "price"))
    return opened.select(*carried, "pos", "side", "level", "price", F.get("quantities", F.col("level")).alias("quantity"))


def _openings(rows: DataFrame, o: Ordered) -> DataFrame:
    """The levels each page of a hot key starts with: per price, the last write of an earlier page."""
    rows = rows.where("_hot")
    writes = (
        rows.where("_write != 0")
        .groupBy(*o.group, "_write", "price")
        .agg(F.max_by("quantity", "_pos").alias("quantity"))
    )
    pages = rows.groupBy(*o.keys).agg(F.max("_page").alias("_last"))
    following = F.lead("_page").over(Window.partitionBy(*o.keys, "_write", "price").orderBy("_page"))
    live = (
        null_safe_join(writes.withColumn("_next", following), pages, o.keys)
        .where(F.col("quantity") >= EMPTY_QUANTITY)
        # In the book at the start of every page up to and including the next that writes this price.
        .withColumn("_until", F.coalesce("_next", "_last"))
        .where("_until > _page")
        .withColumn("_page", F.explode(F.expr("sequence(_page + 1, _until)")))
    )
    return live.select(*o.group, "_write", "price", "quantity", F.lit(OPENING).alias("_role"))


def book_snapshots(
    updates: DataFrame,
    keys: Sequence[str],
    levels: int | None = DEFAULT_LEVELS,
    order: Sequence[str] = EVENT_ORDER,
    page_rows: int | None = None,
) -> DataFrame:
    """One row per update, side and level: ``pos, time, side, level`` (0 is best), price, quantity."""
    books = replay_book(updates.select(*keys, *order, "price", "quantity", "side"), keys, levels, order,
                        page_rows=page_rows)
    return explode_levels(books, [*keys, "pos", "time"])


def explode_levels(books: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both sides of each book as rows of (side, level, price, quantity)."""
    rows = books.select(*columns, F.inline("book"))
    side = F.when(F.col("ask"), "ask").otherwise("bid")
    return rows.select(*columns, side.alias("side"), "level", "price", "quantity")


def side_levels(ask: bool) -> Column:
    """One side of ``book`` as an array of (price, quantity), best first."""
    kept = F.filter("book", lambda x: x["ask"] if ask else ~x["ask"])
    return F.transform(kept, lambda x: F.struct(x["price"].alias("price"), x["quantity"].alias("quantity")))


def running_state(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole price -> quantity map of each key after every (price, quantity) write.

    Where rows have a ``side``, there are two maps, ``asks`` and ``bids``; else one, ``state``.
    """
    if "side" not in df.columns:
        books = replay_book(df.withColumn("side", F.lit("ask")), keys, None, order)
        return books.select(*keys, "pos", F.map_from_entries(side_levels(ask=True)).alias("state"))
    sides = {"asks": side_levels(ask=True), "bids": side_levels(ask=False)}
    return replay_book(df, keys, None, order).select(
        *keys, "pos", *[F.map_from_entries(levels).alias(name) for name, levels in sides.items()])


def message_books(
    updates: DataFrame, keys: Sequence[str], message: Sequence[str], order: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """Both sides at full depth once per message, after all of its updates."""
    return replay_book(updates, keys, None, order, last_of=message)


def message_levels(
    updates: DataFrame, keys: Sequence[str], message: Sequence[str], columns: Sequence[str], order: Sequence[str] = EVENT_ORDER,
    shown: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The levels of `message_books` as rows of (keys, pos, columns, side, level, price, quantity)."""
    levels = replay_book(updates, keys, None, order, last_of=message, shown=shown, flat=[*keys, *columns])
    return levels.select(*keys, "pos", *columns, "side", "level", "price", "quantity")
