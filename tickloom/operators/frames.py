"""Frames, labels and differences over feature rows, per instrument in time order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.operators import ordered as o_
from tickloom.operators.ordered import Ordered, ordered
from tickloom.schemas import INSTRUMENT, older_names

FRAME_ROWS = 90
WARM_UP_ROWS = 150
SERIES_BARS = 300
PRICE = "all_close_price"


def timeline(features: DataFrame, keys: Sequence[str] = INSTRUMENT, order: Sequence[str] = ("window_end",),
             page_rows: int | None = None, large: bool | None = None) -> Ordered:
    """Feature rows numbered per instrument; the input of the operators below."""
    return ordered(features, keys, order, page_rows, large)


def forward_fill(o: Ordered, columns: Sequence[str]) -> DataFrame:
    return o_.plain(o_.forward_fill(o, columns))


def drop_warm_up(features: DataFrame, columns: Sequence[str], rows: int = WARM_UP_ROWS,
                 keys: Sequence[str] = INSTRUMENT, order: Sequence[str] = ("window_end",),
                 page_rows: int | None = None) -> DataFrame:
    """Drop the first ``rows`` rows of each instrument, then forward fill what is left."""
    o = ordered(features, keys, order, page_rows)
    kept = Ordered(o.df.where(F.col("_pos") > rows), o.keys, o.order, o.page_rows, o.paged)
    return o_.plain(o_.forward_fill(kept, columns))


def _frame(columns: Sequence[str], first: int, last: int):
    return lambda w: F.collect_list(F.struct(*columns)).over(w.rowsBetween(first, last))


def frames(o: Ordered, columns: Sequence[str], rows: int = FRAME_ROWS, batch_size: int | None = None) -> DataFrame:
    """The frame of ``rows`` rows that starts at each row; incomplete frames are left out.

    ``start`` is the 0-based number of the first row, ``batch`` its training batch.
    """
    built = o.near(0, rows - 1, lambda w: {"frame": _frame(columns, 0, rows - 1)(w)})
    return _numbered(built.where(F.size("frame") == rows), batch_size)


def _numbered(built: DataFrame, batch_size: int | None) -> DataFrame:
    built = built.withColumn("start", F.col("_pos") - 1)
    if batch_size:
        built = built.withColumn("batch", F.expr(f"start div {batch_size}"))
    return o_.plain(built)


def frame_labels(o: Ordered, columns: Sequence[str], rows: int = FRAME_ROWS, price: str = PRICE,
                 batch_size: int | None = None) -> DataFrame:
    """Frames with the price of the row after the frame and of the one after that."""
    built = o.near(0, rows + 1, lambda w: {
        "frame": _frame(columns, 0, rows - 1)(w),
        "current_price": F.lead(price, rows).over(w),
        "next_price": F.lead(price, rows + 1).over(w),
        "_last": F.lead(F.lit(1), rows + 1).over(w),
    })
    return _numbered(built.where("_last IS NOT NULL").drop("_last"), batch_size)


def differenced_frames(o: Ordered, columns: Sequence[str], rows: int = FRAME_ROWS) -> DataFrame:
    """Per row of the frame, the next row's values minus its own."""
    def build(w):
        return {f"_d_{c}": F.lead(c, 1).over(w) - F.col(c) for c in columns} | {
            "_next": F.lead(F.lit(1), 1).over(w)
        }

    stepped = o.near(0, 1, build).drop(*columns).withColumnsRenamed({f"_d_{c}": c for c in columns})
    usable = Ordered(stepped.where("_next IS NOT NULL").drop("_next"), o.keys, o.order, o.page_rows, o.paged)
    return frames(usable, columns, rows)


def price_relative(o: Ordered, rows: int = FRAME_ROWS, price: str = PRICE) -> DataFrame:
    """Next price over current price, both after the frame that starts at the row."""
    built = o_.offsets(o, {"current_price": (price, rows), "next_price": (price, rows + 1)})
    relative = F.col("next_price") / F.nullif(F.col("current_price"), F.lit(0.0))
    return o_.plain(built.where("next_price IS NOT NULL").withColumn("price_relative", relative))


def delta(o: Ordered, column: str, name: str = "delta") -> DataFrame:
    """Change since the row before; the first row of a key has none and is left out."""
    built = o_.offsets(o, {"_before": (column, -1)})
    changed = built.where(F.col("_pos") > 1).withColumn(name, F.col(column) - F.col("_before"))
    return o_.plain(changed.drop("_before"))


def bounded_series(o: Ordered, columns: Sequence[str], bars: int = SERIES_BARS) -> DataFrame:
    """The last ``bars`` rows up to and including each row, oldest first."""
    return o_.plain(o.near(bars - 1, 0, lambda w: {"series": _frame(columns, -(bars - 1), 0)(w)}))


def observation_pairs(o: Ordered, columns: Sequence[str], rows: int = FRAME_ROWS) -> DataFrame:
    """Frames with the row two after their end as target."""
    built = o.near(0, rows + 1, lambda w: {
        "frame": _frame(columns, 0, rows - 1)(w),
        "target": F.lead(F.struct(*columns), rows + 1).over(w),
    })
    return _numbered(built.where("target IS NOT NULL"), None)


def multi_resolution_frames(
    fine: DataFrame,
    coarse: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = INSTRUMENT,
    time: str = "window_end",
    rows: int = FRAME_ROWS,
    page_rows: int | None = None,
    large: bool | None = None,
) -> DataFrame:
    """Each full fine frame with the first ``rows`` coarse rows at or after its first row's time.

    A coarse frame near the end of the coarse rows is shorter, and empty after it. Keys that fit a task
    are built in one: rows are shuffled once, frames never. ``large``: whether a key of either input has
    more than ``page_rows`` rows, if the caller knows.
    """
    if large is None:
        large = o_.has_large_keys(fine, keys, page_rows) or o_.has_large_keys(coarse, keys, page_rows)
    marks = fine.select(*keys, F.col(time).alias("time"), F.lit(0).alias("_coarse"), F.struct(*columns).alias("_values")).unionByName(
        coarse.select(*keys, F.col(time).alias("time"), F.lit(1).alias("_coarse"), F.struct(*columns).alias("_values"))
    )
    if large:
        paged = _with_reach(o_.ordered(marks, keys, ["time", "_coarse"], page_rows), rows)
        cut = _cut_resolutions(paged, [*keys, "_page"], rows).where("_home")
    else:
        cut = _cut_resolutions(marks, keys, rows)
    return cut.select(*keys, "time", "fine_frame", "coarse_frame")


def _cut_resolutions(marks: DataFrame, group: Sequence[str], rows: int) -> DataFrame:
    """The full fine frames of each group, with the frame that begins at the next coarse row."""
    # Frames of either kind, then, from the end of the time line, the frame of the next coarse row. A coarse
    # row of the same time is still to come for a fine one.
    own = Window.partitionBy(*group, "_coarse").orderBy("time").rowsBetween(0, rows - 1)
    back = Window.partitionBy(*group).orderBy(F.desc("time"), F.desc("_coarse")).rowsBetween(Window.unboundedPreceding, 0)
    # Spread by group first: the window over one kind would spread its rows, and the next one then its frames.
    spread = marks.repartition(*group) if group else marks
    framed = spread.withColumn("_frame", F.collect_list("_values").over(own)).drop("_values")
    ahead = F.last(F.when(F.col("_coarse") == 1, F.col("_frame")), ignorenulls=True).over(back)
    built = framed.withColumn("_ahead", ahead).where((F.col("_coarse") == 0) & (F.size("_frame") == rows))
    empty = F.array().cast(built.schema["_frame"].dataType)
    return built.withColumnRenamed("_frame", "fine_frame").withColumn("coarse_frame", F.coalesce("_ahead", empty))


def _with_reach(line: Ordered, rows: int) -> DataFrame:
    """The time line of both kinds, with a copy in each page of the rows that its frames need from later pages.

    Those are the next ``rows - 1`` fine and the next ``rows`` coarse rows after the page, however far on they lie;
    they are named by their number within their kind, without their values, and fetched by position. ``_home``: not a copy.
    """
    own = line.df.drop("_pos", "_hot").withColumn("_home", F.lit(True))
    if not line.paged:
        return own
    narrow = replace(line, df=line.df.drop("_values"))
    numbered = o_.running_sum(narrow, "_before", F.col("_coarse")).withColumn(
        "_number", F.when(F.col("_coarse") == 1, F.col("_before")).otherwise(F.col("_pos") - F.col("_before"))
    )
    hot = numbered.where("_hot").select(*line.group, "_coarse", "_number", "_pos")
    so_far = Window.partitionBy(*line.keys).orderBy("_page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = hot.groupBy(*line.group).agg(F.sum(1 - F.col("_coarse")).alias("_fine"), F.sum("_coarse").alias("_big")).select(
        *line.group, "_fine", F.sum("_fine").over(so_far).alias("_fine_end"), F.sum("_big").over(so_far).alias("_big_end")
    ).where("_fine > 0")
    reach = F.array(
        *[F.struct(F.lit(0).alias("_coarse"), (F.col("_fine_end") + i).alias("_number")) for i in range(1, rows)],
        *[F.struct(F.lit(1).alias("_coarse"), (F.col("_big_end") + i).alias("_number")) for i in range(1, rows + 1)],
    )
    wanted = ends.select(*line.keys, F.col("_page").alias("_to"), F.inline(reach))
    named = o_.null_safe_join(wanted, hot.drop("_page"), [*line.keys, "_coarse", "_number"]).select(*line.keys, "_pos", "_to")
    copies = o_.null_safe_join(line.df.where("_hot").drop("_page"), named, [*line.keys, "_pos"])
    return own.unionByName(copies.drop("_pos", "_hot").withColumnRenamed("_to", "_page").withColumn("_home", F.lit(False)))


def reindex(rows: DataFrame, index: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Index columns first, unwanted ones gone."""
    gone = {*index, *drop}
    return rows.select(*index, *[c for c in rows.columns if c not in gone])


def select_preset(features: DataFrame, preset: Sequence[str], control: Sequence[str] = (*INSTRUMENT, "window_end")):
    return features.select(*control, *preset)


def from_older_names(features: DataFrame, levels: int = 10) -> DataFrame:
    return features.withColumnsRenamed(older_names(levels))


def to_older_names(features: DataFrame, levels: int = 10, control: Sequence[str] = (*INSTRUMENT, "window_end")) -> DataFrame:
    return features.select(*control, *[F.col(c).alias(older) for older, c in older_names(levels).items()])
