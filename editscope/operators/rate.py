"""High-rate accounts: ``n`` or more edits in the trailing ``seconds``, known bots excepted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import MICROS, event_micros, floor_div


def suspicious_flag(
    edits: DataFrame,
    seconds: int = 60,
    n: int = 10,
    *,
    user: str = "user",
    time_col: str = "ts",
    id_col: str = "event_id",
    bot_col: str = "is_bot",
    out: str = "is_suspicious",
    hot_rows: int = 20_000,
    max_hot: int = 20_000,
    cells_per_bucket: int = 8,
    spread: int = 8192,
) -> DataFrame:
    """Add ``out``: true when a non-bot has ``n`` edits in ``(ts - seconds, ts]``, this one
    included. Bots are neither tested nor counted; rows without a user or time are false.
    Equal times are taken in the order of ``id_col``, a unique whole number.

    An edit reaches the rate exactly when the edit ``n - 1`` places before it is young enough.
    So one lag over (user, time bucket) decides, with the last ``seconds`` of a bucket copied
    into the next one as context: a busy account is split by time, and one shuffle is enough.

    Time does not split an account that sends everything at once. Cells (user, ``seconds``
    long span) of ``hot_rows`` rows or more are therefore thinned first. Within a cell, any row
    after the first ``n - 1`` has reached the rate, and no later row looks further back than
    the last ``n - 1``; the rows between are decided without the window and are spread, like
    the rows of bots, over ``spread`` groups a user. A cell is hot from ``hot_rows`` rows and a
    ``max_hot``-th of all tracked rows on. No more than ``max_hot`` cells can have that share, so
    their list, which is broadcast, is bounded without cutting it off; a smaller cell is no
    burden to its task. The counting and the thinning read the edits again, so run this on landed
    edits rather than on unparsed text.

    Ids that are not unique are told apart by a hash of the row, so edits without a revision do
    not stick together; only rows equal in every column do.
    """
    names = sorted(c for c in edits.columns if c != out)
    span = seconds * MICROS
    micros = event_micros(edits, time_col)
    known = F.col(user).isNotNull() & F.col(time_col).isNotNull()
    tracked = ~F.coalesce(F.col(bot_col), F.lit(False)) & known
    rows = edits.withColumns(
        {
            "_us": micros,
            "_tracked": tracked,
            "_cell": F.when(tracked, floor_div(micros, span)),
            "_tie": F.xxhash64(*names),
        }
    )
    if n <= 1:
        return rows.withColumn(out, F.col("_tracked")).drop("_us", "_tracked", "_cell", "_tie")

    cell = [user, "_cell"]
    inner = _hot_cell_interior(rows, cell, id_col, n, max(hot_rows, 2 * n), max_hot)
    place = F.struct("_us", F.col(id_col).alias("id"), "_tie")
    decided = F.coalesce((place > F.col("_head_end")) & (place < F.col("_tail_start")), F.lit(False))
    free = F.col("_decided") | ~F.col("_tracked")
    home = floor_div(F.col("_cell"), cells_per_bucket)
    last_cell = F.pmod(F.col("_cell"), F.lit(cells_per_bucket)) == cells_per_bucket - 1
    spread_over = F.pmod(F.xxhash64(id_col, "_us", "_tie"), F.lit(spread)) + 1
    own_and_next = F.when(~free & last_cell, F.array(home, home + 1)).otherwise(F.array(home))
    placed = (
        rows.join(F.broadcast(inner), cell, "left")
        .withColumn("_decided", decided)
        .withColumns(
            {
                "_part": F.when(free, spread_over).otherwise(F.lit(0)),
                "_home": home,
                "_bucket": F.explode(own_and_next),
            }
        )
    )
    order = Window.partitionBy(user, "_bucket", "_part").orderBy("_us", id_col, "_tie")
    young = F.lag("_us", n - 1).over(order) > F.col("_us") - span
    flagged = placed.withColumn("_young", F.coalesce(young, F.lit(False))).filter(
        F.col("_bucket").eqNullSafe(F.col("_home"))
    )
    result = F.col("_tracked") & (F.col("_decided") | F.col("_young"))
    columns = [c for c in edits.columns if c != out]
    return flagged.select(*columns, result.alias(out))


def _hot_cell_interior(
    rows: DataFrame, cell: list[str], id_col: str, n: int, hot_rows: int, max_hot: int
) -> DataFrame:
    """For each hot cell, the places of its ``n - 1``-th row from either end. At most
    ``max_hot`` rows, since each cell has that share of all; with no hot cell, adaptive execution
    drops everything after the count.
    """
    tracked = rows.filter("_tracked").select(*cell, "_us", F.col(id_col).alias("_id"), "_tie")
    share = rows.agg(F.count_if("_tracked") / max_hot).scalar()
    hot = (
        tracked.groupBy(cell)
        .agg(F.count("*").alias("_rows"))
        .filter((F.col("_rows") >= hot_rows) & (F.col("_rows") >= share))
        .select(*cell)
    )
    # One pass finds both ends: each row stands for itself and for its mirror image, whose order
    # is reversed. The rank filter becomes a group limit, which cuts every map task's rows
    # to n - 1 a cell and side before the shuffle.
    mirrored = F.array(
        F.struct(
            F.lit(True).alias("head"), F.col("_us").alias("us"), F.col("_id").alias("id"), F.col("_tie").alias("tie")
        ),
        F.struct(
            F.lit(False).alias("head"),
            F.bitwise_not("_us").alias("us"),
            F.bitwise_not("_id").alias("id"),
            F.bitwise_not("_tie").alias("tie"),
        ),
    )
    sides = tracked.join(F.broadcast(hot), cell).select(*cell, F.inline(mirrored))
    rank = F.row_number().over(Window.partitionBy(*cell, "head").orderBy("us", "id", "tie"))
    ends = sides.withColumn("_rank", rank).filter(F.col("_rank") <= n - 1)
    place = F.struct("us", "id", "tie")
    back = F.struct(
        F.bitwise_not("us").alias("us"), F.bitwise_not("id").alias("id"), F.bitwise_not("tie").alias("tie")
    )
    return ends.groupBy(cell).agg(
        F.max(F.when(F.col("head"), place)).alias("_head_end"),
        F.min(F.when(~F.col("head"), back)).alias("_tail_start"),
    )
