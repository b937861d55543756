"""Row order inside a junction's series without a window over the whole junction.

A junction may hold a large part of all readings, so rows are ranked inside pieces of its series
and the pieces are lined up by their sizes. A piece is a calendar month, or a block of rows that an
earlier step has cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "SeriesBlock"


def number_rows(series: DataFrame, piece: str | None = None) -> DataFrame:
    """Append RowNo, counted from 1 by DateTime inside the junction, and RowCount of the junction.

    ``piece`` names a column that never falls as DateTime rises; default is the month.
    """
    cut = piece or "_month"
    pieces = series if piece else series.withColumn("_month", F.trunc("DateTime", "month"))
    line = Window.partitionBy("Junction").orderBy(cut)
    starts = (
        pieces.groupBy("Junction", cut)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            "Junction",
            cut,
            F.coalesce(F.sum("_size").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.sum("_size").over(Window.partitionBy("Junction")).alias("RowCount"),
        )
    )
    inside = Window.partitionBy("Junction", cut).orderBy("DateTime")
    numbered = (
        pieces.withColumn("_at", F.row_number().over(inside))
        .join(starts, ["Junction", cut])
        .withColumn("RowNo", F.col("_before") + F.col("_at"))
    )
    return numbered.select(*series.columns, "RowNo", "RowCount")


def add_lags(series: DataFrame, lags: dict[str, int], value: str = "Vehicles", block_rows: int = 4096) -> DataFrame:
    """Append earlier values of the series by row distance, as {column: distance}.

    The numbered series is cut into blocks of equal length. The last rows of a block are also sent
    to the next one, so each block sees what its first rows look back on. Keeps the block number,
    which orders the rows of a junction as well, in the column SeriesBlock.
    """
    reach = max(lags.values())
    if block_rows < reach:
        raise ValueError(f"block_rows must be at least the longest lag ({reach})")
    at = F.col("RowNo") - 1
    block = F.floor(at / block_rows).cast("int")
    last_block = F.floor((F.col("RowCount") - 1) / block_rows).cast("int")
    here = F.struct(block.alias("block"), F.lit(False).alias("copy"))
    ahead = F.struct((block + 1).alias("block"), F.lit(True).alias("copy"))
    looked_back_on = (at % block_rows >= block_rows - reach) & (block < last_block)
    spread = number_rows(series).withColumn(
        "_to", F.explode(F.when(looked_back_on, F.array(here, ahead)).otherwise(F.array(here)))
    ).withColumns({BLOCK: F.col("_to.block"), "_copy": F.col("_to.copy")})
    window = Window.partitionBy("Junction", BLOCK).orderBy("RowNo")
    return (
        spread.withColumns({name: F.lag(value, distance).over(window) for name, distance in lags.items()})
        .where(~F.col("_copy"))
        .select(*series.columns, *lags, BLOCK)
    )
