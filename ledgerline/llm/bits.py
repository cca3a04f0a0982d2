"""A bit table of fixed size that lets through all rows of some hashes and few others: for texts that should not be moved in vain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import save

#: The table has 2^BITS bits: 2,048 rows of 4 KB, whatever the input's size. One that fills up lets more through.
BITS = 26
_PAGE = 32_768  # bits of one row of Spark's bitmaps


def _at(column: str, bits: int) -> Column:
    return F.pmod(F.col(column), F.lit(1 << bits))


def bit_table(hashes: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """page and bitmap: the bits of all hashes (longs), as rows of 4 KB."""
    at = _at(column, bits)
    return hashes.groupBy(F.floor(at / _PAGE).alias("page")).agg(F.bitmap_construct_agg((at % _PAGE).cast("int")).alias("bitmap"))


def may_have(rows: DataFrame, hashes: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """The rows whose ``column`` is among the ``column`` of ``hashes``, and by chance some others."""
    return told_apart(rows, hashes, column, bits)[0]


def told_apart(rows: DataFrame, hashes: DataFrame, column: str, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """The rows that ``may_have`` gives, and all others."""
    table = F.broadcast(save(bit_table(hashes, column, bits), "bits"))
    at = _at(column, bits)
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(at % _PAGE / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    has = F.getbit(byte, (at % 8).cast("int")) == 1
    paged = rows.withColumn("page", F.floor(at / _PAGE))
    others = paged.join(table, "page", "left").filter(~F.coalesce(has, F.lit(False)))
    return paged.join(table, "page").filter(has).drop("page", "bitmap"), others.drop("page", "bitmap")
