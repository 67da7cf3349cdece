"""Membership filters: a key set as bitmaps, to thin rows before they are shuffled.

A key set that is too large to broadcast can still be sent as a few bits a key.
The filter is a block Bloom filter from Spark's bitmap aggregates: a key's hash
picks a block of ``BLOCK_BITS`` bits (one bitmap) and ``HASHES`` bits in it.  Keys
are never lost; a row whose key is not in the set passes with a small, stated
probability and is removed by the exact join behind.  Filters of the same shape
merge by or-ing their blocks, so those of days or batches can be kept and united.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .algebra import audience

#: Bits of a bitmap aggregate, and of a block.
BLOCK_BITS = 32768
#: Bits that a key sets: 15 bits of one 64-bit hash each.
HASHES = 4
BITS_PER_KEY = 12
#: Filters of more bytes are not sent; the exact join then works alone.
FILTER_MAX = 128 << 20


def _block(on: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(on), F.lit(11)), F.lit(blocks)).cast("int")


def _places(on: str) -> list[Column]:
    h = F.xxhash64(F.lit(13), F.col(on))
    return [F.shiftright(h, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)]


@dataclass(frozen=True)
class KeyFilter:
    """``bits``: ``block, bits`` of the blocks that have keys; ``kind``: the keys' type."""

    bits: DataFrame
    blocks: int
    kind: str

    @property
    def size(self) -> int:
        """Bytes of the filter at most."""
        return self.blocks * BLOCK_BITS // 8

    def merge(self, other: KeyFilter) -> KeyFilter:
        if (self.blocks, self.kind) != (other.blocks, other.kind):
            raise ValueError("filters of different shape")
        both = self.bits.unionByName(other.bits)
        return replace(self, bits=both.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")))


def blocks_for(n_keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    return max(1, math.ceil(n_keys * bits_per_key / BLOCK_BITS))


def false_positive_rate(n_keys: int, blocks: int) -> float:
    """The share of other keys that pass, expected."""
    return (1 - math.exp(-HASHES * n_keys / (blocks * BLOCK_BITS))) ** HASHES


def key_filter(keys: DataFrame, on: str, blocks: int) -> KeyFilter:
    """The filter of the ``on`` values of ``keys``, nulls left out."""
    rows = keys.where(F.col(on).isNotNull()).select(
        _block(on, blocks).alias("block"), F.explode(F.array(*_places(on))).alias("place")
    )
    bits = rows.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))
    return KeyFilter(bits, blocks, keys.schema[on].dataType.simpleString())


def _words(bits: str) -> Column:
    """A bitmap as 64-bit words, the first byte on top."""
    word = lambda i: F.conv(F.hex(F.substring(F.col(bits), 8 * i + 1, F.lit(8))), 16, -10)
    return F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), lambda i: word(i).cast("long"))


def maybe_in(rows: DataFrame, on: str, found: KeyFilter) -> DataFrame:
    """The rows whose ``on`` value is in the filter: all that are in the set, and a few more.

    Rows stay where they are: the blocks are broadcast, ``found.size`` bytes.
    """
    kind = rows.schema[on].dataType.simpleString()
    if kind != found.kind:
        raise ValueError(f"{on!r} is {kind}, the filter's keys are {found.kind}")
    sent = found.bits.select(F.col("block").alias("_block"), _words("bits").alias("_words"))
    hit = _block(on, found.blocks) == F.col("_block")
    for place in _places(on):
        word = F.get("_words", F.shiftright(place, 6).cast("int"))
        shift = (7 - F.shiftright(place, 3) % 8) * 8 + place % 8
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), shift.cast("int"))
        hit = hit & (word.bitwiseAND(mask) != 0)
    return rows.join(F.broadcast(sent), hit, "left_semi")


def semi_join_filtered(
    rows: DataFrame,
    keys: DataFrame,
    on: str,
    keys_on: str | None = None,
    bits_per_key: int = BITS_PER_KEY,
    filter_max: int = FILTER_MAX,
) -> DataFrame:
    """Rows of ``rows`` whose ``on`` value is in ``keys``; only likely ones are shuffled.

    The distinct keys are written once (a checkpoint), as they are counted, put
    into the filter and joined.  Over ``filter_max`` bytes no filter is sent.
    For key sets that are too large to broadcast; below that a plain
    ``restrict_to`` does as well.
    """
    right = cut_lineage(audience(keys, on, source=keys_on))
    blocks = blocks_for(right.count(), bits_per_key)
    found = key_filter(right, on, blocks)
    likely = maybe_in(rows, on, found) if found.size <= filter_max else rows
    return likely.join(right, on, "left_semi")
