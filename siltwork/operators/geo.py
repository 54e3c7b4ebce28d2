"""Places from IP addresses by a range join."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions.network import ipv4_number
from siltwork.operators.keys import number_rows
from siltwork.shared import write_shared

PLACE_FIELDS = ("country", "city", "region")
UNKNOWN = "Unknown"
ADDRESS_BITS = 32


def locate(
    df: DataFrame,
    bands: DataFrame,
    ip_col: str = "ip_address",
    fields: Sequence[str] = PLACE_FIELDS,
    prefix_bits: int = 16,
) -> DataFrame:
    """Add the place of the band that holds each address, or ``Unknown``.

    ``bands`` has ``ip_from``, ``ip_to`` (numbers, inclusive, not overlapping:
    see :func:`flatten_bands`) and ``fields``.  Each band is listed under every address prefix it touches,
    which turns the range test into an equi-join on the prefix with the range as
    a residual condition.  A small band table is then hash-joined without moving
    ``df``; a large one is sort-merged, where adaptive execution splits a prefix
    that holds many rows.
    """
    shift = ADDRESS_BITS - prefix_bits
    listed = bands.select(
        "ip_from",
        "ip_to",
        *(F.col(f).alias(f"_{f}") for f in fields),
        F.explode(F.sequence(F.shiftright("ip_from", shift), F.shiftright("ip_to", shift))).alias("_band_prefix"),
    )
    number = F.col("_number")
    numbered = df.withColumn("_number", ipv4_number(F.col(ip_col))).withColumn("_prefix", F.shiftright(number, shift))
    inside = (F.col("_prefix") == F.col("_band_prefix")) & number.between(F.col("ip_from"), F.col("ip_to"))
    found = numbered.join(listed, inside, "left")
    places = [F.coalesce(F.col(f"_{f}"), F.lit(UNKNOWN)).alias(f) for f in fields]
    return found.select(*df.columns, *places)


def _sweeper():
    """The sweep as a local function, which travels to tasks with its code: they need not have this package."""

    def sweep(table: pa.Table) -> pa.Table:
        """Of the bands in one block, the stretches between their edges with the band that holds each."""
        starts, ends, order = (table.column(n).to_pylist() for n in ("ip_from", "ip_to", "_order"))
        rows = sorted(range(len(starts)), key=lambda k: (starts[k], order[k]))
        out: list[tuple[int, int, int]] = []
        open_bands: list[tuple[int, int]] = []  # by order, the most specific first
        edges = sorted({*starts, *(e + 1 for e in ends)})
        upcoming = 0
        for edge, following in zip(edges, edges[1:]):
            while upcoming < len(rows) and starts[rows[upcoming]] == edge:
                heapq.heappush(open_bands, (order[rows[upcoming]], rows[upcoming]))
                upcoming += 1
            while open_bands and ends[open_bands[0][1]] < edge:
                heapq.heappop(open_bands)
            if open_bands:
                band = open_bands[0][1]
                if out and out[-1][2] == band and out[-1][1] == edge - 1:
                    out[-1] = (out[-1][0], following - 1, band)
                else:
                    out.append((edge, following - 1, band))
        columns = {"ip_from": pa.array([a for a, _, _ in out], pa.int64()), "ip_to": pa.array([b for _, b, _ in out], pa.int64())}
        return pa.table({**columns, "_order": pa.array([order[band] for _, _, band in out], pa.int64())})

    return sweep


def flatten_bands(bands: DataFrame, fields: Sequence[str] = PLACE_FIELDS, prefix_bits: int = 16) -> DataFrame:
    """Bands that may overlap or nest, as bands that do not: of those that hold an address the most specific wins.

    The most specific is the narrowest, of equal width the one that starts later, then the first by ``fields``,
    nulls first; equal bands count once.  Bands that end before they start and null ends are left out.
    Each band is cut at the blocks of ``prefix_bits`` it touches, and the edges of each block are swept on their
    own, so that blocks are worked on in parallel and a task holds the bands of one block.  What comes out has at most
    one row for each edge in a block and two for each block, whatever the depth of the nesting, so that
    :func:`locate` lists no more prefixes than there are blocks and rows.
    """
    valid = bands.where("ip_from <= ip_to").select(F.col("ip_from").cast("long"), F.col("ip_to").cast("long"), *fields).distinct()
    widest_last = [F.col("ip_to") - F.col("ip_from"), F.col("ip_from").desc(), *(F.col(f).asc_nulls_first() for f in fields)]
    ordered = number_rows(valid, widest_last, "_order")
    shift = ADDRESS_BITS - prefix_bits
    block = F.explode(F.sequence(F.shiftright("ip_from", shift), F.shiftright("ip_to", shift))).alias("_block")
    cut = ordered.select("ip_from", "ip_to", "_order", block)
    first, last = F.shiftleft("_block", shift), F.shiftleft(F.col("_block") + 1, shift) - 1
    pieces = cut.select("_block", F.greatest("ip_from", first).alias("ip_from"), F.least("ip_to", last).alias("ip_to"), "_order")
    # Of pieces with equal ends, the most specific band's is enough: a block filled by many wide bands is one piece.
    fewer = pieces.groupBy("_block", "ip_from", "ip_to").agg(F.min("_order").alias("_order"))
    counted = write_shared(fewer.withColumn("_pieces", F.count("*").over(Window.partitionBy("_block"))), "band-pieces")
    alone, several = counted.where("_pieces = 1"), counted.where("_pieces > 1").drop("_pieces")
    swept = several.groupBy("_block").applyInArrow(_sweeper(), "ip_from bigint, ip_to bigint, _order bigint")
    swept = swept.unionByName(alone.select("ip_from", "ip_to", "_order"))
    return swept.join(ordered.select("_order", *fields), "_order").select("ip_from", "ip_to", *fields)
