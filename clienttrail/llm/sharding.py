"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns several places on a ring of 2^14 cells. A document starts at the next place clockwise of
its doc_id's hash. A shard that is asked to take more than it may keeps the documents whose hashes are
smallest; the others go on clockwise to the next shard that is not full. Documents so move together, one
step at a time, and every step but the last fills at least one shard: there are as many steps as shards at
most, each over the documents left only. A step is decided by one hash for each crowded shard, found by
counting ever finer ranges of hashes, so the driver sees counts and no documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, stored

SHARDS = 40
#: Places of each shard on the ring.
REPLICAS = 64
#: Bytes that a document takes beside its text.
ROW_BYTES = 16
CELL_BITS = 14
#: Bits of a hash by which each counting pass narrows a range down, and keys that are listed rather than narrowed.
RANGE_BITS, LISTED = 12, 4096
#: Rows numbered together, and copies of one row that one task writes.
NUMBERED, RUN = 50_000, 100_000
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1
_KEY = ["doc_id", "size", "text_crc32"]


def ring(shards: int, replicas: int = REPLICAS) -> tuple[np.ndarray, np.ndarray]:
    """For each cell the arc it lies in, and for each arc its shards, nearest clockwise first.

    The places of a shard do not depend on how many shards there are. Of two places in one cell the one
    with the smaller hash takes its arc.
    """
    places = sorted((xxhash.xxh64_intdigest(f"{s}:{r}"), s) for s in range(shards) for r in range(replicas))
    cells = np.array([place >> (64 - CELL_BITS) for place, _ in places])
    arc = np.searchsorted(cells, np.arange(1 << CELL_BITS)) % len(places)
    owners = [shard for _, shard in places]
    walks = [list(dict.fromkeys(owners[i:] + owners[:i])) for i in range(len(places))]
    return arc, np.array(walks)


def _listed(values: Sequence[int], kind: str = "int") -> Column:
    """A constant array; one text is parsed faster than thousands of literals."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast(f"array<{kind}>")


def _keys(documents: DataFrame, arcs: np.ndarray) -> DataFrame:
    """Distinct (doc_id, size, crc) with the number of their rows, their arc and 128 hash bits."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    keys = rows.groupBy(*_KEY).agg(F.count("*").alias("copies"))
    nameless = F.when(F.col("doc_id").isNull(), F.struct("size", "text_crc32"))
    cell = F.shiftrightunsigned(F.xxhash64(F.lit("ring"), "doc_id", nameless), 64 - CELL_BITS)
    return keys.select(
        *_KEY,
        "copies",
        F.get(_listed(arcs), cell.cast("int")).alias("arc"),
        F.xxhash64(*_KEY).alias("p"),
        F.xxhash64(F.lit("second"), *_KEY).alias("q"),
    )


def _quotas(homes: dict[int, int], shards: int, slack: float) -> np.ndarray:
    """Rows that each shard may take: without slack floor or ceiling of the mean, the more for those that
    are most asked for."""
    rows = sum(homes.values())
    if slack:
        return np.full(shards, ceil((1 + slack) * rows / shards), np.int64)
    quota = np.full(shards, rows // shards, np.int64)
    order = sorted(range(shards), key=lambda s: (-homes.get(s, 0), s))
    quota[order[: rows % shards]] += 1
    return quota


def _cuts(asked: DataFrame, room: np.ndarray) -> dict[int, tuple[int, int, int]]:
    """For each shard asked for more rows than it has room: the hashes (p, q) of the last key that it may
    take, in their order, and how many copies of that key."""
    cuts: dict[int, tuple[int, int, int]] = {}
    pending: dict[int, tuple[int, int]] = {}
    shift = 64 - RANGE_BITS
    part = asked
    while True:
        # Bounded: a count for each shard and range.
        counted = (
            part.groupBy("shard", F.shiftright("p", shift).alias("range"))
            .agg(F.sum("copies").alias("copies"), F.count("*").alias("keys"))
            .collect()
        )
        listed = 0
        by_shard: dict[int, list[tuple[int, int, int]]] = {}
        for shard, at, copies, keys in counted:
            by_shard.setdefault(shard, []).append((at, copies, keys))
        for shard, ranges in by_shard.items():
            left = pending[shard][1] if shard in pending else int(room[shard])
            if shard not in pending and sum(c for _, c, _ in ranges) <= left:
                continue
            for at, copies, keys in sorted(ranges):
                if copies > left:
                    pending[shard] = (at, left)
                    listed = max(listed, keys)
                    break
                left -= copies
        if not pending:
            return cuts
        ranges = _listed([pending.get(s, (_LAST, 0))[0] for s in range(len(room))], "bigint")
        crowded = _listed([s in pending for s in range(len(room))])
        part = asked.where(
            (F.get(crowded, F.col("shard")) == 1)
            & (F.shiftright("p", shift) == F.get(ranges, F.col("shard")))
        )
        if listed <= LISTED or not shift:
            break
        shift = max(0, shift - RANGE_BITS)
    rows: dict[int, list[tuple[int, int, int]]] = {}
    for shard, p, q, copies in part.select("shard", "p", "q", "copies").collect():
        rows.setdefault(shard, []).append((p, q, copies))
    for shard, (_, left) in pending.items():
        for p, q, copies in sorted(rows[shard]):
            if copies > left:
                cuts[shard] = (p, q, left)
                break
            left -= copies
    return cuts


def _taken(cuts: dict[int, tuple[int, int, int]], shards: int) -> Column:
    """How many copies of a key its shard takes."""
    if not cuts:
        return F.col("copies")
    ends = [cuts.get(s, (_LAST, _LAST, 0)) for s in range(shards)]
    p, q, some = (F.get(_listed([e[k] for e in ends], "bigint"), F.col("shard")) for k in range(3))
    crowded = F.get(_listed([s in cuts for s in range(shards)]), F.col("shard")) == 1
    before = (F.col("p") < p) | ((F.col("p") == p) & (F.col("q") < q))
    last = (F.col("p") == p) & (F.col("q") == q)
    return F.when(~crowded | before, F.col("copies")).when(last, some).otherwise(F.lit(0))


def _placed(keys: DataFrame, walks: np.ndarray, shards: int, slack: float) -> DataFrame:
    """Keys with shard, home and the copies placed there; a key cut by a full shard has a row for each."""
    home = F.get(_listed(walks[:, 0]), F.col("arc"))
    homes = {s: n for s, n in keys.groupBy(home).agg(F.sum("copies")).collect()}
    room = _quotas(homes, shards, slack)
    parts: list[DataFrame] = []
    left = keys
    while True:
        free = room > 0
        first = walks[np.arange(len(walks)), free[walks].argmax(axis=1)]
        asked = left.withColumn("shard", F.get(_listed(first), F.col("arc")))
        cuts = _cuts(asked, room)
        asked = asked.withColumn("taken", _taken(cuts, shards))
        columns = [*_KEY, "p", "q", "shard", home.alias("home")]
        parts.append(asked.where("taken > 0").select(*columns, F.col("taken").alias("copies")))
        if not cuts:
            break
        taken = parts[-1].groupBy("shard").agg(F.sum("copies")).collect()
        for shard, copies in taken:
            room[shard] -= copies
        rest = asked.where("taken < copies").withColumn("copies", F.col("copies") - F.col("taken"))
        left = stored(rest.drop("shard", "taken"), "ring-left")
    placed = parts[0]
    for part in parts[1:]:
        placed = placed.unionAll(part)
    return placed


def _numbered(placed: DataFrame, rows: int, shards: int) -> DataFrame:
    """Add slot, the first slot of a key's copies: gapless from 0 in each shard, in the order of (p, q).

    Ranges of hashes are numbered alone and moved by what lies before them.
    """
    bits = max(0, ceil(rows / (shards * NUMBERED)) - 1).bit_length()
    at = F.shiftright("p", 64 - bits) if bits else F.lit(0).cast("long")
    ranged = placed.withColumn("range", at)
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("shard", "range")
        .agg(F.sum("copies").alias("copies"))
        .select("shard", "range", F.coalesce(F.sum("copies").over(before), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("shard", "range").orderBy("p", "q").rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.withColumn("inner", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    return inner.join(starts, ["shard", "range"]).select(
        *_KEY, "copies", "shard", "home", (F.col("start") + F.col("inner")).alias("slot")
    )


def _every_copy(numbered: DataFrame) -> DataFrame:
    """One row for each copy; a row with very many copies is dealt to several tasks."""

    def spelled(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        slot = F.explode(F.sequence(first, last)).alias("slot")
        return rows.select(*_KEY, "shard", "home", slot)

    end = F.col("slot") + F.col("copies") - 1
    few = spelled(numbered.where(F.col("copies") <= RUN), F.col("slot"), end)
    starts = F.explode(F.sequence("slot", end, F.lit(RUN).cast("long"))).alias("start")
    many = numbered.where(F.col("copies") > RUN).select(*_KEY, "shard", "home", end.alias("end"), starts)
    many = many.repartition("shard", "start")
    return few.unionAll(spelled(many, F.col("start"), F.least(F.col("start") + RUN - 1, F.col("end"))))


def ring_shards(
    documents: DataFrame, shards: int = SHARDS, replicas: int = REPLICAS, slack: float = 0.0
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, home (its shard if none were full) and slot in the shard.

    No shard takes more than (1 + slack) times the mean; without slack row counts are at most one apart.
    Less slack means more rows beyond their home: each shard that is added takes its share from all others,
    and what overflows may move as well.

    A null text has the bytes of an empty one; texts are read whole, of any length, and never shuffled. The
    place on the ring depends on doc_id alone, for null ids on the text. Rows equal in doc_id, size and crc
    travel as one row and a count, so one id may hold any share of the rows; repeated rows are all placed,
    each in its own slot, on several shards if one is full. Ties in the hashes of different rows are decided
    by a second hash. Other columns are not read, whatever their names. No rows give no rows.
    """
    arcs, walks = ring(shards, replicas)
    keys = stored(_keys(documents, arcs), "ring-keys")
    rows = keys.agg(F.sum("copies")).first()[0] or 0
    placed = stored(_placed(keys, walks, shards, slack), "ring-placed")
    return _every_copy(stored(_numbered(placed, rows, shards), "ring-slots"))


def op11_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 by the law of rows; grown_shard is null, as that law has none."""
    found = ring_shards(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("home").alias("home_shard"),
    )
