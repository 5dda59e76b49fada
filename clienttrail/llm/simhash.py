"""SimHash near-duplicates: fingerprints joined on shared blocks, verified by Hamming distance.

A 64-bit fingerprint is cut into six pieces. Fingerprints that differ in at most three bits agree on
at least three pieces, so each fingerprint is filed under its twenty choices of three pieces; keys have
about 32 bits, so chance company stays rare at billions of texts. Only distinct fingerprints are
filed, a group of copies being one of them. Within a block only edges that span its linked parts are
reported, never all pairs. Blocks are counted before anything is joined: a block of two is judged from its
least and largest fingerprint, and only larger ones are listed. Fingerprints of a block with very many are
filed anew by more pieces, at last by thirteen of sixteen: no such block can hold more than 4096.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clienttrail.llm.common import one_row_per_document, read_table, stored, text_key, values_of
from clienttrail.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
#: Pieces of a fingerprint, level by level: 20, 56, 220 and 560 choices. A block of the last level holds 4096
#: different fingerprints at most.
PIECES = (6, 8, 12, 16)
#: Fingerprints in one block that one task compares; larger blocks are filed by more pieces.
BLOCK_ROWS = 8192
_CHUNK = 1 << 16
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles, unsigned; 0 for a text without words."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = iter([b" ".join(words)])
        count = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
        count = len(words) - shingle_words + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, _CHUNK):
        part = hashes[start : start + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fingerprint() of the texts, as the signed long with the same bits; one text at a time."""
    names = ["doc_id", "key_a", "key_b"]
    for batch in batches:
        prints = np.fromiter(map(fingerprint, values_of(batch.column("text"))), np.uint64, len(batch))
        arrays = [batch.column(c) for c in names] + [pa.array(prints.view(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, [*names, "print"])


def _masks(pieces: int, shared: int) -> list[int]:
    """Bit masks of every choice of `shared` out of `pieces` nearly equal pieces, as signed longs."""
    ends = [round(64 * i / pieces) for i in range(pieces + 1)]
    piece = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(ends, ends[1:])]
    masks = [sum(chosen) for chosen in combinations(piece, shared)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _filed(prints: DataFrame, masks: list[int]) -> DataFrame:
    """A row (choice, block, print) for each fingerprint and mask."""
    blocks = F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in masks])
    return prints.select(F.posexplode(blocks).alias("choice", "block"), "print")


def spanning_links(prints: np.ndarray, distance: int = MAX_DISTANCE) -> tuple[list[int], list[int]]:
    """Edges that connect the same prints as all pairs within the distance do, one less than prints at most.

    Breadth first: each reached print is compared with the prints not reached yet only.
    """
    left = np.unique(prints.astype(np.int64)).view(np.uint64)
    source: list[int] = []
    target: list[int] = []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(left ^ at) <= distance
            found = left[near]
            source += [int(at)] * len(found)
            target += found.tolist()
            front += list(found)
            left = left[~near]
    return source, target


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("prints")
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        sizes = np.diff(ends, prepend=0)
        # Pairs, by far the most blocks, in one step; larger blocks one by one.
        at = ends[sizes == 2] - 2
        a, b = values[at].view(np.uint64), values[at + 1].view(np.uint64)
        near = np.bitwise_count(a ^ b) <= MAX_DISTANCE
        source, target = [a[near]], [b[near]]
        for end, size in zip(ends[sizes > 2], sizes[sizes > 2]):
            one, two = spanning_links(values[end - size : end])
            source.append(np.array(one, np.uint64))
            target.append(np.array(two, np.uint64))
        a, b = np.concatenate(source).view(np.int64), np.concatenate(target).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _blocks(prints: DataFrame, pieces: int) -> DataFrame:
    """Blocks of two prints or more: choice, block, size and the least and largest print, stored.

    Counts combine before they shuffle, and most blocks end here: alone, or as a pair.
    """
    blocks = _filed(prints, _masks(pieces, pieces - MAX_DISTANCE)).groupBy("choice", "block")
    summed = blocks.agg(
        F.count("*").alias("size"), F.min("print").alias("low"), F.max("print").alias("high")
    )
    return stored(summed.where("size > 1"), "blocks")


def _members(prints: DataFrame, pieces: int, blocks: DataFrame) -> DataFrame:
    filed = _filed(prints, _masks(pieces, pieces - MAX_DISTANCE))
    return filed.join(blocks.select("choice", "block"), ["choice", "block"])


def near_links(prints: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all pairs within three bits.

    Fingerprints of blocks with more than block_rows are filed by more pieces, level by level.
    """
    found: DataFrame | None = None
    for level, pieces in enumerate(PIECES):
        blocks = _blocks(prints, pieces)
        near = F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= MAX_DISTANCE
        links = blocks.where((F.col("size") == 2) & near).select(F.col("low").alias("a"), F.col("high").alias("b"))
        last = level == len(PIECES) - 1
        larger = blocks.where(F.col("size") > 2)
        listed = larger if last else larger.where(F.col("size") <= block_rows)
        lists = _members(prints, pieces, listed).groupBy("choice", "block")
        lists = lists.agg(F.collect_list("print").alias("prints")).select("prints")
        links = links.unionAll(lists.mapInArrow(_links, "a long, b long"))
        found = links if found is None else found.unionAll(links)
        crowded = blocks.where(F.col("size") > block_rows)
        if last or crowded.isEmpty():
            return found
        prints = stored(_members(prints, pieces, crowded).select("print").distinct(), "crowded")


def near_duplicate_groups(prints: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add component_id, the smallest doc_id reachable, and group, the group's smallest print, to rows
    with doc_id and print.

    Rows linked to nothing carry their own doc_id; null ids are never the smallest, and a component
    with null ids alone has a null component_id. Repeated rows stay. Extra columns stay.
    """
    distinct = stored(
        prints.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")),
        "prints",
    )
    roots = stored(connected_components(near_links(distinct.select("print"), block_rows)), "roots")
    linked = roots.join(distinct, F.col("node") == F.col("print"))
    firsts = linked.groupBy("root").agg(F.min("first_id").alias("component"))
    of_linked = roots.join(firsts, "root").select(F.col("node").alias("of_print"), "root", "component")
    of_copies = (
        distinct.where("rows > 1")
        .join(roots, F.col("node") == F.col("print"), "left_anti")
        .select(F.col("print").alias("of_print"), F.col("print").alias("root"), F.col("first_id").alias("component"))
    )
    known = of_linked.unionAll(of_copies)
    joined = prints.join(known, F.col("print") == F.col("of_print"), "left")
    own = F.when(F.col("of_print").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    group = F.coalesce("root", prints["print"])
    columns = [prints[c] for c in prints.columns]
    return joined.select(*columns, group.alias("group"), own.alias("component_id"))


def document_prints(documents: DataFrame) -> DataFrame:
    """doc_id, text key and fingerprint of every row, stored: both passes below read it."""
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *text_key())
    kinds = "doc_id long, key_a long, key_b long, print long"
    return stored(keyed.mapInArrow(_fingerprints, kinds), "document-prints")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id.

    Null and wordless texts have the fingerprint 0 and are linked like any other.
    """
    groups = near_duplicate_groups(document_prints(documents))
    return groups.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_of_each_group(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates the row with the smallest doc_id stays."""
    groups = near_duplicate_groups(document_prints(documents))
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key_a", "key_b")
    chosen = groups.groupBy("group").agg(F.min(row).alias("row")).select("row.*")
    return one_row_per_document(documents, chosen)


def op7_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
