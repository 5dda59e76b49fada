"""How the sources of a language differ in their terms, priced on hash-consed segment trees.

Terms are counted by language and source. The kept terms of a language are dealt to blocks of bounded size,
terms that occur in equally many sources together. In a block each source's counts are a segment tree over
the block's term ids; equal subtrees are one node, in one source's tree or in several, and ids are given in
the order of the counts, which makes long stretches equal. Two trees are walked together from their roots,
level by level: a pair of nodes that turns up again is the same pair and is priced once. A block gives a part
of the price of each pair of sources, and these parts are summed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, stored

MIN_DOCUMENTS = 3
UNIT, PRIOR = 1_000_000_000, 1
RANKS = 200
#: Terms of a block on average, pairs of sources walked at a time, terms a task counts before it hands them on.
BLOCK_TERMS, WALKED_PAIRS, HELD_TERMS = 3000, 1024, 200_000

# Letters are lower-cased A-Z and every byte of a character beyond ASCII; anything else is a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, documents) in held.items():
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), len(counts)),
                        pa.repeat(pa.scalar(source, pa.string()), len(counts)),
                        pa.array(list(counts), pa.binary()).cast(pa.string()),
                        pa.array(counts.values(), pa.int64()),
                        pa.array([documents[t] for t in counts], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "documents"],
                )

    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for group, text in zip(groups, batch.column("text")):
            terms = terms_of(text.as_py())
            counts, documents = held.setdefault(group, (Counter(), Counter()))
            size -= len(counts)
            counts.update(terms)
            documents.update(set(terms))
            size += len(counts)
            if size >= HELD_TERMS:
                yield from handed()
                held, size = {}, 0
    yield from handed()


def term_counts(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """A row for each language and kept term: lang, term, sources and counts (arrays side by side).

    One shuffle by language and term serves both aggregations.
    """
    counted = documents.mapInArrow(_count, "lang string, source string, term string, n long, documents long")
    by_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents")
    )
    kept = by_source.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("entries")
    )
    return kept.where(F.col("documents") >= min_documents).select(
        "lang", "term", F.col("entries.source").alias("sources"), F.col("entries.n").alias("counts")
    )


class Forest:
    """Segment trees over the same ids, one for each row of counts; equal subtrees are one node.

    Node numbers count within a level; the leaves' numbers are those of the distinct counts, and the number
    after them stands for places without a term.
    """

    def __init__(self, counts: np.ndarray) -> None:
        width = 1 << max(0, counts.shape[1] - 1).bit_length()
        self.counts, nodes = np.unique(counts, return_inverse=True)
        nodes = nodes.reshape(counts.shape)
        self.leaves = nodes
        nodes = np.pad(nodes, ((0, 0), (0, width - counts.shape[1])), constant_values=len(self.counts))
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        self.sizes = [len(self.counts) + 1]
        while nodes.shape[1] > 1:
            size = self.sizes[-1]
            pairs, nodes = np.unique(nodes[:, 0::2] * size + nodes[:, 1::2], return_inverse=True)
            self.children.append((pairs // size, pairs % size))
            self.sizes.append(len(pairs))
            nodes = nodes.reshape(len(counts), -1)
        self.roots = nodes[:, 0]

    def walk(self, first: np.ndarray, second: np.ndarray, price: Callable) -> np.ndarray:
        """The price of each pair of trees (first, second), summed over the ids.

        price takes (pair, number of the first leaf, number of the second) as arrays. Of the node pairs met at
        one level, each different one of a pair of trees is followed once.
        """
        pair, a, b = np.arange(len(first)), self.roots[first], self.roots[second]
        met = []
        for level in range(len(self.children), -1, -1):
            size = self.sizes[level]
            keys, places = np.unique((pair * size + a) * size + b, return_inverse=True)
            pair, a, b = keys // (size * size), keys // size % size, keys % size
            met.append(places)
            if level:
                left, right = self.children[level - 1]
                pair = np.concatenate([pair, pair])
                a, b = np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]])
        value = price(pair, a, b)
        for places in reversed(met[1:]):
            both = value[places]
            value = both[: len(both) // 2] + both[len(both) // 2 :]
        return value[met[0]]


def shares(counts: np.ndarray, totals: list[int], terms: int) -> np.ndarray:
    """p of each total (rows) and count (columns), exact at any size."""
    if len(counts) and int(counts.max()) >= 9_000_000_000:
        rows = [[min(1 + UNIT * (int(c) + PRIOR) // (n + PRIOR * terms), UNIT + 1) for c in counts] for n in totals]
        return np.array(rows, np.int64)
    below = np.array([n + PRIOR * terms for n in totals], np.int64)
    return 1 + UNIT * (counts.astype(np.int64) + PRIOR) // below[:, None]


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    # At most 10^18; the sum over all terms stays below (10^9 + terms)^2.
    return (p - q) * (p - q) // q


_OUT = "lang string, source string, part string, item string, value long"


def _price_block(table: pa.Table) -> pa.Table:
    about = table.filter(pc.is_null(table.column("term"))).to_pylist()[0]
    names, totals, kept = about["sources"], about["counts"], about["kept"]
    table = table.filter(pc.is_valid(table.column("term")))
    terms = table.column("term").combine_chunks().cast(pa.binary()).to_pylist()
    entries = table.column("sources").combine_chunks()
    row = np.repeat(np.arange(len(terms)), entries.value_lengths().to_numpy())
    source = pc.index_in(entries.flatten(), pa.array(names, pa.string())).to_numpy()
    # The last row is the whole language.
    counts = np.zeros((len(names) + 1, len(terms)), np.int64)
    counts[source, row] = table.column("counts").combine_chunks().flatten().to_numpy()
    counts[-1] = counts.sum(axis=0)
    order = np.lexsort(counts)
    counts, terms = counts[:, order], [terms[i] for i in order]
    forest = Forest(counts)
    p = shares(forest.counts, [*totals, sum(totals)], kept)
    # A place without a term costs nothing.
    p = np.concatenate([p, np.ones((len(p), 1), np.int64)], axis=1)

    out: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}

    def add(sources, part, items, values) -> None:
        out["source"] += sources
        out["part"] += [part] * len(sources)
        out["item"] += items
        out["value"] += values

    size = len(names)
    for start in range(0, size * size, WALKED_PAIRS):
        both = np.arange(start, min(start + WALKED_PAIRS, size * size))
        both = both[both // size != both % size]
        first, second = both // size, both % size
        if len(both):
            value = forest.walk(first, second, lambda pair, a, b: _gaps(p[first[pair], a], p[second[pair], b]))
            add([names[i] for i in first], "pair", [names[i] for i in second], value.tolist())

    # For each source its terms that are more frequent than in the language; only the first can be among the
    # first of all blocks.
    rank = np.empty(len(terms), np.int64)
    rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    whole = forest.leaves[-1]
    distinct = forest.sizes[0]
    for i, name in enumerate(names):
        pairs, place = np.unique(forest.leaves[i] * distinct + whole, return_inverse=True)
        one, all_ = pairs // distinct, pairs % distinct
        mine, base = p[i, one], p[-1, all_]
        value = np.where((forest.counts[one] > 0) & (mine > base), _gaps(mine, base), -1)[place]
        best = np.lexsort((rank, -value))[:RANKS]
        best = best[value[best] >= 0]
        add([name] * len(best), "term", [terms[j].decode() for j in best], value[best].tolist())
    columns = {"lang": pa.array([about["lang"]] * len(out["part"]), pa.string())}
    columns |= {k: pa.array(v, pa.int64() if k == "value" else pa.string()) for k, v in out.items()}
    return pa.table(columns)


def _priced(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Parts of all prices, block by block."""
    spread = F.size("sources").alias("spread")
    sizes = kept.groupBy("lang", spread).agg(F.ceil(F.count("*") / F.lit(BLOCK_TERMS)).alias("blocks"))
    dealt = kept.withColumn("spread", spread).join(sizes, ["lang", "spread"])
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    columns = ["lang", "spread", "block", "term", "sources", "counts", "kept"]
    terms = dealt.select("lang", "spread", block, "term", "sources", "counts", F.lit(None).cast("long").alias("kept"))
    entry = F.collect_list(F.struct("source", "total"))
    of_lang = groups.groupBy("lang").agg(entry.alias("entries"), F.max("kept").alias("kept"))
    about = of_lang.join(sizes, "lang").select(
        "lang",
        "spread",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("string").alias("term"),
        F.col("entries.source").alias("sources"),
        F.col("entries.total").alias("counts"),
        "kept",
    )
    # Dealt by block, whichever way the sizes were joined: all blocks of a language may be one task's else.
    together = terms.select(*columns).unionAll(about.select(*columns)).repartition("lang", "spread", "block")
    return together.groupBy("lang", "spread", "block").applyInArrow(_price_block, _OUT)


def source_divergence(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Rows lang, source, part, item, value, rank.

    Part `pair` prices each other source of the language by all kept terms; part `term` lists the first 200
    terms that a source has more of than its language. Ties rank by the UTF-8 bytes of the item.

    A null text, language or source counts as ''. Texts are read whole, one at a time, and never shuffled.
    Repeated rows are documents of their own. A source may hold any share of the rows: what is counted of it is
    one row for each term. A source without kept terms is priced with counts of zero, a language without any
    with prices of zero; a language's only source has no pairs. Other columns are not read, whatever their
    names. No documents give no rows.
    """
    rows = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = stored(term_counts(rows, min_documents), "divergence-terms")
    totals = kept.select("lang", F.inline(F.arrays_zip("sources", "counts")))
    totals = totals.groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = groups.join(sizes, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "kept")]
    )
    groups = stored(groups, "divergence-groups")
    priced = stored(_priced(kept, groups), "divergence-prices")

    every = groups.select("lang", "source")
    others = groups.select("lang", F.col("source").alias("item"))
    every = every.join(others, "lang").where("source <> item")
    summed = priced.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = every.join(summed, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    terms = priced.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= RANKS)
    return ranked.unionByName(terms)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


SQL = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    occurring AS (SELECT DISTINCT lang, source FROM docs),
    words AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
    in_document AS (SELECT id, lang, source, term, count(*) AS n FROM words GROUP BY ALL),
    kept AS (SELECT lang, term FROM in_document GROUP BY lang, term HAVING count(*) >= 3),
    sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    counted AS (
        SELECT lang, source, term, sum(n) AS n FROM in_document SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL),
    of_source AS (
        SELECT o.lang, o.source, k.term, coalesce(c.n, 0) AS n,
               1 + CAST(1000000000 * (coalesce(c.n, 0) + 1) AS HUGEINT) // (coalesce(t.total, 0) + s.v) AS p
        FROM occurring o JOIN kept k USING (lang) JOIN sizes s USING (lang)
        LEFT JOIN counted c ON c.lang = o.lang AND c.source = o.source AND c.term = k.term
        LEFT JOIN totals t ON t.lang = o.lang AND t.source = o.source),
    lang_counts AS (SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL),
    lang_totals AS (SELECT lang, sum(n) AS total FROM counted GROUP BY ALL),
    of_lang AS (
        SELECT c.lang, c.term, 1 + CAST(1000000000 * (c.n + 1) AS HUGEINT) // (t.total + s.v) AS q
        FROM lang_counts c JOIN lang_totals t USING (lang) JOIN sizes s USING (lang)),
    priced AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM of_source a JOIN of_source b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
        FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
    terms AS (
        SELECT a.lang, a.source, a.term AS item, (p - q) * (p - q) // q AS value
        FROM of_source a JOIN of_lang l ON a.lang = l.lang AND a.term = l.term WHERE a.n > 0 AND p > q),
    ranked AS (
        SELECT lang, source, 'pair' AS part, item, value,
               row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
        UNION ALL
        SELECT lang, source, 'term', item, value,
               row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 200"""
