"""Ranked lexical search by per-term geometric blocking.

Documents become sparse vectors over the queries' terms: the impact of a term on a document's score. Vectors are clustered around pivots, and the posting list of
a term is cut into blocks that follow the clusters, so the members of a block are alike. Every block stores the coordinatewise maximum of its
members; its product with a query is an upper bound of every member's score, in exact integers.

The search goes in two rounds. First the short lists of each query's heaviest terms are scored whole, which gives it a threshold: its k-th best score so far. Another
document that reaches the threshold must hold one of the query's essential terms, those whose best cases the others' sum cannot replace, so only
their lists are blocked. Then the bound of every block is compared with the threshold, and only the members of blocks that reach it are scored.

Clusters are stored as records of bounded size, a crowded one in several, so a term that most documents hold spreads over many tasks. What the
driver and the tasks share is the queries, the terms' statistics and the pivots, all of counted size; many queries go in several blocks of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.llm.common import sample_by_hash
from promptloom.llm.words import fold
from promptloom.storage import materialise

TERMS_AT_ONCE = 32_768  # of a block of queries, with repeats over queries
PIVOTS = 256  # at most; they are fitted on a sample of as many documents, every document is indexed
PER_PIVOT = 512  # documents at least, by count
LEAD = 1000  # documents in a query's lists of the first round, unless its heaviest term has more
RECORD = 2048  # documents in a stored record, about
MEMBERS = 32  # of a block, about
CELLS = 1 << 20  # numbers held at once in a task

RECORDS = "cell int, piece int, docs array<long>, offsets array<int>, terms array<int>, impacts array<int>"
BLOCKS = "cell int, piece int, term int, members array<int>, coords array<int>, maxima array<int>"
FOUND = "query long, doc long, score long"


@dataclass
class Asked:
    """A block of queries, the statistics of its terms, and what the rounds find out about it."""

    rows: list[int]
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]  # of each query, sorted
    times: list[np.ndarray]
    n_docs: int = 0
    n_terms: int = 0
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    most: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # largest impact of each term
    held: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # documents that hold each term
    pivots: np.ndarray | None = None  # terms x pivots, unit length
    lead: list[np.ndarray] = field(default_factory=list)  # terms of the first round, by query
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # least score that may enter, by query
    essential: dict[int, list[int]] = field(default_factory=dict)  # term: queries

    def weights(self, query: int) -> np.ndarray:
        return self.weight[self.terms[query]] * self.times[query]

    def dense(self, queries: list[int]) -> np.ndarray:
        """terms x queries: the weight of each term in each query, repeats included."""
        out = np.zeros((len(self.vocabulary), len(queries)), np.int64)
        for k, query in enumerate(queries):
            out[self.terms[query], k] = self.weights(query)
        return out


def impact(tf, n, n_docs: int, n_terms: int):
    """What a term adds to a document's score per unit of its weight, for numbers or arrays."""
    return 10**9 * tf // (1000 * tf + 12 * (75 + 25 * n * n_docs // max(n_terms, 1)))


def _counted(batch_terms) -> tuple[list[bytes], list[int]]:
    counts = Counter(batch_terms)
    return [*counts], [*counts.values()]


def query_terms(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(_row, _item, words, times) of every item."""
    rows = items.select(F.col(item_id).alias("_item"), F.col(item_text).cast("string").cast("binary").alias("_text"))
    schema = rows.select(F.lit(0).cast("long").alias("_row"), "_item").schema.add("words", T.ArrayType(T.BinaryType())).add("times", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, times = zip(*[_counted(fold(t).split()) for t in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))], schema.names)

    return rows.select(F.monotonically_increasing_id().alias("_row"), "_item", "_text").mapInArrow(run, schema)


def vectors(docs: DataFrame, text: str, doc_id: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, tfs) of every document: all its terms counted, those of the vocabulary named in order."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            n, terms, tfs = [], [], []
            for value in batch.column(1):
                words = fold(value.as_py()).split()
                n.append(len(words))
                counts = Counter([t for w in words if (t := number(w)) is not None])
                terms.append(sorted(counts))
                tfs.append([counts[t] for t in terms[-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], ["doc", "n", "terms", "tfs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<int>")


def _entries(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list array."""
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]), lists.flatten().to_numpy()


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows of ``values``, none of the runs being empty."""
    return np.add.reduceat(values, offsets[:-1], axis=0) if len(offsets) > 1 else values[:0]


def _placed(shared):
    """Impacts and the cell of every vector: the pivot it is most like."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            offsets, terms = _entries(batch.column(2))
            n = np.repeat(batch.column(1).to_numpy(), np.diff(offsets))
            impacts = impact(batch.column(3).flatten().to_numpy().astype(np.int64), n, asked.n_docs, asked.n_terms)
            cell, step = np.zeros(len(batch), np.int32), max(1, CELLS // asked.pivots.shape[1])
            at = 0
            while at < len(batch):
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, "right")) - 1)
                own = slice(offsets[at], offsets[stop])
                like = asked.pivots[terms[own]] * (impacts[own] * asked.weight[terms[own]]).astype(np.float32)[:, None]
                cell[at:stop] = _sums(like, offsets[at : stop + 1] - offsets[at]).argmax(axis=1)
                at = stop
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(impacts, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists, pa.array(cell)], ["doc", "terms", "impacts", "cell"])
    return run


def _record(key: tuple, group: pa.Table) -> pa.Table:
    """The documents of a cell's piece as one row, ordered by id."""
    group = group.sort_by("doc").combine_chunks()
    terms, impacts = (group.column(c).combine_chunks() for c in ("terms", "impacts"))
    terms, impacts = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (terms, impacts))
    offsets, flat = _entries(terms)
    values = [[key[0].as_py()], [key[1].as_py()], [group.column("doc").to_pylist()], [offsets], [flat], [impacts.flatten().to_numpy()]]
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]
    return pa.table([pa.array(v, t) for v, t in zip(values, kinds)], ["cell", "piece", "docs", "offsets", "terms", "impacts"])


class Record:
    """A stored record: the vectors of some documents of a cell."""

    def __init__(self, docs: list, offsets: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.docs, self.offsets, self.terms, self.impacts = docs, offsets, terms, impacts.astype(np.int64)
        # Null ids come last.
        self.order = np.array([2**63 - 1 if d is None else d for d in docs], np.int64)

    def entries(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, terms, impacts) of some of the documents."""
        sizes = np.diff(self.offsets)[members]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        own = np.repeat(self.offsets[members] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return offsets, self.terms[own], self.impacts[own]

    def holds(self, terms: np.ndarray, vocabulary: int) -> np.ndarray:
        """Whether each document holds one of some terms."""
        wanted = np.zeros(vocabulary, bool)
        wanted[terms] = True
        return np.logical_or.reduceat(wanted[self.terms], self.offsets[:-1])

    def score(self, weights: np.ndarray, members: np.ndarray | None = None) -> np.ndarray:
        """Exact scores of (some of) the documents: documents x queries. ``weights`` is terms x queries."""
        offsets, terms, impacts = (self.offsets, self.terms, self.impacts) if members is None else self.entries(members)
        out, step = [], max(1, CELLS // max(1, len(terms)))
        for at in range(0, weights.shape[1], step):
            out.append(_sums(weights[terms, at : at + step] * impacts[:, None], offsets))
        return np.concatenate(out, axis=1)

    def best(self, score: np.ndarray, floor: int, k: int, members: np.ndarray | None = None) -> list[tuple[int | None, int]]:
        """The first ``k`` documents by (score descending, id) whose score is above 0 and reaches ``floor``."""
        at = np.flatnonzero((score >= floor) & (score > 0))
        place = at if members is None else members[at]
        order = np.lexsort((self.order[place], -score[at]))[:k]
        return [(self.docs[p], int(s)) for p, s in zip(place[order], score[at][order])]


def records_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Record]]:
    for i in range(len(batch)):
        docs, offsets, terms, impacts = (batch.column(c)[i] for c in range(2, 6))
        yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), Record(docs.as_py(), *[x.values.to_numpy() for x in (offsets, terms, impacts)])


def _found(rows: list[tuple[int, int | None, int]]) -> pa.RecordBatch:
    query, doc, score = (list(x) for x in zip(*rows)) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (query, doc, score)], ["query", "doc", "score"])


def _led(shared, k: int):
    """The first round: the documents that hold one of a query's lead terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            for _, _, record in records_of(batch):
                rows = []
                for q, lead in enumerate(asked.lead):
                    members = np.flatnonzero(record.holds(lead, len(asked.vocabulary)))
                    if len(members):
                        rows.extend((asked.rows[q], *hit) for hit in record.best(record.score(asked.dense([q]), members)[:, 0], 1, k, members))
                yield _found(rows)
    return run


def clustered(points: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    """Numbers of clusters of about ``most`` rows: every row goes to the one it is most like of evenly spaced rows."""
    points = points * weight.astype(np.float32)
    chosen = points[:: most] / np.maximum(np.linalg.norm(points[:: most], axis=1, keepdims=True), 1e-9)
    return (points @ chosen.T).argmax(axis=1)


def blocks_of(record: Record, members: np.ndarray, coords: np.ndarray, weight: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(members, maxima over ``coords``) of the blocks of a posting list. ``place`` is scratch of the vocabulary's size, -1 throughout."""
    place[coords] = np.arange(len(coords))
    for at in range(0, len(members), step := max(MEMBERS, 4 * CELLS // max(1, len(coords)))):
        part = members[at : at + step]
        offsets, terms, impacts = record.entries(part)
        column, row = place[terms], np.repeat(np.arange(len(part)), np.diff(offsets))
        asked_for = column >= 0
        points = np.zeros((len(part), len(coords)), np.int32)
        points[row[asked_for], column[asked_for]] = impacts[asked_for]
        if len(part) > MEMBERS:
            cluster = clustered(points, weight[coords], MEMBERS)
            order = np.argsort(cluster, kind="stable")
            part, points, starts = part[order], points[order], np.unique(cluster[order], return_index=True)[1]
        else:
            starts = np.zeros(1, int)
        yield from zip(np.split(part, starts[1:]), np.maximum.reduceat(points, starts, axis=0))
    place[coords] = -1


def _blocked(shared):
    """The blocks of a record: the posting list of each essential term here, clustered, with the coordinatewise maxima of the terms that its queries ask for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        essential, place = np.zeros(len(asked.vocabulary), bool), np.full(len(asked.vocabulary), -1)
        essential[list(asked.essential)] = True
        for batch in batches:
            for cell, piece, record in records_of(batch):
                owner = np.repeat(np.arange(len(record.docs)), np.diff(record.offsets))
                entries = np.flatnonzero(essential[record.terms])
                entries = entries[np.argsort(record.terms[entries], kind="stable")]
                terms, first = np.unique(record.terms[entries], return_index=True)
                rows = []
                for term, members in zip(terms.tolist(), np.split(owner[entries], first[1:])):
                    coords = np.unique(np.concatenate([asked.terms[q] for q in asked.essential[term]]))
                    for own, maxima in blocks_of(record, members, coords, asked.weight, place):
                        held = maxima > 0
                        rows.append((cell, piece, term, own, coords[held], maxima[held]))
                columns = [list(x) for x in zip(*rows)] if rows else [[]] * 6
                kinds = [pa.int32()] * 3 + [pa.list_(pa.int32())] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["cell", "piece", "term", "members", "coords", "maxima"])
    return run


def bounds(asked: Asked, queries: list[int], coords: np.ndarray, maxima: np.ndarray) -> np.ndarray:
    """The most that a member of a block can score in each query; terms outside ``coords`` are held by no member."""
    summary = np.zeros(len(asked.vocabulary), np.int64)
    summary[coords] = maxima
    return np.array([int((asked.weights(q) * summary[asked.terms[q]]).sum()) for q in queries], np.int64)


def _open(shared):
    """(cell, piece, query, members) for the blocks whose bound reaches the query's threshold; all others are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            taken, query = [], []
            for i, term in enumerate(batch.column(2).to_pylist()):
                queries = asked.essential[term]
                reach = bounds(asked, queries, batch.column(4)[i].values.to_numpy(), batch.column(5)[i].values.to_numpy())
                some = [q for q, bound in zip(queries, reach.tolist()) if bound >= asked.floor[q]]
                taken.extend([i] * len(some))
                query.extend(some)
            taken = pa.array(taken, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(query, pa.int32()), batch.column(3).take(taken)],
                                             ["cell", "piece", "query", "members"])
    return run


def _scored(shared, k: int):
    """The second round: the members of a record's open blocks that the first round left, each query's once however many of its blocks hold them."""
    def run(opened: pa.Table, stored: pa.Table) -> pa.Table:
        asked, rows = shared.value, []
        if opened.num_rows and stored.num_rows:
            record = next(records_of(stored.combine_chunks().to_batches()[0]))[2]
            of: dict[int, list] = {}
            for query, members in zip(opened.column("query").to_pylist(), opened.column("members")):
                of.setdefault(query, []).append(members.values.to_numpy())
            for query, lists in of.items():
                members = np.unique(np.concatenate(lists))
                members = members[~record.holds(asked.lead[query], len(asked.vocabulary))[members]]
                if not len(members):
                    continue
                score = record.score(asked.dense([query]), members)[:, 0]
                rows.extend((asked.rows[query], *hit) for hit in record.best(score, int(asked.floor[query]), k, members))
        return pa.Table.from_batches([_found(rows)])
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _statistics(stored: DataFrame, asked: Asked) -> None:
    """Document counts, weights of terms and their largest impacts."""
    asked.n_docs, asked.n_terms = (int(x or 0) for x in stored.agg(F.count_if(F.col("n") > 0), F.sum("n")).first())
    held = stored.select("n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("n", F.col("x.terms").alias("term"), F.col("x.tfs").cast("long").alias("tf"))
    length = F.lit(75) + F.expr(f"(25 * n * {asked.n_docs}L) div {max(asked.n_terms, 1)}L")
    value = F.call_function("div", F.lit(10**9) * F.col("tf"), F.lit(1000) * F.col("tf") + F.lit(12) * length)
    asked.weight, asked.most, asked.held = (np.zeros(len(asked.vocabulary), np.int64) for _ in range(3))
    for r in held.groupBy("term").agg(F.count("*").alias("df"), F.max(value).alias("most")).collect():  # a row per term of the queries
        asked.weight[r.term] = math.floor(1000 * math.log((2 * asked.n_docs + 2) / (2 * r.df + 1)))
        asked.most[r.term], asked.held[r.term] = r.most, r.df


def _fit_pivots(held: DataFrame, asked: Asked) -> None:
    """Pivots are documents, the first by a hash of what they hold."""
    wanted = max(1, min(PIVOTS, asked.n_docs // PER_PIVOT))
    few = held.select("n", "terms", "tfs")
    # A cut by hash may miss all of few different vectors; any document serves as a pivot.
    sample = sample_by_hash(few, max(wanted, 32), "terms", "tfs").collect()[:wanted] or few.limit(1).collect()
    pivots = np.zeros((len(asked.vocabulary), len(sample)), np.float32)
    for p, row in enumerate(sample):
        terms = np.array(row.terms)
        pivots[terms, p] = impact(np.array(row.tfs, np.int64), row.n, asked.n_docs, asked.n_terms) * asked.weight[terms]
    asked.pivots = pivots / np.maximum(np.linalg.norm(pivots, axis=0), 1e-9)


def _set_lead(asked: Asked) -> None:
    """Each query's heaviest terms whose lists together are short, the heaviest one in any case."""
    for q, terms in enumerate(asked.terms):
        order = np.argsort(-asked.weights(q) * asked.most[terms], kind="stable")
        wanted = np.cumsum(asked.held[terms[order]]) <= LEAD
        wanted[:1] = True
        asked.lead.append(terms[order[wanted]])


def _set_floor(asked: Asked, first: DataFrame, k: int) -> None:
    """Thresholds from the first round, and the terms whose lists can hold a document that reaches them."""
    kth = {r["query"]: r.score for r in first.filter(F.col("rank") == k).select("query", "score").collect()}  # a row per query
    asked.floor = np.array([max(1, kth.get(row, 1)) for row in asked.rows], np.int64)
    for q, terms in enumerate(asked.terms):
        most = asked.weights(q) * asked.most[terms]
        order = np.argsort(most, kind="stable")
        # Documents with none but the first terms cannot reach the threshold.
        for term in np.setdiff1d(terms[order[np.cumsum(most[order]) >= asked.floor[q]]], asked.lead[q]).tolist():
            asked.essential.setdefault(term, []).append(q)


def _search_block(docs: DataFrame, asked: Asked, k: int, text: str, doc_id: str) -> DataFrame:
    """(query, rank, doc, score) for a block of queries."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    stored = materialise(vectors(docs, text, doc_id, asked.vocabulary), "vectors")
    _statistics(stored, asked)
    held = stored.filter(F.size("terms") > 0)
    _fit_pivots(held, asked)
    if not asked.pivots.shape[1]:
        return spark.createDataFrame([], FOUND).withColumn("rank", F.lit(0))
    placed = materialise(held.mapInArrow(_placed(share(asked)), "doc long, terms array<int>, impacts array<int>, cell int"), "placed")
    sizes = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}  # a row per pivot
    pieces = F.array(*[F.lit(-(-sizes.get(c, 1) // RECORD)) for c in range(asked.pivots.shape[1])])
    piece = F.pmod(F.xxhash64("doc", "terms", F.monotonically_increasing_id()), F.get(pieces, F.col("cell"))).cast("int")
    records = materialise(placed.withColumn("piece", piece).groupBy("cell", "piece").applyInArrow(_record, RECORDS), "records")

    _set_lead(asked)
    first = materialise(_first(records.mapInArrow(_led(share(asked), k), FOUND), k), "first")
    _set_floor(asked, first, k)
    shared = share(asked)
    blocks = materialise(records.mapInArrow(_blocked(shared), BLOCKS), "blocks")
    opened = blocks.mapInArrow(_open(shared), "cell int, piece int, query int, members array<int>")
    second = opened.groupBy("cell", "piece").cogroup(records.groupBy("cell", "piece")).applyInArrow(_scored(shared, k), FOUND)
    return _first(first.drop("rank").unionByName(second), k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for every item, ties to the smaller id.

    Terms are runs of letters, digits and non-ASCII characters with ASCII letters lower-cased; the score is a saturating term frequency under a
    length norm times an inverse document frequency, in 64-bit integers. Every row of ``items`` is a query of its own, as is every row of ``docs`` a document, so
    rows that repeat take ranks of their own. Null and empty texts have no terms: such items have no results, such documents are never found and
    do not count. Documents without an id come last among equal scores. No documents or no items give no rows. Other columns are not read. An item of
    more than ``TERMS_AT_ONCE`` distinct terms is searched by itself.
    """
    spark = docs.sparkSession
    asked = materialise(query_terms(items, item_id, item_text).filter(F.size("words") > 0), "queries")
    total = asked.agg(F.sum(F.size("words"))).first()[0] or 0
    parts, out = -(-total // TERMS_AT_ONCE), []
    for part in range(parts):
        # A hash of the row deals out blocks of queries of about equal size, counted above.
        rows = asked.filter(F.pmod(F.xxhash64("_row"), F.lit(parts)) == part).orderBy("_row").collect()
        if not rows:
            continue
        vocabulary: dict[bytes, int] = {}
        for r in rows:
            for w in r.words:
                vocabulary.setdefault(bytes(w), len(vocabulary))
        terms, times = [], []
        for r in rows:
            numbers = np.array([vocabulary[bytes(w)] for w in r.words])
            order = np.argsort(numbers)
            terms.append(numbers[order])
            times.append(np.array(r.times, np.int64)[order])
        block = Asked([r["_row"] for r in rows], vocabulary, terms, times)
        out.append(_search_block(docs, block, k, text, doc_id))
    if not out:
        return spark.createDataFrame([], FOUND).select(F.lit(None).cast(items.schema[item_id].dataType).alias(item_id), F.lit(0).alias("rank"), F.col("doc").alias(doc_id), "score")
    found = reduce(DataFrame.unionByName, out)
    names = asked.select(F.col("_row").alias("query"), F.col("_item"))
    return found.join(names, "query").select(F.col("_item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
