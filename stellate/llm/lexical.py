"""Ranked lexical search over a length-stratified index.

A document's score for an item is the sum, over the item's different terms, of w(term) * impact(tf, m), where the
normaliser m depends on the document's length alone. So documents are grouped by equal m (a stratum, cut into
blocks of at most ``BLOCK_DOCS`` documents), and a block's postings of a term are grouped by tf: each impact is
computed once per (stratum, term, tf), not once per posting. The highest tf of a term in a block bounds what
the term can add there, and the sum of these bounds what any document of the block can score.

Steps: (1) one pass over the texts writes each document's length and the asked terms it holds with their tf; number
of documents, of terms and document frequencies are sums over that table. (2) Documents are range-partitioned by
m and cut into blocks: the index. (3) Bounds order the visits: of every item, the ``VISITS`` blocks with the
highest bounds are scored first, which gives the score that the ``top``-th document has at least (its floor);
then every other block whose bound reaches the item's floor is scored, and floors rise as a task goes on.

Scale: texts are read once a block of items and not shuffled; the shuffle carries ids and counts of asked terms. A
length that a third of all documents have is many blocks, in many tasks. Only items (in blocks of
``ITEM_BYTES`` of text, each with an index of its own terms), their weights and floors are broadcast. Memory
is bounded by an Arrow batch, a block of documents and ``CELLS`` scores.

Terms: runs of bytes other than 0x00-0x2F, 0x3A-0x40, 0x5B-0x60, 0x7B-0x7F, with A-Z lower-cased; equal terms are
equal bytes. Defined results: null and empty texts have no terms and count in no statistic; equal scores rank
by ascending id, a null id last; repeated documents rank each; items equal in id and text are one, items without
terms have no row; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.kernels import LOWER_VALUES, numbered, slices, spread, words
from stellate.llm.staging import stage

TOP = 10
BLOCK_DOCS = 4096
VISITS = 16
ITEM_BYTES = 1 << 22
SLICE_BYTES = 1 << 21
CELLS = 1 << 21

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_RUNS = ("terms", "term_first", "tfs", "run_first", "places")


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first term of each text and the end, numbers of the terms, different terms by number)."""
    starts, ends, first = words(data, offsets, SEPARATORS)
    return first, *numbered(LOWER_VALUES[data], starts, ends)


class Items:
    """A block of items: its vocabulary and, by term, the items that ask for it."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        first, codes, self.vocabulary = terms(data, offsets)
        self.n = len(texts)
        pairs = np.unique(codes * self.n + np.repeat(np.arange(self.n), np.diff(first)))
        self.items = pairs % self.n
        self.first = np.searchsorted(pairs // self.n, np.arange(len(self.vocabulary) + 1))
        self.weights = np.zeros(len(self.vocabulary), np.int64)

    def askers(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``asked``, item) of every item that asks for one of these terms."""
        size = self.first[asked + 1] - self.first[asked]
        return np.repeat(np.arange(len(asked)), size), self.items[spread(size, self.first[asked])]


def _added(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of integers by place; as doubles where these are exact."""
    if not len(values) or float(values.max()) * len(values) < 2.0**53:
        return np.bincount(at, values, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


def impacts(weights: np.ndarray, tf: np.ndarray, m: int) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def document_terms(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """id, n (terms with repeats), terms (numbers of the asked ones, ascending) and tfs of each row with terms."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        vocabulary = shared.value.vocabulary
        for batch in batches:
            for lo, data, offsets in slices(batch.column(1), SLICE_BYTES):
                first, codes, different = terms(data, offsets)
                asked = pc.fill_null(pc.index_in(different, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
                met = asked >= 0
                pairs, tf = np.unique(doc[met] * max(len(vocabulary), 1) + asked[met], return_counts=True)
                edges = np.searchsorted(pairs, np.arange(len(offsets)) * max(len(vocabulary), 1))
                some = np.flatnonzero(np.diff(first))
                edges = pa.array(np.append(edges[some], len(pairs)), pa.int32())
                lists = [pa.ListArray.from_arrays(edges, pa.array(x, pa.int32())) for x in (pairs % max(len(vocabulary), 1), tf)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(offsets) - 1).take(pa.array(some)), pa.array(np.diff(first)[some]), *lists],
                                                 ["id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, f"id {id_type}, n long, terms array<int>, tfs array<int>")


def normaliser(n_docs: int, n_terms: int):
    """m of a document of n terms."""
    return F.expr(f"CAST(100 - 90 + (CAST(n AS DECIMAL(20, 0)) * {90 * n_docs}) div {max(n_terms, 1)} AS LONG)")


def build_index(held: DataFrame, n_docs: int, n_terms: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row a block: block, m, docs (ids), and its postings: terms, term_first (runs of a term), tfs (tf of a
    run), run_first (postings of a run), places (in docs), as little-endian 32-bit integers; tops (highest tf of
    a term)."""
    rows = held.where(F.size("terms") > 0).select("id", normaliser(n_docs, n_terms).alias("m"), "terms", "tfs", F.monotonically_increasing_id().alias("at"))
    sorted_rows = rows.repartitionByRange("m", "at").sortWithinPartitions("m", "at").drop("at")
    id_type = held.schema["id"].dataType.simpleString()

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        waiting, m, count = [], None, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            ms = table.column("m").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(ms)) + 1).tolist(), len(ms)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                while lo < hi:
                    if waiting and (ms[lo] != m or count == block_docs):
                        yield _block(number, m, pa.concat_tables(waiting))
                        number, waiting, count = number + 1, [], 0
                    m = ms[lo]
                    step = min(hi - lo, block_docs - count)
                    waiting.append(table.slice(lo, step))
                    count, lo = count + step, lo + step
        if waiting:
            yield _block(number, m, pa.concat_tables(waiting))

    columns = ", ".join(f"{c} binary" for c in (*_RUNS, "tops"))
    return sorted_rows.mapInArrow(run, f"block long, m long, docs array<{id_type}>, {columns}")


def _block(number: int, m: int, docs: pa.Table) -> pa.RecordBatch:
    # places follow the ids, so that ties are settled by place
    docs = docs.take(pc.sort_indices(docs, [("id", "ascending")], null_placement="at_end")).combine_chunks()
    lists = docs.column("terms").combine_chunks()
    term = lists.flatten().to_numpy().astype(np.int64)
    tf = docs.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
    place = np.repeat(np.arange(len(docs)), lists.value_lengths().to_numpy())
    order = np.lexsort((place, -tf, term))
    term, tf, place = term[order], tf[order], place[order]
    new_term = np.concatenate([[True], term[1:] != term[:-1]])
    runs = np.flatnonzero(new_term | np.concatenate([[True], tf[1:] != tf[:-1]]))
    heads = np.flatnonzero(new_term)
    packed = [term[heads], np.searchsorted(runs, np.append(heads, len(term))), tf[runs], np.append(runs, len(term)), place, tf[heads]]
    ids = docs.column("id").combine_chunks()
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([m], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
         *[pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in packed]], ["block", "m", "docs", *_RUNS, "tops"])


def _ints(cell) -> np.ndarray:
    return np.frombuffer(cell.as_py(), "<i4").astype(np.int64)


def bounds(items: Items, asked: np.ndarray, tops: np.ndarray, m: int) -> np.ndarray:
    """What a document of the block can score for each item at most."""
    at, item = items.askers(asked)
    return _added(item, impacts(items.weights[asked], tops, m)[at], items.n)


def first_visits(index: DataFrame, items: Items, visits: int) -> DataFrame:
    """block, items: the ``visits`` blocks with the highest bounds of each item."""
    shared = index.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        best, where = np.zeros((items_n, visits), np.int64), np.zeros((items_n, visits), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                found = bounds(shared.value, _ints(batch.column(2)[i]), _ints(batch.column(3)[i]), batch.column(1)[i].as_py())
                least = best.argmin(axis=1)
                better = np.flatnonzero(found > best[np.arange(items_n), least])
                best[better, least[better]], where[better, least[better]] = found[better], batch.column(0)[i].as_py()
        item, k = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(where[item, k]), pa.array(best[item, k])], ["item", "block", "bound"])

    items_n = items.n
    tried = index.select("block", "m", "terms", "tops").mapInArrow(run, "item int, block long, bound long")
    return _best(tried, visits, F.col("bound").desc(), F.col("block")).groupBy("block").agg(F.collect_list("item").alias("asking"))


def _best(rows: DataFrame, top: int, *order) -> DataFrame:
    """The first ``top`` rows of each item: within a share of the tasks, then of all."""
    shares = rows.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(256)))
    some = shares.withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top).drop("share")


def score_block(items: Items, m: int, columns: list[np.ndarray], n_docs: int, live: np.ndarray, floors: np.ndarray, top: int):
    """(item, place, score) of up to ``top`` documents an item that reach its floor; raises ``floors`` where a block
    has that many."""
    asked, term_first, tfs, run_first, places = columns
    out = []
    run_term = np.repeat(np.arange(len(asked)), np.diff(term_first))
    impact = np.repeat(impacts(items.weights[asked[run_term]], tfs, m), np.diff(run_first))
    posting_first = run_first[term_first]
    at, item = items.askers(asked)
    slot = np.full(items.n, -1, np.int64)
    chunk = max(1, CELLS // n_docs)
    for lo in range(0, len(live), chunk):
        some = live[lo:lo + chunk]
        slot[:] = -1
        slot[some] = np.arange(len(some))
        use = slot[item] >= 0
        term, who = at[use], slot[item[use]]
        scores = np.zeros(len(some) * n_docs, np.int64)
        size = posting_first[term + 1] - posting_first[term]
        edges = np.concatenate([[0], np.cumsum(size)])
        i = 0
        while i < len(term):
            j = max(i + 1, int(np.searchsorted(edges, edges[i] + CELLS, "right")) - 1)
            posting = spread(size[i:j], posting_first[term[i:j]])
            scores += _added(np.repeat(who[i:j] * n_docs, size[i:j]) + places[posting], impact[posting], len(scores))
            i = j
        scores = scores.reshape(len(some), n_docs)
        if n_docs > top:
            kth = np.partition(scores, n_docs - top, axis=1)[:, n_docs - top]
            floors[some] = np.maximum(floors[some], kth)
        row, place = np.nonzero(scores >= np.maximum(floors[some], 1)[:, None])
        score = scores[row, place]
        # the first ``top`` of an item by score, then place
        order = np.lexsort((place, -score, row))
        row, place, score = row[order], place[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < top
        out.append((some[row[keep]], place[keep], score[keep]))
    return [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ([], [], []))]


def _scored(index: DataFrame, items: Items, floors: np.ndarray, top: int, seeds: bool) -> DataFrame:
    """item, id, score of candidates; ``seeds``: of each block, for the items in ``asking`` only."""
    id_type = index.schema["docs"].dataType.elementType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast((items, floors))

    def run(batches):
        items, given = shared.value
        floors = given.copy()
        for batch in batches:
            blocks = []
            for i in range(batch.num_rows):
                m = batch.column(1)[i].as_py()
                columns = [_ints(batch.column(c)[i]) for c in _RUNS]
                bound = bounds(items, columns[0], _ints(batch.column("tops")[i]), m)
                asking = np.array(batch.column("asking")[i].as_py(), np.int64) if seeds else np.arange(items.n)
                blocks.append((int(bound.max(initial=0)), i, m, columns, bound, asking))
            for _, i, m, columns, bound, asking in sorted(blocks, key=lambda b: -b[0]):
                live = asking[(bound[asking] >= floors[asking]) & (bound[asking] > 0)]
                if not len(live):
                    continue
                docs = batch.column("docs")[i].values
                item, place, score = score_block(items, m, columns, len(docs), live, floors, top)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), docs.take(pa.array(place)), pa.array(score)], ["item", "id", "score"])

    return index.mapInArrow(run, f"item int, id {id_type}, score long")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", item_bytes: int = ITEM_BYTES, block_docs: int = BLOCK_DOCS, visits: int = VISITS) -> DataFrame:
    """item, rank (from 1), id, score: each item's ``top`` highest-scoring documents."""
    spark = docs.sparkSession
    asked = queries.select(F.col(item_col).alias("name"), F.col(item_text_col).cast("binary").alias("text")).where(F.octet_length("text") > 0).distinct()
    name_type, id_type = (x.simpleString() for x in (asked.schema["name"].dataType, docs.schema[id_col].dataType))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // item_bytes)
    found = spark.createDataFrame([], f"{item_col} {name_type}, rank int, {id_col} {id_type}, score long")
    for i in range(n):
        part = asked.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == i).collect()
        ranked = _search_block(docs, Items([bytes(r["text"]) for r in part]), top, id_col, text_col, block_docs, visits)
        names = spark.createDataFrame([(k, r["name"]) for k, r in enumerate(part)], f"item int, name {name_type}")
        found = found.unionAll(stage(ranked.join(names, "item").select("name", "rank", "id", "score"), "ranked"))
    return found


def _search_block(docs: DataFrame, items: Items, top: int, id_col: str, text_col: str, block_docs: int, visits: int) -> DataFrame:
    held = stage(document_terms(docs, items, id_col, text_col), "document-terms")
    n_docs, n_terms = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # a block's vocabulary
        items.weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    index = stage(build_index(held, n_docs, n_terms, block_docs), "lexical-index")
    order = (F.col("score").desc(), F.col("id").asc_nulls_last())
    visited = index.join(first_visits(index, items, visits), "block")
    floors = np.zeros(items.n, np.int64)
    first = stage(_best(_scored(visited, items, floors, top, True), top, *order), "first-visits")
    for r in first.groupBy("item").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == top).collect():
        floors[r["item"]] = r["floor"]
    return _best(_scored(index, items, floors, top, False), top, *order)
