"""Ranked lexical search with NRA (no random access) over impact-sorted lists.

A first pass over the corpus counts the terms that the queries have, per
document, and stores them (id, terms in the text, term numbers, counts); the
corpus figures the score needs (documents N, terms L, documents of each term)
are aggregates of that table.  A second pass reads it in blocks of documents.
In a block, every term has a list of (document, impact) sorted by falling
impact, and a query is answered by NRA: all its lists are read down to a falling
impact level, never looked up by document.  What has been read gives a
document's lower bound; with every unread entry below the level, the level
times the query terms not yet read for it gives its upper bound.  Documents
whose upper bound falls below the k-th lower bound are out; reading goes on
until those left have equal bounds, so membership, ties and scores are exact.
Levels halve, so a block is read in O(log(largest impact)) sequential steps.

Blocks are answered apart, each by its exact k best, and the k best of all
follow from those: first within PARTS groups of blocks, then over the groups.
A query never meets more than PARTS * k rows in one task of the last step.

Queries are taken in groups of about GROUP_BYTES of text, each with two passes
of its own, so what is collected and sent to the executors (terms, weights and
queries of one group) is bounded.  A block holds BLOCK_DOCS documents or
BLOCK_ENTRIES list entries, about 40 MB with what sorting needs.

Score: the sum over a query's terms, repeats included, of
w * ((10^9 tf) div (1000 tf + 12 m)), w = floor(1000 ln((2N + 2) / (2 df + 1))),
m = 75 + ((25 n N) div L), all in 64 bits but the logarithm.

Defined results: terms are runs of letters, digits and non-ASCII characters,
A-Z lower-cased, of the whole text.  Null and empty texts have no terms, count
for nothing and match nothing.  Every row is a document: rows of equal or null
id are ranked each; equal scores by ascending id, null ids last.  Equal query
rows (id and text) are one query; equal ids with different texts are queries
of their own.  Queries without a match, and empty tables, give no rows.  Only
the columns named are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import map_texts, stored, words_of

BEST = 20
GROUP_BYTES = 8 << 20                 # text of the queries answered at a time, on average
BLOCK_DOCS, BLOCK_ENTRIES = 8192, 1 << 19
PARTS = 256
SCALE = 1_000_000_000
INDEX = [StructField("n", LongType()), StructField("terms", ArrayType(IntegerType())),
         StructField("counts", ArrayType(IntegerType()))]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Impact-sorted lists of some documents."""

    def __init__(self, ids: list, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray,
                 weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids = ids
        m = 75 + 25 * lengths * n_docs // n_terms
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        tf = counts.astype(np.int64)
        impact = weights[terms] * (SCALE * tf // (1000 * tf + 12 * m[doc]))
        order = np.lexsort((-impact, terms))
        self.doc, self.impact = doc[order], impact[order]
        self.first = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        top = int(self.impact.max(initial=0))
        self.levels = [top >> k for k in range(1, top.bit_length())] or [1]
        self._lists: dict[int, tuple] = {}

    def entries(self, term: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Documents and impacts of a term's list, and how much of it lies at or above each level.

        Entries of impact 0 add nothing and are left out.
        """
        if term not in self._lists:
            doc, impact = (x[self.first[term]:self.first[term + 1]] for x in (self.doc, self.impact))
            cuts = np.searchsorted(-impact, [-x for x in self.levels], side="right").tolist()
            self._lists[term] = doc[:cuts[-1]], impact[:cuts[-1]], cuts
        return self._lists[term]

    def best(self, query: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """(place, score) of the k best documents for (term, repeats) pairs, by NRA."""
        lists = [(*self.entries(t), times) for t, times in query if self.first[t] < self.first[t + 1]]
        lower = np.zeros(len(self.ids), np.int64)
        met = np.zeros(len(self.ids), np.int64)          # repeats of the document's entries read, of lists not at their end
        left = np.arange(len(self.ids))                  # documents not ruled out
        within = np.ones(len(self.ids), bool)
        for step, level in enumerate(self.levels):
            unread = 0
            for doc, impact, cuts, times in lists:
                start, stop = cuts[step - 1] if step else 0, cuts[step]
                at, add = doc[start:stop], impact[start:stop]
                if len(left) < len(self.ids):
                    kept = within[at]
                    at, add = at[kept], add[kept]
                lower[at] += times * add
                if stop < len(doc):
                    met[at] += times
                    unread += times
                elif start < stop:                       # the list has ended: nothing of it is open for any document
                    met[doc[:start]] -= times
            upper = lower[left] + level * (unread - met[left])
            reached = lower[left]
            least = int(np.partition(reached, -k)[-k]) if len(left) > k else 0
            hopeful = upper >= max(least, 1)
            if not hopeful.all():
                within[left[~hopeful]] = False
                left = left[hopeful]
            if not unread or (upper[hopeful] == lower[left]).all():
                break
        found = [(int(i), int(s)) for i, s in zip(left, lower[left]) if s > 0]
        found.sort(key=lambda x: (-x[1], self.ids[x[0]] is None, self.ids[x[0]]))
        return found[:k]


def _index(docs: DataFrame, id_col: str, text_col: str, numbers: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts): terms in the text, and the numbers and counts of those that the queries have."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def make():
        number = shared.value.get

        def count(texts: list[bytes | None]) -> list[list]:
            out: list[list] = [[], [], []]
            for text in texts:
                words = words_of(text)
                own = Counter(map(number, words))
                own.pop(None, None)
                for column, value in zip(out, (len(words), list(own.keys()), list(own.values()))):
                    column.append(value)
            return out

        return count

    return map_texts(docs, [id_col], text_col, INDEX, make)


def _answers(index: DataFrame, id_col: str, queries: list[tuple[int, list[tuple[int, int]]]], weights: np.ndarray,
             n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(query, part, id, score): the k best of every block of documents."""
    schema = StructType([StructField("query", LongType()), StructField("part", LongType()), index.schema[id_col],
                         StructField("score", LongType())])
    arrow = to_arrow_schema(schema)
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        part = TaskContext.get().partitionId() % PARTS
        held: list[pa.RecordBatch] = []

        def answer() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            ids = t.column(0).to_pylist()
            lists, counts = t.column(2).combine_chunks(), t.column(3).combine_chunks()
            block = Block(ids, t.column(1).to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False),
                          lists.flatten().to_numpy(), counts.flatten().to_numpy(), weights, n_docs, n_terms)
            rows = [(q, ids[i], score) for q, terms in queries for i, score in block.best(terms, k)]
            columns = [r[0] for r in rows], [part] * len(rows), [r[1] for r in rows], [r[2] for r in rows]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        docs = entries = 0
        for b in batches:
            if docs and (docs + len(b) > BLOCK_DOCS or entries + len(b.column(2).flatten()) > BLOCK_ENTRIES):
                yield answer()
                held, docs, entries = [], 0, 0
            held.append(b)
            docs, entries = docs + len(b), entries + len(b.column(2).flatten())
        if docs:
            yield answer()

    matching = index.filter(F.size("terms") > 0).select(id_col, "n", "terms", "counts")
    return matching.mapInArrow(run, schema)


def _search_group(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, k: int) -> DataFrame:
    """search() for one bounded group of queries, rows (item, text)."""
    asked = [(r["item"], Counter(words_of(r["text"].encode()))) for r in items.collect()]
    numbers = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in asked))))}
    index = stored(_index(docs, id_col, text_col, numbers), "term-counts")
    total = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 1
    having = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = np.zeros(len(numbers), np.int64)
    for r in having.collect():                             # at most the terms of one group of queries
        weights[r["term"]] = weight(n_docs, r["df"])
    queries = [(q, [(numbers[t], n) for t, n in c.items()]) for q, (_, c) in enumerate(asked)]
    found = _answers(index, id_col, queries, weights, n_docs, n_terms, k)
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    for group in (["query", "part"], ["query"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))) \
            .filter(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(
        [(q, item) for q, (item, _) in enumerate(asked)],
        StructType([StructField("query", LongType()), StructField(item_col, items.schema["item"].dataType)]))
    return found.join(F.broadcast(names), "query").select(item_col, "rank", id_col, "score")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(item, rank, id, score): the k best documents of `docs` for each row of `items`."""
    items = stored(items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
                   .filter("text IS NOT NULL").distinct(), "queries")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // group_bytes)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(n, 1)))
    results = [_search_group(docs, items.filter(part == i), id_col, text_col, item_col, k) for i in range(max(n, 1))]
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
