"""Benchmark decontamination: every passage of the training texts queries a BM25 index of the benchmark items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from penprint.llm import words
from penprint.llm.common import bounded

K1, B = 1.2, 0.75
BLOCK = 4  # items whose largest impact is kept together
GROUPS = 128  # groups of blocks in the bounds of all passages of a slice
RETRIEVE = 0.5  # part of an item's own score that a passage must reach
OVERLAP = 0.75  # part of an item's five-word shingles that a passage must hold
WIDTH = 5
SHARD = 32 << 20  # text bytes of one index; more items make more indexes
LEAK = ST.StructType(
    [ST.StructField("item_id", ST.LongType()), *(ST.StructField(n, ST.DoubleType()) for n in ("score", "overlap", "question_overlap", "answer_overlap"))]
)


def runs(tokens: np.ndarray, width: int) -> np.ndarray:
    return words.chained(tokens, width)


class Index:
    """Inverted lists of impacts in blocks of items, and what is needed to verify a hit.

    An impact is the BM25 weight of a term in an item, divided by the item's own score (all its terms present), so one
    threshold serves all items.
    """

    def __init__(self, rows: list[tuple[int, str, str]]):
        """``rows``: id, question, answer of items with at least one word."""
        self.ids = [r[0] for r in rows]
        split = [folded(pa.array([q, a], pa.large_string())) for _, q, a in rows]
        self.parts = [(h[: b[1]], h[b[1] :]) for h, b in split]
        self.sizes = np.array([len(h) for h, _ in split])
        self.longest = int(self.sizes.max(initial=1))
        item = np.repeat(np.arange(len(rows)), self.sizes)
        hashes = np.concatenate([h for h, _ in split]) if rows else np.zeros(0, np.uint64)
        self.terms, term = np.unique(hashes, return_inverse=True)
        pair, tf = np.unique(term * max(1, len(rows)) + item, return_counts=True)
        term, item = pair // max(1, len(rows)), pair % max(1, len(rows))
        df = np.bincount(term, minlength=len(self.terms))
        idf = np.log1p((len(rows) - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * self.sizes / max(1e-9, self.sizes.mean() if len(rows) else 1))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[item])
        impact = weight / np.bincount(item, weights=weight, minlength=len(rows))[item]
        # lists: term -> block -> (items, impacts, the block's largest impact)
        self.lists: list[dict[int, tuple[list, list, float]]] = [{} for _ in self.terms]
        block = item // BLOCK
        self.blocks = int(block.max(initial=0)) + 1
        cuts = np.append(np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))[: len(term)]), len(term))
        for i, j in zip(cuts[:-1], cuts[1:]):
            self.lists[term[i]][int(block[i])] = (item[i:j].tolist(), impact[i:j].tolist(), float(impact[i:j].max()))
        self.span = -(-self.blocks // GROUPS)
        self.most = np.zeros((len(self.terms), -(-self.blocks // self.span)), np.float32)
        np.maximum.at(self.most, (term, block // self.span), (impact * (1 + 1e-6)).astype(np.float32))
        bits = 16
        while bits < 24 and len(np.unique(self.terms >> np.uint64(64 - bits))) < len(self.terms):
            bits += 1
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.slots[(self.terms >> self.shift).astype(np.int64)] = np.arange(len(self.terms))
        self.whole = len(np.unique(self.terms >> self.shift)) == len(self.terms)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of every word, -1 for words in no item."""
        if not len(self.terms):
            return np.full(len(hashes), -1, np.int64)
        if self.whole:
            found = self.slots[(hashes >> self.shift).astype(np.int64)].astype(np.int64)
        else:
            found = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[found] == hashes, found, -1)

    def search(self, terms: list[int], block: int, least: float) -> list[tuple[int, float]]:
        """All items of a block whose score for these different terms reaches ``least``, by WAND on the block's maxima.

        Cursors stand on the next item of every list. In order of their items, the first lists whose largest impacts
        together reach ``least`` give the pivot: no earlier item can, so cursors before it jump to it.
        """
        lists = [self.lists[t][block] for t in terms if block in self.lists[t]]
        if sum(x[2] for x in lists) < least:
            return []
        cursors = [[items[0], 0, items, impacts, most] for items, impacts, most in lists]
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound = 0.0
            for cursor in cursors:
                bound += cursor[4]
                if bound >= least:
                    break
            else:
                return out
            pivot = cursor[0]
            if cursors[0][0] == pivot:
                score = sum(c[3][c[1]] for c in cursors if c[0] == pivot)
                if score >= least:
                    out.append((pivot, score))
                pivot += 1
            for c in cursors:
                while c[1] < len(c[2]) and c[2][c[1]] < pivot:
                    c[1] += 1
                c[0] = c[2][c[1]] if c[1] < len(c[2]) else None
            cursors = [c for c in cursors if c[0] is not None]
        return out

    def overlaps(self, item: int, tokens: np.ndarray) -> tuple[float, float, float]:
        """Shares of the item's shingles found among the passage's: of both parts, the question, the answer."""
        found, total, shares = 0, 0, []
        for part in self.parts[item]:
            if not len(part):
                shares.append(1.0)
                continue
            width = min(WIDTH, len(part))
            own = np.unique(runs(part, width))
            hit = int(np.isin(own, runs(tokens, width)).sum())
            found, total = found + hit, total + len(own)
            shares.append(hit / len(own))
        return found / total if total else 0.0, shares[0], shares[1]

    def leaks(self, hashes: np.ndarray, bounds: np.ndarray) -> list[dict[int, tuple]]:
        """Verified items of every text: item id to (score, overlaps) of the best passage.

        Passages are twice as long as the longest item and overlap by half, so that any item lies whole in one. Sums of
        the largest impacts of each group of blocks rule out most pairs of passage and group before a search.
        """
        step, texts = self.longest, len(bounds) - 1
        best: list[dict[int, tuple]] = [{} for _ in range(texts)]
        if not len(hashes) or not len(self.terms):
            return best
        numbers = self.numbers(hashes)
        counts = np.maximum(1, -(-np.diff(bounds) // step))  # half passages of every text
        first = np.append(0, np.cumsum(counts))
        text = np.repeat(np.arange(texts), np.diff(bounds))
        half = first[text] + (np.arange(len(hashes)) - bounds[text]) // step
        known = numbers >= 0
        keys = np.unique(half[known] * len(self.terms) + numbers[known])
        if not len(keys):
            return best
        width = len(self.terms)

        def summed(part: np.ndarray) -> np.ndarray:
            """The largest impacts of each half's terms, added up."""
            out = np.zeros((first[-1] + 1, self.most.shape[1]), np.float32)
            if len(part):
                where = part // width
                begin = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
                out[where[begin]] = np.add.reduceat(self.most[part % width], begin, axis=0)
            return out

        term, ends = keys % width, np.searchsorted(keys, np.arange(first[-1] + 1) * width)
        place = np.minimum(np.searchsorted(keys, keys + width), len(keys) - 1)
        sums, shared = summed(keys), summed(keys[keys[place] == keys + width])  # terms that the next half has too
        owners = np.repeat(np.arange(texts), counts)
        joined = np.append(owners[1:] == owners[:-1], False)  # the next half belongs to the same text
        total = sums[:-1] + np.where(joined[:, None], sums[1:] - shared[:-1], 0)
        last = np.append(False, joined[:-1]) & ~joined  # already the second half of a passage
        total[last] = 0
        for h, group in zip(*np.nonzero(total >= RETRIEVE - 1e-4)):
            d = owners[h]
            end = ends[h + 2] if joined[h] else ends[h + 1]
            terms = np.unique(term[ends[h] : end])
            a = bounds[d] + (h - first[d]) * step
            passage = hashes[a : min(a + 2 * step, bounds[d + 1])]
            for block in range(group * self.span, min((group + 1) * self.span, self.blocks)):
                for item, score in self.search(terms.tolist(), block, RETRIEVE - 1e-9):
                    overlap, question, answer = self.overlaps(item, passage)
                    row = (score, overlap, question, answer)
                    if overlap >= OVERLAP and question > 0 and answer > 0 and row > best[d].get(self.ids[item], ()):
                        best[d][self.ids[item]] = row
        return best


def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of letters and digits of lower-cased texts, and the bounds of each row's."""
    return words.word_hashes(pc.utf8_lower(texts), words.MARKS)


def halves(text: str) -> tuple[str, str]:
    """A text without separate question and answer: the first and the second half of its words."""
    cut = text.split()
    return " ".join(cut[: (len(cut) + 1) // 2]), " ".join(cut[(len(cut) + 1) // 2 :])


def indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes of at most ``SHARD`` text bytes each; items are read in that many rounds, in order of a hash.

    ``items``: item_id and text, or item_id, question and answer. Null and wordless items are left out.
    """
    paired = {"question", "answer"} <= set(items.columns)
    columns = ["question", "answer"] if paired else ["text"]
    size = items.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0)))).first()[0] or 0
    shards = int(size // SHARD) + 1
    for k in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k).select("item_id", *columns)
        rows = sorted(part.collect(), key=lambda r: (r[0] is None, r[0], [str(x) for x in r[1:]]))
        rows = [(r[0], r["question"] or "", r["answer"] or "") if paired else (r[0], *halves(r["text"] or "")) for r in rows]
        data = [(i, q, a) for i, q, a in rows if i is not None and len(folded(pa.array([q + " " + a]))[0])]
        if data:
            yield Index(data)


def with_leaks(docs: DataFrame, items: DataFrame, column: str = "leaks") -> DataFrame:
    """Add the verified benchmark items of every whole text: array of item_id, score, overlap and the two parts' shares.

    Every passage of every text is a query; all items above the retrieval threshold are verified by the share of their five-word
    shingles in the passage. Words are runs of letters and
    digits, lower-cased. Null and empty texts and
    an empty benchmark give empty arrays; rows and other columns pass unchanged, a column of that name is replaced.
    """
    rest = docs.drop(column)
    context = docs.sparkSession.sparkContext
    parts = [context.broadcast(index) for index in indexes(items)]
    schema = ST.StructType(list(rest.schema.fields)).add(column, ST.ArrayType(LEAK))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), *((n, pa.float64()) for n in ("score", "overlap", "question_overlap", "answer_overlap"))]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1 << 20):
            hashes, bounds = folded(batch.column("text"))
            found: list[dict] = [{} for _ in range(batch.num_rows)]
            for part in parts:
                for mine, more in zip(found, part.value.leaks(hashes, bounds)):
                    mine.update((i, max(row, mine.get(i, row))) for i, row in more.items())
            out = [[dict(zip(LEAK.names, (i, *mine[i]))) for i in sorted(mine)] for mine in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*batch.schema.names, column])

    return rest.mapInArrow(find, schema)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was verified."""
    return with_leaks(docs, items, "_leaks").where(F.size("_leaks") == 0).drop("_leaks")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = with_leaks(docs, items).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.*")
