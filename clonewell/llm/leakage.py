"""Problem 6: evaluation texts that leaked into a corpus, by latent semantic retrieval with exact checks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from clonewell.session import BROADCAST_BYTES, stage, unstage

WORD = re.compile(r"[^\W_]+")


#: Lengths of items that are searched for together; an item belongs to the greatest one it has. Longer ones than ``run`` count as ``run``.
LENGTHS = (9, 6, 4, 3, 2, 1)
#: Bytes of an item's passage beside its latent vector: its places in the index and its words.
PASSAGE_BYTES = 400


@dataclass(frozen=True)
class Settings:
    """``run``: words in a row that make a verbatim leak. ``rank``: dimensions of the latent space.
    ``min_cosine``: of a pair of passages to be looked at closer. ``min_known``: share of a passage's
    words that must occur in some item. ``bridge``: words up to which two stretches of such passages are one. ``tables``, ``bits``: of the index of
    latent vectors. ``span``: words of an item within which a paraphrase is measured (the whole of shorter ones). ``min_lcs``, ``min_answer``: of a paraphrase, the share of
    those words in the longest common subsequence, and of their answer terms (numbers and rarest
    quarter of the item's words) that stand in it. ``group_chars``: characters of items that are handled at a time; ``group_words``:
    distinct words of items for which the corpus is read once; ``block_bytes``: size of the passages that are sent to the tasks at a time."""

    run: int = 12
    rank: int = 96
    min_cosine: float = 0.9
    min_known: float = 0.75
    bridge: int = 24
    tables: int = 16
    bits: int = 14
    span: int = 40
    min_lcs: float = 0.7
    min_answer: float = 0.6
    group_chars: int = 8_000_000
    group_words: int = 60_000
    block_bytes: int = 48 << 20
    seed: int = 7


def words_of(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, in lower case."""
    return WORD.findall(text.lower()) if text else []


@dataclass
class Items:
    """Items with a common vocabulary: word ids (from 1) per item, by length class."""

    vocabulary: dict[str, int]
    classes: dict[int, list[tuple[int, np.ndarray]]]

    def members(self) -> np.ndarray:
        """One row per class (in falling order): whether a word occurs in an item of it; id 0 is no word."""
        out = np.zeros((len(self.classes), len(self.vocabulary) + 1), dtype=bool)
        for k, c in enumerate(sorted(self.classes, reverse=True)):
            for _, words in self.classes[c]:
                out[k, words] = True
        return out


def _groups(rows: list[tuple[int, str]], settings: Settings) -> Iterator[Items]:
    """The items in order, as many at a time as have ``group_words`` distinct words (one at least)."""
    items = Items({}, {})
    for i, text in sorted(rows):
        words = words_of(text)
        if not words:
            continue
        if items.vocabulary and len(items.vocabulary.keys() | set(words)) > settings.group_words:
            yield items
            items = Items({}, {})
        ids = np.array([items.vocabulary.setdefault(x, len(items.vocabulary) + 1) for x in words], dtype=np.int32)
        length = max(n for n in (settings.run, *LENGTHS) if n <= max(1, min(len(ids), settings.run)))
        items.classes.setdefault(length, []).append((i, ids))
    if items.vocabulary:
        yield items


def _cut(length: int) -> tuple[int, int]:
    """(width, stride) of passages, so that each run of ``length`` words holds a whole one cut at the stride."""
    stride = max(1, length // 3)
    return length - stride + 1, stride


def _blocks(items: list[tuple[int, np.ndarray]], width: int, rank: int, room: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The items in blocks whose passages take ``room`` bytes at most (one item at least)."""
    block, size = [], 0
    for item in items:
        more = (len(item[1]) - width + 1) * (4 * rank + PASSAGE_BYTES)
        if block and size + more > room:
            yield block
            block, size = [], 0
        block.append(item)
        size += more
    if block:
        yield block


def _windows(w: np.ndarray, width: int, stride: int) -> np.ndarray:
    """All passages of ``width`` words that begin at multiples of ``stride``, as rows."""
    if len(w) < width:
        return np.empty((0, width), w.dtype)
    return np.lib.stride_tricks.sliding_window_view(w, width)[::stride]


def _stretches(known: np.ndarray, width: int, least: int, bridge: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the maximal ranges covered by passages with at least ``least`` known words, no more than ``bridge`` words apart."""
    if len(known) < width:
        return
    total = np.concatenate(([0], np.cumsum(known, dtype=np.int32)))
    good = np.flatnonzero(total[width:] - total[:-width] >= least)
    if not len(good):
        return
    cuts = np.flatnonzero(np.diff(good) > width + bridge)
    for a, b in zip(np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(good) - 1]))):
        yield int(good[a]), int(good[b]) + width


def _vectors(windows: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Latent vectors of passages. TF-IDF rows have length 1; id 0 (a word of no item) weighs nothing."""
    out = np.zeros((len(windows), basis.shape[1]))
    for j in range(windows.shape[1]):
        out += basis[windows[:, j]] * idf[windows[:, j], None]
    return out / _lengths(windows, idf)[:, None]


def _lengths(windows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Lengths of the TF-IDF rows: a word that stands f times in a passage weighs f x idf."""
    s = np.sort(windows, axis=1)
    total = np.zeros(len(s))
    run = np.zeros(len(s))
    for j in range(s.shape[1]):
        run = np.where(s[:, j] == s[:, j - 1], run + 1, 1.0) if j else run + 1
        # f^2 grows by 2f - 1 with each further occurrence
        total += (2 * run - 1) * idf[s[:, j]] ** 2
    return np.sqrt(np.maximum(total, 1e-12))


def _gram_times(windows: np.ndarray, idf: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A^T (A y) for the TF-IDF rows A of ``windows``, in chunks."""
    out = np.zeros_like(y)
    for k in range(0, len(windows), 20_000):
        w = windows[k : k + 20_000]
        ay = _vectors(w, idf, y) / _lengths(w, idf)[:, None]
        for j in range(w.shape[1]):
            order = np.argsort(w[:, j], kind="stable")
            ids, at = np.unique(w[order, j], return_index=True)
            out[ids] += np.add.reduceat(ay[order], at, axis=0) * idf[ids, None]
    out[0] = 0
    return out


def _common_run(a: np.ndarray, b: np.ndarray) -> int:
    """Words in the longest passage that stands in both."""
    best, last = 0, np.zeros(len(b) + 1, dtype=np.int32)
    for x in a:
        now = np.zeros_like(last)
        now[1:] = np.where(b == x, last[:-1] + 1, 0)
        best, last = max(best, int(now.max())), now
    return best


def _grams(words: np.ndarray, n: int) -> set[bytes]:
    """The passages of n words, as the bytes of their ids."""
    return {x.tobytes() for x in _windows(np.ascontiguousarray(words, dtype=np.int32), n, 1)}


class Index:
    """Latent vectors hashed by the signs of random projections, in several tables.

    Vectors and projections are rounded to whole numbers, of which sums are exact in any order: so equal passages always have equal
    codes, and those of a verbatim run are found whatever the tables' recall is.
    """

    def __init__(self, latent: np.ndarray, tables: int, bits: int, seed: int) -> None:
        self.latent = latent
        self.planes = np.round(np.random.default_rng(seed).standard_normal((latent.shape[1], tables * bits)) * 1024)
        self.shape = (tables, bits)
        codes = self.codes(latent)
        self.order = np.argsort(codes, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(codes, self.order, axis=0)

    def codes(self, v: np.ndarray) -> np.ndarray:
        signs = np.round(v.astype(np.float64) * 4096) @ self.planes >= 0
        return (signs.reshape(len(v), *self.shape) @ (1 << np.arange(self.shape[1]))).astype(np.int32)

    def near(self, v: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row of v, row of the index, cosine) of pairs that share a code and reach ``least``; a pair may come once per table."""
        codes = self.codes(v)
        for t in range(self.shape[0]):
            low, high = (np.searchsorted(self.sorted[:, t], codes[:, t], side) for side in ("left", "right"))
            n = high - low
            ends = np.cumsum(n)
            for first in range(0, int(ends[-1]) if len(n) else 0, 200_000):
                at = np.arange(first, min(first + 200_000, int(ends[-1])))
                q = np.searchsorted(ends, at, "right")
                hit = self.order[low[q] + at - (ends[q] - n[q]), t]
                cosine = np.einsum("ij,ij->i", v[q], self.latent[hit])
                good = cosine >= least
                yield q[good], hit[good], cosine[good]


class Checker:
    """What the checks need of one item, made once per task: its passages, and where each word stands as bits."""

    def __init__(self, words: np.ndarray, run: int, idf: np.ndarray) -> None:
        self.words, self.n = words, len(words)
        self.need = min(run, self.n)
        self.passages = _grams(words, self.need)
        self.at: dict[int, int] = {}
        for k, x in enumerate(words.tolist()):
            self.at[x] = self.at.get(x, 0) | (1 << k)
        # answer terms: the rarest quarter of the words (numbers and names, as a rule), one at least
        terms = np.argsort(-idf[words], kind="stable")[: max(1, self.n // 4)].tolist()
        self.answer, self.terms = sum(1 << k for k in terms), len(terms)

    def common_subsequence(self, text: list[int]) -> int:
        """Bits of the item's positions in the longest common subsequence with ``text``, bit-parallel over the item."""
        at, full = self.at, (1 << self.n) - 1
        v = full
        for x in text:
            if m := at.get(x):
                u = v & m
                v = ((v + u) | (v - u)) & full
        return full & ~v

    def shares(self, bits: int, span: int, min_answer: float) -> tuple[float, float]:
        """(share of words, share of answer terms) that the bits hold of the best ``span`` of the item, of those that pass ``min_answer`` if any do."""
        n = min(span, self.n)
        best = (False, 0.0, 0.0)
        for k in range(self.n - n + 1):
            window = ((1 << n) - 1) << k
            terms = (self.answer & window).bit_count()
            answer = (bits & self.answer & window).bit_count() / terms if terms else 0.0
            best = max(best, (answer >= min_answer, (bits & window).bit_count() / n, answer))
        return best[1], best[2]


def find_leaks(documents: DataFrame, doc_id: Column, text: Column, items: DataFrame, item_id: Column, item_text: Column, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, item_id, cosine, run_words, lcs_share, answer_share, verbatim``: items found in documents.

    Passages are short windows of words. One pass over all documents tokenises whole texts, counts in
    how many documents each word of an item occurs, and keeps the stretches in which enough words
    occur in some item: elsewhere a passage's TF-IDF row is nearly empty. A randomised SVD of the TF-IDF rows of all
    passages (two distributed passes that return a matrix of item words x rank) gives the latent
    space. Passages of documents look up those of items of high cosine in an index of random projections, and each
    (stretch, item) that has such a pair is checked: longest common run,
    longest common subsequence, answer terms. A verbatim leak has ``run`` common words in a row, or
    the whole of a shorter item; a paraphrase passes ``min_lcs`` and ``min_answer`` within some ``span`` of the item.

    Passages of documents are cut at a stride so small that each verbatim run holds a whole passage
    which is also cut from the item, where the stride is 1: its cosine and its code in the index are the same, so no verbatim leak is
    missed. Items are searched for by length classes, so short ones don't shorten the passages of others. Words are maximal runs of letters and digits without case.

    Scale: the items are the query set. They are collected in groups of bounded size, and sent to the tasks in blocks of
    bounded size, cut by what their passages take; any number of them is handled. Documents are read once per ``group_words`` distinct words of items
    and never shuffled; only stretches, a small part of the corpus, are staged, spread evenly, and gone over once per block.
    Null or empty texts hold nothing; items without words are never found; identical documents and
    repeated items each give their own rows; empty tables give none.
    """
    spark = documents.sparkSession
    queries = items.select(item_id.alias("item_id"), item_text.alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    parts = 1 + (queries.agg(F.sum(F.length("text"))).first()[0] or 0) // settings.group_chars
    docs = documents.select(doc_id.alias("doc_id"), text.alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    found = []
    for k in range(parts):
        rows = [tuple(r) for r in queries.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k).collect()]
        for group in _groups(rows, settings):
            found += _search(docs, group, settings)
    if not found:
        return spark.createDataFrame([], _FOUND)
    # a document may hold an item in several stretches
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("cosine", "run_words", "lcs_share", "answer_share", "verbatim")))


_FOUND = "doc_id bigint, item_id bigint, cosine double, run_words int, lcs_share double, answer_share double, verbatim boolean"


def _sent(spark, value, size: int):
    if size > BROADCAST_BYTES:
        raise ValueError(f"{size} bytes of one item are too many to broadcast")
    return spark.sparkContext.broadcast(value)


def _search(docs: DataFrame, items: Items, s: Settings) -> list[DataFrame]:
    """Hits of one group of items, staged, block by block."""
    spark, size = docs.sparkSession, len(items.vocabulary) + 1
    table = stage(_passages(docs, items, s), "stretches")
    counts = np.zeros(size)
    for i, n in table.where("start = -1").select(F.posexplode("ids").alias("i", "n")).groupBy("i").agg(F.sum("n")).collect():  # one row per item word
        counts[i] = n
    idf = np.log1p(counts[0] / (1 + counts))
    idf[0] = 0
    spread = 4 * spark.sparkContext.defaultParallelism
    stretches = stage(table.where("start >= 0").select("doc_id", "length", "start", F.col("ids").cast("array<int>").alias("ids")).repartition(spread, "doc_id", "start"), "spread")
    unstage(table)
    basis = _latent_space(stretches, items, idf, s)
    sent = _sent(spark, (idf, basis), basis.nbytes + idf.nbytes)
    found = []
    for length, members in items.classes.items():
        for block in _blocks(members, _cut(length)[0], basis.shape[1], s.block_bytes):
            found.append(stage(_check(stretches.where(F.col("length") == length), length, block, sent, s), "hits"))
    unstage(stretches)
    return found


def _passages(docs: DataFrame, items: Items, s: Settings) -> DataFrame:
    """``doc_id, length, start, ids``: stretches by length class; rows with start -1 count the documents with each word, and all documents under word 0."""
    members = items.members()
    sent = _sent(docs.sparkSession, (items.vocabulary, members), 100 * len(items.vocabulary) + members.nbytes)
    classes = [(n, _cut(n)[0]) for n in sorted(items.classes, reverse=True)]

    def passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, members = sent.value
        get, docs_with, n = vocabulary.get, np.zeros(members.shape[1], dtype=np.int64), 0
        for batch in batches:
            found = []
            for d, t in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                w = np.array([get(x, 0) for x in WORD.findall(t.lower())], dtype=np.int32)
                n += 1
                docs_with[np.unique(w)] += 1
                for (length, width), member in zip(classes, members):
                    found += [(d, length, a, w[a:b]) for a, b in _stretches(member[w], width, int(np.ceil(s.min_known * width)), s.bridge)]
            yield pd.DataFrame(found, columns=["doc_id", "length", "start", "ids"])
        docs_with[0] = n
        yield pd.DataFrame({"doc_id": [None], "length": [0], "start": [-1], "ids": [docs_with]})

    return docs.mapInPandas(passages, "doc_id bigint, length int, start int, ids array<bigint>")


def _latent_space(stretches: DataFrame, items: Items, idf: np.ndarray, s: Settings) -> np.ndarray:
    """Right singular vectors of the TF-IDF rows of all passages of documents and items, as item words x rank."""
    spark, size = stretches.sparkSession, len(idf)
    own = [np.concatenate([_windows(w, _cut(length)[0], 1) for _, w in members]) for length, members in items.classes.items()]

    def gram(y: np.ndarray) -> np.ndarray:
        """A^T A y over the passages of all documents and items."""
        sent = _sent(spark, (idf, y), y.nbytes)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            idf, y = sent.value
            total = np.zeros_like(y)
            for batch in batches:
                for length, rows in batch.groupby("length"):
                    total += _gram_times(np.concatenate([_windows(np.asarray(w), *_cut(length)) for w in rows["ids"]]), idf, y)
            hit = np.flatnonzero(total.any(axis=1))
            yield pd.DataFrame({"i": hit, "v": pd.Series(list(total[hit]), dtype=object)})

        parts = stretches.select("length", "ids").mapInPandas(partial, "i int, v array<double>")
        sums = parts.groupBy("i").agg(*(F.sum(F.get("v", F.lit(j))).alias(f"v{j}") for j in range(y.shape[1]))).toPandas()  # one row per item word
        out = sum(_gram_times(w, idf, y) for w in own)
        out[sums["i"].to_numpy(dtype=int)] += sums.drop(columns="i").to_numpy(dtype=float)
        return out

    q = np.linalg.qr(gram(np.random.default_rng(s.seed).standard_normal((size, min(s.rank, size)))))[0]
    values, turn = np.linalg.eigh(q.T @ gram(q))
    return (q @ turn[:, values > 1e-9 * max(values.max(), 1e-300)]).astype(np.float32)


def _unit(w: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    v = _vectors(w, idf, basis)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _check(stretches: DataFrame, length: int, block: list[tuple[int, np.ndarray]], space, s: Settings) -> DataFrame:
    """Items of one block in stretches of their length class."""
    width, stride = _cut(length)
    least = int(np.ceil(s.min_known * width))
    model = _sent(stretches.sparkSession, block, sum(64 + w.nbytes for _, w in block))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = None
        for batch in batches:
            if index is None:
                idf, basis = space.value
                items = [(i, Checker(w, s.run, idf)) for i, w in model.value]
                index = Index(_unit(np.concatenate([_windows(c.words, width, 1) for _, c in items]), idf, basis), s.tables, s.bits, s.seed)
                origin = np.concatenate([np.full(c.n - width + 1, k) for k, (_, c) in enumerate(items)])
                lengths = {c.need for _, c in items}
            texts, cuts, owner = [], [], []
            for k, w in enumerate(batch["ids"]):
                w = np.asarray(w, dtype=np.int32)
                texts.append(w)
                cut = _windows(w, width, stride)
                if (len(w) - width) % stride:
                    cut = np.concatenate([cut, w[None, -width:]])
                cut = cut[(cut > 0).sum(axis=1) >= least]
                cuts.append(cut)
                owner.append(np.full(len(cut), k))
            best: dict[tuple[int, int], float] = {}
            if texts:
                cut, owner = np.concatenate(cuts), np.concatenate(owner)
                for first in range(0, len(cut), 20_000):
                    v = _unit(cut[first : first + 20_000], idf, basis)
                    for q, hit, cosine in index.near(v, s.min_cosine):
                        pair, at = np.unique(owner[first + q].astype(np.int64) * len(items) + origin[hit], return_inverse=True)
                        top = np.zeros(len(pair))
                        np.maximum.at(top, at, cosine)
                        for p, c in zip(pair.tolist(), top.tolist()):
                            key = divmod(p, len(items))
                            best[key] = max(best.get(key, 0.0), c)
            found, grams, last = [], {}, -1
            docs = batch["doc_id"].tolist()
            for (k, at), cosine in sorted(best.items()):
                if k != last:
                    last, grams, text = k, {n: _grams(texts[k], n) for n in lengths}, texts[k].tolist()
                i, item = items[at]
                verbatim = not item.passages.isdisjoint(grams[item.need])
                lcs, answer = item.shares(item.common_subsequence(text), s.span, s.min_answer)
                if verbatim or lcs >= s.min_lcs and answer >= s.min_answer:
                    found.append((docs[k], i, min(cosine, 1.0), _common_run(texts[k], item.words), lcs, answer, verbatim))
            yield pd.DataFrame(found, columns=[c.split()[0] for c in _FOUND.split(", ")])

    return stretches.select("doc_id", "ids").mapInPandas(check, _FOUND)
