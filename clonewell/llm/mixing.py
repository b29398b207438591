"""Problem 7: mixing sources to target shares of all tokens, by pivotal dependent rounding."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from clonewell.session import small, stage

#: Ranks of a public byte-level tokenizer; the path is a parameter of every function that counts tokens.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which that tokenizer splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows that one task rounds at a time, and residuals it combines at a time.
CHUNK = 20_000
FAN_IN = 1_000


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: White space in the tokenizer's sense; longer runs than this overflow its pattern's stack.
_LONG_SPACE = re.compile("[ \\t\\n\\r\\f\\v\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{4096,}")


def _counter(path: str, pattern: str):
    """Function that counts the tokens of a text. Long runs of white space are counted apart.

    The pattern takes such a run up to its last character as one piece (the whole run at the end of a text), and a piece
    ends where it begins, so cutting there doesn't change the count.
    """
    encoder = _encoder(path, pattern)

    def count(text: str) -> int:
        n = at = 0
        for m in _LONG_SPACE.finditer(text):
            end = m.end() - (m.end() < len(text))
            n += len(encoder.encode_ordinary(text[at : m.start()])) + len(encoder._core_bpe.encode_single_piece(text[m.start() : end].encode()))
            at = end
        return n + len(encoder.encode_ordinary(text[at:]))

    return count


def token_counts(df: DataFrame, text: str, tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """``df`` with ``text`` replaced by ``n_tokens``, its tokens; null and empty texts have 0. A column of that name is replaced."""
    others = [c for c in df.columns if c not in (text, "n_tokens")]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(tokenizer, pattern)
        for batch in batches:
            yield batch[others].assign(n_tokens=[count(t) if t else 0 for t in batch[text]])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in others)
    return df.select(*others, text).mapInPandas(counted, f"{schema}, n_tokens bigint")


def source_name(c: Column) -> Column:
    """A source name for comparison: lower case, blanks, ``-`` and ``_`` as one ``-``; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), r"[\s_-]+", "-"), F.lit("-")), F.lit(""))


def plan_shares(tokens: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """``source, share, max_repeat, n_docs, n_source, want, copies``: how often each source's documents are to be used on average.

    ``targets`` has ``source, share, max_repeat`` with source names made comparable. Shares are taken
    relative to the sum of those of sources that have tokens. ``total`` is the mixture's size; by
    default the largest at which no source exceeds its cap. A larger one leaves capped sources short.
    """
    have = tokens.where("n_tokens > 0").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_source"))
    asked = targets.where("source IS NOT NULL AND share > 0 AND max_repeat > 0").groupBy("source").agg(F.max("share").alias("share"), F.min("max_repeat").alias("max_repeat"))
    both = have.join(small(asked), "source")
    sums = both.agg(F.sum("share").alias("all_shares"), F.min(F.col("max_repeat") * F.col("n_source") / F.col("share")).alias("room"))
    size = F.lit(float(total)) if total is not None else F.col("room") * F.col("all_shares")
    planned = both.crossJoin(F.broadcast(sums))  # one row
    planned = planned.withColumn("want", size * F.col("share") / F.col("all_shares"))
    # a cap that is met up to rounding error is met
    copies = F.least(F.col("want") / F.col("n_source"), F.col("max_repeat").cast("double"))
    copies = F.when(F.abs(copies - F.round(copies)) < 1e-9, F.round(copies)).otherwise(copies)
    return planned.withColumn("copies", copies).select("source", "share", "max_repeat", "n_docs", "n_source", "want", "copies")


def _pivotal(size: np.ndarray, p: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, int]:
    """Rounded p, but for at most one unit (its index, or -1). The sum of size x p stays the same."""
    p, at = p.tolist(), -1
    size = size.tolist()
    draws = random.random(len(p)).tolist()
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if at < 0:
            at = j
            continue
        i = at
        up = min((1.0 - p[i]) * size[i], p[j] * size[j])  # mass that can move from j to i
        down = min(p[i] * size[i], (1.0 - p[j]) * size[j])
        move = up if draws[j] * (up + down) < down else -down
        p[i] += move / size[i]
        p[j] -= move / size[j]
        for k in (i, j):
            if p[k] < 1e-9:
                p[k] = 0.0
            elif p[k] > 1.0 - 1e-9:
                p[k] = 1.0
        at = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return np.array(p), at


def _rounding(seed: int, level: int, last: bool):
    """Rounds one bucket of one source; at the last level also the unit that is left."""

    def rounded(key: tuple, unit: pd.DataFrame) -> pd.DataFrame:
        unit = unit.sort_values(["n_tokens", "doc_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        random = np.random.default_rng([seed, level, int(key[1]), *key[0].encode()])
        p, at = _pivotal(unit["n_tokens"].to_numpy(float), unit["p"].to_numpy(float), random)
        if last and at >= 0:
            p[at] = float(random.random() < p[at])
        return unit.assign(p=p)

    return rounded


_UNIT = "source string, doc_id bigint, n_tokens bigint, times bigint, base bigint, p double, bucket bigint"


def mix_sources(tokens: DataFrame, plan: DataFrame, seed: int = 11, chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, source, n_tokens, copies`` of the chosen documents.

    Each document of a source is to be used ``copies`` times on average: its whole part for certain,
    the fraction with that probability. Pivotal rounding pairs two fractional units and moves
    token mass from one to the other, in the direction drawn with the odds that keep both expectations,
    until one of them is 0 or 1. The pair's mass (tokens x probability) doesn't change, so a source
    ends within one document of its target. Units are taken in order of falling size, so those paired are alike.

    Scale: documents are hashed into buckets of about ``chunk``, so a source with a third of all rows
    is spread over its buckets. A bucket leaves at most one fractional document; those of ``fan_in``
    buckets are combined in the next level, until one per source is left, which is rounded by its
    probability. Draws depend only on the seed, level, source and bucket, and units are taken in order
    of size and id, so a repeated task gives the same rows. Rows alike are counted before, by a map-side aggregate, so that an
    id that stands in very many rows is one unit; its uses are spread evenly over its rows.

    ``plan`` is read several times; it has one row per source and should be staged. Null sources, and those without target,
    share or room, are not used. Documents without tokens are never chosen. Repeated rows are documents of their own.
    Empty tables give no rows.
    """
    known = tokens.where("n_tokens > 0 AND doc_id IS NOT NULL").groupBy("doc_id", "source", "n_tokens").agg(F.count(F.lit(1)).alias("times"))
    known = known.join(small(plan.where("copies > 0").select("source", "copies", "n_docs")), "source")
    uses = F.col("copies") * F.col("times")
    uses = F.when(F.abs(uses - F.round(uses)) < 1e-9, F.round(uses)).otherwise(uses)
    buckets = F.ceil(F.col("n_docs") / chunk)
    units = known.select(
        "source", "doc_id", "n_tokens", "times", F.floor(uses).alias("base"), (uses - F.floor(uses)).alias("p"), F.pmod(F.xxhash64("doc_id", F.lit(seed)), buckets).alias("bucket")
    )
    most = plan.agg(F.max("n_docs")).first()[0] or 0
    levels = [1] if most <= chunk else [1, *([fan_in] * int(np.ceil(np.log(most / chunk + 1) / np.log(fan_in))))]
    done = []
    for level, width in enumerate(levels):
        units = units.withColumn("bucket", F.floor(F.col("bucket") / width)).groupBy("source", "bucket").applyInPandas(_rounding(seed, level, level == len(levels) - 1), _UNIT)
        units = stage(units, "rounded")
        done.append(units.where("p IN (0, 1)"))
        units = units.where("p > 0 AND p < 1")
    chosen = reduce(DataFrame.unionByName, done).withColumn("uses", F.col("base") + F.col("p").cast("int")).where("uses > 0")
    each = chosen.select("doc_id", "source", "n_tokens", "uses", "times", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("uses", "times"))).alias("k"))
    return each.select("doc_id", "source", "n_tokens", (F.floor(F.col("uses") / F.col("times")) + (F.col("k") <= F.col("uses") % F.col("times")).cast("int")).cast("int").alias("copies"))


def reached_shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, max_repeat, reached_share, n_docs, n_tokens, most_copies`` of every target, also of those without documents."""
    by = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens") * F.col("copies")).alias("n_tokens"), F.max("copies").alias("most_copies"))
    total = chosen.agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("total"))
    zero = {"n_docs": 0, "n_tokens": 0, "most_copies": 0}
    out = targets.join(by, "source", "left").crossJoin(F.broadcast(total)).fillna(zero)  # total is one row
    share = F.coalesce(F.col("n_tokens") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    return out.select("source", F.col("share").alias("target_share"), "max_repeat", share.alias("reached_share"), "n_docs", "n_tokens", "most_copies")
