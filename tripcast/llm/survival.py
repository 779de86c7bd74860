"""Operator 12: filter interaction audit by truth-table survival words.

Which of five filters a text fails decides which of the 32 subsets of the filters it
survives: one 32-bit word per document, with a bit per subset. Summing the words bit
by bit (positional popcounts, by carry-save adders inside tasks) gives each subset's
survivors per part and label. Every figure of every order of the filters is a
difference of such sums, so the documents are read once and no order is replayed.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
WORD = r"[^\x20\x09-\x0D]+"
MANY_PARTS = 4096  # parts that a task holds sums of before it passes them on

# bit s of word f: a document that fails the filters in f survives the subset s
SURVIVES = np.array([sum(1 << s for s in range(SUBSETS) if not s & f) for f in range(SUBSETS)], np.uint32)


def text_filters(text: Column) -> list[Column]:
    """Failure conditions A to D of a text that isn't null: too few words, too few distinct ones, shouting, symbols."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [F.size(words) < 100, 100 * F.size(F.array_distinct(words)) < 80 * F.size(words), 100 * capitals > 10 * F.length(text),
            text.rlike(r"[#$%&*|]")]


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words hold each bit: carry-save adders make three words of a weight one, and one of the next."""
    total, weight = np.zeros(32, np.int64), 0
    while len(words):
        carries = [words[:0]]
        while len(words) >= 3:
            n = len(words) // 3
            a, b, c = words[:n], words[n:2 * n], words[2 * n:3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * n:]))
        for w in words.tolist():
            total += np.array([w >> s & 1 for s in range(32)], np.int64) << weight
        words, weight = np.concatenate(carries), weight + 1
    return total


def survivors(fails: DataFrame, classes: int) -> DataFrame:
    """fails(part string, fails int, classes int) to (part, class int, subset int, n long), zeros left out.

    ``classes`` is a set of bits; class 0 has all documents and class k those with bit k - 1.
    """

    def sums(held: dict):
        rows = [(part, k, s, int(n)) for part, counts in held.items() for k in range(classes + 1) for s, n in enumerate(counts[k]) if n]
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int64()))],
                               names=["part", "class", "subset", "n"])

    def one(batches):
        held: dict = {}
        for batch in batches:
            coded = batch["part"].dictionary_encode()
            of, parts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            words, bits = SURVIVES[batch["fails"].to_numpy()], batch["classes"].to_numpy()
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(len(parts) + 1))
            for i, part in enumerate(parts):
                mine = order[cuts[i]: cuts[i + 1]]
                counts = held.setdefault(part, np.zeros((classes + 1, 32), np.int64))
                for k in range(classes + 1):
                    counts[k] += positional_popcount(words[mine[bits[mine] >> (k - 1) & 1 == 1] if k else mine])
            if len(held) > MANY_PARTS:
                yield sums(held)
                held = {}
        yield sums(held)

    found = fails.select("part", "fails", "classes").mapInArrow(one, "part string, class int, subset int, n long")
    return found.groupBy("part", "class", "subset").agg(F.sum("n").alias("n"))


def _steps() -> list[dict]:
    """Each step of each order: the subsets applied before and after it."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append({"filter_order": "".join(FILTERS[i] for i in order), "step": step, "f": f, "bit": 1 << f, "before": before, "after": before | 1 << f})
            before |= 1 << f
    return rows


def _shapley(f: int, n: Column) -> Column:
    """What the filter of bit f removes, summed over all orders: a subset of k others comes first in k! (4 - k)! of them."""
    others = [s for s in range(SUBSETS) if not s & f]
    return sum((factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) * (n[s] - n[s | f]) for s in others), F.lit(0).cast("long"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """What each filter removes at each step of every order, per part.

    Filters: those of ``text_filters`` and E, a text identical to one under a smaller id
    anywhere in the table. labels(id, quality, toxic) may lack documents or name one more
    than once (a 1 in any row counts); rows without id have no label, are no repeat
    and make none. Rows that share an id count each on their own, and are no repeats of each
    other. Null texts are empty, a null part is the empty string. Returns 600 rows per
    part (zeros included; none for an empty table): ``part``, ``filter_order``, ``step`` and
    the documents ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its
    filter, gone before), ``unique_fails`` (failing its filter only), ``good_lost`` and
    ``toxic_lost`` (removed with such a label), ``shapley`` (removed by its filter, over all orders).
    """
    text = F.coalesce(F.col("c1"), F.lit(""))
    bits = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_filters(text))), F.lit(0))
    df = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    slim = R.written(df.select("c0", "part", bits.cast("int").alias("bits"), F.unhex(F.sha2(text, 256)).alias("h")), "filters")
    # every text's smallest id; meeting it by id too spreads the copies of one text
    firsts = slim.where("c0 is not null").groupBy("h").agg(F.min("c0").alias("c0")).withColumn("first", F.lit(True))
    known = labels.select(F.col(id_col).alias("c0"), (F.col("quality") == 1).alias("q"), (F.col("toxic") == 1).alias("t"))
    known = known.where("c0 is not null").groupBy("c0").agg(F.max("q").alias("q"), F.max("t").alias("t"))
    rows = slim.join(firsts, ["c0", "h"], "left").join(known, "c0", "left")
    repeat = F.col("c0").isNotNull() & F.col("first").isNull()
    rows = rows.select("part", (F.col("bits") + F.when(repeat, 16).otherwise(0)).alias("fails"),
                       (F.when(F.col("q"), 1).otherwise(0) + F.when(F.col("t"), 2).otherwise(0)).alias("classes"))
    counts = survivors(rows, 2).withColumn("at", F.col("class") * SUBSETS + F.col("subset"))
    per = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("m"))
    by = [F.transform(F.sequence(F.lit(k * SUBSETS), F.lit((k + 1) * SUBSETS - 1)), lambda s: F.coalesce(F.col("m")[s], F.lit(0).cast("long"))) for k in range(3)]
    per = per.select("part", *[x.alias(c) for x, c in zip(by, ("n", "good", "toxic"), strict=True)])
    per = per.withColumn("values", F.array(*[_shapley(1 << i, F.col("n")) for i in range(len(FILTERS))]))
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order:string,step:int,f:int,bit:int,before:int,after:int>>")
    out = per.select("*", F.inline(steps))
    n, good, toxic, before, after, bit = (F.col(c) for c in ("n", "good", "toxic", "before", "after", "bit"))
    removed, every = n[before] - n[after], SUBSETS - 1
    return out.select("part", "filter_order", "step", n[after].alias("kept"), removed.alias("removed"), (n[0] - n[bit] - removed).alias("redundant"),
                      (n[every - bit] - n[every]).alias("unique_fails"), (good[before] - good[after]).alias("good_lost"),
                      (toxic[before] - toxic[after]).alias("toxic_lost"), F.col("values")[F.col("f")].alias("shapley"))
