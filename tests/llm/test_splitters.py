"""Splitters of the histogram sort against a sorted list."""

import random
from bisect import bisect_left

from shared import docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tripcast.llm import sharding

MASK = (1 << 64) - 1


def plain_key(h, k, row):
    return ((h & MASK) << 128) | (((k & MASK) ^ (1 << 63)) << 64) | row


def test_splitters_count_exactly_and_are_as_near_as_whole_rows_allow(spark):
    rng = random.Random(3)
    hashes = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(40)]
    # a third of all rows share one hash, some also the id, and sizes differ by five orders
    table = [(hashes[0] if i % 3 == 0 else rng.choice(hashes), rng.choice([-5, 0, 7, i]), i, rng.choice([8, 9, 100, 5000, 900_000])) for i in range(3000)]
    rows = spark.createDataFrame(table, "h long, k long, row long, size long").repartition(7)
    order = sorted((plain_key(h, k, r), size) for h, k, r, size in table)
    keys = [k for k, _ in order]
    sums = [0]
    for _, size in order:
        sums.append(sums[-1] + size)
    parts = 24
    targets = [sums[-1] * i // parts for i in range(1, parts)]
    for slack in (0.0, 0.01 * sums[-1] / parts):
        found = sharding.splitters(rows, targets, [slack] * len(targets), sums[-1], len(table))
        for (key, below, count), target in zip(found, targets, strict=True):
            at = bisect_left(keys, key)
            assert (below, count) == (sums[at], at)
            nearest = min(abs(x - target) for x in sums)
            assert abs(below - target) <= max(slack, nearest)


def test_slots_are_places_in_the_sorted_list(spark, docs, rows):
    copies = docs.union(docs.where("doc_id = 3").withColumn("doc_id", F.explode(F.sequence(F.lit(300000), F.lit(300099)))))
    got = sharding.shard(copies, shards=5, carry=("text",)).withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    placed = sorted(got, key=lambda r: (r.shard, r.slot))
    order = [(r.h & MASK, r.doc_id) for r in placed]
    assert order == sorted(order) and len(order) == len(rows) + 100
    for s in range(5):
        assert [r.slot for r in placed if r.shard == s] == list(range(sum(r.shard == s for r in placed)))
