"""Operator 8: language ID by rank-order profiles.

A profile is the list of a text's most frequent n-grams (one to four UTF-8 bytes
inside words, a space marking a word's edge), most frequent first. A language's
profile is counted over all its training texts; a document has the language whose
profile is least out of place: each n-gram costs the difference of its ranks, or the
most possible where the language doesn't rank it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripcast.llm.text import lower_ascii, raw, slices

LONGEST, TOP = 4, 300
UNKNOWN = "und"


@dataclass
class Profiles:
    """Ranks of the n-grams that any language ranks: grams sorted, ranks[gram, language] (TOP: not ranked)."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    top: int


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes from each byte on (0: none), bytes x LONGEST, and each text's range (one more than texts)."""
    spaced = pc.binary_join_element_wise(texts, pa.scalar(b" ", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    data, offsets = raw(spaced)
    data = lower_ascii(np.concatenate(([np.uint8(0x20)], data, np.full(LONGEST, 0x20, np.uint8))))
    after = np.zeros(len(data), bool)  # Latin capitals beyond ASCII: C3 80..9E but 97
    after[1:] = (data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] >= 0x80) & (data[1:] != 0x97)
    data = data + (after.astype(np.uint8) << 5)
    letter = (data >= 0x80) | ((data >= 97) & (data <= 122))
    data = np.where(letter, data, np.uint8(0x20)).astype(np.uint32)
    n = len(data) - LONGEST
    out = np.zeros((n, LONGEST), np.uint32)
    code = data[:n]
    out[:, 0] = np.where(letter[:n], code, 0)
    for k in range(1, LONGEST):
        code = (code << np.uint32(8)) | data[k: k + n]
        out[:, k] = np.where(_in_word(letter, n, k), code, 0)
    return out, offsets


def _in_word(letter: np.ndarray, n: int, k: int) -> np.ndarray:
    """Whether bytes 1..k-1 from each place on are letters, and one of the two at the edges is."""
    ok = letter[:n] | letter[k: k + n]
    for j in range(1, k):
        ok &= letter[j: j + n]
    return ok


def _counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes[codes > 0])
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[at], np.diff(np.append(at, len(codes)))


def _ranked(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, equal ones by code."""
    key = (counts.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - grams.astype(np.uint64))
    if len(key) > top:
        key = np.partition(key, len(key) - top)[len(key) - top:]
    return (np.uint64(0xFFFFFFFF) - (np.sort(key)[::-1] & np.uint64(0xFFFFFFFF))).astype(np.uint32)


def learn(docs: DataFrame, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> Profiles:
    """Profiles of all languages of docs, counted over all rows with a language and a text.

    What reaches the driver is bounded: top n-grams per language.
    """
    def one(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), "text"):
                codes, at = _codes(texts)
                langs = np.array(part["lang"].to_pylist(), object)
                for lang in dict.fromkeys(langs):
                    mine = np.flatnonzero(langs == lang)
                    grams, counts = _counts(np.concatenate([codes[at[i]:at[i + 1]].ravel() for i in mine]))
                    if lang in total:
                        both = np.concatenate((total[lang][0], grams))
                        grams, where = np.unique(both, return_inverse=True)
                        counts = np.bincount(where, np.concatenate((total[lang][1], counts))).astype(np.int64)
                    total[lang] = grams, counts
        for lang, (grams, counts) in total.items():
            yield pa.record_batch({"lang": pa.array([lang] * len(grams), pa.string()), "gram": pa.array(grams.astype(np.int64)),
                                   "n": pa.array(counts.astype(np.int64))})

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    sums = rows.mapInArrow(one, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", "gram", "rank").collect()
    langs = sorted({r.lang for r in best})
    grams = np.array(sorted({r.gram for r in best}), np.uint32)
    ranks = np.full((len(grams), len(langs)), top, np.int64)
    for r in best:
        ranks[np.searchsorted(grams, r.gram), langs.index(r.lang)] = r["rank"] - 1
    return Profiles(langs, grams, ranks, top)


def _distance(profile: np.ndarray, p: Profiles) -> np.ndarray:
    at = np.minimum(np.searchsorted(p.grams, profile), len(p.grams) - 1)
    found = p.grams[at] == profile
    ranks = p.ranks[at[found]]
    moved = np.where(ranks < p.top, np.abs(ranks - np.flatnonzero(found)[:, None]), p.top)
    return moved.sum(axis=0) + p.top * (len(profile) - int(found.sum()))


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """docs with ``lang_pred`` and ``score`` (1 less the distance's share of the largest possible; input columns of these names are replaced).

    Reads the text only. A null text, one without a letter, and every text if nothing
    was learned, is ``und`` with score 0. Equal distances: the first language by name.
    """
    names = docs.columns
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index(text_col)}"

    def one(batches):
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), text):
                codes, at = _codes(texts)
                pred, score = [], []
                for i in range(len(texts)):
                    grams, counts = _counts(codes[at[i]:at[i + 1]].ravel())
                    if not len(grams) or not profiles.langs or not (
                            ((grams >= 97) & (grams <= 122)).any() or any(c.isalpha() for c in texts[i].as_py().decode())):
                        pred.append(UNKNOWN)
                        score.append(0.0)
                        continue
                    profile = _ranked(grams, counts, profiles.top)
                    distance = _distance(profile, profiles)
                    best = int(np.argmin(distance))
                    pred.append(profiles.langs[best])
                    score.append(1.0 - float(distance[best]) / (profiles.top * len(profile)))
                yield from pa.table([*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                    names=[*part.column_names, "pred", "score"]).combine_chunks().to_batches()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    out = df.mapInArrow(one, ddl + ", pred string, score double")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in ("lang_pred", "score")],
                      F.col("pred").alias("lang_pred"), "score")


def held_out(id_col: str = "doc_id"):
    """True for documents that nothing is learned from: crc32 of the id as text mod 5 is 0 (also without id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))
