"""Operator 6: line dedup with DataFrame operations only.

Each text is split at line feeds; a line's key is the line without white space at
its ends and with A-Z lower-cased, taken by two independent 64-bit hashes. Every
row sends each distinct key once; counting combines before the shuffle, so a line
that a third of all documents hold costs a row per task. Keys counted often enough
meet the lines again (a join that Spark splits where a key is hot, or broadcasts
where the keys are few), their documents are counted exactly, and each text that
loses lines gets their positions and is put together from the stretches between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"


def fold(text: Column) -> Column:
    """Equal for texts that differ only in the case of A-Z.

    ``lower`` would also fold letters beyond ASCII, and ``translate`` builds an object
    per character. Read byte by byte (ISO-8859-1), lower-casing moves A-Z and the lead
    bytes of two-byte characters; a moved lead byte can't be taken for another one, as
    the number of continuation bytes after it differs.
    """
    return F.lower(F.decode(text.cast("binary"), "ISO-8859-1"))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop, in every document, all lines whose key is found in at least min_docs documents.

    Returns docs with the text replaced by the remaining lines joined by a line feed,
    and ``n_lines`` (before) and ``n_dropped`` (long; input columns of these names are
    replaced). Keys of fewer than min_chars code points stay (always so an empty key).
    A null or empty text is one empty line. Documents are told apart by id: rows that
    share one count as one document, rows without id by their text.
    """
    names = docs.columns
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    full = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(full, "\n", -1)
    # the row's text, so that rows sharing an id keep their own positions
    df = df.withColumn("r", F.xxhash64(full))
    doc = F.when(F.col(key).isNull(), F.col("r")).otherwise(F.xxhash64(key, F.lit(0))) if docs.schema[id_col].dataType.simpleString() == "string" else \
        F.coalesce(F.col(key).cast("long"), F.col("r"))

    def keyed(array: Column, *more: str) -> DataFrame:
        out = df.select(doc.alias("doc"), "r", F.posexplode(array).alias("pos", "line"))
        out = out.withColumn("line", F.btrim("line", F.lit(WHITE)))
        out = out.where(F.char_length("line") >= max(1, min_chars)).withColumn("line", fold(F.col("line")))
        return out.select("doc", *more, F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))

    often = keyed(F.array_distinct(lines)).groupBy("h", "g").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    hits = keyed(lines, "r", "pos").join(often.select("h", "g"), ["h", "g"])
    # array_distinct sees lines, not keys, and an id may repeat: count the documents of these keys exactly
    sure = hits.groupBy("h", "g", "doc").agg(F.lit(1).alias("one")).groupBy("h", "g").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    lost = hits.join(sure.select("h", "g"), ["h", "g"]).groupBy("doc", "r").agg(F.array_sort(F.collect_set("pos")).alias("lost"))
    out = df.withColumn("doc", doc).join(lost, ["doc", "r"], "left")
    out = out.withColumns({"lines": lines, "lost": F.coalesce("lost", F.array().cast("array<int>"))})
    # the stretches between lost lines, each taken once
    def stretch(every: Column, j: Column) -> Column:
        before, after = F.coalesce(F.get("lost", j - 1), F.lit(-1)), F.coalesce(F.get("lost", j), F.size(every))
        return F.slice(every, before + 2, after - before - 1)

    rest = F.transform(F.array("lines"), lambda every: F.flatten(F.transform(F.sequence(F.lit(0), F.size("lost")), lambda j: stretch(every, j))))
    kept = F.when(F.size("lost") == 0, full).otherwise(F.concat_ws("\n", F.get(rest, F.lit(0))))
    out = out.withColumns({text: kept, "total": F.size("lines").cast("long"), "gone": F.size("lost").cast("long")})
    keep = [c for c in names if c not in ("n_lines", "n_dropped")]
    return out.select(*[F.col(f"c{names.index(c)}").alias(c) for c in keep], F.col("total").alias("n_lines"), F.col("gone").alias("n_dropped"))
