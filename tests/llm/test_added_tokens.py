"""Packing of texts that hold added tokens, against the tokenizer as loaded."""

import json
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tripcast.llm import packing, queries
from tripcast.llm.queries import vocabulary

BPE = vocabulary("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [f"see {END} a", END, END * 3, f"{END}  x", f"a  {END}", "plain text", f"<{END}>\n {END}\n", "<|endoftext|", "", f"日本 {END} é b", f"w {END} " * 900, "a  b", "<|endof<|endoftext|>text|>"]


def test_query_and_stage_give_the_ids_of_the_tokenizer_as_loaded(spark, tmp_path):
    t = Tokenizer.from_file(BPE)
    assert t.encode(TEXTS[0], add_special_tokens=False).ids == [3826, 220, 50256, 257]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(2)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    packed = corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).withColumn("ids_crc32", F.crc32("ids")).collect()
    got = defaultdict(list)
    for r in packed:
        got[r.doc_id].append(r)
    for i, text in enumerate(TEXTS):
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        pieces = sorted(got[i], key=lambda r: r.start)
        assert [x for r in pieces for x in np.frombuffer(r.ids, "<u4").tolist()] == ids, text[:40]
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    rows = queries.op2_packing(spark, str(tmp_path)).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, rows)) == sorted(map(key, packed))


@pytest.mark.parametrize("normalized", [False, True])
def test_several_added_tokens(tmp_path, normalized):
    spec = json.load(open(BPE, encoding="utf-8"))
    extra = [("<|endoftext|>more", not normalized), ("qua zix", normalized), ("qua z", False), ("zix and", True)]
    spec["added_tokens"] += [{"id": 50257 + i, "content": c, "single_word": False, "lstrip": False, "rstrip": False, "normalized": n, "special": i % 2 == 0}
                             for i, (c, n) in enumerate(extra)]
    path = f"{tmp_path}/more.json"
    json.dump(spec, open(path, "w", encoding="utf-8"))
    texts = [f"x {END}more y", "qua zix and qua  zix and", "a qua zix", "zix and qua zix and", "none", f"{END}{END}more"]
    ids, at = packing.Encoder(path, added=True).batch(pa.array(texts, pa.large_string()))
    t = Tokenizer.from_file(path)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_tokens_that_depend_on_their_surroundings_are_refused(tmp_path):
    spec = json.load(open(BPE, encoding="utf-8"))
    spec["added_tokens"][0]["lstrip"] = True
    path = f"{tmp_path}/odd.json"
    json.dump(spec, open(path, "w", encoding="utf-8"))
    with pytest.raises(ValueError, match="surroundings"):
        packing.Encoder(path, added=True)
