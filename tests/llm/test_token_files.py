import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from quire.llm import token_files  # noqa: E402
from quire.llm.queries import vocabulary  # noqa: E402

ROWS = [
    (5, "The cat's pyjamas, he'll see: 12345 times!\n\nTwo  spaces\tand a tab"), (2, ""), (3, None), (None, "no id"), (9, "déjà vu é ́x ΟΔΟΣ İ ſ"),
    (9, "déjà vu é ́x ΟΔΟΣ İ ſ"), (7, "<|endoftext|>word<|startoftext|> <|endoftext"), (8, "a b c\x1cd\x85e\x0bf​g"), (1, "word " * 30_000),
]


def expected(rows):
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("part", F.lit(1))


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_files_hold_what_the_tokenizer_gives(spark):
    assert ordered(token_files.token_files(frame(spark, ROWS), vocabulary()).collect()) == expected(ROWS)


def test_no_rows(spark):
    assert token_files.token_files(frame(spark, []), vocabulary()).collect() == []


def test_lookup_is_pushed_to_the_stripes(spark, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write(frame(spark, ROWS), folder, vocabulary(), partitions=3)
    one = token_files.read(spark, folder).where("doc_id = 7")
    assert "EqualTo(doc_id,7)" in one._jdf.queryExecution().toString()
    assert one.count() == 1
    order = [r.doc_id for r in token_files.read(spark, folder).orderBy("part", "place").collect()]
    assert order == [None, 1, 2, 3, 5, 7, 8, 9, 9]


def test_whole_texts_of_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert ordered(token_files.token_files(docs, vocabulary()).collect()) == expected([(r.doc_id, r.text) for r in docs.collect()])
