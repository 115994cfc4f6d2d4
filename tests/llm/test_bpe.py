from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.edges import TEXTS, documents, no_documents
from touchline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
OUTPUTS = ["n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="aeinst ing'sll re\n\t  <|endoftext|>0123é日\x85\x1c", max_size=120))
def test_ids_equal_the_library(text):
    ids, written = bpe.coder(PATH).encode(text)
    assert ids.tolist() == Tokenizer_ids(text)
    assert written == ",".join(map(str, ids.tolist()))
    assert bpe.coder(PATH).decode(ids).decode() == text


def Tokenizer_ids(text, cache={}):
    if "t" not in cache:
        cache["t"] = Tokenizer.from_file(PATH)
    return cache["t"].encode(text, add_special_tokens=False).ids


def test_white_space_and_letters_of_all_planes():
    use = bpe.coder(PATH)
    for start in range(0, 0x3100):
        text = f"a{chr(start)}1 {chr(start)}{chr(start)} b"
        assert use.encode(text)[0].tolist() == Tokenizer_ids(text), hex(start)


def test_memos_that_overflow_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 3)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 5)
    use = bpe.Coder(PATH)
    for text in ["some words that are met again, some words", "unheardofwords inbetweenthem some"] * 3:
        assert use.encode(text)[0].tolist() == Tokenizer_ids(text)


def test_all_kinds_of_rows(spark, library):
    got = bpe.encode_decode(documents(spark), PATH, ["doc_id", "score", "node"], OUTPUTS).collect()
    assert len(got) == len(TEXTS)
    want = []
    for doc, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc, 0.5, "n", len(ids), ids, digest(",".join(map(str, ids))), decoded, digest(decoded)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_workers_keep_no_texts_beyond_a_task(spark):
    def held(batches):
        use = bpe.coder(PATH)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(use.memo) + len(use.memo.older) + len(use.pairs)] * batch.num_rows, pa.int64())], ["n"])

    assert len(bpe.encode_decode(documents(spark), PATH, ["doc_id"], OUTPUTS).collect()) > 0
    assert {r["n"] for r in spark.range(16, numPartitions=8).mapInArrow(held, "n bigint").collect()} == {0}


def test_empty_table(spark):
    assert bpe.encode_decode(no_documents(spark), PATH, ["doc_id"], OUTPUTS).collect() == []
