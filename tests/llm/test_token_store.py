import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from jobmart.llm.token_store import read_store, write_store
from jobmart.llm.tokens import Encoder
from jobmart.llm.vocabularies import PACKING_ENCODING, STORE_ENCODING
from jobmart.session import work_dir


def plain(encoding, text):
    t = Tokenizer.from_file(encoding.path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [encoding.end_id]


@pytest.mark.parametrize("encoding", [STORE_ENCODING, PACKING_ENCODING])
def test_pieces_give_the_ids_of_the_whole_text(encoding):
    import random

    rng = random.Random(3)
    parts = list("aZ1!é'|_\x00") + ["\t", "\n", "\x0b", "\r", " ", "  ", "\x85", "\xa0", "　", " ", "\x1c", "​",
                                       "'s", "<|endoftext|>", "́", "Σ", "İ", "漢", "😀", "the "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 10))) for _ in range(4000)] + [None, ""]
    encode, t = Encoder(encoding), Tokenizer.from_file(encoding.path)
    t.encode_special_tokens = True
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text or "", add_special_tokens=False).ids + [encoding.end_id]


def test_case_and_punctuation_make_no_pieces_of_their_own():
    import random

    encode = Encoder(STORE_ENCODING)
    encode(["Word word WORD word, Word. (word) word...", "ÄHRE ähre, Ähre!"])
    assert {"word", "ähre"} <= set(encode.known) and not {"Word", "word,", "Word.", "Ähre!"} & set(encode.known)
    rng = random.Random(5)
    low = [chr(c) for c in range(0x300) if chr(c) != "|"]
    texts = [*low, *("".join(rng.choices(low, k=12)) for _ in range(4000))]
    marks = [*"aEJjßÉ=<.,'!)", "\u030c", "\u0338", "\u0301", "\u0130", "'s", "'S."]
    texts += ["".join(rng.choices(marks, k=6)) for _ in range(4000)]
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain_ids(encode.tokenizer, text), ascii(text)


def plain_ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids + [STORE_ENCODING.end_id]


def test_small_memory_changes_nothing():
    import dataclasses

    texts = [f"word{i} other{i % 7}" for i in range(300)]
    small = Encoder(dataclasses.replace(STORE_ENCODING, remembered=10))
    assert [small([t])[0] for t in texts] == Encoder(STORE_ENCODING)(texts)


def test_round_trip(spark, odd_docs, clashing_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = sorted(
        ((i is not None, i or 0, len(ids), np.array(ids, "<u4").tobytes()) for i, t in rows for ids in [plain(STORE_ENCODING, t)]),
    )
    for docs in (odd_docs, clashing_docs):
        path = work_dir(spark, "test-store")
        write_store(docs, path, STORE_ENCODING)
        got = read_store(spark, path).orderBy("start").collect()
        assert [bytes(r.ids) for r in got if r.doc_id not in (None, 8)] == [b for has, i, _, b in want if has and i != 8]
        assert sorted(bytes(r.ids) for r in got) == sorted(b for *_, b in want)
        at = 0
        for r in got:
            assert r.start == at and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
            at += r.n_tokens
        ids = [r.doc_id for r in got if r.doc_id is not None]
        assert ids == sorted(ids) and got[0].doc_id is None


def test_single_documents(spark, odd_docs):
    path = work_dir(spark, "test-store")
    write_store(odd_docs, path, STORE_ENCODING)
    whole = {r.doc_id: r for r in read_store(spark, path).collect()}
    some = read_store(spark, path, only=[1, 10, 999]).collect()
    assert {r.doc_id: r for r in some} == {k: whole[k] for k in (1, 10)}


def test_damaged_dictionary(spark, odd_docs):
    path, other = work_dir(spark, "test-store"), work_dir(spark, "test-store")
    write_store(odd_docs, path, STORE_ENCODING)
    spark.read.parquet(f"{path}/blocks").write.parquet(f"{other}/blocks")
    spark.read.parquet(f"{path}/dictionary").selectExpr("CAST('zz' AS BINARY) AS content", "sha256", "width") \
        .write.parquet(f"{other}/dictionary")
    with pytest.raises(ValueError, match="damaged"):
        read_store(spark, other)


def test_no_rows(spark, no_docs):
    path = work_dir(spark, "test-store")
    write_store(no_docs, path, STORE_ENCODING)
    assert read_store(spark, path).count() == 0
