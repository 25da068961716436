import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tixprep.llm.packing import differencing, pack, windows_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, capacity=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return sequences


def test_whole_table_round_trip(spark, tokenizer):
    from tixprep.llm.queries import QUERIES
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    rows = QUERIES["op3_pack"](spark, "/root/testdata/sf0.01").collect()
    sequences = check(rows, dict(zip(t["doc_id"], t["text"], strict=True)), tokenizer)
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len(sequences)) > 0.97


def test_edge_texts(spark, make_docs, tokenizer):
    texts = [None, "", "  \n", "a", "It's THE end now \x1c\x1d x", "<|endoftext|> é ẖ H̱ İ ß",
             "word " * 5000, "\U0001f600" * 3, "x" * 3000]
    rows = pack(make_docs(texts), PATH).collect()
    check(rows, dict(enumerate(texts)), tokenizer)
    assert pack(make_docs(texts).limit(0), PATH).count() == 0
    twice = pack(make_docs([(1, "a b"), (1, "a b")]), PATH).collect()
    assert len(twice) == 2 and sorted(r["offset"] for r in twice)[0] == 0


def test_differencing_is_balanced_and_window_count_rises():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 512, 800)
    window = differencing(sizes, 100)
    sums = np.bincount(window, weights=sizes, minlength=100)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() < 0.05 * sums.mean()
    three = windows_of(np.array([1500, 1500, 1000]), 2048)
    assert len(set(three)) == 3
    assert set(windows_of(np.array([2048]), 2048)) == {0}


def test_special_token_strings_are_encoded_as_the_tokenizer_does(spark, make_docs, tokenizer):
    texts = {0: "before <|endoftext|> after", 1: "<|endoftext|>", 2: "a<|endoftext|>b <|startoftext|>x", 3: "<|endoftext|", 4: "END <|endoftext|> <|endoftext|>"}
    check(pack(make_docs(list(texts.values())), PATH).collect(), texts, tokenizer)
