"""Encoder against the tokenizers library, exact round trips, edge cases."""
import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from regmine.llm import bpe
from regmine.llm.common import tokenizer_path
from regmine.llm.queries import op1_bpe_codec

EDGES = [None, "", " ", "  ", " a  b\n c \n\n d", "a   b", "\n", "foo\n bar", "foo\n\n bar", "<|endoftext|>",
         "a<|endoftext|> b <|endoftext|><|endoftext|>", "don't 'stop' I'll", "a" * 5000, "ab" * 3000,
         " " * 3000, "-" * 1000 + "=" * 777, "日本語 中文 😀😀 é à ü", "\t\t x", "x y z",
         "a \x1c b\x1f c", "x\x85 y"]


@pytest.fixture(scope="module")
def both():
    return bpe.load(tokenizer_path()), Tokenizer.from_file(tokenizer_path())


def same(both, text):
    enc, lib = both
    want = lib.encode(text or "", add_special_tokens=False).ids
    got = np.frombuffer(enc.encode(text), dtype="<u4")
    assert got.tolist() == want
    assert enc.decode(got) == lib.decode(want, skip_special_tokens=False) == (text or "")


@pytest.mark.parametrize("text", EDGES)
def test_edges(both, text):
    same(both, text)


def test_random_texts(both):
    r = random.Random(7)
    parts = ["a", "b", "th", "e", "t", " ", "  ", "\n", "1", "22", "'s", "é", "日", "😀", ".", "\t", "ing"]
    for _ in range(4000):
        same(both, "".join(r.choice(parts) for _ in range(r.randint(1, 30))))


def test_every_letter_is_cut_as_the_library_does(both):
    import unicodedata
    enc, lib = both
    for cp in range(0, 0x30000, 3):
        c = chr(cp)
        if unicodedata.category(c) in ("Cn", "Cs"):
            continue
        same(both, f"a{c}b {c}1 .{c}.")


def test_query_matches_library(spark, sf, both):
    _, lib = both
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(back.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op1_bpe_codec(spark, sf).collect()}
    assert got == want


def test_table_edges_and_decode(spark, make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(EDGES)] + [(None, "x y"), (0, None)])
    out = bpe.encode_documents(docs, tokenizer_path(), with_ids=True)
    assert out.count() == len(EDGES) + 2
    back = {r.doc_id: r.text for r in bpe.decode_documents(out, tokenizer_path()).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(EDGES))
    assert bpe.encode_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_library_encoder_gives_the_same_ids(both, monkeypatch):
    enc, _ = both
    for limit in (bpe.LONG_TEXT, 3):
        monkeypatch.setattr(bpe, "LONG_TEXT", limit)
        ids = bpe.library_encoder(tokenizer_path())
        for text in EDGES:
            assert ids(text or "").tolist() == np.frombuffer(enc.encode(text), dtype="<u4").tolist()
