import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import tokens as T


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(T.default_tokenizer())


def _expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [T.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_testdata_round_trip(load, tokenizer):
    docs = load("documents")
    got = T.token_output(docs, T.default_tokenizer()).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    assert [tuple(r) for r in got] == _expected(tokenizer, rows)


def test_odd_rows(odd_docs, no_docs, tokenizer):
    got = T.token_output(odd_docs, T.default_tokenizer()).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [tuple(r) for r in got] == _expected(tokenizer, rows)
    assert T.token_output(no_docs, T.default_tokenizer()).count() == 0


def test_files_and_lookup(spark, load, tmp_dir, tokenizer):
    docs, path = load("documents"), tmp_dir + "/tokens"
    T.write_tokens(docs, path, T.default_tokenizer())
    want = docs.where("doc_id = 17").first().text
    assert T.lookup(spark, path, [17]).first().ids == tokenizer.encode(want, add_special_tokens=False).ids + [T.END_ID]
    import glob

    from pyarrow import orc
    last = -1
    for f in sorted(glob.glob(path + "/part-*.orc")):  # one ascending range of ids a file
        ids = orc.ORCFile(f).read(columns=["doc_id"]).column("doc_id").to_pylist()
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_word_by_word_is_the_tokenizers_answer(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.default_tokenizer())
    ids, n = T._encoder(T.default_tokenizer()).encode(pa.array(texts))
    want = [tok.encode(t, add_special_tokens=False).ids + [T.END_ID] for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 3)
    enc = T._Encoder(T.default_tokenizer())
    for text in ("alpha beta", "gamma delta", "alpha gamma", "a b c d e f"):
        ids, _ = enc.encode(pa.array([text]))
        assert ids[:-1].tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Plain sentence, with marks. It's here!", "", None, "  two\n lines ", "CASE case"]
    enc = T._Encoder(path)
    assert not enc.by_word and T._Encoder(T.default_tokenizer()).by_word
    ids, sizes = enc.encode(pa.array(texts, pa.large_string()))
    plain = Tokenizer.from_file(path)
    want = [[*plain.encode(t or "", add_special_tokens=False).ids, T.END_ID] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


def test_ascii_words_are_learnt_from_their_ids_alone():
    enc = T._Encoder(T.default_tokenizer())
    slow = enc.tokenizer

    class Fast:
        def __getattr__(self, name):
            assert name != "encode"
            return getattr(slow, name)
    enc.tokenizer = Fast()
    texts = ["Hello world a b c, the The THE", "x", "", None, "internationalization zzzzqqqq (jkjkjk) w.", "q" * 300]
    ids, size = enc.encode(pa.array(texts, pa.large_string()))
    want = [[*slow.encode(t or "", add_special_tokens=False).ids, T.END_ID] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and size.tolist() == [len(w) for w in want]
