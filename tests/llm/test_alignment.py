import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import alignment, queries

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
_COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers over whole texts, token by token: (id, bytes) lists."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    # Characters of the byte-level vocabulary, read off the tokenizer's own alphabet.
    from tokenizers.pre_tokenizers import ByteLevel
    assert len(ByteLevel.alphabet()) == 256
    to_byte = {}
    for byte in range(256):
        text = bytes([byte]).decode("latin-1")
        pieces = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(text)[0][0]
        for c, raw in zip(pieces, text.encode()):
            to_byte[c] = raw
    for c in set(ByteLevel.alphabet()) - set(to_byte):  # bytes that begin longer characters
        to_byte[c] = None

    def tokens(text):
        one = [(i, bytes(to_byte.get(c) if to_byte.get(c) is not None else _lead(c) for c in a.id_to_token(i)))
               for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
               for i in b.encode(text)]
        return one, two
    return tokens


def _lead(c):
    """Bytes 0xC4.. to 0xFF stand for themselves in that vocabulary."""
    assert 0xA1 <= ord(c) <= 0xFF
    return ord(c)


def brute(texts, tokens):
    docs, holders = [], defaultdict(set)
    for k, text in enumerate(texts):
        one, two = tokens(text) if text else ([], [])
        raw = (" " + text).encode() if text else b""
        if b"".join(x for _, x in one) != raw or b"".join(x for _, x in two) != raw:
            one, two = [], []
        groups, i, j = [], 0, 0
        while i < len(one):
            ia, ib, at, bt = [one[i][0]], [two[j][0]], len(one[i][1]), len(two[j][1])
            i, j = i + 1, j + 1
            while at != bt:
                if at < bt:
                    ia.append(one[i][0])
                    at += len(one[i][1])
                    i += 1
                else:
                    ib.append(two[j][0])
                    bt += len(two[j][1])
                    j += 1
            groups.append((ia, ib))
        found = Counter((x, y) for ia, ib in groups for x in ia for y in ib)
        for p in found:
            holders[p].add(k)
        docs.append((len(one), len(two), groups, found))
    best = defaultdict(int)
    for (x, _), who in holders.items():
        best[x] = max(best[x], len(who))
    for n_a, n_b, groups, found in docs:
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield (n_a, n_b, len(groups), sum(found.values()), sum(n for p, n in found.items() if len(holders[p]) == best[p[0]]),
               sum(n * len(holders[p]) for p, n in found.items()), hashlib.sha256(written.encode()).hexdigest() if n_a else "")


def _query(spark, docs, monkeypatch):
    monkeypatch.setattr(alignment, "table", lambda *a: docs)
    return sorted(map(tuple, alignment.op12(spark, "").select(*_COLUMNS).collect()), key=str)


def _want(rows, plain):
    return sorted(((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows], plain))), key=str)


ODD_TEXTS = ["", None, " ", "a ", "  two  spaces ", "\n\n x\n  y\t z ", "<|endoftext|> </s> <0x41>", "▁ taken for a space",
             "ﬁ ligature \xa0 nbsp 　 wide", "日本語のテキスト 😀😀 🇫🇷", "\x00 nul \x7f", "aaaa" * 500, "=-" * 700, "1234567890" * 40,
             "it's they'll WE'RE", "é combining", "tab\tend ", "\r\n"]


def test_odd_texts_match_brute_force(spark, plain, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS * 2)], "doc_id long, text string")
    assert _query(spark, docs, monkeypatch) == _want(docs.collect(), plain)


def test_blocks_parts_and_large_groups(spark, plain, monkeypatch):
    # Small limits: several blocks, words and texts in parts, groups by distinct ids.
    for name in ("LINKS_AT_ONCE", "PART_BYTES", "WORD_BYTES"):
        monkeypatch.setattr(alignment, name, 64)
    texts = [t for t in ODD_TEXTS if t] + ["some words that are cut in parts, it's so " * 5] * 3
    a, b = alignment._tokenizers(A, B)
    held = alignment._Block()
    held.add(alignment.pa.array(range(len(texts))), texts, True)
    *docs, own = [r for batch in held.rows(0, a, b) for r in batch.to_pylist()]
    want = list(brute(texts, plain))
    assert [(d["n_a"], d["n_b"], d["n_groups"], d["n_links"], sum(d["times"])) for d in docs] == [(*w[:4], w[3]) for w in want]
    for d, w in zip(docs, want):
        assert len(set(d["at"])) == len(d["at"])
        assert (hashlib.sha256(d["groups"].encode()).hexdigest() if d["n_a"] else "") == w[6]
    assert own["pairs"] == sorted(own["pairs"])
    assert own["docs"] == [sum(i in d["at"] for d in docs) for i in range(len(own["pairs"]))]


def test_whole_table_and_odd_documents(spark, load, plain, odd_docs, no_docs, monkeypatch):
    rows = load("documents").collect()
    got = queries.REGISTRY["op12_token_alignment"](spark, "/root/testdata/sf0.001").select(*_COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == _want(rows, plain)
    assert _query(spark, odd_docs, monkeypatch) == _want(odd_docs.collect(), plain)
    assert _query(spark, no_docs, monkeypatch) == []


def test_words_encode_like_whole_texts(monkeypatch):
    a, b = alignment._tokenizers(A, B)
    assert a.splits and b.splits
    monkeypatch.setattr(alignment, "PART_BYTES", 3)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list("ab'sZ1, .\n\t\xa0é日▁<|>")), min_size=1, max_size=40))
    def check(text):
        words = [w for part in alignment.words_of(text) for w in part]
        assert " ".join(words) == text
        for t in (a, b):
            ids, counts = alignment._encode(t, words)
            assert ids.tolist() == t.encode([" " + text])[0] and len(counts) == len(words)
    check()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=30), st.randoms())
def test_groups_break_where_both_end(sizes, rng):
    total, other = sum(sizes), []
    while sum(other) < total:
        other.append(min(rng.randint(1, 6), total - sum(other)))
    ga, gb = alignment.coalesce(np.array(sizes), np.array(other))
    ends = set(np.cumsum(sizes)) & set(np.cumsum(other))
    for ids, own in ((ga, sizes), (gb, other)):
        assert ids.tolist() == [sum(e < c for e in ends) for c in np.cumsum(own)]
