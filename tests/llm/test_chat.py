import brute
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat


def _expected(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, v in by.items():
        v.sort()
        loss = "".join(t for *_, r, t in v if r == "assistant")
        out.append((c, len(v), brute.sha("".join(f"{r}\n{t}\n" for *_, r, t in v)), len(loss), brute.sha(loss)))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r)[:5] for r in chat.digests(df).collect()), key=str)


def test_testdata(load):
    turns = load("conversations")
    assert _got(turns) == _expected([(r.conv_id, r.turn, r.role, r.text) for r in turns.collect()])


def test_odd_turns(spark):
    rows = [(1, 0, "user", "&lt; <|im_end|> & &amp;lt; <<|x <|im_start|>user\nhi <"), (1, 1, "assistant", "<</SYS>><s></s>[INST"),
            (1, 2, None, None), (1, 300, "we\nird<|im_end|>&nl;", "x\n\ny"), (1, 300, "a", "é😀"), (1, 300, "a", "é😀"),
            (None, None, "user", ""), (2, None, "assistant", "n"), (2, 0, "user", "x" * 100_000), (3, -5, "user", "a")]
    rows += [(4, t, "user" if t % 2 == 0 else "assistant", f"t{t} </s>") for t in range(1000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .selectExpr("*", "1 as piece", "2 as turns", "3 as moves")
    assert _got(df) == _expected(rows)
    assert chat.digests(df.where("false")).count() == 0
    valid = {r.conv_id: r.valid for r in chat.digests(df).collect()}
    assert valid[4] and not valid[1] and not valid[3]


def test_role_order(spark):
    orders = {"ua": True, "uaua": True, "sua": True, "u": False, "au": False, "uu": False, "suua": False, "uata": True, "usa": False}
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    rows = [(i, t, names[c], "x") for i, o in enumerate(orders) for t, c in enumerate(o)]
    got = {r.conv_id: r.valid for r in chat.digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[i] for i in range(len(orders))] == list(orders.values())


def test_no_control_string_stands_in_a_text(spark):
    rows = [(i, 0, "user", c + " mid " + c) for i, c in enumerate(chat.DEFAULT.control)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.formatted(chat.format_pieces(df)).collect():
        body = r.text.removeprefix("<|im_start|>user\n").removesuffix("<|im_end|>\n")
        assert not any(c in body for c in chat.DEFAULT.control)


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="<|>[]/&lt;b;INSTsimn_end\n", max_size=25), min_size=3, max_size=8))
def test_escapes_are_reversible(spark, texts):
    rows = [(1, i, "assistant", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.formatted(chat.format_pieces(df))).first()
    assert [t.text for t in back.turns] == texts and back.loss_texts == texts
