import hashlib
from collections import defaultdict

import brute
import duckdb

from strata.llm import mixing as X


def _fill(budget, kids):
    """Tokens of each child (name, cap, weight): raise all in proportion until full."""
    out, left, open_ = {}, budget, sorted(kids, key=lambda k: (k[1] / max(k[2], 1), k[0]))
    while open_:
        name, cap, w = open_[0]
        total = sum(k[2] for k in open_)
        if cap * total <= left * w:
            out[name], left, open_ = cap, left - cap, open_[1:]
        else:
            return out | {n: left * k // max(total, 1) for n, _, k in open_}
    return out


def _brute(rows, plan, domain):
    leaves = defaultdict(list)
    for r in rows:
        tokens = len(brute.spaced(r.text))
        ident = f"{'' if r.doc_id is None else r.doc_id}|{hashlib.md5((r.text or '').encode()).hexdigest()}"
        leaves[(domain(r.source), r.lang or "", r.source or "")].append((r.doc_id, tokens, ident))
    supply = {k: sum(t for _, t, _ in v) for k, v in leaves.items()}
    given = {(): sum(supply.values()) * plan.budget_percent // 100}
    weight = lambda d, n: plan.weights.get(plan.levels[d], {}).get(n, 1)
    for depth in range(3):
        for parent, budget in [(k, v) for k, v in given.items() if len(k) == depth]:
            caps = defaultdict(int)
            for k, s in supply.items():
                if k[:depth] == parent:
                    caps[k[depth]] += s * plan.max_epochs * all(weight(d, k[d]) for d in range(3))
            weights = plan.weights.get(plan.levels[depth], {})
            kids = [(n, c if weights.get(n, 1) else 0, weights.get(n, 1)) for n, c in caps.items()]
            given |= {(*parent, n): g for n, g in _fill(budget, kids).items()}
    out = []
    for k, docs in leaves.items():
        if not supply[k]:
            continue
        full, rest = divmod(given[k], supply[k])
        out += [(d, *k, e, t) for d, t, _ in docs for e in range(1, full + 1)]
        at = 0
        key = lambda x: hashlib.md5(f"{plan.seed}|{full + 1}|{x[2]}".encode()).hexdigest()
        for d, t, _ in sorted(docs, key=key):
            if at < rest:
                out.append((d, *k, full + 1, t))
            at += t
    return sorted(out, key=str)


def _got(df, plan):
    cols = X.mix(df, plan, {"domain": X.domain_of(X.F.col("source"))}).select(
        "doc_id", "_leaf.domain", "_leaf.lang", "_leaf.source", "_epoch", "_tokens")
    return sorted((tuple(r) for r in cols.collect()), key=str)


def _domain(source):
    import re
    m = re.search(r"([0-9]{1,9})$", source or "")
    return f"d{int(m[1]) % 4 if m else 0}"


def test_testdata(load):
    docs = load("documents")
    for plan in (X.MIX, X.Plan(weights={"domain": {"d0": 9, "d1": 0}}, budget_percent=130, max_epochs=3, bucket_docs=2)):
        assert _got(docs, plan) == _brute(docs.collect(), plan, _domain)


def test_oracle_sql_is_the_same_mixture(load):
    docs = load("documents")
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(con.execute(X._sql(X.MIX)).fetchall(), key=str) == _got(docs, X.MIX)


def test_odd_rows(odd_docs, no_docs):
    assert _got(odd_docs, X.MIX) == _brute(odd_docs.collect(), X.MIX, _domain)
    assert X.mix_documents(no_docs).count() == 0
    assert set(odd_docs.columns) < set(X.mix_documents(odd_docs).columns)


def test_shortages_go_to_siblings_first(spark):
    """Leaf d0/en/src0 is short; its sibling src4 takes all of it."""
    rows = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate(
        [("src0", 10)] + [("src4", 10)] * 50 + [("src1", 10)] * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = X.Plan(budget_percent=20, max_epochs=1)
    total = defaultdict(int)
    for r in _got(df, plan):
        total[r[3]] += r[5]
    assert total == {"src0": 10, "src4": 150, "src1": 160}


def test_a_weight_of_0_deep_in_the_tree_loses_no_budget(spark, tmp_path):
    """Domain d0 weighs most but holds only a language of weight 0 beside one
    short one: what it cannot use goes to d1."""
    rows = [(i, "w " * 10, lang, s, 0) for i, (lang, s) in enumerate(
        [("de", "src0")] * 40 + [("en", "src0")] * 5 + [("en", "src1")] * 35)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = X.Plan(weights={"domain": {"d0": 9, "d1": 1}, "lang": {"de": 0}}, budget_percent=50, max_epochs=1)
    got = _got(df, plan)
    assert got == _brute(df.collect(), plan, _domain)
    total = defaultdict(int)
    for r in got:
        total[r[1:3]] += r[5]
    assert total == {("d0", "en"): 50, ("d1", "en"): 350}
    df.toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    assert sorted(con.execute(X._sql(plan)).fetchall(), key=str) == got
