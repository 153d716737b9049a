"""Mixing sources to target weights, with DataFrame functions alone.

A token budget is handed down a tree (domain, language, source) in proportion
to weights. A node never gets more than its subtree holds, so what a leaf
cannot use goes to its siblings first and to its ancestors' siblings only when
these are full. Each leaf then gives whole epochs in seeded order and a token
prefix of the last.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import query, stage, table

_WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Plan:
    """``levels``: names of the tree's levels, root first. ``weights``: per
    level, integer weight of a node's name (1 if not listed; 0 takes nothing).
    ``budget_percent``: the token budget as a share of all tokens, in percent."""
    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: dict = field(default_factory=dict)
    budget_percent: int = 100
    max_epochs: int = 2
    seed: int = 17
    #: Documents a bucket of a leaf's seeded order holds, about.
    bucket_docs: int = 250


def token_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(plan: Plan, level: str) -> Column:
    out = F.lit(1)
    for name, w in sorted(plan.weights.get(level, {}).items()):
        out = F.when(F.col(level) == name, F.lit(int(w))).otherwise(out)
    return out


def _share_out(nodes: DataFrame, plan: Plan, level: str, above: list[str]) -> DataFrame:
    """``nodes`` (path, level, cap, given to the parent) with ``given``: filled
    in the order of cap per weight, a child is full while what is left would
    give it more than it holds; the others share the rest by weight."""
    w = nodes.withColumn("w", _weight(plan, level))
    w = w.withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(0))
    order = Window.partitionBy(*above).orderBy(F.col("cap") / F.greatest("w", F.lit(1)), level)
    w = w.withColumn("used", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("left_w", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    full = F.col("cap").cast(_WIDE) * F.col("left_w") <= (F.col("parent") - F.col("used")).cast(_WIDE) * F.col("w")
    w = w.withColumn("full", full)
    group = Window.partitionBy(*above)
    w = w.withColumn("rest", F.col("parent") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group)) \
        .withColumn("rest_w", F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0)).over(group))
    part = F.expr("cast((cast(rest as decimal(38,0)) * w) div greatest(rest_w, 1) as bigint)")
    return w.withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(part))


def budgets(leaves: DataFrame, plan: Plan) -> DataFrame:
    """``leaves`` (levels, supply, docs: one row a leaf) with ``given`` tokens.
    A leaf that has a weight of 0 on its way holds nothing for its ancestors
    either, so no tokens are handed where they cannot be used."""
    levels = list(plan.levels)
    open_way = reduce(Column.__and__, [_weight(plan, level) > 0 for level in levels])
    out = leaves.withColumn("cap", F.when(open_way, F.col("supply") * plan.max_epochs).otherwise(0))
    # The whole budget, as a one-row group of the root.
    out = out.withColumn("given", F.expr(
        f"cast((cast(sum(supply) over (partition by 1) as decimal(38,0)) * {int(plan.budget_percent)}) div 100 as bigint)"))
    for i, level in enumerate(levels):
        path, above = levels[:i + 1], levels[:i]
        nodes = out.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first("given").alias("parent"))
        if not above:
            nodes, above = nodes.withColumn("_root", F.lit(0)), ["_root"]
        got = _share_out(nodes, plan, level, above).select(*path, "given")
        out = out.drop("given").join(got, path)
    return out.drop("cap")


def mix(docs: DataFrame, plan: Plan, level_cols: dict[str, Column] | None = None) -> DataFrame:
    """``docs`` (doc_id, text and whatever the levels read), each row as often
    as it is drawn, with further columns ``_leaf`` (struct of the levels),
    ``_epoch`` and ``_tokens``.

    Leaves hold their documents in the order of md5(seed, epoch, doc_id,
    md5(text)). A leaf given g tokens of its s gives g div s whole epochs and,
    of the next, the documents before which fewer than g mod s tokens stand:
    whole documents, at most one past the budget. Null levels are named ''. A
    leaf without tokens gives nothing. Null text holds no tokens, repeated
    rows are drawn each, an empty table gives no rows; columns keep their
    names and values.
    """
    levels = list(plan.levels)
    cols = level_cols or {}
    leaf = [F.coalesce(cols.get(c, F.col(c)).cast("string"), F.lit("")).alias(c) for c in levels]
    ident = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    # The given columns travel as one struct: no name of theirs can clash.
    rows = docs.select(F.struct("*").alias("_row"), F.struct(*leaf).alias("_leaf"),
                       token_count(F.col("text")).alias("_tokens"), ident.alias("_ident"))
    narrow = stage(rows.drop("_row"), "mix-rows")
    leaves = narrow.groupBy("_leaf").agg(F.sum("_tokens").alias("supply"), F.count(F.lit(1)).alias("docs")) \
        .select("_leaf.*", "supply", "docs")
    given = budgets(leaves, plan).where("supply > 0 and given > 0").select(
        F.struct(*levels).alias("leaf"), F.expr("cast(given div supply as int)").alias("full"),
        (F.col("given") % F.col("supply")).alias("rest"),
        F.least(F.lit(1 << 20), F.ceil(F.col("docs") / plan.bucket_docs)).cast("long").alias("buckets"))
    given = stage(given, "mix-leaves")

    def ordered(df: DataFrame, leaves: DataFrame) -> DataFrame:
        key = F.md5(F.concat_ws("|", F.lit(str(plan.seed)), (F.col("full") + 1).cast("string"), "_ident").cast("binary"))
        spot = F.conv(F.substring("_key", 1, 5), 16, 10).cast("long")
        return df.join(leaves, F.col("_leaf") == F.col("leaf")).withColumn("_key", key) \
            .withColumn("_bucket", F.floor(spot * F.col("buckets") / (1 << 20)))

    per = ordered(narrow, given.where("rest > 0")).groupBy("leaf", "rest", "_bucket") \
        .agg(F.sum("_tokens").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy("leaf").orderBy("_bucket")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = per.withColumn("base", before).where("base < rest") \
        .groupBy("leaf").agg(F.max(F.struct("_bucket", "base")).alias("edge"))
    plan_rows = stage(given.join(edge.withColumnRenamed("leaf", "l"), F.col("leaf") == F.col("l"), "left").drop("l"), "mix-edges")

    drawn = ordered(rows, plan_rows)
    epochs = F.concat(F.when(F.col("full") > 0, F.sequence(F.lit(1), F.col("full"))).otherwise(F.expr("cast(array() as array<int>)")),
                      F.when(F.col("_bucket") < F.col("edge._bucket"), F.array(F.col("full") + 1))
                      .otherwise(F.expr("cast(array() as array<int>)")))
    whole = drawn.select("_row.*", "_leaf", F.explode(epochs).alias("_epoch"), "_tokens")
    at_edge = drawn.where(F.col("_bucket") == F.col("edge._bucket"))
    inside = F.coalesce(F.sum("_tokens").over(Window.partitionBy("_leaf").orderBy("_key")
                                              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = at_edge.withColumn("_before", F.col("edge.base") + inside).where("_before < rest") \
        .select("_row.*", "_leaf", (F.col("full") + 1).alias("_epoch"), "_tokens")
    return whole.unionByName(last)


#: The query's mixture: four domains by the number in a source's name.
MIX = Plan(weights={"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}})


def domain_of(source: Column) -> Column:
    """d0 to d3: the last digits of the source's name modulo 4 (0 without)."""
    number = F.coalesce(F.expr("try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') as bigint)"), F.lit(0))
    return F.concat(F.lit("d"), (number % 4).cast("string"))


def mix_documents(docs: DataFrame, plan: Plan = MIX) -> DataFrame:
    return mix(docs, plan, {"domain": domain_of(F.col("source"))})


def _sql(plan: Plan) -> str:
    """The same mixture in DuckDB SQL, one window over each whole leaf."""
    def weight(level: str) -> str:
        cases = " ".join(f"when {level} = '{n}' then {w}" for n, w in plan.weights.get(level, {}).items())
        return f"case {cases} else 1 end" if cases else "1"
    open_way = " and ".join(f"{weight(level)} > 0" for level in plan.levels)
    parts = [r"""rows0 as (select doc_id, 'd' || cast(coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') as bigint), 0) % 4 as varchar) as domain,
  coalesce(lang, '') as lang, coalesce(source, '') as source,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as n_tokens,
  concat_ws('|', coalesce(cast(doc_id as varchar), ''), md5(coalesce(text, ''))) as ident from documents)""",
             f"""leaves as (select domain, lang, source, sum(n_tokens)::hugeint as supply,
  case when {open_way} then sum(n_tokens)::hugeint * {plan.max_epochs} else 0 end as cap0 from rows0 group by domain, lang, source)""",
             f"g0 as (select *, (sum(supply) over ()) * {plan.budget_percent} // 100 as given from leaves)"]
    for i, level in enumerate(plan.levels):
        path, above = ", ".join(plan.levels[:i + 1]), ", ".join(plan.levels[:i]) or "1"
        parts += [f"""n{i} as (select {path}, {weight(level)} as w, sum(cap0) as cap, any_value(given) as parent from g{i} group by {path})""",
                  f"""o{i} as (select *, coalesce(sum(cap) over (partition by {above} order by cap / greatest(w, 1), {level} rows between unbounded preceding and 1 preceding), 0) as used,
  sum(w) over (partition by {above} order by cap / greatest(w, 1), {level} rows between current row and unbounded following) as left_w from n{i})""",
                  f"f{i} as (select *, cap * left_w <= (parent - used) * w as full_ from o{i})",
                  f"""r{i} as (select *, parent - sum(case when full_ then cap else 0 end) over (partition by {above}) as rest,
  sum(case when full_ then 0 else w end) over (partition by {above}) as rest_w from f{i})""",
                  f"""g{i + 1} as (select g.* exclude (given), case when full_ then cap else rest * w // greatest(rest_w, 1) end as given
  from g{i} g join r{i} using ({path}))"""]
    parts += [f"""p as (select r.*, given // supply as full_n, given % supply as rest from rows0 r join g{len(plan.levels)} using (domain, lang, source)
  where supply > 0 and given > 0)""",
              f"""k as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source
  order by md5(concat_ws('|', '{plan.seed}', cast(full_n + 1 as varchar), ident)) rows between unbounded preceding and 1 preceding), 0) as before_ from p)"""]
    return "with " + ",\n".join(parts) + """
select doc_id, domain, lang, source, cast(epoch as int) as epoch, cast(n_tokens as bigint) as n_tokens
from (select *, unnest(range(1, cast(full_n as bigint) + 1)) as epoch from k
      union all select *, full_n + 1 from k where before_ < rest)"""


@query("op3_weighted_mixture", _sql(MIX))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "_leaf.domain", "_leaf.lang", "_leaf.source", F.col("_epoch").alias("epoch"), F.col("_tokens").alias("n_tokens"))
