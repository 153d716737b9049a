"""URL filter by path-template trees, with DataFrame functions alone.

Per host, the paths form a tree of segments, walked level by level until no two
paths share a node. Segments that vary (many siblings, none of them far above an
even share) become a wildcard, unless their labels set them apart; other branches
are merged where their shapes agree and a two-proportion test cannot tell their
labels apart. A template is rejected when the smoothed share of bad urls among
its labelled ones is high.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import query, stage, table


@dataclass(frozen=True)
class Settings:
    #: A segment varies if it has at least so many siblings (itself included)
    #: and holds at most ``even`` times an even share of their urls.
    min_siblings: int = 8
    even: int = 2
    #: Shares within this many standard errors of each other are alike.
    z: float = 1.96
    #: Smoothed bad shares of labelled branches are sorted into so many bins
    #: before neighbours are compared; a node's comparison never exceeds them.
    bins: int = 10
    #: Purity = (bad + prior_bad) / (labelled + prior_bad + prior_good);
    #: templates reaching ``reject`` are blocked.
    prior_bad: float = 1.0
    prior_good: float = 3.0
    reject: float = 0.7


DEFAULT = Settings()
WILD, MERGED = "*", "~"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased;
    empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    raw = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_column(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule (``host/path`` prefix, verdict) that fits, as a struct
    of rule and verdict, or null. A rule fits its host and all subdomains."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, prefix = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + prefix))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


_TAIL = r"(\.[A-Za-z][A-Za-z0-9]{0,4})\z"


def shape(segment: Column) -> Column:
    """Segments that are plainly values: numbers, dates, hashes and UUIDs,
    each with or without a file's extension, which is kept."""
    tail = F.regexp_extract(segment, _TAIL, 1)
    stem = F.substr(segment, F.lit(1), F.length(segment) - F.length(tail))
    return F.when(stem.rlike(r"^[0-9]+\z"), F.concat(F.lit("{number}"), tail)) \
        .when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?\z"), F.concat(F.lit("{date}"), tail)) \
        .when(stem.rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"), F.concat(F.lit("{uuid}"), tail)) \
        .when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F]{16,}\z"), F.concat(F.lit("{hash}"), tail)).otherwise(segment)


def segments(path: Column) -> Column:
    """Shaped segments of a path. Segments that begin like a wildcard, a merged
    branch or a shape (``* ~ { %``) are kept apart from these by a ``%``."""
    raw = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(raw, lambda s: shape(F.when(s.rlike(r"^[*~{%]"), F.concat(F.lit("%"), s)).otherwise(s)))


def kind(segment: Column) -> Column:
    """How a segment is written: f a file, w a word, d with digits, o other."""
    return F.when(segment.rlike(_TAIL), "f").when(segment.rlike(r"^[A-Za-z]+\z"), "w") \
        .when(segment.rlike("[0-9]"), "d").otherwise("o")


def _differs(hits1: Column, of1: Column, hits2: Column, of2: Column, z: float) -> Column:
    """Two-proportion test with one success and one failure added on either
    side (Agresti and Caffo), so that few labels are no proof."""
    n1, n2 = of1 + 2, of2 + 2
    p1, p2 = (hits1 + 1) / n1, (hits2 + 1) / n2
    return F.abs(p1 - p2) > z * F.sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2)


def _fates(branch: DataFrame, s: Settings) -> DataFrame:
    """``branch`` (p, seg: one row a branch; n, lab, bad, ends, paths) with
    ``named``: the branch's name in its templates.

    Varying siblings are held against their pool's labels, the others sorted by
    shape (kind; all, some or none of its urls end there) and bin of smoothed
    bad share: neighbouring bins of a shape that the test cannot tell apart are
    one cluster. Two or more labelled branches of a cluster are merged, and with
    them the unlabelled ones of the shape, if all its labelled ones agree. One
    labelled branch alone says nothing of its siblings."""
    c = F.col
    total = branch.groupBy(c("p").alias("tp")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("pn"))
    known = branch.join(total, c("p") == c("tp")).withColumn(
        "var", (c("k") >= s.min_siblings) & (c("n") * c("k") <= s.even * c("pn")))
    pool = known.where("var").groupBy(c("p").alias("vp")).agg(F.sum("lab").alias("vlab"), F.sum("bad").alias("vbad"))
    known = known.join(pool, c("p") == c("vp"), "left").withColumn(
        "wild", c("var") & ~_differs(c("bad"), c("lab"), c("vbad") - c("bad"), c("vlab") - c("lab"), s.z))
    known = known.withColumns({
        "kind": kind(c("seg")), "form": F.when(c("ends") == 0, 0).when(c("ends") == c("n"), 2).otherwise(1),
        "bin": F.when(c("lab") == 0, -1).otherwise(F.expr(f"cast(({s.bins} * (bad + 1)) div (lab + 2) as int)"))})
    cell = known.where(~c("wild") & (c("lab") > 0)).groupBy(
        c("p").alias("cp"), c("kind").alias("ck"), c("form").alias("cf"), c("bin").alias("cb")).agg(
        F.count(F.lit(1)).alias("of"), F.sum("lab").alias("clab"), F.sum("bad").alias("cbad"))
    alike = Window.partitionBy("cp", "ck", "cf")  # at most ``bins`` rows
    near = alike.orderBy("cb")
    cell = cell.withColumn("cut", F.coalesce(_differs(
        c("cbad"), c("clab"), F.lag("cbad").over(near), F.lag("clab").over(near), s.z), F.lit(False)).cast("int"))
    cell = cell.withColumn("cluster", F.sum("cut").over(near))
    own = Window.partitionBy("cp", "ck", "cf", "cluster")
    cell = cell.withColumns({"of": F.sum("of").over(own), "low": F.min("cb").over(own), "last": F.max("cluster").over(alike)}) \
        .where("of > 1").withColumn("as", F.concat(F.lit(MERGED), c("ck"), c("cf").cast("string"), c("low").cast("string")))
    agreed = cell.where("last = 0").groupBy("cp", "ck", "cf").agg(F.min("as").alias("as")).withColumn("cb", F.lit(-1))
    names = cell.select("cp", "ck", "cf", "cb", "as").unionByName(agreed)
    same = (c("p") == c("cp")) & (c("kind") == c("ck")) & (c("form") == c("cf")) & (c("bin") == c("cb"))
    return known.join(names, same, "left").withColumn(
        "named", F.when(c("wild"), WILD).otherwise(F.coalesce("as", "seg"))) \
        .select("p", "seg", "paths", "named")


def templates(urls: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """``urls`` (host, segs, n, lab, bad: distinct paths with counts of urls,
    labelled and bad ones) with the column ``template`` (an array).

    One round per level. Counts are summed per branch before they are summed
    per parent, and no group of branches is ever collected. Paths that end, or
    that are alone in their branch, leave; so there are as many rounds as the
    deepest node that two paths share has segments."""
    live = urls.withColumn("template", F.expr("cast(array() as array<string>)"))
    done = [live.where(F.size("segs") == 0)]
    live, level = live.where(F.size("segs") > 0), 0
    while level == 0 or not live.isEmpty():
        level += 1
        at = live.withColumns({"parent": F.concat_ws("/", "host", "template"), "at": F.get("segs", F.lit(level - 1))})
        branch = at.groupBy(F.col("parent").alias("p"), F.col("at").alias("seg")).agg(
            F.sum("n").alias("n"), F.sum("lab").alias("lab"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("paths"),
            F.sum(F.when(F.size("segs") == level, F.col("n")).otherwise(0)).alias("ends"))
        alone = (F.col("paths") == 1) & (F.col("named") == F.col("seg"))
        ends = F.size("segs") == level
        step = at.join(_fates(branch, s), (F.col("parent") == F.col("p")) & (F.col("at") == F.col("seg"))).select(
            *urls.columns, F.when(alone, F.concat("template", F.slice("segs", F.lit(level), F.size("segs"))))
            .otherwise(F.concat("template", F.array("named"))).alias("template"), (~ends & ~alone).alias("live"))
        step = stage(step, "url-tree")
        done.append(step.where("not live").drop("live"))
        live = step.where("live").drop("live")
    return reduce(DataFrame.unionByName, done)


def judge(pages: DataFrame, rules: list[tuple[str, str]], s: Settings = DEFAULT, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: the id, host, path, rule, verdict
    ("allow" or "block"), template, purity.

    The longest fitting rule decides; the urls it decides are also the labels
    the templates' purity is measured on. A url that no rule fits is blocked
    if its template is rejected. Null urls, or without ``://``: empty host and
    path, allowed unless a rule fits. Repeated rows and ids are judged each;
    further columns are ignored; an empty table gives no rows.
    """
    u = F.col(url_col)
    rows = pages.select(F.col(id_col), host_of(u).alias("host"), path_of(u).alias("path"))
    rows = rows.withColumn("hit", rule_column(rules, F.col("host"), F.col("path")))
    seg = segments(F.col("path"))
    rows = rows.withColumn("key", F.concat_ws("/", F.col("host"), seg))
    bad = F.when(F.col("hit.verdict") == "block", 1).otherwise(0)
    paths = stage(rows.groupBy("key").agg(
        F.first("host").alias("host"), F.first(seg).alias("segs"), F.count(F.lit(1)).alias("n"),
        F.count("hit").alias("lab"), F.sum(bad).alias("bad")), "url-paths")
    tree = templates(paths, s).withColumn("name", F.concat_ws("/", F.col("host"), "template"))
    tree = stage(tree.select("key", "name", "lab", "bad"), "url-templates")
    purity = tree.groupBy(F.col("name").alias("template")).agg(
        ((F.sum("bad") + s.prior_bad) / (F.sum("lab") + s.prior_bad + s.prior_good)).alias("purity"))
    named = tree.select(F.col("key").alias("k"), "name").join(purity, F.col("name") == F.col("template")) \
        .select("k", "template", "purity")
    return rows.join(named, F.col("key") == F.col("k")).select(
        id_col, "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(F.col("purity") >= s.reject, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")




RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def _sql(rules: list[tuple[str, str]], s: Settings = DEFAULT) -> str:
    """The same verdicts in DuckDB SQL: a recursion over the levels, every path
    to its end."""
    def differs(h1: str, of1: str, h2: str, of2: str) -> str:
        n1, n2 = f"({of1} + 2)", f"({of2} + 2)"
        p1, p2 = f"(({h1} + 1) / {n1})", f"(({h2} + 1) / {n2})"
        return f"(abs({p1} - {p2}) > {s.z} * sqrt({p1} * (1 - {p1}) / {n1} + {p2} * (1 - {p2}) / {n2}))"
    cases = {"rule": "", "verdict": ""}
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, prefix = rule.partition("/")
        fits = f"when (host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '{slash + prefix}') then"
        cases["rule"] += f" {fits} '{rule}'"
        cases["verdict"] += f" {fits} '{verdict}'"
    tail = r"(\.[A-Za-z][A-Za-z0-9]{0,4})\z"
    stem = f"substr(x, 1, length(x) - length(regexp_extract(x, '{tail}', 1)))"
    end = f"regexp_extract(x, '{tail}', 1)"
    return rf"""with recursive r0 as (select page_id, case when url like '%://%' then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
r1 as (select page_id, regexp_extract(rest, '(?s)^([^/?#]*)', 1) as h, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path from r0),
r2 as (select page_id, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from r1),
r3 as (select *, case{cases['rule']} end as rule, case{cases['verdict']} end as rv,
  list_transform(list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
    lambda x: case when regexp_matches(x, '^[*~{{%]') then '%' || x else x end),
    lambda x: case when regexp_full_match({stem}, '[0-9]+') then '{{number}}' || {end}
      when regexp_full_match({stem}, '[0-9]{{4}}-[0-9]{{2}}(-[0-9]{{2}})?') then '{{date}}' || {end}
      when regexp_full_match({stem}, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}') then '{{uuid}}' || {end}
      when regexp_full_match({stem}, '[0-9a-fA-F]{{16,}}') and regexp_matches({stem}, '[0-9]') then '{{hash}}' || {end} else x end) as segs from r2),
paths as (select host, segs, count(*)::double as n, count(rv)::double as lab, count(*) filter (rv = 'block')::double as bad from r3 group by host, segs),
tree as (
  select host, segs, n, lab, bad, 0 as level, host as name from paths
  union all
  (with x as (select *, segs[level + 1] as seg from tree where level < len(segs)),
  b as (select name as p, seg, sum(n) as n, sum(lab) as lab, sum(bad) as bad, sum(case when len(segs) = level + 1 then n else 0 end) as ends from x group by name, seg),
  v as (select *, count(*) over (partition by p) >= {s.min_siblings} and n * count(*) over (partition by p) <= {s.even} * sum(n) over (partition by p) as var from b),
  y as (select *, sum(lab) over (partition by p, var) as vlab, sum(bad) over (partition by p, var) as vbad from v),
  k as (select *, var and not {differs('bad', 'lab', '(vbad - bad)', '(vlab - lab)')} as wild,
    case when regexp_matches(seg, '{tail}') then 'f' when regexp_matches(seg, '^[A-Za-z]+\z') then 'w' when regexp_matches(seg, '[0-9]') then 'd' else 'o' end as kind,
    case when ends = 0 then 0 when ends = n then 2 else 1 end as form,
    case when lab = 0 then -1 else floor({s.bins} * (bad + 1) / (lab + 2))::int end as bin from y),
  c as (select p, kind, form, bin, count(*) as of_, sum(lab) as lab, sum(bad) as bad from k where not wild and lab > 0 group by p, kind, form, bin),
  l as (select *, lag(bad) over w as pbad, lag(lab) over w as plab from c window w as (partition by p, kind, form order by bin)),
  d as (select *, sum(case when {differs('bad', 'lab', 'pbad', 'plab')} then 1 else 0 end) over (partition by p, kind, form order by bin) as cluster from l),
  e as (select *, sum(of_) over (partition by p, kind, form, cluster) as many, min(bin) over (partition by p, kind, form, cluster) as low,
    max(cluster) over (partition by p, kind, form) as last_ from d),
  m as (select p, kind, form, bin, '{MERGED}' || kind || form || low as as_ from e where many > 1
    union all select distinct p, kind, form, -1, '{MERGED}' || kind || form || low from e where many > 1 and last_ = 0),
  f as (select k.p, k.seg, case when wild then '{WILD}' else coalesce(as_, seg) end as named
    from k left join m on k.p = m.p and k.kind = m.kind and k.form = m.form and k.bin = m.bin)
  select x.host, x.segs, x.n, x.lab, x.bad, x.level + 1, x.name || '/' || f.named from x join f on x.name = f.p and x.seg = f.seg)),
z as (select * from tree where level = len(segs)),
w as (select name, (sum(bad) + {s.prior_bad}) / (sum(lab) + {s.prior_bad} + {s.prior_good}) as purity from z group by name)
select page_id, r3.host, path, rule, coalesce(rv, case when purity >= {s.reject} then 'block' else 'allow' end) as verdict,
       z.name as template, purity from r3 join z on r3.host = z.host and r3.segs = z.segs join w on z.name = w.name"""


@query("op1_url_templates", _sql(RULES))
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), RULES)
