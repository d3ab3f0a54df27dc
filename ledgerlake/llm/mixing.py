"""Mixing sources to target weights by temperature (operator 5), DataFrame functions only.

Token shares p of the sources become weights proportional to p ** alpha.
alpha is bisected between 0 (all sources alike) and 1 (shares as they are)
until the weights' entropy meets a target share of the greatest possible
one, or until no source is repeated more than a limit allows; with both, the
larger alpha holds.  Each step evaluates several exponents in one aggregate
over the table of sources, so any number of sources works and only sums
reach the driver.

The weights times a budget of tokens give each source's tokens.  They are
realised by permutations in blocks: a hash of id and text deals a source's rows
to blocks, whose number follows the number of rows, blocks and the rows in each
are ordered by hashes, and a row's position is its block's start plus the
tokens before it in the block.
Every full pass over a source gives each of its rows one copy; the part pass
that is left gives one more to the rows that end within it.  A source that
holds a third of all rows is spread over its blocks, never ordered in one
task.

Without a budget the smallest one is taken that drops no row: the source
with the least weight for its size is used exactly once, the others as often
as their weights say.

Null sources are a source of their own.  Null and empty texts have no tokens
and get the full passes' copies, at least one (they cost nothing).  Very long
texts count whole.  Repeated rows and null ids are rows like any, dealt by their
texts; rows with equal id and text are ordered by a hash of the whole row.
Empty input gives an empty result.  Other columns can have any name but those
that begin with ``_mx`` or ``_ll_``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize


@dataclass(frozen=True)
class Settings:
    entropy: float | None = 0.95      # of the entropy of equal weights, or None
    repeats: float | None = None      # most passes over a source, or None
    budget: int | None = None         # tokens to realise, or None for the least that drops nothing
    blocks: int = 1024                # of a source's permutation, at least
    block_rows: int = 16384           # and one more for each so many rows of the table
    seed: int = 3
    steps: int = 7                    # of bisection, each by 1 / (points + 1)
    points: int = 31


def words_in(text: Column) -> Column:
    """Tokens of a text for mixing: its words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _sources(rows: DataFrame) -> DataFrame:
    """(source, tokens, p): shares among sources that have tokens."""
    sums = materialize(rows.groupBy("_mx_source").agg(
        F.sum("_mx_tokens").alias("_mx_total"), F.count(F.lit(1)).alias("_mx_rows")), "sources")
    total = sums.agg(F.sum("_mx_total")).first()[0] or 0
    return sums.withColumn("_mx_p", F.when(F.col("_mx_total") > 0, F.col("_mx_total") / F.lit(float(max(total, 1)))))


def _evaluate(sources: DataFrame, alphas: list[float], budget_share: float | None) -> list[tuple[float, float]]:
    """(entropy of the weights, most passes over a source) at each exponent, by one aggregate."""
    p = F.col("_mx_p")
    sums = []
    for i, a in enumerate(alphas):
        w = F.pow(p, F.lit(a))
        sums += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log(p)).alias(f"l{i}"),
                 F.max(w / p).alias(f"h{i}"), F.min(w / p).alias(f"m{i}")]
    r = sources.where(p.isNotNull()).agg(*sums).first()
    out = []
    for i, a in enumerate(alphas):
        z = r[f"z{i}"]
        # Passes over a source are budget / total * weight / share; without a budget the least is exactly one.
        passes = r[f"h{i}"] / z * budget_share if budget_share else r[f"h{i}"] / r[f"m{i}"]
        out.append((math.log(z) - a * r[f"l{i}"] / z, passes))
    return out


def exponent(sources: DataFrame, s: Settings) -> float:
    """The least exponent within [0, 1] that keeps the repetition limit and comes down to the entropy target."""
    used = sources.where(F.col("_mx_p").isNotNull()).agg(F.count(F.lit(1)), F.sum("_mx_total")).first()
    if used[0] < 2:
        return 1.0
    share = s.budget / used[1] if s.budget else None
    most = math.log(used[0])

    def enough(entropy: float, passes: float) -> bool:
        return (s.entropy is None or entropy <= s.entropy * most) and (s.repeats is None or passes <= s.repeats)

    low, high = 0.0, 1.0
    if enough(*_evaluate(sources, [0.0], share)[0]):
        return 0.0
    for _ in range(s.steps):
        step = (high - low) / (s.points + 1)
        alphas = [low + step * (i + 1) for i in range(s.points)]
        good = [enough(*x) for x in _evaluate(sources, alphas, share)]
        first = good.index(True) if True in good else s.points
        low, high = (alphas[first - 1] if first else low), (alphas[first] if first < s.points else high)
    return high


def weights(sources: DataFrame, s: Settings) -> DataFrame:
    """``sources`` plus _mx_weight and _mx_budget (tokens of the source to realise)."""
    alpha = exponent(sources, s)
    powers = sources.withColumn("_mx_power", F.pow("_mx_p", F.lit(alpha)))
    r = powers.agg(F.sum("_mx_power"), F.max(F.col("_mx_total") / F.col("_mx_power"))).first()
    norm = r[0] or 1.0
    budget = float(s.budget) if s.budget is not None else (r[1] or 0.0) * norm
    weight = F.col("_mx_power") / F.lit(norm)
    return powers.withColumn("_mx_weight", weight).withColumn(
        "_mx_budget", F.round(weight * F.lit(budget)).cast("long"))


def mixed(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", source_col: str = "source",
          tokens: Column | None = None, text_col: str = "text", out: str = "_mx",
          digest: Column | None = None) -> DataFrame:
    """``docs`` plus a struct ``out``: n_tokens, weight, block, position, copies (0 and more).

    ``tokens`` and ``digest`` (of the text) are computed from the text if not given.
    """
    s = settings
    count = tokens if tokens is not None else words_in(F.col(f"`{text_col}`"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    digest = digest if digest is not None else F.md5(F.col(f"`{text_col}`"))
    key = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), F.coalesce(digest, F.lit("")))
    source = F.col(f"`{source_col}`").cast("string")
    source = F.when(source.isNull(), "null").otherwise(F.concat(F.lit("="), source))  # never null: plain join keys
    rows = docs.select(row.alias("_mx_row"), source.alias("_mx_source"), count.alias("_mx_tokens"),
                       F.md5(F.concat(F.lit(f"{s.seed}:"), key)).alias("_mx_hash"))
    sources = _sources(rows.select("_mx_source", "_mx_tokens"))
    blocks = max(s.blocks, -(-(sources.agg(F.sum("_mx_rows")).first()[0] or 0) // s.block_rows))
    rows = rows.withColumn("_mx_block", (F.conv(F.substring("_mx_hash", 1, 8), 16, 10).cast("long") % blocks).cast("int"))
    found = weights(sources, s)

    # Starts of the blocks within their source: a few numbers per source.
    per_block = rows.groupBy("_mx_source", "_mx_block").agg(F.sum("_mx_tokens").alias("_mx_in_block"))
    turn = F.md5(F.concat_ws(":", F.lit(str(s.seed)), "_mx_source", F.col("_mx_block").cast("string")))
    before = Window.partitionBy("_mx_source").orderBy(turn, "_mx_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_block.withColumn("_mx_start", F.coalesce(F.sum("_mx_in_block").over(before), F.lit(0)))
    plan = materialize(starts.join(found, "_mx_source").select(
        "_mx_source", "_mx_block", "_mx_start", "_mx_total", "_mx_weight", "_mx_budget"), "mixing-plan")

    within = Window.partitionBy("_mx_source", "_mx_block").orderBy("_mx_hash", "_mx_tokens", F.xxhash64("_mx_row")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("_mx_end", F.sum("_mx_tokens").over(within))
    placed = placed.join(plan, ["_mx_source", "_mx_block"])
    end = F.col("_mx_start") + F.col("_mx_end")
    budget = F.coalesce("_mx_budget", F.lit(0))
    passes = F.when(F.col("_mx_total") > 0, F.floor(budget / F.col("_mx_total"))).otherwise(0)
    left = F.when(F.col("_mx_total") > 0, budget % F.col("_mx_total")).otherwise(0)
    copies = F.when(F.col("_mx_tokens") > 0, passes + (end <= left).cast("long")).otherwise(F.greatest(passes, F.lit(1)))
    result = F.struct(F.col("_mx_tokens").alias("n_tokens"), F.coalesce("_mx_weight", F.lit(0.0)).alias("weight"),
                      F.col("_mx_block").alias("block"), (end - F.col("_mx_tokens")).alias("position"),
                      copies.cast("long").alias("copies"))
    return placed.select(*[F.col("_mx_row").getField(c).alias(c) for c in docs.columns], result.alias(out))


def mix(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", source_col: str = "source",
        tokens: Column | None = None, text_col: str = "text") -> DataFrame:
    """The mixed rows themselves: each row of ``docs`` as often as its copies say."""
    done = mixed(docs, settings, id_col, source_col, tokens, text_col, "_ll_mix")
    repeated = done.withColumn("_ll_copy", F.explode(F.array_repeat(F.lit(0), F.col("_ll_mix.copies").cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_temperature_mixing(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    # Numbers and a digest are written once, so that texts are read once.
    slim = materialize(docs.select("doc_id", "source", words_in(F.col("text")).alias("n_tokens"), F.md5("text").alias("digest")),
                       "mixing-rows")
    done = mixed(slim, settings, tokens=F.col("n_tokens"), digest=F.col("digest"))
    return done.select("doc_id", "source", "n_tokens", F.round("_mx.weight", 6).alias("weight"), "_mx.block",
                       "_mx.position", "_mx.copies")


def op5_sql(s: Settings = Settings()) -> str:
    """The same rows in DuckDB's SQL, for an entropy target without limit and budget."""
    return f"""
with recursive rows_ as (
  select row_number() over () as rid, doc_id, source,
         case when source is null then 'null' else '=' || source end as s,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as n,
         md5('{s.seed}:' || coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '')) as h from documents),
dealt as (select *, (('0x' || substr(h, 1, 8))::bigint % greatest({s.blocks},
                 ((select count(*) from rows_) + {s.block_rows - 1}) // {s.block_rows}))::int as block from rows_),
sources as (select s, sum(n) as total from dealt group by s),
shares as (select s, total, total / sum(total) over () as p from sources where total > 0),
search(step, low, high) as (
  select 0, 0.0::double, 1.0::double
  union all
  select step + 1,
         coalesce(max(a) filter (where a < first_good), low), first_good_or_high
  from (select *, coalesce(first_good_raw, 2.0) as first_good, coalesce(first_good_raw, high) as first_good_or_high
        from (select *, min(a) filter (where entropy <= {s.entropy} * ln(k)) over () as first_good_raw
              from (select step, low, high, a, ln(sum(p ** a)) - a * sum(p ** a * ln(p)) / sum(p ** a) as entropy,
                           count(*) as k
                    from (select step, low, high, low + (high - low) / {s.points + 1} * i as a
                          from search, range(1, {s.points + 1}) t(i) where step < {s.steps}), shares
                    group by step, low, high, a)))
  group by step, low, high, first_good, first_good_or_high),
flat as (select ln(count(*)) as most, count(*) as k from shares),
alpha as (select case when k < 2 then 1.0 when most <= {s.entropy} * most then 0.0
                 else (select high from search order by step desc limit 1) end as alpha from flat),
powers as (select s, total, p ** alpha as power from shares, alpha),
weighed as (select s, total, power / sum(power) over () as weight,
                   round(power / sum(power) over () * (max(total / power) over () * sum(power) over ()))::bigint as budget
            from powers),
per_block as (select s, block, sum(n) as in_block from dealt group by s, block),
starts as (select s, block, coalesce(sum(in_block) over (partition by s order by md5('{s.seed}:' || s || ':' || block),
                  block rows between unbounded preceding and 1 preceding), 0) as start from per_block),
placed as (select dealt.*, start + sum(n) over (partition by s, block order by h, n
                  rows between unbounded preceding and current row) as e
           from dealt join starts using (s, block))
select doc_id, source, n as n_tokens, round(coalesce(weight, 0.0), 6) as weight, block, (e - n)::bigint as position,
       case when n > 0 then budget // total + (e <= budget % total)::bigint
            else greatest(coalesce(budget // total, 0), 1) end::bigint as copies
from placed left join weighed using (s)
"""
