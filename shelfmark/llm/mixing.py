"""Mixing sources to target weights, by Sainte-Lague apportionment.

Every source gets a target of tokens. The targets are cut into blocks of equal
tokens, and the sources are allotted whole blocks by the highest quotients
target / (2 k + 1); within a source its shards, each a bounded share of the
documents, are allotted the source's blocks in the same way. A shard lays its
documents end to end in a seeded order and its blocks are drawn from there:
whole passes over the shard as often as its quota reaches round, and for the
rest the first blocks of that order.

Only one row per source or shard meets in the apportionment; documents meet
within a shard, of which a source has as many as its tokens and rows ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import WORD, free_name, row_hash, stored

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_REPEATS = 2
BLOCK_TOKENS = 16
SHARD_TOKENS = 200_000
SHARD_ROWS = 20_000
SEED = "mix-1"


def seeded(key: Column, seed: str) -> Column:
    """32 hex digits that put keys into a seeded order."""
    return F.md5(F.concat(F.lit(seed), F.lit("|"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def seeded_number(key: Column, seed: str) -> Column:
    return F.conv(F.substring(seeded(key, seed), 1, 8), 16, 10).cast("long")


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, repeats: int = MAX_REPEATS
) -> DataFrame:
    """``sources`` (source, source_size) with weight, target and position.

    The weights are dealt to the sources by code point, null last, and repeat.
    The targets share ``percent`` of all sizes; a source is filled to at most
    ``repeats`` times its size, and what is over goes to the others by weight.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    everything = Window.partitionBy(F.lit(0))
    below = Window.orderBy("fill", "position").rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*[F.lit(w) for w in weights])
    limit = F.col("source_size") * repeats
    total = F.sum("source_size").over(everything)
    sources = (
        sources.withColumn("position", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("position") % len(weights) + 1).cast("int")))
        .withColumn("fill", limit / F.col("weight"))
        .withColumn("left", total * percent / 100 - F.coalesce(F.sum(limit).over(below), F.lit(0)))
        .withColumn(
            "weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0))
        )
        .withColumn("level", F.col("left") / F.col("weights"))
    )
    # The level of the first source that isn't filled holds for all that follow.
    level = F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "position", "level"))).over(everything)
    filled = level.isNull() | (F.struct("fill", "position") < F.struct(level["fill"], level["position"]))
    return sources.withColumn(
        "target", F.when(filled, limit.cast("double")).otherwise(level["level"] * F.col("weight"))
    ).select("source", "source_size", "weight", "position", "target")


def apportion(
    parties: DataFrame, votes: str, order: str, seats: str, within: str | None = None, name: str = "quota"
) -> DataFrame:
    """``parties`` with the whole seats that Sainte-Lague gives each by its votes.

    ``seats`` is a column with the number to give in the group ``within``. All
    get the seats that are theirs at a divisor too high to give more than there
    are; the few left go to the highest quotients votes / (2 k + 1), ties to the
    lower ``order``. No votes: no seats.
    """
    groups = [within] if within else []
    group = Window.partitionBy(*(groups or [F.lit(0)]))
    share = F.col(votes) * F.col(seats) / F.col("all_votes")
    # With n parties and S seats, S - n / 2 times the share, rounded, sums up to at most S.
    sure = F.floor(
        F.greatest(F.lit(0.0), F.col(votes) / F.col("all_votes") * (F.col(seats) - F.col("parties") / 2.0)) + 0.4999999
    )
    counted = (
        parties.withColumn("all_votes", F.sum(votes).over(group))
        .withColumn("parties", F.sum(F.when(F.col(votes) > 0, 1).otherwise(0)).over(group))
        .withColumn("sure", F.when(F.col(votes) > 0, F.least(sure, F.floor(share) + 1)).otherwise(F.lit(0)).cast("long"))
        .withColumn("open", (F.col(seats) - F.sum("sure").over(group)).cast("long"))
    )
    offers = (F.ceil(F.col("parties") * F.col(votes) / F.col("all_votes")) + 2).cast("long")
    bids = (
        counted.where(F.col(votes) > 0)
        .select(
            *groups, order, "open", "sure", votes, F.explode(F.sequence(F.lit(0).cast("long"), offers)).alias("more")
        )
        .withColumn("quotient", F.col(votes) / (2 * (F.col("sure") + F.col("more")) + 1))
    )
    best = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(F.desc("quotient"), order, "more")
    won = (
        bids.withColumn("standing", F.row_number().over(best))
        .where(F.col("standing") <= F.col("open"))
        .groupBy(*groups, order)
        .agg(F.count("*").alias("won"))
    )
    return (
        counted.join(won, [*groups, order], "left")
        .withColumn(name, F.col("sure") + F.coalesce("won", F.lit(0)))
        .drop("all_votes", "parties", "sure", "open", "won")
    )


def mixed(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", also: tuple[str, ...] = (),
    weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, repeats: int = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS, seed: str = SEED,
) -> DataFrame:
    """A row per document: doc_id, ``also``, size, source, source_size, target, quota, taken.

    See ``_dealt`` for what is laid where. The size is the number of words, 0 for null text. Null is a source of its
    own. ``taken`` counts the words that the mix takes of the document, repeats
    included, at most ``repeats`` times its size. Repeated rows are documents of
    their own. A table without words has targets of 0; no rows give no rows.
    """
    dealt = _dealt(docs, text, doc_id, source, also, weights, percent, repeats, block_tokens, seed)
    before = F.sum("size").over(_laid(seed, also).rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    within = F.greatest(F.lit(0), F.least("size", F.col("rest") - before))
    return dealt.withColumn("taken", (F.col("passes") * F.col("size") + within).cast("long")).select(
        "doc_id", *also, "size", "source", "source_size", "target", "quota", "taken"
    )


def _laid(seed: str, also: tuple[str, ...]):
    """The order in which a shard lays its documents end to end."""
    return Window.partitionBy("place").orderBy(seeded(F.col("doc_id"), seed), "doc_id", "size", *also)


def _dealt(
    docs: DataFrame, text: str, doc_id: str, source: str, also: tuple[str, ...], weights: tuple[int, ...],
    percent: int, repeats: int, block_tokens: int, seed: str,
) -> DataFrame:
    """Every document with its shard (``place``) and what the shard gives: whole ``passes``, and ``rest`` words more."""
    sized = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            *also,
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    wanted = targets(per_source, weights, percent, repeats).join(
        per_source.select(F.col("source").alias("source_"), "n_docs"), F.col("source").eqNullSafe(F.col("source_"))
    ).drop("source_")
    everything = Window.partitionBy(F.lit(0))
    blocks = F.round(F.sum("target").over(everything) / block_tokens).cast("long")
    quotas = stored(
        apportion(wanted.withColumn("seats", blocks), "target", "position", "seats").withColumn(
            "shards",
            F.greatest(F.ceil(F.col("source_size") / SHARD_TOKENS), F.ceil(F.col("n_docs") / SHARD_ROWS)),
        ),
        "quotas",
    )
    dealt = sized.join(
        quotas.select(
            F.col("source").alias("source_"), "position", "shards", "source_size", "target", "quota"
        ),
        F.col("source").eqNullSafe(F.col("source_")),
    ).withColumn("shard", seeded_number(F.col("doc_id"), seed + "|shard") % F.col("shards"))
    place = F.col("position") * F.lit(1 << 32) + F.col("shard")
    dealt = dealt.withColumn("place", place)
    shards = dealt.groupBy("position", "place").agg(
        F.sum("size").alias("shard_size"), F.max("quota").alias("seats")
    )
    shards = apportion(shards, "shard_size", "place", "seats", "position", "shard_quota").select(
        F.col("place").alias("place_"), "shard_size", "shard_quota"
    )
    limit = F.least(F.col("shard_quota") * block_tokens, F.col("shard_size") * repeats)
    passes = F.floor(F.col("limit") / F.greatest("shard_size", F.lit(1)))
    return (
        dealt.join(shards, F.col("place") == F.col("place_"))
        .withColumn("limit", limit)
        .withColumn("passes", passes.cast("long"))
        .withColumn("rest", F.col("limit") - F.col("passes") * F.col("shard_size"))
    )


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: ``docs`` with each document as often as it is taken, all columns kept.

    Documents stay whole. For what is left of a shard's quota after whole passes,
    those that are longer than that are passed over, so they don't use it up; the
    others are laid end to end, and of these the one that the end of the quota
    cuts is taken if at least half of its words are within. Where all are longer,
    the shortest is taken on the same condition. So a shard is off by half a
    document that fits, at most. Documents without words are not in a mix.
    """
    mark, id_ = free_name(docs, "row_mark"), f"`{doc_id}`"
    marked = docs.withColumn(mark, row_hash(docs))
    dealt = _dealt(
        marked, text, doc_id, source, (mark,), WEIGHTS, SHARE_PERCENT, MAX_REPEATS, BLOCK_TOKENS, SEED
    ).where("size > 0")
    fits = F.col("size") <= F.col("rest")
    laid, shard = _laid(SEED, (mark,)), Window.partitionBy("place")
    fitting = F.when(F.col("fits_"), F.col("size")).otherwise(F.lit(0))
    before = F.sum(fitting).over(laid.rowsBetween(Window.unboundedPreceding, 0)) - fitting
    shortest = F.row_number().over(shard.orderBy("size", seeded(F.col("doc_id"), SEED), "doc_id", mark)) == 1
    in_turn = F.when(F.col("any_"), F.col("fits_") & (2 * (F.col("rest") - F.col("before_")) >= F.col("size"))).otherwise(
        F.col("shortest_") & (2 * F.col("rest") >= F.col("size"))
    )
    # Rows alike in all columns get alike shares: they are told apart by their number.
    takes = (
        dealt.withColumn("fits_", fits)
        .withColumn("any_", F.max("fits_").over(shard))
        .withColumn("before_", before)
        .withColumn("shortest_", shortest)
        .withColumn("copies_", F.col("passes") + F.when(in_turn, 1).otherwise(0))
        .where("copies_ > 0")
        .select(F.col("doc_id").alias("id_"), F.col(mark).alias("mark_"), "copies_")
        .groupBy("id_", "mark_")
        .agg(F.sum("copies_").cast("int").alias("copies_"), F.count("*").alias("rows_"))
    )
    taken = takes.select("id_", "mark_", "copies_")
    first = Window.partitionBy(mark, id_).orderBy(F.lit(1))
    number = free_name(marked, "number_")
    return (
        marked.withColumn(number, F.row_number().over(first))
        .where(F.col(number) == 1)
        .join(taken, F.col(id_).eqNullSafe(F.col("id_")) & (F.col(mark) == F.col("mark_")))
        .select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("copies_"))).alias("copy_"))
        .drop("copy_")
    )


#: The same rows in DuckDB: targets, quotas, shards and seeded blocks.
MIXING_SQL = f"""
with sized as (
  select doc_id, source,
         cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size
  from documents
), per_source as (
  select source, cast(sum(size) as bigint) as source_size, count(*) as n_docs from sized group by source
), named as (
  select *, row_number() over (order by source is null, encode(source)) - 1 as position from per_source
), weighted as (
  select *, ([5, 2, 1])[position % 3 + 1] as weight from named
), filled as (
  select *, (source_size * 2)::double / weight as fill from weighted
), levels as (
  select *,
    ((sum(source_size) over ())::double * {SHARE_PERCENT} / 100
      - coalesce(sum(source_size * 2) over below, 0)::double)
    / (sum(weight) over () - coalesce(sum(weight) over below, 0))::double as level
  from filled window below as (order by fill, position rows between unbounded preceding and 1 preceding)
), cut as (
  select min({{'fill': fill, 'position': position, 'level': level}}) as c from levels where fill > level
), targets as (
  select source, source_size, n_docs, position,
    case when c is null or (fill, position) < (c.fill, c.position)
         then (source_size * 2)::double else c.level * weight end as target
  from levels, cut
), seats as (
  select *, cast(round(sum(target) over () / {BLOCK_TOKENS}) as bigint) as seats,
         sum(target) over () as all_votes from targets
), bids as (
  select position, target / (2 * k + 1) as quotient, k, seats
  from seats, unnest(range(cast(floor(target / all_votes * seats) as bigint) + 3)) as t(k)
  where target > 0
), quotas as (
  select position, count(*) as quota from (
    select position, seats, row_number() over (order by quotient desc, position, k) as place from bids
  ) where place <= seats group by position
), dealt as (
  select s.doc_id, s.size, t.source_size, t.target, t.position, coalesce(q.quota, 0) as quota,
    ('0x' || substr(md5('{SEED}|shard|' || coalesce(s.doc_id::varchar, '')), 1, 8))::bigint
      % greatest(ceil(t.source_size / {SHARD_TOKENS}.0), ceil(t.n_docs / {SHARD_ROWS}.0))::bigint as shard
  from sized s join targets t on s.source is not distinct from t.source
  left join quotas q on q.position = t.position
), shards as (
  select position, shard, sum(size) as shard_size, max(quota) as seats from dealt group by position, shard
), shard_votes as (
  select *, sum(shard_size) over (partition by position) as all_votes from shards
), shard_bids as (
  select position, shard, seats, shard_size / (2 * k + 1)::double as quotient, k
  from shard_votes, unnest(range(cast(floor(shard_size::double * seats / all_votes) as bigint) + 3)) as t(k)
  where shard_size > 0
), shard_quotas as (
  select position, shard, count(*) as shard_quota from (
    select *, row_number() over (partition by position order by quotient desc, shard, k) as place from shard_bids
  ) where place <= seats group by position, shard
), laid as (
  select d.*, s.shard_size,
    least(coalesce(q.shard_quota, 0) * {BLOCK_TOKENS}, s.shard_size * {MAX_REPEATS}) as lim,
    sum(d.size) over (partition by d.position, d.shard
      order by md5('{SEED}|' || coalesce(d.doc_id::varchar, '')), d.doc_id, d.size
      rows between unbounded preceding and current row) - d.size as before
  from dealt d join shards s using (position, shard) left join shard_quotas q using (position, shard)
)
select doc_id, size, source_size, target,
  cast(lim // greatest(shard_size, 1) * size
    + greatest(0, least(size, lim - (lim // greatest(shard_size, 1)) * shard_size - before)) as bigint) as taken
from laid
"""
