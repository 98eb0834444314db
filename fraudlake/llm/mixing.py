"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree.

Documents are dealt by hash to output shards, and their texts cut into blocks of
``block_words`` words. A source's mix is ``full`` whole passes over all its
blocks, and a part of its blocks once more: ``rest`` words, so that its words meet
its target exactly. That quota is split among the shards by a binary tree: a node
holds ``w`` words of the source's blocks and has ``r`` of them to draw; how many
of these its left child draws is hypergeometric (``r`` drawn from ``w``, of which
the left child holds ``w_left``), the right child draws the others. So all levels
keep each source's quota exactly, and over the shards it is split multivariate
hypergeometrically. Quotas are counted in words: a shard draws its own blocks, which
no other shard holds, in the order of a random permutation until its quota is met,
and cuts the last one. What a document gives is the sum of what its shard draws.

A shard's rows are shuffled locally by a hash (``place``; :func:`shards`). DataFrame
functions only. Random numbers are hashes, so reruns agree.

Scale: a shard holds about ``shard_blocks`` blocks, so the number of shards (a power
of two) follows the input; a source with a third of all rows is spread over all of
them. Blocks are shuffled once, by (source number, shard): that partitioning serves
the permutation, the join with the quotas and the sums per document. The tree is a
table of (source, node) rows, a join and an explode a level. Only sources are
ordered in one task, a row each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
WIDE = 5000.0


def word_count(text: Column) -> Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5,
                   limit: float = 2.0) -> DataFrame:
    """``sized`` (source, size) -> (source, source_size, target).

    Sources in code point order, null last, get ``weights`` in turn and share
    ``share`` of all words by weight; none gets more than ``limit`` times its
    words, the excess goes to the others by weight until none is above. That
    is a water level: sources fill up in the order of limit / weight, and the
    level left for the rest follows from running sums.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1)
    per = per.withColumn("w", weight).withColumn("cap", limit * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = per.withColumns({
        "left": share * F.sum("source_size").over(whole)
        - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)),
        "w_left": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))})
    full = F.col("cap") <= F.col("w") * F.col("left") / F.col("w_left")
    # Full sources come first; the first that is not full sets the level of the rest.
    level = F.min(F.when(~full, F.struct(F.col("cap") / F.col("w"), F.col("left")
                                         / F.col("w_left")))).over(whole)
    return per.select(
        "source", F.col("source_size").cast("long").alias("source_size"),
        F.least("cap", F.coalesce(F.col("w") * level.getField("col2"), F.col("cap")))
        .alias("target"))


def _log_factorial(x: str) -> str:
    """SQL for ln(x!): Stirling's series at x + 8, less the eight factors."""
    y = f"({x} + 8.0D)"
    low = " * ".join(f"({x} + {k}.0D)" for k in range(1, 9))
    return (f"(({y} + 0.5D) * ln({y}) - {y} + {0.5 * math.log(2 * math.pi)!r}D"
            f" + 1.0D / (12.0D * {y}) - 1.0D / (360.0D * {y} * {y} * {y}) - ln({low}))")


def _draw_sql(good: str, total: str, drawn: str, u: str) -> str:
    """SQL for a hypergeometric draw: how many of ``good`` are among ``drawn`` of
    ``total`` (doubles), by inverting the distribution function at ``u``.
    Weights are summed within ten standard deviations (plus 10) of the mean,
    which holds all the mass that a double can show. One-element arrays bind
    what is computed once. With a standard deviation above :data:`WIDE`, whose
    weights would fill an array of that size, the draw is the normal one with the
    same mean and deviation, rounded, within the same limits."""

    def weight(k: str) -> str:
        terms = (k, f"(v.g - {k})", f"(v.d - {k})", f"(v.t - v.g - v.d + {k})")
        return "(-" + " - ".join(map(_log_factorial, terms)) + ")"

    steps = (
        f"array(named_struct('g', {good}, 't', {total}, 'd', {drawn}, 'u', {u}))",
        "named_struct('g', v.g, 't', v.t, 'd', v.d, 'u', v.u, 'm', v.d * (v.g / v.t), 's', 10.0D"
        " + 10.0D * sqrt(v.d * (v.g / v.t) * (1.0D - v.g / v.t) * ((v.t - v.d)"
        " / greatest(v.t - 1.0D, 1.0D))))",
        "named_struct('g', v.g, 't', v.t, 'd', v.d, 'u', v.u, 'm', v.m,"
        " 'lo', greatest(0.0D, v.g + v.d - v.t, floor(v.m - v.s) + 0.0D),"
        " 'hi', least(v.g, v.d, ceil(v.m + v.s) + 0.0D))",
        "named_struct('g', v.g, 't', v.t, 'd', v.d, 'u', v.u, 'lo', v.lo, 'hi', v.hi, 'top', "
        + weight("least(greatest(floor(v.m) + 0.0D, v.lo), v.hi)") + ")",
        "named_struct('u', v.u, 'lo', v.lo, 'p', transform(sequence(cast(v.lo as bigint),"
        f" cast(v.hi as bigint)), h -> exp({weight('cast(h as double)')} - v.top)))",
        "named_struct('goal', v.u * aggregate(v.p, 0.0D, (c, w) -> c + w), 'lo', v.lo, 'p', v.p)",
        "v.lo + aggregate(v.p, named_struct('run', 0.0D, 'n', 0.0D), (b, y) -> named_struct("
        "'run', b.run + y, 'n', b.n + if(b.run + y < v.goal, 1.0D, 0.0D)),"
        " b -> least(b.n, size(v.p) - 1.0D))",
    )
    sql = steps[0]
    for step in steps[1:]:
        sql = f"transform({sql}, v -> {step})"
    mean = f"({drawn} * ({good} / {total}))"
    deviation = (f"sqrt({mean} * (1.0D - {good} / {total}) * (({total} - {drawn})"
                 f" / greatest({total} - 1.0D, 1.0D)))")
    angle = f"(6.283185307179586D * pmod({u} * 1048576.0D, 1.0D))"
    normal = (f"least({good}, {drawn}, greatest(0.0D, {good} + {drawn} - {total}, floor({mean}"
              f" + {deviation} * sqrt(-2.0D * ln({u})) * cos({angle}) + 0.5D) + 0.0D))")
    return f"""(CASE WHEN {good} <= 0.0D OR {drawn} <= 0.0D THEN 0.0D
        WHEN {drawn} >= {total} THEN cast({good} as double)
        WHEN {good} >= {total} THEN cast({drawn} as double)
        WHEN {deviation} > {WIDE}D THEN {normal} ELSE element_at({sql}, 1) END)"""


def split_quotas(held: DataFrame, rest: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """``held`` (s, shard, w): words of source ``s`` in a shard; ``rest`` (s, r): words to
    draw of it, at most what it holds -> (s, shard, r): what each shard draws.

    One tree level after the other; ``shards`` is a power of two. Only nodes with
    words to draw are kept.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    depth = shards.bit_length() - 1
    nodes = (held.groupBy("s").agg(F.sum("w").cast("double").alias("w")).join(rest, "s")
             .select("s", F.lit(0).alias("node"), "w", F.col("r").cast("double").alias("r"))
             .filter("r > 0"))
    for level in range(depth):
        left = (held.filter(f"shiftright(shard, {depth - level - 1}) % 2 = 0")
                .groupBy("s", F.shiftright("shard", depth - level).alias("node"))
                .agg(F.sum("w").cast("double").alias("left_w")))
        u = f"((shiftrightunsigned(xxhash64({seed}, {level}, node, s), 11) + 0.5D) / {2.0 ** 53!r}D)"
        nodes = (nodes.join(left, ["s", "node"], "left").fillna(0.0, ["left_w"])
                 .withColumn("left_r", F.expr(_draw_sql("left_w", "w", "r", u)))
                 .select("s", F.inline(F.expr("""array(
                     named_struct('node', node * 2, 'w', left_w, 'r', left_r),
                     named_struct('node', node * 2 + 1, 'w', w - left_w, 'r', r - left_r))""")))
                 .filter("r > 0"))
        if level % 4 == 3:
            nodes = staged(nodes, "mix-level")
    return nodes.select("s", F.col("node").alias("shard"), F.col("r").cast("long").alias("r"))


ROW = ("doc_id", "row_hash", "copy")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, limit: float = 2.0,
        block_words: int = 32, shard_blocks: int = 20_000, seed: int = 42,
        tree_seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(targets, draws) of the mix of ``docs`` (doc_id, text, source).

    targets: source, source_size, target. draws: one row per document: its key
    (doc_id, row_hash, copy), source, size, ``shard``, ``full`` (whole passes over it)
    and ``parts`` (block and words taken of it, for each block drawn once more).

    Each source's drawn words are its target rounded to a whole word; a block
    is drawn at most ``limit`` times (rounded up), its words at most ``limit``.
    ``tree_seed`` (default: ``seed``) draws the shards' quotas, ``seed`` the rest.
    Nulls: a null text has no words; a null source is a source, the last one;
    a null doc_id is a document. Repeated rows are told apart by ``copy``. A very
    long text is one row a block until its blocks are summed up. Empty table:
    empty results. Other columns only enter ``row_hash``.
    """
    every = F.xxhash64(*[docs[c] for c in docs.columns])
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"), every.alias("row_hash"))
    rows = staged(own.groupBy("doc_id", "source", "size", "row_hash")
                  .agg(F.count("*").alias("copies")), "mix-rows")
    n_blocks = F.ceil(F.col("size") / block_words).cast("long")
    blocks = rows.agg(F.sum(n_blocks * F.col("copies"))).first()[0] or 0
    n_shards = 1 << max(math.ceil(blocks / shard_blocks) - 1, 15).bit_length()

    sized = rows.select("source", (F.col("size") * F.col("copies")).alias("size"))
    targets = staged(source_targets(sized, weights, share, limit), "mix-targets")
    # A number for each source: below, only it is carried and joined on.
    passes = F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))
    plan = staged(targets.select(
        "source", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("s"),
        F.coalesce(passes, F.lit(0)).cast("long").alias("full"),
        F.coalesce(F.round("target") - passes * F.col("source_size"), F.lit(0)).cast("long")
        .alias("r")), "mix-plan")
    # Null sources are told by a flag, so that the join is on plain equality.
    known = plan.select(F.coalesce("source", F.lit("")).alias("name"),
                        F.col("source").isNull().alias("none"), "s", "full")
    numbered = (rows.withColumn("name", F.coalesce("source", F.lit("")))
                .withColumn("none", F.col("source").isNull()).join(known, ["name", "none"])
                .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
                .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), *ROW), F.lit(n_shards)).cast("int"))
                .select(*ROW, "s", "shard", "size", "full"))
    held = staged(numbered.filter("size > 0").groupBy("s", "shard").agg(F.sum("size").alias("w")),
                  "mix-held")
    quotas = staged(split_quotas(held, plan.select("s", "r"), n_shards,
                                 seed if tree_seed is None else tree_seed), "mix-quotas")

    cut = numbered.filter("size > 0").select(
        *ROW, "s", "shard", "size", "full",
        F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int"))).alias("block"))
    cut = cut.withColumns({
        "words": F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words).cast("int"),
        "h": F.xxhash64(F.lit(seed + 1), *ROW, "block")})
    order = Window.partitionBy("s", "shard").orderBy("h", *ROW, "block")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    taken = (cut.withColumn("before", before).join(quotas, ["s", "shard"], "left")
             .withColumn("take", F.greatest(F.lit(0), F.least(
                 F.col("words"), F.coalesce("r", F.lit(0)) - F.col("before"))).cast("int")))
    summed = taken.groupBy("s", "shard", *ROW).agg(
        F.first("size").alias("size"), F.first("full").alias("full"),
        F.sort_array(F.collect_list(F.when(F.col("take") > 0, F.struct("block", "take"))))
        .alias("parts"))
    bare = numbered.filter("size = 0").select(
        "s", "shard", *ROW, "size", F.lit(0).cast("long").alias("full"),
        F.lit(None).cast("array<struct<block:int,take:int>>").alias("parts"))
    draws = summed.unionByName(bare).join(plan.select("s", "source"), "s").select(
        *ROW, "source", "size", "shard", "full",
        F.coalesce("parts", F.array()).cast("array<struct<block:int,take:int>>").alias("parts"))
    return targets, staged(draws, "mix-draws")


def _extra() -> Column:
    """Words of the blocks that a document gives once more."""
    return F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + x["take"])


def taken_words(targets: DataFrame, draws: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (what
    its shard draws of it) and the shard."""
    per = draws.select("doc_id", "source", "size", "shard",
                       (F.col("full") * F.col("size") + _extra()).alias("taken"))
    return per.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source")).select(
        "d.doc_id", "d.source", "d.size", "t.source_size", "t.target", "d.taken", "d.shard")


def _mixed(docs: DataFrame, block_words: int, seed: int, **options) -> DataFrame:
    """``docs`` as mixed, with ``__mix_shard`` and ``__mix_place``."""
    _, draws = mix(docs, block_words=block_words, seed=seed, **options)
    mark, shard, place = "__mix_row_hash", "__mix_shard", "__mix_place"
    # Pass k below full is the whole text, pass full the parts.
    last = F.col("full") + F.when(F.size("parts") > 0, 0).otherwise(-1)
    passes = (draws.filter("size > 0").filter(last >= 0)
              .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), last)))
              .select("doc_id", "row_hash", F.col("shard").alias(shard),
                      F.xxhash64(F.lit(seed + 2), *ROW, "pass").alias(place),
                      F.when((F.col("pass") == F.col("full")) & (_extra() < F.col("size")),
                             F.col("parts")).alias("parts")))
    keyed = docs.withColumn(mark, F.xxhash64(*[docs[c] for c in docs.columns]))
    keyed = keyed.dropDuplicates(["doc_id", mark])
    text = F.when(F.col("p.parts").isNull(), F.col("d.text")).otherwise(F.array_join(F.flatten(
        F.transform("p.parts", lambda x: F.slice(
            F.regexp_extract_all("d.text", F.lit(WORD), F.lit(0)),
            x["block"] * block_words + 1, x["take"]))), " "))
    out = keyed.alias("d").join(passes.alias("p"), F.expr(
        f"cast(d.doc_id as bigint) <=> p.doc_id AND d.{mark} = p.row_hash")).select(
        *[F.col(f"d.{c}") for c in docs.columns if c not in ("text", "n_chars")],
        text.alias("text"), F.col(f"p.{shard}"), F.col(f"p.{place}"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns, shard, place)


def mixed_documents(docs: DataFrame, block_words: int = 32, seed: int = 42, **options) -> DataFrame:
    """``docs`` as mixed: a row per document and pass of its shard over it, with the
    words drawn in the order of the text (a whole text as it is; parts joined by
    spaces), in the columns of ``docs`` (``n_chars`` follows the text)."""
    return _mixed(docs, block_words, seed, **options).select(*docs.columns)


def shards(docs: DataFrame, block_words: int = 32, seed: int = 42, **options) -> DataFrame:
    """The output shards: rows of :func:`mixed_documents` with ``shard`` and ``place``,
    each shard in one partition and shuffled within it by ``place``. A column of
    either name in ``docs`` gives way."""
    out = _mixed(docs, block_words, seed, **options)
    own = [c for c in docs.columns if c not in ("shard", "place")]
    out = out.select(*own, F.col("__mix_shard").alias("shard"), F.col("__mix_place").alias("place"))
    return out.repartition("shard").sortWithinPartitions("shard", "place")
