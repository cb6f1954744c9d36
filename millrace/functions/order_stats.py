"""Order statistics that never need a whole group in one task.

* ``quantiles``: exact interpolated quantiles in two passes. A mergeable sketch brackets every quantile,
  then one aggregate counts what lies outside the brackets and keeps the distinct values inside.
* ``wide_quantiles``: the same for many columns at once; only values inside brackets become rows.
* ``take_by_hash``: an exact per-group quota in hash order. A radix selection finds the hash range where the
  quota ends, by counts only, until it is small; only that range is ranked.
* ``running_totals``: global prefix sums. Splitters sampled from the keys cut the order into ranges; each
  range is summed on its own and shifted by the total of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.expressions import all_of
from millrace.functions.hashing import hash32
from millrace.session import settle

SKETCH_ACCURACY = 20_000
BRACKET = 3e-4  # half width in rank share; six times the sketch error of 1 / SKETCH_ACCURACY
SMALL_BRACKET = 0.01  # the same for groups up to SMALL_GROUP, where the sketch is off by one row at most
WIDE_COLUMNS = 32  # columns of one plan
TINY_GROUP = 1_000  # up to here the bracket of a wide quantile is the whole value range
SMALL_GROUP = 20_000  # and up to here that of a single one
WIDE_GROUP = 1_000_000_000  # beyond, a group's brackets are ranked in ranges
SLOT_BITS = 10
HASH_BITS = 32
EDGE_ROWS = 20_000  # rows of a group that are ranked in one task
FAN = 10
SPLITTERS = FAN**3
SLICE_ROWS = 100_000  # rows that are sorted for a slice, where its keys differ
SLICE_SAMPLE = 10_000  # keys that the driver holds to cut a slice out
SLICE_MARGIN = 250  # of them on either side; five deviations of a rank in the sample


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return all_of(left[a].eqNullSafe(right[b]) for a, b in pairs)


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), as_type: str = "double") -> DataFrame:
    """One row per (kept columns, column, value)."""
    cast = df.select(*keep, *[F.col(c).cast(as_type).alias(c) for c in cols])
    return cast.unpivot(list(keep), list(cols), "column", "value")


def _reached(folded: DataFrame, by: Sequence[str], wide: bool) -> DataFrame:
    """Adds ``reached_``: rows of the group up to and including this value."""
    if not wide:
        order = Window.partitionBy(*by).orderBy(F.col("anchor_").asc_nulls_first(), "gap_")
        return folded.withColumn("reached_", F.sum("rows_").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = settle(running_totals(folded, [*by, "anchor_", "gap_"], {"all_": F.col("rows_")}), "reached")
    before = F.min(F.col("all_") - F.col("rows_")).alias("before_")
    if not by:
        return ranked.withColumn("reached_", F.col("all_") - ranked.agg(before).scalar())
    starts = ranked.groupBy(*[F.col(c).alias(f"g_{c}") for c in by]).agg(before)
    joined = ranked.join(starts, null_safe(ranked, starts, [(c, f"g_{c}") for c in by]))
    return joined.withColumn("reached_", F.col("all_") - F.col("before_"))


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: dict[str, float],
    extra: dict[str, Column] | None = None,
    approx: bool = False,
    few_groups: bool = False,
) -> DataFrame:
    """Quantiles of a double column per group, with optional further aggregates of the same pass.

    Nulls and NaN are left out. The sketch table is written first: Spark then plans its join from the
    measured size instead of an estimate that would shuffle all values. ``few_groups`` states that the
    groups are column names, so the table is bounded by the schema and is broadcast in any case.

    What remains inside the brackets is about k * 2 * BRACKET of a group. Up to WIDE_GROUP values that is
    ranked in one task per group; beyond, by ``running_totals`` in many ranges.
    """
    by = list(by)
    extra = extra or {}
    clean = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    names, ps = list(probs), list(probs.values())
    base = [F.count(value).alias("n"), *[e.alias(f"x_{k}") for k, e in extra.items()]]
    if approx:
        found = clean.groupBy(*by).agg(*base, F.percentile_approx(value, ps, SKETCH_ACCURACY).alias("q"))
        picked = [F.get("q", F.lit(i)).alias(name) for i, name in enumerate(names)]
        return found.select(*by, "n", *[F.col(f"x_{k}").alias(k) for k in extra], *picked)

    marks = [max(0.0, p - BRACKET) for p in ps] + [min(1.0, p + BRACKET) for p in ps]
    sketch = clean.groupBy(*by).agg(
        *base,
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.percentile_approx(value, marks, SKETCH_ACCURACY).alias("marks"),
    )
    small = F.col("n") <= SMALL_GROUP
    lows = [F.when(small | (p == 0), F.col("lowest")).otherwise(F.get("marks", F.lit(i))) for i, p in enumerate(ps)]
    highs = [
        F.when(small | (p == 1), F.col("highest")).otherwise(F.get("marks", F.lit(len(ps) + i)))
        for i, p in enumerate(ps)
    ]
    carried = ["n", *[f"x_{k}" for k in extra]]
    sketch = sketch.select(
        *[F.col(c).alias(f"k_{c}") for c in by],
        *carried,
        *[c.alias(f"lo{i}") for i, c in enumerate(lows)],
        *[c.alias(f"hi{i}") for i, c in enumerate(highs)],
    )
    sketch = settle(sketch, "sketch")
    wide = (sketch.agg(F.max("n")).first()[0] or 0) > WIDE_GROUP
    rows = clean.select(*by, F.col(value).alias("value_"))
    if by:
        side = F.broadcast(sketch) if few_groups else sketch
        joined = rows.join(side, null_safe(rows, sketch, [(c, f"k_{c}") for c in by]))
    else:
        joined = rows.select("value_", F.inline(F.array(sketch.select(F.struct(*sketch.columns)).scalar())))
    inside = F.lit(False)
    for i in range(len(ps)):
        inside = inside | F.col("value_").between(F.col(f"lo{i}"), F.col(f"hi{i}"))
    passed = [F.when(F.col(f"hi{i}") < F.col("value_"), F.col(f"hi{i}")) for i in range(len(ps))]
    anchor = F.when(inside, F.col("value_")).otherwise(F.greatest(*passed, F.lit(None).cast("double")))
    # Values outside every bracket fold into one "gap_" row behind the last bracket they passed.
    folded = joined.groupBy(*by, anchor.alias("anchor_"), (~inside).alias("gap_")).agg(
        F.count("value_").alias("rows_"), *[F.max(c).alias(c) for c in carried]
    )
    ranked = _reached(folded, by, wide)

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("reached_") > position, F.struct("anchor_", "gap_")))

    picks = []
    for i, p in enumerate(ps):
        position = F.lit(float(p)) * (F.col("n") - 1)
        picks += [at(F.floor(position)).alias(f"a{i}"), at(F.ceil(position)).alias(f"b{i}")]
    found = ranked.groupBy(*by).agg(*[F.max(c).alias(c) for c in carried], *picks)

    def checked(name: str) -> Column:
        broken = F.raise_error(F.lit("a quantile fell outside its sketch bracket")).cast("double")
        return F.when(F.col(f"{name}.gap_"), broken).otherwise(F.col(f"{name}.anchor_"))

    outs = []
    for i, (name, p) in enumerate(zip(names, ps, strict=True)):
        position = F.lit(float(p)) * (F.col("n") - 1)
        low, high = checked(f"a{i}"), checked(f"b{i}")
        outs.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(*by, "n", *[F.col(f"x_{k}").alias(k) for k in extra], *outs)


def wide_quantiles(
    df: DataFrame,
    by: Sequence[str],
    cols: Sequence[str],
    probs: dict[str, float],
    extra: dict[str, Callable[[str], Column]] | None = None,
    approx: bool = False,
) -> DataFrame:
    """Exact quantiles of many columns per group: (by, column, n, extra, probs), nulls and NaN aside.

    One aggregate over the table as it stands has a mergeable sketch of every column. The sketches bracket each
    quantile; a second aggregate counts the values below the brackets, and only values inside brackets ever become
    rows: up to SMALL_GROUP of a group those within 1 % of the quantile, beyond that about 2 * BRACKET of the group. A
    value outside its bracket fails the job. Columns without a value have no row. Columns are taken WIDE_COLUMNS at a
    time, each part of them read on its own.
    """
    cols = list(cols)
    parts = [_wide_part(df, list(by), cols[at : at + WIDE_COLUMNS], probs, extra or {}, approx) for at in range(0, len(cols), WIDE_COLUMNS)]
    return reduce(DataFrame.unionByName, parts)


def _wide_part(df: DataFrame, by: list[str], cols: list[str], probs: dict[str, float], extra: dict[str, Callable[[str], Column]], approx: bool) -> DataFrame:
    names, ps = list(probs), list(probs.values())
    double = {c: F.col(c).cast("double") for c in cols}
    clean = df.select(*by, *[F.when(~F.isnan(double[c]), double[c]).alias(f"v{i}") for i, c in enumerate(cols)])
    widths = (BRACKET, SMALL_BRACKET)
    marks = ps if approx else [m for w in widths for p in ps for m in (max(0.0, p - w), min(1.0, p + w))]

    def facts(v: str) -> list[Column]:
        base = [F.count(v).alias("n"), F.min(v).alias("lowest"), F.max(v).alias("highest")]
        return [*base, F.percentile_approx(v, marks, SKETCH_ACCURACY).alias("marks"), *[e(v).alias(f"x_{k}") for k, e in extra.items()]]

    sketch = settle(clean.groupBy(*by).agg(*[F.struct(*facts(f"v{i}")).alias(f"c{i}") for i in range(len(cols))]), "sketch")
    rows_of = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("f")) for i, c in enumerate(cols)]
    long = sketch.select(*by, F.inline(F.array(*rows_of))).filter("f.n > 0")
    kept = ["column", F.col("f.n").alias("n"), *[F.col(f"f.x_{k}").alias(k) for k in extra]]
    if approx:
        return long.select(*by, *kept, *[F.get("f.marks", F.lit(i)).alias(name) for i, name in enumerate(names)])

    def bracket(c: int, i: int, side: int) -> str:
        end = f"c{c}.{('lowest', 'highest')[side]}"
        if ps[i] == side:
            return end
        near, far = (f"c{c}.marks[{(w * len(ps) + i) * 2 + side}]" for w in (0, 1))
        return f"CASE WHEN c{c}.n <= {TINY_GROUP} THEN {end} WHEN c{c}.n <= {SMALL_GROUP} THEN {far} ELSE {near} END"

    # Expressions as SQL text: there are several for each column and quantile.
    every = [(c, i) for c in range(len(cols)) for i in range(len(ps))]
    bounds = {c: ", ".join(f"'{e}{i}', {bracket(c, i, side)}" for i in range(len(ps)) for side, e in enumerate(("lo", "hi"))) for c in range(len(cols))}
    ends = [F.expr(f"named_struct({bounds[c]}, 'n', c{c}.n) AS c{c}") for c in bounds]
    edges = settle(sketch.select(*[F.col(c).alias(f"k_{c}") for c in by], *ends), "edges")
    if by:
        placed = clean.join(edges, null_safe(clean, edges, [(c, f"k_{c}") for c in by]))
        end = lambda c, name: f"c{c}.{name}"
    else:
        row = edges.first()  # one row, as wide as the table
        placed = clean
        text = lambda x: "NULL" if x is None else f"double('{x!r}')" if isinstance(x, float) else f"{x}L"
        end = lambda c, name: text(row[f"c{c}"][name])
    below = [F.expr(f"count_if(v{c} < {end(c, f'lo{i}')}) AS b{c}_{i}") for c, i in every] + [F.expr(f"max({end(c, 'n')}) AS n{c}") for c in bounds]
    cells = ", ".join(f"named_struct('c', {c}, 'i', {i}, 'anchor_', double(null), 'rows_', b{c}_{i}, 'n', n{c})" for c, i in every)
    first = placed.groupBy(*by).agg(*below).select(*by, F.expr(f"inline(array({cells}))")).withColumn("gap_", F.lit(True)).filter("n > 0")
    found = ", ".join(f"CASE WHEN v{c} BETWEEN {end(c, f'lo{i}')} AND {end(c, f'hi{i}')} THEN named_struct('c', {c}, 'i', {i}, 'anchor_', v{c}, 'n', {end(c, 'n')}) END" for c, i in every)
    inside = placed.select(*by, F.expr(f"inline(array_compact(array({found})))"))
    inside = inside.groupBy(*by, "c", "i", "anchor_").agg(F.count(F.lit(1)).alias("rows_"), F.max("n").alias("n")).withColumn("gap_", F.lit(False))
    wide = (long.agg(F.max("f.n")).first()[0] or 0) > WIDE_GROUP
    ranked = _reached(first.unionByName(inside), [*by, "c", "i"], wide)
    position = F.element_at(F.array(*[F.lit(float(p)) for p in ps]), F.col("i") + 1) * (F.col("n") - 1)
    at = lambda place: F.min(F.when(F.col("reached_") > place, F.struct("anchor_", "gap_")))
    placed_at = ranked.withColumn("position_", position).groupBy(*by, "c", "i")
    picked = placed_at.agg(at(F.floor("position_")).alias("a"), at(F.ceil("position_")).alias("b"), F.max("position_").alias("p"))
    broken = F.raise_error(F.lit("a quantile fell outside its sketch bracket")).cast("double")
    low, high = (F.when(F.col(f"{e}.gap_") | F.col(e).isNull(), broken).otherwise(F.col(f"{e}.anchor_")) for e in "ab")
    value = low + (high - low) * (F.col("p") - F.floor("p"))
    name_of = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("c") + 1)
    exact = picked.select(*by, name_of.alias("column"), "i", value.alias("value")).groupBy(*by, "column")
    exact = exact.agg(*[F.max(F.when(F.col("i") == i, F.col("value"))).alias(name) for i, name in enumerate(names)])
    facts_of = long.select(*by, *kept)
    keys = [*by, "column"]
    renamed = exact.withColumnsRenamed({c: f"k_{c}" for c in keys})
    joined = facts_of.join(renamed, null_safe(facts_of, renamed, [(c, f"k_{c}") for c in keys]))
    return joined.select(*facts_of.columns, *names)


def _attach(tagged: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """Every row with its group's edge; without groups the one edge row is a scalar."""
    if by:
        return tagged.join(edges, null_safe(tagged, edges, [(c, f"k_{c}") for c in by]))
    return tagged.select("*", F.inline(F.array(edges.select(F.struct(*edges.columns)).scalar())))


def _narrowed(counts: DataFrame, by: list[str], quota: Column, before: Column, low: Column, width: int) -> DataFrame:
    """The slot in which each group's quota ends: its hash range [lo_, hi_), rows in it and rows before it.

    ``counts`` has the rows_ of each slot_, at most 2**SLOT_BITS rows a group. Beyond the quota's group (quota above
    its size) the range is empty and behind all rows.
    """
    order = Window.partitionBy(*by).orderBy("slot_").rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.withColumn("reached_", before + F.sum("rows_").over(order))
    at_edge = F.min(F.when(F.col("reached_") >= quota, F.struct("slot_", "rows_", "reached_"))).alias("e_")
    carried = [F.max(c).alias(c) for c in ("n_", "quota_", "low_")]
    found = reached.withColumn("low_", low).groupBy(*by).agg(at_edge, *carried)
    start = F.col("low_") + F.col("e_.slot_") * width
    return found.select(
        *by,
        "n_",
        "quota_",
        F.coalesce(start, F.lit(1 << HASH_BITS)).alias("lo_"),
        F.coalesce(start + width, F.lit(1 << HASH_BITS)).alias("hi_"),
        F.coalesce(F.col("e_.rows_"), F.lit(0)).alias("edge_rows_"),
        F.coalesce(F.col("e_.reached_") - F.col("e_.rows_"), F.col("n_")).alias("before_"),
    )


def _quota_edges(tagged: DataFrame, by: list[str], quota: Callable[[Column], Column]) -> DataFrame:
    """Per group (k_ columns) the hash range in which its quota ends, narrowed until it holds EDGE_ROWS rows at most.

    A radix selection: each round counts rows by the next SLOT_BITS bits of the hash, only in groups whose range still
    holds more, and only in that range. Counts combine before the shuffle, at most 2**SLOT_BITS a task and group. After
    all bits a range is one hash value, whose rows only a key repeated without end could make many.
    """
    width = 1 << (HASH_BITS - SLOT_BITS)
    group = Window.partitionBy(*by)  # at most 2**SLOT_BITS rows per group
    counts = tagged.withColumn("slot_", F.floor(F.col("hash_") / width)).groupBy(*by, "slot_").agg(F.count(F.lit(1)).alias("rows_"))
    sized = counts.withColumn("n_", F.sum("rows_").over(group)).withColumn("quota_", quota(F.col("n_")).cast("bigint"))
    edges = settle(_named(_narrowed(sized, by, F.col("quota_"), F.lit(0), F.lit(0).cast("bigint"), width), by), "edges")
    while width > 1:
        wide = (F.col("edge_rows_") > EDGE_ROWS) & (F.col("hi_") - F.col("lo_") > 1)
        if edges.filter(wide).isEmpty():
            break
        step = max(1, width >> SLOT_BITS)
        rows = _attach(tagged, settle(edges.filter(wide), "wide") if by else edges, by)
        inside = rows.filter((F.col("hash_") >= F.col("lo_")) & (F.col("hash_") < F.col("hi_")))
        slots = inside.withColumn("slot_", F.floor((F.col("hash_") - F.col("lo_")) / step))
        same = [F.max(c).alias(c) for c in ("n_", "quota_", "lo_", "before_")]
        counts = slots.groupBy(*by, "slot_").agg(F.count(F.lit(1)).alias("rows_"), *same)
        narrow = _named(_narrowed(counts, by, F.col("quota_"), F.col("before_"), F.col("lo_"), step), by)
        edges = settle(edges.filter(~wide).unionByName(narrow), "edges")
        width = step
    return edges


def _named(edges: DataFrame, by: list[str]) -> DataFrame:
    return edges.withColumnsRenamed({c: f"k_{c}" for c in by})


def mark_by_hash(
    df: DataFrame,
    quota: Callable[[Column], Column],
    key: Sequence[str],
    by: Sequence[str] = (),
    seed: int = 42,
    mark: str = "taken",
) -> DataFrame:
    """Adds a boolean: is the row among the first ``quota(group size)`` of its group in hash order?

    Rows outside the range in which a group's quota ends are decided where they are; only that range, EDGE_ROWS rows at
    most however large the group, is shuffled and ranked. ``key`` must identify a row.
    """
    by, key = list(by), list(key)
    tagged = df.withColumn("hash_", hash32(seed, key))
    placed = _attach(tagged, _quota_edges(tagged, by, quota), by)
    inside = (F.col("hash_") >= F.col("lo_")) & (F.col("hash_") < F.col("hi_"))
    settled = placed.filter(~inside).withColumn(mark, F.col("hash_") < F.col("lo_"))
    order = Window.partitionBy(*by).orderBy("hash_", *key)
    at_edge = placed.filter(inside).withColumn(mark, F.row_number().over(order) <= F.col("quota_") - F.col("before_"))
    out = [*df.columns, mark]
    return settled.select(*out).unionByName(at_edge.select(*out))


def take_by_hash(
    df: DataFrame, quota: Callable[[Column], Column], key: Sequence[str], by: Sequence[str] = (), seed: int = 42
) -> DataFrame:
    """The first ``quota(group size)`` rows of each group in hash order."""
    return mark_by_hash(df, quota, key, by, seed, "taken_").filter("taken_").drop("taken_")


def _with_range(df: DataFrame, keys: list[str], key_type: str) -> DataFrame:
    """Adds ``part_``: how many splitters (JSON texts, ascending) lie below ``key_``.

    The search goes down three levels of FAN splitters each. The levels are literals of the plan, so no row
    carries them, and each level is a column of its own, so it is looked up once.
    """

    def literal(groups: list[list[str]]) -> Column:
        text = "[" + ",".join(f"[{','.join(g)}]" for g in groups) + "]"
        return F.from_json(F.lit(text), f"array<array<{key_type}>>")

    out = df.withColumn("place_", F.lit(1))
    for step in (FAN * FAN, FAN, 1):
        width = step * FAN
        groups = [keys[i : i + width : step] for i in range(0, len(keys), width)]
        place = F.greatest(F.col("place_"), F.lit(1))
        below = F.size(F.filter(F.element_at(literal(groups), place), lambda s: s["key_"] < F.col("key_")))
        out = out.withColumn("below_", below)
        out = out.withColumn("place_", F.when(F.col("place_") == 0, 0).otherwise((place - 1) * FAN + F.col("below_")))
    return out.withColumn("part_", F.col("place_")).drop("place_", "below_")


def _splitters(keyed: DataFrame) -> list[str]:
    """Up to SPLITTERS keys of the column ``key_`` as JSON, ascending; a null sorts first, into the first range."""
    usable = keyed.select("key_").filter(F.col("key_").isNotNull())
    sample = usable.orderBy(F.xxhash64("key_"), "key_").limit(SPLITTERS)
    return [r["k"] for r in sample.orderBy("key_").select(F.to_json(F.struct("key_")).alias("k")).collect()]


def slice_in_order(df: DataFrame, order: Sequence[str], skip: int, take: int) -> tuple[DataFrame, int]:
    """Rows skip + 1 to skip + take in ascending ``order``, and the number of all rows.

    A sample tells between which two keys the rows should lie; one pass counts the rows before and between them. What
    lies between is sampled again until it is SLICE_ROWS rows at most, and only that is sorted, so a slice far down costs
    the same as the first. Counts decide: where the sample misled, its margin is widened. Rows that agree in all of
    ``order`` stay together.
    """
    order = list(order)
    rows = df.withColumn("key_", F.struct(*order))
    kinds = [f.dataType for f in rows.schema["key_"].dataType.fields]
    total = size = rows.count()
    if skip >= total:
        return df.limit(0), total
    before, margin = 0, SLICE_MARGIN

    def key(values: Sequence) -> Column:
        return F.struct(*[F.lit(v).cast(kind).alias(c) for v, kind, c in zip(values, kinds, order, strict=True)])

    while size > SLICE_ROWS:
        sample = rows.select("key_").orderBy(F.rand(size)).limit(SLICE_SAMPLE).orderBy("key_").collect()
        first = int((skip - before) / size * len(sample)) - margin
        last = int((skip + take - before) / size * len(sample)) + 1 + margin
        low = F.col("key_") >= key(sample[first]["key_"]) if first >= 0 else F.lit(True)
        high = F.col("key_") <= key(sample[last]["key_"]) if last < len(sample) else F.lit(True)
        lower, inside = rows.agg(F.count_if(~low), F.count_if(low & high)).first()
        if inside == size:
            break
        if before + lower > skip or before + lower + inside < min(skip + take, total):
            margin *= 4
            continue
        rows, before, size = rows.filter(low & high), before + lower, inside
    return rows.orderBy(*order).offset(skip - before).limit(take).drop("key_"), total


def running_totals(df: DataFrame, order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Adds inclusive running sums over the whole frame in ascending ``order``.

    The order columns are numbers or strings and identify a row. The frame is written once, since the
    splitters, the range totals and the result all read it.
    """
    order = list(order)
    keyed = settle(df.withColumns({f"in_{name}": value for name, value in sums.items()}), "ranked")
    keyed = keyed.withColumn("key_", F.col(order[0]) if len(order) == 1 else F.struct(*order))
    keys = _splitters(keyed)
    if not keys:  # at most one row, with a null key
        return keyed.select(*df.columns, *[F.col(f"in_{name}").alias(name) for name in sums])
    placed = _with_range(keyed, keys, f"struct<key_:{keyed.schema['key_'].dataType.simpleString()}>")
    totals = placed.groupBy(F.col("part_").alias("p_")).agg(*[F.sum(f"in_{n}").alias(f"t_{n}") for n in sums])
    earlier = Window.orderBy("p_").rowsBetween(Window.unboundedPreceding, -1)  # at most SPLITTERS + 1 rows
    shifts = totals.select(
        "p_", *[F.coalesce(F.sum(f"t_{n}").over(earlier), F.lit(0)).alias(f"s_{n}") for n in sums]
    )
    here = Window.partitionBy("part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # shifts holds at most SPLITTERS + 1 rows, so its broadcast cannot grow with the data
    joined = placed.join(F.broadcast(shifts), F.col("part_") == F.col("p_"))
    return joined.select(
        *df.columns, *[(F.sum(f"in_{n}").over(here) + F.col(f"s_{n}")).alias(n) for n in sums]
    )
