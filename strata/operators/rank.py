"""Distributed exact ordering statistics: cumulative counts, ranks, quantiles.

A global ``Window.orderBy`` without ``partitionBy`` runs in ONE task.  Instead:

1. ``groupBy(groups, value).agg(count, weights)`` -- partial aggregation, so a
   value that holds a third of all rows is one row after the map side;
2. per group, ``percentile_approx`` picks P-1 bucket boundaries over the
   *distinct* values (P follows the number of distinct values);
3. every distinct value gets ``bucket = #boundaries < value``;
4. per-(group, bucket) totals are summed before each bucket by a window over
   the bucket table;
5. a window partitioned by (group, bucket) adds the in-bucket running sum.

The result is exact (same as a single global sort) and every step is
partitioned.  It is the building block for pandas-style percentile ranks and
AUC / ROC / PR curves.

A few ranks (quantiles, split and fold cuts) need no order of all values:
:func:`select_ranks` brackets each wanted rank by ``percentile_approx``, counts
the rows below the bracket and looks at the values inside it only -- a small
share of the rows, narrowed again while they are many.  Quantiles of several
columns are bracketed side by side, without a long table of all values.

NULL and NaN have no rank.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import default_parallelism

# up to this many groups their sizes are listed on the driver and broadcast; more stay distributed
MAX_GROUPS = 1024
# distinct-value tables of at most this size (rows x widest row, measured) are broadcast when
# joined back to the rows: the big side is then never shuffled, so a hot value cannot skew it
BROADCAST_BYTES = 32 << 20
# groups with at most this many distinct values are ranked in one window partition each; larger
# ones get a bucket per so many
SINGLE_BUCKET_MAX = 100_000
# rows inside the brackets of wanted ranks that are looked at one by one
BRACKET_ROWS = 200_000


def _ranked_only(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` have a rank: neither NULL nor NaN."""
    for c in cols:
        ok = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(c)
        df = df.where(ok)
    return df


def _order_key(df: DataFrame, c: str) -> Column:
    """A double that never decreases with the column; ties of it are broken by the column itself."""
    t = df.schema[c].dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.conv(F.hex(F.rpad(F.substring(F.col(c).cast("binary"), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    if isinstance(t, (T.DateType, T.TimestampType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def ordered_counts(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                   weights: Mapping[str, Column] | None = None, descending: bool = False,
                   buckets: int | None = None, accuracy: int = 10000,
                   single_bucket_max: int = SINGLE_BUCKET_MAX) -> DataFrame:
    """One row per distinct ``(group_cols, order_cols)`` with exact running totals.

    Output columns: group cols, order cols, ``cnt`` (rows with this value),
    ``cum`` (rows ordered at or before it within the group), ``cum_before``
    (= cum - cnt), ``idx`` (1-based dense position), ``total`` (rows in group);
    for every weight ``w``: ``w``, ``cum_w``, ``cum_before_w``, ``total_w``.
    Order is ascending on ``order_cols`` (descending if asked); NULL order values
    are dropped (they have no rank).
    """
    spark = df.sparkSession
    weights = dict(weights or {})
    order_cols = list(order_cols)
    gcols = list(group_cols)
    if not gcols:
        df = df.withColumn("_grp", F.lit(0))
        gcols = ["_grp"]
        drop_grp = True
    else:
        drop_grp = False
    keep = _ranked_only(df, order_cols)
    aggs = [F.count(F.lit(1)).alias("cnt")] + [F.sum(e).alias(n) for n, e in weights.items()]
    g = keep.groupBy(*gcols, *order_cols).agg(*aggs)
    sign = -1.0 if descending else 1.0
    g = g.withColumn("_k", _order_key(g, order_cols[0]) * F.lit(sign))

    sizes = g.groupBy(*gcols).agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("_ndist"),
                                  *[F.sum(n).alias(f"total_{n}") for n in weights])
    size_rows = sizes.limit(MAX_GROUPS + 1).collect()
    listed = len(size_rows) <= MAX_GROUPS and sum(len(str(r)) for r in size_rows) <= BROADCAST_BYTES
    n_distinct = sum(r["_ndist"] for r in size_rows) if listed else None
    largest = max((r["_ndist"] for r in size_rows), default=0)
    if listed:
        sizes = F.broadcast(spark.createDataFrame([tuple(r) for r in size_rows], sizes.schema))
    else:
        largest = sizes.agg(F.max("_ndist")).first()[0]
    # NULL groups are groups like others
    keyed = null_safe_join(g, sizes, gcols)
    zero_offsets = {"_oc": F.lit(0).cast("long"), "_od": F.lit(0).cast("long"),
                    **{f"_ow_{n}": F.lit(0).cast(g.schema[n].dataType) for n in weights}}
    # cold groups (<= single_bucket_max distinct values each): one window partition per group
    res = keyed.where(F.col("_ndist") <= single_bucket_max).withColumns({"_bucket": F.lit(0), **zero_offsets})
    if largest > single_bucket_max:
        p = max(2, buckets or max(default_parallelism(spark), -(-largest // max(1, single_bucket_max))))
        hot = _hot_groups(keyed.where(F.col("_ndist") > single_bucket_max), gcols, weights, p, accuracy, listed)
        res = res.unionByName(hot)
    out = _finish(res, gcols, order_cols, weights, descending, drop_grp)
    out._strata_distinct = n_distinct
    return out


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the right side's keys are dropped."""
    names = {k: f"_r_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    on = [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    return left.join(right, on, how).drop(*names.values())


def _hot_groups(rows: DataFrame, gcols, weights, p: int, accuracy: int, listed: bool) -> DataFrame:
    """Groups with many distinct values: p value buckets from approximate quantiles and exact
    per-bucket totals, summed before each bucket, so each window partition is one bucket.
    ``listed``: the groups are few and their tables are broadcast."""
    hint = F.broadcast if listed else (lambda df: df)
    probs = [i / p for i in range(1, p)]
    bounds = rows.groupBy(*gcols).agg(
        F.array_sort(F.array_distinct(F.percentile_approx("_k", probs, max(accuracy, 10 * p)))).alias("_b"))
    gb = null_safe_join(rows, hint(bounds), gcols).withColumn("_bucket", _bucket_of(F.col("_b"), F.col("_k"), p)).drop("_b")
    before = Window.partitionBy(*gcols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = gb.groupBy(*gcols, "_bucket").agg(
        F.sum("cnt").alias("_oc"), F.count(F.lit(1)).alias("_od"), *[F.sum(n).alias(f"_ow_{n}") for n in weights])
    sums = ["_oc", "_od", *[f"_ow_{n}" for n in weights]]
    offsets = totals.select(*gcols, "_bucket", *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).cast(totals.schema[c].dataType).alias(c) for c in sums])
    return null_safe_join(gb, hint(offsets), [*gcols, "_bucket"])


def _bucket_of(bounds: Column, k: Column, p: int) -> Column:
    """Number of (sorted) boundaries below ``k`` -- a two-level search.

    Every ``blk``-th boundary forms a coarse index; counting the coarse entries
    below ``k`` fixes the block, then only that block is scanned: about 2 * sqrt(P)
    comparisons per distinct value instead of P.
    """
    blk = max(1, math.isqrt(p))
    coarse = F.filter(bounds, lambda x, i: ((i + 1) % blk == 0) & (x < k))
    c = F.size(coarse)
    block = F.slice(bounds, c * blk + 1, blk)
    return c * blk + F.size(F.filter(block, lambda x: x < k))


def _finish(res: DataFrame, gcols, order_cols, weights, descending: bool, drop_grp: bool) -> DataFrame:
    """In-bucket running sums plus the bucket offsets."""
    orderings = [F.col("_k").asc()] + [
        (F.col(c).desc() if descending else F.col(c).asc()) for c in order_cols]
    w = (Window.partitionBy(*gcols, "_bucket").orderBy(*orderings)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    res = res.withColumn("cum", F.col("_oc") + F.sum("cnt").over(w))
    res = res.withColumn("idx", F.col("_od") + F.count(F.lit(1)).over(w))
    res = res.withColumn("cum_before", F.col("cum") - F.col("cnt"))
    for n in weights:
        res = res.withColumn(f"cum_{n}", F.col(f"_ow_{n}") + F.sum(n).over(w))
        res = res.withColumn(f"cum_before_{n}", F.col(f"cum_{n}") - F.col(n))
    out = gcols + order_cols + ["cnt", "cum", "cum_before", "idx", "total"]
    for n in weights:
        out += [n, f"cum_{n}", f"cum_before_{n}", f"total_{n}"]
    res = res.select(*out)
    if drop_grp:
        res = res.drop("_grp")
    return res


def select_ranks(df: DataFrame, group: str, order_cols: Sequence[str], wanted: Mapping, accuracy: int = 10000) -> dict:
    """The values of ``order_cols`` at the wanted ranks: ``{group value: {rank: tuple}}``.

    ``wanted``: ``{group value: ranks}`` (0-based, among the group's rows without NULL and NaN, in the
    order of ``order_cols``).  Each rank gets a bracket of the first order column; one aggregation counts
    the rows below and inside the brackets.  Brackets that miss their rank are widened, brackets that hold
    more than ``BRACKET_ROWS`` rows are narrowed, then the rows inside are counted by value.  Only numbers per
    bracket and the value at its rank reach the driver; rows are never shuffled
    but those inside.  A bracket of one hot value that further columns must order is left to
    :func:`ordered_counts`.
    """
    df = _ranked_only(df, order_cols)
    df = df.withColumn("_k", _order_key(df, order_cols[0]))
    inf = float("inf")
    # bracket: rank, bounds of the key, rows below and inside, margin of the next bounds
    state = [{"g": g, "r": r, "lo": -inf, "hi": inf, "below": 0, "inside": None, "d": 2.0 / accuracy}
             for g, ranks in wanted.items() for r in sorted(set(ranks))]

    def shared(which, bounds):
        """For each rank the first rank that has the same bracket."""
        first: dict = {}
        return {i: first.setdefault((state[i]["g"], bounds[i]), i) for i in which}

    def in_brackets(which, bounds):
        """The rows inside the brackets, once for each distinct bracket, with its first rank's number."""
        which = sorted(set(shared(which, bounds).values()))
        if all(bounds[i] == (-inf, inf) for i in which):  # whole groups
            number = None
            for i in which:
                match = F.col(group).isNull() if state[i]["g"] is None else F.col(group) == F.lit(state[i]["g"])
                number = F.when(match, i) if number is None else number.when(match, i)
            return df.withColumn("i", number).where(F.col("i").isNotNull())
        expr = None
        for g in {state[i]["g"] for i in which}:
            own = [(i, F.col("_k").between(*bounds[i])) for i in which if state[i]["g"] == g]
            match = F.col(group).isNull() if g is None else F.col(group) == F.lit(g)
            match = match & reduce(or_, (inside for _, inside in own))  # a row outside all brackets makes no array
            ids = F.array(*[F.when(inside, i) for i, inside in own])
            expr = F.when(match, ids) if expr is None else expr.when(match, ids)
        return df.select("*", F.explode(expr).alias("i")).where(F.col("i").isNotNull())

    open_ = list(range(len(state)))
    while open_:
        bounds = {i: (state[i]["lo"], state[i]["hi"]) for i in open_}
        first = shared(open_, bounds)
        sizes = {r["i"]: r["n"] for r in in_brackets(open_, bounds).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
        for i in open_:
            state[i]["inside"] = sizes.get(first[i], 0)
        open_ = [i for i in open_ if state[i]["inside"] > BRACKET_ROWS and state[i]["lo"] < state[i]["hi"]]
        if not open_:
            break
        share = {i: (state[i]["r"] - state[i]["below"] + 0.5) / state[i]["inside"] for i in open_}
        probs = {i: [max(0.0, share[i] - state[i]["d"]), min(1.0, share[i] + state[i]["d"])] for i in open_}
        every = sorted({p for i in open_ for p in probs[i]})
        found = {r["i"]: dict(zip(every, r["q"])) for r in in_brackets(open_, bounds).groupBy("i").agg(
            F.percentile_approx("_k", every, accuracy).alias("q")).collect()}
        new = {i: (found[first[i]][probs[i][0]], found[first[i]][probs[i][1]]) for i in open_}
        once: dict = {}  # ranks with the same bracket before and now are counted once
        same = {i: once.setdefault((first[i], new[i]), i) for i in open_}
        counted = {r["_r"]: (r["b"], r["n"]) for r in in_brackets(open_, bounds).join(
            F.broadcast(df.sparkSession.createDataFrame([(first[i], i, *new[i]) for i in once.values()], "i int, _r int, _lo double, _hi double")), "i")
            .groupBy("_r").agg(F.count_if(F.col("_k") < F.col("_lo")).alias("b"),
                              F.count_if(F.col("_k").between(F.col("_lo"), F.col("_hi"))).alias("n")).collect()}
        below = {i: counted[same[i]] for i in open_}
        for i in open_:
            b, n = below[i]
            if b <= state[i]["r"] - state[i]["below"] < b + n and n < state[i]["inside"]:
                state[i].update(lo=new[i][0], hi=new[i][1], below=state[i]["below"] + b, d=2.0 / accuracy)
            else:
                state[i]["d"] *= 8
                if state[i]["d"] > 2:  # a value that can't be narrowed
                    state[i].update(lo=state[i]["hi"] if state[i]["lo"] == state[i]["hi"] else state[i]["lo"])
                    open_ = [j for j in open_ if j != i]
    many = [i for i, s in enumerate(state) if len(order_cols) > 1 and s["inside"] and s["inside"] > BRACKET_ROWS]
    out: dict = {g: {} for g in wanted}
    few = [i for i in range(len(state)) if i not in many]
    if few:
        bounds = {i: (state[i]["lo"], state[i]["hi"]) for i in few}
        first = shared(few, bounds)
        counts = in_brackets(few, bounds).groupBy("i", *order_cols).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("i").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranks = F.element_at(F.create_map(*[x for f in sorted(set(first.values())) for x in (
            F.lit(f), F.array(*[F.struct(F.lit(i).alias("r"), F.lit(state[i]["r"] - state[i]["below"]).cast("long").alias("at")) for i in few if first[i] == f]))]), F.col("i"))
        at = (counts.withColumn("_cum", F.sum("_n").over(upto))
              .select("*", F.explode(F.filter(ranks, lambda x: x["at"].between(F.col("_cum") - F.col("_n"), F.col("_cum") - 1))).alias("_at")))
        for r in at.collect():
            own = state[r["_at"]["r"]]
            out[own["g"]][own["r"]] = tuple(r[c] for c in order_cols)
    for i in many:
        s = state[i]
        match = F.col(group).isNull() if s["g"] is None else F.col(group) == F.lit(s["g"])
        oc = ordered_counts(df.where(match & F.col("_k").between(s["lo"], s["hi"])), order_cols)
        r = oc.where((F.col("cum_before") <= s["r"] - s["below"]) & (F.col("cum") > s["r"] - s["below"])).first()
        out[s["g"]][s["r"]] = tuple(r[c] for c in order_cols)
    return out


def percent_rank_avg(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                     out_col: str | None = None) -> DataFrame:
    """pandas ``rank(pct=True)``: (average rank of ties) / n, per group; NULL stays NULL.

    The distinct-value ranks come from :func:`ordered_counts` and are joined back
    to the rows on (group, value).  Their number is known from the first pass:
    up to ``BROADCAST_BYTES`` the rank table is broadcast (no shuffle of the
    rows, immune to hot values); beyond it the equi-join is left to the planner,
    whose AQE skew-join splits a hot value's partition.  NaN counts as missing.
    """
    out_col = out_col or f"{value_col}_pct"
    oc = ordered_counts(df, [value_col], group_cols)
    ranks = oc.select(*group_cols, value_col,
                      ((F.col("cum_before") + (F.col("cnt") + F.lit(1)) / F.lit(2.0))
                       / F.col("total")).alias(out_col))
    keys = list(group_cols) + [value_col]
    if _fits(ranks, oc, keys):
        ranks = F.broadcast(ranks)
    names = {k: f"_r_{i}" for i, k in enumerate(keys)}
    on = [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    return df.join(ranks.withColumnsRenamed(names), on, "left").drop(*names.values())


def _fits(ranks: DataFrame, counts: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a table of the distinct values is small enough to broadcast: its rows are counted, variable-width
    keys are measured."""
    n = getattr(counts, "_strata_distinct", None)
    if n is None:
        return False
    width = 8 + 8 * len(keys)
    if n * width > BROADCAST_BYTES:
        return False
    texts = [k for k in keys if isinstance(ranks.schema[k].dataType, (T.StringType, T.BinaryType))]
    if texts:
        width += ranks.agg(F.max(sum(F.coalesce(F.octet_length(k), F.lit(0)) for k in texts))).first()[0] or 0
    return n * width <= BROADCAST_BYTES


def percent_ranks(df: DataFrame, cols: Sequence[str], suffix: str = "_pct") -> DataFrame:
    """pandas ``rank(pct=True)`` for several columns with ONE distinct-value pass.

    The columns are unpivoted to ``(column, value)`` and ranked per column together;
    each column's rank table is then joined back on its value (broadcast when the
    measured distinct count is bounded, otherwise a planner-chosen equi-join).
    """
    cols = list(cols)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "_col", "_v")
    oc = ordered_counts(long, ["_v"], ["_col"])
    ranks = oc.select("_col", "_v", ((F.col("cum_before") + (F.col("cnt") + F.lit(1)) / F.lit(2.0))
                                     / F.col("total")).alias("_p"))
    small = _fits(ranks, oc, ["_v"])
    out = df
    for c in cols:
        rc = ranks.where(F.col("_col") == c).select(F.col("_v").alias(f"_k_{c}"), F.col("_p").alias(f"{c}{suffix}"))
        rc = F.broadcast(rc) if small else rc
        out = out.join(rc, F.col(c).cast("double") == F.col(f"_k_{c}"), "left").drop(f"_k_{c}")
    return out


def grouped_quantiles(df: DataFrame, value: str, group_cols: Sequence[str], probs: Sequence[float],
                      names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group as a DataFrame (nothing collected).

    From the distinct-value table, the (at most two) values around each wanted rank
    are picked by one grouped aggregate and interpolated -- scales with the number
    of groups.
    """
    gcols = list(group_cols)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    x = df.select(*gcols, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    oc = ordered_counts(x, ["_v"], gcols)
    inside = lambda r: (r >= F.col("cum_before")) & (r < F.col("cum"))
    aggs = []
    for i, p_ in enumerate(probs):
        pos = F.lit(float(p_)) * (F.col("total") - F.lit(1)).cast("double")
        aggs += [F.max(F.when(inside(F.floor(pos)), F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(inside(F.ceil(pos)), F.col("_v"))).alias(f"_hi{i}"),
                 F.first(pos - F.floor(pos)).alias(f"_fr{i}")]
    picked = oc.groupBy(*gcols).agg(*aggs)
    return picked.select(*gcols, *[
        (F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(n)
        for i, n in enumerate(names)])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> dict:
    """Exact linear-interpolated quantiles (pandas / DuckDB ``quantile_cont``).

    Returns ``{(group values..., column): [q(p) for p in probs]}``; columns with no
    value get ``None``.  Without groups the wanted ranks are bracketed
    (:func:`select_ranks`); with groups all distinct values are ordered.
    """
    gcols = list(group_cols)
    cols = list(cols)
    if not gcols:
        return _column_quantiles(df, cols, probs)
    long = df.select(*gcols, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        gcols, cols, "_col", "_v")
    long = long.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    oc = ordered_counts(long, ["_v"], gcols + ["_col"])
    need = []
    for p_ in probs:
        pos = F.lit(float(p_)) * (F.col("total") - F.lit(1)).cast("double")
        need += [F.floor(pos), F.ceil(pos)]
    hit = F.exists(F.array(*need), lambda r: (r >= F.col("cum_before")) & (r < F.col("cum")))
    rows = oc.where(hit).select(*gcols, "_col", "_v", "cum_before", "cum", "total").collect()
    by_group: dict = {}
    for r in rows:
        key = tuple(r[c] for c in gcols) + (r["_col"],)
        by_group.setdefault(key, []).append((r["cum_before"], r["cum"], r["_v"], r["total"]))
    result = {}
    for key, segs in by_group.items():
        segs.sort()
        n = segs[0][3]

        def at(rank):
            for lo, hi, v, _ in segs:
                if lo <= rank < hi:
                    return v
            raise RuntimeError("rank not found")  # pragma: no cover

        qs = []
        for p_ in probs:
            pos = float(p_) * float(n - 1)
            lo_r, hi_r = math.floor(pos), math.ceil(pos)
            lo_v, hi_v = at(lo_r), at(hi_r)
            qs.append(lo_v if hi_r == lo_r else lo_v + (pos - lo_r) * (hi_v - lo_v))
        result[key] = qs
    for gkey in {k[:-1] for k in result} or {()}:
        for c in cols:
            result.setdefault(gkey + (c,), [None] * len(probs))
    return result


def _column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    x = {c: F.col(c).cast("double") for c in cols}
    n = df.agg(*[F.count(F.when(~F.isnan(x[c]), x[c])).alias(f"n{i}") for i, c in enumerate(cols)]).first() if cols else []
    size = {c: n[i] for i, c in enumerate(cols) if n[i]}
    pos = {c: [float(p) * float(size[c] - 1) for p in probs] for c in size}
    ranks = {c: sorted({r for p in at for r in (math.floor(p), math.ceil(p))}) for c, at in pos.items()}
    values = _bracketed_values(df, x, {c: m for c, m in size.items() if m > BRACKET_ROWS}, ranks)
    left = {c: own for c in ranks if (own := [r for r in ranks[c] if r not in values.get(c, {})])}
    if left:
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_col"), x[c].alias("_v")) for c in left])))
        for c, own in select_ranks(long, "_col", ["_v"], left).items():
            values.setdefault(c, {}).update({r: v for r, (v,) in own.items()})

    def at(c, p):
        lo, hi = values[c][math.floor(p)], values[c][math.ceil(p)]
        return lo if lo == hi else lo + (p - math.floor(p)) * (hi - lo)

    return {(c,): [at(c, p) for p in pos[c]] if c in pos else [None] * len(probs) for c in cols}


def _bracketed_values(df: DataFrame, x: Mapping[str, Column], size: Mapping[str, int], ranks: Mapping[str, Sequence[int]],
                      accuracy: int = 10000) -> dict:
    """``{column: {rank: value}}`` of the columns in ``size`` (their rows with a value), side by side: one pass takes all brackets,
    one counts the rows below and inside them, one counts the values inside. The rows are never made longer but by those
    inside. A rank that its bracket misses, or whose bracket has more than ``BRACKET_ROWS`` rows between its ends, is left out."""
    if not size:
        return {}
    known = {c: F.when(~F.isnan(x[c]), x[c]) for c in size}
    share = {c: [(r + 0.5) / size[c] for r in ranks[c]] for c in size}
    ends = {c: [e for s in share[c] for e in (max(0.0, s - 2.0 / accuracy), min(1.0, s + 2.0 / accuracy))] for c in size}
    found = df.agg(*[F.percentile_approx(known[c], ends[c], accuracy) for c in size]).first()
    brackets: list[dict] = []
    for c, q in zip(size, found):
        for k, r in enumerate(ranks[c]):
            lo, hi, last = q[2 * k] + 0.0, q[2 * k + 1] + 0.0, brackets[-1] if brackets else None
            if last and last["c"] == c and lo <= last["hi"]:  # neighbours share a bracket
                last.update(hi=max(hi, last["hi"]), ranks=[*last["ranks"], r])
            else:
                brackets.append({"c": c, "lo": lo, "hi": hi, "ranks": [r]})

    def inside(b, ends_too=True):
        v, lo, hi = known[b["c"]], F.lit(b["lo"]), F.lit(b["hi"])
        return (v >= lo) & (v <= hi) if ends_too else (v > lo) & (v < hi)

    counts = df.agg(*[e for b in brackets for e in (F.count_if(known[b["c"]] < F.lit(b["lo"])), F.count_if(inside(b, b["lo"] == b["hi"])))]).first()
    out: dict = {c: {} for c in size}
    many = {}
    for i, b in enumerate(brackets):
        b["below"], n = counts[2 * i], counts[2 * i + 1]
        if b["lo"] == b["hi"]:
            out[b["c"]].update({r: b["lo"] for r in b["ranks"] if b["below"] <= r < b["below"] + n})
        elif n <= BRACKET_ROWS:
            many[i] = b
    if many:
        own = F.array(*[F.when(inside(b), F.struct(F.lit(i).alias("i"), known[b["c"]].alias("_v"))) for i, b in many.items()])
        rows = df.select(F.inline(F.filter(own, lambda e: e.isNotNull()))).groupBy("i", "_v").agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        wanted = F.element_at(F.create_map(*[e for i, b in many.items() for e in (
            F.lit(i), F.array(*[F.lit(r - b["below"]).cast("long") for r in b["ranks"]]))]), F.col("i"))
        at = rows.withColumn("_cum", F.sum("_n").over(upto)).select(
            "i", "_v", F.explode(F.filter(wanted, lambda r: r.between(F.col("_cum") - F.col("_n"), F.col("_cum") - 1))).alias("_at"))
        for r in at.collect():
            out[many[r["i"]]["c"]][r["_at"] + many[r["i"]]["below"]] = r["_v"]
    return out


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10000) -> dict:
    """One-pass approximate quantiles (Greenwald-Khanna via ``percentile_approx``)."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c)
                   for c in cols]).first()
    return {(c,): list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              method: str = "exact", accuracy: int = 10000) -> dict[str, list]:
    """``{column: [quantiles]}`` (ungrouped convenience wrapper)."""
    if method == "exact":
        res = exact_quantiles(df, cols, probs)
    elif method == "approx":
        res = approx_quantiles(df, cols, probs, accuracy)
    else:
        raise ValueError("method must be 'exact' or 'approx'")
    return {k[-1]: v for k, v in res.items()}
