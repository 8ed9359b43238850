"""Marts: the wide daily table from six daily legs, and the sleep detail table.

Two joins of the six legs are offered and never swapped silently:

* ``full_outer_chain`` (J1) reproduces the warehouse model exactly: readiness
  is the anchor, sleep and activity join on readiness' day, the other three on
  ``coalesce(sleep, activity, readiness)``. A day without readiness can
  therefore yield two rows, and a day with only the last three legs three rows.
* ``full_outer_on_key`` (J2) is "one row per key and day".

Both have three forms. ``join`` chains joins and takes any legs; duplicates multiply. ``grouped``
(one shuffle) gives the same rows where each leg has at most one row per key; it counts the rows of
every leg in the same aggregation and fails on a leg with more, so rows are never blended.
``product`` takes any legs with one shuffle of their rows: a key's rows are gathered in an array per
leg and multiplied by generators. A key with more than ``SPLIT`` rows in a leg is cut into parts:
that leg's rows are dealt to the parts, those of its other legs go to each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

# The wellness legs in join order, and the columns each leg
# contributes to the daily mart as (staged column, mart column).
LEGS = ("ready", "sleep", "act", "spo2", "stress", "res")
WELLNESS_COLUMNS = {
    "ready": (("readiness_score", "readiness_score"),),
    "act": (("steps", "steps"), ("calories", "calories")),
    "sleep": (("sleep_score", "sleep_score"), ("efficiency_score", "sleep_efficiency")),
    "spo2": (("avg_spo2_pct", "avg_spo2_pct"),
             ("breathing_disturbance_index", "breathing_disturbance_index")),
    "stress": (("stress_high", "stress_high"), ("recovery_high", "recovery_high"),
               ("stress_summary", "stress_summary")),
    "res": (("resilience_level", "resilience_level"),
            ("sleep_recovery_score", "sleep_recovery_score"),
            ("daytime_recovery_score", "daytime_recovery_score"),
            ("stress_score", "resilience_stress_score")),
}
STAGED_FOR_LEG = {"ready": "readiness", "act": "activity", "sleep": "sleep", "spo2": "spo2",
                  "stress": "stress", "res": "resilience"}
# Output column order of the daily mart (after keys and day).
_OUT_ORDER = ("ready", "act", "sleep", "spo2", "stress", "res")
# Order of the day coalesce in the output.
_DAY_ORDER = ("sleep", "act", "ready", "spo2", "stress", "res")


def wellness_legs(staged: Mapping[str, DataFrame], keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Select and rename each staged daily table into its mart leg."""
    out = {}
    for leg, cols in WELLNESS_COLUMNS.items():
        df = staged[STAGED_FOR_LEG[leg]]
        out[leg] = df.select(*keys, "day", *[F.col(s).alias(m) for s, m in cols])
    return out


def _value_cols(df: DataFrame, keys: Sequence[str], day: str) -> list[str]:
    return [c for c in df.columns if c not in (*keys, day)]


def _valid(keys: Sequence[str], day: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, day)])


def _lone_nulls(u: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Add ``_lone``: NULL for rows with a full key, a unique id otherwise.

    A join never matches a NULL key, so such rows must stay on their own when
    grouping; the id keeps them apart in the same single pass (no second scan).
    """
    return u.withColumn("_lone", F.when(_valid(keys, day), F.lit(None).cast("long"))
                        .otherwise(F.monotonically_increasing_id()))


def _refuse_duplicates(g: DataFrame, legs: Sequence[str], kd: Sequence[str]) -> DataFrame:
    """Fail where a leg brought more than one row for a key (counts ``_c_<leg>``)."""
    out = g
    for leg in legs:
        said = F.concat(F.lit(f"leg {leg} has several rows for "), F.to_json(F.struct(*kd)),
                        F.lit("; use method='join'"))
        out = out.where(F.when(F.col(f"_c_{leg}") <= 1, F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))
    return out


def full_outer_chain(legs: Mapping[str, DataFrame], keys: Sequence[str] = (), day: str = "day",
                     method: str = "join") -> DataFrame:
    """J1, the faithful chain. ``method="grouped"`` fails unless legs are unique per key and day."""
    if method == "grouped":
        return _chain_grouped(legs, keys, day)
    if method == "product":
        g = _gathered({n: legs[n] for n in LEGS}, keys, day)
        r, s, a = (_has(n) for n in ("ready", "sleep", "act"))
        xs = ("spo2", "stress", "res")
        lone = ~r & ~s & ~a
        branches = [(r, ("ready", "sleep", "act", *xs)), (~r & s, ("sleep", *xs)), (~r & a, ("act", *xs)),
                    *[(lone & _has(x), (x,)) for x in xs]]
        vals = [c for n in _OUT_ORDER for c in _value_cols(legs[n], keys, day)]
        return _multiplied(g, legs, keys, day, branches).select(*keys, day, *vals)
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    kd = [*keys, day]

    def pref(name: str) -> DataFrame:
        df = legs[name]
        return df.select(*[F.col(c).alias(f"{name}__{c}") for c in kd],
                         *_value_cols(df, keys, day))

    def eq(a: str, b_cols: Sequence[Column]) -> Column:
        return reduce(lambda x, y: x & y,
                      [F.col(f"{a}__{c}") == bc for c, bc in zip(kd, b_cols)])

    r, s, a = pref("ready"), pref("sleep"), pref("act")
    j = r.join(s, eq("sleep", [F.col(f"ready__{c}") for c in kd]), "full_outer")
    j = j.join(a, eq("act", [F.col(f"ready__{c}") for c in kd]), "full_outer")
    base = [F.coalesce(*[F.col(f"{n}__{c}") for n in ("sleep", "act", "ready")]) for c in kd]
    for name in ("spo2", "stress", "res"):
        j = j.join(pref(name), eq(name, base), "full_outer")
    out_kd = [F.coalesce(*[F.col(f"{n}__{c}") for n in _DAY_ORDER]).alias(c) for c in kd]
    vals = [c for n in _OUT_ORDER for c in _value_cols(legs[n], keys, day)]
    return j.select(*out_kd, *vals)


def _chain_grouped(legs: Mapping[str, DataFrame], keys: Sequence[str], day: str) -> DataFrame:
    """J1 with one shuffle: group all legs by (keys, day), then emit J1's rows.

    Per key and day, with R/S/A/X1/X2/X3 the six legs: if R is present one row
    (R, S, A); otherwise one row per present S and A. When any of those rows
    exist each carries X1..X3; otherwise X1, X2 and X3 each get their own row.
    Rows with a NULL key or day never match in the join form, so they stay
    single-leg rows here as well.
    """
    kd = [*keys, day]
    vcols = {n: _value_cols(legs[n], keys, day) for n in LEGS}
    tagged = []
    for n in LEGS:
        df = legs[n]
        st = F.struct(*[F.col(c) for c in vcols[n]])
        others = [F.lit(None).alias(f"_{m}") for m in LEGS if m != n]
        tagged.append(df.select(*kd, st.alias(f"_{n}"), *others))
    # Align struct types of the NULL placeholders through unionByName.
    schema_of = {n: tagged[i].schema[f"_{n}"].dataType for i, n in enumerate(LEGS)}
    tagged = [t.select(*kd,
                       *[F.col(f"_{m}").cast(schema_of[m]).alias(f"_{m}") for m in LEGS])
              for t in tagged]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    g = (_lone_nulls(u, keys, day).groupBy(*kd, "_lone")
         .agg(*[F.first(f"_{m}", ignorenulls=True).alias(f"_{m}") for m in LEGS],
              *[F.count(f"_{m}").alias(f"_c_{m}") for m in LEGS]))
    g = _refuse_duplicates(g, LEGS, kd)

    def row(valid_c: Column, present: Sequence[str]) -> Column:
        fields = [valid_c.alias("ok")]
        for m in LEGS:
            fields.append((F.col(f"_{m}") if m in present else F.lit(None).cast(schema_of[m])).alias(m))
        return F.struct(*fields)

    R, S, A = (F.col("_ready").isNotNull(), F.col("_sleep").isNotNull(), F.col("_act").isNotNull())
    none_base = ~R & ~S & ~A
    xs = ("spo2", "stress", "res")
    cands = F.array(
        row(R, ("ready", "sleep", "act", *xs)),
        row(~R & S, ("sleep", *xs)),
        row(~R & A, ("act", *xs)),
        row(none_base & F.col("_spo2").isNotNull(), ("spo2",)),
        row(none_base & F.col("_stress").isNotNull(), ("stress",)),
        row(none_base & F.col("_res").isNotNull(), ("res",)),
    )
    ex = g.select(*kd, F.explode(F.filter(cands, lambda r: r["ok"])).alias("_r"))
    vals = [F.col("_r")[n][c].alias(c) for n in _OUT_ORDER for c in vcols[n]]
    return ex.select(*kd, *vals)


#: Rows of a leg for one key that are gathered in one array at most.
SPLIT = 4096
#: Split keys up to which their table is broadcast; beyond, it is joined by a shuffle.
FEW_SPLIT = 10_000


def _gathered(legs: Mapping[str, DataFrame], keys: Sequence[str], day: str) -> DataFrame:
    """Per (keys, day, part): an array of each leg's rows, and which leg (if any) the key was split by.

    A key whose rows of one leg exceed ``SPLIT`` gets as many parts as that leg, its largest, fills. The
    counts that decide it are combined map-side; only keys beyond the limit are kept (at most the rows of
    all legs divided by ``SPLIT``).
    """
    kd = [*keys, day]
    counts = reduce(lambda a, b: a.unionByName(b), [
        df.where(_valid(keys, day)).groupBy(*kd).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SPLIT)
        .withColumn("_split", F.lit(n)) for n, df in legs.items()])
    split = counts.groupBy(*kd).agg(F.max_by(F.struct("_split", "_n"), F.struct("_n", "_split")).alias("_m"))
    split = stored(split.select(*[F.col(c).alias(f"_k_{c}") for c in kd], F.col("_m._split").alias("_split"),
                                F.ceil(F.col("_m._n") / SPLIT).cast("int").alias("_parts")), "split-keys")
    many = split.limit(FEW_SPLIT + 1).count()

    names, tagged = list(legs), []
    types = {n: legs[n].select(F.struct(*_value_cols(legs[n], keys, day)).alias("s")).schema["s"].dataType for n in names}
    for n in names:
        row = F.struct(*[F.col(c) for c in _value_cols(legs[n], keys, day)])
        rows = legs[n].select(*kd, *[(row if m == n else F.lit(None)).cast(types[m]).alias(f"_{m}") for m in names])
        if many:
            same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_k_{c}") for c in kd])
            rows = rows.join(F.broadcast(split) if many <= FEW_SPLIT else split, same, "left")
            own = F.array(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")).cast("int"))
            every = F.sequence(F.lit(0), F.col("_parts") - 1)
            part = F.when(F.col("_parts").isNull(), F.array(F.lit(0))).when(F.col("_split") == n, own).otherwise(every)
            rows = rows.select(*kd, *[f"_{m}" for m in names], "_split", F.explode(part).alias("_part"))
        else:
            rows = rows.select("*", F.lit(None).cast("string").alias("_split"), F.lit(0).alias("_part"))
        tagged.append(rows)
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    return _lone_nulls(u, keys, day).groupBy(*kd, "_lone", "_part").agg(
        F.max("_split").alias("_split"), *[F.collect_list(f"_{m}").alias(f"_{m}") for m in names])


def _has(leg: str) -> Column:
    """The key has rows of the leg, in this part or (if it is the split one) in another."""
    return (F.size(f"_{leg}") > 0) | F.coalesce(F.col("_split") == leg, F.lit(False))


def _multiplied(g: DataFrame, legs: Mapping[str, DataFrame], keys: Sequence[str], day: str,
                branches: Sequence[tuple[Column, Sequence[str]]]) -> DataFrame:
    """The rows of each branch that applies: the product of its legs' arrays, absent legs as NULLs.

    In a split key a branch with the split leg runs where that leg has rows, any other one in part 0 only.
    The product is streamed through one generator per leg and never held.
    """
    names, kd = list(legs), [*keys, day]
    flags = []
    for test, members in branches:
        held = reduce(lambda a, b: a | b, [(F.col("_split") == m) & (F.size(f"_{m}") > 0) for m in members])
        here = F.when(F.col("_split").isNull(), F.lit(True)).when(
            F.col("_split").isin(*members), held).otherwise(F.col("_part") == 0)
        flags.append(F.when(test & here, F.array(*[F.lit(m in members) for m in names])))
    rows = g.select(*kd, *[f"_{m}" for m in names], F.explode(F.array_compact(F.array(*flags))).alias("_in"))
    for i, m in enumerate(names):
        rest = [f"_{x}" if j > i else f"_row_{x}" for j, x in enumerate(names) if j != i]
        rows = rows.select(*kd, "_in", *rest, F.explode_outer(F.when(F.col("_in")[i], F.col(f"_{m}"))).alias(f"_row_{m}"))
    return rows.select(*kd, *[F.col(f"_row_{m}")[c].alias(c) for m in names for c in _value_cols(legs[m], keys, day)])


def full_outer_on_key(legs: Mapping[str, DataFrame] | Sequence[DataFrame], keys: Sequence[str] = (),
                      day: str = "day", method: str = "grouped") -> DataFrame:
    """Full outer join of all legs on (keys, day); key columns coalesced.

    ``method="grouped"`` (one shuffle) fails on a leg with more than one row for a
    key; ``method="product"`` (one shuffle) and ``method="join"`` (a join per leg) accept anything.
    """
    frames = list(legs.values()) if isinstance(legs, Mapping) else list(legs)
    kd = [*keys, day]
    if method == "product":
        named = dict(legs) if isinstance(legs, Mapping) else {f"l{i}": f for i, f in enumerate(frames)}
        return _multiplied(_gathered(named, keys, day), named, keys, day, [(F.lit(True), tuple(named))])
    if method == "join":
        return reduce(lambda a, b: a.join(b, kd, "full_outer"), frames)
    if method != "grouped":
        raise ValueError(f"unknown method {method!r}")
    names = list(legs) if isinstance(legs, Mapping) else [str(i) for i in range(len(frames))]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
               [f.withColumn("_leg", F.lit(n)) for f, n in zip(frames, names)])
    vals = [c for f in frames for c in _value_cols(f, keys, day)]
    g = (_lone_nulls(u, keys, day).groupBy(*kd, "_lone")
         .agg(*[F.first(c, ignorenulls=True).alias(c) for c in vals],
              *[F.count_if(F.col("_leg") == n).alias(f"_c_{n}") for n in names]))
    return _refuse_duplicates(g, names, kd).select(*kd, *vals)


# Sleep detail columns, from the sleep periods and the sleep
# time recommendation tables.
SLEEP_PERIOD_COLUMNS = (
    "id", "day", "sleep_type", "bedtime_start", "bedtime_end", "total_sleep_duration",
    "deep_sleep_duration", "light_sleep_duration", "rem_sleep_duration", "awake_time",
    "time_in_bed", "efficiency", "latency", "avg_hr", "avg_hrv", "lowest_hr", "avg_breath",
    "restless_periods",
)
SLEEP_TIME_COLUMNS = ("sleep_recommendation", "optimal_bedtime_start_offset",
                      "optimal_bedtime_end_offset")


def sleep_detail(periods: DataFrame, sleep_time: DataFrame, keys: Sequence[str] = (),
                 period_cols: Sequence[str] = SLEEP_PERIOD_COLUMNS,
                 time_cols: Sequence[str] = SLEEP_TIME_COLUMNS) -> DataFrame:
    """Every sleep period with the day's recommendation(s) (left join on keys, day).

    The join strategy is left to AQE: the recommendation table grows with
    entities and days, so it is not forced into a broadcast.
    """
    sp = periods.select(*keys, *[c for c in period_cols if c not in keys])
    st = sleep_time.select(*keys, "day", *time_cols)
    out = sp.join(st, [*keys, "day"], "left")
    return out.select(*keys, *[c for c in period_cols if c not in keys], *time_cols)
