"""User paths: ordered funnels, transitions, sessions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from growthkit.functions.columns import names, ratio
from growthkit.functions.slices import MOST, joined, micros, node_of, radix, slice_of
from growthkit.operators.metrics import with_users


def funnel_matches(
    events: DataFrame,
    steps: Sequence[str],
    key: str | Sequence[str],
    ts: str,
    event: str,
    grain: str = "hour",
) -> DataFrame:
    """Matched step times per key -> key, matched (microseconds, one per step reached).

    Step 1 is the key's first such event; each further step is the first one strictly
    after the matched step before it.

    Time is cut into slices. Inside a slice every step row learns how the path would go
    on from it to the end of the slice; a slice is thereby reduced to a function: the steps matched
    in it, if it is entered with so many steps done. Functions of neighbouring slices are
    composed, then those of neighbouring nodes of slices, until one is left for each key. No task has to hold all events, or all slices, of one
    key. Events without a key or a time are left out.
    """
    steps, key = list(steps), names(key)
    if not steps or len(set(steps)) != len(steps):
        raise ValueError("steps must be a non-empty list without repeats")
    step = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(event)).cast("int")
    rows = events.dropna(subset=key).where(F.col(event).isin(steps) & F.col(ts).isNotNull()).select(
        *key, slice_of(ts, grain).alias("__slice"), micros(ts).alias("__t"), step.alias("__step")
    )
    # Descending order: the rows strictly later than the current one come before it.
    later = (
        W.partitionBy(*key, "__slice").orderBy(F.col("__t").desc()).rangeBetween(W.unboundedPreceding, -1)
    )
    rows = rows.withColumn("__path", F.array("__t"))
    for at in range(len(steps) - 1, 0, -1):
        onward = F.min(F.when(F.col("__step") == at + 1, F.struct("__t", "__path"))).over(later)
        rows = rows.withColumn("__next", onward).withColumn(
            "__path",
            F.when(
                (F.col("__step") == at) & F.col("__next").isNotNull(),
                F.concat(F.array("__t"), F.col("__next.__path")),
            ).otherwise(F.col("__path")),
        )
    entries = [
        F.min(F.when(F.col("__step") == at, F.struct("__t", "__path"))).alias(f"__from{at}")
        for at in range(1, len(steps) + 1)
    ]
    nothing = F.array().cast("array<bigint>")
    slices = rows.groupBy(*key, "__slice").agg(*entries)
    paths = F.array(
        *[F.coalesce(F.col(f"__from{at}.__path"), nothing) for at in range(1, len(steps) + 1)]
    )
    nothing_of = F.array(*[nothing for _ in steps])

    def then(done, of_slice):
        more = F.transform(done, lambda p, at: F.concat(p, F.coalesce(F.get(of_slice["__paths"], at + F.size(p)), nothing)))
        return more

    slices = slices.select(*key, F.col("__slice").alias("__at"), paths.alias("__paths"))
    for _ in range(radix(grain)[1]):
        node = slices.groupBy(*key, node_of("__at", grain).alias("__node"))
        in_order = F.sort_array(F.collect_list(F.struct("__at", "__paths")))
        composed = node.agg(in_order.alias("__s")).withColumn("__paths", F.aggregate("__s", nothing_of, then))
        slices = composed.select(*key, F.col("__node").alias("__at"), "__paths")
    return slices.select(*key, F.get("__paths", F.lit(0)).alias("matched"))


def funnel(
    events: DataFrame,
    steps: Sequence[str],
    key: str | Sequence[str],
    ts: str,
    event: str,
    *,
    within: dt.timedelta | None = None,
    dims: str | Sequence[str] | None = None,
    users: DataFrame | None = None,
    user: str | None = None,
    grain: str = "hour",
) -> DataFrame:
    """Ordered funnel -> dims, step_no, step, n, from_prev, from_first.

    Counts keys (users, or user-days) that reach each step. `within` limits the time since
    the matched first step. `dims` are columns of `users`, joined on `user`, or part of `key`.
    """
    dims = names(dims)
    matched = funnel_matches(events, steps, key, ts, event, grain)
    if within is not None:
        limit = int(within / dt.timedelta(microseconds=1))
        matched = matched.withColumn(
            "matched", F.filter("matched", lambda t: t - F.get("matched", F.lit(0)) <= limit)
        )
    matched = matched.withColumn("__reached", F.size("matched")).drop("matched")
    if users is not None:
        matched = with_users(matched, users, user or names(key)[0], dims)
    counts = matched.groupBy(*dims).agg(
        *[F.count_if(F.col("__reached") >= at).alias(f"__n{at}") for at in range(1, len(steps) + 1)]
    )
    lines = [
        F.struct(
            F.lit(at).cast("bigint").alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"__n{at}").alias("n"),
            ratio(F.col(f"__n{at}"), F.col(f"__n{max(at - 1, 1)}")).alias("from_prev"),
            ratio(F.col(f"__n{at}"), F.col("__n1")).alias("from_first"),
        )
        for at, name in enumerate(steps, start=1)
    ]
    return counts.select(*dims, F.inline(F.array(*lines)))


def transitions(
    events: DataFrame,
    user: str,
    ts: str,
    event: str,
    order: str | Sequence[str],
    grain: str = "hour",
) -> DataFrame:
    """Step-to-step moves of users -> from, to, n, share. `share` is within `from`.

    Events without a user or a time are left out. Events are ordered once, inside (user, time slice). Moves inside a slice are counted where they
    are found; of each slice its first and last event are left, and one move leads from it to the next.
    """
    rows = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(user).alias("__user"), slice_of(ts, grain).alias("__slice"), ts, *names(order), F.col(event).alias("from")
    )
    inside = W.partitionBy("__user", "__slice").orderBy(ts, *names(order))
    seen = rows.withColumns(
        {
            "to": F.lead("from").over(inside),
            "__last": F.lead(F.lit(1)).over(inside).isNull(),
            "__first": F.lag(F.lit(1)).over(inside).isNull(),
        }
    )
    border = F.col("__first") | F.col("__last")
    counted = seen.groupBy(
        "from", "to", "__first", "__last", *[F.when(border, F.col(c)).alias(c) for c in ("__user", "__slice")]
    ).agg(F.count(F.lit(1)).alias("n"))
    # Level by level: a node's rows know their next row but the last, which meets the first of the next node a level above. Moves
    # counted already pass by, spread over parts.
    size, levels = radix(grain)
    passing = F.pmod(F.xxhash64("from", "to"), F.lit(MOST))
    ends = counted.withColumns({"__node": F.coalesce(node_of("__slice", grain), -1 - passing), "__next": F.lit(None)})
    edge = F.lit(True)
    for level in range(levels):
        apart = F.when(edge, F.lit(-MOST - 1)).otherwise(F.col("__node")) if level else F.col("__node")
        ends = ends.withColumn("__up", (F.col("__node") / F.lit(size**level)).cast("bigint")).withColumn("__apart", apart)
        along = W.partitionBy("__user", "__up", "__apart").orderBy("__slice", "__last")
        met = F.lead(F.struct("from")).over(along)
        ends = ends.withColumns({"__next": F.coalesce("__next", met) if level else met, "__edge": met.isNull() | F.lag(F.lit(1)).over(along).isNull()})
        edge = F.col("__edge")
    to = F.when(F.col("__last"), F.col("__next.from")).otherwise(F.col("to"))
    moves = ends.where(~F.col("__last") | F.col("__next").isNotNull()).groupBy("from", to.alias("to")).agg(F.sum("n").alias("n"))
    return moves.withColumn("share", ratio(F.col("n"), F.sum("n").over(W.partitionBy("from"))))


def _local_sessions(events: DataFrame, user: list[str], ts: str, gap: dt.timedelta, grain: str) -> DataFrame:
    """Number the sessions inside each (user, time slice) from 0."""
    inside = W.partitionBy(*user, "__slice").orderBy("__t")
    apart = F.col("__t") - F.lag("__t").over(inside) > int(gap / dt.timedelta(microseconds=1))
    return (
        events.withColumn("__slice", slice_of(ts, grain))
        .withColumn("__t", micros(ts))
        .withColumn("__local", F.count_if(apart).over(inside))
    )


def _pauses_before(rows: DataFrame, user: list[str], gap: dt.timedelta, grain: str, levels: int | None = None) -> DataFrame:
    """`rows` (user, __at, __from, __to, __pauses) with `__before`: the user's pauses before the first event of a row.

    A row is a slice or a node of slices with the pauses inside it. A prefix scan in segments: pauses are added up along the rows
    of each node, then, the same way, along the nodes, whose sums are added to their rows.
    """
    levels = radix(grain)[1] if levels is None else levels
    along = W.partitionBy(*user, "__node").orderBy("__at")
    apart = F.col("__from") - F.lag("__to").over(along) > int(gap / dt.timedelta(microseconds=1))
    rows = rows.withColumn("__node", node_of("__at", grain)).withColumn("__apart", F.coalesce(apart.cast("bigint"), F.lit(0)))
    before = F.sum(F.col("__apart") + F.col("__pauses")).over(along) - F.col("__pauses")
    rows = rows.withColumn("__before", before)
    if levels > 1:
        nodes = rows.groupBy(*user, F.col("__node").alias("__at")).agg(
            F.min("__from").alias("__from"),
            F.max("__to").alias("__to"),
            F.sum(F.col("__apart") + F.col("__pauses")).alias("__pauses"),
        )
        nodes = _pauses_before(nodes, user, gap, grain, levels - 1).withColumnRenamed("__before", "__more")
        rows = joined(rows, nodes, user, "__node", "__at", ["__more"])
        rows = rows.withColumn("__before", F.col("__before") + F.col("__more")).drop("__more")
    return rows.drop("__node", "__apart")


def sessions(
    events: DataFrame, user: str | Sequence[str], ts: str, gap: dt.timedelta, grain: str = "hour"
) -> DataFrame:
    """Sessions from raw events -> user, session_no, started, ended, n_events, seconds.

    A pause longer than `gap` starts a new session. Events without a user or a time are left out. Sessions are found inside (user,
    time slice) and numbered by a scan over slices; only the pieces of one session are ever brought together.
    """
    user = names(user)
    local = _local_sessions(events.select(*user, ts).dropna(subset=[*user, ts]), user, ts, gap, grain)
    pieces = local.groupBy(*user, F.col("__slice").alias("__at"), "__local").agg(
        F.min("__t").alias("__from"), F.max("__t").alias("__to"), F.count(F.lit(1)).alias("__n")
    )
    slices = pieces.groupBy(*user, "__at").agg(
        F.min("__from").alias("__from"), F.max("__to").alias("__to"), F.max("__local").alias("__pauses")
    )
    numbered = _pauses_before(slices, user, gap, grain)
    pieces = joined(pieces, numbered, user, "__at", "__at", ["__before"])
    kind = events.schema[ts].dataType
    return pieces.groupBy(*user, (F.col("__before") + F.col("__local") + 1).alias("session_no")).agg(
        F.timestamp_micros(F.min("__from")).cast(kind).alias("started"),
        F.timestamp_micros(F.max("__to")).cast(kind).alias("ended"),
        F.sum("__n").alias("n_events"),
        F.floor((F.max("__to") - F.min("__from")) / 1_000_000).alias("seconds"),
    )


def sessionize(
    events: DataFrame, user: str | Sequence[str], ts: str, gap: dt.timedelta, grain: str = "hour"
) -> DataFrame:
    """The events with their `session_no`; user and number together identify a session.

    An event without a user or a time has no session (NULL).
    """
    user = names(user)
    local = _local_sessions(events, user, ts, gap, grain)
    slices = local.dropna(subset=[*user, ts]).groupBy(*user, F.col("__slice").alias("__at")).agg(
        F.min("__t").alias("__from"), F.max("__t").alias("__to"), F.max("__local").alias("__pauses")
    )
    numbered = _pauses_before(slices, user, gap, grain).select(
        *[F.col(c).alias(f"__u_{c}") for c in user], F.col("__at").alias("__s"), "__before"
    )
    same = [F.col(c) == F.col(f"__u_{c}") for c in user] + [F.col("__slice") == F.col("__s")]
    number = F.col("__before") + F.col("__local") + 1
    return local.join(numbered, same, "left").withColumn("session_no", number).select(*events.columns, "session_no")
