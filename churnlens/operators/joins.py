"""Null-safe outer joins that stay balanced when a few keys hold most rows.

NULL keys match NULL keys. A sketch of the key column (one job, no shuffle of rows) names the
keys that would overload one task. Their rows are cut into a grid of salts: the left rows by
row, the right rows by column, each copied along the other axis, so that every pair still
meets exactly once. Without such keys the plan is the plain sort-merge join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import quoted


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot, in rows (or joined pairs) for a single task.

    ``rows_per_part`` are the rows of a task that sorts or groups rows dealt by key.
    Keys with more than ``share`` of a side's rows are looked for. There are at most 1/share of
    them, so none is cut off, and the sketch is sized to tell them from the rest.
    """

    rows_per_task: int = 1_000_000
    pairs_per_task: int = 5_000_000
    rows_per_part: int = 250_000
    share: float = 1e-4

    @property
    def top(self) -> int:
        return math.ceil(1 / self.share)

    @property
    def tracked(self) -> int:
        """Counters of the sketch; its error is at most rows/tracked, a twentieth of the share."""
        return min(1_000_000, 20 * self.top)


@dataclass(frozen=True)
class KeyLoad:
    """Rows of one join side, in all and (estimated from above) for its most frequent keys."""

    rows: int
    counts: dict[object, int]


@dataclass(frozen=True)
class HotKey:
    value: object
    left_rows: int
    right_rows: int

    def grid(self, policy: SkewPolicy) -> tuple[int, int]:
        """Number of left and right salts."""
        left = max(1, math.ceil(self.left_rows / policy.rows_per_task))
        right = max(1, math.ceil(self.right_rows / policy.rows_per_task))
        if self.left_rows and self.right_rows:
            # Cells of as many left as right rows: fewest copies, left x right salts and right x left.
            cells = math.ceil(self.left_rows * self.right_rows / policy.pairs_per_task)
            even = math.ceil(math.sqrt(cells * self.right_rows / self.left_rows))
            right = max(right, min(self.right_rows, even))
            left = max(left, min(self.left_rows, math.ceil(cells / right)))
            right = max(right, min(self.right_rows, math.ceil(cells / left)))
        return left, right


DEFAULT_POLICY = SkewPolicy()
# Up to so many parts a table is left to adaptive execution.
LEAST_PARTS = 8
# Most pairs of one key that a full outer join forms: Spark holds them all before it passes on the first.
FULL_JOIN_PAIRS = 100_000
# Most parts of the pairs of hot keys.
MOST_PAIR_PARTS = 2_000


def _collect_all(frames: list[DataFrame]) -> list:
    """The rows of several small results, in one job."""
    return reduce(DataFrame.unionByName, frames).collect()


def heavy_keys(
    sides: Iterable[tuple[str, DataFrame, str]], policy: SkewPolicy = DEFAULT_POLICY
) -> dict[str, KeyLoad]:
    """Row counts of the most frequent keys (estimated from above; exact for NULL), per named side.

    One pass over the key column of each side, in one job; at most 1/share counts a side reach
    the driver.
    """
    counted = _collect_all(
        [
            side.agg(
                F.lit(name).alias("side"),
                F.count("*").alias("rows"),
                F.count_if(F.isnull(key)).alias("nulls"),
                F.expr(f"approx_top_k({quoted(key)}, {policy.top}, {policy.tracked})").alias("top"),
            )
            for name, side, key in sides
        ]
    )
    found = {}
    for row in counted:
        least = policy.share * row["rows"]
        counts = {t["item"]: t["count"] for t in row["top"] or [] if t["item"] is not None and t["count"] > least}
        found[row["side"]] = KeyLoad(row["rows"], counts | ({None: row["nulls"]} if row["nulls"] else {}))
    return found


def hot_of(
    left: dict[object, int], right: dict[object, int], policy: SkewPolicy = DEFAULT_POLICY
) -> list[HotKey]:
    """Keys whose rows, or whose joined pairs, are too many for one task."""
    keys = [HotKey(v, left.get(v, 0), right.get(v, 0)) for v in {**left, **right}]
    return [
        k
        for k in keys
        if max(k.left_rows, k.right_rows) > policy.rows_per_task
        or k.left_rows * k.right_rows > policy.pairs_per_task
    ]


def parts_of(rows: int, policy: SkewPolicy = DEFAULT_POLICY) -> int | None:
    """Parts for so many rows, so that a part stays as large when the table grows; None for a small table."""
    parts = math.ceil(rows / policy.rows_per_part)
    return parts if parts > LEAST_PARTS else None


def salts_of(counts: dict[object, int], policy: SkewPolicy = DEFAULT_POLICY) -> dict[object, int]:
    """Number of salts of each hot key."""
    return {k.value: k.grid(policy)[1] for k in hot_of({}, counts, policy)}


@dataclass(frozen=True)
class Dealt:
    """Rows in parts of bounded size, each key (and salt, where some key is hot) in one part."""

    rows: DataFrame
    keys: list[str]
    parts: int


def deal(df: DataFrame, key: str, policy: SkewPolicy = DEFAULT_POLICY) -> Dealt:
    """``df`` dealt by ``key`` over a number of parts that grows with its rows, so that a part takes as much
    memory whatever the size of the table. The rows of a hot key, NULL too, are spread by row
    over a column ``_salt``."""
    load = heavy_keys([("rows", df, key)], policy)["rows"]
    parts = max(1, math.ceil(load.rows / policy.rows_per_part))
    salts = salts_of(load.counts, policy)
    if not salts:
        return Dealt(df.repartition(parts, key), [key], parts)
    rows = own_salt(df, "_salt", F.col(key), salts)
    return Dealt(rows.repartition(parts, key, "_salt"), [key, "_salt"], parts)


def exact_hot_keys(
    left: DataFrame, right: DataFrame, key: str, policy: SkewPolicy = DEFAULT_POLICY
) -> list[HotKey]:
    """Hot keys of two join sides with exact counts on both."""
    return _layout(left, right, key, policy)[0]


def _layout(
    left: DataFrame, right: DataFrame, key: str, policy: SkewPolicy, pairs: int | None = None
) -> tuple[list[HotKey], int | None]:
    """Hot keys (``pairs``: of more than so many pairs) of two join sides with exact counts on both, and the
    parts for the larger side, its copies counted."""
    found = heavy_keys([("left", left, key), ("right", right, key)], policy)
    limits = replace(policy, pairs_per_task=min(pairs or policy.pairs_per_task, policy.pairs_per_task))
    hot = hot_of(found["left"].counts, found["right"].counts, limits)
    if hot:
        values = [k.value for k in hot]
        counted = _collect_all(
            [
                side.where(_is_one_of(F.col(key), values))
                .groupBy(key)
                .agg(F.lit(name).alias("side"), F.count("*").alias("n"))
                for name, side in (("left", left), ("right", right))
            ]
        )
        exact = {(r["side"], r[key]): r["n"] for r in counted}
        hot = [HotKey(v, exact.get(("left", v), 0), exact.get(("right", v), 0)) for v in values]
    return hot, dealt_parts(found["left"].rows, found["right"].rows, hot, policy)


def dealt_parts(left_rows: int, right_rows: int, hot: list[HotKey], policy: SkewPolicy = DEFAULT_POLICY) -> int | None:
    """Parts for the larger of two join sides, the copies of its hot rows counted."""
    grids = [(k, *k.grid(policy)) for k in hot if k.left_rows and k.right_rows]
    left_rows += sum(k.left_rows * (right - 1) for k, _, right in grids)
    right_rows += sum(k.right_rows * (left - 1) for k, left, _ in grids)
    return parts_of(max(left_rows, right_rows), policy)


def _is_one_of(key: Column, values: list[object]) -> Column:
    named = [v for v in values if v is not None]
    test = F.coalesce(key.isin(named), F.lit(False)) if named else F.lit(False)
    return test | key.isNull() if None in values else test


def _lookup(key: Column, numbers: dict[object, int], default: int) -> Column:
    """Number assigned to a key; all but a few keys take the default."""
    named = {v: n for v, n in numbers.items() if v is not None}
    out = F.lit(default)
    if named:
        table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
        out = F.when(key.isin(list(named)), F.element_at(table, key)).otherwise(out)
    if None in numbers:
        out = F.when(key.isNull(), F.lit(numbers[None])).otherwise(out)
    return out


def _copies(df: DataFrame, name: str, key: Column, numbers: dict[object, int]) -> DataFrame:
    """One copy of each row per salt of the other side."""
    if max(numbers.values()) == 1:
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), _lookup(key, numbers, 1) - 1)))


def own_salt(df: DataFrame, name: str, key: Column, numbers: dict[object, int]) -> DataFrame:
    # A hash of the whole row, not rand(): a task that runs again must salt alike.
    salts = _lookup(key, numbers, 1)
    return df.withColumn(name, F.pmod(F.xxhash64(*df.columns), salts).cast("int"))


def outer_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "full",
    hot: list[HotKey] | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    null_safe: bool = True,
    hint: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``left``, ``full`` or ``inner`` join on a null-safe key; only ``key`` may be in both sides.
    With plain equality (``null_safe=False``) tables bucketed by the key join without a shuffle.
    ``hint`` names a join strategy. ``parts`` deals both inputs over so many parts, in place of the
    session's number, which doesn't grow with the tables; only a string key is dealt so.

    ``hot`` lists the hot keys; left out, they are looked for in both inputs, and so are the parts. For a full join
    the counts must tell whether a key is present on each side, for a left join on the right.
    Under plain equality NULL meets nothing and is never salted.
    """
    if hot is None:
        hot, found = _layout(left, right, key, policy, FULL_JOIN_PAIRS if how == "full" else None)
        parts = parts or found
    if not null_safe:
        hot = [k for k in hot if k.value is not None]
    columns = left.columns + [c for c in right.columns if c != key]
    met = [k for k in hot if k.left_rows and k.right_rows] if how == "full" else []
    if met:
        # All rows of these keys have partners. An inner join passes their pairs on as it forms them.
        hot = [k for k in hot if k not in met]
        sides = [(df, _is_one_of(F.col(key), [k.value for k in met])) for df in (left, right)]
        (a, b), (left, right) = ([df.where(of) for df, of in sides], [df.where(~of) for df, of in sides])
        cells = sum(x * y for x, y in (k.grid(policy) for k in met))
        spread = min(cells, MOST_PAIR_PARTS) if cells > LEAST_PARTS else None
        # Not broadcast, however small these rows look: one side would then stay in a few tasks.
        pairs = outer_join(a, b, key, "inner", met, policy, null_safe, hint or "merge", spread)
        return outer_join(left, right, key, how, hot, policy, null_safe, hint, parts).union(pairs)
    right = right.withColumnRenamed(key, "_key")
    lkey, rkey = F.col(key), F.col("_key")
    same_key = lkey.eqNullSafe(rkey) if null_safe else lkey == rkey
    if dict(left.dtypes)[key] != "string" or dict(right.dtypes)["_key"] != "string":
        parts = None
    if hot:
        joined = _salted(left, right, key, same_key, how, hot, policy, hint, null_safe, parts)
    else:
        if parts:
            left = left.repartition(parts, *_dealt_by(left, key, null_safe))
            right = right.repartition(parts, *_dealt_by(right, "_key", null_safe))
        joined = left.join(right.hint(hint) if hint else right, same_key, how)
    if how == "full":
        joined = joined.withColumn(key, F.coalesce(key, "_key"))
    return joined.select(columns)


def _dealt_by(df: DataFrame, key: str, null_safe: bool) -> list[Column]:
    """What a join on ``key`` is partitioned by: under null-safe equality the key with a value in
    place of NULL, and whether it is NULL. Rows dealt by it are not shuffled again."""
    if not null_safe:
        return [F.col(key)]
    return [F.coalesce(F.col(key), F.lit("")), F.isnull(key)]


def _salted(left, right, key, same_key, how, hot, policy, hint, null_safe, parts):
    grid = {k.value: k.grid(policy) for k in hot}
    # A left join needs the left count for balance only, never to decide on copies.
    paired = {k.value for k in hot if k.right_rows and (k.left_rows or how == "left")}
    left_salts = {v: g[0] for v, g in grid.items()}
    right_salts = {v: g[1] for v, g in grid.items()}
    left_copies = {v: g[1] if v in paired else 1 for v, g in grid.items()}
    right_copies = {v: g[0] if v in paired else 1 for v, g in grid.items()}

    lkey, rkey = F.col(key), F.col("_key")
    a = _copies(own_salt(left, "_ls", lkey, left_salts), "_rs", lkey, left_copies)
    b = _copies(own_salt(right, "_rs2", rkey, right_salts), "_ls2", rkey, right_copies)
    a, b = a.withColumn("_in_left", F.lit(True)), b.withColumn("_in_right", F.lit(True))
    if parts:
        a = a.repartition(parts, *_dealt_by(a, key, null_safe), "_ls", "_rs")
        b = b.repartition(parts, *_dealt_by(b, "_key", null_safe), "_ls2", "_rs2")
    joined = a.join(
        b.hint(hint) if hint else b,
        same_key & (F.col("_ls") == F.col("_ls2")) & (F.col("_rs") == F.col("_rs2")),
        how,
    )
    if not paired or how == "inner":
        return joined
    # A copy that met no partner in its cell is no result row: its key does have partners.
    lonely = F.col("_in_right").isNull()
    if how == "full":
        lonely = lonely | F.col("_in_left").isNull()
    return joined.where(~(_is_one_of(F.coalesce(lkey, rkey), list(paired)) & lonely))
