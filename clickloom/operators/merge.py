"""Upsert by key with a change test, on plain Parquet tables.

Semantics (those of a MERGE with ``=`` on the keys and a condition on one column):

* a target row whose key occurs in the source with another value of the watched
  column takes the update columns of that source row; two such source rows are an
  error;
* a source row whose key is not in the target is inserted, as often as it occurs;
* NULL equals nothing, so a source row with a NULL key is always inserted, unless
  the spec asks for NULL-safe keys.

How it runs: one join of the source with the target's keys finds what changes (rows
to insert, candidates for an update). That change set, usually about a day of data,
is written to the shared folder. Only partitions in which an update changes a value are
rewritten; everything else is an append. Of the target only partitions are read that can
hold a match: those of the source where the key names the partition, and those that a key
index names where a table has one. Both sides of a join are brought to one row per key
by a map-side-combined aggregation where they could repeat, so no step ever emits
the pairs of a repeated key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.params import all_of, any_of
from clickloom.operators.keyindex import KeyIndex
from clickloom.operators.rows import conform, spare
from clickloom.operators.skew import spread_join, spread_spot
from clickloom.sources import tables
from clickloom.workspace import discard, fresh_dir, kept, stage, stage_split


@dataclass(frozen=True)
class MergeSpec:
    """What identifies a row, which change counts, and what is then updated.

    ``watch`` None means insert-only. ``unique_source`` promises at most one source
    row per key (NULLs equal), as after ``latest_per_key`` on the same keys; it
    saves the look for NULL keys. ``indexed`` keeps the keys of a partitioned table in an
    index beside it (see ``keyindex``), from which a merge tells what is new without the
    table; what is watched must then be a partition column or nothing.
    """

    keys: tuple[str, ...]
    watch: str | None = None
    update: tuple[str, ...] = ()
    unique_source: bool = False
    null_safe_keys: bool = False
    nan_never_matches: tuple[str, ...] = ()
    indexed: bool = False


def _match_keys(df: DataFrame, spec: MergeSpec) -> tuple[DataFrame, list[str]]:
    """``df`` with the columns to match on: the keys, or NULL-free stand-ins."""
    if not spec.null_safe_keys:
        return df, list(spec.keys)
    names = []
    for key in spec.keys:
        null_flag, value = spare(f"_null_{key}", df), spare(f"_value_{key}", df)
        df = df.withColumn(null_flag, F.col(key).isNull())
        # A stand-in for NULL of the right type; the flag keeps it apart from real values.
        kind = df.schema[key].dataType
        df = df.withColumn(value, F.coalesce(F.col(key), _zero(kind.typeName()).cast(kind)))
        names += [null_flag, value]
    return df, names


def _zero(type_name: str) -> Column:
    if type_name in ("date", "timestamp", "timestamp_ntz"):
        return F.lit("1970-01-01")
    if type_name == "boolean":
        return F.lit(False)
    return F.lit("" if type_name == "string" else 0)


def _unmatchable(spec: MergeSpec) -> Column:
    """Source rows that match nothing by definition."""
    test = F.lit(False)
    if not spec.null_safe_keys:
        for key in spec.keys:
            test = test | F.col(key).isNull()
    for key in spec.nan_never_matches:
        test = test | F.coalesce(F.isnan(key), F.lit(False))
    return test


def changes(target: DataFrame, source: DataFrame, spec: MergeSpec, flag: str = "_insert") -> DataFrame:
    """Source rows that insert or may update, with a column ``flag`` telling which.

    A row with ``flag`` false differs in the watched column from at least one
    target row of its key.
    """
    columns = source.columns
    plain_source, names = _match_keys(source, spec)
    target, _ = _match_keys(target, spec)
    facts = _Facts(spec, plain_source)
    present = facts.of(target.where(~_unmatchable(spec)), names)

    if spec.unique_source:
        # One row per key, so no key is hot, and after latest_per_key the rows
        # already lie where this join wants them.
        joined = plain_source.join(present, names, "left")
        always = None
    else:
        matchable = plain_source.where(~_unmatchable(spec))
        joined = spread_join(matchable, present, names, "left")
        always = plain_source.where(_unmatchable(spec)) if _open_ended(source, spec) else None

    result = joined.where(facts.differ).select(*columns, facts.new.alias(flag))
    if always is not None:
        result = result.unionByName(always.select(*columns, F.lit(True).alias(flag)))
    return result


def _open_ended(source: DataFrame, spec: MergeSpec) -> bool:
    """Whether some rows may match nothing by definition."""
    return bool(spec.nan_never_matches) or any(source.schema[k].nullable for k in spec.keys)


class _Facts:
    """What is to be known of the target rows of a key: how often it occurs, and enough about
    the watched column to know whether any of its rows differs from a given value."""

    def __init__(self, spec: MergeSpec, source: DataFrame) -> None:
        self.watch = spec.watch
        self.rows, self.valued, self.low, self.high = (spare(n, source) for n in ("_rows", "_valued", "_low", "_high"))

    def of(self, target: DataFrame, names: Sequence[str]) -> DataFrame:
        """One row per key."""
        facts = [F.count(F.lit(1)).alias(self.rows)]
        if self.watch:
            seen = F.col(self.watch)
            facts += [F.count(seen).alias(self.valued), F.min(seen).alias(self.low), F.max(seen).alias(self.high)]
        return target.groupBy(*names).agg(*facts)

    @property
    def new(self) -> Column:
        """The key is not in the target."""
        return F.col(self.rows).isNull()

    @property
    def differ(self) -> Column:
        """The key is new, or some row of it has another watched value."""
        if not self.watch:
            return self.new
        mine, valued = F.col(self.watch), F.col(self.valued)
        all_null = mine.isNull() & (valued == 0)
        all_same = (valued == F.col(self.rows)) & (F.col(self.low) == mine) & (F.col(self.high) == mine)
        return self.new | ~(all_null | F.coalesce(all_same, F.lit(False)))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], **options: object) -> DataFrame:
    """Source rows whose key is not in the target (NULL keys never are)."""
    spec = MergeSpec(keys=tuple(keys), **options)
    flag = spare("_insert", source)
    return changes(target, source, spec, flag).drop(flag)


def _updates(candidates: DataFrame, spec: MergeSpec, into: tuple[str, str, str]) -> DataFrame:
    """One row per key from the candidates: how many values, and the two extreme ones, named ``into``.

    A target row whose value is ``v`` is updated by the candidates whose value is not
    ``v``, and there may be one of these at most. So if three values or more occur,
    every target row of the key is in error, and two values can be told by the
    smallest and the largest.
    """
    candidates, names = _match_keys(candidates, spec)
    payload = F.struct(*[F.col(c).alias(c) for c in spec.update])
    value, n, set_ = (spare(x, candidates) for x in ("_value", "_n", "_set"))
    by_value = candidates.groupBy(*names, F.col(spec.watch).alias(value)).agg(
        F.count(F.lit(1)).alias(n), F.min(payload).alias(set_)
    )
    entry = F.struct(F.col(value).alias("value"), F.col(n).alias("n"), F.col(set_).alias("set"))
    values, low, high = into
    return by_value.groupBy(*names).agg(
        F.count(F.lit(1)).alias(values), F.min(entry).alias(low), F.max(entry).alias(high)
    )


def _apply_updates(target: DataFrame, candidates: DataFrame, spec: MergeSpec, flag: str = "_changed") -> DataFrame:
    """Target rows with the updates applied, and ``flag``: whether that changed a value."""
    columns = target.columns
    wide, names = _match_keys(target, spec)
    values, low_, high_ = (spare(n, wide) for n in ("_values", "_low", "_high"))
    joined = spread_join(wide, _updates(candidates, spec, (values, low_, high_)), names, "left", spread_nulls=True)
    mine, low, high = F.col(spec.watch), F.col(low_), F.col(high_)
    like_low = mine.eqNullSafe(low["value"])
    like_high = mine.eqNullSafe(high["value"])
    one, two = F.col(values) == 1, F.col(values) == 2
    chosen = F.when(one & ~like_low, low).when(two & like_low, high).when(two & like_high, low)
    too_many = (F.col(values) > 2) | (two & ~like_low & ~like_high) | (chosen["n"] > 1)
    message = F.lit("merge: more than one source row would update the same target row")
    pick = spare("_chosen", joined)
    joined = joined.withColumn(pick, F.when(too_many, F.raise_error(message)).otherwise(chosen))
    hit = F.col(pick).isNotNull()
    updated = [
        F.when(hit, F.col(pick)["set"][c]).otherwise(F.col(c)).alias(c) if c in spec.update else F.col(c)
        for c in columns
    ]
    other = any_of(~F.col(c).eqNullSafe(F.col(pick)["set"][c]) for c in spec.update)
    return joined.select(*updated, (hit & other).alias(flag))


def merge_frames(target: DataFrame, source: DataFrame, spec: MergeSpec, once: bool = False) -> DataFrame:
    """The whole target after the merge; nothing is written or run until it is read.

    With ``once`` the change set is computed at once and kept, as it is read for the updates and
    for the inserts, which take other columns of it, so Spark would join and shuffle for each.
    """
    columns = target.columns
    flag = spare("_insert", target)
    change = changes(target, conform(source, target.schema), spec, flag)
    if once and spec.watch is not None:
        change = kept(change)
    inserts = change.where(F.col(flag)).drop(flag)
    if spec.watch is None:
        return target.unionByName(inserts)
    candidates = change.where(~F.col(flag)).drop(flag)
    return _apply_updates(target, candidates, spec, flag).select(*columns).unionByName(inserts)


def merge_insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], nan_never_matches: Sequence[str] = ()
) -> DataFrame:
    """The target with the source rows appended whose key it does not hold."""
    spec = MergeSpec(keys=tuple(keys), nan_never_matches=tuple(nan_never_matches))
    source, flag = conform(source, target.schema), spare("_insert", target)
    return target.unionByName(changes(target, source, spec, flag).drop(flag))


def merge_table(
    spark: SparkSession, name: str, source: DataFrame, spec: MergeSpec, cheap_source: bool = False
) -> None:
    """Merge ``source`` into the table ``name``.

    A source that is read more than once is written out first, unless
    ``cheap_source`` says it is a plain scan.

    Partitions holding an updated row are rewritten from a staged copy, all else is
    an append, so a run that fails between the two can be run again. Swapping
    several partitions is not one atomic step; an unpartitioned table is switched to
    its new version in one.
    """
    target = spark.table(name)
    source = conform(source, target.schema)
    work = fresh_dir(spark, "merge")
    partitioned = tables.partition_columns(spark, name)
    flag = spare("_insert", target)
    try:
        if not cheap_source and (spec.indexed or not spec.unique_source):
            # Read twice below: for rows with NULL keys and by the join.
            source, cheap_source = stage(source, "source", f"{work}/source"), True
        index = None
        if spec.indexed and partitioned:
            index = KeyIndex(spark, name, spec, partitioned, _unmatchable(spec))
            change = _changes_by_index(index, source, spec, flag)
        elif cheap_source and partitioned and set(partitioned) <= set(spec.keys):
            # The key fixes the partition: no other one can hold a match.
            held = target.where(_within(source.where(~_unmatchable(spec)), partitioned))
            change = changes(held, source, spec, flag)
        else:
            change = changes(target, source, spec, flag)
        inserts, candidates = stage_split(change, flag, "changes", f"{work}/changes")
        if spec.watch is not None and not candidates.isEmpty():
            if not partitioned:
                merged = _apply_updates(target, candidates, spec, flag).select(*target.columns).unionByName(inserts)
                tables.atomic_refresh(spark, name, merged)
                return
            if index:
                target = target.where(_within(index.rows_of(candidates), partitioned))
            _rewrite_partitions(spark, name, target, candidates, spec, partitioned, f"{work}/rewrite")
        tables.append(spark, name, inserts)
        if index:
            index.add(inserts)
    finally:
        discard(spark, work)


def _changes_by_index(index: KeyIndex, source: DataFrame, spec: MergeSpec, flag: str) -> DataFrame:
    """``changes`` told from the key index: only the source's distinct keys are shuffled to it.

    The rows are then picked by the keys that changed, usually few enough to be broadcast.
    """
    columns = source.columns
    matchable = source.where(~_unmatchable(spec))
    keyed, names = index.hashed(matchable)
    facts = _Facts(spec, keyed)
    watched = [spec.watch] if spec.watch else []
    own = keyed.select(*names, *watched).distinct()
    found = own.join(facts.of(index.table(), names), names, "left").where(facts.differ)
    value = {c: spare(f"_own_{c}", keyed) for c in watched}
    found = found.select(*names, *[F.col(c).alias(n) for c, n in value.items()], facts.new.alias(flag))
    # Joined by the hashes as expressions: as columns they would be a third of what is shuffled.
    spot = spare("_spot", found, matchable)
    hashes = [*index.hashes(matchable), spread_spot(index.hashes(matchable))]
    found = found.withColumn(spot, spread_spot(names))
    rows = matchable.join(found, all_of(h == F.col(n) for h, n in zip(hashes, [*names, spot], strict=True)), "inner")
    for c, n in value.items():
        rows = rows.where(F.col(c).eqNullSafe(F.col(n)))
    result = rows.select(*columns, flag)
    if _open_ended(source, spec):
        result = result.unionByName(source.where(_unmatchable(spec)).select(*columns, F.lit(True).alias(flag)))
    return result


def _within(rows: DataFrame, partitioned: list[str]) -> Column:
    """Rows in the partitions that occur in ``rows``; one entry per day is collected."""
    found = rows.select(*partitioned).distinct().collect()
    if not found:
        return F.lit(False)
    only = all_of(
        F.col(c).isin([row[c] for row in found if row[c] is not None])
        | (F.col(c).isNull() if any(row[c] is None for row in found) else F.lit(False))
        for c in partitioned
    )
    if len(partitioned) > 1:
        # Value by value the filter lets more combinations through; only these are meant.
        only = only & any_of(all_of(F.col(c).eqNullSafe(F.lit(row[c])) for c in partitioned) for row in found)
    return only


def _rewrite_partitions(
    spark: SparkSession,
    name: str,
    target: DataFrame,
    candidates: DataFrame,
    spec: MergeSpec,
    partitioned: list[str],
    path: str,
) -> None:
    """Write the partitions anew in which an update changes a value; others are left as they are."""
    flag = spare("_changed", target)
    changing = _apply_updates(target, candidates, spec, flag).where(F.col(flag))
    only = _within(changing, partitioned)
    changed = _apply_updates(target.where(only), candidates, spec, flag)
    rows = stage(changed.select(*target.columns), "rewrite", path)
    if not rows.isEmpty():
        tables.overwrite_partitions(spark, name, path)
