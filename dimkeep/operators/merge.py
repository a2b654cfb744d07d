"""Table changes: merge, insert-only loads, deletes by id set, conditional update.

Every function returns the new table rows plus ``_action`` (INSERT, UPDATE,
DELETE or NONE). DELETE rows are still there so that they can be counted while
the table is written; :func:`survivors` removes them.

A merge is written as *target left join source* for what happens to known rows
and *source anti join target keys* for the new ones, not as one full outer join:

* a source below the broadcast threshold never shuffles the target;
* adaptive execution can split a hot partition of the preserved side of a left
  or anti join, but of neither side of a full outer join;
* target keys are reduced to distinct ones map-side before they move.

Both joins ask for the source hashed on the same keys with the same columns, so
that shuffle is done once and reused.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeep.operators.skew import distinct_keys, evenly

ACTION = "_action"
INSERT, UPDATE, DELETE, NONE = "INSERT", "UPDATE", "DELETE", "NONE"

Row = Callable[[str], Column]


def _side(alias: str) -> Row:
    return lambda name: F.col(f"{alias}.`{name}`")


_t, _s = _side("t"), _side("s")


def _both(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _no_null(keys: Sequence[str]) -> Column:
    return _both([F.col(k).isNotNull() for k in keys])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; a hot key is reduced before the shuffle."""
    return df.where(_no_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def repeated_keys_fail(counts: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """No rows, in ``schema``; running it fails with the first repeated key it meets.

    The message holds the count, so the test cannot move below the aggregate, and
    no column is a constant, so no filter above can make the optimizer drop it.
    """
    named = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    message = F.concat(
        F.lit("source has "), F.col("_n").cast("string"), F.lit(" rows for one key: "), named
    )
    repeated = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.col("_n") < 1)
    return counts.where(repeated).select(
        [
            (F.col(f.name) if f.name in keys else message.try_cast(f.dataType)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _with_action(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ACTION, T.StringType())])


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    changed: Callable[[Row, Row], Column] | None = None,
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
    gone: str | Mapping[str, object] | None = None,
    gone_if: Callable[[Row], Column] | None = None,
    markers: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Bring ``target`` up to date with ``source``, matching on ``keys`` (same names on both sides).

    changed   ``(t, s) -> Column``: update a known row only where this is true; always if not given.
    update    columns a known row takes from the source (default: all it has besides the keys).
    insert    columns a new row takes from the source (default: all it has); the others are null.
    gone      what happens to target rows missing from the source: nothing, ``"delete"``,
              or a mapping column -> value they are reset to.
    gone_if   ``(t) -> Column``: the rows ``gone`` applies to (default: all).
    markers   target columns that exist only for ``gone_if``; they are not part of the result.
    unique    the source was grouped by the keys, so there is nothing to check.

    Keys match by ``=``: a null key never matches, so such source rows are always
    new. A repeated non-null source key fails the job and is named in the error.
    """
    keys = list(keys)
    schema = T.StructType([f for f in target.schema.fields if f.name not in markers])
    names = schema.fieldNames()
    update = [c for c in source.columns if c in names and c not in keys] if update is None else list(update)
    insert = [c for c in source.columns if c in names] if insert is None else list(insert)
    used = [c for c in source.columns if c in {*keys, *update, *insert} or changed is not None]
    source = source.select(used)
    # Both joins take this one frame, without renaming, so that its shuffle can be shared.
    keyed = source.where(_no_null(keys)).alias("s")
    same_key = _both([_t(k) == _s(k) for k in keys])

    known = _known_rows(
        target.alias("t").join(keyed, same_key, "left"), keys, schema, changed, update, gone, gone_if
    )

    counts = key_counts(source, keys)
    # Reading the count here too makes both uses of ``counts`` the same shuffle.
    wanted = (keyed if unique else counts.where("_n > 0")).select(keys)
    hits = distinct_keys(target, keys).join(wanted, keys, "left_semi")
    new = _new_rows(keyed.join(hits.alias("t"), same_key, "left_anti"), schema, insert)
    unmatched = _new_rows(source.where(~_no_null(keys)), schema, insert)

    result = known.unionByName(new).unionByName(unmatched)
    if unique:
        return result
    return result.unionByName(repeated_keys_fail(counts, keys, _with_action(schema)))


def _known_rows(joined, keys, schema, changed, update, gone, gone_if) -> DataFrame:
    # The source side has no null key, so after the left join its key says whether there was a match.
    matched = _s(keys[0]).isNotNull()
    updated = matched if changed is None else matched & F.coalesce(changed(_t, _s), F.lit(False))
    left_over = F.lit(False)
    if gone is not None:
        left_over = ~matched & (F.lit(True) if gone_if is None else F.coalesce(gone_if(_t), F.lit(False)))
    resets = gone if isinstance(gone, Mapping) else {}

    def value(field: T.StructField) -> Column:
        old = _t(field.name)
        if field.name in resets:
            old = F.when(left_over, F.lit(resets[field.name]).cast(field.dataType)).otherwise(old)
        if field.name in update:
            old = F.when(updated, _s(field.name).cast(field.dataType)).otherwise(old)
        return old.alias(field.name)

    action = (
        F.when(updated, F.lit(UPDATE))
        .when(left_over, F.lit(UPDATE if isinstance(gone, Mapping) else DELETE))
        .otherwise(F.lit(NONE))
    )
    return joined.select(*[value(f) for f in schema.fields], action.alias(ACTION))


def _new_rows(rows: DataFrame, schema: T.StructType, insert: Sequence[str]) -> DataFrame:
    return rows.select(
        *[
            (F.col(f.name) if f.name in insert else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        F.lit(INSERT).alias(ACTION),
    )


def rows_to_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, distinct: bool
) -> DataFrame:
    """Source rows whose key the target lacks, ready to be appended.

    ``distinct`` de-duplicates the rows first and then fails on a key that still
    repeats. Without it, repeats inside the batch all go in.
    """
    keys = list(keys)
    rows = source.distinct() if distinct else source
    # A small source cuts the target's keys down to its own before they move.
    known = distinct_keys(target, keys).join(source.select(keys), keys, "left_semi")
    new = rows.join(evenly(known), keys, "left_anti").select(source.columns)
    if distinct and set(keys) != set(source.columns):
        new = new.unionByName(repeated_keys_fail(key_counts(rows, keys), keys, new.schema))
    return new


def insert_new(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, distinct: bool = True
) -> DataFrame:
    """The target plus :func:`rows_to_insert`."""
    new = rows_to_insert(target, source, keys, distinct=distinct)
    return target.withColumn(ACTION, F.lit(NONE)).unionByName(
        _new_rows(new, target.schema, new.columns)
    )


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Change ``values`` on the rows where the condition holds, and only there."""
    hit = F.coalesce(condition, F.lit(False))
    out = [
        F.when(hit, values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        if f.name in values
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*out, F.when(hit, F.lit(UPDATE)).otherwise(F.lit(NONE)).alias(ACTION))


def mark_members(df: DataFrame, members: DataFrame, on: Sequence[str], marker: str) -> DataFrame:
    """Boolean column saying whether the row's ``on`` columns are among ``members``."""
    ids = evenly(distinct_keys(members, on)).withColumn(marker, F.lit(True))
    return (
        df.join(ids, list(on), "left")
        .withColumn(marker, F.col(marker).isNotNull())
        .select(*df.columns, marker)
    )


def delete_members(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the given members become DELETE."""
    marked = mark_members(df, members, on, "_member")
    return marked.select(
        *df.columns, F.when(F.col("_member"), F.lit(DELETE)).otherwise(F.lit(NONE)).alias(ACTION)
    )


def survivors(changed: DataFrame) -> DataFrame:
    """The new table: rows that were not deleted, without the action."""
    return changed.where(F.col(ACTION) != DELETE).drop(ACTION)


def action_counts(changed: DataFrame) -> DataFrame:
    """One row: inserted, updated, deleted."""
    return changed.agg(*count_columns())


def count_columns() -> list[Column]:
    """The three counts, for an aggregate or for an observation on a write."""
    return [
        F.count_if(F.col(ACTION) == action).alias(name)
        for name, action in (("inserted", INSERT), ("updated", UPDATE), ("deleted", DELETE))
    ]
