"""Keyed upsert (MERGE ... WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT) as a DataFrame.

Parquet tables have no row-level MERGE in Spark, so the merge is computed as a
new snapshot of the target: every target row (updated or kept) plus the source
rows whose key found no target row (inserted). Each output row carries
``_action`` in {"update", "insert", "keep"}.

Join plan:

* ``broadcast_source=True``: if the source's bytes, summed by one job, stay within
  ``BROADCAST_BYTES``, the target is never shuffled; beyond, the join below is taken. ``target LEFT JOIN broadcast(source)`` gives updated and kept
  rows; ``source LEFT ANTI broadcast(matched keys)`` gives inserts, where the
  matched keys come from a key-only scan of the target semi-joined to the
  broadcast source keys (bounded by the source).
* ``co_located=True`` (the target is bucketed by the key): one ``FULL OUTER``
  join on the key alone; the target is read bucket by bucket without an
  exchange, only the source is shuffled to its buckets, and its NULL-key rows
  are added beside the join.
* otherwise: one ``FULL OUTER`` join, each side scanned and shuffled once.

NULL keys never match (``=`` semantics): a NULL-key source row is always
inserted, a NULL-key target row is always kept. In the shuffled join such rows
are salted (spread by a row hash), so NULL keys never pile up in one shuffle
partition. All other keys are unique on both sides (the source is
deduplicated, the target is a previous merge result), so the join has no hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_action"
#: A source of more bytes than this is not broadcast, whatever the caller asks for.
BROADCAST_BYTES = 64 << 20
_T = "__in_target"
_M = "__in_source"


def _src(c: str) -> str:
    return f"__s_{c}"


def _keys_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def assert_unique_keys(source: DataFrame, keys: str | Sequence[str]) -> None:
    """Fail if a non-NULL key occurs more than once in the source.

    One aggregate job over the key columns (partial counts per task).
    """
    keys = _keys_list(keys)
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    dup = source.filter(not_null).groupBy(*keys).count().filter(F.col("count") > 1).limit(1)
    if not dup.isEmpty():
        raise ValueError(
            f"merge source has several rows for one key {keys}: {dup.first().asDict()}"
        )


def source_bytes(df: DataFrame) -> int:
    """Bytes of all values (text and binary by their length, others 8 each) and 16 a row; one aggregate job."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{c}`")).cast("long"), F.lit(0)) if t in ("string", "binary") else F.lit(8)
        for c, t in df.dtypes
    ]
    total = sum(sizes, F.lit(16).cast("long"))
    return int(df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0])


def _value(
    c: str,
    keys: list[str],
    update_cols: set[str],
    insert_cols: set[str],
    defaults: Mapping[str, Column],
    dtype: str,
) -> Column:
    in_t, in_s = F.col(_T), F.col(_M)
    tgt = F.col(c)
    if c in insert_cols or c in keys:
        ins = F.col(_src(c))
    elif c in defaults:
        ins = defaults[c]
    else:
        ins = F.lit(None)
    upd = F.col(_src(c)) if c in update_cols else tgt
    return (
        F.when(in_t & in_s, upd)
        .when(in_t, tgt)
        .otherwise(ins.cast(dtype))
        .alias(c)
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
    *,
    broadcast_source: bool | None = None,
    co_located: bool = False,
    check_unique: bool = True,
) -> DataFrame:
    """Upsert ``source`` into ``target``; returns the new target + ``_action``.

    * matched: columns in ``update_cols`` take the source value (a NULL source
      value overwrites), all other columns keep the target value;
    * not matched: a new row with ``insert_cols`` from the source, columns in
      ``defaults`` from their expression, the rest NULL;
    * target rows without a source row are kept unchanged (no delete branch).

    ``defaults`` values may be any Column (e.g. ``lit(run_ts)`` for creation
    stamps). ``check_unique`` runs :func:`assert_unique_keys` first; pass False
    when the source comes from ``latest_per_key``.
    """
    keys = _keys_list(keys)
    defaults = dict(defaults or {})
    update_set, insert_set = set(update_cols), set(insert_cols)
    tcols = target.columns
    for c in list(update_set | insert_set):
        if c not in tcols:
            raise ValueError(f"column {c!r} is not in the target")
    if check_unique:
        assert_unique_keys(source, keys)

    needed = [c for c in tcols if c in update_set or c in insert_set or c in keys]
    s = source.select(*[F.col(c).alias(_src(c)) for c in needed], F.lit(True).alias(_M))
    t = target.withColumn(_T, F.lit(True))
    dtypes = dict(target.dtypes)

    def project(df: DataFrame) -> DataFrame:
        in_t, in_s = F.col(_T), F.col(_M)
        action = (
            F.when(in_t & in_s, F.lit("update")).when(in_t, F.lit("keep")).otherwise(F.lit("insert"))
        )
        return df.select(
            *[_value(c, keys, update_set, insert_set, defaults, dtypes[c]) for c in tcols],
            action.alias(ACTION),
        )

    def any_null(cols: list[str]) -> Column:
        out = F.lit(False)
        for c in cols:
            out = out | F.col(c).isNull()
        return out

    def row_hash(df: DataFrame) -> Column:
        hashable = [n for n, t in df.dtypes if not t.startswith(("variant", "map", "struct<", "array<"))]
        return F.xxhash64(*[F.col(n) for n in hashable])

    def source_only(df: DataFrame) -> DataFrame:
        return df.select(
            "*", *[F.lit(None).cast(dtypes[c]).alias(c) for c in tcols], F.lit(None).cast("boolean").alias(_T)
        )

    src_keys_null = any_null([_src(k) for k in keys])
    if broadcast_source and source_bytes(s) <= BROADCAST_BYTES:
        # No shuffle here, so NULL keys cannot pile up: the whole target streams
        # through one hash join against the broadcast source.
        s_keyed = s.filter(~src_keys_null)
        cond = [F.col(k) == F.col(_src(k)) for k in keys]
        matched_rows = t.join(F.broadcast(s_keyed), cond, "left")
        src_keys = s_keyed.select(*[F.col(_src(k)) for k in keys])
        matched_keys = (
            target.select(*keys)
            .join(F.broadcast(src_keys), cond, "left_semi")
            .select(*[F.col(k).alias(f"__mk_{k}") for k in keys])
        )
        inserts = s.join(
            F.broadcast(matched_keys),
            [F.col(_src(k)) == F.col(f"__mk_{k}") for k in keys],
            "left_anti",
        )  # NULL-key source rows never match, so they pass the anti join
        return project(matched_rows).unionByName(project(source_only(inserts)))

    if co_located:
        joined = t.join(s.filter(~src_keys_null), [F.col(k) == F.col(_src(k)) for k in keys], "full_outer")
        return project(joined).unionByName(project(source_only(s.filter(src_keys_null))))

    # Shuffled join. NULL keys never match (plain `=`), but would all hash to
    # one reducer: the join also requires equal salts, which are 0 for rows
    # with keys and a row hash for NULL-key rows, so the shuffle on
    # (key, salt) spreads those rows. Each side is scanned and shuffled once.
    t_salted = t.withColumn(
        "__t_salt", F.when(any_null(keys), row_hash(t)).otherwise(F.lit(0).cast("long"))
    )
    s_salted = s.withColumn(
        "__s_salt", F.when(src_keys_null, row_hash(s)).otherwise(F.lit(0).cast("long"))
    )
    cond = [F.col(k) == F.col(_src(k)) for k in keys] + [F.col("__t_salt") == F.col("__s_salt")]
    joined = t_salted.join(s_salted, cond, "full_outer")
    return project(joined)


def merge_counts(merged: DataFrame) -> DataFrame:
    """Row counts per action, and ``affected`` = updated + inserted.

    A matched row counts as updated even when its values did not change.
    """
    a = F.col(ACTION)
    return merged.agg(
        F.count_if(a == "update").alias("updated"),
        F.count_if(a == "insert").alias("inserted"),
        F.count_if(a == "keep").alias("kept"),
    ).withColumn("affected", F.col("updated") + F.col("inserted"))


def merge_into_table(
    source: DataFrame,
    table: str,
    keys: str | Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str],
    values: Mapping[str, Column] | None = None,
) -> None:
    """Native ``MERGE INTO`` for catalogs with row-level operations (``DataFrame.mergeInto``).

    ``values`` overrides the value of a column in both branches (e.g. run
    literals for ``_job_id``/``_trace_id``). Plain Parquet tables do not
    support it; Spark raises ``UNSUPPORTED_FEATURE.TABLE_OPERATION`` and the
    caller falls back to :func:`merge_upsert` + publishing.
    """
    keys = _keys_list(keys)
    values = dict(values or {})
    src = source.alias("s")
    cond = None
    for k in keys:
        c = F.col(f"{table}.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c

    def assignment(cols: Sequence[str]) -> dict[str, Column]:
        return {c: values.get(c, F.col(f"s.{c}")) for c in cols}

    (
        src.mergeInto(table, cond)
        .whenMatched()
        .update(assignment(update_cols))
        .whenNotMatched()
        .insert(assignment(insert_cols))
        .merge()
    )
