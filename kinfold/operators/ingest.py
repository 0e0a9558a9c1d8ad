"""From delivered rows to records, field values, the string dictionary and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.text import hash_key, normalize_text

FIELDS = ("composite", "person", "roles", "title", "provision", "subjects")
#: Fields that get vectors.
EMBEDDED = ("composite", "person", "title", "provision", "subjects")
#: Texts in place of a missing hash; fixed values.
NULL_WORDS = ("", "null", "none", "nan", "n/a")


def valid_records(rows: DataFrame, record: str) -> DataFrame:
    """Rows with a usable id (null, empty and "unknown" are not), which is trimmed."""
    return rows.withColumn(record, F.trim(record)).where(F.col(record).isNotNull() & ~F.col(record).isin("", "unknown"))


def latest_records(rows: DataFrame, record: str, order: list[str | Column]) -> DataFrame:
    """One row for each id: the last by `order`, the other columns breaking ties. A single aggregation, no window over an id."""
    rest = [c for c in rows.columns if c != record]
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    return rows.groupBy(record).agg(F.max_by(F.struct(*rest), F.struct(*by, *rest)).alias("__last")).select(record, "__last.*")


def cells(rows: DataFrame, record: str, keep: list[str] | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(record, keep..., field, value, hash) in long form; value and hash are null for a missing cell."""
    keep = keep or []
    long = rows.select(record, *keep, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), normalize_text(F.col(f)).alias("value")) for f in fields])).alias("c"))
    return long.select(record, *keep, "c.field", "c.value", hash_key(F.col("c.value")).alias("hash"))


def string_dictionary(cells: DataFrame, order: list[str]) -> DataFrame:
    """(hash, value, n, n_fields): each string once, in the spelling that came first, and its occurrences."""
    return cells.where("hash IS NOT NULL").groupBy("hash").agg(F.min_by("value", F.struct(*order, "value")).alias("value"), F.count(F.lit(1)).alias("n"), F.count_distinct("field").alias("n_fields"))


def field_hash_counts(cells: DataFrame) -> DataFrame:
    return cells.where("hash IS NOT NULL").groupBy("hash", "field").agg(F.count(F.lit(1)).alias("n"))


def field_statistics(field_hash: DataFrame) -> DataFrame:
    return field_hash.groupBy("field").agg(F.sum("n").alias("total_occurrences"), F.count(F.lit(1)).alias("unique_values"))


def multi_field_hashes(field_hash: DataFrame) -> DataFrame:
    return field_hash.groupBy("hash").agg(F.count(F.lit(1)).alias("n_fields"), F.sum("n").alias("n")).where("n_fields > 1")


def record_fields(cells: DataFrame, record: str) -> DataFrame:
    """The wide form again: (record, composite_h, ..., subjects_h)."""
    return cells.groupBy(record).agg(*[F.max(F.when(F.col("field") == f, F.col("hash"))).alias(f"{f}_h") for f in FIELDS])


def null_profile(cells: DataFrame) -> DataFrame:
    """(field, total, missing, distinct_values, present_share)."""
    out = cells.groupBy("field").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("hash").isNull()).alias("missing"), F.count_distinct("hash").alias("distinct_values"))
    return out.withColumn("present_share", F.round(1 - F.col("missing") / F.col("total"), 6))


def modal_hashes(cells: DataFrame) -> DataFrame:
    """(field, hash, n, records, share): the most frequent hash of each field, the smallest of equals."""
    counts = cells.where("hash IS NOT NULL").groupBy("field", "hash").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("field").agg(F.max(F.struct("n", F.lit(0))).getField("n").alias("n"))
    modal = counts.join(F.broadcast(top), ["field", "n"]).groupBy("field", "n").agg(F.min("hash").alias("hash"))
    records = cells.groupBy("field").agg(F.count(F.lit(1)).alias("records"))
    return modal.join(F.broadcast(records), "field").select("field", "hash", "n", "records", F.round(F.col("n") / F.col("records"), 6).alias("share"))


def missing_fields(cells: DataFrame, record: str, modal_share: float = 0.15) -> DataFrame:
    """(record, missing): the fields that count as missing - null, a null word, or a hash that is the modal one of any field and covers more than `modal_share` of the records there. The modal hashes, at most one a field, are broadcast."""
    modal = F.broadcast(modal_hashes(cells).where(F.col("n") > F.col("records") * modal_share).select("hash").distinct().withColumn("__modal", F.lit(True)))
    null_word = F.coalesce(F.lower("value").isin(*NULL_WORDS), F.lit(True))
    marked = cells.join(modal, "hash", "left").where(null_word | F.col("__modal").isNotNull())
    return marked.groupBy(record).agg(F.array_sort(F.collect_set("field")).alias("missing"))


def unprocessed(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed run still has to do."""
    return items.join(done, keys, "left_anti")


def mapping_differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """(hash, field, change): hashes added to or removed from a field between two mappings."""
    added = after.join(before, ["hash", "field"], "left_anti").select("hash", "field", F.lit("added").alias("change"))
    removed = before.join(after, ["hash", "field"], "left_anti").select("hash", "field", F.lit("removed").alias("change"))
    return added.unionByName(removed)


def reconcile(counts: dict[str, DataFrame], key: str = "field", count: str = "n") -> DataFrame:
    """Counts of several sources side by side, 0 where a source lacks the key, and each one's difference from the first."""
    names = list(counts)
    out = None
    for name, df in counts.items():
        df = df.select(key, F.col(count).alias(name))
        out = df if out is None else out.join(df, key, "full")
    out = out.select(key, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
    return out.select(key, *names, *[(F.col(n) - F.col(names[0])).alias(f"{n}_difference") for n in names[1:]])


def trace_hash(tables: dict[str, tuple[DataFrame, str]], value: Column) -> DataFrame:
    """(stage, rows): how many rows of each stage hold the hash."""
    out = None
    for stage, (df, column) in tables.items():
        hits = df.where(F.col(column) == value).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"), "rows")
        out = hits if out is None else out.unionByName(hits)
    return out


def with_defaults(keys: DataFrame, strings: DataFrame, vectors: DataFrame, on: list[str], placeholder: str, dimensions: int) -> DataFrame:
    """(on..., value, v) of every key: a missing text is the placeholder, a missing vector zeros, so that no object is lost. `strings` and `vectors` are unique by `on`."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dimensions)
    return keys.join(strings, on, "left").join(vectors, on, "left").select(*on, F.coalesce("value", F.lit(placeholder)).alias("value"), F.coalesce("v", zeros).alias("v"))


def merge_by_key(old: DataFrame, new: DataFrame, on: list[str], newest: list[str]) -> DataFrame:
    """The rows of `old` with those of `new` put over them: one row a key, the one that comes last by `newest`. Doing it again changes nothing."""
    rest = [c for c in old.columns if c not in on]
    last = old.unionByName(new).groupBy(*on).agg(F.max(F.struct(*newest, *[c for c in rest if c not in newest])).alias("__r"))
    return last.select(*on, *[F.col(f"__r.{c}").alias(c) for c in rest])
