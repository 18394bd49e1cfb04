"""Re-key listings to the key account's folders and combine all accounts.

Plan shape (one shuffle for the combine, everything else broadcast when the
folder-sized side passes its size check):

    listing --(broadcast map, inner)--> rekeyed --(filter all-null)--> exchange on (name, key folder)
                                        --> hash aggregate: each account's copies of a key --> one row a copy
    key folders --(left anti, broadcast seen folders)--> placeholder rows (empty folders)

The combine deals rows out by ``(name, bucket, prefix)``, so a hot folder is spread over
all reducers by file name. An account's key is almost always unique, so nothing would fold before
the exchange, and nothing is sorted. The seen folders come from the same exchange, read again.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktake.functions.uri import quoted
from stocktake.operators.joins import fits_broadcast, join_small
from stocktake.operators.uri_map import ORD, key_folders, materialize
from stocktake.schemas import ATTRS, FILE_NAME_COLUMN, OBJECT_STRUCT, attr_column, key_bucket_column, key_prefix_column

# Grouping key of the combine.
ROW_KEY = ["name", "key_bucket", "key_prefix"]
FOLDER_KEY = ["account", "bucket", "prefix"]
#: Copies of a key in an account that are paired in one array.
MAX_COPIES = 256


def map_for_rekey(long_map: DataFrame) -> DataFrame:
    """``(account, bucket, prefix) -> (key_bucket, key_prefix)`` for every usable map cell."""
    return (
        long_map.where(F.col("bucket").isNotNull() & F.col("key_bucket").isNotNull())
        .select(*FOLDER_KEY, "key_bucket", "key_prefix")
        .distinct()
    )


def rekey(listing: DataFrame, long_map: DataFrame) -> DataFrame:
    """Replace each account's folder by the key account's folder of the same map row.

    Rows of folders outside the map are dropped here; :func:`unmapped_objects` reports them.
    """
    joined = join_small(listing, map_for_rekey(long_map), FOLDER_KEY, "inner", salt_by=["name"], bound=long_map)
    return joined.select("account", "key_bucket", "key_prefix", "name", *ATTRS)


def unmapped_objects(listing: DataFrame, long_map: DataFrame) -> DataFrame:
    """Listing rows whose ``(account, bucket, prefix)`` is not in the map."""
    m = map_for_rekey(long_map).select(*FOLDER_KEY)
    return join_small(listing, m, FOLDER_KEY, "left_anti", salt_by=["name"], bound=long_map)


def rekey_counts(listing: DataFrame, long_map: DataFrame) -> DataFrame:
    """Per account: listing rows, rows the re-key produces, rows outside the map (one pass).

    The re-key preserves the row count when ``n_rekeyed + n_unmapped == n_rows``;
    a folder mapped to two key folders (a duplicated map entry) makes ``n_rekeyed`` larger.
    """
    keys = map_for_rekey(long_map).groupBy(*FOLDER_KEY).agg(F.count(F.lit(1)).alias("n_keys"))
    joined = join_small(listing.select(*FOLDER_KEY, "name"), keys, FOLDER_KEY, "left", salt_by=["name"], bound=long_map)
    return joined.groupBy("account").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("n_keys"), F.lit(0)).cast("long").alias("n_rekeyed"),
        F.count(F.when(F.col("n_keys").isNull(), F.lit(1))).alias("n_unmapped"),
    )


def order_like_map(flat: DataFrame, long_map: DataFrame, accounts: list[str]) -> DataFrame:
    """Optional output order: map row order of the key folder, then file name (empty folders first).

    A total, deterministic order (a range-partitioned sort); use it for small
    outputs or when the text files must list rows as the map does.
    """
    key = accounts[0]
    ords = long_map.where(F.col("account") == F.lit(key)).groupBy(
        F.col("key_bucket").alias("__b"), F.col("key_prefix").alias("__p")
    ).agg(F.min(ORD).alias("__ord"))
    kb, kp = quoted(key_bucket_column(key)), quoted(key_prefix_column(key))
    joined = flat.join(F.broadcast(ords) if fits_broadcast(long_map) else ords, (kb == F.col("__b")) & (kp == F.col("__p")), "left")
    return joined.orderBy(F.col("__ord").asc_nulls_last(), kb, kp, quoted(FILE_NAME_COLUMN).asc_nulls_first()).drop(
        "__b", "__p", "__ord"
    )


def has_attributes() -> Column:
    return F.col("date").isNotNull() | F.col("size").isNotNull() | F.col("hash").isNotNull()


def account_column(accounts: list[str], account: str) -> str:
    """Internal name of an account's struct, so that no account name meets a column of ours."""
    return f"__acc_{accounts.index(account)}"


def deal(rekeyed: DataFrame) -> DataFrame:
    """Rows with an attribute, dealt out by the row key: the combine's only exchange of objects."""
    return rekeyed.where(has_attributes()).repartition(*ROW_KEY)


def let(name: str, value: str, use: str) -> str:
    """SQL: ``use`` with ``name`` bound to the value, computed once (an array of one holds it)."""
    return f"transform(array({value}), {name} -> {use})[0]"


def paired(names: list[str]) -> str:
    """SQL: the rows of one key from ``found``, its copies with their account's number ``k``: an array of one struct per row.

    Copies with equal hashes share a row, as many times as at least two accounts have them (rows by hash). All
    other copies of an account fill, by date, size and hash, first the rows where the account has none yet, then new ones.
    """
    n, columns = len(names), [f"`{c}`" for c in names]
    copy = "struct(" + ", ".join(f"{{c}}.{a} AS {a}" for a in ATTRS) + ")"
    place = "cast(array_position(found.k, {k}) AS int) - 1"
    only = "if(array_contains(found.k, {k}), " + copy.format(c=f"get(found, {place})") + ", NULL)"
    single = "array(struct(" + ", ".join(f"{only.format(k=k)} AS {c}" for k, c in enumerate(columns)) + "))"
    none = f"cast(array() AS array<array<{OBJECT_STRUCT.simpleString()}>>)"
    # `copies`: by account; `groups`: by hash and account; `common`: cells of the rows that two accounts share.
    hashes = "array_sort(filter(array_distinct(transform(flatten(copies), x -> x.hash)), h -> h IS NOT NULL))"
    groups = f"transform({hashes}, h -> transform(copies, c -> filter(c, x -> x.hash = h)))"
    depth = "sort_array(transform(g, c -> size(c)), false)[1]" if n > 1 else "0"
    common = f"flatten(transform(groups, g -> if({depth} > 0, transform(sequence(0, {depth} - 1), j -> transform(g, c -> get(c, j))), {none})))"
    # `rest`: what is left, by account; `gaps`: the common rows without the account.
    more = f"flatten(transform(groups, g -> slice(g[k], {depth} + 1, greatest(size(g[k]) - {depth}, 0))))"
    rest = f"transform(copies, (c, k) -> array_sort(concat(filter(c, x -> x.hash IS NULL), {more})))"
    gaps = "transform(copies, (c, k) -> filter(if(size(common) > 0, sequence(0, size(common) - 1), cast(array() AS array<int>)), i -> common[i][k] IS NULL))"
    last = "size(common) + greatest(0, array_max(transform(rest, (c, k) -> size(c) - size(gaps[k]))))"
    cell = """if(t < size(common),
        coalesce(get(get(common, t), {k}), if(array_position(gaps[{k}], t) > 0, get(rest[{k}], cast(array_position(gaps[{k}], t) AS int) - 1), NULL)),
        get(rest[{k}], size(gaps[{k}]) + t - size(common)))"""
    row = "struct(" + ", ".join(f"{cell.format(k=k)} AS {c}" for k, c in enumerate(columns)) + ")"
    rows = f"transform(sequence(0, {last} - 1), t -> {row})"
    by_account = f"transform(sequence(0, {n - 1}), k -> array_sort(transform(filter(found, c -> c.k = k), c -> {copy.format(c='c')})))"
    bound = let("copies", by_account, let("groups", groups, let("common", common, let("rest", rest, let("gaps", gaps, rows)))))
    return f"if(size(array_distinct(found.k)) = size(found), {single}, {bound})"


def combine_dealt(dealt: DataFrame, accounts: list[str]) -> DataFrame:
    """:func:`combine` of rows that are dealt out already."""
    names = [account_column(accounts, a) for a in accounts]
    number = F.array_position(F.array(*[F.lit(a) for a in accounts]), F.col("account")).cast("int") - 1
    # One aggregate keeps a key's copies (hardly ever more than one an account) in a hash map: no sort, no window.
    found = F.collect_list(F.when(number >= 0, F.struct(number.alias("k"), *ATTRS))).alias("found")
    return dealt.groupBy(*ROW_KEY).agg(found).where(F.size("found") > 0).selectExpr(*ROW_KEY, f"inline({paired(names)})")


def combine(rekeyed: DataFrame, accounts: list[str], repeated: DataFrame | None = None) -> DataFrame:
    """N-way outer combine: one row per key and copy, one ``struct<date,size,hash>`` column per account.

    Rows with no attribute at all (placeholders) are dropped first. Rows of one account with equal
    keys (versions of an object, a listing given twice) are all kept and paired across accounts as
    :func:`paired` states. A key's copies are held together in a task; keys known to have more of them than that
    bears (``repeated``, with the columns of the row key) are paired the same way by sorts that spill.
    """
    if repeated is None:
        return combine_dealt(deal(rekeyed), accounts)
    keys = repeated.select(*ROW_KEY).distinct()
    same = lambda side: reduce(operator.and_, [rekeyed[c].eqNullSafe(side[c]) for c in ROW_KEY])
    few = combine_dealt(deal(rekeyed.join(keys, same(keys), "left_anti")), accounts)
    return few.unionByName(combine_many_copies(rekeyed.join(keys, same(keys), "left_semi"), accounts))


def repeated_keys(duplicates: DataFrame, listing: DataFrame, long_map: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """Row keys with more copies in an account than :func:`combine` should hold together in a task.

    From the report of keys listed more than once, and the objects without a name (which it leaves out), counted by folder."""
    named = duplicates.where(F.col("n_copies") > most).select(*FOLDER_KEY, "name")
    unnamed = listing.where(F.col("name").isNull() & has_attributes()).groupBy(*FOLDER_KEY, "name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    nothing = {a: F.lit(None).cast(t) for a, t in zip(ATTRS, ("timestamp", "long", "string"))}
    return materialize(rekey(named.unionByName(unnamed.drop("n")).withColumns(nothing), long_map).select(*ROW_KEY).distinct())


def combine_many_copies(rekeyed: DataFrame, accounts: list[str]) -> DataFrame:
    """The rows of :func:`combine` by windows: copies are numbered and matched as rows, however many a key has."""
    obj = F.struct(*[F.col(a) for a in ATTRS])
    key = Window.partitionBy(*ROW_KEY)
    nth = F.row_number().over(Window.partitionBy(*ROW_KEY, "account", "hash").orderBy("date", "size"))
    holders = F.count(F.lit(1)).over(Window.partitionBy(*ROW_KEY, "hash", "nth"))
    numbered = rekeyed.where(has_attributes()).withColumn("nth", nth).withColumn("common", F.col("hash").isNotNull() & (holders > 1))
    place = F.dense_rank().over(Window.partitionBy(*ROW_KEY, "common").orderBy("hash", "nth"))
    turn = F.row_number().over(Window.partitionBy(*ROW_KEY, "common", "account").orderBy(*ATTRS))
    placed = numbered.withColumn("place", F.when(F.col("common"), place)).withColumn("turn", F.when(~F.col("common"), turn))
    placed = placed.withColumn("n_common", F.coalesce(F.max("place").over(key), F.lit(0)))
    # Which common rows an account isn't in, in their order; its other copies take these places by turn.
    present = placed.where("common").groupBy(*ROW_KEY, "place").agg(F.collect_set("account").alias("there"))
    gaps = present.select(*ROW_KEY, "place", F.explode(F.array_except(F.array(*[F.lit(a) for a in accounts]), "there")).alias("account"))
    mine = Window.partitionBy(*ROW_KEY, "account")
    gaps = gaps.withColumn("gap_turn", F.row_number().over(mine.orderBy("place"))).withColumn("n_gaps", F.count(F.lit(1)).over(mine))
    on = [*ROW_KEY, "account"]
    named = lambda df, prefix: df.select([F.col(c).alias(f"{prefix}_{c}") for c in df.columns])
    equal = lambda prefix, columns: reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"{prefix}_{c}")) for c in columns])
    by_turn = named(gaps.select(*on, F.col("gap_turn").alias("turn"), "place"), "gap")
    counts = named(gaps.select(*on, "n_gaps").distinct(), "all")
    filled = placed.where("NOT common").join(by_turn, equal("gap", [*on, "turn"]), "left").join(counts, equal("all", on), "left")
    at = F.coalesce("gap_place", F.col("n_common") + F.col("turn") - F.coalesce("all_n_gaps", F.lit(0)))
    rows = placed.where("common").select(*ROW_KEY, "account", *ATTRS, "place").unionByName(filled.select(*ROW_KEY, "account", *ATTRS, at.alias("place")))
    per_account = [F.max(F.when(F.col("account") == F.lit(a), obj)).alias(account_column(accounts, a)) for a in accounts]
    return rows.groupBy(*ROW_KEY, "place").agg(*per_account).drop("place")


def seen_folders(dealt: DataFrame) -> DataFrame:
    """Key folders that hold an object, from the rows as they were dealt out.

    The bits of all columns are asked for (and their presence is tested), so the optimizer can't narrow the
    rows before the exchange: the combine's own exchange is read again, and neither the listing nor the aggregate runs twice.
    """
    bits = F.bit_or(F.xxhash64("name", "account", *ATTRS))
    return dealt.groupBy(F.col("key_bucket").alias("bucket"), F.col("key_prefix").alias("prefix")).agg(bits.alias("bits")).where(F.col("bits").isNotNull()).drop("bits")


def with_empty_folders(combined: DataFrame, seen: DataFrame, long_map: DataFrame, accounts: list[str]) -> DataFrame:
    """Add a null row for every key-account folder that is not among ``seen``.

    The anti join is on folder-sized inputs only; object rows are never shuffled by folder.
    """
    # `seen` holds key folders only (re-keying is an inner join on the map), so the map bounds its size.
    empty = join_small(key_folders(long_map), seen, ["bucket", "prefix"], "left_anti", null_safe=True, bound=long_map)
    return combined.unionByName(placeholder_rows(empty, accounts))


def placeholder_rows(folders: DataFrame, accounts: list[str]) -> DataFrame:
    """``bucket, prefix`` folders -> struct-form rows with a null name and null accounts."""
    nulls = [F.lit(None).cast(OBJECT_STRUCT).alias(account_column(accounts, a)) for a in accounts]
    return folders.select(
        F.col("bucket").alias("key_bucket"), F.col("prefix").alias("key_prefix"), F.lit(None).cast("string").alias("name"), *nulls
    )


def flatten(struct_form: DataFrame, accounts: list[str], key_account: str | None = None) -> DataFrame:
    """Struct per account -> ``bucket_in_<key>, prefix_in_<key>, file_name_in_all_accounts, <attr>_in_<account>``."""
    key_account = key_account or accounts[0]
    cols = [
        F.col("key_bucket").alias(key_bucket_column(key_account)),
        F.col("key_prefix").alias(key_prefix_column(key_account)),
        F.col("name").alias(FILE_NAME_COLUMN),
    ]
    for a in accounts:
        cols += [F.col(account_column(accounts, a)).getField(attr).alias(attr_column(attr, a)) for attr in ATTRS]
    return struct_form.select(*cols)


def to_struct_form(flat: DataFrame, accounts: list[str], key_account: str | None = None) -> DataFrame:
    """Inverse of :func:`flatten`, built from the account list (names are never parsed)."""
    key_account = key_account or accounts[0]
    cols = [
        quoted(key_bucket_column(key_account)).alias("key_bucket"),
        quoted(key_prefix_column(key_account)).alias("key_prefix"),
        quoted(FILE_NAME_COLUMN).alias("name"),
    ]
    for a in accounts:
        cols.append(F.struct(*[quoted(attr_column(attr, a)).alias(attr) for attr in ATTRS]).alias(account_column(accounts, a)))
    return flat.select(*cols)


def all_accounts_struct(listing: DataFrame, long_map: DataFrame, accounts: list[str]) -> DataFrame:
    dealt = deal(rekey(listing, long_map))
    return with_empty_folders(combine_dealt(dealt, accounts), seen_folders(dealt), long_map, accounts)


def all_accounts(listing: DataFrame, long_map: DataFrame, accounts: list[str]) -> DataFrame:
    """Listings of all accounts -> the flattened all-accounts table."""
    return flatten(all_accounts_struct(listing, long_map, accounts), accounts)
