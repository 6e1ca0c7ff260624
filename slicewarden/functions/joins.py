"""Join helpers for lookups whose big side may hold a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this on the big side is hot and gets salted.
HOT_ROWS = 1_000_000
# At most this many keys are salted, the largest ones: a key beyond them holds
# at most 1 / MAX_HOT of all rows.  Bounds the broadcast of the hot keys.
MAX_HOT = 10_000
# Hot keys are looked for in the parts of so many, by hash, that are large enough to hold one.
HOT_PARTS = 1 << 16
# A lookup table of at most this many keys is broadcast once its rows were counted.
FEW_KEYS = 100_000


def broadcast_if_few(keys: DataFrame) -> DataFrame:
    """``keys`` (stored, so that counting them is cheap), broadcast if they are
    at most ``FEW_KEYS``: the big side then stays where it is."""
    return F.broadcast(keys) if keys.limit(FEW_KEYS + 1).count() <= FEW_KEYS else keys


def broadcast_or_merge(keys: DataFrame) -> DataFrame:
    """Like :func:`broadcast_if_few`, but many keys are never broadcast: the planner
    judges a table by its files, and a few MB of them may hold millions of keys,
    more than a driver can build a broadcast of."""
    few = broadcast_if_few(keys)
    return keys.hint("merge") if few is keys else few


def hottest(counts: DataFrame, n_col: str, hot_rows: int) -> DataFrame:
    """The rows of ``counts`` with more than ``hot_rows``, at most ``MAX_HOT``
    of them (the largest)."""
    return counts.where(F.col(n_col) > hot_rows).orderBy(F.desc(n_col)).limit(MAX_HOT)


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's columns, apart from maps, which have none.  Unlike a
    random number it is the same when a lost task runs again."""
    plain = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    return F.xxhash64(F.lit(7), *plain)


def hot_keys(big: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(__hk, __salts): hot keys of ``big`` and the number of parts each is
    cut into.  Reads the key column only: once to count the rows of
    ``HOT_PARTS`` parts of all keys, which leaves a few rows a task to shuffle,
    and once for the keys of parts with more than ``hot_rows``."""
    part = F.pmod(F.xxhash64(F.col(key)), F.lit(HOT_PARTS))
    large = big.groupBy(part.alias("__hp")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    keys = big.select(F.col(key).alias("__hk"), part.alias("__p"))
    keys = keys.join(F.broadcast(large.select("__hp")), F.col("__p") == F.col("__hp"), "left_semi")
    counts = keys.groupBy("__hk").agg(F.count(F.lit(1)).alias("__n"))
    return hottest(counts, "__n", hot_rows).select("__hk", F.ceil(F.col("__n") / hot_rows).cast("int").alias("__salts"))


def hot_split_lookup(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                     hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Inner equi-join of ``big`` with a lookup table ``small`` that may not
    be broadcast whole, safe when one key holds a large share of ``big``.

    One join on (key, salt): the rows of a hot key are dealt to ``__salts``
    salts, and only that key's lookup rows are repeated, once per salt; all
    other rows have salt 0.  ``hot`` may hold the hot keys found on another
    frame, e.g. one that ``big`` was derived from.  The result equals
    ``big.join(small, big[big_key] == small[small_key])``.
    """
    if hot is None:
        hot = hot_keys(big, big_key, hot_rows)
    hot = F.broadcast(hot)               # at most MAX_HOT rows
    salt = F.coalesce(F.pmod(row_hash(big), F.col("__salts")).cast("int"), F.lit(0))
    salted = big.join(hot, big[big_key] == F.col("__hk"), "left").select(*[big[c] for c in big.columns],
                                                                       salt.alias("__salt"))
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))
    copies = small.join(hot, small[small_key] == F.col("__hk"), "left").select(*[small[c] for c in small.columns],
                                                                             parts.alias("__part"))
    joined = salted.join(copies, (salted[big_key] == copies[small_key]) & (F.col("__salt") == F.col("__part")))
    return joined.drop("__salt", "__part")
