"""Item sets, MinHash signatures, LSH banding and similar pairs.

A pair's score is the number of LSH bands in which the two signatures are
equal (1..n_bands). Everything is built from aggregates, joins and array
expressions; the Python steps are the numpy fold of the default signature
engine (``engine="sql"`` stays on the JVM) and the comparison of the signatures
of a bucket, both on Arrow batches.

Scale notes
* Signatures are minima over (user, item) rows, folded per task and merged by
  a ``min`` aggregate, not hashes of a collected set: a user with a huge set is
  spread over many tasks.
* Users with identical signatures (copies, bots) collapse into one cluster
  represented by its smallest user id; pairs inside a cluster score n_bands
  and are never listed wholesale.
* Pairs with score >= t are found by the pigeonhole principle: split the bands
  into n_bands - t + 1 groups; such a pair agrees on every band of at least one
  group. Longer group keys make far smaller buckets than single bands. The
  top-k search goes down these levels, skips those that a bound on their pairs
  rules out. If all of them together hold fewer than k pairs, small tables
  count the join on single bands, once; larger ones are searched on subsets of
  2 to 4 bands (``_subsets``), whose buckets stay small where single bands
  do not, at a threshold that a look at some of these buckets proposes and the
  exact search confirms.
* A bucket of many different signatures is joined block by block, each pair of
  blocks under a key of its own.
* Where single bands are joined, a signature brings the hashes of all its bands
  to each of its buckets, and a pair is counted in the first bucket that it
  shares: signatures are shuffled, pairs are not.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.expr import hash_mod
from affinity.functions.hashing import NUM_HASHES, PRIME, hash_params
from affinity.operators.bounds import small_side, within
from affinity.operators.overlaps import chunked_overlaps
from affinity.session import reliable_checkpoint

N_BANDS = 32
ROWS_PER_BAND = 4
MIN_ITEMS = 3
TOP_K = 100
# Shares of the bands that top_pairs asks for, level by level, before it counts
# single bands: 31, 28, 24, 20 and 17 of 32. All are above one half, where the
# groups of the pigeonhole search have more than one band.
DESCENT = (31 / 32, 28 / 32, 24 / 32, 20 / 32, 17 / 32)
# Signatures of a bucket that are joined with each other under one key.
BLOCK = 2000
# The same where signatures are compared in numpy, which takes larger blocks: fewer copies of their rows.
TILED = 16_384
# Pairs compared at once, and the size of a bucket from which it is compared by tiles.
TILE, TILED_FROM = 1 << 18, 32
# Joined rows of single bands up to which they are just counted.
COUNTED = 10_000_000
# Joined rows a signature up to which top_pairs joins a level on whole groups of bands.
LEVEL_ROWS = 16
# Rows whose hashes are computed at once.
FOLD_ROWS = 8192
# Largest item number: a * item + b must stay below 2**63 for every hash function.
MAX_ITEM = (2**63 - 1 - PRIME) // PRIME


# ---------------------------------------------------------------- sets (M1, M2)

def item_sets(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """M1: the distinct items of each user as rows (user, item), a form that
    any size of set survives; nulls skipped."""
    return df.select(user, item).filter(F.col(item).isNotNull()).distinct()


def set_sizes(df: DataFrame, user: str = "user_id", item: str = "item_id",
              distinct_input: bool = False) -> DataFrame:
    """(user, n_items): distinct non-null items of each user. ``distinct_input``
    skips the de-duplication when the caller guarantees it."""
    rows = df.select(user, item).filter(F.col(item).isNotNull()) if distinct_input else item_sets(df, user, item)
    return rows.groupBy(user).agg(F.count(F.lit(1)).alias("n_items"))


def min_set_size(df: DataFrame, n: int = MIN_ITEMS, user: str = "user_id",
                 item: str = "item_id") -> DataFrame:
    """M2: keep the (user, item) rows of users with at least ``n`` distinct items."""
    keep = set_sizes(df, user, item).filter(F.col("n_items") >= n).select(user)
    return df.join(keep, user, "left_semi")


# ---------------------------------------------------------------- signatures (M3, M4)

def signatures(df: DataFrame, user: str = "user_id", item: str = "item_id",
               n_hashes: int = NUM_HASHES, min_items: int = 0, engine: str = "numpy",
               distinct_input: bool = False, number: str | None = None, grouped: bool = False) -> DataFrame:
    """M4: (user, n_items, sig array<int>, sig_key bigint).

    sig[i] = min over the user's items of (a_i * item + b_i) mod p. Null items
    are skipped; a user with null items only has the empty set, whose signature
    is p throughout. ``sig_key`` is a 64-bit hash of the signature for cheap
    shuffles; joins still compare the array itself. ``number`` is a SQL
    expression that gives an item's number (default: the item); sets are told
    apart by the items. A number beyond +-9e9 is an error.

    ``engine="numpy"``: each task folds its Arrow batches into per-user
    partial minima (numpy, one batch held), then a ``min`` aggregate merges
    the partials by user. The (user, number) rows are brought together by user
    first, in partitions that Spark splits where a user is huge; ``grouped``
    skips that for rows that mostly come user by user as they are.
    ``engine="sql"``: 128 ``min`` aggregates over the
    rows, JVM only. Both are partial-then-final aggregations, so a user with a
    huge set is spread over many map tasks. ``distinct_input`` skips the
    (user, item) de-duplication when the caller guarantees it.
    """
    rows = df.select(user, item)
    if min_items:
        rows = rows.filter(F.col(item).isNotNull())
    if not distinct_input:
        rows = rows.distinct()
    rows = rows.select(user, (F.expr(number) if number else F.col(item)).cast("bigint").alias("_x"))
    if engine == "numpy":
        if not grouped:
            rows = rows.hint("rebalance", user).sortWithinPartitions(user)
        partial = _numpy_partials(rows, user, "_x", n_hashes)
        agg = partial.groupBy(user).agg(
            F.sum("_n").alias("n_items"),
            *[F.min(F.col("_s")[i]).alias(f"_h{i}") for i in range(n_hashes)])
    else:
        a, b = hash_params(n_hashes)
        agg = rows.groupBy(user).agg(
            F.count("_x").alias("n_items"),
            *[F.min(hash_mod(F.col("_x"), a[i], b[i])).cast("int").alias(f"_h{i}")
              for i in range(n_hashes)])
    if min_items:
        agg = agg.filter(F.col("n_items") >= min_items)
    sig = F.array(*[F.coalesce(F.col(f"_h{i}"), F.lit(PRIME)).cast("int")
                    for i in range(n_hashes)])
    return agg.select(user, "n_items", sig.alias("sig")).withColumn("sig_key", F.xxhash64("sig"))


def signature_counts(df: DataFrame, user: str = "user_id", item: str = "item_id",
                     min_items: int = MIN_ITEMS, **how) -> DataFrame:
    """Users and distinct signatures, of all sets and of those with at least
    ``min_items`` items, in one aggregate over the signatures. Equal signatures
    may belong to sets on either side of the size."""
    big = F.col("n_items") >= min_items
    each = signatures(df, user, item, **how).groupBy("sig_key", "sig").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(big).alias("n_big"))
    return each.agg(F.sum("n").alias("n_users"), F.count(F.lit(1)).alias("n_signatures"),
                    F.sum("n_big").alias("n_users_filtered"), F.count_if(F.col("n_big") > 0).alias("n_signatures_filtered"))


def _numpy_partials(rows: DataFrame, user: str, item: str, n_hashes: int) -> DataFrame:
    """Per task: (user, _n items, _s partial signature) folded over its batches.
    Rows with a null item give the empty signature.

    A batch gives a row for each run of rows of one user (rows in no order are
    brought into runs first), and only its last run waits for the next batch.
    So a task holds one batch, whatever the number of users, and rows that come
    user by user give one partial row per user and task. An item number that
    occurs often in a batch is hashed once.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    a, b = hash_params(n_hashes)
    user_type = rows.schema[user].dataType.simpleString()
    limit = MAX_ITEM

    def fold(batches):
        av, bv = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)

        def out(users, counts, mins):
            ends = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * n_hashes)
            return pa.RecordBatch.from_arrays(
                [users, pa.array(counts), pa.ListArray.from_arrays(ends, pa.array(mins.ravel()))], names=[user, "_n", "_s"])

        def runs(codes, x):
            """Starts of the runs of equal codes, their lengths and minima."""
            start = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            if x.max() > limit or x.min() < -limit:
                raise ValueError(f"item numbers must be within +-{limit}")
            seen, at = np.unique(x, return_inverse=True)
            h = np.empty((len(seen), n_hashes), np.int32)
            for i in range(0, len(seen), 256):  # in the processor's cache
                h[i:i + 256] = (seen[i:i + 256, None] * av + bv) % PRIME
            ends = np.r_[start[1:], len(x)]
            if len(x) < 16 * len(start):
                mins = np.minimum.reduceat(h[at], start, axis=0)
            else:  # few long runs
                mins = np.stack([h.take(at[i:j], axis=0).min(axis=0) for i, j in zip(start, ends)])
            return start, ends - start, mins

        last = None  # user (an array of one), count and minima of the last run
        for whole in batches:
            for lo in range(0, whole.num_rows, FOLD_ROWS):
                batch = whole.slice(lo, FOLD_ROWS)
                coded = pc.dictionary_encode(batch.column(0), null_encoding="encode")
                names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
                none = batch.column(1).is_null().to_numpy(zero_copy_only=False)
                if none.any():
                    alone = np.unique(codes[none])
                    yield out(names.take(pa.array(alone)), np.zeros(len(alone), np.int64),
                              np.full((len(alone), n_hashes), PRIME, np.int32))
                    codes = codes[~none]
                    if not len(codes):
                        continue
                x = batch.column(1).drop_null().to_numpy()
                if (codes[1:] < codes[:-1]).any():
                    order = np.argsort(codes, kind="stable")
                    codes, x = codes[order], x[order]
                start, counts, mins = runs(codes, x)
                users = names.take(pa.array(codes[start]))
                if last is not None:
                    if last[0].equals(users.slice(0, 1)):
                        counts[0] += last[1]
                        mins[0] = np.minimum(mins[0], last[2])
                    else:
                        yield out(last[0], np.array([last[1]]), last[2])
                last = users.slice(len(users) - 1), counts[-1], mins[-1].copy()
                if len(users) > 1:
                    yield out(users.slice(0, len(users) - 1), counts[:-1], mins[:-1])
        if last is not None:
            yield out(last[0], np.array([last[1]]), last[2])

    return rows.select(user, item).mapInArrow(fold, f"{user} {user_type}, _n bigint, _s array<int>")


# ---------------------------------------------------------------- clusters (M5, M6)

def clusters(sigs: DataFrame, user: str = "user_id") -> DataFrame:
    """(sig_key, sig, rep, n_users): one row per distinct signature, the
    smallest user id as representative."""
    return sigs.groupBy("sig_key", "sig").agg(F.min(user).alias("rep"),
                                               F.count(F.lit(1)).alias("n_users"))


def signature_clusters(sigs: DataFrame, k: int = 10, user: str = "user_id") -> DataFrame:
    """M5: the k largest groups of identical signatures, largest first
    (representative breaks ties): (rep, n_users, sig)."""
    return (clusters(sigs, user).orderBy(F.col("n_users").desc(), F.col("rep").asc())
            .limit(k).select("rep", "n_users", "sig"))


def members(sigs: DataFrame, cl: DataFrame, user: str = "user_id") -> DataFrame:
    """(user, rep, n_users) for every user."""
    return sigs.select(user, "sig_key", "sig").join(cl, ["sig_key", "sig"]).select(
        user, "rep", "n_users")


def cluster_members(sigs: DataFrame, pairs: DataFrame, k: int = 1, user: str = "user_id",
                    item: str = "item_id") -> DataFrame:
    """M6: users of the k largest signature clusters and their items:
    (rep, user, item). The k cluster rows are broadcast. ``sigs`` is read
    twice: checkpoint it first."""
    top = (clusters(sigs, user).orderBy(F.col("n_users").desc(), F.col("rep").asc()).limit(k)
           .select("sig_key", "sig", "rep"))
    who = sigs.select(user, "sig_key", "sig").join(F.broadcast(top), ["sig_key", "sig"])
    return who.select(user, "rep").join(pairs.select(user, item), user).select("rep", user, item)


# ---------------------------------------------------------------- bands (M7-M9)

def _band_expr(sig: Column, n_bands: int, rows: int, n_groups: int | None = None) -> Column:
    """Array of struct(g, key) with key = signature slice of group g.

    Without ``n_groups``: one group per band. With it: the n_bands bands are
    split into n_groups contiguous groups of whole bands (sizes differ by one).
    """
    if n_groups is None or n_groups == n_bands:
        return F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)),
                           lambda j: F.struct(j.alias("g"),
                                              F.slice(sig, j * rows + 1, rows).alias("key")))
    bounds = [(g * n_bands) // n_groups for g in range(n_groups + 1)]
    groups = [F.struct(F.lit(g).alias("g"),
                       F.slice(sig, bounds[g] * rows + 1,
                               (bounds[g + 1] - bounds[g]) * rows).alias("key"))
              for g in range(n_groups)]
    return F.array(*groups)


def bands(sigs: DataFrame, n_bands: int = N_BANDS, rows: int = ROWS_PER_BAND,
          user: str = "user_id") -> DataFrame:
    """M7: (user, band_idx, band array<int>), n_bands rows per user."""
    return (sigs.select(user, F.explode(_band_expr(F.col("sig"), n_bands, rows)).alias("_b"))
            .select(user, F.col("_b.g").alias("band_idx"), F.col("_b.key").alias("band")))


def buckets(band_rows: DataFrame, user: str = "user_id") -> DataFrame:
    """M8: users with equal (band_idx, band): (band_idx, band, n_users,
    min_user, max_user). The members of a bucket are the rows of ``bands`` with
    its key; they are never gathered into one row."""
    return band_rows.groupBy("band_idx", "band").agg(
        F.count(F.lit(1)).alias("n_users"), F.min(user).alias("min_user"), F.max(user).alias("max_user"))


def bucket_stats(band_rows: DataFrame, user: str = "user_id") -> DataFrame:
    """M9: number of buckets, their size summary, buckets with more than one
    user, and the largest. Counts only; no member lists."""
    b = buckets(band_rows, user)
    return b.agg(F.count(F.lit(1)).alias("n_buckets"),
                 F.avg("n_users").alias("mean_size"),
                 F.stddev_samp("n_users").alias("stddev_size"),
                 F.min("n_users").alias("min_size"),
                 F.percentile("n_users", 0.5).alias("median_size"),
                 F.count_if(F.col("n_users") > 1).alias("n_shared_buckets"),
                 F.max("n_users").alias("max_size"))


# ---------------------------------------------------------------- pairs

def _shared_bands(s1: Column, s2: Column, n_bands: int, rows: int) -> Column:
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(n_bands - 1)),
                           lambda j: F.slice(s1, j * rows + 1, rows)
                           == F.slice(s2, j * rows + 1, rows)))


def _rep_pairs(cl: DataFrame, min_count: int, n_bands: int, rows: int) -> DataFrame:
    """Pairs of distinct signatures sharing >= min_count bands:
    (rep1 < rep2, count, n1, n2).

    At or below half the bands the pigeonhole groups are single bands, so
    the band self-join itself is counted (an exact band comparison per joined
    row, partial-aggregated), with no signature join.
    """
    if min_count * 2 > n_bands:
        return _rep_pairs_grouped(cl, min_count, n_bands, rows)
    return _rep_pairs_counted(cl, n_bands, rows).filter(F.col("count") >= min_count)


def _keyed(cl: DataFrame, n_bands: int, rows: int, n_groups: int | None = None) -> DataFrame:
    """(rep, n_users, g, key, gk): a row per signature and group of bands."""
    keyed = cl.select("rep", "n_users", F.explode(_band_expr(F.col("sig"), n_bands, rows, n_groups)).alias("_g"))
    return keyed.select("rep", "n_users", F.col("_g.g").alias("g"), F.col("_g.key").alias("key"),
                        F.xxhash64(F.col("_g.g"), F.col("_g.key")).alias("gk"))


def _own_block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("rep", "g"), F.col(blocks)).cast("int")


def _deal(keyed: DataFrame, block: int, *carried: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of the triangular join: every row stands on the low side for
    its own and all higher blocks of its bucket, and on the high side for its
    own and all lower ones."""
    hot = keyed.groupBy("gk").agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > block).select(
        "gk", F.ceil(F.col("_m") / block).cast("int").alias("_blocks"))
    dealt = keyed.join(small_side(reliable_checkpoint(hot)), "gk", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = dealt.withColumn("_b", _own_block("_blocks"))
    low = dealt.select("gk", "g", "key", F.col("_b").alias("lo"), F.explode(F.sequence("_b", F.col("_blocks") - 1)).alias("hi"),
                       F.col("rep").alias("_r1"), F.col("n_users").alias("_n1"), *[F.col(c).alias(f"{c}1") for c in carried])
    high = dealt.select("gk", "g", "key", F.explode(F.sequence(F.lit(0), "_b")).alias("lo"), F.col("_b").alias("hi"),
                        F.col("rep").alias("_r2"), F.col("n_users").alias("_n2"), *[F.col(c).alias(f"{c}2") for c in carried])
    return low, high


def _bucket_pairs(keyed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (rep1 < rep2, n1, n2) of signatures in one bucket, a row for each
    bucket that they share, by a triangular join of blocks.

    A bucket of more than ``block`` signatures is cut into blocks by the hash of
    their representatives, and every two blocks (i <= j), the same one
    included, make a join key of their own. So a key joins about
    block x block rows at most, and a hot bucket of m signatures is spread over
    its (m / block)^2 / 2 keys, for m / block copies of its rows.
    """
    low, high = _deal(keyed, block)
    met = low.join(high, ["gk", "g", "key", "lo", "hi"]).filter((F.col("lo") < F.col("hi")) | (F.col("_r1") < F.col("_r2")))
    swap = F.col("_r1") > F.col("_r2")
    return met.select(F.least("_r1", "_r2").alias("rep1"), F.greatest("_r1", "_r2").alias("rep2"),
                      F.when(swap, F.col("_n2")).otherwise(F.col("_n1")).alias("n1"),
                      F.when(swap, F.col("_n1")).otherwise(F.col("_n2")).alias("n2"))


def _band_hash(sig: str, j: int, rows: int, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), F.lit(j), F.slice(sig, j * rows + 1, rows))


def _told_apart(cl: DataFrame, n_bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(rep, n_users, _h array<bigint>) with a hash of each band, equal only for
    equal bands, and (gk, _m): the hashes that several signatures have. A second
    hash tells whether different bands share one; if so, all are hashed anew."""
    for salt in itertools.count():
        hashes = F.array(*[_band_hash("sig", j, rows, salt) for j in range(n_bands)])
        hashed = cl.filter("rep IS NOT NULL").select("rep", "n_users", "sig", hashes.alias("_h"))
        second = F.xxhash64("g", F.slice("sig", F.col("g") * rows + 1, F.lit(rows)), F.lit(salt))
        shared = reliable_checkpoint(hashed.select("sig", F.posexplode("_h").alias("g", "gk")).select("gk", second.alias("_x")).groupBy("gk").agg(
            F.count(F.lit(1)).alias("_m"), (F.min("_x") != F.max("_x")).alias("_clash")).filter("_m > 1"))
        if shared.filter("_clash").isEmpty():
            return hashed.drop("sig"), shared.drop("_clash")


def _rep_pairs_counted(cl: DataFrame, n_bands: int, rows: int, block: int | None = None) -> DataFrame:
    """All pairs of distinct signatures that share a band, with the number of shared bands.

    Each signature is sent to those buckets of its bands that others share, with
    the hashes of all its bands. So a pair is counted where it first meets and no
    pair is shuffled. A hot bucket is cut into blocks as in ``_bucket_pairs``.
    """
    hashed, shared = _told_apart(cl, n_bands, rows)
    sizes = shared.select("gk", F.ceil(F.col("_m") / (block or TILED)).cast("int").alias("_blocks"))
    slim = hashed.select("rep", F.posexplode("_h").alias("g", "gk")).join(small_side(sizes), "gk")
    dealt = slim.join(hashed, "rep").withColumn("_b", _own_block("_blocks")).withColumn(
        "_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    n = int(cl.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # work grows with the square of a bucket: not by bytes
    met = dealt.select("gk", F.least("_b", "_o").alias("lo"), F.greatest("_b", "_o").alias("hi"), (F.col("_b") > F.col("_o")).alias("high"),
                       "g", "rep", "n_users", "_h").repartition(n, "gk", "lo", "hi").sortWithinPartitions("gk", "lo", "hi", "rep")
    return _numpy_pairs(met, n_bands)


def _numpy_pairs(met: DataFrame, n_bands: int) -> DataFrame:
    """(rep1, rep2, n1, n2, count): pairs of the rows of each (gk, lo, hi), which
    come one after the other in the order of ``rep``, one of each block if lo < hi,
    whose first equal hash is that of band g.

    A task holds one batch and the rows of one key (two blocks). Small buckets
    are compared side by side, large ones by tiles of ``TILE`` pairs.
    """
    import numpy as np
    import pyarrow as pa

    rep_type = met.schema["rep"].dataType.simpleString()
    tile, tiled_from = TILE, TILED_FROM

    def compare(batches):
        def pairs(rows, ends):
            """(p, q, count) of the rows of whole keys."""
            g, high, apart = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("g", "high", "apart"))
            h = rows.column("_h").flatten().to_numpy().reshape(-1, n_bands)
            start = np.r_[0, ends[:-1]]
            size = ends - start
            left = np.repeat(ends, size) - np.arange(len(g))  # rows of the key from this one on
            few = np.repeat(size <= tiled_from, size)
            for d in range(1, min(tiled_from, size.max())):
                found = np.flatnonzero(few & (left > d))
                for i in range(0, len(found), max(1, tile // n_bands)):
                    p = found[i:i + max(1, tile // n_bands)]
                    p = p[~apart[p] | (high[p] != high[p + d])]
                    same = h[p] == h[p + d]
                    first = same.argmax(axis=1) == g[p]
                    if first.any():
                        yield p[first], p[first] + d, same[first].sum(axis=1)
            for lo, hi in zip(start[size > tiled_from], ends[size > tiled_from]):
                band = g[lo]
                code = np.stack([np.unique(h[lo:hi, j], return_inverse=True)[1] for j in range(n_bands)]).astype(
                    np.int16 if hi - lo < 2 ** 15 else np.int32)
                place = np.arange(hi - lo)
                one, two = (place[~high[lo:hi]], place[high[lo:hi]]) if apart[lo] else (place, place)
                if not len(one) or not len(two):
                    continue
                code1, code2 = code[:, one], code[:, two]
                step = max(1, tile // len(two))
                for i in range(0, len(one), step):
                    off = 0 if apart[lo] else i  # columns before the tile's rows have been met
                    part, others = code1[:, i:i + step, None], code2[:, None, off:]
                    n = np.ones((part.shape[1], others.shape[2]), np.uint8 if n_bands < 256 else np.int32)
                    same, seen = np.empty(n.shape, bool), np.zeros(n.shape, bool)
                    for j in range(n_bands):
                        if j != band:
                            np.equal(part[j], others[j], out=same)
                            if j < band:
                                seen |= same
                            else:
                                n += same
                    fresh = ~seen
                    if not apart[lo]:
                        fresh &= place[i:i + step, None] < place[None, off:]
                    at = np.flatnonzero(fresh)
                    p, q = one[i + at // n.shape[1]], two[off + at % n.shape[1]]
                    if len(at):
                        yield lo + np.minimum(p, q), lo + np.maximum(p, q), n.ravel()[at]

        def out(rows, ends):
            rep, users = rows.column("rep"), rows.column("n_users")
            for p, q, n in pairs(rows, ends):
                p, q = pa.array(p), pa.array(q)
                yield pa.RecordBatch.from_arrays([rep.take(p), rep.take(q), users.take(p), users.take(q), pa.array(n.astype(np.int64))],
                                                 names=["rep1", "rep2", "n1", "n2", "count"])

        kept = []  # batches of a key that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*kept, batch]).combine_chunks().to_batches()[0]
            keys = [whole.column(c).to_numpy(zero_copy_only=False) for c in ("gk", "lo", "hi")]
            ends = 1 + np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
            if len(ends):
                yield from out(whole.slice(0, ends[-1]), ends)
                whole = whole.slice(ends[-1])
            kept = [whole]
        if kept:
            yield from out(kept[0], np.array([kept[0].num_rows]))

    rows = met.withColumn("apart", F.col("lo") < F.col("hi"))
    return rows.mapInArrow(compare, f"rep1 {rep_type}, rep2 {rep_type}, n1 bigint, n2 bigint, count bigint")


def _rep_pairs_grouped(cl: DataFrame, min_count: int, n_bands: int, rows: int) -> DataFrame:
    """The same for more than half the bands: candidates agree on a whole group
    of bands, and those that their sketches leave are compared signature by signature."""
    n = n_bands - min_count + 1
    groups = [tuple(range((g * n_bands) // n, ((g + 1) * n_bands) // n)) for g in range(n)]
    return _met_on(cl, groups, min_count, n_bands, rows)


def _scored(cl: DataFrame, cand: DataFrame, min_count: int, n_bands: int, rows: int) -> DataFrame:
    """The candidates (rep1, rep2) that share at least ``min_count`` bands, compared signature by signature."""
    s1 = cl.select(F.col("rep").alias("rep1"), F.col("sig").alias("s1"),
                   F.col("n_users").alias("n1"))
    s2 = cl.select(F.col("rep").alias("rep2"), F.col("sig").alias("s2"),
                   F.col("n_users").alias("n2"))
    scored = cand.join(s1, "rep1").join(s2, "rep2").select(
        "rep1", "rep2", "n1", "n2",
        _shared_bands(F.col("s1"), F.col("s2"), n_bands, rows).cast("long").alias("count"))
    return scored.filter(F.col("count") >= min_count)


def _subsets(n_bands: int, t: int, c: int) -> list[tuple[int, ...]]:
    """Sets of ``c`` bands such that any ``t`` of the bands hold one of them
    (c <= t): the bands are cut into (t - 1) div (c - 1) contiguous parts, so
    that one part has at least c of the t, and all c-subsets of each part are taken."""
    parts = n_bands if c == 1 else min(n_bands // c, (t - 1) // (c - 1))
    bounds = [(p * n_bands) // parts for p in range(parts + 1)]
    return [s for lo, hi in zip(bounds, bounds[1:]) for s in itertools.combinations(range(lo, hi), c)]


def _sketched(cl: DataFrame, n_bands: int, rows: int) -> DataFrame:
    """(rep, n_users, _h array<bigint>, _w0_, _w8_, ... bigint): each band's hash, and a byte of each, eight to a word."""
    def word(lo: int) -> Column:
        byte = [F.shiftleft(F.col("_h")[j].bitwiseAND(F.lit(255)), 8 * (j - lo)) for j in range(lo, min(lo + 8, n_bands))]
        return functools.reduce(lambda x, y: x.bitwiseOR(y), byte)

    hashed = cl.select("rep", "n_users", F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)),
                                                     lambda j: F.xxhash64(F.slice("sig", j * rows + 1, rows))).alias("_h"))
    return hashed.withColumns({w: word(8 * i) for i, w in enumerate(_words(n_bands))})


def _words(n_bands: int) -> list[str]:
    return [f"_w{lo}_" for lo in range(0, n_bands, 8)]


def _at_most_shared(n_bands: int) -> Column:
    """Bands whose bytes are equal: never fewer than the bands shared."""
    differ = F.lit(0)
    for w in _words(n_bands):
        x = F.col(f"{w}1").bitwiseXOR(F.col(f"{w}2"))
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return F.lit(n_bands) - differ


def _subset_pairs(sketched: DataFrame, subsets: Sequence[tuple[int, ...]], n_bands: int, block: int = BLOCK) -> DataFrame:
    """(rep1, rep2, n1, n2, most): a row for each subset of bands in which two
    signatures agree, with an upper bound of the bands they share. Only hashes
    and sketches are shuffled; hot buckets are dealt block by block."""
    key = F.array(*[F.xxhash64(F.lit(i), *[F.col("_h")[j] for j in s]) for i, s in enumerate(subsets)])
    words = _words(n_bands)
    keyed = sketched.select(F.explode(key).alias("gk"), "rep", "n_users", *words).withColumn("g", F.lit(0)).withColumn("key", F.lit(0))
    low, high = _deal(keyed, block, *words)
    met = low.join(high, ["gk", "lo", "hi"]).filter((F.col("lo") < F.col("hi")) | (F.col("_r1") < F.col("_r2")))
    swap = F.col("_r1") > F.col("_r2")
    return met.select(F.least("_r1", "_r2").alias("rep1"), F.greatest("_r1", "_r2").alias("rep2"),
                      F.when(swap, F.col("_n2")).otherwise(F.col("_n1")).alias("n1"),
                      F.when(swap, F.col("_n1")).otherwise(F.col("_n2")).alias("n2"),
                      _at_most_shared(n_bands).alias("most"))


def _rep_pairs_subsets(cl: DataFrame, min_count: int, c: int, n_bands: int, rows: int) -> DataFrame:
    """Pairs of distinct signatures sharing >= min_count bands, found on subsets
    of ``c`` bands and compared signature by signature."""
    return _met_on(cl, _subsets(n_bands, min_count, c), min_count, n_bands, rows)


def _met_on(cl: DataFrame, subsets: Sequence[tuple[int, ...]], min_count: int, n_bands: int, rows: int) -> DataFrame:
    """Pairs that agree on one of the subsets and share >= min_count bands:
    only those whose sketches allow it are joined with their signatures."""
    found = _subset_pairs(_sketched(cl, n_bands, rows), subsets, n_bands).filter(F.col("most") >= min_count)
    return _scored(cl, found.select("rep1", "rep2").distinct(), min_count, n_bands, rows)


def _bucket_sums(cl: DataFrame, sizes: Sequence[int], n_bands: int, rows: int) -> dict[int, float]:
    """For each c the pairs of signatures per group of c contiguous bands, on average."""
    def hashes(c: int) -> Column:
        return F.array(*[F.struct(F.lit(c).alias("c"), F.xxhash64(F.lit(j), F.slice("sig", j * rows + 1, c * rows)).alias("h"))
                         for j in range(0, n_bands - c + 1, c)])

    m = F.col("m").cast("double")
    sums = cl.select(F.explode(F.concat(*map(hashes, sizes))).alias("k")).groupBy("k.c", "k.h").agg(
        F.count(F.lit(1)).alias("m")).groupBy("c").agg(F.sum(m * (m - 1) / 2).alias("s")).collect()  # a row per size
    return {r.c: r.s / len(range(0, n_bands - r.c + 1, r.c)) for r in sums}


def _best_low_pairs(cl: DataFrame, need: int, n_bands: int, rows: int, keep) -> DataFrame | None:
    """All pairs with at least t shared bands, for a t at or below which ``need``
    user pairs lie, or None where counting single bands is the better way.

    The pairs that agree on some groups of contiguous bands propose t by their
    sketches; the exact search at t tells whether it is low enough.
    """
    sizes = [c for c in (1, 2, 3, 4) if c <= n_bands]
    per_key = _bucket_sums(cl, sizes, n_bands, rows)
    if per_key.get(1, 0) * n_bands <= COUNTED:
        return None
    n = cl.count()
    probe = next((c for c in sizes[1:] if per_key[c] * (n_bands // c) <= 64 * n), sizes[-1])
    groups = [tuple(range(j, j + probe)) for j in range(0, n_bands - probe + 1, probe)]
    seen = _subset_pairs(_sketched(cl, n_bands, rows), groups, n_bands).groupBy("most").agg(F.sum(F.col("n1") * F.col("n2")).alias("w"))
    t, total = 1, 0
    for most, w in sorted(((r.most, r.w) for r in seen.collect()), reverse=True):  # n_bands rows
        total += w
        if total >= need:
            t = most
            break
    for t in range(t, 1, -1):
        cost = {c: len(_subsets(n_bands, t, c)) * (per_key[c] + 8 * n) for c in sizes if c <= t}
        level = keep(_rep_pairs_subsets(cl, t, min(cost, key=cost.get), n_bands, rows))
        if (level.agg(F.sum(F.col("n1") * F.col("n2"))).first()[0] or 0) >= need:
            return level
    return None


def level_bounds(cl: DataFrame, levels: Sequence[int], n_bands: int, rows: int) -> dict[int, int]:
    """For each level t an upper bound of the number of user pairs between
    clusters that share at least t bands, without a join."""
    return {t: bound for t, (bound, _) in _level_sums(cl, levels, n_bands, rows).items()}


def _level_sums(cl: DataFrame, levels: Sequence[int], n_bands: int, rows: int) -> dict[int, tuple[int, float]]:
    """For each level t the bound of ``level_bounds`` and the pairs of clusters
    that meet in the level's groups of bands.

    Such a pair agrees on a whole group of bands, so it is counted in that
    group's bucket: a bucket whose clusters have n_1, n_2, ... users holds
    ((sum n)^2 - sum n^2) / 2 pairs. One aggregate over the bucket hashes of
    all levels (equal hashes of different keys only raise a bound).
    """
    def hashes(t: int) -> Column:
        return F.transform(_band_expr(F.col("sig"), n_bands, rows, n_bands - t + 1),
                           lambda x: F.struct(F.lit(t).alias("t"), F.xxhash64(x["g"], x["key"]).alias("h")))

    keys = F.concat(*map(hashes, levels))
    n = F.col("n_users").cast("double")  # a bound: the sums may exceed 64 bits
    sums = (cl.select("n_users", F.explode(keys).alias("k")).groupBy("k.t", "k.h")
            .agg(F.sum(n).alias("s"), F.sum(n * n).alias("q"), F.count(F.lit(1)).alias("m")).filter("m > 1"))
    m = F.col("m").cast("double")
    found = {r.t: (math.ceil(r.bound * (1 + 1e-9)), r.met) for r in sums.groupBy("t").agg(
        F.sum((F.col("s") * F.col("s") - F.col("q")) / 2).alias("bound"), F.sum(m * (m - 1) / 2).alias("met")).collect()}
    return {t: found.get(t, (0, 0.0)) for t in levels}


def _first_members(mem: DataFrame, limit: int, user: str) -> DataFrame:
    """The ``limit`` smallest users of each cluster, with their position.
    row_number <= limit is planned as a per-task group limit before the
    shuffle, so a huge cluster sends only ``limit`` rows per task."""
    w = Window.partitionBy("rep").orderBy(user)
    return mem.withColumn("_pos", F.row_number().over(w)).filter(F.col("_pos") <= limit)


def _cross_cluster_pairs(rp: DataFrame, mem: DataFrame, limit: int | None, user: str) -> DataFrame:
    """Expand representative pairs into user pairs (u1 < u2, count). With
    ``limit``, only the ``limit`` smallest members of each cluster take part
    (enough for a top-``limit`` by (count, user1, user2))."""
    m = _first_members(mem, limit, user) if limit else mem
    m1 = m.select(F.col("rep").alias("rep1"), F.col(user).alias("_a"))
    m2 = m.select(F.col("rep").alias("rep2"), F.col(user).alias("_b"))
    e = rp.select("rep1", "rep2", "count").join(m1, "rep1").join(m2, "rep2")
    return e.select(F.least("_a", "_b").alias("user1"), F.greatest("_a", "_b").alias("user2"),
                    "count")


def _within_cluster_pairs(mem: DataFrame, limit: int | None, n_bands: int,
                          user: str) -> DataFrame:
    """User pairs inside clusters (identical signatures): count = n_bands.
    With ``limit``, only each cluster's ``limit`` + 1 smallest members."""
    m = mem.filter(F.col("n_users") > 1)
    if limit:
        m = _first_members(m, limit + 1, user)
    a = m.select("rep", F.col(user).alias("user1"))
    b = m.select("rep", F.col(user).alias("user2"))
    return (a.join(b, "rep").filter(F.col("user1") < F.col("user2"))
            .select("user1", "user2", F.lit(n_bands).cast("long").alias("count")))


def candidate_groups(sigs: DataFrame, min_count: int = 1, n_bands: int = N_BANDS,
                     rows: int = ROWS_PER_BAND, user: str = "user_id") -> DataFrame:
    """M10, between groups of users with equal signatures: (rep1, rep2, n1, n2,
    count). A group is named by its smallest user and has n users; every user
    of the one shares ``count`` bands with every user of the other. A group of
    several users is also listed with itself (rep1 = rep2), at n_bands."""
    cl = reliable_checkpoint(clusters(sigs, user))  # read by the count of the buckets and by both sides of their join
    own = cl.filter("n_users > 1").select(F.col("rep").alias("rep1"), F.col("rep").alias("rep2"), F.col("n_users").alias("n1"),
                                          F.col("n_users").alias("n2"), F.lit(n_bands).cast("long").alias("count"))
    return own if min_count >= n_bands else own.unionByName(_rep_pairs(cl, min_count, n_bands, rows))


def candidate_pairs(sigs: DataFrame, min_count: int = 1, n_bands: int = N_BANDS,
                    rows: int = ROWS_PER_BAND, user: str = "user_id") -> DataFrame:
    """M10 as user pairs (user1 < user2) sharing at least ``min_count`` bands,
    with the number of shared bands as ``count``.

    This expands ``candidate_groups``: the output has a row for each pair of
    users, so it grows with the square of a group. For small tables and tests.
    """
    cl = clusters(sigs, user)
    mem = members(sigs, cl, user)
    out = _within_cluster_pairs(mem, None, n_bands, user)
    if min_count < n_bands:
        out = out.unionByName(
            _cross_cluster_pairs(_rep_pairs(cl, min_count, n_bands, rows), mem, None, user))
    return out


def top_pairs(sigs: DataFrame, k: int = TOP_K, n_bands: int = N_BANDS,
              rows: int = ROWS_PER_BAND, user: str = "user_id",
              descent: Sequence[float] = DESCENT) -> DataFrame:
    """The k pairs sharing most bands, as (user1, user2, count) in the
    total order (count desc, user1, user2). Exact.

    Start from identical signatures (count = n_bands). If they give at least k
    pairs, the answer lies in the k groups with the smallest representatives
    (each has a pair that starts with it), and there in each group's k + 1
    smallest members. Otherwise go down the levels of ``descent`` until the
    pairs with count >= t, weighted by group sizes, reach k; a level is only
    joined if its bound (``level_bounds``, one aggregate for all of them) lets it
    reach k. If no level does, lower ones are searched on subsets of bands
    (``_best_low_pairs``); on small tables the join on single bands is counted once, and the
    largest t that reaches k is read from its counts. Each level is one job on
    the driver's order;
    ``sigs`` should be persisted or checkpointed by the caller. The k result
    rows are checkpointed and every intermediate is released before returning.
    """
    order = [F.col("count").desc(), F.col("user1").asc(), F.col("user2").asc()]
    cl = clusters(sigs, user).persist()
    cached = [cl]

    def weight(rp: DataFrame) -> int:
        return rp.agg(F.sum(F.col("n1") * F.col("n2"))).first()[0] or 0

    try:
        within_total = cl.agg(F.sum(F.col("n_users") * (F.col("n_users") - 1) / 2)).first()[0] or 0
        if within_total >= k:
            first = cl.filter("n_users > 1").orderBy("rep").limit(k)
            mem = sigs.select(user, "sig_key", "sig").join(F.broadcast(first), ["sig_key", "sig"]).select(user, "rep", "n_users")
            res = _within_cluster_pairs(mem, k, n_bands, user).orderBy(*order).limit(k)
        else:
            mem = members(sigs, cl, user)
            rp = None
            levels = sorted({int(round(f * n_bands)) for f in descent if f * n_bands > n_bands / 2 and f < 1}, reverse=True)
            bounds = _level_sums(cl, levels, n_bands, rows) if levels else {}
            n = cl.count() if levels else 0
            for t in (t for t in levels if within_total + bounds[t][0] >= k):
                if bounds[t][1] > max(COUNTED, LEVEL_ROWS * n):
                    break  # the buckets of this level grow with the square of the table
                level = _rep_pairs_grouped(cl, t, n_bands, rows).persist()
                cached.append(level)
                if within_total + weight(level) >= k:
                    rp = level
                    break
                cached.remove(level)
                level.unpersist()
            if rp is None:
                rp = _best_low_pairs(cl, k - int(within_total), n_bands, rows, lambda df: cached.append(df.persist()) or cached[-1])
            if rp is None:
                rp = _rep_pairs_counted(cl, n_bands, rows).persist()
                cached.append(rp)
                per_count = rp.groupBy("count").agg(F.sum(F.col("n1") * F.col("n2")).alias("w"))
                total, low = within_total, 1
                for count, w in sorted(((r["count"], r["w"]) for r in per_count.collect()), reverse=True):  # n_bands rows
                    total += w
                    if total >= k:
                        low = count
                        break
                rp = rp.filter(F.col("count") >= low)
            within = _within_cluster_pairs(mem, None, n_bands, user)  # fewer than k pairs
            res = within.unionByName(_cross_cluster_pairs(rp, mem, k, user)).orderBy(*order).limit(k)
        # k rows: store them in the checkpoint folder and release the
        # intermediates; the result no longer depends on cached data.
        return reliable_checkpoint(res)
    finally:
        for c in cached:
            c.unpersist()


# ---------------------------------------------------------------- Jaccard

def with_sets(pairs: DataFrame, df: DataFrame, user: str = "user_id",
              item: str = "item_id") -> DataFrame:
    """The items of both users of each pair, as rows (user1, user2, item,
    in1, in2), so a large set stays many rows."""
    p = pairs.select("user1", "user2").distinct()
    sides = p.select("user1", "user2", F.explode(F.array(
        F.struct(F.col("user1").alias("u"), F.lit(1).alias("side")),
        F.struct(F.col("user2").alias("u"), F.lit(2).alias("side")))).alias("s")).select("user1", "user2", "s.u", "s.side")
    rows = df.select(F.col(user).alias("u"), item).filter(F.col(item).isNotNull())
    return rows.join(small_side(sides), "u").groupBy("user1", "user2", item).agg(
        F.bool_or(F.col("side") == 1).alias("in1"), F.bool_or(F.col("side") == 2).alias("in2"))


def jaccard(pairs: DataFrame, df: DataFrame, user: str = "user_id",
            item: str = "item_id", sizes: DataFrame | None = None) -> DataFrame:
    """Exact Jaccard of each pair of a pair list: |A and B| / |A or B|.
    No set is ever collected. Adds n_items1, n_items2, n_shared, jaccard (NULL
    when both sets are empty). ``sizes`` (user, n_items) saves a pass when
    already known.

    Only rows of the list's users are read past the scan. A list within the
    broadcast bound is broadcast to the (user, item) rows; for a longer one the
    sets are packed into chunks first (``overlaps.chunked_overlaps``).
    """
    p = pairs.select("user1", "user2").distinct()
    who = small_side(p.select(F.explode(F.array("user1", "user2")).alias(user)).distinct())
    rows = (df.select(user, item).filter(F.col(item).isNotNull())
            .join(who, user, "left_semi").distinct())
    if sizes is None:
        sizes = rows.groupBy(user).agg(F.count(F.lit(1)).alias("n_items"))
    else:
        sizes = sizes.select(user, "n_items").join(who, user, "left_semi")
    if within(p):
        r1 = rows.select(F.col(user).alias("user1"), item)
        r2 = rows.select(F.col(user).alias("user2"), item)
        shared = (F.broadcast(p).join(r1, "user1").join(r2, ["user2", item])
                  .groupBy("user1", "user2").agg(F.count(F.lit(1)).alias("n_shared")))
    else:
        shared = chunked_overlaps(p, rows, user, item)
    n1 = sizes.select(F.col(user).alias("user1"), F.col("n_items").alias("n_items1"))
    n2 = sizes.select(F.col(user).alias("user2"), F.col("n_items").alias("n_items2"))
    out = (pairs.join(n1, "user1", "left").join(n2, "user2", "left")
           .join(shared, ["user1", "user2"], "left")
           .fillna(0, subset=["n_items1", "n_items2", "n_shared"]))
    union = F.col("n_items1") + F.col("n_items2") - F.col("n_shared")
    return out.withColumn("jaccard", F.try_divide(F.col("n_shared").cast("double"), union))


def similar_pairs(df: DataFrame, user: str = "user_id", item: str = "item_id",
                  k: int = TOP_K, min_items: int = MIN_ITEMS, n_bands: int = N_BANDS,
                  rows: int = ROWS_PER_BAND, n_hashes: int = NUM_HASHES,
                  distinct_input: bool = False, persist_input: bool = False,
                  number: str | None = None, grouped: bool = False) -> DataFrame:
    """Sets -> size filter -> signatures -> top-k pairs -> Jaccard.

    Signatures are checkpointed to the session's checkpoint folder: the pair
    search reads them several times, and a lost executor must not send the
    job back to the raw interactions. ``persist_input`` keeps the (user,
    item) rows for the Jaccard step when the input is expensive to derive
    (a plain Parquet scan is cheaper to read twice).
    """
    df = df.select(user, item)
    if persist_input:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sigs = reliable_checkpoint(signatures(df, user, item, n_hashes, min_items=min_items,
                                              distinct_input=distinct_input, number=number, grouped=grouped))
        top = top_pairs(sigs, k, n_bands, rows, user)
        out = jaccard(top, df, user, item, sizes=sigs)
        # k rows; materialized so the persisted input can be released.
        return reliable_checkpoint(out) if persist_input else out
    finally:
        if persist_input:
            df.unpersist()
