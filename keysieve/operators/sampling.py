"""Deterministic sampling, balanced down-sampling, splits and folds.

Membership is decided by the first 32 bits of ``md5(key || '|' || salt)``:
no shuffle, the same on re-run and after any repartitioning, identical in any
SQL engine, and train/test are exact complements (no overlap, nothing lost).
Sample, split, balance and fold use different salts so they do not correlate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keysieve.functions.digest import TWO_POW_32, below_fraction, hash_bits

SALT_SAMPLE = "sample"
SALT_SPLIT = "split"
SALT_WEIGHTED = "weighted"
SALT_BALANCE = "balance"
SALT_FOLD = "fold"
SALT_PARTS = "parts"
HIST_SHIFT = 20  # 2^32 >> 20 = 4096 hash buckets per class for exact top-n


def hash_sample(df: DataFrame, fraction: float, key: str = "password",
                salt: str = SALT_SAMPLE) -> DataFrame:
    """About ``fraction`` of the rows, chosen by key hash (Bernoulli-like)."""
    return df.where(below_fraction(hash_bits(key, salt), fraction))


def native_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own Bernoulli sample (depends on partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def limited_sample(df: DataFrame, fraction: float, n: int, key: str = "password",
                   salt: str = SALT_SAMPLE) -> DataFrame:
    """Hash sample capped at ``n`` rows, taking the ``n`` smallest hashes so the
    cap is deterministic (a top-n, planned as TakeOrderedAndProject)."""
    bits = hash_bits(key, salt)
    return (df.withColumn("_h", bits).where(below_fraction(F.col("_h"), fraction))
            .orderBy("_h", key).limit(n).drop("_h"))


def train_test_split(df: DataFrame, train_fraction: float = 0.8, key: str = "password",
                     salt: str = SALT_SPLIT, out: str = "split") -> DataFrame:
    """Tag each row ``train`` or ``test`` (complements by construction)."""
    in_train = below_fraction(hash_bits(key, salt), train_fraction)
    return df.withColumn(out, F.when(in_train, "train").otherwise("test"))


def split_ids(df: DataFrame, n: int, key: str = "password", salt: str = SALT_PARTS,
              out: str = "split_id") -> DataFrame:
    """Assign one of ``n`` near-equal parts (``0..n-1``)."""
    return df.withColumn(out, (hash_bits(key, salt) % n).cast("int"))


def kfold(df: DataFrame, k: int = 3, key: str = "password", salt: str = SALT_FOLD,
          out: str = "fold") -> DataFrame:
    """Deterministic fold column for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(out, (hash_bits(key, salt) % k).cast("int"))


#: Largest share of a class that goes to training, so that every class is also tested.
MAX_FRACTION = 0.8


def class_fractions(df: DataFrame, per_class: int, label_col: str = "password_strength",
                    max_fraction: float = MAX_FRACTION) -> DataFrame:
    """``label -> least(max_fraction, n / count)``; one row per class."""
    return (df.where(F.col(label_col).isNotNull())
            .groupBy(label_col).agg(F.count(F.lit(1)).alias("_class_rows"))
            .select(label_col,
                    F.least(F.lit(float(max_fraction)), F.lit(float(per_class)) / F.col("_class_rows"))
                    .alias("_fraction")))


def balanced_flags(df: DataFrame, per_class: int = 15000,
                   label_col: str = "password_strength", key: str = "password",
                   salt: str = SALT_BALANCE, out: str = "in_train",
                   max_fraction: float = MAX_FRACTION, bits: str | None = None) -> DataFrame:
    """Tag about ``per_class`` rows of each class as training rows, but no more
    than ``max_fraction`` of the class. Rows with a null label or key are not.
    ``bits`` names a column that holds the key's hash bits already, for frames
    that don't carry the key.

    The per-class fraction table has one row per class; it is broadcast (its
    size is bounded by the number of classes, not by the data)."""
    frac = class_fractions(df, per_class, label_col, max_fraction)
    chosen = below_fraction(F.col(bits) if bits else hash_bits(key, salt), F.col("_fraction"))
    return (df.join(F.broadcast(frac), label_col, "left")
            .withColumn(out, F.coalesce(chosen, F.lit(False)))
            .select(*df.columns, out))


def balanced_split(df: DataFrame, per_class: int = 15000,
                   label_col: str = "password_strength", key: str = "password",
                   salt: str = SALT_BALANCE,
                   max_fraction: float = MAX_FRACTION) -> tuple[DataFrame, DataFrame]:
    """(train, test): about ``per_class`` rows per class, and all other rows."""
    tagged = balanced_flags(df, per_class, label_col, key, salt, "_in_train", max_fraction)
    return (tagged.where("_in_train").drop("_in_train"),
            tagged.where(~F.col("_in_train")).drop("_in_train"))


def sample_by_class_union(df: DataFrame, per_class: int = 15000,
                          label_col: str = "password_strength",
                          classes: list[str] | None = None, key: str = "password",
                          salt: str = SALT_BALANCE,
                          max_fraction: float = MAX_FRACTION) -> DataFrame:
    """The per-class filter + sample + union form of balancing; returns the
    same rows as the training side of :func:`balanced_split`: of all classes
    that occur (their names are taken to the driver), or of ``classes``."""
    frac = class_fractions(df, per_class, label_col, max_fraction).collect()  # a row per class
    key_bits = hash_bits(key, salt)
    out = df.where(F.lit(False))
    for r in frac:
        if classes is None or r[label_col] in classes:
            out = out.unionByName(df.where((F.col(label_col) == r[label_col]) & below_fraction(key_bits, r["_fraction"])))
    return out


def holdout(full: DataFrame, train: DataFrame, key: str = "password") -> DataFrame:
    """Test set as ``full`` minus ``train`` by a stable key (left anti join).

    The key side is made distinct first (map-side combined), so a key that
    repeats in ``train`` cannot blow up the join buffer. A hot key of ``full``
    is split by AQE's skew handling."""
    return full.join(train.select(key).distinct(), key, "left_anti")


def exact_per_class(df: DataFrame, per_class: int,
                    label_col: str = "password_strength", key: str = "password",
                    salt: str = SALT_BALANCE) -> DataFrame:
    """Exactly ``min(per_class, class size)`` rows per class: those with the
    smallest ``(hash, key)``. Rows that repeat a key count once: repeated rows
    are combined first, so no hot key meets in one task.

    No task sorts a whole class. A histogram of hash buckets per class (at most
    classes x 4096 rows) tells, for each class, which buckets are needed: all
    buckets before the one where the running count passes ``per_class``, and
    that one. Only rows of needed buckets are kept (about ``per_class`` plus
    one bucket, ~1/4096 of the class since the hash is uniform over distinct
    keys), and they are ranked with a window per (class, bucket).
    """
    h = df.dropDuplicates([label_col, key]).withColumns({"_h": hash_bits(key, salt)})
    h = h.withColumn("_b", F.shiftright(F.col("_h"), HIST_SHIFT))
    hist = h.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    need = (hist.withColumn("_cum", F.sum("_n").over(w))
            .withColumn("_prev", F.col("_cum") - F.col("_n"))
            .where(F.col("_prev") < per_class)
            .select(label_col, "_b", (F.lit(per_class) - F.col("_prev")).alias("_need")))
    rank = Window.partitionBy(label_col, "_b").orderBy("_h", key)
    return (h.join(F.broadcast(need), [label_col, "_b"])
            .withColumn("_r", F.row_number().over(rank))
            .where(F.col("_r") <= F.col("_need"))
            .select(*df.columns))


#: Parts of a power of two that an exponential key's histogram tells apart.
KEY_STEPS = 1024


def exponential_key(weight: str, key: str = "password", salt: str = SALT_WEIGHTED) -> F.Column:
    """A row's waiting time at rate ``weight``: the rows of the least ones are a
    weighted sample without replacement. Null unless the weight is positive."""
    u = (hash_bits(key, salt).cast("double") + 0.5) / F.lit(TWO_POW_32)
    return F.when(F.col(weight) > 0, -F.log(u) / F.col(weight).cast("double"))


def weighted_sample(df: DataFrame, n: int, weight: str = "freq", key: str = "password",
                    salt: str = SALT_WEIGHTED) -> DataFrame:
    """Exactly ``n`` rows (all with a positive weight, if there are fewer),
    drawn without replacement with chances by ``weight``: those of the least
    ``(exponential key, key)``. ``key`` should be distinct.

    No table is sorted. A histogram of the keys' logarithms, a few ten thousand
    buckets at most, tells the bucket in which the n-th row lies; rows of lower
    buckets are taken as they are, and only that bucket, well under a
    thousandth of the rows, is ordered. ``df`` is read once for the histogram
    and once for each of the two parts. Fires a job."""
    k = df.withColumn("_e", exponential_key(weight, key, salt)).where("_e is not null")
    k = k.withColumn("_b", F.floor(F.log2("_e") * KEY_STEPS))
    hist = k.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_b"))
    last = (hist.withColumn("_cum", upto).where(F.col("_cum") - F.col("_n") < n)
            .agg(F.max("_b").alias("b"), F.max(F.col("_cum") - F.col("_n")).alias("before")).first())
    if last["b"] is None:
        return df.where(F.lit(False))
    edge = k.where(F.col("_b") == last["b"]).orderBy("_e", key).limit(n - last["before"])
    return k.where(F.col("_b") < last["b"]).unionByName(edge).select(*df.columns)
