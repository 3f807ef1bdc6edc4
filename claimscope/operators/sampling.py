"""Growing a table by noisy resampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimscope.functions.columns import col, hash_unit
from claimscope.functions.order import exact_percentiles
from claimscope.operators.clean import numeric_columns
from claimscope.session import cut_lineage

# The columns an augmented table keeps.
AUGMENT_COLUMNS = ["policy_number", "age", "months_as_customer", "policy_state", "policy_csl",
                   "policy_annual_premium", "insured_sex", "fraud_reported"]


def augment(df: DataFrame, target: int, columns: Sequence[str] = AUGMENT_COLUMNS, noise: float = 0.05, seed: int = 42) -> DataFrame:
    """Exactly ``target`` rows: the originals, then copies with Gaussian noise on the numbers.

    Every row is copied equally often; for what is left over, the rows with the least hash of
    their content are copied once more, up to an exact cut point. Rows are
    multiplied in place, without a shuffle. The noise has ``noise`` times the deviation of its
    column, and is made from the row's content, the number of the copy and the column: the same rows give
    the same copies however they are partitioned. Equal rows share their noise. A table that is large enough already stays as it is.
    """
    df = df.select(*[col(c) for c in columns if c in df.columns])
    names, numeric = df.columns, numeric_columns(df)
    place = F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    stored = cut_lineage(df, "augment").withColumn("_place", place)
    content = F.concat(*[F.coalesce(F.concat(F.length(col(c).cast("string")).cast("string"), F.lit(":"), col(c).cast("string")), F.lit("-")) for c in names])
    stored = stored.withColumn("_content", F.md5(content)).withColumn("_h", hash_unit(F.col("_content"), seed))
    facts = stored.agg(F.count("*").alias("n"), *[F.stddev_samp(col(c)).alias(f"s{i}") for i, c in enumerate(numeric)]).first()
    n = facts["n"]
    if n == 0 or n >= target:
        return stored.select(*[col(c) for c in names])

    rounds, rest = divmod(target - n, n)
    copies = F.lit(rounds)
    if rest:
        share = (rest - 1) / (n - 1) if n > 1 else 0.0
        # the rank may come out a hair low in floating point; ask for the middle of its step
        share = min(1.0, share + 0.5 / max(n - 1, 1)) if rest < n else 1.0
        cut = exact_percentiles(stored, {"h": F.col("_h")}, [share], interpolate=False)["h"][0]
        below = stored.filter(F.col("_h") < cut).count()
        # rows at the cut are equal, but for a rare collision of hashes; which of them are copied makes no difference
        numbered = F.row_number().over(W.partitionBy("_h").orderBy("_content", "_place"))
        at_cut = cut_lineage(stored.filter(F.col("_h") == cut).select("_h", "_content", "_place").withColumn("_n", numbered)
                             .filter(F.col("_n") <= rest - below).select("_place", F.lit(1).alias("_more")), "augment-cut")
        stored = stored.join(at_cut, "_place", "left")
        copies = copies + ((F.col("_h") < cut) | F.col("_more").isNotNull()).cast("int")
    grown = stored.withColumn("_copy", F.explode(F.sequence(F.lit(0), copies)))
    def normal(i: int) -> Column:
        """A normal number from a row's content, its copy and the column (Box and Muller)."""
        key = F.concat_ws(":", F.col("_content"), F.col("_copy").cast("string"), F.lit(str(i)))
        u, v = hash_unit(F.concat(key, F.lit("u")), seed), hash_unit(F.concat(key, F.lit("v")), seed)
        return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u)) * F.cos(F.lit(2 * math.pi) * v)

    shaken = {
        c: F.when(F.col("_copy") == 0, col(c).cast("double"))
        .otherwise(col(c) + normal(i) * F.lit(noise * (facts[f"s{i}"] or 0.0)))
        for i, c in enumerate(numeric)
    }
    return grown.withColumns(shaken).select(*[col(c) for c in names])
